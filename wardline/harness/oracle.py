"""DuckDB SQL for the registered queries.

Written from the definitions of the results and not from the operators: joins
are literal (disjunctions, fan-outs), sums are over rows, ranks are windows.
"""

from __future__ import annotations

import re

from wardline import vocabulary as V
from wardline.harness import adapter as A

_STATES = ", ".join(f"({code}, '{state}')" for code, state in V.STATE_BY_CODE.items())
_NATIONS = ", ".join(f"({key}, {code})" for key, code in enumerate((*A.NATION_CODES, A.UNMAPPED_CODE)))
_CODES = ", ".join(f"'{code}'" for code in A.CASES.codes)
_SLICE = (f"cid_principal IN ({_CODES}) AND uf = '{A.CASES.state}' "
          f"AND ano BETWEEN {A.CASES.first_year} AND {A.CASES.last_year}")
_LOW, _MID, _HIGH = A.LEVEL_BOUNDS

# Common table expressions, each in terms of the test tables and of the ones above it.
CTES = {
    "states": f"SELECT * FROM (VALUES {_STATES}) AS t(code, sigla)",
    "nations": f"""
        SELECT k AS nationkey, t.code, sigla FROM (VALUES {_NATIONS}) AS t(k, code)
        LEFT JOIN states ON states.code = t.code""",
    "adm": """
        SELECT concat(l_orderkey, '-', l_linenumber) AS N_AIH,
               l_linestatus AS UF_ZI,
               350000 + l_partkey % 25 AS MUNIC_RES,
               350000 + l_suppkey % 25 AS MUNIC_MOV,
               CASE WHEN l_orderkey % 10 < 6 THEN strftime(CAST(l_shipdate AS DATE), '%Y-%m-%d')
                    WHEN l_orderkey % 10 < 9 THEN strftime(CAST(l_shipdate AS DATE), '%Y%m%d')
                    ELSE strftime(CAST(l_shipdate AS DATE), '%d/%m/%Y') END AS DT_INTER,
               strftime(CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER), '%Y%m%d') AS DT_SAIDA,
               p_type AS DIAG_PRINC,
               CAST(l_partkey AS VARCHAR) AS PROC_REA,
               CASE WHEN l_orderkey % 53 = 0 THEN -l_extendedprice ELSE l_extendedprice END AS VAL_TOT,
               CAST(l_quantity AS BIGINT) - 3 AS DIAS_PERM,
               l_partkey % 95 AS IDADE,
               l_returnflag AS SEXO,
               CAST(l_linenumber % 2 AS BIGINT) AS MORTE,
               l_suppkey + CASE WHEN l_orderkey % 97 = 0 THEN 1000 ELSE 0 END AS CNES,
               sigla AS uf
        FROM lineitem LEFT JOIN part ON p_partkey = l_partkey
        LEFT JOIN supplier ON s_suppkey = l_suppkey
        LEFT JOIN nations ON nationkey = s_nationkey""",
    "adm_dated": """
        SELECT *, CAST(CASE WHEN regexp_full_match(DT_INTER, '[0-9]{4}-[0-9]{2}-[0-9]{2}')
                            THEN try_strptime(DT_INTER, '%Y-%m-%d')
                            WHEN regexp_full_match(DT_INTER, '[0-9]{8}')
                            THEN try_strptime(DT_INTER, '%Y%m%d') END AS DATE) AS internacao,
               CAST(try_strptime(DT_SAIDA, '%Y%m%d') AS DATE) AS saida
        FROM adm""",
    "adm_first": """
        SELECT * FROM adm_dated QUALIFY row_number() OVER (PARTITION BY N_AIH ORDER BY
            DT_INTER NULLS LAST, DIAS_PERM NULLS LAST, VAL_TOT NULLS LAST, CNES NULLS LAST, DIAG_PRINC NULLS LAST,
            UF_ZI NULLS LAST, MUNIC_RES NULLS LAST, MUNIC_MOV NULLS LAST, DT_SAIDA NULLS LAST, PROC_REA NULLS LAST,
            IDADE NULLS LAST, SEXO NULLS LAST, MORTE NULLS LAST, uf NULLS LAST) = 1""",
    "sil": """
        SELECT N_AIH, UF_ZI AS uf_residencia_paciente, MUNIC_RES, MUNIC_MOV AS municipio_id,
               internacao AS DT_INTER, saida AS DT_SAIDA, DIAG_PRINC AS cid_principal, PROC_REA,
               VAL_TOT AS valor_total, CAST(DIAS_PERM AS INTEGER) AS dias_permanencia,
               CAST(IDADE AS INTEGER) AS IDADE, SEXO, MORTE, CNES AS cnes_id, uf,
               CAST(year(internacao) AS INTEGER) AS ano, CAST(month(internacao) AS INTEGER) AS mes,
               CAST(weekofyear(internacao) AS INTEGER) AS semana_epidemiologica
        FROM adm_first WHERE DIAS_PERM >= 0 AND VAL_TOT >= 0 AND internacao IS NOT NULL""",
    "reg": """
        SELECT s_suppkey AS codigo_cnes,
               s_name || CASE WHEN version = 2 THEN '' ELSE ' (antigo)' END AS nome_fantasia,
               CAST(nullif((s_suppkey + CASE WHEN version = 2 THEN 0 ELSE 3 END) % 8, 0) AS INTEGER)
                   AS codigo_tipo_unidade,
               code AS codigo_uf,
               CAST(CASE WHEN s_suppkey % 2 = 0 THEN 350000 + s_nationkey
                         ELSE (350000 + s_nationkey) * 10 + 5 END AS INTEGER) AS codigo_municipio,
               CASE WHEN s_suppkey % 17 <> 0 THEN -20 - s_nationkey / 10.0::DOUBLE END AS latitude,
               CASE WHEN s_suppkey % 17 <> 0 THEN -45 - s_suppkey / 100.0::DOUBLE END AS longitude,
               CAST(s_suppkey % 2 AS INTEGER) AS possui_atendimento_hospitalar,
               CASE WHEN version = 2 AND s_suppkey % 10 = 0 THEN NULL
                    WHEN version = 2 OR s_suppkey % 13 = 0 THEN '2024-03-15' ELSE '2022-06-01' END
                   AS data_atualizacao,
               sigla
        FROM supplier LEFT JOIN nations ON nationkey = s_nationkey
        CROSS JOIN (VALUES (1), (2)) AS v(version)""",
    "reg_latest": """
        SELECT * FROM reg QUALIFY row_number() OVER (PARTITION BY codigo_cnes ORDER BY
            data_atualizacao DESC NULLS LAST, nome_fantasia NULLS LAST, codigo_tipo_unidade NULLS LAST) = 1""",
    "dim": """
        SELECT codigo_cnes AS cnes_id, nome_fantasia AS nome_estabelecimento, codigo_tipo_unidade,
               codigo_tipo_unidade IN (5, 7, 15, 20, 21, 62) AS eh_tipo_hospitalar, sigla AS uf,
               CAST(codigo_municipio AS BIGINT) AS codigo_municipio, latitude, longitude,
               CAST(NULL AS INTEGER) AS leitos_totais, CAST(NULL AS INTEGER) AS leitos_sus,
               possui_atendimento_hospitalar, data_atualizacao
        FROM reg_latest WHERE sigla IS NOT NULL""",
    "muni": f"""
        SELECT CAST(CASE n_nationkey WHEN {A.APART} THEN {A.APART_CODE} ELSE 350000 + n_nationkey END * 10 + 5 AS BIGINT)
                   AS codigo_municipio, n_name AS nome_municipio, sigla AS uf, r_name AS regiao_saude, CAST(n_nationkey * 10000 AS BIGINT) AS populacao,
               1.5 + n_nationkey / 10.0::DOUBLE AS meta_leitos_1000hab
        FROM nation LEFT JOIN region ON r_regionkey = n_regionkey LEFT JOIN nations ON nationkey = n_nationkey""",
    "fato": """
        SELECT cnes_id, municipio_id, semana_epidemiologica, cid_principal, valor_total, dias_permanencia, ano, mes
        FROM sil""",
    "placed": """
        SELECT d.*, m.nome_municipio, m.regiao_saude, m.populacao
        FROM dim d LEFT JOIN muni m
        ON m.codigo_municipio = d.codigo_municipio OR m.codigo_municipio // 10 = d.codigo_municipio""",
    "cases": """
        SELECT uf, cid_principal, ano, mes, semana_epidemiologica, count(*) AS qtd_casos
        FROM fato LEFT JOIN (SELECT cnes_id, uf FROM dim) USING (cnes_id) GROUP BY ALL""",
    "lagged": """
        SELECT *, lag(qtd_casos) OVER (PARTITION BY uf, cid_principal ORDER BY ano, mes, semana_epidemiologica)
                   AS qtd_casos_semana_anterior
        FROM cases""",
    "trend": """
        SELECT *, CASE WHEN qtd_casos_semana_anterior > 0 THEN
                   (qtd_casos - qtd_casos_semana_anterior) / qtd_casos_semana_anterior * 100 END AS variacao_pct
        FROM lagged""",
    "trend_month": """
        SELECT uf, cid_principal, ano, mes, CAST(sum(qtd_casos) AS BIGINT) AS qtd_casos_mes,
               avg(variacao_pct) AS variacao_media_pct
        FROM trend GROUP BY ALL""",
    "feats": """
        SELECT cnes_id, ano, mes, count(*) AS qtd_internacoes, avg(dias_permanencia) AS permanencia_media,
               count(*) FILTER (WHERE dias_permanencia >= 10) AS pacientes_criticos
        FROM fato GROUP BY ALL""",
    "indexed": """
        SELECT *, round_even((qtd_internacoes / (SELECT max(qtd_internacoes) FROM feats) * 50
                              + permanencia_media / (SELECT max(permanencia_media) FROM feats) * 30
                              + pacientes_criticos / (SELECT max(pacientes_criticos) FROM feats) * 20) * 10, 0) / 10
                   AS indice_pressao
        FROM feats""",
    "press": f"""
        SELECT *, CASE WHEN indice_pressao >= {_HIGH} THEN 'Sobrecarga iminente'
                       WHEN indice_pressao >= {_MID} THEN 'Crítico'
                       WHEN indice_pressao >= {_LOW} THEN 'Atenção' ELSE 'Baixo risco' END AS nivel_risco
        FROM indexed""",
    "overview": """
        SELECT ano, mes, uf, nome_municipio, count(*) AS qtd_internacoes,
               CAST(sum(CAST(valor_total AS DECIMAL(38, 6))) AS DOUBLE) AS valor_total_pago,
               avg(dias_permanencia) AS permanencia_media, avg(indice_pressao) AS indice_pressao_medio,
               max(nivel_risco) AS nivel_risco_predominante
        FROM fato JOIN placed USING (cnes_id)
        LEFT JOIN (SELECT cnes_id, ano, mes, indice_pressao, nivel_risco FROM press) USING (cnes_id, ano, mes)
        GROUP BY ALL""",
    "region_pressure": """
        SELECT uf, nome_municipio, latitude, longitude, regiao_saude,
               avg(indice_pressao) AS indice_pressao_medio, min(nivel_risco) AS nivel_risco_regiao,
               CAST(sum(dias_permanencia) AS DOUBLE) * 1000 / nullif(populacao, 0) AS internacoes_por_1000hab,
               CAST(count(*) AS DOUBLE) * 1000 / nullif(populacao, 0) AS admissoes_por_1000hab
        FROM fato JOIN press USING (cnes_id, ano, mes) JOIN placed USING (cnes_id)
        GROUP BY uf, nome_municipio, latitude, longitude, regiao_saude, populacao""",
    "alerts": f"""
        SELECT nome_estabelecimento, uf, nome_municipio, ano, mes, indice_pressao, nivel_risco,
               qtd_internacoes, permanencia_media,
               rank() OVER (PARTITION BY ano, mes ORDER BY indice_pressao DESC NULLS LAST) AS ranking_criticidade
        FROM placed JOIN press USING (cnes_id) WHERE indice_pressao >= {_MID}""",
    "alerts_state": f"""
        SELECT * FROM alerts WHERE uf = '{A.CASES.state}'
        ORDER BY ano DESC, mes DESC, ranking_criticidade, nome_estabelecimento, nome_municipio NULLS LAST,
                 nivel_risco, qtd_internacoes, permanencia_media
        LIMIT 30""",
    "case_rows": f"SELECT * FROM fato JOIN placed USING (cnes_id) WHERE {_SLICE}",
    "case_overview": """
        SELECT ano, mes, uf, nome_municipio, count(*) AS qtd_internacoes,
               CAST(sum(CAST(valor_total AS DECIMAL(38, 6))) AS DOUBLE) AS valor_total_pago,
               avg(dias_permanencia) AS permanencia_media
        FROM case_rows GROUP BY ALL""",
    "case_names": """
        SELECT nome_estabelecimento, uf, nome_municipio, count(*) AS qtd_casos,
               avg(dias_permanencia) AS permanencia_media, rank() OVER (ORDER BY count(*) DESC) AS ranking_criticidade
        FROM case_rows GROUP BY nome_estabelecimento, uf, nome_municipio
        ORDER BY qtd_casos DESC, nome_estabelecimento, nome_municipio NULLS LAST LIMIT 20""",
    "occ": """
        SELECT l_suppkey AS cnes_id, s_name AS nome_estabelecimento, count(*) AS qtd_internacoes,
               round(avg(l_quantity), 1) AS permanencia_media,
               count(*) FILTER (WHERE l_quantity >= 45) AS pacientes_criticos,
               round(avg(l_discount + l_tax) * 12, 2) AS taxa_ocupacao_estimada
        FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY l_suppkey, s_name""",
    "occ_index": """
        SELECT *, round_even((least(greatest(taxa_ocupacao_estimada, 0), 1) * 60
                              + permanencia_media / (SELECT max(permanencia_media) FROM occ) * 25
                              + pacientes_criticos / (SELECT max(pacientes_criticos) FROM occ) * 15) * 10, 0) / 10
                   AS indice_pressao
        FROM occ""",
    "dropped": f"""
        SELECT * EXCLUDE (PROC_REA) REPLACE (CAST(CAST(replace(N_AIH, '-', '') AS BIGINT) AS VARCHAR) AS N_AIH, coalesce(uf, '{A.NO_STATE}') AS uf),
               PROC_REA AS partkey, year(shipped) * 100 + month(shipped) AS landed
        FROM (SELECT *, CAST(strptime(DT_SAIDA, '%Y%m%d') AS DATE) - CAST(DIAS_PERM + 3 AS INTEGER) AS shipped FROM adm)""",
    # Years whose files lack PROC_REA have it as NULL.
    "dropped_adm": """
        SELECT * EXCLUDE (partkey, shipped), CASE WHEN landed // 100 % 3 <> 1 THEN partkey END AS PROC_REA FROM dropped""",
    "run_sil": """
        SELECT N_AIH, CNES AS cnes_id, MUNIC_MOV AS municipio_id, DIAG_PRINC AS cid_principal, VAL_TOT AS valor_total,
               DIAS_PERM AS dias_permanencia,
               CAST(CASE WHEN DT_INTER LIKE '____-__-__' THEN try_strptime(DT_INTER, '%Y-%m-%d')
                         WHEN DT_INTER NOT LIKE '%/%' THEN try_strptime(DT_INTER, '%Y%m%d') END AS DATE) AS dia
        FROM (SELECT * FROM dropped_adm QUALIFY row_number() OVER (PARTITION BY N_AIH ORDER BY
              DT_INTER NULLS LAST, DIAS_PERM NULLS LAST, VAL_TOT NULLS LAST, CNES NULLS LAST, DIAG_PRINC NULLS LAST,
              UF_ZI NULLS LAST, MUNIC_RES NULLS LAST, MUNIC_MOV NULLS LAST, DT_SAIDA NULLS LAST, PROC_REA NULLS LAST,
              IDADE NULLS LAST, SEXO NULLS LAST, MORTE NULLS LAST, uf NULLS LAST) = 1)
        WHERE DIAS_PERM >= 0 AND VAL_TOT >= 0 AND dia IS NOT NULL""",
    "run_fato": """
        SELECT *, CAST(year(dia) AS INTEGER) AS ano, CAST(month(dia) AS INTEGER) AS mes,
               CAST(weekofyear(dia) AS INTEGER) AS semana FROM run_sil""",
    "run_feats": """
        SELECT cnes_id, ano, mes, count(*) AS n, avg(dias_permanencia) AS media,
               count(*) FILTER (WHERE dias_permanencia >= 10) AS criticos
        FROM run_fato GROUP BY ALL""",
    "run_press": """
        SELECT *, round_even((n / (SELECT max(n) FROM run_feats) * 50
                              + media / (SELECT max(media) FROM run_feats) * 30
                              + criticos / (SELECT max(criticos) FROM run_feats) * 20) * 10, 0) / 10 AS indice
        FROM run_feats""",
    "run_trend": """
        SELECT *, lag(casos) OVER (PARTITION BY uf, cid_principal ORDER BY ano, mes, semana) AS antes
        FROM (SELECT uf, cid_principal, ano, mes, semana, count(*) AS casos
              FROM run_fato LEFT JOIN (SELECT cnes_id, uf FROM dim) USING (cnes_id) GROUP BY ALL)""",
    "docs": """
        SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""",
    "doc_records": """
        SELECT event_id AS codigo_cnes, user_id, k, event_id % 6 AS kind, FALSE AS second FROM docs
        WHERE event_id % 6 <> 5
        UNION ALL
        SELECT event_id + 1000000, user_id, k, event_id % 6, TRUE FROM docs WHERE event_id % 6 IN (0, 2)""",
    "month_bounds": "SELECT min(DT_INTER) AS first, max(DT_INTER) AS last FROM sil",
    "spine": """
        SELECT CAST(year(m) AS INTEGER) AS ano, CAST(month(m) AS INTEGER) AS mes, strftime(m, '%Y%m') AS ano_mes
        FROM (SELECT unnest(generate_series(date_trunc('month', first), date_trunc('month', last), INTERVAL 1 MONTH))
              AS m FROM month_bounds)""",
    "landing": f"""
        SELECT ano_mes, count(*) AS vistas, count(*) FILTER (WHERE {_SLICE}) AS gravadas
        FROM (SELECT *, CAST(ano * 100 + mes AS VARCHAR) AS ano_mes FROM sil) GROUP BY ano_mes""",
    "landing_report": """
        SELECT spine.ano_mes, coalesce(vistas, 0) AS vistas, coalesce(gravadas, 0) AS gravadas,
               coalesce(gravadas, 0) = 0 AS vazio
        FROM spine LEFT JOIN landing ON landing.ano_mes = spine.ano_mes""",
    "filled": """
        SELECT codigo_municipio, nome_municipio,
               CASE WHEN codigo_municipio % 3 <> 0 THEN populacao ELSE 5000 END AS populacao,
               codigo_municipio % 3 = 0 AS is_estimated
        FROM muni""",
}

_RECORD = """codigo_cnes, 'U' || user_id AS nome_fantasia, CAST(NULL AS INTEGER) AS codigo_tipo_unidade,
    k AS codigo_uf, CAST(NULL AS INTEGER) AS codigo_municipio,
    -23.5::DOUBLE AS latitude_estabelecimento_decimo_grau,
    CAST(NULL AS DOUBLE) AS longitude_estabelecimento_decimo_grau,
    CAST(NULL AS INTEGER) AS estabelecimento_possui_atendimento_hospitalar,
    CAST(NULL AS VARCHAR) AS numero_telefone_estabelecimento, CAST(NULL AS VARCHAR) AS data_atualizacao"""

_REGISTRY = """codigo_cnes, nome_fantasia, codigo_tipo_unidade, codigo_uf, codigo_municipio,
    round(latitude, 6) AS latitude_estabelecimento_decimo_grau,
    round(longitude, 6) AS longitude_estabelecimento_decimo_grau,
    possui_atendimento_hospitalar AS estabelecimento_possui_atendimento_hospitalar,
    CAST(NULL AS VARCHAR) AS numero_telefone_estabelecimento, data_atualizacao"""

_FEATURES = """cnes_id, ano, mes, qtd_internacoes, round(permanencia_media, 6) AS permanencia_media,
    pacientes_criticos"""


def _scaled(column: str) -> str:
    return (f"round(({column} - (SELECT avg({column}) FROM feats)) / (SELECT stddev_pop({column}) FROM feats), 6) "
            f"+ 0 AS {column}_z")


def _written(name: str) -> str:
    return f"SELECT '{name}' AS escrita, * REPLACE (coalesce(uf, '--') AS uf) FROM adm"


_WHOLE_RUN = """
        SELECT ano, mes, uf, nome_municipio, TRUE AS nivel_valido, count(*) AS qtd_internacoes,
               round(CAST(sum(CAST(valor_total AS DECIMAL(38, 6))) AS DOUBLE), 6) AS valor_total_pago,
               round(avg(dias_permanencia), 6) AS permanencia_media, round(avg(indice), 6) AS indice_pressao_medio
        FROM run_fato JOIN placed USING (cnes_id)
        LEFT JOIN (SELECT cnes_id, ano, mes, indice FROM run_press) USING (cnes_id, ano, mes)
        GROUP BY ALL"""


SELECTS = {
    "src_partitions": "SELECT DISTINCT uf, CAST(landed AS VARCHAR) AS ano_mes FROM dropped",
    "src_drift_scan": "SELECT * EXCLUDE (landed) FROM dropped_adm",
    "src_harmonize": """
        SELECT CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS N_AIH, CAST(NULL AS VARCHAR) AS UF_ZI,
               CAST(NULL AS BIGINT) AS MUNIC_RES, CAST(NULL AS BIGINT) AS MUNIC_MOV,
               CAST(NULL AS VARCHAR) AS DT_INTER, CAST(NULL AS VARCHAR) AS DT_SAIDA,
               CAST(NULL AS VARCHAR) AS DIAG_PRINC, CAST(NULL AS VARCHAR) AS PROC_REA, l_extendedprice AS VAL_TOT,
               CASE WHEN l_orderkey % 11 <> 0 THEN CAST(l_quantity AS BIGINT) END AS DIAS_PERM,
               l_partkey AS IDADE, l_returnflag AS SEXO, CAST(NULL AS BIGINT) AS MORTE, CAST(NULL AS BIGINT) AS CNES
        FROM lineitem""",
    "src_json": f"SELECT {_REGISTRY} FROM reg",
    "src_parquet": "SELECT * REPLACE (strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate) FROM lineitem",
    "src_csv": """
        SELECT * REPLACE (regiao_saude || ', "norte"' AS regiao_saude,
                          round(meta_leitos_1000hab, 6) AS meta_leitos_1000hab) FROM muni""",
    "src_codes": "SELECT DISTINCT l_suppkey AS cnes_id FROM lineitem WHERE l_orderkey % 7 <> 0",
    "src_coords": """
        SELECT CAST((350000 + n_nationkey) * 10 + 5 AS BIGINT) AS codigo_ibge, n_name AS nome,
               -10 - n_nationkey / 4.0::DOUBLE AS latitude, -50 - n_nationkey / 8.0::DOUBLE AS longitude
        FROM nation""",
    "src_features": "SELECT * FROM occ",
    "json_envelope": f"SELECT {_RECORD} FROM doc_records WHERE kind <> 3",
    "json_lookup": f"SELECT {_RECORD} FROM doc_records WHERE NOT second",
    "json_population": """
        SELECT CAST(350000 + k AS BIGINT) AS codigo_municipio, max(event_id) AS populacao
        FROM docs WHERE event_id % 5 <> 0 AND event_id % 7 <> 0 GROUP BY ALL""",
    "json_municipality": """
        SELECT c_custkey AS codigo_municipio, c_name AS nome_municipio, 'SP' AS uf,
               CASE WHEN c_custkey % 5 IN (0, 1, 2) THEN c_mktsegment ELSE 'Não classificada' END AS regiao_saude
        FROM customer""",
    "land_admissions": """
        SELECT * EXCLUDE (partkey, shipped, landed) REPLACE ('SP' AS uf),
               CAST(NULL AS VARCHAR) AS PROC_REA, '202301' AS ano_mes
        FROM dropped WHERE starts_with(DIAG_PRINC, 'PROMO')""",
    "land_municipalities": """
        SELECT c_custkey AS codigo_municipio, c_name AS nome_municipio, 'SP' AS uf,
               CASE WHEN c_custkey % 5 IN (0, 1, 2) THEN c_mktsegment ELSE 'Não classificada' END AS regiao_saude,
               coalesce(last_event, 5000) AS populacao, CAST(NULL AS DOUBLE) AS meta_leitos_1000hab,
               last_event IS NULL AS is_estimated
        FROM customer LEFT JOIN (SELECT k, max(event_id) AS last_event FROM docs
                                 WHERE event_id % 5 <> 0 AND event_id % 7 <> 0 GROUP BY k) ON k = c_custkey""",
    "land_registry_codes": """
        SELECT event_id AS codigo_cnes, event_id % 6 <> 5 AND k = 35 AS encontrado FROM docs""",
    "sink_roundtrip": " UNION ALL ".join(_written(name) for name in ("colocated", "partitioned", "plain")),
    "sink_dynamic": """
        SELECT CAST(N_AIH AS BIGINT) AS N_AIH, VAL_TOT,
               DIAS_PERM + CASE WHEN uf = 'SP' AND landed // 100 = 1997 THEN 1000 ELSE 0 END AS DIAS_PERM,
               uf, CAST(landed AS VARCHAR) AS ano_mes
        FROM dropped""",
    "sink_json": f"SELECT {_REGISTRY} FROM reg CROSS JOIN (VALUES (1), (2)) AS runs(run)",
    "sink_csv": "SELECT * FROM occ_index",
    "catalog_tables": """
        SELECT 'fato_internacoes' AS tabela, cnes_id, municipio_id, semana AS semana_epidemiologica, cid_principal, valor_total,
               dias_permanencia, ano, mes FROM run_fato
        UNION ALL BY NAME SELECT 'dim_hospital' AS tabela, * EXCLUDE (data_atualizacao)
            REPLACE (round(latitude, 6) AS latitude, round(longitude, 6) AS longitude) FROM dim
        UNION ALL BY NAME SELECT DISTINCT 'dim_tempo' AS tabela, ano, mes, semana AS semana_epidemiologica,
            CAST((mes - 1) // 3 + 1 AS INTEGER) AS trimestre FROM run_fato
        UNION ALL BY NAME SELECT 'kpi_pressao_hospitalar' AS tabela, cnes_id, ano, mes, n AS qtd_internacoes,
            round(media, 6) AS permanencia_media, criticos AS pacientes_criticos, indice AS indice_pressao, TRUE AS em_ordem FROM run_press
        UNION ALL BY NAME SELECT 'kpi_tendencia_doencas' AS tabela, uf, cid_principal, ano, mes, semana AS semana_epidemiologica,
            casos AS qtd_casos, antes AS qtd_casos_semana_anterior,
            round(CASE WHEN antes > 0 THEN (casos - antes) / antes * 100 END, 6) AS variacao_pct FROM run_trend
        UNION ALL BY NAME SELECT 'municipios_referencia' AS tabela, * REPLACE (round(meta_leitos_1000hab, 6) AS meta_leitos_1000hab)
            FROM muni""",
    "catalog_views": """
        SELECT 'geral' AS visao, uf, nome_municipio AS chave, ano, mes, count(*) AS casos,
               round(avg(dias_permanencia), 6) AS media
        FROM run_fato JOIN placed USING (cnes_id) GROUP BY uf, nome_municipio, ano, mes
        UNION ALL
        SELECT 'tendencia', uf, cid_principal, ano, mes, CAST(sum(casos) AS BIGINT),
               round(avg(CASE WHEN antes > 0 THEN (casos - antes) / antes * 100 END), 6)
        FROM run_trend GROUP BY uf, cid_principal, ano, mes
        UNION ALL SELECT v, NULL, NULL, NULL, NULL, 0, NULL FROM (VALUES ('regiao'), ('ranking')) AS compared(v)""",
    "full_run": _WHOLE_RUN,
    "month_run": _WHOLE_RUN,
    "silver_by_month": """
        SELECT N_AIH, cnes_id, municipio_id, cid_principal, valor_total, CAST(dias_permanencia AS INTEGER) AS dias_permanencia, ano, mes
        FROM run_fato""",
    "silver_id_index": """
        SELECT N_AIH, string_agg(DISTINCT CAST(landed AS VARCHAR), ' ' ORDER BY CAST(landed AS VARCHAR)) AS meses, any_value(ano) AS ano,
               any_value(mes) AS mes
        FROM dropped_adm LEFT JOIN (SELECT N_AIH, ano, mes FROM run_fato) USING (N_AIH) GROUP BY N_AIH""",
    "proj_dim": """
        SELECT * EXCLUDE (data_atualizacao) REPLACE (round(latitude, 6) AS latitude, round(longitude, 6) AS longitude)
        FROM dim""",
    "proj_fact": "SELECT * FROM fato",
    "proj_typed_null": """
        SELECT s_suppkey, CAST(NULL AS INTEGER) AS leitos_totais, CAST(NULL AS INTEGER) AS leitos_sus
        FROM supplier""",
    "map_lookup": """
        SELECT c_custkey, sigla AS uf FROM customer
        LEFT JOIN states ON code = c_nationkey + 11 AND c_custkey % 9 <> 0""",
    "flag_isin": """
        SELECT codigo_cnes, nome_fantasia, codigo_tipo_unidade IN (5, 7, 15, 20, 21, 62) AS eh_tipo_hospitalar
        FROM reg""",
    "calendar": """
        SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS ano, CAST(month(o_orderdate) AS INTEGER) AS mes,
               CAST(weekofyear(o_orderdate) AS INTEGER) AS semana_epidemiologica
        FROM orders""",
    "dim_time": """
        SELECT DISTINCT ano, mes, semana_epidemiologica, CAST((mes - 1) // 3 + 1 AS INTEGER) AS trimestre FROM sil""",
    "proj_names": "SELECT o_orderkey AS O_ORDERKEY, o_orderstatus AS O_ORDERSTATUS FROM orders",
    "canonicalize": """
        SELECT CAST(l_orderkey AS VARCHAR) AS N_AIH, l_linenumber AS linha,
               strftime(l_shipdate, '%Y-%m-%d') AS DT_INTER, CAST(l_partkey AS VARCHAR) AS DT_SAIDA,
               CASE WHEN l_orderkey % 11 <> 0 THEN CAST(l_quantity AS BIGINT) END AS DIAS_PERM,
               CAST(l_quantity AS BIGINT) AS IDADE, l_extendedprice AS VAL_TOT
        FROM lineitem""",
    "parse_mixed_date": """
        SELECT N_AIH, DT_INTER, CAST(internacao AS VARCHAR) AS internacao, CAST(saida AS VARCHAR) AS saida
        FROM adm_dated""",
    "quality_filter": """
        SELECT N_AIH, DIAS_PERM, VAL_TOT, CAST(internacao AS VARCHAR) AS DT_INTER FROM adm_dated
        WHERE DIAS_PERM >= 0 AND VAL_TOT >= 0 AND internacao IS NOT NULL""",
    "quality_rejects": """
        SELECT N_AIH, DIAS_PERM, VAL_TOT,
               concat_ws('+', CASE WHEN DIAS_PERM < 0 THEN 'permanencia' END, CASE WHEN VAL_TOT < 0 THEN 'valor' END,
                         CASE WHEN internacao IS NULL THEN 'data_internacao' END) AS motivos
        FROM adm_dated WHERE DIAS_PERM < 0 OR VAL_TOT < 0 OR internacao IS NULL""",
    "filter_prefix": """
        SELECT p_partkey, p_type FROM part WHERE starts_with(p_type, 'PRO') OR starts_with(p_type, 'ST')""",
    "registry_validate": "SELECT codigo_cnes, nome_fantasia FROM reg WHERE codigo_uf = 35",
    "registry_counts": """
        SELECT count(*) FILTER (WHERE codigo_uf = 35) AS aceitos, count(*) FILTER (WHERE codigo_uf <> 35) AS rejeitados
        FROM reg""",
    "registry_sample": """
        SELECT codigo_cnes, nome_fantasia FROM reg WHERE codigo_uf = 35 ORDER BY codigo_cnes, nome_fantasia LIMIT 5""",
    "geo_points": """
        SELECT cnes_id, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude FROM dim
        WHERE latitude IS NOT NULL AND longitude IS NOT NULL""",
    "audit_geo": "SELECT cnes_id, nome_estabelecimento FROM dim WHERE latitude IS NULL",
    "dedup_admissions": "SELECT * EXCLUDE (internacao, saida) FROM adm_first",
    "latest_version": "SELECT codigo_cnes, nome_fantasia, codigo_tipo_unidade, data_atualizacao FROM reg_latest",
    "join_left": "SELECT * FROM fato LEFT JOIN (SELECT cnes_id, uf FROM dim) USING (cnes_id)",
    "join_inner": "SELECT * FROM fato JOIN (SELECT cnes_id, nome_estabelecimento FROM dim) USING (cnes_id)",
    "join_disjunctive": "SELECT cnes_id, codigo_municipio, nome_municipio, regiao_saude, populacao FROM placed",
    "coverage_anti": "SELECT DISTINCT cnes_id FROM fato WHERE cnes_id NOT IN (SELECT cnes_id FROM dim)",
    "coverage_semi": "SELECT codigo_cnes, nome_fantasia FROM reg WHERE codigo_cnes IN (SELECT cnes_id FROM fato)",
    "coverage_inferred": """
        SELECT cnes_id, nome_estabelecimento, uf, FALSE AS is_inferred FROM dim
        UNION ALL
        SELECT DISTINCT cnes_id, NULL, NULL, TRUE FROM fato WHERE cnes_id NOT IN (SELECT cnes_id FROM dim)""",
    "population_fill": "SELECT * FROM filled",
    "population_summary": """
        SELECT count(*) FILTER (WHERE NOT is_estimated) AS reais, count(*) FILTER (WHERE is_estimated) AS estimados
        FROM filled""",
    "geo_fill": """
        SELECT cnes_id,
               round(coalesce(latitude, -10 - n_nationkey / 4.0::DOUBLE), 6) AS latitude,
               round(coalesce(longitude, -50 - n_nationkey / 8.0::DOUBLE), 6) AS longitude,
               latitude IS NULL AND n_nationkey IS NOT NULL AS is_coord_estimated
        FROM dim LEFT JOIN nation ON (350000 + n_nationkey) * 10 + 5 = codigo_municipio
                                  OR 350000 + n_nationkey = codigo_municipio""",
    "geo_fill_repeats": """
        SELECT cnes_id,
               round(coalesce(latitude, -11 - n_nationkey / 4.0::DOUBLE), 6) AS latitude,
               round(coalesce(longitude, -51 - n_nationkey / 8.0::DOUBLE), 6) AS longitude,
               latitude IS NULL AND n_nationkey IS NOT NULL AS is_coord_estimated
        FROM dim LEFT JOIN nation ON codigo_municipio IN (3500005 + n_nationkey * 10, 350000 + n_nationkey)""",
    "union_by_name": """
        SELECT c_custkey AS chave, c_mktsegment AS segmento, NULL AS nome FROM customer
        UNION ALL SELECT s_suppkey, NULL, s_name FROM supplier""",
    "month_spine": "SELECT * FROM spine",
    "month_coverage": f"""
        SELECT * FROM spine
        WHERE ano_mes NOT IN (SELECT CAST(ano * 100 + mes AS VARCHAR) FROM sil WHERE {_SLICE})""",
    "ingest_report": "SELECT * FROM landing_report",
    "ingest_summary": """
        SELECT count(*) AS meses, CAST(sum(vistas) AS BIGINT) AS vistas, CAST(sum(gravadas) AS BIGINT) AS gravadas,
               count(*) FILTER (WHERE vazio) AS meses_vazios
        FROM landing_report""",
    "silver_admissions": """
        SELECT * REPLACE (CAST(DT_INTER AS VARCHAR) AS DT_INTER, CAST(DT_SAIDA AS VARCHAR) AS DT_SAIDA) FROM sil""",
    "silver_registry": """
        SELECT * REPLACE (round(latitude, 6) AS latitude, round(longitude, 6) AS longitude) FROM dim""",
    "weekly_cases": "SELECT * FROM cases",
    "weekly_lag": "SELECT * FROM lagged",
    "disease_trend": "SELECT * REPLACE (round(variacao_pct, 6) AS variacao_pct) FROM trend",
    "view_trend": "SELECT * REPLACE (round(variacao_media_pct, 6) AS variacao_media_pct) FROM trend_month",
    "pressure_features": f"SELECT {_FEATURES} FROM feats",
    "standardize": f"""
        SELECT {_FEATURES}, {_scaled('qtd_internacoes')}, {_scaled('permanencia_media')},
               {_scaled('pacientes_criticos')}
        FROM feats""",
    "pressure_index": f"SELECT {_FEATURES}, indice_pressao FROM indexed",
    "pressure_index_period": f"""
        SELECT {_FEATURES},
               round_even((qtd_internacoes / max(qtd_internacoes) OVER w * 50
                           + coalesce(permanencia_media / nullif(max(permanencia_media) OVER w, 0), 0) * 30
                           + coalesce(pacientes_criticos / nullif(max(pacientes_criticos) OVER w, 0), 0) * 20)
                          * 10, 0) / 10 AS indice_pressao
        FROM feats WINDOW w AS (PARTITION BY ano, mes)""",
    "pressure_index_occ": "SELECT * FROM occ_index",
    "pressure_clusters": f"SELECT {_FEATURES}, TRUE AS mais_proximo FROM feats",
    "pressure_levels": f"SELECT {_FEATURES}, indice_pressao, TRUE AS em_ordem FROM indexed",
    "pressure_levels_occ": "SELECT *, TRUE AS em_ordem FROM occ_index",
    "label_clusters": """
        SELECT cnes_id, ano, mes, CAST(cnes_id % 3 AS INTEGER) AS cluster,
               CASE cnes_id % 3 WHEN 2 THEN 'Baixo risco' WHEN 1 THEN 'Atenção' ELSE 'Crítico' END AS nivel_risco
        FROM feats""",
    "label_ties": """
        SELECT cnes_id, ano, mes, CAST(cnes_id % 6 AS INTEGER) AS cluster,
               CASE cnes_id % 6 WHEN 0 THEN 'Baixo risco' WHEN 1 THEN 'Atenção' WHEN 2 THEN 'Crítico'
                                ELSE 'Sobrecarga iminente' END AS nivel_risco
        FROM feats""",
    "view_overview": """
        SELECT * REPLACE (round(valor_total_pago, 6) AS valor_total_pago,
                          round(permanencia_media, 6) AS permanencia_media,
                          round(indice_pressao_medio, 6) AS indice_pressao_medio)
        FROM overview""",
    "view_pressure_region": """
        SELECT * REPLACE (round(latitude, 6) AS latitude, round(longitude, 6) AS longitude,
                          round(indice_pressao_medio, 6) AS indice_pressao_medio,
                          round(internacoes_por_1000hab, 6) AS internacoes_por_1000hab,
                          round(admissoes_por_1000hab, 6) AS admissoes_por_1000hab)
        FROM region_pressure""",
    "view_ranking": "SELECT * REPLACE (round(permanencia_media, 6) AS permanencia_media) FROM alerts",
    "dash_overview": """
        SELECT * REPLACE (round(valor_total_pago, 6) AS valor_total_pago,
                          round(permanencia_media, 6) AS permanencia_media)
        FROM case_overview""",
    "dash_trend": f"""
        SELECT * REPLACE (round(variacao_media_pct, 6) AS variacao_media_pct) FROM trend_month WHERE {_SLICE}""",
    "dash_case_map": """
        SELECT uf, nome_municipio, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude, regiao_saude,
               count(*) AS qtd_casos,
               round(CAST(count(*) AS DOUBLE) / nullif(populacao, 0) * 1000, 6) AS casos_por_1000hab
        FROM case_rows GROUP BY uf, nome_municipio, case_rows.latitude, case_rows.longitude, regiao_saude, populacao""",
    "dash_rank_cases": "SELECT * REPLACE (round(permanencia_media, 6) AS permanencia_media) FROM case_names",
    "dash_pressure_map": f"""
        SELECT * REPLACE (round(latitude, 6) AS latitude, round(longitude, 6) AS longitude,
                          round(indice_pressao_medio, 6) AS indice_pressao_medio,
                          round(internacoes_por_1000hab, 6) AS internacoes_por_1000hab,
                          round(admissoes_por_1000hab, 6) AS admissoes_por_1000hab)
        FROM region_pressure WHERE uf = '{A.CASES.state}'""",
    "dash_pressure_rank": "SELECT * REPLACE (round(permanencia_media, 6) AS permanencia_media) FROM alerts_state",
    "trend_timeline": f"""
        SELECT CAST(make_date(ano, mes, 1) AS VARCHAR) AS periodo, cid_principal, qtd_casos_mes,
               round(variacao_media_pct, 6) AS variacao_media_pct
        FROM trend_month WHERE {_SLICE}""",
    "rank_cases": """
        SELECT ranking_criticidade AS "#", nome_estabelecimento AS "Hospital", nome_municipio AS "Município",
               qtd_casos AS "Casos", round(permanencia_media, 6) AS "Permanência média (dias)"
        FROM case_names""",
    "kpi_headline": """
        SELECT CAST(sum(qtd_internacoes) AS BIGINT) AS total_internacoes,
               round(CAST(sum(CAST(valor_total_pago AS DECIMAL(38, 6))) AS DOUBLE), 6) AS valor_total,
               round(avg(permanencia_media), 6) AS permanencia_media,
               count(DISTINCT nome_municipio) AS municipios_afetados
        FROM overview""",
    "kpi_display": """
        SELECT replace(format('{:,d}', CAST(sum(qtd_internacoes) AS BIGINT)), ',', '.') AS internacoes,
               replace(printf('%.1f', avg(permanencia_media)), '.', ',') AS permanencia,
               'R$ ' || replace(format('{:,d}', CAST(round_even(sum(CAST(valor_total_pago AS DECIMAL(38, 6))), 0) AS BIGINT)), ',', '.')
                   AS valor,
               count(DISTINCT nome_municipio) AS municipios_afetados
        FROM overview""",
    "kpi_pressure_display": """
        SELECT printf('%.1f', avg(indice_pressao)) || ' / 100' AS indice,
               count(*) FILTER (WHERE nivel_risco = 'Sobrecarga iminente') AS em_sobrecarga,
               count(DISTINCT nome_estabelecimento) AS hospitais_monitorados
        FROM alerts_state""",
    "trend_table": f"""
        SELECT dense_rank() OVER (ORDER BY make_date(ano, mes, 1) DESC) AS lugar,
               CAST(make_date(ano, mes, 1) AS VARCHAR) AS periodo, cid_principal, qtd_casos_mes,
               round(variacao_media_pct, 6) AS variacao_media_pct
        FROM trend_month WHERE {_SLICE}""",
    "top_municipalities": """
        SELECT nome_municipio, CAST(sum(qtd_internacoes) AS BIGINT) AS qtd_internacoes FROM overview
        WHERE nome_municipio IS NOT NULL GROUP BY ALL ORDER BY qtd_internacoes DESC, nome_municipio LIMIT 15""",
    "cases_by_year": """
        SELECT ano, CAST(sum(qtd_internacoes) AS BIGINT) AS qtd_internacoes FROM case_overview GROUP BY ano""",
    "kpi_pressure": """
        SELECT round(avg(indice_pressao), 6) AS indice_pressao_medio,
               count(*) FILTER (WHERE nivel_risco = 'Sobrecarga iminente') AS em_sobrecarga,
               count(DISTINCT nome_estabelecimento) AS hospitais_monitorados
        FROM alerts_state""",
    "risk_distribution": """
        SELECT nivel_risco, count(*) AS qtd_hospitais FROM alerts_state WHERE nivel_risco IS NOT NULL GROUP BY ALL""",
    "top_ranked": """
        SELECT l_partkey, count(*) AS vezes, rank() OVER (ORDER BY count(*) DESC) AS posicao
        FROM lineitem GROUP BY l_partkey ORDER BY vezes DESC, l_partkey LIMIT 20""",
    "rank_by_value": """
        SELECT o_orderkey, o_orderpriority, o_totalprice,
               rank() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC) AS posicao
        FROM orders""",
}


def _needed(text: str, found: set[str]) -> set[str]:
    for name in CTES:
        if name not in found and re.search(rf"\b{name}\b", text):
            found.add(name)
            _needed(CTES[name], found)
    return found


def with_tables(select: str) -> str:
    """The statement with the common table expressions it needs in front."""
    needed = _needed(select, set())
    ctes = ", ".join(f"{name} AS ({CTES[name]})" for name in CTES if name in needed)
    return f"WITH {ctes} {select}" if ctes else select


def oracle_sql() -> dict[str, str]:
    return {name: with_tables(select) for name, select in SELECTS.items()}
