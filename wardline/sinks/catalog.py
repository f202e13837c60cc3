"""External tables over the Gold files, and the business views over the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from wardline import schemas, vocabulary as V
from wardline.plans import views

# Table names, column order and partition columns the queries rely on.
GOLD_TABLES = {
    "fato_internacoes": (schemas.FACT, ("ano", "mes")),
    "dim_hospital": (schemas.DIM_HOSPITAL, ()),
    "dim_tempo": (schemas.DIM_TIME, ()),
    "kpi_pressao_hospitalar": (schemas.PRESSURE, ()),
    "kpi_tendencia_doencas": (schemas.DISEASE_TREND, ()),
}
MUNICIPALITY_TABLE = "municipios_referencia"


def _columns(schema: T.StructType) -> str:
    return ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema.fields)


def register_tables(spark: SparkSession, gold_root: str, municipalities_path: str, database: str = "gold") -> None:
    """Create the database and its six external tables, replacing earlier definitions (never files)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name, (schema, partitions) in GOLD_TABLES.items():
        layout = f"PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")
        spark.sql(f"CREATE TABLE `{database}`.`{name}` ({_columns(schema)}) USING parquet {layout} "
                  f"LOCATION '{gold_root}/{name}'")
        if partitions:
            spark.catalog.recoverPartitions(f"{database}.{name}")
    spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{MUNICIPALITY_TABLE}`")
    spark.sql(f"CREATE TABLE `{database}`.`{MUNICIPALITY_TABLE}` ({_columns(schemas.MUNICIPALITIES)}) "
              f"USING csv OPTIONS (header 'true', escape '\"') LOCATION '{municipalities_path}'")


def publish(spark: SparkSession, gold_root: str, municipalities_path: str, database: str = "gold",
            months: list[tuple[int, int]] | None = None) -> None:
    """Point the tables of `database` at a finished run under `gold_root`; no file is touched.

    Everything is written before this is called, so a run that ends earlier
    leaves the tables as they were. Only entries of the catalog change: the
    location of each small table, and of the months of the fact that the run
    wrote. Given `months`, the run wrote those only: the other months stay where
    they are, and those of them without rows now are dropped. A table that does
    not exist yet, or has other columns, is created.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name, (schema, partitions) in GOLD_TABLES.items():
        full, place = f"`{database}`.`{name}`", f"{gold_root}/{name}"
        declared = [(field.name, field.dataType.simpleString()) for field in schema.fields]
        if spark.catalog.tableExists(f"{database}.{name}") and spark.table(full).dtypes != declared:
            spark.sql(f"DROP TABLE {full}")
        layout = f"PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {full} ({_columns(schema)}) USING parquet {layout} LOCATION '{place}'")
        if not partitions:
            spark.sql(f"ALTER TABLE {full} SET LOCATION '{place}'")
            spark.catalog.refreshTable(f"{database}.{name}")
            continue
        # as many rows as there are months
        weeks = spark.read.schema(GOLD_TABLES["dim_tempo"][0]).parquet(f"{gold_root}/dim_tempo")
        present = {(row.ano, row.mes) for row in weeks.select("ano", "mes").distinct().collect()}
        known = {tuple(int(value.split("=")[1]) for value in row.partition.split("/"))
                 for row in spark.sql(f"SHOW PARTITIONS {full}").collect()}
        written = present if months is None else present & set(months)
        gone = known - present if months is None else (known & set(months)) - present
        entry = lambda year, month: f"PARTITION (ano = {year}, mes = {month})"
        at = lambda year, month: f"LOCATION '{place}/ano={year}/mes={month}'"
        for month in sorted(written & known):
            spark.sql(f"ALTER TABLE {full} {entry(*month)} SET {at(*month)}")
        if written - known:
            spark.sql(f"ALTER TABLE {full} ADD IF NOT EXISTS " + " ".join(f"{entry(*m)} {at(*m)}" for m in sorted(written - known)))
        if gone:
            spark.sql(f"ALTER TABLE {full} DROP IF EXISTS " + ", ".join(entry(*m) for m in sorted(gone)))
        spark.catalog.refreshTable(f"{database}.{name}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{database}`.`{MUNICIPALITY_TABLE}` ({_columns(schemas.MUNICIPALITIES)}) "
              f"USING csv OPTIONS (header 'true', escape '\"') LOCATION '{municipalities_path}'")
    spark.sql(f"ALTER TABLE `{database}`.`{MUNICIPALITY_TABLE}` SET LOCATION '{municipalities_path}'")
    spark.catalog.refreshTable(f"{database}.{MUNICIPALITY_TABLE}")


# The views as the catalog keeps them. Like their DataFrame forms they first combine the fact to a row per facility and
# month, and join facilities and municipalities to that.
_MONTHS = """
    SELECT cnes_id, ano, mes, count(*) AS n, sum(dias_permanencia) AS days, count(dias_permanencia) AS stays,
           sum(CASE WHEN whole THEN CAST(rint(valor_total * 100) AS DECIMAL(28, 0)) END) AS cents,
           sum(CASE WHEN NOT whole THEN valor_total END) AS odd
    FROM (SELECT *, rint(valor_total * 100) / 100 = valor_total AND abs(valor_total) < 1e25 AS whole
          FROM {db}.fato_internacoes)
    GROUP BY cnes_id, ano, mes"""
_SPELLINGS = """
    SELECT explode(array_distinct(array(codigo_municipio, codigo_municipio div 10))) AS code, nome_municipio, regiao_saude,
           populacao
    FROM {db}.municipios_referencia"""
_MONEY = "CASE WHEN sum(odd) IS NULL THEN CAST(sum(cents) AS DOUBLE) / 100 ELSE coalesce(CAST(sum(cents) AS DOUBLE) / 100, 0) + sum(odd) END"
_INDEX = "try_divide(sum(indice_pressao * n), sum(CASE WHEN indice_pressao IS NOT NULL THEN n END))"

# View names and columns the reports ask for.
VIEW_SQL = {
    "vw_acompanhamento_geral": f"""
        WITH months AS ({_MONTHS}), spots AS ({_SPELLINGS}),
        indices AS (SELECT cnes_id, ano, mes, indice_pressao, nivel_risco FROM {{db}}.kpi_pressao_hospitalar)
        SELECT ano, mes, uf, nome_municipio, sum(n) AS qtd_internacoes, {_MONEY} AS valor_total_pago,
               try_divide(CAST(sum(days) AS DOUBLE), sum(stays)) AS permanencia_media, {_INDEX} AS indice_pressao_medio,
               max(nivel_risco) AS nivel_risco_predominante
        FROM months LEFT JOIN indices USING (cnes_id, ano, mes) JOIN {{db}}.dim_hospital USING (cnes_id)
        LEFT JOIN spots ON code = CAST(codigo_municipio AS BIGINT)
        GROUP BY ano, mes, uf, nome_municipio""",
    "vw_tendencia_doencas": """
        SELECT uf, cid_principal, ano, mes, sum(qtd_casos) AS qtd_casos_mes, avg(variacao_pct) AS variacao_media_pct
        FROM {db}.kpi_tendencia_doencas GROUP BY uf, cid_principal, ano, mes""",
    "vw_pressao_por_regiao": f"""
        WITH months AS ({_MONTHS}), spots AS ({_SPELLINGS}),
        indices AS (SELECT cnes_id, ano, mes, indice_pressao, nivel_risco FROM {{db}}.kpi_pressao_hospitalar),
        regions AS (
            SELECT uf, nome_municipio, latitude, longitude, regiao_saude, nullif(populacao, 0) AS people, {_INDEX} AS mean_index,
                   min(nivel_risco) AS least_level, CAST(sum(days) AS DOUBLE) AS all_days
            FROM months JOIN indices USING (cnes_id, ano, mes) JOIN {{db}}.dim_hospital USING (cnes_id)
            LEFT JOIN spots ON code = CAST(codigo_municipio AS BIGINT)
            GROUP BY uf, nome_municipio, latitude, longitude, regiao_saude, populacao)
        SELECT uf, nome_municipio, latitude, longitude, regiao_saude, mean_index AS indice_pressao_medio,
               least_level AS nivel_risco_regiao, try_divide(all_days, people) * 1000 AS internacoes_por_1000hab
        FROM regions""",
    "vw_ranking_hospitais_criticos": f"""
        WITH spots AS ({_SPELLINGS})
        SELECT nome_estabelecimento, uf, nome_municipio, ano, mes, indice_pressao, nivel_risco, qtd_internacoes,
               permanencia_media, CAST(rank() OVER (PARTITION BY ano, mes ORDER BY indice_pressao DESC NULLS LAST) AS BIGINT)
                   AS ranking_criticidade
        FROM {{db}}.kpi_pressao_hospitalar JOIN {{db}}.dim_hospital USING (cnes_id)
        LEFT JOIN spots ON code = CAST(codigo_municipio AS BIGINT)
        WHERE nivel_risco IN ({", ".join(f"'{level}'" for level in V.ALERT_LEVELS)})""",
}


def register_views(spark: SparkSession, database: str = "gold") -> dict[str, DataFrame]:
    """The four business views over the tables of `database`, under their report names.

    They are created in the database, where any session finds them, and as
    views of this session under the bare names, from their DataFrame forms;
    those are returned.
    """
    for name, text in VIEW_SQL.items():
        spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{name}` AS {text.format(db=f'`{database}`')}")
    fact, dim, pressure, trend, municipalities = (
        spark.table(f"{database}.{name}") for name in
        ("fato_internacoes", "dim_hospital", "kpi_pressao_hospitalar", "kpi_tendencia_doencas", MUNICIPALITY_TABLE)
    )
    registered = {
        "vw_acompanhamento_geral": views.overview(fact, dim, municipalities, pressure),
        "vw_tendencia_doencas": views.monthly_trend(trend),
        "vw_pressao_por_regiao": views.pressure_by_region(fact, dim, municipalities, pressure),
        "vw_ranking_hospitais_criticos": views.critical_ranking(dim, municipalities, pressure),
    }
    for name, view in registered.items():
        view.createOrReplaceTempView(name)
    return registered
