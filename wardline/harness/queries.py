"""Every operator as a named query over the test tables: `name -> (session, folder) -> DataFrame`.

A result that could not be compared across engines as it is, is put in a
comparable form at the end only: `comparable` rounds doubles and spells dates.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from wardline import schemas, vocabulary as V
from wardline.functions import codes, dates, numbers
from wardline.harness import adapter as A
from wardline.operators import dedup, joins, months, projections, quality, ranking, statistics
from wardline.plans import full_run as runs, gold, landing, months as by_month, pressure, reports, silver, trends, views
from wardline.session import fresh_path
from wardline.sinks import writers
from wardline.sinks.catalog import GOLD_TABLES, MUNICIPALITY_TABLE
from wardline.sources import harmonize as H, partitioned, payloads, tables

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

#: How much farther than the nearest mean a row's own may lie, squared, when K-Means stops moving its centres.
NEAR = 0.05


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def comparable(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, dates as text; other columns as they are."""
    columns = []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DoubleType):
            value = F.round(value, digits)
        elif isinstance(field.dataType, T.DateType):
            value = value.cast("string")
        columns.append(value.alias(field.name))
    return df.select(*columns)


# Sources ------------------------------------------------------------------------------------------


def _landed(spark: SparkSession, sf: str) -> str:
    root = fresh_path(spark, "landed")
    A.write_drifting(spark, sf, root)
    return root


@query
def src_partitions(spark, sf):
    return partitioned.discover_partitions(spark, _landed(spark, sf)).select("uf", "ano_mes")


@query
def src_drift_scan(spark, sf):
    return partitioned.read_drifting_parquet(spark, _landed(spark, sf), schemas.ADMISSIONS)


@query
def src_harmonize(spark, sf):
    lines = A.table(spark, sf, "lineitem")
    drifted = lines.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("n_aih"),
        F.when(F.col("l_orderkey") % 11 == 0, "x").otherwise(F.col("l_quantity").cast("string")).alias("DIAS_PERM"),
        F.col("l_extendedprice").cast("string").alias("VAL_TOT"),
        F.col("l_partkey").cast("int").alias("IDADE"),
        F.col("l_returnflag").alias("SEXO"),
        F.col("l_tax").alias("not_in_the_schema"),
    )
    return comparable(H.harmonize(drifted, schemas.ADMISSIONS))


@query
def src_json(spark, sf):
    root = fresh_path(spark, "registry")
    raw = A.registry(spark, sf).withColumns({"codigo_uf": F.col("codigo_uf").cast("string"), "uf": F.lit("SP")})
    writers.land_registry(raw, root)
    return comparable(tables.read_registry(spark, root))


@query
def src_parquet(spark, sf):
    lines = tables.read_table(spark, f"{sf}/lineitem.parquet")
    return comparable(lines.withColumn("l_shipdate", F.col("l_shipdate").cast("date")))


@query
def src_csv(spark, sf):
    path = fresh_path(spark, "municipalities")
    quoted = A.municipalities(spark, sf).withColumn("regiao_saude", F.concat("regiao_saude", F.lit(', "norte"')))
    writers.write_csv(quoted, path)
    return comparable(tables.read_municipalities(spark, path))


@query
def src_codes(spark, sf):
    path = fresh_path(spark, "codes")
    codes_ = A.table(spark, sf, "lineitem").select(
        F.when(F.col("l_orderkey") % 7 != 0, F.col("l_suppkey").cast("string")).alias("cnes_id"), "l_returnflag")
    writers.write_csv(codes_, path)
    return tables.read_code_list(spark, path)


@query
def src_coords(spark, sf):
    path = fresh_path(spark, "coordinates")
    writers.write_csv(A.coordinates(spark, sf), path)
    return comparable(tables.read_coordinates(spark, path))


@query
def src_features(spark, sf):
    path = fresh_path(spark, "features")
    writers.write_csv(A.occupancy_features(spark, sf), path)
    return comparable(tables.read_features(spark, path))


def _registry_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Every event as an API answer, in six kinds of envelope."""
    key = F.get_json_object("props", "$.k")

    def record(code):
        return F.concat(F.lit('{"codigo_cnes": '), code.cast("string"), F.lit(', "codigo_uf": "'), key,
                        F.lit('", "nome_fantasia": "U'), F.col("user_id").cast("string"),
                        F.lit('", "latitude_estabelecimento_decimo_grau": -23.5, "outro": [1, {"a": 2}]}'))

    one, two = record(F.col("event_id")), record(F.col("event_id") + 1000000)
    kind = F.col("event_id") % 6
    return A.table(spark, sf, "events").select(
        F.when(kind == 0, F.concat(F.lit('{"estabelecimentos": ['), one, F.lit(","), two, F.lit("]}")))
        .when(kind == 1, F.concat(F.lit('{"data": ['), one, F.lit("]}")))
        .when(kind == 2, F.concat(F.lit("["), one, F.lit(", "), two, F.lit("]")))
        .when(kind == 3, one)
        .when(kind == 4, F.concat(F.lit('{"estabelecimentos": [], "data": ['), one, F.lit("]}")))
        .otherwise(F.lit("[]")).alias("payload"))


@query
def json_envelope(spark, sf):
    return comparable(payloads.unwrap_registry_payload(_registry_documents(spark, sf)))


@query
def json_lookup(spark, sf):
    return comparable(payloads.unwrap_registry_payload(_registry_documents(spark, sf), single=True))


def _population_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Every event as a statistics answer; some hold no usable number."""
    key = F.get_json_object("props", "$.k").cast("int") + 350000
    value = F.when(F.col("event_id") % 5 == 0, "-").otherwise(F.col("event_id").cast("string"))
    series = (F.when(F.col("event_id") % 7 == 0, "{}")
              .otherwise(F.concat(F.lit('{"2022": "7", "2024": "'), value, F.lit('"}'))))
    return A.table(spark, sf, "events").select("event_id", F.concat(
        F.lit('[{"resultados": [{"series": [{"localidade": {"id": "'), key.cast("string"),
        F.lit('"}, "serie": '), series, F.lit("}]}]}]")).alias("payload"))


def _locality_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Every customer as a locality answer, in five kinds of nesting."""
    kind = F.col("c_custkey") % 5
    segment = F.concat(F.lit('{"nome": "'), F.col("c_mktsegment"), F.lit('"}'))
    levels = (
        F.when(kind == 0, F.concat(F.lit(', "microrregiao": {"mesorregiao": '), segment, F.lit("}")))
        .when(kind == 1, F.concat(F.lit(', "regiao-imediata": '), segment))
        .when(kind == 2, F.concat(F.lit(', "microrregiao": {"mesorregiao": {"nome": ""}}, "regiao-imediata": '),
                                  segment))
        .when(kind == 3, F.concat(F.lit(', "microrregiao": null, "regiao-imediata": '), segment))
        .otherwise(""))
    return A.table(spark, sf, "customer").select(F.concat(
        F.lit('[{"id": '), F.col("c_custkey").cast("string"), F.lit(', "nome": "'), F.col("c_name"), F.lit('"'),
        levels, F.lit("}]")).alias("payload"))


@query
def json_population(spark, sf):
    return payloads.flatten_population(_population_documents(spark, sf), order="event_id")


@query
def json_municipality(spark, sf):
    return payloads.flatten_municipalities(_locality_documents(spark, sf), "SP")


# Landing ------------------------------------------------------------------------------------------


@query
def land_admissions(spark, sf):
    """All lines landed as one month of one state, with lower-case names and one diagnosis prefix; read back."""
    root = fresh_path(spark, "landed-month")
    raw = A.dropped_admissions(spark, sf).drop("uf", "ano_mes", "PROC_REA")
    landing.land_admissions(raw.toDF(*[name.lower() for name in raw.columns]), root, "SP", 2023, 1, ["promo"])
    return comparable(partitioned.read_drifting_parquet(spark, root, schemas.ADMISSIONS,
                                                        schemas.ADMISSION_PARTITIONS, ("uf", "ano_mes")))


@query
def land_municipalities(spark, sf):
    """Customers as localities; those with a population event get its value, the others an estimate."""
    places = _locality_documents(spark, sf)
    statistics_ = _population_documents(spark, sf).withColumn(
        "payload", F.replace("payload", F.lit('{"id": "350'), F.lit('{"id": "')))
    return landing.municipality_reference(places, statistics_, "SP", 5000, order="event_id")


@query
def land_registry_codes(spark, sf):
    """Lookups of every event: the records found in one state, and the codes left over."""
    wanted = A.table(spark, sf, "events").select(F.col("event_id").alias("codigo_cnes"))
    found, missing = landing.registry_of_codes(_registry_documents(spark, sf), wanted, "SP")
    return found.select("codigo_cnes", F.lit(True).alias("encontrado")).unionByName(
        missing.select("codigo_cnes", F.lit(False).alias("encontrado")))


# Sinks --------------------------------------------------------------------------------------------


@query
def sink_roundtrip(spark, sf):
    """Co-located, plain partitioned and unpartitioned writes, each read back."""
    rows = A.admissions(spark, sf).withColumn("uf", F.coalesce("uf", F.lit("--")))
    read = []
    for name in ("colocated", "partitioned", "plain"):
        path = fresh_path(spark, name)
        if name == "plain":
            writers.write_table(rows, path)
        else:
            writers.write_partitioned(rows, path, ["uf"], colocate=name == "colocated")
        read.append(tables.read_table(spark, path, rows.schema).select(F.lit(name).alias("escrita"), "*"))
    return comparable(partitioned.union_all(read))


@query
def sink_dynamic(spark, sf):
    """All months landed, one year landed again with other values, then nothing landed."""
    root = fresh_path(spark, "months")
    rows = A.dropped_admissions(spark, sf).select("N_AIH", "VAL_TOT", "DIAS_PERM", "uf", "ano_mes")
    writers.land_month(rows, root)
    again = rows.filter(F.col("ano_mes").startswith("1997") & (F.col("uf") == "SP"))
    writers.land_month(again.withColumn("DIAS_PERM", F.col("DIAS_PERM") + 1000), root)
    writers.land_month(rows.limit(0), root)
    return comparable(tables.read_table(spark, root, rows.schema))


@query
def sink_json(spark, sf):
    """Two runs of the registry appended under their states."""
    root = fresh_path(spark, "registry-runs")
    raw = A.registry(spark, sf).select("*", F.coalesce(codes.state_abbrev("codigo_uf"), F.lit("--")).alias("uf"))
    for _ in range(2):
        writers.land_registry(raw, root)
    return comparable(tables.read_registry(spark, root))


@query
def sink_csv(spark, sf):
    path = fresh_path(spark, "index")
    index = pressure.pressure_index_occupancy(A.occupancy_features(spark, sf))
    writers.write_csv(index, path)
    back = H.harmonize(tables.read_csv(spark, path), index.schema)
    return comparable(back)


#: The months that come later in runs by month.
LATER = [f"1997{month:02d}" for month in range(1, 13)]


def _lake(spark: SparkSession, sf: str, which: Column | None = None) -> runs.Paths:
    base = fresh_path(spark, "run")
    paths = runs.Paths(f"{base}/admissions", f"{base}/registry", f"{base}/municipalities",
                       f"{base}/silver", f"{base}/gold")
    A.write_drifting(spark, sf, paths.admissions, which)
    raw = A.registry(spark, sf).select("*", F.coalesce(codes.state_abbrev("codigo_uf"), F.lit("--")).alias("uf"))
    writers.land_registry(raw, paths.registry)
    writers.write_csv(A.municipalities(spark, sf), paths.municipalities)
    return paths


def _run(spark: SparkSession, sf: str, database: str) -> dict[str, DataFrame]:
    return runs.full_run(spark, _lake(spark, sf), database)


@query
def silver_by_month(spark, sf):
    """Silver built without one year, which is landed and taken in afterwards; as if all had been there."""
    later = F.col("ano_mes").isin(LATER)
    paths = _lake(spark, sf, ~later)
    runs.build_silver(spark, paths)
    by_month.build_index(spark, paths.admissions, paths.silver)
    A.write_drifting(spark, sf, paths.admissions, later)
    by_month.update_silver(spark, paths.admissions, paths.silver, LATER)
    kept = tables.read_table(spark, f"{paths.silver}/internacoes", schemas.SILVER_ADMISSIONS)
    return comparable(kept.select("N_AIH", "cnes_id", "municipio_id", "cid_principal", "valor_total", "dias_permanencia", "ano", "mes"))


@query
def silver_id_index(spark, sf):
    """The index after the same: of every id, in how many landed months it has copies and where the one that stayed is."""
    later = F.col("ano_mes").isin(LATER)
    paths = _lake(spark, sf, ~later)
    runs.build_silver(spark, paths)
    by_month.build_index(spark, paths.admissions, paths.silver)
    A.write_drifting(spark, sf, paths.admissions, later)
    by_month.update_silver(spark, paths.admissions, paths.silver, LATER)
    index = tables.read_table(spark, f"{paths.silver}/ids", by_month.INDEX)
    return index.select("N_AIH", F.array_join("meses", " ").alias("meses"), "ano", "mes")


@query
def month_run(spark, sf):
    """A whole run without one year, then a run for its months; the overview, as of a run over all."""
    later = F.col("ano_mes").isin(LATER)
    paths = _lake(spark, sf, ~later)
    runs.full_run(spark, paths, "gold_months", keep_index=True)
    A.write_drifting(spark, sf, paths.admissions, later)
    return _overview_rows(runs.month_run(spark, paths, LATER, "gold_months")["vw_acompanhamento_geral"])


@query
def catalog_tables(spark, sf):
    """The rows of every catalog table after a whole run; of the risk levels, whether they rise with the volume."""
    _run(spark, sf, "gold_tables")
    read = []
    for name in (*GOLD_TABLES, MUNICIPALITY_TABLE):
        rows = spark.table(f"gold_tables.{name}")
        if "nivel_risco" in rows.columns:
            rows = _in_order(rows, "qtd_internacoes").drop("cluster")
        read.append(rows.select(F.lit(name).alias("tabela"), "*"))
    return comparable(partitioned.union_all(read))


def _differences(one: DataFrame, other: DataFrame) -> DataFrame:
    """How many rows are in one of two tables and not in the other, doubles rounded."""
    one, other = comparable(one), comparable(other)
    return one.exceptAll(other).unionByName(other.exceptAll(one)).agg(F.count("*").alias("casos"))


@query
def catalog_views(spark, sf):
    """The views of the catalog after a whole run, as another session reads them by name.

    The rows of the overview and the trend; of the two that depend on clusters,
    how many rows differ from the literal SQL over the tables of the catalog.
    """
    _run(spark, sf, "gold_views")
    other = spark.newSession()
    overview = other.table("gold_views.vw_acompanhamento_geral").select(
        F.lit("geral").alias("visao"), "uf", F.col("nome_municipio").alias("chave"), "ano", "mes",
        F.col("qtd_internacoes").alias("casos"), F.col("permanencia_media").alias("media"))
    trend = other.table("gold_views.vw_tendencia_doencas").select(
        F.lit("tendencia").alias("visao"), "uf", F.col("cid_principal").alias("chave"), "ano", "mes",
        F.col("qtd_casos_mes").alias("casos"), F.col("variacao_media_pct").alias("media"))
    place = """LEFT JOIN gold_views.municipios_referencia AS m
               ON h.codigo_municipio = m.codigo_municipio OR h.codigo_municipio = m.codigo_municipio div 10"""
    region = other.sql(f"""
        SELECT h.uf, nome_municipio, latitude, longitude, regiao_saude, avg(indice_pressao) AS indice_pressao_medio,
               min(nivel_risco) AS nivel_risco_regiao, sum(dias_permanencia) / nullif(populacao, 0) * 1000 AS internacoes_por_1000hab
        FROM gold_views.fato_internacoes JOIN gold_views.kpi_pressao_hospitalar USING (cnes_id, ano, mes)
        JOIN gold_views.dim_hospital AS h USING (cnes_id) {place}
        GROUP BY h.uf, nome_municipio, latitude, longitude, regiao_saude, populacao""")
    critical = other.sql(f"""
        SELECT nome_estabelecimento, h.uf, nome_municipio, ano, mes, indice_pressao, nivel_risco, qtd_internacoes, permanencia_media,
               CAST(rank() OVER (PARTITION BY ano, mes ORDER BY indice_pressao DESC NULLS LAST) AS BIGINT) AS ranking_criticidade
        FROM gold_views.kpi_pressao_hospitalar JOIN gold_views.dim_hospital AS h USING (cnes_id) {place}
        WHERE nivel_risco IN ({", ".join(f"'{level}'" for level in V.ALERT_LEVELS)})""")
    compared = [_differences(other.table(f"gold_views.{name}"), literal).select(F.lit(short).alias("visao"), "casos")
                for short, name, literal in (("regiao", "vw_pressao_por_regiao", region),
                                             ("ranking", "vw_ranking_hospitais_criticos", critical))]
    return comparable(partitioned.union_all([overview, trend, *compared]))


@query
def full_run(spark, sf):
    """A whole run from landed files; of the clustered level of the overview, whether there is one where there is an index."""
    return _overview_rows(_run(spark, sf, "gold_run")["vw_acompanhamento_geral"])


def _overview_rows(overview: DataFrame) -> DataFrame:
    level, known = F.col("nivel_risco_predominante"), F.col("indice_pressao_medio").isNotNull()
    valid = F.when(known, F.coalesce(level.isin(*V.RISK_LEVELS), F.lit(False))).otherwise(level.isNull())
    return comparable(overview.withColumn("nivel_valido", valid).drop("nivel_risco_predominante"))


# Projections and derivations ----------------------------------------------------------------------


@query
def proj_dim(spark, sf):
    return comparable(A.dim(spark, sf))


@query
def proj_fact(spark, sf):
    return comparable(A.fact(spark, sf))


@query
def proj_typed_null(spark, sf):
    beds = T.StructType([schemas.SILVER_REGISTRY["leitos_totais"], schemas.SILVER_REGISTRY["leitos_sus"]])
    return projections.with_typed_nulls(A.table(spark, sf, "supplier").select("s_suppkey"), beds)


@query
def map_lookup(spark, sf):
    return A.table(spark, sf, "customer").select("c_custkey", codes.state_abbrev(
        F.when(F.col("c_custkey") % 9 != 0, F.col("c_nationkey") + 11)).alias("uf"))


@query
def flag_isin(spark, sf):
    return A.registry(spark, sf).select("codigo_cnes", "nome_fantasia", codes.is_hospital_type(
        "codigo_tipo_unidade").alias("eh_tipo_hospitalar"))


@query
def calendar(spark, sf):
    days = A.table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("dia"))
    return dates.with_calendar(days, "dia").drop("dia")


@query
def dim_time(spark, sf):
    return gold.dim_time(A.silver_admissions(spark, sf))


@query
def proj_names(spark, sf):
    return H.normalize_names(A.table(spark, sf, "orders"), ["O_ORDERKEY", "O_ORDERSTATUS", "O_NOT_THERE"])


@query
def canonicalize(spark, sf):
    lines = A.table(spark, sf, "lineitem")
    mixed = lines.select(
        F.col("l_orderkey").alias("N_AIH"), F.col("l_linenumber").alias("linha"),
        F.col("l_shipdate").alias("DT_INTER"), F.col("l_partkey").alias("DT_SAIDA"),
        F.when(F.col("l_orderkey") % 11 == 0, "x").otherwise(F.col("l_quantity").cast("string")).alias("DIAS_PERM"),
        F.col("l_quantity").alias("IDADE"), F.col("l_extendedprice").cast("string").alias("VAL_TOT"))
    return comparable(projections.canonicalize(mixed))


@query
def parse_mixed_date(spark, sf):
    return comparable(A.admissions(spark, sf).select(
        "N_AIH", "DT_INTER", dates.parse_mixed_date("DT_INTER").alias("internacao"),
        dates.parse_mixed_date("DT_SAIDA").alias("saida")))


# Rules --------------------------------------------------------------------------------------------


@query
def quality_filter(spark, sf):
    rows = A.admissions(spark, sf).withColumn("DT_INTER", dates.parse_mixed_date("DT_INTER"))
    rules = quality.admission_rules("DIAS_PERM", "VAL_TOT")
    return comparable(quality.apply_rules(rows, rules).select("N_AIH", "DIAS_PERM", "VAL_TOT", "DT_INTER"))


@query
def quality_rejects(spark, sf):
    rows = A.admissions(spark, sf).withColumn("DT_INTER", dates.parse_mixed_date("DT_INTER"))
    _, rejected = quality.split_rules(rows, quality.admission_rules("DIAS_PERM", "VAL_TOT"))
    return comparable(rejected.select("N_AIH", "DIAS_PERM", "VAL_TOT", F.array_join("motivos", "+").alias("motivos")))


@query
def filter_prefix(spark, sf):
    return quality.filter_code_prefix(A.table(spark, sf, "part").select("p_partkey", "p_type"), "p_type",
                                      codes.split_code_list("pro, St"))


@query
def registry_validate(spark, sf):
    valid, _ = quality.validate_state(A.registry(spark, sf), "SP")
    return valid.select("codigo_cnes", "nome_fantasia")


@query
def registry_counts(spark, sf):
    _, counts = quality.validate_state(A.registry(spark, sf), "SP")
    return counts


@query
def registry_sample(spark, sf):
    return quality.sample_valid(A.registry(spark, sf), "SP", 5).select("codigo_cnes", "nome_fantasia")


@query
def geo_points(spark, sf):
    return comparable(quality.with_coordinates(A.dim(spark, sf)).select("cnes_id", "latitude", "longitude"))


@query
def audit_geo(spark, sf):
    return quality.missing_coordinates(A.dim(spark, sf)).select("cnes_id", "nome_estabelecimento")


# Deduplication ------------------------------------------------------------------------------------


@query
def dedup_admissions(spark, sf):
    return comparable(dedup.dedup_any(A.admissions(spark, sf), ["N_AIH"], silver.COPY_ORDER))


@query
def latest_version(spark, sf):
    raw = A.registry(spark, sf).withColumn("data_atualizacao", dates.iso_date("data_atualizacao"))
    return comparable(dedup.latest_by(raw, ["codigo_cnes"], "data_atualizacao").select(
        "codigo_cnes", "nome_fantasia", "codigo_tipo_unidade", "data_atualizacao"))


# Joins --------------------------------------------------------------------------------------------


@query
def join_left(spark, sf):
    return comparable(joins.with_state(A.fact(spark, sf), A.dim(spark, sf)))


@query
def join_inner(spark, sf):
    return comparable(joins.with_facility(A.fact(spark, sf), A.dim(spark, sf), ["nome_estabelecimento"]))


@query
def join_disjunctive(spark, sf):
    return comparable(joins.join_municipality(
        A.dim(spark, sf), A.municipalities(spark, sf), ["nome_municipio", "regiao_saude", "populacao"]).select(
        "cnes_id", "codigo_municipio", "nome_municipio", "regiao_saude", "populacao"))


@query
def coverage_anti(spark, sf):
    return joins.missing_members(A.fact(spark, sf), A.dim(spark, sf))


@query
def coverage_semi(spark, sf):
    used = A.fact(spark, sf).select("cnes_id").distinct()
    return joins.restrict_to_codes(A.registry(spark, sf), used, "codigo_cnes").select("codigo_cnes", "nome_fantasia")


@query
def coverage_inferred(spark, sf):
    dim = A.dim(spark, sf)
    complete = joins.with_inferred_members(dim, joins.missing_members(A.fact(spark, sf), dim))
    return complete.select("cnes_id", "nome_estabelecimento", "uf", "is_inferred")


@query
def population_fill(spark, sf):
    places = A.municipalities(spark, sf)
    known = places.filter(F.col("codigo_municipio") % 3 != 0).select("codigo_municipio", "populacao")
    return joins.fill_population(places, known, 5000).select(
        "codigo_municipio", "nome_municipio", "populacao", "is_estimated")


@query
def population_summary(spark, sf):
    return reports.estimate_summary(population_fill(spark, sf))


@query
def geo_fill(spark, sf):
    return comparable(joins.fill_coordinates(A.dim(spark, sf), A.coordinates(spark, sf)).select(
        "cnes_id", "latitude", "longitude", "is_coord_estimated"))


@query
def geo_fill_repeats(spark, sf):
    """Facilities against a reference that has every code twice, and once more without a latitude."""
    points = A.coordinates(spark, sf)
    shifted = points.withColumns({"latitude": F.col("latitude") - 1, "longitude": F.col("longitude") - 1})
    reference = points.unionByName(shifted).unionByName(points.withColumn("latitude", F.lit(None).cast("double")))
    return comparable(joins.fill_coordinates(A.dim(spark, sf), reference).select(
        "cnes_id", "latitude", "longitude", "is_coord_estimated"))


@query
def union_by_name(spark, sf):
    customers = A.table(spark, sf, "customer").select(F.col("c_custkey").alias("chave"),
                                                      F.col("c_mktsegment").alias("segmento"))
    suppliers = A.table(spark, sf, "supplier").select(F.col("s_name").alias("nome"),
                                                      F.col("s_suppkey").alias("chave"))
    return partitioned.union_all([customers, suppliers])


# Months -------------------------------------------------------------------------------------------


@query
def month_spine(spark, sf):
    return months.spine_of(A.silver_admissions(spark, sf), "DT_INTER")


@query
def month_coverage(spark, sf):
    """Months of the whole span in which the slice has no case."""
    rows = A.silver_admissions(spark, sf)
    landed = A.CASES.of(rows).select(dates.year_month("ano", "mes").alias("ano_mes"))
    return months.missing_months(landed, months.spine_of(rows, "DT_INTER"))


def _ingest(spark: SparkSession, sf: str) -> DataFrame:
    rows = A.silver_admissions(spark, sf)
    keyed = rows.withColumn("ano_mes", dates.year_month("ano", "mes"))
    return reports.ingest_report(keyed, A.CASES.of(keyed), months.spine_of(rows, "DT_INTER"))


@query
def ingest_report(spark, sf):
    return _ingest(spark, sf)


@query
def ingest_summary(spark, sf):
    return reports.ingest_summary(_ingest(spark, sf))


# Silver, trends -----------------------------------------------------------------------------------


@query
def silver_admissions(spark, sf):
    return comparable(A.silver_admissions(spark, sf))


@query
def silver_registry(spark, sf):
    return comparable(A.silver_registry(spark, sf))


@query
def weekly_cases(spark, sf):
    return trends.weekly_cases(A.fact(spark, sf), A.dim(spark, sf))


@query
def weekly_lag(spark, sf):
    return trends.weekly_lag(weekly_cases(spark, sf))


@query
def disease_trend(spark, sf):
    return comparable(A.disease_trend(spark, sf))


@query
def view_trend(spark, sf):
    return comparable(views.monthly_trend(A.disease_trend(spark, sf)))


# Pressure -----------------------------------------------------------------------------------------


@query
def pressure_features(spark, sf):
    return comparable(A.features(spark, sf))


@query
def standardize(spark, sf):
    return comparable(statistics.standardize(A.features(spark, sf), pressure.SIGNALS))


@query
def pressure_index(spark, sf):
    return comparable(pressure.pressure_index(A.features(spark, sf)))


@query
def pressure_index_period(spark, sf):
    return comparable(pressure.pressure_index(A.features(spark, sf), per_period=True))


@query
def pressure_index_occ(spark, sf):
    return comparable(pressure.pressure_index_occupancy(A.occupancy_features(spark, sf)))


def _nearest(clustered: DataFrame, columns: list[str]) -> DataFrame:
    """Whether each row's cluster is the one whose mean lies nearest, up to what K-Means leaves open when it stops."""
    scaled = [f"{c}_z" for c in columns]
    points = statistics.standardize(clustered, columns)
    means = points.groupBy("cluster").agg(F.array(*[F.avg(c) for c in scaled]).alias("at"))
    centres = means.agg(F.collect_list(F.struct("cluster", "at")).alias("all")).scalar()  # one per cluster, k at most

    def distance(centre: Column) -> Column:
        return reduce(lambda a, b: a + b, [F.pow(F.col(c) - centre["at"][i], 2) for i, c in enumerate(scaled)])

    own = F.filter("all", lambda c: c["cluster"] == F.col("cluster"))[0]
    least = F.array_min(F.transform("all", distance))
    return (points.withColumn("all", centres).withColumn("mais_proximo", distance(own) <= least + NEAR)
            .drop("all", "cluster", *scaled))


def _in_order(levelled: DataFrame, by: str) -> DataFrame:
    """Whether the levels of the clusters rise with the clusters' means."""
    means = levelled.groupBy("nivel_risco").agg(F.avg(by).alias("media")).agg(
        F.sort_array(F.collect_list(F.struct("media", "nivel_risco"))).alias("m")).scalar()
    levels = F.array(*[F.lit(level) for level in V.RISK_LEVELS])
    found = F.transform("m", lambda c: F.array_position(levels, c["nivel_risco"]))
    return levelled.withColumn("m", means).withColumn("em_ordem", found == F.array_sort(found)).drop("nivel_risco", "m")


@query
def pressure_clusters(spark, sf):
    return comparable(_nearest(pressure.pressure_clusters(A.features(spark, sf)), pressure.SIGNALS))


@query
def pressure_levels(spark, sf):
    levelled = _in_order(pressure.pressure_levels(A.features(spark, sf)), "qtd_internacoes")
    return comparable(levelled.drop("cluster"))


@query
def pressure_levels_occ(spark, sf):
    levelled = _in_order(pressure.pressure_levels_occupancy(A.occupancy_features(spark, sf)), "taxa_ocupacao_estimada")
    return comparable(levelled.drop("cluster"))


@query
def label_clusters(spark, sf):
    """Levels of clusters that SQL can repeat: three of unlike means, fewer than there are levels."""
    bands = A.features(spark, sf).withColumn("cluster", (F.col("cnes_id") % 3).cast("int"))
    volume = bands.withColumn("volume", F.col("cluster") * -10 + 5)
    return comparable(statistics.label_clusters(volume, "volume").select("cnes_id", "ano", "mes", "cluster", "nivel_risco"))


@query
def label_ties(spark, sf):
    """Six clusters, more than there are levels, in pairs of one mean: the lower number goes first, the last level repeats."""
    groups = A.features(spark, sf).withColumn("cluster", (F.col("cnes_id") % 6).cast("int"))
    volume = groups.withColumn("volume", F.floor(F.col("cluster") / 2))
    return comparable(statistics.label_clusters(volume, "volume").select("cnes_id", "ano", "mes", "cluster", "nivel_risco"))


# Views and reports --------------------------------------------------------------------------------


@query
def view_overview(spark, sf):
    return comparable(A.overview(spark, sf))


@query
def view_pressure_region(spark, sf):
    return comparable(A.pressure_by_region(spark, sf))


@query
def view_ranking(spark, sf):
    return comparable(A.critical_ranking(spark, sf))


def _case_overview(spark: SparkSession, sf: str) -> DataFrame:
    return reports.case_overview(*A.star(spark, sf), A.CASES)


def _case_trend(spark: SparkSession, sf: str) -> DataFrame:
    return reports.case_trend(views.monthly_trend(A.disease_trend(spark, sf)), A.CASES)


def _case_ranking(spark: SparkSession, sf: str) -> DataFrame:
    return reports.facilities_by_cases(*A.star(spark, sf), A.CASES)


def _pressure_ranking(spark: SparkSession, sf: str) -> DataFrame:
    return reports.pressure_ranking(A.critical_ranking(spark, sf), A.CASES.state)


@query
def dash_overview(spark, sf):
    return comparable(_case_overview(spark, sf))


@query
def dash_trend(spark, sf):
    return comparable(_case_trend(spark, sf))


@query
def dash_case_map(spark, sf):
    return comparable(reports.case_map(*A.star(spark, sf), A.CASES))


@query
def dash_rank_cases(spark, sf):
    return comparable(_case_ranking(spark, sf))


@query
def dash_pressure_map(spark, sf):
    return comparable(reports.pressure_map(A.pressure_by_region(spark, sf), A.CASES.state))


@query
def dash_pressure_rank(spark, sf):
    return comparable(_pressure_ranking(spark, sf))


@query
def trend_timeline(spark, sf):
    return comparable(reports.timeline(_case_trend(spark, sf)))


@query
def trend_table(spark, sf):
    """The timeline newest first, with each row's place."""
    newest = reports.timeline(_case_trend(spark, sf), newest_first=True)
    months = F.dense_rank().over(Window.orderBy(F.col("periodo").desc()))  # one row per diagnosis and month of the slice
    return comparable(newest.select(months.cast("bigint").alias("lugar"), "*"))


@query
def rank_cases(spark, sf):
    return comparable(reports.ranking_table(_case_ranking(spark, sf)))


@query
def kpi_headline(spark, sf):
    return comparable(reports.headline_kpis(A.overview(spark, sf).drop("nivel_risco_predominante")))


@query
def kpi_display(spark, sf):
    """The headline figures as they are shown."""
    figures = reports.headline_kpis(A.overview(spark, sf))
    return figures.select(numbers.format_thousands("total_internacoes").alias("internacoes"),
                          numbers.format_thousands("permanencia_media", 1).alias("permanencia"),
                          numbers.format_money("valor_total").alias("valor"), "municipios_afetados")


@query
def kpi_pressure_display(spark, sf):
    """The pressure figures as they are shown."""
    figures = reports.pressure_headline(_pressure_ranking(spark, sf))
    return figures.select(numbers.format_of_hundred("indice_pressao_medio").alias("indice"), "em_sobrecarga", "hospitais_monitorados")


@query
def top_municipalities(spark, sf):
    return reports.top_municipalities(A.overview(spark, sf))


@query
def cases_by_year(spark, sf):
    return reports.cases_by_year(_case_overview(spark, sf))


@query
def kpi_pressure(spark, sf):
    return comparable(reports.pressure_headline(_pressure_ranking(spark, sf)))


@query
def risk_distribution(spark, sf):
    return reports.value_counts(_pressure_ranking(spark, sf), "nivel_risco")


@query
def top_ranked(spark, sf):
    """The 20 parts ordered most often, with their rank among all parts."""
    by_part = A.table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("vezes"))
    return ranking.top_ranked(by_part, "vezes", 20, "posicao", ["l_partkey"])


@query
def rank_by_value(spark, sf):
    """Every order ranked by price within its priority."""
    orders = A.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return ranking.rank_desc(orders, ["o_orderpriority"], "o_totalprice", "posicao")
