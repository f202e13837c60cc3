"""Projections that give the test tables the shape of the health tables.

`lineitem` plays the admissions (an order line that occurs again is a copy of
one admission), `supplier` the facility registry, `nation` and `region` the
municipalities, `part` the diagnosis. `oracle.py` repeats them in SQL.
"""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from wardline import vocabulary as V
from wardline.functions.codes import state_abbrev
from wardline.plans import gold, pressure, silver, trends, views
from wardline.plans.reports import CaseSlice

# State code by nation key: the nations lie in three states in turn, so that each has many facilities and a folder per
# month. The last nation has a code of no state.
NATION_CODES = tuple(V.CODE_BY_STATE[("SP", "RJ", "MG")[key % 3]] for key in range(24))
UNMAPPED_CODE = 99
NO_STATE = "ZZ"

# The nation whose municipality code no facility has, and that code without its check digit.
APART, APART_CODE = 23, 990000

NUMBER, DAY, MONTH = "_number", "_day", "_month"

# The slice reports are run on.
CASES = CaseSlice(("PROMO", "SMALL", "LARGE"), "SP", 1997, 1999)

# Lower index bounds of the levels above the first, equally spaced, for checks without clustering.
LEVEL_BOUNDS = (40, 50, 60)


_schemas: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. Its footer is read once per process, not once per use."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def _nation_code(key: str) -> Column:
    codes = ", ".join(str(code) for code in NATION_CODES)
    return F.coalesce(F.get(F.expr(f"array({codes})"), F.col(key)), F.lit(UNMAPPED_CODE))


def _day(column: str) -> Column:
    return F.col(column).cast("date")


def _compact(day: Column) -> Column:
    """`yyyyMMdd` of a date. A formatter takes longer for a row than reading it, so it is left the years without four digits."""
    number = F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)
    return F.when(F.year(day).between(1000, 9999), number.cast("string")).otherwise(F.date_format(day, "yyyyMMdd"))


def _iso(day: Column) -> Column:
    return F.when(F.year(day).between(1000, 9999), day.cast("string")).otherwise(F.date_format(day, "yyyy-MM-dd"))


def admissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze admissions with `uf`."""
    return _admissions(spark, sf_dir).drop(NUMBER, MONTH)


def _admissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the id as a number, and the month of DT_SAIDA less the stay, that of the ship date if there is a quantity."""
    return _spelled(_joined(spark, sf_dir), "uf", MONTH)


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with their diagnosis, state and month, in the few columns that admissions are spelled from."""
    lines = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    # a line without a supplier has no state, like one of a nation without
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", state_abbrev(_nation_code("s_nationkey")).alias("uf"))
    joined = (lines.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
              .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"), "left"))
    day = _day("l_shipdate")
    return joined.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_linestatus", "l_returnflag",
        "p_type", "uf", day.alias(DAY),
        F.when(F.col("l_quantity").isNotNull(), F.year(day) * 100 + F.month(day)).alias(MONTH),
    )


def _spelled(joined: DataFrame, *keys: str) -> DataFrame:
    """Admissions from such lines, with the id as a number, then `keys` as they are."""
    order, day = F.col("l_orderkey"), F.col(DAY)
    admitted = (F.when(order % 10 < 6, _iso(day))
                .when(order % 10 < 9, _compact(day))
                .otherwise(F.date_format(day, "dd/MM/yyyy")))
    return joined.select(
        F.concat("l_orderkey", F.lit("-"), "l_linenumber").alias("N_AIH"),
        F.col("l_linestatus").alias("UF_ZI"),
        (F.col("l_partkey") % 25 + 350000).alias("MUNIC_RES"),
        (F.col("l_suppkey") % 25 + 350000).alias("MUNIC_MOV"),
        admitted.alias("DT_INTER"),
        _compact(F.date_add(day, F.col("l_quantity").cast("int"))).alias("DT_SAIDA"),
        F.col("p_type").alias("DIAG_PRINC"),
        F.col("l_partkey").cast("string").alias("PROC_REA"),
        F.when(order % 53 == 0, -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice")).alias("VAL_TOT"),
        (F.col("l_quantity").cast("bigint") - 3).alias("DIAS_PERM"),
        (F.col("l_partkey") % 95).alias("IDADE"),
        F.col("l_returnflag").alias("SEXO"),
        (F.col("l_linenumber") % 2).cast("bigint").alias("MORTE"),
        (F.col("l_suppkey") + F.when(order % 97 == 0, 1000).otherwise(0)).alias("CNES"),
        (order * 10 + F.col("l_linenumber")).alias(NUMBER),
        *keys,
    )


def _placed(joined: DataFrame) -> DataFrame:
    """Such lines with the state and month of their folder."""
    return joined.withColumns({"uf": F.coalesce("uf", F.lit(NO_STATE)), "ano_mes": F.lpad(F.col(MONTH).cast("string"), 6, "0")})


def dropped_admissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Admissions as they lie in landed folders: numeric ids, one folder per state and month."""
    return _numbered(_placed(_joined(spark, sf_dir)))


def _numbered(placed: DataFrame) -> DataFrame:
    return _spelled(placed, "uf", "ano_mes").withColumn("N_AIH", F.col(NUMBER)).drop(NUMBER)


def write_drifting(spark: SparkSession, sf_dir: str, root: str, which: Column | None = None) -> None:
    """Write the landed folders, or those `which` holds for, with three sets of column types, by year.

    Lines are moved to their folders in the columns they come in and spelled
    there. Up to the year 9999 a folder is of one layout, so the layouts are
    landed at the same time and each replaces its own folders; later years are
    cut to six digits and share folders, so their layouts are added in turn.
    """
    lines = _placed(_joined(spark, sf_dir))
    if which is not None:
        lines = lines.filter(which)
    kind = F.expr(f"{MONTH} div 100 % 3")  # every layout looks for its rows in all lines
    shipped = table(spark, sf_dir, "lineitem").select("l_shipdate")
    first = F.make_date(F.lit(10000), F.lit(1), F.lit(1)).cast(shipped.schema[0].dataType)  # row groups before it are skipped
    shared = not shipped.filter(F.col("l_shipdate") >= first).isEmpty()

    def land(number: int) -> None:
        rows = _numbered(lines.filter(kind == number).drop(MONTH).hint("rebalance", F.col("uf"), F.col("ano_mes")))
        layouts = (
            rows.withColumn("N_AIH", F.col("N_AIH").cast("string")),
            rows.drop("PROC_REA").withColumn("MUNIC_MOV", F.col("MUNIC_MOV").cast("int")),
            rows.withColumns({"DIAS_PERM": F.col("DIAS_PERM").cast("string"), "VAL_TOT": F.col("VAL_TOT").cast("string"),
                              "N_AIH": F.col("N_AIH").cast("string"), "EXTRA": F.lit(1)}),
        )
        (layouts[number].write.mode("append" if shared else "overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("uf", "ano_mes").parquet(root))

    with ThreadPool(1 if shared else 3) as pool:
        pool.map(land, range(3))


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze registry: two versions of every supplier."""
    key, nation = F.col("s_suppkey"), F.col("s_nationkey")
    newer = F.col("version") == 2
    tail = F.when(key % 2 == 0, 350000 + nation).otherwise((350000 + nation) * 10 + 5)
    updated = (F.when(newer & (key % 10 == 0), F.lit(None))
               .when(newer | (key % 13 == 0), F.lit("2024-03-15"))
               .otherwise(F.lit("2022-06-01")))
    return table(spark, sf_dir, "supplier").withColumn("version", F.explode(F.array(F.lit(1), F.lit(2)))).select(
        key.alias("codigo_cnes"),
        F.concat(F.col("s_name"), F.when(newer, "").otherwise(" (antigo)")).alias("nome_fantasia"),
        F.nullif((key + F.when(newer, 0).otherwise(3)) % 8, F.lit(0)).cast("int").alias("codigo_tipo_unidade"),
        _nation_code("s_nationkey").cast("int").alias("codigo_uf"),
        tail.cast("int").alias("codigo_municipio"),
        F.when(key % 17 != 0, -20 - nation / 10.0).alias("latitude_estabelecimento_decimo_grau"),
        F.when(key % 17 != 0, -45 - key / 100.0).alias("longitude_estabelecimento_decimo_grau"),
        (key % 2).cast("int").alias("estabelecimento_possui_atendimento_hospitalar"),
        F.lit(None).cast("string").alias("numero_telefone_estabelecimento"),
        updated.alias("data_atualizacao"),
    )


def municipalities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Municipality reference: nations with 7-digit codes, one of which no facility has."""
    nations = table(spark, sf_dir, "nation")
    regions = table(spark, sf_dir, "region")
    key = F.col("n_nationkey")
    return nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
        (F.when(key == APART, APART_CODE).otherwise(350000 + key) * 10 + 5).cast("bigint").alias("codigo_municipio"),
        F.col("n_name").alias("nome_municipio"),
        state_abbrev(_nation_code("n_nationkey")).alias("uf"),
        F.col("r_name").alias("regiao_saude"),
        (key * 10000).cast("bigint").alias("populacao"),
        (1.5 + key / 10.0).alias("meta_leitos_1000hab"),
    )


def coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        ((350000 + key) * 10 + 5).cast("bigint").alias("codigo_ibge"), F.col("n_name").alias("nome"),
        (-10 - key / 4.0).alias("latitude"), (-50 - key / 8.0).alias("longitude"))


# Tables further on, each derived from the ones above. ---------------------------------------------


def silver_admissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_admissions(admissions(spark, sf_dir))


def silver_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_registry(registry(spark, sf_dir))


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.fact(silver_admissions(spark, sf_dir))


def dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_hospital(silver_registry(spark, sf_dir))


def disease_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.disease_trend(fact(spark, sf_dir), dim(spark, sf_dir))


def star(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Fact, facilities, municipalities."""
    return fact(spark, sf_dir), dim(spark, sf_dir), municipalities(spark, sf_dir)


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pressure.pressure_features(fact(spark, sf_dir))


def pressure_table(fact: DataFrame) -> DataFrame:
    """Pressure table whose level follows from the index alone, so that SQL can repeat it."""
    low, _, high = LEVEL_BOUNDS
    step = F.width_bucket(F.col("indice_pressao"), F.lit(low), F.lit(high), F.lit(len(LEVEL_BOUNDS) - 1))
    level = F.get(F.array(*[F.lit(name) for name in V.RISK_LEVELS]), step.cast("int"))
    return pressure.pressure_index(pressure.pressure_features(fact)).withColumn("nivel_risco", level)


def occupancy_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Input of the occupancy index: one row per supplier that has lines."""
    quantity = F.col("l_quantity")
    by_supplier = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("cnes_id")).agg(
        F.count("*").alias("qtd_internacoes"),
        F.round(F.avg(quantity), 1).alias("permanencia_media"),
        F.count_if(quantity >= 45).alias("pacientes_criticos"),
        F.round(F.avg(F.col("l_discount") + F.col("l_tax")) * 12, 2).alias("taxa_ocupacao_estimada"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("cnes_id"),
                                                        F.col("s_name").alias("nome_estabelecimento"))
    return by_supplier.join(suppliers, "cnes_id").select(
        "cnes_id", "nome_estabelecimento", "qtd_internacoes", "permanencia_media", "pacientes_criticos",
        "taxa_ocupacao_estimada")


def overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, dim, places = star(spark, sf_dir)
    return views.overview(fact, dim, places, pressure_table(fact))


def pressure_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, dim, places = star(spark, sf_dir)
    return views.pressure_by_region(fact, dim, places, pressure_table(fact), count_rate=True)


def critical_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, dim, places = star(spark, sf_dir)
    return views.critical_ranking(dim, places, pressure_table(fact))
