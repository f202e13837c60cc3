"""Scans, landed payloads, writers and the catalog."""

import json
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F, types as T

from wardline import schemas
from wardline.operators.projections import canonicalize
from wardline.sinks import writers
from wardline.sources import harmonize as H, partitioned, payloads, tables

TARGET = T.StructType([T.StructField("N_AIH", T.StringType()), T.StructField("DIAS_PERM", T.LongType()),
                       T.StructField("PROC_REA", T.StringType()), T.StructField("VAL_TOT", T.DoubleType())])


def drop(spark, root, uf, month, sql):
    spark.sql(sql).coalesce(1).write.parquet(f"{root}/uf={uf}/ano_mes={month}")


@pytest.fixture
def drifting(spark, tmp_path):
    root = str(tmp_path / "bronze")
    drop(spark, root, "SP", "202301", "SELECT 'x1' AS N_AIH, 3L AS DIAS_PERM, 'p' AS PROC_REA, 1.5D AS VAL_TOT")
    drop(spark, root, "SP", "202302", "SELECT 12L AS N_AIH, 4 AS DIAS_PERM, 2.5D AS VAL_TOT, 'extra' AS OUTRA")
    drop(spark, root, "01", "202303", "SELECT '0013' AS n_aih, '5.0' AS DIAS_PERM, 'q' AS PROC_REA, 'x' AS VAL_TOT")
    drop(spark, root, "RJ", "202304", "SELECT 'x9' AS N_AIH, 6L AS DIAS_PERM, 'p' AS PROC_REA, 9.5D AS VAL_TOT LIMIT 0")
    drop(spark, root, "RJ", "202305", "SELECT 'x2' AS N_AIH, 7L AS DIAS_PERM")
    spark.range(1).write.parquet(f"{root}/other/ano_mes=202301")
    return root


def test_partitions_need_both_keys(spark, drifting):
    found = partitioned.discover_partitions(spark, drifting)
    assert [(r.uf, r.ano_mes) for r in found.collect()] == [
        ("01", "202303"), ("RJ", "202304"), ("RJ", "202305"), ("SP", "202301"), ("SP", "202302")]


def test_no_file_is_opened_to_list_partitions(spark, drifting):
    found = partitioned.discover_partitions(spark, drifting)
    assert "ReadSchema: struct<path:string>" in found._jdf.queryExecution().executedPlan().toString()


def test_drifting_types_meet_in_the_target(spark, drifting, rows):
    df = partitioned.read_drifting_parquet(spark, drifting, TARGET)
    assert df.columns == ["N_AIH", "DIAS_PERM", "PROC_REA", "VAL_TOT", "uf"]
    assert rows(df) == [("0013", 5, "q", None, "01"), ("12", 4, None, 2.5, "SP"), ("x1", 3, "p", 1.5, "SP"),
                        ("x2", 7, None, None, "RJ")]


def test_one_scan_per_type_combination(spark, tmp_path):
    root = str(tmp_path / "many")
    for month in range(1, 9):
        kind = "STRING" if month % 2 else "BIGINT"
        drop(spark, root, "SP", f"2023{month:02d}", f"SELECT CAST({month} AS {kind}) AS N_AIH, 1L AS DIAS_PERM")
    plan = partitioned.read_drifting_parquet(spark, root, TARGET)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2


def test_an_empty_root_is_an_error(spark, tmp_path):
    spark.range(1).write.parquet(str(tmp_path / "flat"))
    with pytest.raises(ValueError):
        partitioned.read_drifting_parquet(spark, str(tmp_path / "flat"), TARGET)


def test_harmonize(spark):
    df = spark.sql("SELECT '7.9' AS dias_perm, 4294967296L AS big, ' 12 ' AS N_AIH")
    target = T.StructType([T.StructField("DIAS_PERM", T.IntegerType()), T.StructField("BIG", T.IntegerType()),
                           T.StructField("N_AIH", T.LongType()), T.StructField("VAL", T.DoubleType())])
    got = H.harmonize(df, target)
    assert tuple(got.first()) == (7, None, 12, None)
    assert [f.dataType for f in got.schema.fields] == [f.dataType for f in target.fields]


def test_required_columns(spark):
    df = spark.range(1)
    assert H.require_columns(df, ["id"]) is df
    with pytest.raises(ValueError, match="populacao, uf"):
        H.require_columns(df, ["uf", "id", "populacao"])


def test_names(spark):
    df = spark.sql("SELECT 1 AS n_aih, 2 AS Cnes, 3 AS outro")
    assert H.normalize_names(df, ["CNES", "N_AIH", "SEXO"]).columns == ["CNES", "N_AIH"]
    with pytest.raises(ValueError):
        H.normalize_names(df, ["SEXO"])


def test_registry_survives_odd_fields(spark, tmp_path, rows):
    (tmp_path / "a.json").write_text(
        '{"codigo_cnes": 1, "codigo_uf": "35", "latitude_estabelecimento_decimo_grau": -23.5}\n'
        '{"codigo_cnes": "2", "codigo_uf": 35.0, "codigo_municipio": "x", "novo": {"a": [1]}}\n'
        "not json\n")
    df = tables.read_registry(spark, str(tmp_path / "a.json"))
    assert df.schema == schemas.REGISTRY
    got = rows(df, "codigo_cnes", "codigo_uf", "codigo_municipio", "latitude_estabelecimento_decimo_grau")
    assert got == [(None, None, None, None), (1, 35, None, -23.5), (2, 35, None, None)]


def test_csv_sources(spark, tmp_path, rows):
    (tmp_path / "m.csv").write_text(
        "codigo_municipio,nome_municipio,uf,regiao_saude,populacao,meta_leitos_1000hab\n"
        '3550308,"Sao Paulo, capital",SP,"Grande ""SP""",11451245,2.4\n')
    assert rows(tables.read_municipalities(spark, str(tmp_path / "m.csv"))) == [
        (3550308, "Sao Paulo, capital", "SP", 'Grande "SP"', 11451245, 2.4)]
    (tmp_path / "c.csv").write_text("codigo_ibge,nome,latitude,longitude\n3550308,Sao Paulo,-23.5,-46.6\n")
    assert rows(tables.read_coordinates(spark, str(tmp_path / "c.csv"))) == [(3550308, "Sao Paulo", -23.5, -46.6)]
    with pytest.raises(ValueError, match="populacao"):
        tables.read_municipalities(spark, str(tmp_path / "c.csv"))


def test_code_list(spark, tmp_path, rows):
    (tmp_path / "named.csv").write_text("outro,cnes_id\na,2\nb,2.0\nc,\nd,1\n")
    assert rows(tables.read_code_list(spark, str(tmp_path / "named.csv"))) == [(1,), (2,)]
    (tmp_path / "first.csv").write_text("codigo,x\n5,1\n5,2\nz,3\n")
    assert rows(tables.read_code_list(spark, str(tmp_path / "first.csv"))) == [(5,)]


# Payloads -----------------------------------------------------------------------------------------

ONE, TWO = {"codigo_cnes": 1, "codigo_uf": "35"}, {"codigo_cnes": 2}
DOCUMENTS = [{"estabelecimentos": [ONE, TWO]}, {"data": [ONE]}, [ONE, TWO], ONE, {"estabelecimentos": [], "data": [TWO]},
             [], {"estabelecimentos": []}, {"outro": 1}]


def documents(spark, items):
    return spark.createDataFrame([(json.dumps(item) if not isinstance(item, str) else item,) for item in items],
                                 "payload string")


@pytest.mark.parametrize("single, expected", [(False, [1, 1, 1, 2, 2, 2]), (True, [1, 1, 1, 1, 2])])
def test_envelopes(spark, single, expected):
    df = payloads.unwrap_registry_payload(documents(spark, [*DOCUMENTS, "{broken", ""]), single=single)
    assert df.schema == schemas.REGISTRY
    assert sorted(r.codigo_cnes for r in df.collect()) == expected


def population(code, series):
    return [{"resultados": [{"series": [{"localidade": {"id": code}, "serie": series}]}]}]


def test_population(spark, rows):
    items = [population("1", {"2022": "5", "2024": "7"}), population("2", {"2024": "-"}), population("3", {}),
             population("4", {"2024": "12.5"}), population("5", {"2024": " 8 "}), population("x", {"2024": "1"})]
    assert rows(payloads.flatten_population(documents(spark, items))) == [(1, 7), (5, 8)]


def test_population_keeps_the_last_value(spark, rows):
    df = documents(spark, [population("1", {"2024": "5"}), population("1", {"2024": "6"}),
                           population("1", {"2024": "-"})]).withColumn("n", F.monotonically_increasing_id())
    assert rows(payloads.flatten_population(df, order="n")) == [(1, 6)]


def test_municipalities(spark, rows):
    def place(number, **levels):
        return {"id": number, "nome": f"m{number}", **{k.replace("_", "-"): v for k, v in levels.items()}}

    name = {"nome": "R"}
    items = [[place(1, microrregiao={"mesorregiao": {"nome": "M"}}, regiao_imediata=name),
              place(2, regiao_imediata=name), place(3)],
             [place(4, microrregiao={"mesorregiao": {"nome": ""}}, regiao_imediata=name),
              place(5, microrregiao=None, regiao_imediata=name),
              place(6, microrregiao={"mesorregiao": None}, regiao_imediata=name),
              place(7, microrregiao={}, regiao_imediata=name), place(8, microrregiao={}, regiao_imediata=None)]]
    got = rows(payloads.flatten_municipalities(documents(spark, items), "SP"), "codigo_municipio", "regiao_saude")
    none = "Não classificada"
    assert got == [(1, "M"), (2, "R"), (3, none), (4, "R"), (5, none), (6, none), (7, "R"), (8, none)]


# Sinks --------------------------------------------------------------------------------------------


def test_months_land_idempotently(spark, tmp_path, rows):
    root = str(tmp_path / "landed")
    first = spark.createDataFrame([("SP", "202301", 1), ("SP", "202302", 2), ("RJ", "202301", 3)],
                                  "uf string, ano_mes string, v int")
    writers.land_month(first, root)
    writers.land_month(first.filter("uf = 'SP' AND ano_mes = '202301'").withColumn("v", F.lit(9)), root)
    writers.land_month(first.limit(0), root)
    assert rows(spark.read.schema(first.schema).parquet(root), "uf", "ano_mes", "v") == [
        ("RJ", "202301", 3), ("SP", "202301", 9), ("SP", "202302", 2)]


def test_registry_runs_add_up(spark, tmp_path):
    root = str(tmp_path / "registry")
    run = spark.createDataFrame([("SP", 1), ("RJ", 2)], "uf string, codigo_cnes long")
    writers.land_registry(run, root)
    writers.land_registry(run, root)
    assert tables.read_registry(spark, root).count() == 4


def test_partitioned_writes(spark, tmp_path, rows):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 4).alias("p"), "id")
    for colocate in (True, False):
        path = str(tmp_path / f"c{colocate}")
        writers.write_partitioned(df, path, ["p"], colocate, sort_by=["id"])
        assert rows(spark.read.schema(df.schema).parquet(path), "p", "id") == rows(df)
        for file in Path(path).glob("p=*/*.parquet"):
            ids = pq.read_table(file, columns=["id"], partitioning=None)["id"].to_pylist()
            assert ids == sorted(ids)
    writers.write_partitioned(df.limit(5), path, ["p"])
    assert spark.read.parquet(path).count() == 5


def test_csv_roundtrip_with_quotes(spark, tmp_path, rows):
    df = spark.createDataFrame([('a "b", c', 1), (None, 2)], "t string, n long")
    writers.write_csv(df, str(tmp_path / "t"))
    assert rows(H.harmonize(tables.read_csv(spark, str(tmp_path / "t")), df.schema)) == rows(df)


def test_landed_months_read_back_in_any_type(spark, tmp_path):
    root = str(tmp_path / "canonical")
    for month, sql in (("202301", "SELECT 1L AS N_AIH, timestamp'2023-01-05 00:00:00' AS DT_INTER, '4' AS DIAS_PERM"),
                       ("202302", "SELECT 'b' AS N_AIH, '20230205' AS DT_INTER, 5 AS DIAS_PERM")):
        landed = canonicalize(spark.sql(sql)).withColumns({"uf": F.lit("SP"), "ano_mes": F.lit(month)})
        writers.land_month(landed, root)
    df = spark.read.parquet(root)
    assert sorted(tuple(r) for r in df.select("N_AIH", "DT_INTER", "DIAS_PERM").collect()) == [
        ("1", "2023-01-05", 4), ("b", "20230205", 5)]


def _month(spark, root, name, rows, ddl, mode="append"):
    spark.createDataFrame(rows, ddl).coalesce(1).write.mode(mode).parquet(f"{root}/uf=SP/ano_mes={name}")


@pytest.mark.parametrize("beside", [[], ["202302"], ["202302", "202303"]])
def test_no_column_is_lost_whatever_lies_beside(spark, tmp_path, beside):
    root = str(tmp_path / "lake")
    # one folder of two files: only one has PROC_REA, and they differ in the type of DIAS_PERM
    _month(spark, root, "202301", [("1", 5)], "N_AIH string, DIAS_PERM long")
    _month(spark, root, "202301", [("2", "7", "x")], "N_AIH string, DIAS_PERM string, PROC_REA string")
    for name in beside:
        _month(spark, root, name, [(3, 9.5)], "N_AIH long, VAL_TOT double")
    found = partitioned.read_drifting_parquet(spark, root, schemas.ADMISSIONS).where("N_AIH IN ('1', '2')")
    assert sorted((r.N_AIH, r.DIAS_PERM, r.PROC_REA) for r in found.collect()) == [("1", 5, None), ("2", 7, "x")]


def test_a_csv_with_another_header_fails(spark, tmp_path):
    path = tmp_path / "csv"
    path.mkdir()
    (path / "a.csv").write_text("codigo_ibge,nome,latitude,longitude\n1,A,-10,-50\n")
    assert tables.read_coordinates(spark, str(path)).count() == 1
    (path / "b.csv").write_text("codigo_ibge,nome,longitude,latitude\n2,B,-51,-11\n")
    with pytest.raises(Exception, match="(?i)header"):
        tables.read_coordinates(spark, str(path)).collect()


def test_broken_registry_lines_are_listed(spark, tmp_path):
    path = tmp_path / "registry"
    path.mkdir()
    (path / "a.json").write_text('{"codigo_cnes": 1, "nome_fantasia": "A"}\n{"codigo_cnes": 2, "nome\nnot json\n{"codigo_cnes": "x"}\n')
    assert sorted(r.line for r in tables.broken_registry_lines(spark, str(path)).collect()) == ["not json", '{"codigo_cnes": 2, "nome']


def jobs_of(spark, name, work):
    """(number of jobs, number of tasks that failed) of what `work` runs."""
    spark.sparkContext.setJobGroup(name, name)
    try:
        work()
    finally:
        spark.sparkContext.setJobGroup("rest", "rest")
    tracker = spark.sparkContext.statusTracker()
    jobs = [tracker.getJobInfo(job) for job in tracker.getJobIdsForGroup(name)]
    stages = [tracker.getStageInfo(stage) for job in jobs if job for stage in job.stageIds]
    return len(jobs), sum(stage.numFailedTasks for stage in stages if stage), {job.status for job in jobs if job}


def test_conflicting_types_cost_no_failed_job_and_jobs_do_not_grow_with_files(spark, tmp_path):
    counts = []
    for months in (4, 24):
        root = str(tmp_path / f"lake{months}")
        for month in range(months):
            kind = "STRING" if month % 2 else "BIGINT"
            drop(spark, root, "SP", f"{2020 + month // 12}{month % 12 + 1:02d}", f"SELECT CAST({month} AS {kind}) AS N_AIH, 1L AS DIAS_PERM")
        jobs, failed, states = jobs_of(spark, f"scan{months}", lambda: partitioned.read_drifting_parquet(spark, root, TARGET).collect())
        assert failed == 0 and states == {"SUCCEEDED"}
        counts.append(jobs)
    assert counts[0] == counts[1]


def test_a_type_that_one_file_has_gets_its_own_scan(spark, tmp_path, rows):
    root = str(tmp_path / "odd")
    for part in range(12):
        spark.range(part, part + 1).selectExpr("id AS N_AIH", "1L AS DIAS_PERM").coalesce(1).write.mode("append").parquet(f"{root}/uf=SP/ano_mes=202301")
    odd = spark.range(1).selectExpr("'x' AS N_AIH", "'7' AS DIAS_PERM", "2.5D AS VAL_TOT").coalesce(1)
    odd.write.mode("append").parquet(f"{root}/uf=SP/ano_mes=202301")
    for direct in (True, False):
        files = partitioned._files(spark, root, ("uf", "ano_mes"), {})
        index = partitioned.footer_index(files, TARGET.names, direct)
        kinds = index.groupBy("kind").count().orderBy("count").collect()
        assert [(r["kind"], r["count"]) for r in kinds] == [("DIAS_PERM string, N_AIH string, VAL_TOT double", 1),
                                                            ("DIAS_PERM int64, N_AIH int64", 12)]
    df = partitioned.read_drifting_parquet(spark, root, TARGET)
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 2
    assert rows(df, "N_AIH", "DIAS_PERM", "VAL_TOT") == sorted([(str(i), 1, None) for i in range(12)] + [("x", 7, 2.5)])


def test_a_least_month_leaves_earlier_folders_out(spark, drifting, rows):
    found = partitioned.discover_partitions(spark, drifting, since={"ano_mes": "202303"})
    assert rows(found, "uf", "ano_mes") == [("01", "202303"), ("RJ", "202304"), ("RJ", "202305")]
    df = partitioned.read_drifting_parquet(spark, drifting, TARGET, since={"ano_mes": "202303"})
    assert rows(df, "N_AIH") == [("0013",), ("x2",)]
