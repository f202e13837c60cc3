import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from plans import plan_of
from wardline.operators import joins

FULL = (3534401, 3534402, 3550308, 0, 7, 353440)


@pytest.fixture(scope="module")
def places(spark):
    return spark.createDataFrame([(code, f"m{code}") for code in FULL], "codigo_municipio long, nome_municipio string")


def test_both_spellings_meet(spark, places, rows):
    df = spark.createDataFrame([(1, 3534401), (2, 353440), (3, 3550308), (4, 999), (5, None), (6, 0)],
                               "id int, codigo_municipio int")
    got = rows(joins.join_municipality(df, places, ["nome_municipio"]), "id", "nome_municipio")
    assert got == [(1, "m3534401"), (2, "m353440"), (2, "m3534401"), (2, "m3534402"), (3, "m3550308"),
                   (4, None), (5, None), (6, "m0"), (6, "m7")]


def test_no_nested_loop(spark, places):
    df = spark.range(5).select(F.col("id").alias("codigo_municipio"))
    assert "NestedLoop" not in plan_of(joins.join_municipality(df, places, ["nome_municipio"]))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(codes=st.lists(st.one_of(st.none(), st.integers(0, 120)), min_size=1, max_size=12),
       reference=st.lists(st.integers(0, 1200), min_size=1, max_size=12))
def test_equal_to_the_literal_disjunction(spark, rows, codes, reference):
    left = spark.createDataFrame(list(enumerate(codes)), "id int, codigo_municipio int")
    right = spark.createDataFrame([(c, str(i)) for i, c in enumerate(reference)], "codigo_municipio long, nome string")
    literal = left.alias("l").join(
        right.alias("r"),
        F.expr("r.codigo_municipio = l.codigo_municipio OR r.codigo_municipio div 10 = l.codigo_municipio"), "left")
    assert (rows(joins.join_municipality(left, right, ["nome"]), "id", "nome")
            == rows(literal.select("l.id", "r.nome")))


def test_members(spark, rows):
    fact = spark.createDataFrame([(1,), (2,), (2,), (9,), (9,)], "cnes_id long")
    dim = spark.createDataFrame([(1, "SP", "x"), (3, "RJ", "y")], "cnes_id long, uf string, nome string")
    missing = joins.missing_members(fact, dim)
    assert rows(missing) == [(2,), (9,)]
    whole = joins.with_inferred_members(dim, missing)
    assert rows(whole) == [(1, "SP", "x", False), (2, None, None, True), (3, "RJ", "y", False), (9, None, None, True)]
    assert fact.join(whole, "cnes_id").count() == fact.count()
    assert rows(joins.with_state(fact, dim)) == [(1, "SP"), (2, None), (2, None), (9, None), (9, None)]
    assert rows(joins.with_facility(fact, dim, ["nome"])) == [(1, "x")]
    assert rows(joins.restrict_to_codes(dim, fact.distinct(), "cnes_id"), "cnes_id") == [(1,)]


def test_population_fallback_is_flagged(spark, rows):
    places = spark.createDataFrame([(1, "a"), (2, "b")], "codigo_municipio long, nome string")
    known = spark.createDataFrame([(1, 500)], "codigo_municipio long, populacao long")
    assert rows(joins.fill_population(places, known, 7)) == [(1, "a", 500, False), (2, "b", 7, True)]
    middle = known.agg(F.median("populacao")).scalar()
    assert rows(joins.fill_population(places, known, middle)) == [(1, "a", 500, False), (2, "b", 500, True)]


def test_coordinates_come_from_the_municipality(spark, rows):
    dim = spark.createDataFrame([(1, 353440, None, None), (2, 3550308, 1.0, 2.0), (3, 1, None, 2.0),
                                 (4, 3550308, 1.0, None)],
                                "cnes_id long, codigo_municipio long, latitude double, longitude double")
    points = spark.createDataFrame([(3534401, "a", -1.0, -2.0), (3550308, "b", -3.0, -4.0)],
                                   "codigo_ibge long, nome string, latitude double, longitude double")
    got = rows(joins.fill_coordinates(dim, points), "cnes_id", "latitude", "longitude", "is_coord_estimated")
    assert got == [(1, -1.0, -2.0, True), (2, 1.0, 2.0, False), (3, None, 2.0, False), (4, -3.0, -4.0, True)]


def test_a_hot_key_does_not_change_the_result(spark):
    fact = spark.range(6000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50).alias("cnes_id"))
    dim = spark.range(50).select(F.col("id").alias("cnes_id"), (F.col("id") % 5).cast("string").alias("uf"))
    assert joins.with_state(fact, dim).filter("uf is null").count() == 0
    assert joins.with_state(fact, dim).count() == 6000


def test_a_repeated_population_multiplies_no_municipality(spark, rows):
    places = spark.createDataFrame([(1, "a", None), (2, "b", None)], "codigo_municipio long, nome_municipio string, populacao long")
    known = spark.createDataFrame([(1, 500), (1, 700), (1, None)], "codigo_municipio long, populacao long")
    assert rows(joins.fill_population(places, known, 7)) == [(1, "a", 700, False), (2, "b", 7, True)]


def test_counts_meet_the_facilities(spark):
    from wardline.plans import trends

    fact = spark.range(100).select((F.col("id") % 7).alias("cnes_id"), F.lit("A").alias("cid_principal"), F.lit(2023).alias("ano"),
                                   F.lit(1).alias("mes"), F.lit(1).alias("semana_epidemiologica"))
    dim = spark.createDataFrame([(i, "SP") for i in range(6)], "cnes_id long, uf string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(trends.weekly_cases(fact, dim))
        assert plan.index("SortMergeJoin") < plan.index("partial_count(1)")  # the count is below the join
        assert "partial_sum" in plan[:plan.index("SortMergeJoin")]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_repeated_code_gives_a_facility_one_point(spark, rows):
    dim = spark.createDataFrame([(1, 350001, None, None), (2, 3500015, None, 4.0), (3, 3500019, None, None), (4, 350001, 1.0, 2.0),
                                 (5, 99, None, None)], "cnes_id long, codigo_municipio long, latitude double, longitude double")
    reference = spark.createDataFrame([(3500015, 7.0, 7.0), (3500015, 5.0, 9.0), (3500015, None, 1.0), (3500019, 6.0, 6.0), (99, 1.0, None)],
                                      "codigo_ibge long, latitude double, longitude double")
    found = joins.fill_coordinates(dim, reference)
    assert rows(found, "cnes_id", "latitude", "longitude", "is_coord_estimated") == [
        (1, 5.0, 9.0, True), (2, 5.0, 9.0, True), (3, 6.0, 6.0, True), (4, 1.0, 2.0, False), (5, None, None, False)]
