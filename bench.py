"""Time the headline queries: `python bench.py` prints one JSON line.

Two groups, as in use: the jobs that build the tables from landed files, run
once and cold, and the reports on those tables, best of three. The weekly trend
is also timed straight from the raw tables. Results are computed in full and
discarded.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from wardline.functions.codes import state_abbrev
from wardline.harness import adapter as A
from wardline.harness.queries import QUERIES
from wardline.plans import full_run as runs, pressure, reports, trends, views
from wardline.session import build_session
from wardline.sinks import writers
from wardline.sinks.catalog import register_tables, register_views

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def main() -> None:
    scratch = tempfile.mkdtemp(prefix="wardline-bench-")
    spark = build_session(
        "wardline-bench", f"local[{CPUS}]",
        **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
           "spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "16g",
           "spark.checkpoint.dir": f"file://{scratch}",
           "spark.sql.warehouse.dir": f"file://{scratch}/warehouse"})
    spark.sparkContext.setLogLevel("ERROR")

    base = f"file://{scratch}/lake"
    paths = runs.Paths(f"{base}/admissions", f"{base}/registry", f"{base}/municipalities",
                       f"{base}/silver", f"{base}/gold")
    A.write_drifting(spark, SF_DIR, paths.admissions)
    raw = A.registry(spark, SF_DIR)
    writers.land_registry(raw.withColumn("uf", state_abbrev("codigo_uf")), paths.registry)
    writers.write_csv(A.municipalities(spark, SF_DIR), paths.municipalities)

    seconds: dict[str, float] = {}

    def timed(name, work, times: int = 3) -> None:
        for _ in range(times):
            began = time.perf_counter()
            result = work()
            if result is not None:
                result.write.format("noop").mode("overwrite").save()
            took = round(time.perf_counter() - began, 3)
            seconds[name] = min(took, seconds.get(name, took))

    timed("disease_trend_from_raw", lambda: QUERIES["disease_trend"](spark, SF_DIR))
    timed("build_silver", lambda: runs.build_silver(spark, paths), times=1)
    timed("build_gold", lambda: runs.build_gold(spark, paths), times=1)

    register_tables(spark, paths.gold, paths.municipalities)
    views_by_name = register_views(spark)
    fact, dim, places, risk = (spark.table(f"gold.{name}") for name in (
        "fato_internacoes", "dim_hospital", "municipios_referencia", "kpi_pressao_hospitalar"))
    timed("weekly_trend", lambda: trends.disease_trend(fact, dim))
    timed("pressure_features", lambda: pressure.pressure_features(fact))
    timed("pressure_index", lambda: pressure.pressure_index(pressure.pressure_features(fact)))
    for name in views_by_name:
        timed(name, lambda view=name: spark.sql(f"SELECT * FROM {view}"))
    timed("case_overview", lambda: reports.case_overview(fact, dim, places, A.CASES))
    timed("case_map", lambda: reports.case_map(fact, dim, places, A.CASES))
    timed("facilities_by_cases", lambda: reports.facilities_by_cases(fact, dim, places, A.CASES))
    timed("pressure_map", lambda: reports.pressure_map(
        views.pressure_by_region(fact, dim, places, risk), A.CASES.state))
    timed("pressure_ranking", lambda: reports.pressure_ranking(
        spark.table("vw_ranking_hospitais_criticos"), A.CASES.state))
    timed("headline_kpis", lambda: reports.headline_kpis(views_by_name["vw_acompanhamento_geral"]))

    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
