"""
(cold, then warm second run); DuckDB oracle times on the same data beside them.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, or "all"; default the headline set). Prints ONE JSON line:
``value`` = warm layer rebuild + sum of warm query times. Each Spark query is executed in
full with the ``noop`` sink (no driver collect).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "silver_clean", "fact_player_season", "feature_table", "discovery_topn", "position_zscores",
    "star_join_wide", "history_sequence", "orphans_by_fk", "measure_totals",
    "measure_value_rank", "top_scorer_row", "season_leaders", "measure_sos_change",
    "transfer_history", "cluster_inputs", "cluster_styles", "silver_from_files",
]
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _run(fn) -> float:
    t = time.time()
    fn()
    return round(time.time() - t, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")

    from periodstats.plans import catalog
    from periodstats.plans import warehouse as wh_mod
    from periodstats.plans.warehouse import Warehouse, warehouse
    from periodstats.session import local_session

    wanted = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE))
    names = list(catalog.REGISTRY) if wanted == "all" else [n for n in wanted.split(",") if n]

    spark = local_session(cores=cpus, shuffle_partitions=int(cpus))
    spark.sparkContext.setLogLevel("ERROR")

    def query(name):
        return lambda: catalog.run(name, spark, sf_dir).write.format("noop") \
            .mode("overwrite").save()

    cold = {"build_layers": _run(warehouse(spark, sf_dir).build_all)}
    for name in names:
        cold[name] = _run(query(name))
    # warm pass: a freshly built warehouse serves the queries, so results memoised during the
    # cold pass (clusters, landed files) are computed again, not reused
    fresh = Warehouse(spark, sf_dir)
    warm = {"build_layers": _run(fresh.build_all)}
    wh_mod.serve(fresh)
    for name in names:
        warm[name] = _run(query(name))

    duck: dict[str, float] = {}
    try:
        import duckdb
        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
        for name in names:
            sql = catalog.oracle(name)
            if sql is not None:
                duck[name] = _run(lambda: con.execute(sql).fetchall())
    except Exception as e:  # the oracle timing is informative only
        duck["error"] = str(e)[:200]

    from periodstats.plans.checks import plan_checks
    try:
        checks = plan_checks(spark, sf_dir)
    except Exception as e:  # informative only
        checks = {"error": str(e)[:200]}

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "warm_total_sec", "value": round(sum(warm.values()), 3),
                      "unit": "sec", "queries": warm, "sf": sf, "cpus": int(cpus),
                      "cold_sec": cold, "cold_total_sec": round(sum(cold.values()), 3),
                      "duckdb_oracle_sec": duck, "plan_checks": checks}))


if __name__ == "__main__":
    main()
