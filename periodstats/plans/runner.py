"""End-to-end run: land -> clean -> model -> integrity gate -> features -> scores and
clusters -> BI export -> run metrics. Every stage is a Spark job over the whole input; the
metrics are those that the writing jobs observed.

usage: python -m periodstats.plans.runner <sf_dir> [season]
       python -m periodstats.plans.runner --raw-root <dir> --seasons 2019-20,2020-21 [season]
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import scoring
from ..sources import export
from ..spec import Spec
from .warehouse import METRICS, Warehouse


def run(spark: SparkSession, sf_dir: str, season: str = "2000", spec: Spec = Spec(),
        wh: Warehouse | None = None) -> DataFrame:
    """Run every stage; returns the run metrics (stage, season or null for all, metric, value)."""
    wh = wh or Warehouse(spark, sf_dir, spec=spec)
    wh.landing()                     # raw season files -> Bronze (fails fast on a gap)
    gold = wh.gold()                 # Silver and Gold; a fact with orphans is not published
    # quarantine as CSV, overwritten every run (no stale file survives a clean rerun)
    rejected = export.write_csv(wh.rejected(), wh.path("rejected_rows.csv"))
    features = wh.features()
    clusters = wh.clusters(season, spec.n_clusters)
    seen = Observation()
    counted = clusters.observe(seen, F.count_if(F.col("cluster") >= 0).alias("clustered"))
    export.write_csv(counted, wh.path(f"player_style_clusters_{season}.csv"))
    outliers = scoring.detect_value_outliers(features, season, spec=spec)
    top = export.write_csv(outliers, wh.path(f"hidden_talent_{season}.csv"), one_file=True)
    exported: dict[str, int] = {}
    export.export_tables(gold, wh.path("bi_export"), exported)  # rows counted while written
    rest = [("silver", None, "rejected_rows_written", rejected["rows"]),
            ("ml", season, "clustered_players", seen.get["clustered"]),
            ("ml", season, "value_outliers", top["rows"]),
            *[("export", None, f"{t}_rows", n) for t, n in exported.items()]]
    metrics = wh.metrics().unionByName(spark.createDataFrame(rest, METRICS))
    metrics.coalesce(1).write.mode("overwrite").json(wh.path("run_metrics"))
    return spark.read.schema(metrics.schema).json(wh.path("run_metrics"))


def main() -> None:
    import argparse

    from ..session import local_session
    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("sf_dir", nargs="?", default="/root/testdata/sf0.01")
    ap.add_argument("season", nargs="?", default=None)
    ap.add_argument("--raw-root", default=None, help="folder of <season>/<file>.csv trees")
    ap.add_argument("--seasons", default=None, help="comma-separated expected seasons")
    args = ap.parse_args()
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    if args.raw_root:
        seasons = args.seasons.split(",")
        wh = Warehouse(spark, None, raw_root=args.raw_root, seasons=seasons)
        out = run(spark, None, args.season or seasons[-1], wh=wh)
    else:
        out = run(spark, args.sf_dir, args.season or "2000")
    for r in out.collect():
        print(json.dumps(r.asDict()))


if __name__ == "__main__":
    main()
