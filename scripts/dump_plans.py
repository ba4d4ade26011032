"""Write the formatted physical plan of each layer build and headline query to docs/plans/.

usage: python scripts/dump_plans.py [sf_dir]
"""
from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from periodstats.operators import conform, features, star  # noqa: E402
from periodstats.plans import catalog  # noqa: E402
from periodstats.plans.warehouse import warehouse  # noqa: E402
from periodstats.session import local_session  # noqa: E402
from periodstats.sources import binding  # noqa: E402

QUERIES = ["discovery_topn", "position_zscores", "measure_value_rank", "top_scorer_row",
           "season_leaders", "history_sequence", "orphans_by_fk", "transfer_history",
           "cluster_inputs", "silver_from_files"]


def plan(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    out = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs",
                       "plans")
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    wh = warehouse(spark, sf)
    wh.build_all()
    g = wh.gold()
    layers = {
        "layer_supplier_years": binding.supplier_years(spark, sf),
        "layer_raw_rows": conform.union_seasons(wh.raw_frames()),
        "layer_silver_status": conform.silver_status(wh.conformed()),
        "layer_fact": star.fact_table(wh.silver(), g["dim_player"], g["dim_team"],
                                      g["dim_season"], g["dim_position"]),
        "layer_features": features.build_features(features.star_join_wide(
            g["fact_player_season_stats"], g["dim_player"], g["dim_team"], g["dim_season"],
            g["dim_position"], keep_key=True)),
    }
    for name, df in layers.items():
        with open(os.path.join(out, f"{name}.txt"), "w") as f:
            f.write(plan(df))
    for name in QUERIES:
        with open(os.path.join(out, f"{name}.txt"), "w") as f:
            f.write(plan(catalog.run(name, spark, sf)))


if __name__ == "__main__":
    main()
