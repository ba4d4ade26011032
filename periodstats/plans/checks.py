"""Physical-plan properties that must hold at any scale, read from ``explain`` output."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..operators import features as feature_ops
from ..operators import star
from . import catalog
from .warehouse import warehouse


def plan_text(df: DataFrame) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def _tree(text: str) -> str:
    return text.split("\n\n")[0]


def single_partition_only_over_counts(text: str) -> bool:
    """Every single-partition exchange reads a per-partition count table (``__cnt``), or merges
    the buffers of Spark's own join filter."""
    return all("__cnt" in b or "[buf#" in b for b in text.split("\n\n")
               if "Arguments: SinglePartition" in b)


def plan_checks(spark: SparkSession, sf_dir: str) -> dict[str, bool]:
    wh = warehouse(spark, sf_dir)
    g = wh.gold()
    top = plan_text(catalog.run("discovery_topn", spark, sf_dir))
    wide = feature_ops.star_join_wide(g["fact_player_season_stats"], g["dim_player"],
                                      g["dim_team"], g["dim_season"], g["dim_position"],
                                      keep_key=True)
    hist = _tree(plan_text(feature_ops.build_features(wide)))
    argmax = [plan_text(catalog.run(n, spark, sf_dir)) for n in ("top_scorer_row",
                                                                 "season_leaders")]
    grown = [plan_text(star.dim_player(wh.silver())), plan_text(g["fact_player_season_stats"]),
             plan_text(catalog.run("measure_value_rank", spark, sf_dir))]
    return {
        "topn_is_take_ordered": "TakeOrderedAndProject" in top,
        "cohort_season_partition_pruned": bool(
            re.search(r"PartitionFilters: \[[^\n]*season#\d+ = ", top)),
        "cohort_minutes_pushed_to_scan": "GreaterThanOrEqual(minutes,1000)" in top,
        "scores_without_window": "Window" not in _tree(top),
        "history_one_shuffle": len(re.findall(r"\+- Exchange \(", hist)) == 1,
        "argmax_without_window": all("Window" not in _tree(t) for t in argmax),
        "no_single_task_window_on_growing_tables": all(
            single_partition_only_over_counts(t) for t in grown),
    }
