"""Physical-plan properties that must hold at any scale (checked on sf0.001 plans)."""

from __future__ import annotations

import re

import pytest

from periodstats.operators import features as feature_ops
from periodstats.plans import catalog
from periodstats.plans.warehouse import warehouse

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture(scope="module")
def wh(spark):
    w = warehouse(spark, SF)
    w.build_all()
    return w


def test_topn_is_take_ordered_with_pruned_pushed_scan(spark, wh):
    p = _plan(catalog.run("discovery_topn", spark, SF))
    assert "TakeOrderedAndProject" in p
    assert re.search(r"PartitionFilters: \[[^\n]*season#\d+ = 2000", p)
    assert "GreaterThanOrEqual(minutes,1000)" in p
    assert "Window" not in p  # group statistics come from an aggregate, not a window


def test_history_windows_share_one_exchange(spark, wh):
    g = wh.gold()
    wide = feature_ops.star_join_wide(g["fact_player_season_stats"], g["dim_player"],
                                      g["dim_team"], g["dim_season"], g["dim_position"],
                                      keep_key=True)
    p = _plan(feature_ops.build_features(wide)).split("\n\n")[0]
    assert len(re.findall(r"\+- Exchange \(", p)) == 1 and "BroadcastExchange" in p
    assert p.count("Window") >= 1 and p.count("Sort (") == 1


def test_no_unpartitioned_window_over_growing_tables(spark, wh):
    silver = wh.silver()
    from periodstats.operators import star
    players = star.dim_player(silver)  # numbering runs here (range partitioned)
    for df in (players, wh.read("fact_player_season_stats"),
               catalog.run("measure_value_rank", spark, SF)):
        # the only single-partition exchange allowed is over the per-partition count table
        # (at most #partitions rows) that turns local positions into global ones, and the one that
        # merges Spark's own join filter (a buffer of bounded size a task)
        for block in _plan(df).split("\n\n"):
            if "Arguments: SinglePartition" in block:
                assert "__cnt" in block or "[buf#" in block, block


def test_scores_broadcast_bounded_stats(spark, wh):
    p = _plan(catalog.run("position_zscores", spark, SF))
    assert re.search(r"BroadcastHashJoin LeftOuter BuildRight", p)
    assert "HashAggregate" in p


def test_measure_argmax_is_aggregate_not_window(spark, wh):
    for name in ("top_scorer_row", "season_leaders"):
        p = _plan(catalog.run(name, spark, SF))
        assert "Window" not in p
        assert re.search(r"(Hash|Sort|ObjectHash)Aggregate", p)


def test_bench_plan_checks_all_hold(spark, wh):
    from periodstats.plans.checks import plan_checks
    checks = plan_checks(spark, SF)
    assert checks and all(checks.values()), checks
