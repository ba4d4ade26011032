"""End-to-end: five seasons (three copied from the newest layout), landing through metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from fixtures import SEASONS, season_frames
from periodstats.plans import runner
from periodstats.plans.warehouse import Warehouse
from periodstats.sources import landing
from periodstats.spec import Spec

FIVE = ["2019-20", "2020-21", "2021-22", "2022-23", "2023-24"]


def test_end_to_end_run(spark):
    frames, teams = season_frames(spark)
    newest, newest_teams = frames[1], teams.where(F.col("season") == SEASONS[1])
    extra = [newest.withColumn("season", F.lit(s)) for s in FIVE[1:4]]
    extra_teams = [newest_teams.withColumn("season", F.lit(s)) for s in FIVE[1:4]]
    all_teams = teams
    for t in extra_teams:
        all_teams = all_teams.unionByName(t)
    spec = Spec(n_clusters=3, kmeans_restarts=2)
    wh = Warehouse(spark, None, frames=[frames[0], newest, *extra], teams=all_teams, spec=spec)
    metrics = {(r.stage, r.metric): r.value
               for r in runner.run(spark, None, "2023-24", spec, wh=wh).collect()}
    assert metrics[("silver", "seasons_processed")] == 5
    assert metrics[("silver", "total_clean_rows")] == 7 + 4 * 10
    assert metrics[("silver", "total_rejected_rows")] == 0
    assert metrics[("gold", "fact_player_season_stats_rows")] == 47
    assert metrics[("gold", "orphaned_fact_rows")] == 0
    assert metrics[("features", "feature_rows")] == 47
    assert metrics[("ml", "clustered_players")] == 4  # the others' groups are too small
    hist = {r.code: r.n_seasons for r in
            __import__("periodstats.operators.quality", fromlist=["x"])
            .history_sequence(wh.features()).collect()}
    assert hist == dict.fromkeys((401, 403, 406, 407, 410), 5) | dict.fromkeys(
        (402, 405, 408, 409, 411), 4) | {404: 1, 412: 1}
    files = {(r.season, r.file) for r in landing.read_files(spark, wh.path("bronze")).collect()}
    assert len(files) == 10
