"""Cleaning layer: schema conformance, validity split, season-scoped teams, duplicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from fixtures import players_frame, teams_frame
from periodstats.operators import conform
from periodstats.spec import RAW_FIELDS


def _clean_rejected(spark, frames, teams):
    rows = conform.conformed_rows(frames, teams)
    clean, rejected = conform.split_clean_rejected(rows)
    return clean, rejected


def test_missing_xg_columns_become_null(spark, synthetic):
    frames, teams = synthetic
    assert "expected_goals" not in frames[0].columns
    clean, _ = _clean_rejected(spark, frames, teams)
    old = clean.where("season = '2019-20'")
    assert old.count() == 7
    assert old.where("expected_goals IS NOT NULL OR expected_assists IS NOT NULL "
                     "OR expected_goal_involvements IS NOT NULL").count() == 0
    assert dict(clean.dtypes)["expected_goals"] == "double"  # typed NULL, never void


def test_new_xg_columns_are_retained(spark, synthetic):
    clean, _ = _clean_rejected(spark, *synthetic)
    new = clean.where("season = '2023-24'")
    assert new.where("expected_goals IS NULL").count() == 0
    assert new.where("expected_goals < 0").count() == 0


def test_conform_drops_unknown_and_casts(spark):
    df = spark.createDataFrame([("7", "12", "x")], "code string, minutes string, extra string")
    out = conform.conform(df.withColumns({"season": F.lit("2023-24"),
                                          "ingest_seq": F.lit(1).cast("bigint")}))
    assert "extra" not in out.columns
    assert out.columns[:len(RAW_FIELDS)] == [n for n, _ in RAW_FIELDS]
    row = out.first()
    assert row.code == 7 and row.minutes == 12 and row.starts is None


def test_invalid_rows_are_rejected(spark):
    base = {c: 0 for c, _ in RAW_FIELDS}
    base.update({"web_name": "Valid", "first_name": "A", "second_name": "B", "influence": 50.0,
                 "creativity": 50.0, "threat": 50.0, "ict_index": 8.0,
                 "selected_by_percent": 5.0, "points_per_game": 6.0})
    for c in ("expected_goals", "expected_assists", "expected_goal_involvements"):
        base.pop(c)
    valid = dict(base, code=1, element_type=3, team=1, minutes=1000, now_cost=60)
    invalid = dict(base, code=2, web_name="Invalid", element_type=99, team=1, minutes=-5,
                   now_cost=0)
    frames = [players_frame(spark, "2023-24", [valid, invalid])]
    teams = teams_frame(spark, {"2023-24": {1: "Test FC"}})
    clean, rejected = _clean_rejected(spark, frames, teams)
    assert {r.code for r in clean.collect()} == {1}
    rej = rejected.collect()
    assert {r.code for r in rej} == {2}
    assert rej[0].reject_reason == "minutes,now_cost,position"


def test_null_minutes_is_rejected_not_lost(spark, synthetic):
    frames, teams = synthetic
    frames = [f.withColumn("minutes", F.when(F.col("code") == 401, None)
                           .otherwise(F.col("minutes"))) for f in frames]
    clean, rejected = _clean_rejected(spark, frames, teams)
    assert clean.count() + rejected.count() == 17
    assert rejected.where("code = 401").count() == 2


def test_team_id_mapping_is_season_specific(spark, synthetic):
    clean, _ = _clean_rejected(spark, *synthetic)
    names = {(r.season, r.team_name) for r in clean.where("team = 1").collect()}
    assert names == {("2019-20", "Ashford"), ("2023-24", "Corby")}


def test_duplicates_keep_first_valid_copy(spark, synthetic):
    frames, teams = synthetic
    first = frames[1]
    dup = first.where("code = 406").withColumns(
        {"ingest_seq": F.lit(100).cast("bigint"), "minutes": F.lit(1).cast("bigint")})
    bad = first.where("code = 407").withColumns(
        {"ingest_seq": F.lit(0).cast("bigint"), "now_cost": F.lit(0).cast("bigint")})
    clean, rejected = _clean_rejected(spark, [frames[0], first.unionByName(dup)
                                              .unionByName(bad)], teams)
    assert clean.count() == 17
    row = clean.where("code = 406 AND season = '2023-24'").first()
    assert row.minutes == 2430  # the first copy in file order
    reasons = {(r.code, r.reject_reason) for r in rejected.collect()}
    # an invalid earlier copy does not shadow the valid later one
    assert reasons == {(406, "duplicate"), (407, "now_cost")}


def test_hot_duplicate_key_keeps_exactly_one_row(spark, synthetic):
    """One (code, season) with thousands of copies: one clean row, every other copy rejected."""
    frames, teams = synthetic
    hot = frames[1].where("code = 411").select(
        *[c for c in frames[1].columns if c != "ingest_seq"],
        F.explode(F.sequence(F.lit(1000).cast("bigint"), F.lit(3999).cast("bigint")))
        .alias("ingest_seq"))
    clean, rejected = _clean_rejected(spark, [frames[0], frames[1].unionByName(hot)], teams)
    assert clean.count() == 17
    assert clean.where("code = 411 AND season = '2023-24'").first().ingest_seq == 10
    assert rejected.where("reject_reason = 'duplicate'").count() == 3000
