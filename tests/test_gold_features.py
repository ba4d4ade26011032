"""Star schema and feature table on the hand-made two-season fixture."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from periodstats.operators import features as feature_ops
from periodstats.operators import quality
from periodstats.plans.warehouse import GOLD_TABLES, Warehouse
from periodstats.spec import FEATURE_FIELDS


def _wh(spark, synthetic):
    frames, teams = synthetic
    return Warehouse(spark, None, frames=frames, teams=teams)


def test_star_schema_tables_and_counts(spark, synthetic):
    wh = _wh(spark, synthetic)
    gold = wh.gold()
    counts = {t: gold[t].count() for t in GOLD_TABLES}
    assert counts == {"dim_player": 12, "dim_team": 3, "dim_season": 2, "dim_position": 4,
                      "fact_player_season_stats": 17}
    fact = gold["fact_player_season_stats"]
    orph = {r.fk: r.orphan_rows for r in quality.orphans(fact, {
        "player": (gold["dim_player"], "player_key", "player_key"),
        "team": (gold["dim_team"], "team_key", "team_key"),
        "season": (gold["dim_season"], "season_key", "season_key"),
        "position": (gold["dim_position"], "position_key", "position_key")}).collect()}
    assert orph == {"player": 0, "team": 0, "season": 0, "position": 0}
    ids = sorted(r.fact_id for r in fact.select("fact_id").collect())
    assert ids == list(range(1, 18))
    for name, df in gold.items():
        df.createOrReplaceTempView(name)
    assert set(GOLD_TABLES) <= {t.name for t in spark.catalog.listTables()}


def test_feature_columns_and_values(spark, synthetic):
    feats = _wh(spark, synthetic).features()
    assert feats.columns == [n for n, _ in FEATURE_FIELDS] and len(feats.columns) == 63
    r = {(x.code, x.season): x for x in feats.collect()}
    assert len(r) == 17
    a, b = r[(403, "2019-20")], r[(403, "2023-24")]
    assert a.goals_per_90 == a.goals_scored / (a.minutes / 90.0)
    assert abs(a.goals_per_90 - 0.1) < 1e-12
    assert a.cost_millions == 4.8 and a.points_per_million == 20.0
    assert a.goals_minus_xg is None and b.goals_minus_xg == 0.25
    assert a.points_per_game_prev_season is None
    assert b.points_per_game_prev_season == a.points_per_game
    assert abs(b.points_per_game_yoy_change + 0.4) < 1e-12
    assert a.points_consistency_std is None
    assert abs(b.points_consistency_std - 0.4 / 2 ** 0.5) < 1e-12
    assert a.goals_per_90_trend_slope is None and abs(b.goals_per_90_trend_slope + 0.06) < 1e-12
    assert (a.seasons_of_history, b.seasons_of_history) == (1, 2)
    assert (a.has_previous_season, b.has_previous_season) == (False, True)
    assert (a.has_xg_data, b.has_xg_data) == (False, True)
    idle = r[(402, "2023-24")]  # no minutes: rates are undefined, not zero
    assert idle.minutes == 0 and idle.goals_per_90 is None and idle.points_per_90 is None
    assert idle.goals_minus_xg == -0.25 and idle.goals_minus_xg_per_90 is None


def test_history_order(spark, synthetic):
    feats = _wh(spark, synthetic).features()
    seq = quality.history_sequence(feats).collect()
    assert len(seq) == 12 and all(r.history_ok for r in seq)
    assert {r.code for r in seq if r.n_seasons == 2} == {401, 403, 406, 407, 410}


def test_integrity_gate_raises_on_planted_orphans(spark):
    rows = spark.createDataFrame([(1, 5), (1, 6), (9, 5), (None, 5)], "a bigint, b bigint")
    dim = spark.createDataFrame([(1,), (5,), (5,), (6,)], "k bigint")
    counts = quality.orphans(rows, {"a": (dim, "a", "k"), "b": (dim, "b", "k")})
    assert {r.fk: r.orphan_rows for r in counts.collect()} == {"a": 2, "b": 0}
    with pytest.raises(AssertionError):
        quality.assert_no_orphans(counts)


def test_table_diff_counts_copies(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "k int, v string")
    b = spark.createDataFrame([(1, None), (3, "x")], "k int, v string")
    assert quality.table_diff(a, b).first().diff_rows == 3
    assert quality.table_diff(a, a.limit(0)).first().diff_rows == 3
    assert quality.table_diff(a.limit(0), a.limit(0)).first().diff_rows == 0


def test_trend_slope_matches_least_squares_with_gaps(spark):
    """Expanding slope over non-NULL values against their rank, NULL below two values."""
    ys = [0.5, None, 0.9, 0.4, None, 1.3, 1.1]
    rows = [(7, 2000 + k, y, float(k)) for k, y in enumerate(ys)]
    df = spark.createDataFrame(rows, "player_key bigint, start_year bigint, goals_per_90 double, "
                                     "points_per_game double")
    w = feature_ops.Window.partitionBy("player_key").orderBy("start_year")
    up = w.rowsBetween(feature_ops.Window.unboundedPreceding, feature_ops.Window.currentRow)
    out = df.withColumn("x", F.count("goals_per_90").over(up)).withColumn(
        "slope", feature_ops._slope("goals_per_90", "x", up)).orderBy("start_year").collect()
    for k, r in enumerate(out):
        seen = [y for y in ys[:k + 1] if y is not None]
        if len(seen) < 2:
            assert r.slope is None
        else:
            expect = np.polyfit(np.arange(len(seen), dtype=float), np.array(seen), 1)[0]
            assert abs(r.slope - expect) < 1e-12


def test_rebuild_is_idempotent(spark, synthetic):
    frames, teams = synthetic
    first = Warehouse(spark, None, frames=frames, teams=teams)
    second = Warehouse(spark, None, frames=frames, teams=teams)
    for t in GOLD_TABLES:
        assert quality.table_diff(first.read(t), second.read(t)).first().diff_rows == 0


def test_reload_one_season_swaps_only_that_season(spark, synthetic):
    frames, teams = synthetic
    wh = Warehouse(spark, None, frames=frames, teams=teams)
    before = {(r.code, r.season): r.minutes for r in wh.silver().collect()}
    changed = frames[1].withColumn("minutes", F.col("minutes") + 1)
    wh._frames = [frames[0], changed]          # new files arrived for 2023-24
    wh.reload_seasons(["2023-24"])
    after = {(r.code, r.season): r.minutes for r in wh.silver().collect()}
    assert len(after) == 17 and wh.rejected().count() == 0
    assert all(after[k] == before[k] + (1 if k[1] == "2023-24" else 0) for k in before)
    fact = wh.read("fact_player_season_stats")
    assert fact.count() == 17 and fact.agg(F.sum("minutes")).first()[0] == sum(after.values())
    wh.reload_seasons(["2023-24"])              # idempotent
    assert {(r.code, r.season): r.minutes for r in wh.silver().collect()} == after


def test_bi_export_round_trips_every_table(spark, synthetic):
    from periodstats.session import scratch_path
    from periodstats.sources import export
    from periodstats.spec import (DIM_PLAYER_FIELDS, DIM_POSITION_FIELDS, DIM_SEASON_FIELDS,
                                  DIM_TEAM_FIELDS, FACT_FIELDS, struct_of)
    schemas = {"dim_player": DIM_PLAYER_FIELDS, "dim_team": DIM_TEAM_FIELDS,
               "dim_season": DIM_SEASON_FIELDS, "dim_position": DIM_POSITION_FIELDS,
               "fact_player_season_stats": FACT_FIELDS}
    gold = _wh(spark, synthetic).gold()
    paths = export.export_tables(gold, scratch_path(spark, "t-export"))
    for name, path in paths.items():
        back = export.read_exported(spark, path, struct_of(schemas[name]))
        assert quality.table_diff(gold[name], back).first().diff_rows == 0, name
    counts = {r.table_name: r.rows for r in export.count_rows(gold).collect()}
    assert counts["fact_player_season_stats"] == 17 and counts["dim_position"] == 4


def test_export_counts_rows_while_writing(spark, synthetic):
    from periodstats.session import scratch_path
    from periodstats.sources import export
    gold = _wh(spark, synthetic).gold()
    counts: dict[str, int] = {}
    export.export_tables(gold, scratch_path(spark, "t-export"), counts)
    assert counts == {"dim_player": 12, "dim_team": 3, "dim_season": 2, "dim_position": 4,
                      "fact_player_season_stats": 17}


def _two_seasons(spark):
    from fixtures import season_frames
    frames, teams = season_frames(spark)
    return Warehouse(spark, None, frames=frames, teams=teams)


def test_a_fact_with_orphans_is_not_published(spark, monkeypatch):
    """The write of the fact counts keys that did not resolve; the old Gold stays."""
    from periodstats.operators import star
    wh = _two_seasons(spark)
    facts = wh.read("fact_player_season_stats").count()
    assert facts == 17
    before = wh.layer("gold").current()
    build = star.fact_table
    monkeypatch.setattr(star, "fact_table", lambda *a: build(*a).withColumn(
        "team_key", F.when(F.col("fact_id") != 3, F.col("team_key"))))
    wh._built.discard("gold")
    with pytest.raises(AssertionError, match="team.: 1"):
        wh.read("dim_player")
    monkeypatch.undo()
    assert wh.layer("gold").current() == before
    again = Warehouse(spark, None, root=wh.root, frames=[], teams=None)
    again._built |= {"raw", "silver", "gold", "features"}  # reads what is published, builds nothing
    assert again.read("fact_player_season_stats").where("team_key IS NULL").count() == 0
    assert again.read("fact_player_season_stats").count() == facts
    wh.read("dim_player")  # the next build publishes
    assert wh.layer("gold").current()[0] == before[0] + 1


@pytest.mark.parametrize("dies_at", ["dim_player", "fact_player_season_stats"])
def test_a_gold_build_that_dies_leaves_the_old_tables(spark, monkeypatch, dies_at):
    wh = _two_seasons(spark)
    names = {t: wh.read(t).count() for t in ("dim_player", "dim_team", "fact_player_season_stats")}
    write = Warehouse._write_counted

    def dying(self, df, counts, path, by=None):
        if f"/{dies_at}/" in path:
            raise RuntimeError("lost")
        return write(self, df.limit(1), counts, path, by)
    monkeypatch.setattr(Warehouse, "_write_counted", dying)
    wh._built.discard("gold")
    with pytest.raises(RuntimeError, match="lost"):
        wh.read("dim_team")
    assert {t: wh._published(t).count() for t in names} == names


def test_feature_rows_come_in_order_and_one_file_holds_a_key(spark):
    wh = _two_seasons(spark)
    rows = [(r.season, r.position, r.code) for f in sorted(
        r.path for r in wh.feature_files().collect())
        for r in spark.read.parquet(f).withColumn("season", F.lit(f.split("season=")[1].split("/")[0]))
        .select("season", "position", "code").collect()]
    assert rows == sorted(rows) and len(rows) == 17
    season, position, code = rows[5]
    one = wh.feature_row(season, position, code)
    assert one.columns == wh.features().columns and one.first().code == code
    assert len(one.inputFiles()) == 1
    assert wh.feature_row(season, position, -1).isEmpty()


def test_metrics_are_those_of_the_writes(spark):
    wh = _two_seasons(spark)
    got = {(r.stage, r.season, r.metric): r.value for r in wh.metrics().collect()}
    clean = {r.season: r["count"] for r in wh.silver().groupBy("season").count().collect()}
    for s, n in clean.items():
        assert got["silver", s, "clean_rows"] == got["features", s, "feature_rows"] == n
        assert got["silver", s, "rejected_rows"] == 0
    assert got["silver", None, "total_clean_rows"] == got["features", None, "feature_rows"] == 17
    assert got["features", None, "players"] == wh.features().select("code").distinct().count()
    assert "Scan parquet" not in wh.metrics()._jdf.queryExecution().toString()


def test_sinks_are_compared_by_content(spark):
    from periodstats.session import scratch_path
    from periodstats.sources import export
    df = spark.createDataFrame([(1, 'He said "hi", ok', 0.1), (2, "two\nlines", -1e-300), (3, "", None),
                                (4, None, 1e300), (5, " edge ", float("inf")), (5, " edge ", float("inf"))],
                               "code bigint, name string, x double").repartition(3)
    path = scratch_path(spark, "t-sink") + "/t.csv"
    r = export.compared(spark, "t", df, path).first()
    assert (r.table_name, r.rows, r.same_rows, r.same_content) == ("t", 6, True, True)
    back = export.read_csv(spark, path, df.schema)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    other = back.withColumn("x", F.when(F.col("code") != 4, F.col("x")))
    one, two = (d.agg(export.fingerprint(d.columns).alias("f")).first().f for d in (df, other))
    assert one != two
