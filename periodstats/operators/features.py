"""Features: one model-ready row per player-season (63 columns).

Plan shape: the star join puts ``player_key`` on every fact row; all history windows are
partitioned by ``player_key`` (one-to-one with ``code``), so the history needs exactly one
exchange and one sort, shared by every window below, and if the player join is a sort-merge
join on ``player_key`` that exchange is the join's own. A player has at most one row per
period, so no history partition can grow with the data.

History semantics
* previous season = previous *present* season of the player (may skip years);
* consistency = expanding sample deviation, NULL below two values;
* trend slope = expanding least-squares slope of the non-NULL values against their rank
  among the non-NULL values so far (``x`` = running count), NULL below two values; a row
  whose own value is NULL still gets the slope of its past;
* every frame ends at the current row: a row only sees its past.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import nineties, nullif_zero, per_90
from ..spec import FEATURE_FIELDS, PER_90, WIDE_FIELDS

WIDE_COLUMNS = [n for n, _ in WIDE_FIELDS]
FEATURE_COLUMNS = [n for n, _ in FEATURE_FIELDS]


def star_join_wide(fact: DataFrame, players: DataFrame, teams: DataFrame, seasons: DataFrame,
                   positions: DataFrame, keep_key: bool = False) -> DataFrame:
    """fact ⋈ dim_player ⋈ dim_team ⋈ dim_season ⋈ dim_position (inner), wide rows."""
    pos = positions.select("position_key", F.col("position_code").alias("position"))
    joined = (
        fact.join(players.select("player_key", "code", "web_name"), "player_key")
        .join(teams, "team_key")
        .join(F.broadcast(seasons), "season_key")
        .join(F.broadcast(pos), "position_key")
    )
    cols = WIDE_COLUMNS + (["player_key"] if keep_key else [])
    return joined.select(*cols)


def _per_90_columns() -> dict:
    return {name: per_90(nums) for name, nums in PER_90}


def _slope(y: str, x: str, frame) -> "F.Column":
    # least-squares slope of y on x over the frame; NULL below two non-NULL values
    return F.when(F.col(x) >= 2, F.regr_slope(F.col(y), F.col(x)).over(frame))


def build_features(wide: DataFrame, entity: str = "player_key") -> DataFrame:
    n90 = nineties()
    df = wide.withColumns(_per_90_columns())
    df = df.withColumns({
        "goals_minus_xg": F.col("goals_scored") - F.col("expected_goals"),
        "assists_minus_xa": F.col("assists") - F.col("expected_assists"),
        "goal_involvements_minus_xgi":
            F.col("goals_scored") + F.col("assists") - F.col("expected_goal_involvements"),
    })
    df = df.withColumns({
        "goals_minus_xg_per_90": F.col("goals_minus_xg") / n90,
        "assists_minus_xa_per_90": F.col("assists_minus_xa") / n90,
        "goal_involvements_minus_xgi_per_90": F.col("goal_involvements_minus_xgi") / n90,
        "cost_millions": F.col("now_cost") / 10.0,
    })
    df = df.withColumn("points_per_million",
                       F.col("total_points") / nullif_zero("cost_millions"))

    hist = Window.partitionBy(entity).orderBy("start_year")
    upto = hist.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = df.withColumns({
        "points_per_game_prev_season": F.lag("points_per_game", 1).over(hist),
        "points_per_90_prev_season": F.lag("points_per_90", 1).over(hist),
        "points_consistency_std": F.stddev_samp("points_per_game").over(upto),
        "__x_goals": F.count("goals_per_90").over(upto),
        "__x_assists": F.count("assists_per_90").over(upto),
        "seasons_of_history": F.row_number().over(hist).cast("bigint"),
    })
    df = df.withColumns({
        "points_per_game_yoy_change":
            F.col("points_per_game") - F.col("points_per_game_prev_season"),
        "points_per_90_yoy_change": F.col("points_per_90") - F.col("points_per_90_prev_season"),
        "goals_per_90_trend_slope": _slope("goals_per_90", "__x_goals", upto),
        "assists_per_90_trend_slope": _slope("assists_per_90", "__x_assists", upto),
        "has_previous_season": F.col("seasons_of_history") >= 2,
        "has_xg_data": F.col("expected_goals").isNotNull(),
        "has_xa_data": F.col("expected_assists").isNotNull(),
    })
    return df.select(*FEATURE_COLUMNS)


def feature_counts(features: DataFrame) -> DataFrame:
    """Rows and exact distinct players of the feature table, per season and overall."""
    per = features.groupBy("season").agg(
        F.count(F.lit(1)).cast("bigint").alias("feature_rows"),
        F.count_distinct("code").cast("bigint").alias("players"))
    total = features.agg(
        F.count(F.lit(1)).cast("bigint").alias("feature_rows"),
        F.count_distinct("code").cast("bigint").alias("players")).select(
        F.lit("ALL").alias("season"), "feature_rows", "players")
    return per.unionByName(total)
