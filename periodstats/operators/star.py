"""Gold: a star schema (four dimensions + one fact) built from the clean Silver rows.

Keys are dense 1..n over the sorted business keys, renumbered on every rebuild.
* ``dim_season`` / ``dim_team``: a ranking window over the *distinct* members; their count is
  the number of periods / clubs, small by nature, so one task is enough.
* ``dim_player`` and ``fact_id``: can be as large as the data, so they use the range-partition
  numbering of ``plans.numbering`` (no single-partition window).
* Latest known player attributes: ``max_by(attr, season)`` restricted to non-NULL values of
  that attribute, a partial aggregate (``last`` skips NULLs per column).
* Fact -> dimension lookups: position (4 literal rows) and season (one row per period) are
  broadcast by hint; player and team are left to the planner, which broadcasts only when the
  measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and sort-merges otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.numbering import row_numbers
from ..spec import DIM_POSITION_FIELDS, FACT_FIELDS, POSITION_ROWS, struct_of

FACT_COLUMNS = [n for n, _ in FACT_FIELDS]


def dim_position(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(POSITION_ROWS, struct_of(DIM_POSITION_FIELDS))


def dim_season(silver: DataFrame) -> DataFrame:
    members = silver.select("season").distinct()
    return members.select(
        F.row_number().over(Window.orderBy("season")).cast("bigint").alias("season_key"),
        "season",
        F.substring("season", 1, 4).cast("bigint").alias("start_year"),
    )


def dim_team(silver: DataFrame) -> DataFrame:
    members = silver.select("team_name").where(F.col("team_name").isNotNull()).distinct()
    return members.select(
        F.row_number().over(Window.orderBy("team_name")).cast("bigint").alias("team_key"),
        "team_name",
    )


def _latest(c: str):
    # value of ``c`` from the latest season in which it is not NULL
    return F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("season"))).alias(c)


def latest_player_attributes(silver: DataFrame) -> DataFrame:
    return silver.groupBy("code").agg(_latest("web_name"), _latest("first_name"),
                                      _latest("second_name"))


def dim_player(silver: DataFrame) -> DataFrame:
    names = latest_player_attributes(silver)
    keyed = row_numbers(names, [F.col("code")], "player_key")
    return keyed.select("player_key", "code", "web_name", "first_name", "second_name")


def fact_table(silver: DataFrame, players: DataFrame, teams: DataFrame, seasons: DataFrame,
               positions: DataFrame) -> DataFrame:
    """One row per player-season with four foreign keys and the measures; ``fact_id`` runs
    1..n in Silver order: season, then file order (``ingest_seq``), ``code`` breaking ties."""
    pos = positions.select(F.col("position_code").alias("position"), "position_key")
    joined = (
        silver.join(players.select("code", "player_key"), "code", "left")
        .join(teams, "team_name", "left")
        .join(F.broadcast(seasons.select("season", "season_key")), "season", "left")
        .join(F.broadcast(pos), "position", "left")
    )
    order = [F.col("season"), F.col("ingest_seq"), F.col("code")]
    numbered = row_numbers(joined, order, "fact_id")
    return numbered.select(*FACT_COLUMNS)
