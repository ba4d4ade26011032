"""BI measures over the star schema, each a function of the slicer columns ``by``.

Measures work on the fact's keys: rows are aggregated, ranked or picked before any dimension is
joined, so names are looked up for the few rows that are left. ``cube`` gives all measures for
every set of slicers in one pass.

Skew notes: every measure is a partial+final aggregate; the arg-max row per season is a
``max_by`` aggregate (not a window over a whole season); leaders with ties compare with a
per-season maximum broadcast back (one row per season); the value rank uses the
range-partitioned rank of ``plans.numbering``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import safe_divide
from ..plans.numbering import ranks


def bi_rows(fact: DataFrame, players: DataFrame, teams: DataFrame, seasons: DataFrame,
            positions: DataFrame) -> DataFrame:
    """fact ⋈ dim_player ⋈ dim_season (+ team, position) keeping the fact keys."""
    pos = positions.select("position_key", F.col("position_code").alias("position"))
    return (fact.join(players.select("player_key", "code", "web_name"), "player_key")
            .join(teams, "team_key")
            .join(F.broadcast(seasons), "season_key")
            .join(F.broadcast(pos), "position_key"))


def slicer_rows(fact: DataFrame, seasons: DataFrame, positions: DataFrame) -> DataFrame:
    """fact with season and position only, for measures that name no player or team."""
    pos = positions.select("position_key", F.col("position_code").alias("position"))
    return (fact.join(F.broadcast(seasons), "season_key")
            .join(F.broadcast(pos), "position_key"))


def totals(rows: DataFrame, by=("season",)) -> DataFrame:
    """Total Goals = SUM(goals_scored); Total Points = SUM(total_points)."""
    return rows.groupBy(*by).agg(F.sum("goals_scored").cast("bigint").alias("total_goals"),
                                 F.sum("total_points").cast("bigint").alias("total_points"))


def goals_per_90(rows: DataFrame, by=("season",)) -> DataFrame:
    """DIVIDE(SUM(goals), DIVIDE(SUM(minutes), 90), 0): a ratio of sums, 0 when undefined."""
    agg = rows.groupBy(*by).agg(F.sum("goals_scored").alias("g"), F.sum("minutes").alias("m"))
    return agg.select(*by, safe_divide(F.col("g"), safe_divide(F.col("m"), F.lit(90.0)), 0.0)
                      .cast("double").alias("goals_per_90"))


def top_scorer_points(rows: DataFrame, by=("season",)) -> DataFrame:
    """MAX(total_points) keeping only the season filter: other slicers do not change it.

    The maximum per season (one row a season) is given to every group of ``by``; without
    ``season`` among the slicers it is the maximum of all seasons."""
    best = F.max("total_points").cast("bigint").alias("top_scorer_points")
    if "season" not in by:
        return rows.select(*by).distinct().select(
            *by, F.lit(rows.agg(best).first()[0]).cast("bigint").alias("top_scorer_points"))
    return rows.select(*by).distinct().join(rows.groupBy("season").agg(best), "season") \
        .select(*by, "top_scorer_points")


def top_scorer_row(rows: DataFrame, players: DataFrame, by=("season",)) -> DataFrame:
    """Name and points of the top scorer under ``by``; the lowest ``fact_id`` wins a tie.

    ``rows`` carry ``player_key``; names are joined to the one row a group that is left."""
    order = F.struct(F.col("total_points"), (-F.col("fact_id")).alias("neg_id"))
    best = rows.groupBy(*by).agg(F.max_by("player_key", order).alias("player_key"),
                                 F.max("total_points").cast("bigint").alias("total_points"))
    return _named(best, players).select(*by, "web_name", "total_points")


def _named(few: DataFrame, players: DataFrame) -> DataFrame:
    return few.join(players.select("player_key", "code", "web_name"), "player_key")


def season_over_season(rows: DataFrame, by=()) -> DataFrame:
    """Season points minus the previous *calendar* season's points (missing counts as 0), under
    the other slicers ``by``."""
    by = list(by)
    cur = rows.groupBy("season", "start_year", *by).agg(
        F.sum("total_points").cast("bigint").alias("season_points"))
    prev = cur.select((F.col("start_year") + 1).alias("__year"), *[F.col(c).alias(f"__{c}") for c in by],
                      F.col("season_points").alias("previous_season_points"))
    same = F.col("start_year") == F.col("__year")
    for c in by:  # a slicer value may be NULL
        same &= F.col(c).eqNullSafe(F.col(f"__{c}"))
    out = cur.join(prev, same, "left")  # one row per season and group on both sides
    return out.select("season", "start_year", *by, "season_points", "previous_season_points",
                      (F.col("season_points") - F.coalesce("previous_season_points", F.lit(0)))
                      .cast("bigint").alias("points_change"))


def cube(fact: DataFrame, seasons: DataFrame, positions: DataFrame, teams: DataFrame) -> DataFrame:
    """All measures for every set of the slicers season, position and team (NULL: not sliced).

    One pass over the fact's keys and three measures; names are joined to the groups that are
    left. ``top_scorer_points`` keeps only the season filter (ALLEXCEPT): it comes from the level
    that has no other slicer. ``points_change`` compares with the same group a calendar year
    before, and is NULL where no season is chosen."""
    keys = ["season_key", "position_key", "team_key"]
    groups = fact.cube(*keys).agg(
        F.sum("goals_scored").cast("bigint").alias("total_goals"),
        F.sum("total_points").cast("bigint").alias("total_points"),
        F.sum("minutes").cast("bigint").alias("minutes"),
        F.max("total_points").cast("bigint").alias("__best"), F.grouping_id().alias("level"))
    best = groups.where(F.col("level").isin(3, 7)).select(
        F.col("season_key").alias("__s"), F.col("__best").alias("top_scorer_points"))
    years = seasons.select("season_key", "season", "start_year")
    out = (groups.join(F.broadcast(best), F.col("season_key").eqNullSafe(F.col("__s")))
           .join(F.broadcast(years), "season_key", "left")
           .join(F.broadcast(positions.select("position_key", F.col("position_code").alias("position"))),
                 "position_key", "left")
           .join(teams, "team_key", "left"))
    before = out.where("start_year IS NOT NULL").select(
        (F.col("start_year") + 1).alias("__year"), F.col("position_key").alias("__p"),
        F.col("team_key").alias("__t"), F.col("total_points").alias("__before"))
    same = ((F.col("start_year") == F.col("__year")) & F.col("position_key").eqNullSafe(F.col("__p"))
            & F.col("team_key").eqNullSafe(F.col("__t")))
    out = out.join(before, same, "left")
    change = F.when(F.col("start_year").isNotNull(),
                    F.col("total_points") - F.coalesce("__before", F.lit(0)))
    per_90 = safe_divide(F.col("total_goals"), safe_divide(F.col("minutes"), F.lit(90.0)), 0.0)
    return out.select("season", "position", "team_name", "total_goals", "total_points",
                      per_90.cast("double").alias("goals_per_90"), "top_scorer_points",
                      change.cast("bigint").alias("points_change"))


def value_column(rows: DataFrame) -> DataFrame:
    """Value = total_points / (now_cost / 10); NULL when the cost is 0."""
    return rows.withColumn("value", safe_divide(F.col("total_points"),
                                                F.col("now_cost") / 10.0))


def value_rank(rows: DataFrame, by=("season",)) -> DataFrame:
    """RANKX by value, descending; ties share a rank, gaps follow; one row per player-season."""
    return ranks(value_column(rows), list(by), "value", "value_rank", descending=True)


def value_top(rows: DataFrame, players: DataFrame, season: str, n: int = 5) -> DataFrame:
    """nlargest(n, value) within one season; the lowest ``fact_id`` wins a tie."""
    v = value_column(rows.where(F.col("season") == season))
    top = v.orderBy(F.col("value").desc_nulls_last(), F.col("fact_id")).limit(n)
    return _named(top, players).select("web_name", "total_points", "now_cost", "value")


def season_leaders(rows: DataFrame, players: DataFrame, measure: str = "goals_scored",
                   by=("season",)) -> DataFrame:
    """Every player level with the maximum of ``measure`` under ``by`` (ties all kept)."""
    best = rows.groupBy(*by).agg(F.max(measure).alias("__best"))
    out = rows.join(F.broadcast(best) if list(by) == ["season"] else best, list(by))
    few = out.where(F.col(measure) == F.col("__best"))
    return _named(few, players).select(*by, "code", "web_name", measure)
