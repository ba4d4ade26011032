"""Silver extras, Gold dimensions and counts, quality checks, feature projections, scores and
BI measures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import conform as silver_ops
from ..operators import features as feature_ops
from ..operators import measures, quality, scoring
from ..session import scratch_path
from ..sources.binding import LAYOUT_CHANGE_YEAR
from ..spec import (RAW_FIELDS, DIM_PLAYER_FIELDS, DIM_POSITION_FIELDS, DIM_SEASON_FIELDS, DIM_TEAM_FIELDS,
                    FEATURE_FIELDS, PER_90, RESIDUAL_FIELDS, SILVER_FIELDS, WIDE_FIELDS, B, D, L,
                    S)
from . import oracle as O
from .catalog import SEASON, SPEC, register
from .warehouse import GOLD_TABLES, warehouse

W = O.with_ctes
FT = dict(FEATURE_FIELDS)
ST = dict(SILVER_FIELDS)


def _feat(names):
    return [("code", L), ("season", S)] + [(n, FT[n]) for n in names]


# ----------------------------------------------------------------------------- Silver
@register("silver_conformed", SILVER_FIELDS,
          W(O.SILVER, f"SELECT {O.SILVER_COLS} FROM conformed"))
def silver_conformed(spark, sf):
    return warehouse(spark, sf).conformed()


@register("silver_counts", [("season", S), ("clean_rows", L), ("rejected_rows", L)], W(O.SILVER, """
SELECT season, count_if(ok) AS clean_rows, count_if(NOT ok) AS rejected_rows
FROM (SELECT season, true AS ok FROM clean UNION ALL SELECT season, false FROM rejected)
GROUP BY season"""))
def silver_counts(spark, sf):
    wh = warehouse(spark, sf)
    return silver_ops.season_counts(wh.silver(), wh.rejected())


@register("silver_summary", [("total_clean_rows", L), ("total_rejected_rows", L),
                             ("seasons_processed", L)], W(O.SILVER, """
SELECT count_if(ok) AS total_clean_rows, count_if(NOT ok) AS total_rejected_rows,
  count(DISTINCT season) FILTER (WHERE ok) AS seasons_processed
FROM (SELECT season, true AS ok FROM clean UNION ALL SELECT season, false FROM rejected)"""))
def silver_summary(spark, sf):
    wh = warehouse(spark, sf)
    both = wh.silver().select("season", F.lit(True).alias("ok")).unionByName(
        wh.rejected().select("season", F.lit(False).alias("ok")))
    return both.agg(F.count_if("ok").alias("total_clean_rows"),
                    F.count_if(~F.col("ok")).alias("total_rejected_rows"),
                    F.count_distinct(F.when(F.col("ok"), F.col("season")))
                    .alias("seasons_processed"))


@register("xg_available_seasons", [("season", S), ("has_xg_data", B), ("by_year_rule", B)],
          W(O.SILVER, f"""
SELECT season, count(expected_goals) > 0 AS has_xg_data,
  season_start_year >= {LAYOUT_CHANGE_YEAR} AS by_year_rule
FROM clean GROUP BY season, season_start_year"""))
def xg_available_seasons(spark, sf):
    return silver_ops.xg_available_seasons(warehouse(spark, sf).silver(), LAYOUT_CHANGE_YEAR)


@register("silver_roundtrip", SILVER_FIELDS,
          W(O.SILVER, f"SELECT {O.SILVER_COLS} FROM clean"))
def silver_roundtrip(spark, sf):
    """Write the clean rows partitioned by season, read them back."""
    path = scratch_path(spark, "silver-roundtrip")
    clean = warehouse(spark, sf).silver()
    clean.write.mode("overwrite").partitionBy("season").parquet(path)
    return spark.read.schema(clean.schema).parquet(path).select(*clean.columns)


@register("team_lookup_by_season", [("season", S), ("team", L), ("team_name", S)],
          W(O.SILVER, "SELECT DISTINCT season, team, team_name FROM clean"))
def team_lookup_by_season(spark, sf):
    return warehouse(spark, sf).silver().select("season", "team", "team_name").distinct()


@register("team_id_reuse", [("team", L), ("seasons", L), ("team_names", L)], W(O.SILVER, """
SELECT team, count(DISTINCT season) AS seasons, count(DISTINCT team_name) AS team_names
FROM clean GROUP BY team"""))
def team_id_reuse(spark, sf):
    return quality.team_id_reuse(warehouse(spark, sf).silver())


@register("grain_duplicates", [("code", L), ("season", S), ("copies", L)], W(O.SILVER, """
SELECT code, season, count(*) AS copies FROM status WHERE is_valid
GROUP BY code, season HAVING count(*) > 1"""))
def grain_duplicates(spark, sf):
    valid = silver_ops.with_validity(warehouse(spark, sf).conformed()).where("is_valid")
    return quality.grain_duplicates(valid)


@register("team_lookup_duplicates", [("season", S), ("id", L), ("copies", L)], W(O.SILVER, """
SELECT season, team AS id, count(*) AS copies FROM teams GROUP BY season, team
HAVING count(*) > 1"""))
def team_lookup_duplicates(spark, sf):
    """A team file repeating an id would duplicate player rows in the lookup join."""
    return quality.grain_duplicates(warehouse(spark, sf).read("raw_teams"), ("season", "id"))


_RAW_COLS = [n for n, _ in RAW_FIELDS]


@register("silver_missing_cols", [("season", S), ("column_name", S)], W(O.SILVER, " UNION ALL ".join(
    f"SELECT season, '{c}' AS column_name FROM raw GROUP BY season HAVING count({c}) = 0"
    for c in _RAW_COLS)))
def silver_missing_cols(spark, sf):
    """Declared columns with no value at all in a season (absent from that season's files)."""
    per = warehouse(spark, sf).read("raw_rows").groupBy("season").agg(
        *[F.count(c).alias(c) for c in _RAW_COLS])
    long = per.unpivot("season", _RAW_COLS, "column_name", "non_null")
    return long.where(F.col("non_null") == 0).select("season", "column_name")


_NULLCOLS = ["starts", "expected_goals", "expected_assists", "expected_goal_involvements"]


@register("xg_null_profile", [("season", S), ("rows", L)] + [(f"{c}_non_null", L)
                                                             for c in _NULLCOLS],
          W(O.SILVER, "SELECT season, count(*) AS rows, " + ", ".join(
              f"count({c}) AS {c}_non_null" for c in _NULLCOLS) + " FROM clean GROUP BY season"))
def xg_null_profile(spark, sf):
    return quality.null_profile(warehouse(spark, sf).silver(), _NULLCOLS)


# ----------------------------------------------------------------------------- Gold
def _dim(name, fields):
    @register(name, fields, W(O.GOLD, f"SELECT * FROM {name}"))
    def q(spark, sf):
        return warehouse(spark, sf).read(name)
    return q


for _n, _f in (("dim_season", DIM_SEASON_FIELDS), ("dim_team", DIM_TEAM_FIELDS),
               ("dim_player", DIM_PLAYER_FIELDS)):
    _dim(_n, _f)


@register("dim_position", DIM_POSITION_FIELDS + [("fact_rows", L)], W(O.GOLD, """
SELECT d.position_key, d.position_code, d.position_name, count(f.fact_id) AS fact_rows
FROM dim_position d LEFT JOIN fact f ON f.position_key = d.position_key
GROUP BY d.position_key, d.position_code, d.position_name"""))
def dim_position(spark, sf):
    """The literal position dimension (all members, used or not) with its fact usage."""
    g = warehouse(spark, sf).gold()
    used = g["fact_player_season_stats"].groupBy("position_key").agg(
        F.count(F.lit(1)).alias("fact_rows"))  # one row per position
    return g["dim_position"].join(F.broadcast(used), "position_key", "left") \
        .fillna(0, ["fact_rows"])

_GOLD_SQL_NAMES = {"dim_player": "dim_player", "dim_team": "dim_team",
                   "dim_season": "dim_season", "dim_position": "dim_position",
                   "fact_player_season_stats": "fact"}
_COUNTS_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS rows FROM {s}" for t, s in _GOLD_SQL_NAMES.items())


def _table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(t).alias("table_name"), "rows")
             for t, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


@register("gold_counts", [("table_name", S), ("rows", L)], W(O.GOLD, _COUNTS_SQL + """
UNION ALL SELECT 'orphaned_fact_rows', count(*) FROM fact f
  LEFT JOIN dim_player p ON f.player_key = p.player_key WHERE p.player_key IS NULL"""))
def gold_counts(spark, sf):
    gold = warehouse(spark, sf).gold()
    orph = quality.orphans(gold["fact_player_season_stats"],
                           {"orphaned_fact_rows": (gold["dim_player"], "player_key",
                                                   "player_key")})
    return _table_counts(gold).unionByName(
        orph.select(F.col("fk").alias("table_name"), F.col("orphan_rows").alias("rows")))


@register("gold_tables", [("table_name", S), ("rows", L)], W(O.GOLD, _COUNTS_SQL))
def gold_tables(spark, sf):
    """The tables that the storage of the published Gold holds, by name, with their rows."""
    wh = warehouse(spark, sf)
    wh.gold()
    listed = [*wh.layer("gold").tables(), "dim_position"]  # the latter is literal
    if missing := set(GOLD_TABLES) - set(listed):
        raise AssertionError(f"tables missing from the storage: {sorted(missing)}")
    for name in listed:
        wh.read(name).createOrReplaceTempView(name)
    return _table_counts({t: spark.sql(f"SELECT * FROM {t}") for t in listed})


_ORPHAN_SQL = " UNION ALL ".join(
    f"SELECT '{n}' AS fk, count(*) AS orphan_rows FROM fact f LEFT JOIN {d} d "
    f"ON f.{k} = d.{k} WHERE d.{k} IS NULL"
    for n, d, k in (("player", "dim_player", "player_key"), ("team", "dim_team", "team_key"),
                    ("season", "dim_season", "season_key"),
                    ("position", "dim_position", "position_key")))


def _fact_checks(gold):
    return {"player": (gold["dim_player"], "player_key", "player_key"),
            "team": (gold["dim_team"], "team_key", "team_key"),
            "season": (gold["dim_season"], "season_key", "season_key"),
            "position": (gold["dim_position"], "position_key", "position_key")}


@register("orphans_by_fk", [("fk", S), ("orphan_rows", L)], W(O.GOLD, _ORPHAN_SQL))
def orphans_by_fk(spark, sf):
    gold = warehouse(spark, sf).gold()
    counts = quality.orphans(gold["fact_player_season_stats"], _fact_checks(gold))
    return counts


_QORPHAN_SQL = " UNION ALL ".join(
    f"SELECT '{n}' AS fk, count(*) AS orphan_rows FROM rejected r LEFT JOIN {d} d "
    f"ON r.{rk} = d.{dk} WHERE d.{dk} IS NULL"
    for n, d, rk, dk in (("player", "dim_player", "code", "code"),
                         ("team", "dim_team", "team_name", "team_name"),
                         ("season", "dim_season", "season", "season"),
                         ("position", "dim_position", "position", "position_code")))


@register("quarantine_orphans", [("fk", S), ("orphan_rows", L)], W(O.GOLD, _QORPHAN_SQL))
def quarantine_orphans(spark, sf):
    """The orphan check on rows that do have unresolvable keys: quarantined rows against the
    Gold dimensions on business keys."""
    wh = warehouse(spark, sf)
    gold = wh.gold()
    return quality.orphans(wh.rejected(), {
        "player": (gold["dim_player"], "code", "code"),
        "team": (gold["dim_team"], "team_name", "team_name"),
        "season": (gold["dim_season"], "season", "season"),
        "position": (gold["dim_position"], "position", "position_code")})


@register("row_conservation", [("raw_rows", L), ("clean_rows", L), ("rejected_rows", L),
                               ("fact_rows", L), ("feature_rows", L), ("nothing_lost", B),
                               ("fact_matches_silver", B), ("features_match_silver", B)],
          W(O.FEATURES, """
SELECT r AS raw_rows, c AS clean_rows, j AS rejected_rows, f AS fact_rows, x AS feature_rows,
  c + j = r AS nothing_lost, f = c AS fact_matches_silver, x = c AS features_match_silver
FROM (SELECT (SELECT count(*) FROM raw) r, (SELECT count(*) FROM clean) c,
  (SELECT count(*) FROM rejected) j, (SELECT count(*) FROM fact) f,
  (SELECT count(*) FROM features) x)"""))
def row_conservation(spark, sf):
    wh = warehouse(spark, sf)
    parts = {"r": wh.conformed(), "c": wh.silver(), "j": wh.rejected(),
             "f": wh.read("fact_player_season_stats"), "x": wh.features()}
    counts = reduce(DataFrame.unionByName, [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("k"), "n")
        for k, df in parts.items()])
    v = {k: F.sum(F.when(F.col("k") == k, F.col("n"))) for k in parts}
    one = counts.agg(*[c.alias(k) for k, c in v.items()])
    return one.select(
        F.col("r").alias("raw_rows"), F.col("c").alias("clean_rows"),
        F.col("j").alias("rejected_rows"), F.col("f").alias("fact_rows"),
        F.col("x").alias("feature_rows"),
        (F.col("c") + F.col("j") == F.col("r")).alias("nothing_lost"),
        (F.col("f") == F.col("c")).alias("fact_matches_silver"),
        (F.col("x") == F.col("c")).alias("features_match_silver"))


@register("history_sequence", [("code", L), ("n_seasons", L), ("history_ok", B)],
          W(O.FEATURES, """
SELECT code, count(*) AS n_seasons,
  list(seasons_of_history ORDER BY start_year) = generate_series(1, count(*)) AS history_ok
FROM features GROUP BY code"""))
def history_sequence(spark, sf):
    return quality.history_sequence(warehouse(spark, sf).features())


@register("rebuild_idempotent", [("table_name", S), ("rows", L), ("diff_rows", L)],
          W(O.GOLD, "SELECT table_name, rows, 0 AS diff_rows FROM (" + _COUNTS_SQL + ")"))
def rebuild_idempotent(spark, sf):
    """Build Gold a second time from the same Silver into a fresh folder and diff every
    table with the first build."""
    first = warehouse(spark, sf)
    second = first.fork()
    parts = []
    for t in GOLD_TABLES:
        a, b = first.read(t), second.read(t)
        parts.append(a.agg(F.count(F.lit(1)).alias("rows"))
                     .select(F.lit(t).alias("table_name"), "rows",
                             F.lit(None).cast("bigint").alias("diff_rows")))
        parts.append(quality.table_diff(a, b).select(
            F.lit(t).alias("table_name"), F.lit(None).cast("bigint").alias("rows"), "diff_rows"))
    return reduce(DataFrame.unionByName, parts).groupBy("table_name").agg(
        F.max("rows").alias("rows"), F.max("diff_rows").alias("diff_rows"))


# ----------------------------------------------------------------------------- Features
@register("star_join_wide", WIDE_FIELDS, W(O.WIDE, f"SELECT {O.WIDE_COLS} FROM wide"))
def star_join_wide(spark, sf):
    g = warehouse(spark, sf).gold()
    return feature_ops.star_join_wide(g["fact_player_season_stats"], g["dim_player"],
                                      g["dim_team"], g["dim_season"], g["dim_position"])


@register("transfer_history", [("code", L), ("season", S), ("previous_team", S),
                               ("team_name", S)], W(O.FEATURES, """
SELECT code, season, previous_team, team_name FROM (
  SELECT code, season, team_name,
    lag(team_name) OVER (PARTITION BY code ORDER BY start_year) AS previous_team
  FROM features) WHERE previous_team IS NOT NULL AND previous_team <> team_name"""))
def transfer_history(spark, sf):
    return quality.team_changes(warehouse(spark, sf).features())


CLUB_PLAYER = "Supplier#000000002/2001"  # an entity present at every scale, with a transfer


@register("player_club_history", [("season", S), ("team_name", S)], W(O.WIDE, f"""
SELECT s.season, t.team_name FROM fact f
JOIN dim_player p ON f.player_key = p.player_key
JOIN dim_team t ON f.team_key = t.team_key
JOIN dim_season s ON f.season_key = s.season_key
WHERE p.web_name = '{CLUB_PLAYER}' ORDER BY s.season"""))
def player_club_history(spark, sf):
    """One player's club per season: a point lookup on the latest name, then the star join."""
    g = warehouse(spark, sf).gold()
    p = g["dim_player"].where(F.col("web_name") == CLUB_PLAYER).select("player_key")
    rows = (g["fact_player_season_stats"].join(p, "player_key")
            .join(g["dim_team"], "team_key").join(F.broadcast(g["dim_season"]), "season_key"))
    return rows.select("season", "team_name").orderBy("season")


_PROJECTIONS = {
    "per90": [n for n, _ in PER_90],
    "xg_residuals": RESIDUAL_FIELDS,
    "value_metrics": ["cost_millions", "points_per_million"],
    "flags": ["has_previous_season", "has_xg_data", "has_xa_data"],
    "prev_and_yoy": ["points_per_game_prev_season", "points_per_game_yoy_change",
                     "points_per_90_prev_season", "points_per_90_yoy_change"],
    "consistency_std": ["points_consistency_std"],
    "trend_slopes": ["goals_per_90_trend_slope", "assists_per_90_trend_slope"],
    "history_counter": ["seasons_of_history"],
}


def _projection(name, cols):
    @register(name, _feat(cols),
              W(O.FEATURES, f"SELECT code, season, {', '.join(cols)} FROM features"))
    def q(spark, sf):
        return warehouse(spark, sf).features().select("code", "season", *cols)
    return q


for _n, _c in _PROJECTIONS.items():
    _projection(_n, _c)


@register("feature_counts", [("season", S), ("feature_rows", L), ("players", L)],
          W(O.FEATURES, """
SELECT season, count(*) AS feature_rows, count(DISTINCT code) AS players
FROM features GROUP BY season
UNION ALL SELECT 'ALL', count(*), count(DISTINCT code) FROM features"""))
def feature_counts(spark, sf):
    return feature_ops.feature_counts(warehouse(spark, sf).features())


# ----------------------------------------------------------------------------- Scores
_COHORT = [("code", L), ("season", S), ("position", S), ("minutes", L)]


@register("cohort", _COHORT, W(O.FEATURES, f"""
SELECT code, season, position, minutes FROM features
WHERE season = '{SEASON}' AND minutes >= {SPEC.min_minutes}"""))
def cohort(spark, sf):
    return scoring.cohort(warehouse(spark, sf).features(), SEASON, SPEC) \
        .select("code", "season", "position", "minutes")


@register("cohort_empty_season", _COHORT, W(O.FEATURES, f"""
SELECT code, season, position, minutes FROM features
WHERE season = '1990' AND minutes >= {SPEC.min_minutes}"""))
def cohort_empty_season(spark, sf):
    return scoring.cohort(warehouse(spark, sf).features(), "1990", SPEC) \
        .select("code", "season", "position", "minutes")


_Z = ["points_per_million_zscore", "ownership_zscore", "goals_minus_xg_zscore",
      "assists_minus_xa_zscore"]


def _score_query(name, cols):
    contract = [("code", L), ("position", S)] + [(c, FT.get(c, D)) for c in cols]

    @register(name, contract, W(O.scores(SEASON, SPEC.min_minutes),
                                f"SELECT code, position, {', '.join(cols)} FROM scored"))
    def q(spark, sf):
        return scoring.value_scores(warehouse(spark, sf).features(), SEASON, SPEC) \
            .select("code", "position", *cols)
    return q


_score_query("position_zscores", _Z)
_score_query("hidden_gems", ["points_per_million", "selected_by_percent", "hidden_gem_score"])
_score_query("overperformers", ["goals_minus_xg_per_90", "assists_minus_xa_per_90",
                                "overperformance_score"])

# ----------------------------------------------------------------------------- BI measures
BI = O.GOLD + """,
bi AS (
  SELECT f.*, p.code, p.web_name, t.team_name, s.season, s.start_year,
    pos.position_code AS position
  FROM fact f JOIN dim_player p ON f.player_key = p.player_key
  JOIN dim_team t ON f.team_key = t.team_key
  JOIN dim_season s ON f.season_key = s.season_key
  JOIN dim_position pos ON f.position_key = pos.position_key
)"""


def _players(spark, sf):
    return warehouse(spark, sf).read("dim_player")


def _slim(spark, sf):
    g = warehouse(spark, sf).gold()
    return measures.slicer_rows(g["fact_player_season_stats"], g["dim_season"], g["dim_position"])


@register("measure_totals", [("season", S), ("total_goals", L), ("total_points", L)], W(BI, """
SELECT season, sum(goals_scored) AS total_goals, sum(total_points) AS total_points
FROM bi GROUP BY season"""))
def measure_totals(spark, sf):
    return measures.totals(_slim(spark, sf))


@register("measure_goals_per_90", [("season", S), ("position", S), ("goals_per_90", D)],
          W(BI, """
SELECT season, position,
  coalesce(sum(goals_scored) / (sum(minutes) / 90.0::DOUBLE), 0.0::DOUBLE) AS goals_per_90
FROM bi GROUP BY season, position"""))
def measure_goals_per_90(spark, sf):
    return measures.goals_per_90(_slim(spark, sf), by=("season", "position"))


@register("measure_top_scorer", [("season", S), ("top_scorer_points", L)], W(BI, """
SELECT season, max(total_points) AS top_scorer_points FROM bi GROUP BY season"""))
def measure_top_scorer(spark, sf):
    return measures.top_scorer_points(_slim(spark, sf))


@register("measure_top_scorer_sliced", [("season", S), ("position", S), ("top_scorer_points", L)],
          W(BI, """
SELECT DISTINCT season, position, max(total_points) OVER (PARTITION BY season) AS top_scorer_points
FROM bi"""))
def measure_top_scorer_sliced(spark, sf):
    return measures.top_scorer_points(_slim(spark, sf), by=("season", "position"))


@register("measure_grand_totals", [("total_goals", L), ("total_points", L)], W(BI, """
SELECT sum(goals_scored) AS total_goals, sum(total_points) AS total_points FROM bi"""))
def measure_grand_totals(spark, sf):
    return measures.totals(_slim(spark, sf), by=())


@register("top_scorer_row", [("season", S), ("web_name", S), ("total_points", L)], W(BI, """
SELECT season, web_name, total_points FROM (
  SELECT season, web_name, total_points, row_number() OVER (
    PARTITION BY season ORDER BY total_points DESC, fact_id) AS rn FROM bi) WHERE rn = 1"""))
def top_scorer_row(spark, sf):
    return measures.top_scorer_row(_slim(spark, sf), _players(spark, sf))


@register("measure_sos_change", [("season", S), ("start_year", L), ("season_points", L),
                                 ("previous_season_points", L), ("points_change", L)],
          W(BI + """,
cur AS (SELECT season, start_year, sum(total_points) AS season_points FROM bi
        GROUP BY season, start_year)""", """
SELECT c.season, c.start_year, c.season_points, p.season_points AS previous_season_points,
  c.season_points - coalesce(p.season_points, 0) AS points_change
FROM cur c LEFT JOIN cur p ON p.start_year = c.start_year - 1"""))
def measure_sos_change(spark, sf):
    return measures.season_over_season(_slim(spark, sf))


@register("measure_value_rank", [("fact_id", L), ("season", S), ("code", L), ("value", D),
                                 ("value_rank", L)], W(BI, """
SELECT fact_id, season, code, value,
  rank() OVER (PARTITION BY season ORDER BY value DESC NULLS LAST) AS value_rank
FROM (SELECT *, total_points / CASE WHEN now_cost / 10.0::DOUBLE <> 0
      THEN now_cost / 10.0::DOUBLE END AS value FROM bi)"""))
def measure_value_rank(spark, sf):
    rows = _slim(spark, sf).select("fact_id", "season", "player_key", "total_points", "now_cost")
    ranked = measures.value_rank(rows)  # on the fact's own columns; the code comes after
    return ranked.join(_players(spark, sf).select("player_key", "code"), "player_key") \
        .select("fact_id", "season", "code", "value", "value_rank")


@register("value_top5", [("web_name", S), ("total_points", L), ("now_cost", L), ("value", D)],
          W(BI, f"""
SELECT web_name, total_points, now_cost, total_points / (now_cost / 10.0::DOUBLE) AS value
FROM bi WHERE season = '{SEASON}'
ORDER BY value DESC NULLS LAST, fact_id LIMIT 5"""))
def value_top5(spark, sf):
    return measures.value_top(_slim(spark, sf), _players(spark, sf), SEASON, 5)


@register("season_leaders", [("season", S), ("code", L), ("web_name", S), ("goals_scored", L)],
          W(BI, """
SELECT season, code, web_name, goals_scored FROM (
  SELECT *, rank() OVER (PARTITION BY season ORDER BY goals_scored DESC) AS r FROM bi)
WHERE r = 1"""))
def season_leaders(spark, sf):
    return measures.season_leaders(_slim(spark, sf), _players(spark, sf))


@register("measure_cube", [("season", S), ("position", S), ("team_name", S), ("total_goals", L),
                           ("total_points", L), ("goals_per_90", D), ("top_scorer_points", L),
                           ("points_change", L)],
          W(BI + """,
levels AS (
  SELECT season, start_year, position, team_name, sum(goals_scored) AS total_goals,
    sum(total_points) AS total_points, sum(minutes) AS minutes
  FROM bi GROUP BY GROUPING SETS (
    ((season, start_year), position, team_name), ((season, start_year), position),
    ((season, start_year), team_name), ((season, start_year)), (position, team_name),
    (position), (team_name), ())),
best AS (SELECT season, max(total_points) AS top FROM bi GROUP BY GROUPING SETS ((season), ()))""", """
SELECT l.season, l.position, l.team_name, l.total_goals, l.total_points,
  coalesce(l.total_goals / (l.minutes / 90.0::DOUBLE), 0.0::DOUBLE) AS goals_per_90,
  b.top AS top_scorer_points,
  CASE WHEN l.season IS NOT NULL THEN l.total_points - coalesce(p.total_points, 0) END AS points_change
FROM levels l JOIN best b ON b.season IS NOT DISTINCT FROM l.season
LEFT JOIN levels p ON p.start_year = l.start_year - 1 AND p.position IS NOT DISTINCT FROM l.position
  AND p.team_name IS NOT DISTINCT FROM l.team_name"""))
def measure_cube(spark, sf):
    """Every measure under every set of slicers."""
    g = warehouse(spark, sf).gold()
    return measures.cube(g["fact_player_season_stats"], g["dim_season"], g["dim_position"],
                         g["dim_team"])


@register("measure_sos_change_sliced", [("season", S), ("start_year", L), ("position", S),
                                        ("season_points", L), ("previous_season_points", L),
                                        ("points_change", L)],
          W(BI + """,
cur AS (SELECT season, start_year, position, sum(total_points) AS season_points FROM bi
        GROUP BY season, start_year, position)""", """
SELECT c.season, c.start_year, c.position, c.season_points,
  p.season_points AS previous_season_points,
  c.season_points - coalesce(p.season_points, 0) AS points_change
FROM cur c LEFT JOIN cur p ON p.start_year = c.start_year - 1 AND p.position = c.position"""))
def measure_sos_change_sliced(spark, sf):
    return measures.season_over_season(_slim(spark, sf), by=("position",))


@register("value_rank_by_position", [("fact_id", L), ("season", S), ("position", S), ("value_rank", L)],
          W(BI, """
SELECT fact_id, season, position,
  rank() OVER (PARTITION BY season, position ORDER BY value DESC NULLS LAST) AS value_rank
FROM (SELECT *, total_points / CASE WHEN now_cost / 10.0::DOUBLE <> 0
      THEN now_cost / 10.0::DOUBLE END AS value FROM bi)"""))
def value_rank_by_position(spark, sf):
    rows = _slim(spark, sf).select("fact_id", "season", "position", "total_points", "now_cost")
    return measures.value_rank(rows, by=("season", "position"))
