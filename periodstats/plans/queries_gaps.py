"""Queries over rows that the plain ones never meet: zero denominators, absent values, small
groups. Each is derived from the run's layers by a rule on the row's code, so its work grows with
the tables, and its oracle applies the same rule in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import archetypes, scoring
from ..operators import features as feature_ops
from ..spec import CLUSTER_FEATURES_BY_POSITION, FEATURE_FIELDS, OUTLIER_OUTPUT_COLUMNS, PER_90, D, L, S
from . import oracle as O
from .catalog import SEASON, SPEC, register
from .queries_ml import _INPUT_CONTRACT, CLUSTER_CTES, K
from .warehouse import warehouse

FT = dict(FEATURE_FIELDS)
W = O.with_ctes

# -- zero minutes and zero costs -------------------------------------------------------------
_ZEROED = O.WIDE + """,
zeroed AS (SELECT * REPLACE (CASE WHEN code % 4 = 1 THEN 0 ELSE minutes END AS minutes,
                             CASE WHEN code % 5 = 2 THEN 0 ELSE now_cost END AS now_cost) FROM wide)""" \
    + O.FEATURES[len(O.WIDE):].replace("FROM wide", "FROM zeroed")
_RATES = [n for n, _ in PER_90] + ["points_per_million", "points_per_90_prev_season",
                                   "points_per_90_yoy_change", "goals_per_90_trend_slope",
                                   "goals_minus_xg_per_90"]


@register("rates_of_zero", [("code", L), ("season", S), ("minutes", L)] + [(c, FT[c]) for c in _RATES],
          W(_ZEROED, f"SELECT code, season, minutes, {', '.join(_RATES)} FROM features"))
def rates_of_zero(spark, sf):
    """Rates, and the history built on them, where minutes or costs are 0: absent, not infinite."""
    wh = warehouse(spark, sf)
    g = wh.gold()
    wide = feature_ops.star_join_wide(g["fact_player_season_stats"], g["dim_player"], g["dim_team"],
                                      g["dim_season"], g["dim_position"], keep_key=True)
    wide = wide.withColumns({
        "minutes": F.when(F.col("code") % 4 == 1, F.lit(0).cast("long")).otherwise(F.col("minutes")),
        "now_cost": F.when(F.col("code") % 5 == 2, F.lit(0).cast("long")).otherwise(F.col("now_cost"))})
    return feature_ops.build_features(wide).select("code", "season", "minutes", *_RATES)


# -- scores without residuals ----------------------------------------------------------------
OLD = "1996"  # a season whose files have no expected goals
_OUT = [(c, FT.get(c, D)) for c in OUTLIER_OUTPUT_COLUMNS]


@register("discovery_without_xg", _OUT, W(
    O.scores(OLD, SPEC.min_minutes),
    f"SELECT {', '.join(OUTLIER_OUTPUT_COLUMNS)} FROM scored "
    f"ORDER BY discovery_score DESC NULLS LAST, code LIMIT {SPEC.top_n}"))
def discovery_without_xg(spark, sf):
    """The hidden part alone decides where no row has both residuals."""
    return scoring.detect_value_outliers(warehouse(spark, sf).features(), OLD, spec=SPEC)


_SOME = """,
mixed AS (SELECT * REPLACE (
  CASE WHEN code % 3 <> 0 THEN goals_minus_xg_per_90 END AS goals_minus_xg_per_90,
  CASE WHEN code % 4 <> 1 THEN assists_minus_xa_per_90 END AS assists_minus_xa_per_90) FROM features)"""
_MIXED = ["goals_minus_xg_zscore", "assists_minus_xa_zscore", "hidden_gem_score",
          "overperformance_score", "discovery_score"]


@register("scores_of_mixed_residuals", [("code", L), ("position", S)] + [(c, D) for c in _MIXED],
          W(O.FEATURES + _SOME + O.scores(SEASON, SPEC.min_minutes)[len(O.FEATURES):]
            .replace("FROM features", "FROM mixed"), f"SELECT code, position, {', '.join(_MIXED)} FROM scored"))
def scores_of_mixed_residuals(spark, sf):
    """Rows with both residuals, with one and with none, in one cohort."""
    df = warehouse(spark, sf).features().withColumns({
        "goals_minus_xg_per_90": F.when(F.col("code") % 3 != 0, F.col("goals_minus_xg_per_90")),
        "assists_minus_xa_per_90": F.when(F.col("code") % 4 != 1, F.col("assists_minus_xa_per_90"))})
    return scoring.value_scores(df, SEASON, SPEC).select("code", "position", *_MIXED)


# -- clustering with gaps --------------------------------------------------------------------
_KEEPER = CLUSTER_FEATURES_BY_POSITION["GK"][1:]
_GAPS = sorted({f for fs in CLUSTER_FEATURES_BY_POSITION.values() for f in fs})
_REPLACED = ", ".join(
    f"CASE WHEN code % 3 <> {i % 3}" + (" AND position <> 'GK'" if f in _KEEPER else "")
    + f" THEN {f} END AS {f}" for i, f in enumerate(_GAPS))
_GAPPED = O.FEATURES + f""",
gapped AS (SELECT * REPLACE ({_REPLACED}) FROM features WHERE position <> 'FWD' OR code % 29 = 0)""" \
    + CLUSTER_CTES[len(O.FEATURES):].replace("FROM features", "FROM gapped")


def _gapped(spark, sf):
    """A third of the values of each feature absent, one feature left to goalkeepers, few forwards."""
    code, keeper = F.col("code"), F.col("position") == "GK"
    return warehouse(spark, sf).features().withColumns({
        f: F.when((code % 3 != i % 3) & (~keeper if f in _KEEPER else F.lit(True)), F.col(f))
        for i, f in enumerate(_GAPS)}).where(~(F.col("position") == "FWD") | (code % 29 == 0))


@register("cluster_status_of_gaps", [("position", S), ("players", L), ("usable_features", L),
                                     ("status", S)], W(_GAPPED, "SELECT * FROM cstatus"))
def cluster_status_of_gaps(spark, sf):
    """Groups with too few players, with too few usable features, and others."""
    return archetypes.cluster_status(_gapped(spark, sf), SEASON, K, SPEC)


@register("cluster_inputs_of_gaps", _INPUT_CONTRACT, W(_GAPPED, f"""
SELECT c.code, c.season, c.position, c.feature, c.feature_idx, c.raw_value, c.imputed_value,
  c.scaled_value
FROM cscaled c JOIN cstatus s ON c.position = s.position
WHERE s.status = '{archetypes.CLUSTERED}'"""))
def cluster_inputs_of_gaps(spark, sf):
    """Absent values take the median of their group before they are scaled."""
    return archetypes.cluster_inputs(_gapped(spark, sf), SEASON, K, SPEC)[0]


@register("cluster_styles_of_gaps", [("position", S), ("players", L), ("clustered", L), ("clusters", L),
                                     ("misplaced", L), ("mislabelled", L), ("unordered", L),
                                     ("unclustered_labels", S)], W(_GAPPED, f"""
SELECT position, players, CASE WHEN ok THEN players ELSE 0 END AS clustered,
  CASE WHEN ok THEN {K} ELSE 0 END AS clusters, 0 AS misplaced, 0 AS mislabelled, 0 AS unordered,
  CASE WHEN NOT ok THEN status END AS unclustered_labels
FROM (SELECT *, status = '{archetypes.CLUSTERED}' AS ok FROM cstatus)"""))
def cluster_styles_of_gaps(spark, sf):
    """All rows come back, in clusters or with the reason why not."""
    df = _gapped(spark, sf)
    long, _ = archetypes.cluster_inputs(df, SEASON, K, SPEC)
    styles = archetypes.cluster_playing_styles(df, SEASON, K, SPEC)
    reasons = styles.where("cluster < 0").groupBy("position").agg(
        F.max("cluster_label").alias("unclustered_labels"))
    return archetypes.certificates(styles, long).join(reasons, "position", "left")
