"""Clustering queries: inputs and status (SQL oracles), assignments and summary (row checks)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import archetypes
from ..spec import CLUSTER_FEATURES_BY_POSITION, D, L, S
from . import oracle as O
from .catalog import SEASON, SPEC, register
from .numbering import exact_medians
from .warehouse import warehouse

K = SPEC.n_clusters
_FMAP = ", ".join(f"('{p}', '{f}', {i})" for p, fs in CLUSTER_FEATURES_BY_POSITION.items()
                  for i, f in enumerate(fs))
_NEEDED = sorted({f for fs in CLUSTER_FEATURES_BY_POSITION.values() for f in fs})
_RAW = "CASE m.feature " + " ".join(f"WHEN '{f}' THEN c.{f}" for f in _NEEDED) + " END"
_POSITIONS = ", ".join(f"'{p}'" for p in CLUSTER_FEATURES_BY_POSITION)

CLUSTER_CTES = O.FEATURES + f""",
ccohort AS (
  SELECT * FROM features WHERE season = '{SEASON}' AND minutes >= {SPEC.min_minutes}
    AND position IN ({_POSITIONS})
),
fmap AS (SELECT * FROM (VALUES {_FMAP}) v(position, feature, feature_idx)),
clong AS (
  SELECT c.code, c.season, c.position, m.feature, CAST(m.feature_idx AS BIGINT) AS feature_idx,
    CAST({_RAW} AS DOUBLE) AS raw_value
  FROM ccohort c JOIN fmap m ON c.position = m.position
),
sizes AS (SELECT position, count(*) AS players FROM ccohort GROUP BY position),
fstats AS (
  SELECT position, feature, count(raw_value) AS nn, median(raw_value) AS med
  FROM clong GROUP BY position, feature
),
nusable AS (SELECT position, count(*) AS usable_features FROM fstats WHERE nn > 0
            GROUP BY position),
cstatus AS (
  SELECT s.position, s.players, coalesce(u.usable_features, 0) AS usable_features,
    CASE WHEN s.players < {K} THEN '{archetypes.TOO_FEW_PLAYERS}'
         WHEN coalesce(u.usable_features, 0) < 2 THEN '{archetypes.TOO_FEW_FEATURES}'
         ELSE '{archetypes.CLUSTERED}' END AS status
  FROM sizes s LEFT JOIN nusable u ON s.position = u.position
),
cimp AS (
  SELECT l.*, coalesce(l.raw_value, f.med) AS imputed_value
  FROM clong l JOIN fstats f ON l.position = f.position AND l.feature = f.feature
  WHERE f.nn > 0
),
cscaled AS (
  SELECT *, CASE WHEN min(imputed_value) OVER w = max(imputed_value) OVER w THEN 0.0::DOUBLE
    ELSE (imputed_value - avg(imputed_value) OVER w) / stddev_pop(imputed_value) OVER w END
    AS scaled_value
  FROM cimp WINDOW w AS (PARTITION BY position, feature)
)"""

_INPUT_CONTRACT = [("code", L), ("season", S), ("position", S), ("feature", S),
                   ("feature_idx", L), ("raw_value", D), ("imputed_value", D),
                   ("scaled_value", D)]


@register("cluster_inputs", _INPUT_CONTRACT, O.with_ctes(CLUSTER_CTES, f"""
SELECT c.code, c.season, c.position, c.feature, c.feature_idx, c.raw_value, c.imputed_value,
  c.scaled_value
FROM cscaled c JOIN cstatus s ON c.position = s.position
WHERE s.status = '{archetypes.CLUSTERED}'"""))
def cluster_inputs(spark, sf):
    long, _ = archetypes.cluster_inputs(warehouse(spark, sf).features(), SEASON, K, SPEC)
    return long


@register("cluster_status", [("position", S), ("players", L), ("usable_features", L),
                             ("status", S)],
          O.with_ctes(CLUSTER_CTES, "SELECT * FROM cstatus"))
def cluster_status(spark, sf):
    return archetypes.cluster_status(warehouse(spark, sf).features(), SEASON, K, SPEC)


_STYLE_CONTRACT = [("code", L), ("season", S), ("position", S), ("minutes", L),
                   ("cluster", L), ("cluster_label", S)]


@register("cluster_styles", _STYLE_CONTRACT, None)
def cluster_styles(spark, sf):
    """K-Means assignments; the search has no SQL form, its result is held to certificates."""
    return warehouse(spark, sf).clusters(SEASON, K)


_CERTIFIED = [("position", S), ("players", L), ("clustered", L), ("clusters", L),
              ("misplaced", L), ("mislabelled", L), ("unordered", L)]


@register("cluster_certificates", _CERTIFIED, O.with_ctes(CLUSTER_CTES, f"""
SELECT position, players, CASE WHEN ok THEN players ELSE 0 END AS clustered,
  CASE WHEN ok THEN {K} ELSE 0 END AS clusters, 0 AS misplaced, 0 AS mislabelled, 0 AS unordered
FROM (SELECT *, status = '{archetypes.CLUSTERED}' AS ok FROM cstatus)"""))
def cluster_certificates(spark, sf):
    """Every clustered player is nearest to the mean of its own cluster, labels name the largest
    mean, and cluster numbers are in order."""
    wh = warehouse(spark, sf)
    long, _ = archetypes.cluster_inputs(wh.features(), SEASON, K, SPEC)
    return archetypes.certificates(wh.clusters(SEASON, K), long)


@register("cluster_summary", [("position", S), ("players", L), ("clusters", L)],
          O.with_ctes(CLUSTER_CTES, f"""
SELECT position, players, CASE WHEN status = '{archetypes.CLUSTERED}' THEN {K} ELSE 0 END AS clusters
FROM cstatus"""))
def cluster_summary(spark, sf):
    return archetypes.cluster_summary(warehouse(spark, sf).clusters(SEASON, K))


@register("cluster_medians", [("position", S), ("feature", S), ("median", D)],
          O.with_ctes(CLUSTER_CTES, "SELECT position, feature, med AS median FROM fstats WHERE nn > 0"))
def cluster_medians(spark, sf):
    """The median of every (position, feature) of the cohort, by repeated histograms."""
    _, long, _ = archetypes._long(warehouse(spark, sf).features(), SEASON, K, SPEC)
    found = exact_medians(long, ["position", "feature"], "raw_value")
    return spark.createDataFrame([(*k, m) for k, m in found.items()],
                                 "position string, feature string, median double")
