"""File-based queries: raw landing (Bronze), Silver from landed files, BI export, metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import scoring
from ..session import scratch_path
from ..sources import export, landing
from ..sources.binding import read_table
from ..spec import (DIM_PLAYER_FIELDS, DIM_POSITION_FIELDS, DIM_SEASON_FIELDS, DIM_TEAM_FIELDS,
                    FACT_FIELDS, FEATURE_FIELDS, SILVER_FIELDS, B, L, S, struct_of)
from . import oracle as O
from .catalog import SEASON, SPEC, register
from .queries_ml import _POSITIONS
from .queries_more import _COUNTS_SQL, _ORPHAN_SQL
from .warehouse import GOLD_TABLES, warehouse

W = O.with_ctes
_SEASON_LIST = "SELECT DISTINCT CAST(year(l_shipdate) AS VARCHAR) AS season FROM lineitem"
_KINDS = ", ".join(f"('{k}')" for k in landing.RAW_FILES)


@register("bronze_files", [("season", S), ("file", S), ("data_rows", L), ("same_length", B),
                           ("same_digest", B)], W(O.SILVER, f"""
SELECT *, true AS same_length, true AS same_digest FROM (
SELECT season, '{landing.PLAYERS}' AS file, count(*) AS data_rows FROM raw GROUP BY season
UNION ALL SELECT season, '{landing.TEAMS}', count(*) FROM teams GROUP BY season)"""))
def bronze_files(spark, sf):
    """Records landed per season and file kind; length and digest of the landed bytes against
    those of the bytes read."""
    _, bronze = warehouse(spark, sf).landing()
    return landing.data_rows(spark, bronze)


@register("bronze_manifest", [("season", S), ("files", S), ("source", S)],
          f"SELECT season, '{','.join(sorted(landing.RAW_FILES))}' AS files, "
          f"'{landing.SOURCE}' AS source FROM ({_SEASON_LIST}) v")
def bronze_manifest(spark, sf):
    _, bronze = warehouse(spark, sf).landing()
    return landing.manifest(spark, bronze).select("season", "files", "source")


@register("arrival_check", [("season", S), ("file", S), ("present", B), ("non_empty", B)],
          f"SELECT season, file, true AS present, true AS non_empty "
          f"FROM ({_SEASON_LIST}) s, (VALUES {_KINDS}) k(file)")
def arrival_check(spark, sf):
    raw, _ = warehouse(spark, sf).landing()
    seasons = [r["season"] for r in warehouse(spark, sf).read("raw_teams")
               .select("season").distinct().collect()]  # one row a season
    return landing.arrival_check(spark, raw, sorted(seasons))


@register("season_coverage", [("season", S), ("lineitem_rows", L), ("rows_without_season", L)], """
SELECT CAST(year(l_shipdate) AS VARCHAR) AS season, count(*) AS lineitem_rows,
       (SELECT count(*) FROM lineitem WHERE l_shipdate IS NULL) AS rows_without_season
FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY 1""")
def season_coverage(spark, sf):
    """Lines that reached each season's supplier-year rows, and lines without a date."""
    dateless = read_table(spark, sf, "lineitem").filter("l_shipdate is null").count()
    years = warehouse(spark, sf).supplier_years()
    return years.groupBy(F.col("yr").cast("string").alias("season")).agg(
        F.sum("n").alias("lineitem_rows"), F.lit(dateless).cast("long").alias("rows_without_season"))


_NO_SEQ = [f for f in SILVER_FIELDS if f[0] != "ingest_seq"]


@register("silver_from_files", _NO_SEQ, W(O.SILVER, f"""
SELECT {', '.join(n for n, _ in _NO_SEQ)} FROM clean"""))
def silver_from_files(spark, sf):
    """The whole Silver build again, from landed CSV bytes instead of the table binding."""
    clean, _ = warehouse(spark, sf).silver_from_files()
    return clean


@register("rejected_from_files", [("code", L), ("season", S), ("reject_reason", S)],
          W(O.SILVER, "SELECT code, season, reject_reason FROM rejected"))
def rejected_from_files(spark, sf):
    _, rejected = warehouse(spark, sf).silver_from_files()
    return rejected.select("code", "season", "reject_reason")


_GOLD_SCHEMAS = {"dim_player": DIM_PLAYER_FIELDS, "dim_team": DIM_TEAM_FIELDS,
                 "dim_season": DIM_SEASON_FIELDS, "dim_position": DIM_POSITION_FIELDS,
                 "fact_player_season_stats": FACT_FIELDS}


@register("export_tables", [("table_name", S), ("rows", L)], W(O.GOLD, _COUNTS_SQL))
def export_tables(spark, sf):
    """Export the five tables to CSV, read them back with their schemas, count rows."""
    gold = warehouse(spark, sf).gold()
    paths = export.export_tables(gold, scratch_path(spark, "bi-export"))
    back = {n: export.read_csv(spark, p, struct_of(_GOLD_SCHEMAS[n])) for n, p in paths.items()}
    return export.count_rows({n: back[n] for n in GOLD_TABLES})


@register("sink_contents", [("table_name", S), ("rows", L), ("same_rows", B), ("same_content", B)],
          W(O.FEATURES, f"""
SELECT *, true AS same_rows, true AS same_content FROM ({_COUNTS_SQL}
UNION ALL SELECT 'rejected_rows', count(*) FROM rejected
UNION ALL SELECT 'player_style_clusters', count(*) FROM features WHERE season = '{SEASON}'
  AND minutes >= {SPEC.min_minutes} AND position IN ({_POSITIONS})
UNION ALL SELECT 'hidden_talent', least({SPEC.top_n}, count(*)) FROM features
  WHERE season = '{SEASON}' AND minutes >= {SPEC.min_minutes})"""))
def sink_contents(spark, sf):
    """Every CSV sink of a run: rows written, and rows and content read back against them."""
    wh = warehouse(spark, sf)
    out = scratch_path(spark, "sinks")
    sinks = dict(wh.gold()) | {
        "rejected_rows": wh.rejected(), "player_style_clusters": wh.clusters(SEASON, SPEC.n_clusters),
        "hidden_talent": scoring.detect_value_outliers(wh.features(), SEASON, spec=SPEC)}
    return reduce(DataFrame.unionByName, [
        export.compared(spark, n, df, f"{out}/{n}.csv", n in (export.SMALL_TABLES | {"hidden_talent"}))
        for n, df in sinks.items()])


_METRICS_SQL = W(O.FEATURES, """
SELECT 'silver' AS stage, NULL AS season, 'total_clean_rows' AS metric, count(*) AS value FROM clean
UNION ALL SELECT 'silver', NULL, 'total_rejected_rows', count(*) FROM rejected
UNION ALL SELECT 'silver', NULL, 'seasons_processed', count(DISTINCT season) FROM clean
UNION ALL SELECT 'silver', season, 'clean_rows', count_if(ok) FROM (
  SELECT season, true AS ok FROM clean UNION ALL SELECT season, false FROM rejected) GROUP BY season
UNION ALL SELECT 'silver', season, 'rejected_rows', count_if(NOT ok) FROM (
  SELECT season, true AS ok FROM clean UNION ALL SELECT season, false FROM rejected) GROUP BY season
UNION ALL SELECT 'gold', NULL, table_name || '_rows', rows FROM (""" + _COUNTS_SQL + """)
UNION ALL SELECT 'gold', NULL, 'orphaned_fact_rows', count(*) FROM fact f
  LEFT JOIN dim_player p ON f.player_key = p.player_key WHERE p.player_key IS NULL
UNION ALL SELECT 'gold', NULL, 'orphaned_' || fk || '_rows', orphan_rows FROM (""" + _ORPHAN_SQL + """)
UNION ALL SELECT 'features', NULL, 'feature_rows', count(*) FROM features
UNION ALL SELECT 'features', season, 'feature_rows', count(*) FROM features GROUP BY season
UNION ALL SELECT 'features', NULL, 'players', count(DISTINCT code) FROM features""")


@register("run_metrics", [("stage", S), ("season", S), ("metric", S), ("value", L)], _METRICS_SQL)
def run_metrics(spark, sf):
    """What the writing jobs counted; the plan reads no layer."""
    return warehouse(spark, sf).metrics()


@register("feature_files", [("season", S), ("rows", L), ("in_order", B), ("apart", B)],
          W(O.FEATURES, """
SELECT season, count(*) AS rows, true AS in_order, true AS apart FROM features GROUP BY season"""))
def feature_files(spark, sf):
    """Feature rows as the files hold them: in order inside each file, and the files of a season
    one after the other (by name) without overlap, as their index says."""
    wh = warehouse(spark, sf)
    wh.features()
    key = F.struct("position", "code")
    path = Window.partitionBy("path").orderBy("row_index")
    rows = wh.layer("features").read("rows", struct_of(FEATURE_FIELDS), places=True).select(
        "season", key.alias("key"), "path", "row_index")
    inside = rows.withColumn("before", F.lag("key").over(path)).groupBy("season").agg(
        F.count(F.lit(1)).alias("rows"),
        F.bool_and(F.col("before").isNull() | (F.col("before") < F.col("key"))).alias("in_order"))
    files = Window.partitionBy("season").orderBy("path")
    index = wh.feature_files().withColumn("before", F.lag("most").over(files)).groupBy("season").agg(
        F.bool_and(F.col("before").isNull() | (F.col("before") < F.col("least"))).alias("apart"))
    return inside.join(index, "season")


@register("feature_point", [("code", L), ("season", S), ("position", S), ("minutes", L)],
          W(O.FEATURES, f"""
SELECT code, season, position, minutes FROM features WHERE season = '{SEASON}'
QUALIFY row_number() OVER (ORDER BY position, code) = 1"""))
def feature_point(spark, sf):
    """The least key of a season through the index: one file is read."""
    wh = warehouse(spark, sf)
    least = wh.feature_files().where(F.col("season") == SEASON).agg(F.min("least").alias("k")).first().k
    if least is None:
        return wh.features().where("false")
    return wh.feature_row(SEASON, least.position, least.code)
