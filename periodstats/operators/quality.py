"""Data-quality checks expressed as DataFrames (a check result is data, not a print)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def orphans(rows: DataFrame, checks: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """Per check name: rows of ``rows`` whose ``row_key`` finds no ``dim_key`` in the
    dimension (a NULL key is an orphan). ``checks``: name -> (dimension, row_key, dim_key).

    One scan of ``rows``: its keys are counted per (check, key) with a partial aggregate, so
    the anti-join sees each key once however many rows carry it."""
    keys = F.explode(F.array(*[F.struct(F.lit(name).alias("fk"),
                                        F.col(row_key).cast("string").alias("key"))
                               for name, (_, row_key, _) in checks.items()]))
    used = rows.select(keys.alias("u")).groupBy("u.fk", "u.key") \
        .agg(F.count(F.lit(1)).alias("orphan_rows"))
    known = reduce(DataFrame.unionByName, [
        dim.select(F.lit(name).alias("fk"), F.col(dim_key).cast("string").alias("key"))
        for name, (dim, _, dim_key) in checks.items()])
    none = rows.sparkSession.createDataFrame([(name, 0) for name in checks],
                                             "fk string, orphan_rows bigint")
    return used.join(known, ["fk", "key"], "left_anti").select("fk", "orphan_rows") \
        .unionByName(none).groupBy("fk") \
        .agg(F.sum("orphan_rows").cast("bigint").alias("orphan_rows"))


def assert_no_orphans(counts: DataFrame) -> None:
    """Referential-integrity gate: raise when any foreign key has orphans."""
    bad = counts.where(F.col("orphan_rows") > 0).collect()  # at most one row per key
    if bad:
        raise AssertionError(f"Referential integrity check failed: {[tuple(r) for r in bad]}")


def assert_no_orphan_counts(counts: dict[str, int]) -> None:
    """The same gate for counts that the write of the rows observed."""
    bad = {n: c for n, c in counts.items() if c}
    if bad:
        raise AssertionError(f"Referential integrity check failed: {bad}")


def grain_duplicates(rows: DataFrame, keys=("code", "season")) -> DataFrame:
    """Keys that occur more than once (partial aggregate, then filter)."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).cast("bigint").alias("copies")) \
        .where(F.col("copies") > 1)


def null_profile(rows: DataFrame, columns: list[str], by=("season",)) -> DataFrame:
    """Rows and non-NULL counts of ``columns`` per group."""
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).cast("bigint").alias("rows"),
        *[F.count(c).cast("bigint").alias(f"{c}_non_null") for c in columns])


def history_sequence(features: DataFrame) -> DataFrame:
    """Per entity: the history counter read in period order must be exactly 1..n.

    The collected list holds one entry per period of one entity (bounded by the number of
    periods), never a whole group of the data."""
    seq = features.groupBy("code").agg(
        F.sort_array(F.collect_list(F.struct("start_year", "seasons_of_history"))).alias("h"))
    counters = F.transform("h", lambda s: s["seasons_of_history"])
    return seq.select("code", F.size("h").cast("bigint").alias("n_seasons"),
                      (counters == F.sequence(F.lit(1).cast("bigint"),
                                              F.size("h").cast("bigint"))).alias("history_ok"))


def team_id_reuse(silver: DataFrame) -> DataFrame:
    """Raw team ids that name different clubs in different seasons."""
    return silver.groupBy("team").agg(
        F.count_distinct("season").cast("bigint").alias("seasons"),
        F.count_distinct("team_name").cast("bigint").alias("team_names"))


def team_changes(features: DataFrame) -> DataFrame:
    """Entity-periods whose club differs from the entity's previous present period."""
    w = Window.partitionBy("code").orderBy("start_year")
    prev = features.select("code", "season", "start_year", "team_name",
                           F.lag("team_name").over(w).alias("previous_team"))
    return prev.where(F.col("previous_team").isNotNull()
                      & (F.col("previous_team") != F.col("team_name"))) \
        .select("code", "season", "previous_team", "team_name")


def table_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows in one table but not the other (multiset), as one count (one aggregate)."""
    both = a.withColumn("__side", F.lit(1)).unionByName(b.withColumn("__side", F.lit(-1)))
    net = both.groupBy(*a.columns).agg(F.sum("__side").alias("__net"))
    return net.agg(F.coalesce(F.sum(F.abs("__net")), F.lit(0)).cast("bigint").alias("diff_rows"))
