"""Distributed dense numbering and ranking without a single-partition window.

``Window.orderBy(...)`` with no partition moves every row into one task. Instead:

1. range-partition on the order key (Spark samples the key to pick balanced bounds; equal
   keys always land in the same partition) and sort inside each partition;
2. tag each row with its partition id and its index inside the partition, and checkpoint
   to the shared folder so a recomputed partition cannot change its tags;
3. count rows per partition (and per group) - a table of at most partitions x groups rows;
4. add to every row the number of rows of its group in earlier partitions.

The same scheme gives ``rank()`` (ties share a rank, with gaps) over value groups: rank the
distinct (group, value) pairs with weights, then join the rank back by (group, value).
A group holding a third of all rows is spread over many range partitions, so no task ever
holds a whole group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_dir

_P, _I = "__p", "__i"


def _join_on(left: DataFrame, right: DataFrame, keys: list[str], small: bool = False) -> DataFrame:
    """Inner equi-join on ``keys`` where NULL matches NULL (a NULL group is still a group)."""
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = [left[k].eqNullSafe(r[f"__r_{k}"]) for k in keys]
    return left.join(F.broadcast(r) if small else r, cond, "inner").drop(*[f"__r_{k}" for k in keys])


def _partitions(df: DataFrame, n: int | None) -> int:
    """Range-partition count: ``spark.sql.shuffle.partitions`` unless given. (The optimizer's
    size estimate is not used: without column statistics a join's estimate is the product
    of its inputs' sizes.)"""
    return int(n or df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _tagged(df: DataFrame, order: list[Column], n: int | None) -> DataFrame:
    shared_dir(df.sparkSession)  # make sure the checkpoint folder is installed
    ranged = df.repartitionByRange(_partitions(df, n), *order).sortWithinPartitions(*order)
    tagged = ranged.withColumn(_P, F.spark_partition_id()).withColumn(
        _I, F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("bigint"), 33))
    return tagged.checkpoint(eager=True)


def _offsets(tagged: DataFrame, groups: list[str], weight: str | None) -> DataFrame:
    w = F.sum(weight).cast("bigint") if weight else F.count(F.lit(1))
    counts = tagged.groupBy(_P, *groups).agg(w.alias("__cnt"), F.min(_I).alias("__first"))
    # at most (partitions x groups intersecting them) rows
    spec = Window.partitionBy(*groups) if groups else Window
    before = spec.orderBy(_P).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("__off", F.coalesce(F.sum("__cnt").over(before), F.lit(0)))


def row_numbers(df: DataFrame, order: list[Column], name: str, n: int | None = None) -> DataFrame:
    """Add ``name`` = 1..count in ``order`` (order must be unique for a stable answer)."""
    tagged = _tagged(df, order, n)
    offsets = _offsets(tagged, [], None).select(_P, "__off", "__first")
    out = tagged.join(F.broadcast(offsets), _P)  # one row per partition
    return out.withColumn(name, (F.col("__off") + F.col(_I) - F.col("__first") + 1).cast("bigint")) \
        .drop(_P, _I, "__off", "__first")


def ranks(df: DataFrame, groups: list[str], value: str, name: str, descending: bool = True,
          n: int | None = None) -> DataFrame:
    """``rank() over (partition by groups order by value desc|asc nulls last)``."""
    vc = df.groupBy(*groups, value).agg(F.count(F.lit(1)).alias("__w"))  # partial aggregate
    vcol = F.col(value)
    ordered = vcol.desc_nulls_last() if descending else vcol.asc_nulls_last()
    tagged = _tagged(vc, [*(F.col(g).asc_nulls_first() for g in groups), ordered], n)
    offsets = _offsets(tagged, groups, "__w").drop("__cnt", "__first")
    # weight of the earlier distinct values of the same group inside the same partition
    local = Window.partitionBy(_P, *groups).orderBy(_I).rowsBetween(Window.unboundedPreceding, -1)
    tagged = tagged.withColumn("__before", F.coalesce(F.sum("__w").over(local), F.lit(0)))
    keyed = _join_on(tagged, offsets, [_P, *groups]).select(
        *groups, value, (F.col("__off") + F.col("__before") + 1).cast("bigint").alias(name))
    cond = [df[g].eqNullSafe(keyed[g]) for g in groups] + [df[value].eqNullSafe(keyed[value])]
    return df.join(keyed, cond, "inner").select(df["*"], keyed[name])


def exact_medians(df: DataFrame, groups: list[str], value: str, bins: int = 1024) -> dict[tuple, float]:
    """Exact median of each group (mean of the two middle values for an even count), by group
    values; NULLs are ignored and a group of them only is left out.

    Selection by repeated histograms, without a sort and without a shuffle of values: a pass
    counts the rows of each group in bins of equal width over the range that still holds the
    middle value, with each bin's least and largest value, and goes on inside the bin that holds
    the middle rank. It ends when that bin holds one distinct value, after three or four passes
    for ordinary data. For few groups: a row a group and pass, and ``bins`` counts of it, reach
    the driver."""
    spark = df.sparkSession
    v = F.col(value)
    sizes = df.where(v.isNotNull()).groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n"), F.min(v).alias("a"), F.max(v).alias("b")).collect()
    found: dict[tuple, dict[int, float]] = {}
    todo = []  # (group values, which middle, least, largest, rank among what lies between)
    for r in sizes:
        key = tuple(r[g] for g in groups)
        for middle in {(r.n + 1) // 2, (r.n + 2) // 2}:
            if r.a == r.b:
                found.setdefault(key, {})[middle] = r.a
            else:
                todo.append((*key, middle, float(r.a), float(r.b), middle))
    schema = ", ".join([f"`{g}` {df.schema[g].dataType.simpleString()}" for g in groups]
                       + ["__middle bigint", "__a double", "__b double", "__rank bigint"])
    while todo:
        ranges = spark.createDataFrame(todo, schema)
        inside = _join_on(df.where(v.isNotNull()), ranges, groups, small=True).where(
            v.between(F.col("__a"), F.col("__b")))
        width = (F.col("__b") / 2 - F.col("__a") / 2) / bins  # halves: the range may pass a double's
        at = F.least(F.floor((v / 2 - F.col("__a") / 2) / width), F.lit(bins - 1))
        counts: dict[tuple, list] = {}
        for r in inside.groupBy(*groups, "__middle", at.alias("__bin")).agg(
                F.count(F.lit(1)).alias("n"), F.min(v).alias("a"), F.max(v).alias("b")).collect():
            counts.setdefault((*(r[g] for g in groups), r["__middle"]), []).append(r)
        left = []
        for t in todo:
            key, middle, rank = t[:len(groups)], t[len(groups)], t[-1]
            for r in sorted(counts[*key, middle], key=lambda r: r.a):
                if rank <= r.n:
                    break
                rank -= r.n
            if r.a == r.b:
                found.setdefault(key, {})[middle] = r.a
            else:
                left.append((*key, middle, r.a, r.b, rank))
        todo = left
    return {key: (min(m.values()) + max(m.values())) / 2.0 for key, m in found.items()}
