"""Helpers shared by the operators: table access, written intermediates, let-binding."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from periodstats.session import scratch_path

#: One word: a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back.

    The written table cuts the lineage, survives the loss of executors, and gives the planner
    a measured size: a later join broadcasts it only below the session's threshold.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, also when used inside a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def text_of(column: str | Column = "text") -> Column:
    """The text as a string; null counts as empty."""
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(c.cast("string"), F.lit(""))


#: Bits of the filter of ``maybe_in``: 2 MB, whatever the number of keys.
FILTER_BITS = 1 << 24


def maybe_in(keys: DataFrame, key: Column) -> Callable[[Column], Column]:
    """A test that is true for every key (a 64-bit hash) in ``keys`` and false for most others.

    The keys are folded into a bit map of fixed size, at most FILTER_BITS / 32 rows on the
    driver, which is broadcast. It only thins out what an exact join behind it would shuffle:
    with ever more keys it lets more through, and the result stays the same.
    """
    spark = keys.sparkSession
    at = F.pmod(key, F.lit(FILTER_BITS))
    words = keys.select(at.alias("at")).groupBy(F.shiftright("at", 5).cast("int").alias("w")).agg(
        F.expr("bit_or(shiftleft(1L, cast(at % 32 as int)))").alias("bits"))
    bits = np.zeros(FILTER_BITS // 32, dtype=np.uint32)
    for r in words.collect():
        bits[r["w"]] = r["bits"]
    shared = spark.sparkContext.broadcast(bits.tobytes())

    @F.pandas_udf("boolean")
    def test(position: pd.Series) -> pd.Series:
        known = np.frombuffer(shared.value, dtype=np.uint32)
        p = position.to_numpy().astype(np.int64)
        return pd.Series((known[p >> 5] >> (p & 31).astype(np.uint32)) & 1 == 1)

    return lambda k: test(F.pmod(k, F.lit(FILTER_BITS)).cast("int"))
