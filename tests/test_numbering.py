"""Distributed numbering, ranking and median against plain single-task answers, with one
group holding most rows (a hot key)."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from periodstats.plans import numbering


def _data(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        g = "hot" if rnd.random() < 0.8 else rnd.choice(["a", "b", "c", None])
        v = None if rnd.random() < 0.05 else float(rnd.randint(0, 200))
        rows.append((i, g, v))
    return spark.createDataFrame(rows, "id bigint, g string, v double").repartition(5)


def test_row_numbers_equal_global_row_number(spark):
    df = _data(spark)
    got = numbering.row_numbers(df, [F.col("g"), F.col("id")], "rn", n=6)
    want = df.withColumn("want", F.row_number().over(Window.orderBy("g", "id")))
    j = got.join(want, "id")
    assert j.count() == 3000 and j.where("rn <> want").count() == 0


def test_ranks_equal_sql_rank_with_ties_and_nulls(spark):
    df = _data(spark)
    got = numbering.ranks(df, ["g"], "v", "r", descending=True, n=7)
    want = df.withColumn("want", F.rank().over(
        Window.partitionBy("g").orderBy(F.col("v").desc_nulls_last())))
    j = got.join(want, "id")
    assert j.count() == 3000 and j.where("r <> want").count() == 0
    assert got.where("g IS NULL").count() > 0


@pytest.mark.parametrize("bins", [2, 7, 1024])
def test_exact_medians(spark, bins):
    df = _data(spark)
    got = {k[0]: m for k, m in numbering.exact_medians(df, ["g"], "v", bins).items()}
    assert None in got
    want = {r.g: r.m for r in df.groupBy("g").agg(F.median("v").alias("m")).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-12 for k in got)


def test_medians_of_ties_even_counts_and_wide_ranges(spark):
    groups = {"even": [1.0, 2.0, 3.0, 10.0], "one": [4.5], "ties": [2.0] * 5 + [7.0] * 5,
              "equal": [3.25] * 6, "wide": [-1e300, 1e-300, 2e-300, 1e300, 5.0], "none": [None, None],
              "gap": [None, 0.0, 1e-12, 1.0], "huge": [-1.7e308, 1.7e308, 1.0]}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g string, v double")
    got = {k[0]: m for k, m in numbering.exact_medians(df, ["g"], "v").items()}
    assert got == {"even": 2.5, "one": 4.5, "ties": 4.5, "equal": 3.25, "wide": 2e-300,
                   "gap": 1e-12, "huge": 1.0}
