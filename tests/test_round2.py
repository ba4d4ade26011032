"""File values, slicers, seasons from the data, and repeatable clusters."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from periodstats.operators import archetypes, conform, measures
from periodstats.plans.warehouse import Warehouse
from periodstats.sources import export
from periodstats.session import scratch_path

SF = "/root/testdata/sf0.01"


def test_whole_numbers_and_missing_tokens_in_files(spark):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.DoubleType())])
    rows = [("1000.0", "NaN"), ("7", "1.5"), ("7.5", ""), ("x", None), ("NaN", "2")]
    df = spark.createDataFrame(rows, "a string, b string")
    got = [tuple(r) for r in conform.conform(df, schema).collect()]
    assert got == [(1000, None), (7, 1.5), (None, None), (None, None), (None, 2.0)]


def test_export_doubles_quotes(spark):
    df = spark.createDataFrame([(1, 'He said "hi", ok')], "k int, name string")
    path = export.export_tables({"dim_player": df}, scratch_path(spark, "quotes"))["dim_player"]
    text = "\n".join(r["value"] for r in spark.read.text(path).collect())
    assert '"He said ""hi"", ok"' in text
    assert export.read_exported(spark, path, df.schema).collect() == df.collect()


def test_top_scorer_ignores_slicers_but_season(spark):
    rows = spark.createDataFrame([("A", "GK", 3), ("A", "FW", 9), ("B", "GK", 5)],
                                 "season string, position string, total_points long")
    got = {tuple(r) for r in measures.top_scorer_points(rows, ("season", "position")).collect()}
    assert got == {("A", "GK", 9), ("A", "FW", 9), ("B", "GK", 5)}
    assert {tuple(r) for r in measures.top_scorer_points(rows, ("position",)).collect()} == {
        ("GK", 9), ("FW", 9)}


def test_a_year_outside_the_usual_ones_is_a_season(spark):
    sf = "/root/testdata/sf0.001"
    out = scratch_path(spark, "other-year")
    for t in ("lineitem", "supplier", "nation"):
        df = spark.read.parquet(f"{sf}/{t}.parquet")
        if t == "lineitem":
            df = df.withColumn("l_shipdate", F.when(F.year("l_shipdate") == 1995, F.lit(None))
                               .when(F.year("l_shipdate") == 2001,
                                     F.expr("l_shipdate + interval 3 years"))
                               .otherwise(F.col("l_shipdate")))
        df.write.parquet(f"{out}/{t}.parquet")
    seasons = {r["season"] for r in Warehouse(spark, out).silver().select("season").distinct().collect()}
    assert "2004" in seasons and not seasons & {"1995", "2001"}


def test_clusters_do_not_depend_on_shuffle_partitions(spark):
    features = Warehouse(spark, SF).features()
    before, found = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in (3, 8):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            rows = archetypes.cluster_playing_styles(features, "2000", restarts=2) \
                .select("code", "cluster", "cluster_label").collect()
            found.append(sorted(map(tuple, rows)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1]
