"""CSV sinks, checked by content, and the run metrics table.

Dimensions with a size bounded by configuration (positions, seasons, teams) and top-N lists are
written as one file each; everything else keeps its partitioning (one writer task per
partition), because its size grows with the data.

Rows and an order-free fingerprint (the sum of a hash of each row's typed values, so rows that
occur twice count twice) are observed by the job that writes; ``read_csv`` reads a sink back as
records, which may span lines inside quotes, split over tasks however large a file is.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import records

SMALL_TABLES = {"dim_position", "dim_season", "dim_team"}
#: Quotes doubled as RFC 4180 has it, and no white space taken off values.
CSV = {"header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false",
       "ignoreTrailingWhiteSpace": "false"}


def fingerprint(columns: list[str]) -> Column:
    """Order-free fingerprint of a multiset of rows, as an aggregate."""
    return F.coalesce(F.sum(F.xxhash64(*columns).cast("decimal(38,0)")),
                      F.lit(0).cast("decimal(38,0)"))


def write_csv(df: DataFrame, path: str, one_file: bool = False) -> dict:
    """Write with a header, replacing what is there; {"rows": n, "fingerprint": f} as written."""
    seen = Observation()
    out = df.observe(seen, F.count(F.lit(1)).alias("rows"), fingerprint(df.columns).alias("fingerprint"))
    out = out.coalesce(1) if one_file else out
    out.write.mode("overwrite").options(**CSV).csv(path)
    return seen.get


def export_tables(tables: dict[str, DataFrame], out_dir: str,
                  counts: dict[str, int] | None = None) -> dict[str, str]:
    """Write each table to ``<out_dir>/<name>.csv``; rows written go into ``counts``."""
    paths = {}
    for name, df in tables.items():
        paths[name] = f"{out_dir}/{name}.csv"
        seen = write_csv(df, paths[name], name in SMALL_TABLES)
        if counts is not None:
            counts[name] = int(seen["rows"])
    return paths


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows of a sink written by ``write_csv``."""
    lines = records.lines_of(spark, [path])
    placed = records.placed(lines, records.blocks_of(lines))
    rows = records.records_of(placed, ["path"]).where((F.col("line_no") > 0) & (F.length("record") > 0))
    # An absent value is written as nothing, an empty string in quotes; by default both read as absent.
    options = {"escape": '"', "multiLine": "true", "nullValue": "\u0000", "emptyValue": ""}
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return rows.select(F.from_csv("record", fields, options).alias("r")).select("r.*")


read_exported = read_csv


def compared(spark: SparkSession, name: str, df: DataFrame, path: str, one_file: bool = False) -> DataFrame:
    """One row: name, rows written, whether what is read back has as many rows and is equal."""
    seen = write_csv(df, path, one_file)
    back = read_csv(spark, path, df.schema).agg(F.count(F.lit(1)).alias("n"),
                                                fingerprint(df.columns).alias("f"))
    return back.select(F.lit(name).alias("table_name"), F.lit(int(seen["rows"])).alias("rows"),
                       (F.col("n") == seen["rows"]).alias("same_rows"),
                       (F.col("f") == F.lit(seen["fingerprint"])).alias("same_content"))


def count_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, rows) for every table, one aggregate per table, one union."""
    parts = [df.agg(F.count(F.lit(1)).cast("bigint").alias("rows"))
             .select(F.lit(n).alias("table_name"), "rows") for n, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)
