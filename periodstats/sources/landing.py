"""Bronze: land raw season files byte for byte, with lineage, and read their records per layout.

Raw layouts accepted (each season's player file carries its own header; old seasons lack
columns):
* one file per season and kind: ``<raw_root>/<season>/players_raw.csv`` and ``teams.csv``;
* one dataset per season and kind, as Spark's CSV writer makes it:
  ``<raw_root>/<kind>/season=<season>/part-*.csv``.

Bronze is three tables below ``bronze_root``, versioned and partitioned by season:
* ``lines``: every line of every landed file with its bytes, its number and place in its block
  and what it does to a quoted field (``sources.records``). Files are read once, by Spark's
  splittable text source, without a shuffle; no file is ever one record or one task;
* ``blocks``: one row per block of a file, with what the blocks before it come to;
* ``files``: one row per landed file - size and modification time from the file system, lines,
  data records, header, the digest of the bytes as they were read (``source_digest``) and of
  the landed lines read back (``landed_digest``), ingestion time, source.

Landing fails before anything is written when an expected (season, kind) file is missing or has
an empty part. The three tables are published by one pointer written last
(``sources.versions``), after sizes and digests have been compared: a season is landed whole or
not at all, also when the job dies in between. Landing a season again replaces it, others stay.
``bronze_rows`` parses records, not lines, by name - one ``from_csv`` per distinct header - and
orders them by (file ordinal, number of their first line). ``file_bytes`` gives the files back.
"""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from ..spec import RAW_FILES, B, L, S, struct_of
from . import records
from .versions import Layer

PLAYERS, TEAMS = RAW_FILES
SOURCE = "driver tables (TPC-H binding)"
_KINDS = "|".join(k.replace(".", r"\.") for k in RAW_FILES)
_PER_SEASON = rf"/([^/]+)/({_KINDS})$"          # <season>/<kind>
_WRITTEN = r"/([^/]+)/season=([^/]+)/[^/]+$"    # <kind>/season=<season>/part-*
#: The table of blocks is broadcast up to so many rows (some 50 MB; 64 TB of files in blocks of
#: 128 MB); beyond that lines are joined to it by file and block.
BROADCAST_BLOCKS = 500_000

_NAMES = [("season", S), ("file", S), ("path", S)]
LINES = struct_of([("season", S), ("file", S), *records.LINE_FIELDS])
BLOCKS = struct_of([*_NAMES, ("block", L), ("lines", L), ("bytes", L), ("d0", L), ("d1", L),
                    ("first_line", L), ("first_byte", L), ("inside", B), ("begun", L),
                    ("ends_inside", B)])
FILES = struct_of([*_NAMES, ("lines", L), ("data_lines", L), ("header", S), ("length", L),
                   ("landed_length", L), ("source_digest", S), ("landed_digest", S),
                   ("ends_inside", B), ("modificationTime", TimestampType()),
                   ("ingested_at", TimestampType()), ("source", S)])


def write_raw_files(frames: list[DataFrame], teams: DataFrame, raw_root: str) -> None:
    """Write raw season files: one CSV dataset per (kind, season), header included.

    ``frames`` are per-layout player frames (each with its own column set) carrying
    ``season`` and ``ingest_seq``; rows are written in (code, ingest_seq) order. The player
    layouts are written one after the other into the same dataset; the team files (another
    path) are written concurrently."""
    def players(df):
        cols = [c for c in df.columns if c != "ingest_seq"]
        # range partitions: a large season is split over several files, in code order
        (df.repartitionByRange("season", "code").sortWithinPartitions("code", "ingest_seq")
         .select(*cols).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("season").option("header", True).csv(f"{raw_root}/{PLAYERS}"))

    def team_files():
        (teams.repartition("season").sortWithinPartitions("id").write.mode("overwrite")
         .partitionBy("season").option("header", True).csv(f"{raw_root}/{TEAMS}"))

    with ThreadPoolExecutor(max_workers=1) as pool:
        teams_job = pool.submit(team_files)
        for df in frames:
            players(df)
        teams_job.result()


def _season_kind(path):
    single = path.rlike(_PER_SEASON)
    kind = F.when(single, F.regexp_extract(path, _PER_SEASON, 2)) \
        .otherwise(F.regexp_extract(path, _WRITTEN, 1))
    season = F.when(single, F.regexp_extract(path, _PER_SEASON, 1)) \
        .otherwise(F.regexp_extract(path, _WRITTEN, 2))
    return season.alias("season"), kind.alias("file")


def _file_meta(spark: SparkSession, raw_root: str) -> DataFrame:
    """(path, season, file, length, modificationTime) - file-system metadata only; the
    binaryFile source does not read file contents when ``content`` is not selected."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv") \
        .option("recursiveFileLookup", "true").load(raw_root)
    return files.select("path", *_season_kind(F.col("path")), "length", "modificationTime")


def expected_files(spark: SparkSession, seasons) -> DataFrame:
    """The (season, file) pairs that must arrive: configured seasons x required kinds."""
    kinds = F.explode(F.array(*[F.lit(k) for k in RAW_FILES])).alias("file")
    seasons_df = spark.createDataFrame([(str(s),) for s in seasons], "season string")
    return seasons_df.select("season", kinds)


def arrival_check(spark: SparkSession, raw_root: str, seasons) -> DataFrame:
    """Per expected (season, file): number of parts with bytes, bytes, parts without a byte,
    present, non-empty (no part without a byte)."""
    empty = _empty_parts(spark, raw_root, seasons)
    per = _file_meta(spark, raw_root).groupBy("season", "file").agg(
        F.count(F.lit(1)).cast("bigint").alias("parts"),
        F.sum("length").cast("bigint").alias("bytes"),
        F.max(F.col("path").rlike(_PER_SEASON)).alias("single"))
    out = expected_files(spark, seasons).join(per, ["season", "file"], "left") \
        .join(empty, ["season", "file"], "left")
    none = F.coalesce("empty_parts", F.lit(0))
    return out.select("season", "file", F.coalesce("parts", F.lit(0)).alias("parts"),
                      F.coalesce("bytes", F.lit(0)).alias("bytes"), none.alias("empty_parts"),
                      (F.col("parts").isNotNull() | (none > 0)).alias("present"),
                      ((F.coalesce("bytes", F.lit(0)) > 0) & (none == 0)).alias("non_empty"),
                      F.coalesce("single", F.lit(False)).alias("single"))


def _empty_parts(spark: SparkSession, raw_root: str, seasons) -> DataFrame:
    """(season, file, empty_parts): Spark's own listing leaves files without a byte out, so the
    expected folders are listed through the file system (names only, as Spark's driver does)."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = make(raw_root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = []
    for s in map(str, seasons):
        for kind in RAW_FILES:
            listed = [f for pattern in (f"{raw_root}/{s}/{kind}", f"{raw_root}/{kind}/season={s}/*.csv")
                      for f in fs.globStatus(make(pattern)) or [] if f.isFile()]
            found.append((s, kind, sum(f.getLen() == 0 for f in listed)))
    return spark.createDataFrame(found, "season string, file string, empty_parts long")


def land(spark: SparkSession, raw_root: str, bronze_root: str, seasons,
         source: str = SOURCE) -> DataFrame:
    """Land all seasons' raw files into Bronze; returns the manifest."""
    check = arrival_check(spark, raw_root, seasons).collect()  # seasons x kinds rows
    bad = [f"{r.season}/{r.file}" for r in check if not (r.present and r.non_empty)]
    if bad:
        raise FileNotFoundError(f"Expected raw file missing or empty: {bad}")
    paths = [f"{raw_root}/{r.season}/{r.file}" if r.single else
             f"{raw_root}/{r.file}/season={r.season}/*.csv" for r in check]
    layer = Layer(spark, bronze_root)
    known, _ = layer.current()
    version = layer.fresh()

    def write(table: str, df: DataFrame) -> DataFrame:
        path = layer.write_path(table, version)
        df.write.partitionBy("season").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    path = F.col("path")
    lines = write("lines", records.lines_of(spark, paths).select(
        *_season_kind(path), *[n for n, _ in records.LINE_FIELDS]))
    named = lines.select("season", "file", "path").distinct()  # from dictionaries, one row a file
    blocks = write("blocks", records.blocks_of(lines).join(named, "path"))
    placed = records.placed(lines, _near(blocks))
    read = blocks.groupBy("season", "file", "path").agg(
        F.sum("lines").alias("lines"), (F.sum(records.moved("d0", "first_byte", 0)) % records.P).alias("d0"),
        (F.sum(records.moved("d1", "first_byte", 1)) % records.P).alias("d1"), F.sum("bytes").alias("ended"),
        F.max_by("ends_inside", "block").alias("ends_inside"))
    starts = placed.groupBy("path").agg(
        F.count_if((F.col("record") == F.col("line_no")) & (F.col("line_no") > 0) & ~F.col("blank"))
        .alias("data_lines"))
    headers = records.records_of(placed.where("block = 0 AND record = 0"), ["path"]).select(
        "path", F.col("record").alias("header"))
    landed = records.digests_of(placed).select("path", F.col("d0").alias("l0"),
                                               F.col("d1").alias("l1"), F.col("bytes").alias("l"))
    meta = _file_meta(spark, raw_root).select("path", "length", "modificationTime")
    files = read.join(starts, "path").join(headers, "path").join(landed, "path").join(meta, "path")
    digest = records.file_digest
    files = write("files", files.select(
        "season", "file", "path", "lines", "data_lines", "header", "length",
        (F.col("l") + F.col("length") - F.col("ended")).alias("landed_length"),
        digest("d0", "d1", "ended", "length").alias("source_digest"),
        digest("l0", "l1", "l", F.col("l") + F.col("length") - F.col("ended")).alias("landed_digest"),
        "ends_inside", "modificationTime", F.current_timestamp().alias("ingested_at"),
        F.lit(source).alias("source")))
    wrong = files.where("source_digest <> landed_digest OR length <> landed_length "
                        "OR length NOT BETWEEN landed_length - 1 AND landed_length + 3") \
        .select("path").limit(5).collect()
    if wrong:
        raise OSError(f"landed bytes differ from the file's: {[r.path for r in wrong]}")
    layer.publish({str(s): version for s in seasons}, after=known)
    return manifest(spark, bronze_root)


def _near(blocks: DataFrame) -> DataFrame:
    small = blocks.limit(BROADCAST_BLOCKS + 1).count() <= BROADCAST_BLOCKS
    return F.broadcast(blocks) if small else blocks


def _placed(spark: SparkSession, bronze_root: str) -> DataFrame:
    layer = Layer(spark, bronze_root)
    return records.placed(layer.read("lines", LINES, "season"),
                          _near(layer.read("blocks", BLOCKS, "season")))


def read_lines(spark: SparkSession, bronze_root: str) -> DataFrame:
    """(season, file, path, line_no, line) of the landed files; a line keeps its ``\\r``."""
    return _placed(spark, bronze_root).select("season", "file", "path", "line_no",
                                              F.col("line").cast("string").alias("line"))


def read_files(spark: SparkSession, bronze_root: str) -> DataFrame:
    return Layer(spark, bronze_root).read("files", FILES, "season")


def file_bytes(spark: SparkSession, bronze_root: str) -> DataFrame:
    """(season, file, path, line_no, content): in order of line_no the contents of a path are its
    file, byte for byte."""
    files = read_files(spark, bronze_root).select("path", "lines", "length", "landed_length")
    sizes = read_sizes(spark, bronze_root)
    rows = _placed(spark, bronze_root).join(files.join(sizes, "path"), "path")
    more = F.col("length") - F.col("ended")  # -1: last line not ended, 3: byte-order mark, 2: both
    mark = F.when((F.col("line_no") == 0) & (more > 1), F.lit(records.BOM)).otherwise(F.lit(b""))
    last = (F.col("line_no") == F.col("lines") - 1) & more.isin(-1, 2)
    end = F.when(last, F.lit(b"")).otherwise(F.lit(b"\n"))
    return rows.select("season", "file", "path", "line_no",
                       F.concat(mark, F.col("line"), end).alias("content"))


def read_sizes(spark: SparkSession, bronze_root: str) -> DataFrame:
    """path, ended: bytes of a file's lines if each is ended by a line end."""
    return Layer(spark, bronze_root).read("blocks", BLOCKS, "season").groupBy("path").agg(
        F.sum("bytes").alias("ended"))


def manifest(spark: SparkSession, bronze_root: str) -> DataFrame:
    """One row per landed season: sorted file kinds, source, latest ingestion time (ISO)."""
    return read_files(spark, bronze_root).groupBy("season").agg(
        F.concat_ws(",", F.sort_array(F.collect_set("file"))).alias("files"),
        F.first("source").alias("source"),
        F.date_format(F.max("ingested_at"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
        .alias("ingested_at_utc"),
        F.count(F.lit(1)).cast("bigint").alias("parts"))


def data_rows(spark: SparkSession, bronze_root: str) -> DataFrame:
    """Data records (non-empty, after the header) per landed (season, file kind), with bytes, and
    whether every file's landed bytes are those that were read."""
    return read_files(spark, bronze_root).groupBy("season", "file").agg(
        F.sum("data_lines").cast("bigint").alias("data_rows"),
        F.sum("length").alias("bytes"),
        F.bool_and(F.col("length") == F.col("landed_length")).alias("same_length"),
        F.bool_and(F.col("source_digest") == F.col("landed_digest")).alias("same_digest"))


def header_names(header: str) -> list[str]:
    """Column names of a CSV header line (UTF-8 byte-order mark and quotes removed)."""
    names = next(csv.reader([header.lstrip("\ufeff")]))
    return [n.strip() for n in names]


def bronze_rows(spark: SparkSession, bronze_root: str, kind: str = PLAYERS) -> DataFrame:
    """Records of every landed file of ``kind`` as strings, one parse per header layout, with
    ``season`` and ``ingest_seq`` = (file ordinal in the season) << 32 + first line's number.

    A record may span lines inside quotes. A file that ends inside a quoted field is refused, as
    a CSV parser does. The per-file table (header, ordinal) is joined to the records by path."""
    files = read_files(spark, bronze_root).where(F.col("file") == kind)
    broken = [r.path for r in files.where("ends_inside").select("path").limit(5).collect()]
    if broken:
        raise ValueError(f"end of file inside a quoted field: {broken}")
    files = files.select("path", "header", F.row_number().over(
        Window.partitionBy("season").orderBy("path")).cast("bigint").alias("__file"))
    rows = records.records_of(_placed(spark, bronze_root).where(F.col("file") == kind),
                              ["season", "path"])
    rows = rows.where((F.col("line_no") > 0) & (F.length("record") > 0)).join(files, "path")
    # distinct layouts: one per schema change, a handful in any history
    layouts = [r.header for r in files.select("header").distinct().collect()]
    parts = []
    for header in layouts:
        schema = ", ".join(f"`{n}` STRING" for n in header_names(header))
        parsed = rows.where(F.col("header") == header).select(
            "season", "__file", "line_no",
            F.from_csv("record", schema, {"escape": '"', "multiLine": "true"}).alias("r"))
        parts.append(parsed.select("season", "__file", "line_no", "r.*"))
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return out.withColumn(
        "ingest_seq", F.shiftleft(F.col("__file"), 32) + F.col("line_no").cast("bigint")) \
        .drop("__file", "line_no")
