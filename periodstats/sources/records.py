"""Lines, bytes and CSV records of files of any size.

A file is read in blocks by many tasks and no task sees what came before its block, but three
things depend on it: a line's number, its place in the file, and whether it begins a record or
goes on inside a quoted field. Each is worked out per block for what the block does on its own
and put together over the blocks of a file, one row a block:

* numbers and places are sums over the earlier blocks;
* inside a quoted field or not is a state of two values. A line maps the state at its start to
  the state at its end - most leave it as it is, some set it, some turn it round - and so does
  a block. A block is read for both states it may begin in; the right one follows from the last
  earlier block that sets the state and the number of turns since;
* a digest of bytes is a polynomial in their places, so digests of ranges add up in any order
  to the digest of the file: sum of (byte + 1) * base ^ place modulo 2^31 - 1, for two bases.

Line ends are kept as data: lines are cut at ``\\n`` only, a ``\\r`` before it belongs to the
line. Whether a file ends in a line end, or begins with a byte-order mark (which Spark's reader
takes off), follows from its length.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, IntegerType, LongType, StringType

# Functions sent to executors carry their code, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

P = (1 << 31) - 1
BASES = (48_271, 69_621)
BOM = b"\xef\xbb\xbf"
_CHUNK = 1 << 16
_WHOLE = r'(?:"(?:[^"]|"")*"(?:[^",][^,]*)?|[^",][^,]*)?'        # a field that ends in its line
_OPENS = f'^(?:{_WHOLE},)*"(?:[^"]|"")*$'                         # its last field does not
_STAYS = r'^(?:[^"]|"")*$'                                        # begun inside: never closed
_REOPENS = f'^(?:[^"]|"")*"(?:[^",][^,]*)?(?:,{_WHOLE})*,"(?:[^"]|"")*$'

LINE_FIELDS = [("path", StringType()), ("block", LongType()), ("idx", LongType()),
               ("off", LongType()), ("size", IntegerType()), ("blank", BooleanType()),
               ("opens", BooleanType()), ("back_out", IntegerType()), ("back_in", IntegerType()),
               ("end_out", BooleanType()), ("end_in", BooleanType()), ("d0", LongType()),
               ("d1", LongType()), ("line", BinaryType())]
LINE_SCHEMA = ", ".join(f"{n} {t.simpleString()}" for n, t in LINE_FIELDS)


# -- digests -------------------------------------------------------------------------------

def powers(base: int, n: int) -> np.ndarray:
    """base ^ 0, 1, ... n - 1 modulo P."""
    out = np.ones(1, dtype=np.uint64)
    while len(out) < n:
        out = np.concatenate((out, out * np.uint64(pow(base, len(out), P)) % np.uint64(P)))
    return out[:n]


_POWERS = {b: powers(b, _CHUNK) for b in BASES}


def digest(data: np.ndarray, place: int, base: int) -> int:
    """Digest of a run of bytes that stands at ``place`` of its file."""
    total = 0
    for lo in range(0, len(data), _CHUNK):
        part = data[lo:lo + _CHUNK].astype(np.uint64) + np.uint64(1)
        value = int((part * _POWERS[base][:len(part)]).sum()) % P
        total += value * pow(base, place + lo, P)
    return total % P


def _power_of(base: int, places: np.ndarray) -> np.ndarray:
    """base ^ place for many places."""
    out, square, left = np.ones(len(places), np.uint64), np.uint64(base), places.astype(np.uint64)
    while left.any():
        odd = (left & np.uint64(1)).astype(bool)
        out[odd] = out[odd] * square % np.uint64(P)
        square = square * square % np.uint64(P)
        left = left >> np.uint64(1)
    return out


def line_digests(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, places: np.ndarray,
                 base: int) -> np.ndarray:
    """Digest of each of many lines, whose bytes lie one after the other in ``data``."""
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    longest = int(sizes.max(initial=0))
    table = _POWERS[base] if longest <= _CHUNK else powers(base, longest)
    at = np.arange(len(data)) - np.repeat(starts, sizes)
    terms = (data.astype(np.uint64) + np.uint64(1)) * table[at] % np.uint64(P)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms)))  # under 2^31 * 2^33
    value = (sums[starts + sizes] - sums[starts]) % np.uint64(P)
    return value * _power_of(base, places) % np.uint64(P)


def hex_digest(first: int, second: int, ended: int, length: int) -> str:
    """Digest of a file's bytes from that of its lines, each taken as ended by a line end.

    ``ended`` is the length of those lines with their ends. ``length`` is the file's: one less
    if its last line has no end, three more if it begins with a byte-order mark."""
    mark = length - ended > 1
    unended = (length - ended - 3 * mark) == -1
    out = []
    for value, base in zip((first, second), BASES, strict=True):
        value = value % P
        if unended:
            value -= (ord("\n") + 1) * pow(base, ended - 1, P)
        if mark:
            value = value * pow(base, 3, P) + digest(np.frombuffer(BOM, np.uint8), 0, base)
        out.append(value % P)
    return f"{out[0]:08x}{out[1]:08x}"


def file_digest(first: str, second: str, ended: str, length: Column) -> Column:
    """``hex_digest`` of the named columns, one row a file."""
    @F.pandas_udf("string")
    def combined(a: pd.Series, b: pd.Series, e: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([hex_digest(*map(int, row)) for row in zip(a, b, e, n, strict=True)],
                         dtype=object)
    return combined(first, second, ended, length)


def moved(value: str, place: str, which: int) -> Column:
    """A range's digest moved to the range's place in its file."""
    base = BASES[which]

    @F.pandas_udf("long")
    def move(v: pd.Series, p: pd.Series) -> pd.Series:
        return pd.Series([int(x) * pow(base, int(y), P) % P for x, y in zip(v, p, strict=True)],
                         dtype="int64")
    return move(value, place)


# -- lines of blocks -----------------------------------------------------------------------

def _states(sets: np.ndarray, value: np.ndarray, turns: np.ndarray, start: bool) -> np.ndarray:
    """State before each line and after the last: lines that set it, turn it round, or neither."""
    n = len(sets)
    turned = np.concatenate(([0], np.cumsum(turns)))
    last = np.maximum.accumulate(np.concatenate(([-1], np.where(sets, np.arange(n), -1))))
    base = np.where(last >= 0, value[last] if n else False, start)
    since = turned - np.where(last >= 0, turned[last + 1], 0)
    return base ^ (since % 2 == 1)


class _Run:
    """What is known of a block up to the lines read so far."""

    def __init__(self) -> None:
        self.lines, self.bytes = 0, 0
        self.state = [False, True]     # inside a quoted field, if the block begins outside, inside
        self.first = [-1, -1]          # line that began the record at hand, in either case

    def add(self, path: str, block: int, lines: pa.Array) -> pa.RecordBatch:
        n = len(lines)
        sizes = pc.binary_length(lines).to_numpy().astype(np.int64)
        quoted = np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False))
        opens, stays = np.zeros(n, dtype=bool), np.ones(n, dtype=bool)
        if len(quoted):
            some = lines.take(pa.array(quoted))

            def fits(pattern: str) -> np.ndarray:
                return pc.match_substring_regex(some, pattern).to_numpy(zero_copy_only=False)
            opens[quoted] = fits(_OPENS)
            stays[quoted] = fits(_STAYS).astype(bool) | fits(_REOPENS).astype(bool)
        index = self.lines + np.arange(n)
        back, ends = [], []
        for case in (0, 1):
            state = _states(opens == stays, opens, opens & ~stays, self.state[case])
            first = np.maximum.accumulate(np.where(~state[:-1], index, self.first[case]))
            back.append(np.where(first >= 0, index - first, -1))
            ends.append(bool(state[-1]))
            self.first[case], self.state[case] = int(first[-1]), bool(state[-1])
        offsets = self.bytes + np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
        data = np.frombuffer(b"\n".join(lines.to_pylist()) + b"\n", dtype=np.uint8)
        values = [digest(data, self.bytes, b) for b in BASES]
        blank = (sizes == 0) | ((sizes == 1) & pc.equal(lines, pa.scalar(b"\r")).to_numpy(zero_copy_only=False))
        self.lines, self.bytes = self.lines + n, self.bytes + len(data)

        def at_end(value, kind: pa.DataType) -> pa.Array:
            return pa.array([None] * (n - 1) + [value], kind)
        return pa.RecordBatch.from_arrays(
            [pa.array([path] * n), pa.array([block] * n, pa.int64()), pa.array(index),
             pa.array(offsets), pa.array(sizes.astype(np.int32)), pa.array(blank), pa.array(opens),
             pa.array(back[0].astype(np.int32)), pa.array(back[1].astype(np.int32)),
             at_end(ends[0], pa.bool_()), at_end(ends[1], pa.bool_()),
             at_end(values[0], pa.int64()), at_end(values[1], pa.int64()), lines],
            names=[n for n, _ in LINE_FIELDS])


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    run, at = _Run(), None
    for batch in batches:
        paths, blocks = batch.column("path"), batch.column("block").to_numpy()
        codes = paths.dictionary_encode().indices.to_numpy()
        cut = np.flatnonzero((codes[1:] != codes[:-1]) | (blocks[1:] != blocks[:-1])) + 1
        for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), len(batch)], strict=True):
            if lo == hi:
                continue
            here = (paths[lo].as_py(), int(blocks[lo]))
            if here != at:
                run, at = _Run(), here
            yield run.add(*here, batch.column("line").slice(lo, hi - lo))


def lines_of(spark: SparkSession, paths: list[str]) -> DataFrame:
    """LINE_SCHEMA rows of all lines below ``paths``: one scan, no shuffle."""
    text = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").text(paths)
    raw = text.select(F.col("_metadata.file_path").alias("path"),
                      F.col("_metadata.file_block_start").alias("block"),
                      F.col("value").cast("binary").alias("line"))
    return raw.mapInArrow(_numbered, LINE_SCHEMA)


def blocks_of(lines: DataFrame) -> DataFrame:
    """One row a block of a file: its own sums, and what the blocks before it come to.

    path, block, lines, bytes, d0, d1, first_line, first_byte, inside (begins inside a quoted
    field), begun (line that began the record at hand, if any), ends_inside."""
    own = lines.groupBy("path", "block").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.col("size") + F.lit(1)).alias("bytes"),
        (F.sum("d0") % P).alias("d0"), (F.sum("d1") % P).alias("d1"),
        F.max_by("end_out", F.when(F.col("end_out").isNotNull(), F.col("idx"))).alias("end_out"),
        F.max_by("end_in", F.when(F.col("end_in").isNotNull(), F.col("idx"))).alias("end_in"),
        F.max(F.when(F.col("back_out") == 0, F.col("idx"))).alias("last_out"),
        F.max(F.when(F.col("back_in") == 0, F.col("idx"))).alias("last_in"))
    order = Window.partitionBy("path").orderBy("block")
    before, upto = order.rowsBetween(Window.unboundedPreceding, -1), \
        order.rowsBetween(Window.unboundedPreceding, 0)
    turn = (F.col("end_out") & ~F.col("end_in")).cast("int")
    fixed = F.col("end_out") == F.col("end_in")
    own = own.withColumns({
        "first_line": F.coalesce(F.sum("lines").over(before), F.lit(0)),
        "first_byte": F.coalesce(F.sum("bytes").over(before), F.lit(0)),
        "__turns": F.sum(turn).over(upto)})
    own = own.withColumns({
        "__set": F.last(F.when(fixed, F.col("end_out")), True).over(before),
        "__at": F.last(F.when(fixed, F.col("__turns")), True).over(before),
        "__now": F.coalesce(F.lag("__turns").over(order), F.lit(0))})
    odd = (F.col("__now") - F.coalesce("__at", F.lit(0))) % 2 == 1
    own = own.withColumn("inside", F.coalesce("__set", F.lit(False)) != odd)
    last = F.when(F.col("inside"), F.col("last_in")).otherwise(F.col("last_out"))
    own = own.withColumn("__last", F.col("first_line") + last)
    return own.withColumns({
        "begun": F.max("__last").over(before),
        "ends_inside": F.when(F.col("inside"), F.col("end_in")).otherwise(F.col("end_out"))}).select(
        "path", "block", "lines", "bytes", "d0", "d1", "first_line", "first_byte", "inside",
        "begun", "ends_inside")


def placed(lines: DataFrame, blocks: DataFrame) -> DataFrame:
    """Lines with line_no, place (first byte in the file without a byte-order mark), record (the
    line that begins their record) and whole (the line is its record). Blocks are few."""
    back = F.when(F.col("inside"), F.col("back_in")).otherwise(F.col("back_out"))
    out = lines.join(blocks.select("path", "block", "first_line", "first_byte", "inside", "begun"),
                     ["path", "block"])
    number = F.col("first_line") + F.col("idx")
    return out.withColumns({
        "line_no": number, "place": F.col("first_byte") + F.col("off"),
        "record": F.when(back >= 0, number - back).otherwise(F.col("begun")),
        "whole": (back == 0) & ~F.col("opens")})


def records_of(lines: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, line_no, record): CSV records by the number of their first line, without the last
    line end. Lines that are whole records pass as they are; only others are put together."""
    whole = lines.where("whole").select(*keys, "line_no", F.col("line").cast("string").alias("record"))
    parts = lines.where("NOT whole").groupBy(*keys, F.col("record").alias("line_no")).agg(
        F.sort_array(F.collect_list(F.struct(F.col("line_no").alias("n"),
                                             F.col("line").cast("string").alias("line")))).alias("parts"))
    joined = F.concat_ws("\n", F.transform("parts", lambda p: p["line"]))
    both = whole.unionByName(parts.select(*keys, "line_no", joined.alias("record")))
    return both.withColumn("record", _without_return(F.col("record")))


def _without_return(record: Column) -> Column:
    return F.when(record.endswith("\r"), record.substr(F.lit(1), F.length(record) - 1)).otherwise(record)


def digests_of(lines: DataFrame) -> DataFrame:
    """path, d0, d1, bytes from placed lines in any order (what was landed, not what was read)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            column = batch.column("line").to_pylist()
            data = np.frombuffer(b"\n".join(column) + b"\n", dtype=np.uint8)
            sizes = np.array([len(x) + 1 for x in column], dtype=np.int64)
            starts = np.cumsum(sizes) - sizes
            places = batch.column("place").to_numpy()
            values = [line_digests(data, starts, sizes, places, b).astype(np.int64) for b in BASES]
            found = pa.table({"path": batch.column("path"), "d0": values[0], "d1": values[1],
                              "bytes": sizes}).group_by("path").aggregate(
                [("d0", "sum"), ("d1", "sum"), ("bytes", "sum")])
            yield from found.rename_columns(["path", "d0", "d1", "bytes"]).combine_chunks().to_batches()

    summed = lines.select("path", "place", "line").mapInArrow(
        run, "path string, d0 long, d1 long, bytes long")
    return summed.groupBy("path").agg((F.sum(F.col("d0") % P) % P).alias("d0"),
                                      (F.sum(F.col("d1") % P) % P).alias("d1"),
                                      F.sum("bytes").alias("bytes"))
