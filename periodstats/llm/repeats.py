"""Substring deduplication by relative Lempel-Ziv parsing against indexed reference blocks.

Documents are dealt into blocks by a hash; a block is read by one task and is at once text to
parse and reference for all others. What blocks ask each other travels as packed sorted hashes,
a question once a block however often its words occur there, so a passage in a third of all
documents weighs as much as any other.

1. ``anchors``: of every window of ``window`` words the smallest hash of ``anchor`` consecutive
   words inside it. Equal windows have equal anchors, and an anchor of one document only cannot
   lie in a repeated window. Blocks send their distinct anchors to the index, which answers
   with a bit each: whether two documents hold it.
2. ``index``: windows whose anchor is shared are indexed by hash with their first place in the
   block. The index answers with the first place of all blocks (smallest document, then place).
3. ``parse``: greedy from left to right. A factor begins at the first window with a place in a
   smaller document and goes on while the next window's place follows on in that document. At
   its end the windows across the border are checked one by one, as each may begin a factor of
   another document. Words outside factors are literals. All factors are at least ``window``
   words long, so their union is the duplicate text.

Three passes read the dealt documents, which are shuffled once. Windows are compared by 64-bit
hashes of their words: among n distinct windows some two collide with a chance of about
n * n / 2^65 (5e-4 for the 1.3e8 windows of 0.8 GB of text).

Defined results: null or empty texts have no words; a null ``doc_id`` is neither smaller nor
larger than another, so such a row keeps all words and is no reference; rows of one ``doc_id``
are not smaller than each other, so repeated rows are alike; every input row gives a row; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodstats.llm.hashing import hashed_words, mix


@dataclass(frozen=True)
class Settings:
    window: int = 13
    anchor: int = 6
    block_chars: int = 16_000_000    # a block holds about so much text at most,
    few_blocks: int = 1000           # and a quarter of it until there are so many blocks
    blocks_per_index: int = 4        # texts of so many blocks to a partition of the index

    def __post_init__(self) -> None:
        if not 0 < self.anchor <= self.window:
            raise ValueError("an anchor lies within a window")


def _copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal rows of a batch become one with their number, before anything is shuffled."""
    for batch in batches:
        found = pa.Table.from_batches([batch]).group_by(["id", "text"]).aggregate([([], "count_all")])
        yield from found.rename_columns(["id", "text", "copies"]).combine_chunks().to_batches()


def _grams(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words."""
    n = max(0, len(words) - size + 1)
    total = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        total += mix(words[k:k + n] ^ np.uint64(0x51ED270B * (k + 1)))
    return mix(total)


def _packed(at: np.ndarray, parts: int) -> Iterator[tuple[int, slice]]:
    """Index partition and slice of each run of equal partitions in sorted ``at``."""
    cut = np.searchsorted(at, np.arange(parts + 1))
    for p in np.flatnonzero(np.diff(cut)).tolist():
        yield p, slice(int(cut[p]), int(cut[p + 1]))


class _Block:
    """The documents of a block as hashed words, in a fixed order, with windows and anchors."""

    def __init__(self, rows: pa.Table, settings: Settings, parts: int) -> None:
        # Without an id a row takes no part; the order of rows must not matter.
        rows = rows.filter(pc.is_valid(rows["id"])).combine_chunks()
        self.ids = rows["id"].to_numpy().astype(np.int64)
        hashes, counts = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        if len(rows):
            for _, _, h, c in hashed_words(rows["text"].combine_chunks()):
                hashes.append(h)
                counts.append(c)
        words, self.counts = np.concatenate(hashes), np.concatenate(counts)
        self.first = np.concatenate(([0], np.cumsum(self.counts)))
        size, parts = settings.window, np.uint64(parts)
        starts = np.arange(max(0, len(words) - size + 1))
        row = np.repeat(np.arange(len(self.ids)), self.counts)[:len(starts)]
        valid = starts + size <= self.first[row + 1]
        gram = _grams(words, settings.anchor)
        least, where = gram[:len(starts)].copy(), starts.copy()
        for k in range(1, size - settings.anchor + 1):
            other = gram[k:k + len(starts)]
            less = other < least
            least[less] = other[less]
            where[less] = starts[less] + k
        self.start, self.row, anchor_of = starts[valid], row[valid], least[valid]
        self.window = _grams(words, size)[valid]
        # the distinct anchors, ordered by index partition, and whether two documents hold each
        ids = self.ids[self.row]
        order = np.lexsort((anchor_of, anchor_of % parts))
        a, ids = anchor_of[order], ids[order]
        begin = np.concatenate(([True], a[1:] != a[:-1]))[:len(a)]
        heads = np.flatnonzero(begin)
        self.anchors = a[heads]
        self.parts = (self.anchors % parts).astype(np.int64)
        if len(heads):
            self.many = np.maximum.reduceat(ids, heads) > np.minimum.reduceat(ids, heads)
        else:
            self.many = np.empty(0, dtype=bool)
        self.anchor_at = np.empty(len(a), np.int64)
        self.anchor_at[order] = np.cumsum(begin) - 1

    def keep_shared(self, answers: pa.Table) -> None:
        """Leave the windows whose anchor is shared; the distinct ones by index partition."""
        shared = self.many.copy()
        bits = dict(zip(answers["p"].to_pylist(), answers["bits"].to_pylist(), strict=True))
        for p, run in _packed(self.parts, int(self.parts.max(initial=-1)) + 1):
            found = np.unpackbits(np.frombuffer(bits[p], np.uint8), count=run.stop - run.start)
            shared[run] |= found.astype(bool)
        keep = shared[self.anchor_at]
        self.start, self.row, self.window = self.start[keep], self.row[keep], self.window[keep]

    def distinct(self, parts: int) -> None:
        place, ids = self.start - self.first[self.row], self.ids[self.row]
        order = np.lexsort((place, ids, self.window, self.window % np.uint64(parts)))
        w = self.window[order]
        begin = np.concatenate(([True], w[1:] != w[:-1]))[:len(w)]
        heads = order[begin]
        self.windows, self.home, self.place = self.window[heads], ids[heads], place[heads]
        self.parts = (self.windows % np.uint64(parts)).astype(np.int64)
        self.window_at = np.empty(len(w), np.int64)
        self.window_at[order] = np.cumsum(begin) - 1


def _ask_anchors(settings: Settings, parts: int):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        block = _Block(rows, settings, parts)
        runs = list(_packed(block.parts, parts))
        return pa.table({
            "p": pa.array([p for p, _ in runs], pa.int32()),
            "t": pa.array([key[0].as_py()] * len(runs), pa.int32()),
            "anchors": pa.array([block.anchors[r].tobytes() for _, r in runs], pa.binary()),
            "many": pa.array([np.packbits(block.many[r]).tobytes() for _, r in runs], pa.binary())})
    return run


def _answer_anchors(rows: pa.Table) -> pa.Table:
    asked = [np.frombuffer(x, np.uint64) for x in rows["anchors"].to_pylist()]
    many = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(a)).astype(bool)
            for x, a in zip(rows["many"].to_pylist(), asked, strict=True)]
    known, at, blocks = np.unique(np.concatenate(asked), return_inverse=True, return_counts=True)
    # An anchor of two blocks is taken as shared, though both may hold rows of one document.
    shared = blocks > 1
    shared[at[np.concatenate(many)]] = True
    cut = np.cumsum([len(a) for a in asked])[:-1]
    return pa.table({
        "t": rows["t"], "p": rows["p"],
        "bits": pa.array([np.packbits(x).tobytes() for x in np.split(shared[at], cut)], pa.binary())})


def _ask_windows(settings: Settings, parts: int):
    def run(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        block = _Block(rows, settings, parts)
        block.keep_shared(answers)
        block.distinct(parts)
        runs = list(_packed(block.parts, parts))
        return pa.table({
            "p": pa.array([p for p, _ in runs], pa.int32()),
            "t": pa.array([key[0].as_py()] * len(runs), pa.int32()),
            "windows": pa.array([block.windows[r].tobytes() for _, r in runs], pa.binary()),
            "home": pa.array([block.home[r].tobytes() for _, r in runs], pa.binary()),
            "place": pa.array([block.place[r].astype(np.int32).tobytes() for _, r in runs],
                              pa.binary())})
    return run


def _answer_windows(rows: pa.Table) -> pa.Table:
    """For each block: which of its windows begin in a smaller document elsewhere, and where."""
    def column(name: str, kind: type) -> list[np.ndarray]:
        return [np.frombuffer(x, kind) for x in rows[name].to_pylist()]

    windows, homes = column("windows", np.uint64), column("home", np.int64)
    sizes = [len(w) for w in windows]
    window, home = np.concatenate(windows), np.concatenate(homes)
    place = np.concatenate(column("place", np.int32))
    order = np.lexsort((place, home, window))
    w = window[order]
    begin = np.concatenate(([True], w[1:] != w[:-1]))[:len(w)]
    best = np.empty(len(w), np.int64)
    best[order] = order[np.flatnonzero(begin)[np.cumsum(begin) - 1]]
    less = home[best] < home
    out = []
    for lo, n in zip(np.cumsum([0, *sizes[:-1]]).tolist(), sizes, strict=True):
        at = np.flatnonzero(less[lo:lo + n])
        source = best[lo + at]
        out.append((at.astype(np.int32).tobytes(), home[source].tobytes(), place[source].tobytes()))
    return pa.table({"t": rows["t"], "p": rows["p"],
                     **{name: pa.array([x[i] for x in out], pa.binary())
                        for i, name in enumerate(("at", "home", "place"))}})


def parse(start: np.ndarray, row: np.ndarray, ids: np.ndarray, home: np.ndarray,
          place: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Factors (row, start, words, document, place) from the first places of windows.

    ``start`` is ordered; a window counts if its first place is in a smaller document.
    """
    hit = home < ids
    start, row, home, place = start[hit], row[hit], home[hit], place[hit]
    if not len(start):
        return start, start, start, home, place
    goes_on = ((start[1:] == start[:-1] + 1) & (row[1:] == row[:-1])
               & (home[1:] == home[:-1]) & (place[1:] == place[:-1] + 1))
    heads = np.flatnonzero(np.concatenate(([True], ~goes_on)))
    words = np.diff(np.concatenate((heads, [len(start)]))) + window - 1
    return row[heads], start[heads], words, home[heads], place[heads]


def _parsed(rows: pa.Table, anchors: pa.Table, answers: pa.Table, settings: Settings,
            parts: int) -> tuple[_Block, tuple[np.ndarray, ...]]:
    block = _Block(rows, settings, parts)
    block.keep_shared(anchors)
    block.distinct(parts)
    home, place = block.home.copy(), block.place.astype(np.int64)
    runs = dict(_packed(block.parts, parts))
    for p, at, h, q in zip(*(answers[c].to_pylist() for c in ("p", "at", "home", "place")),
                           strict=True):
        where = runs[p].start + np.frombuffer(at, np.int32)
        home[where] = np.frombuffer(h, np.int64)
        place[where] = np.frombuffer(q, np.int32)
    at = block.window_at
    return block, parse(block.start, block.row, block.ids[block.row], home[at], place[at],
                        settings.window)


#: What the last pass can return, one row a document or one a factor.
SCHEMAS = {
    "digests": "doc_id long, n_words long, n_removed long, kept_sha256 string, n_factors long",
    "texts": "doc_id long, n_words long, n_removed long, kept string, n_factors long",
    "factors": "doc_id long, start long, n_words long, ref_doc long, ref_start long"}


def _finish(settings: Settings, parts: int, what: str):
    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        of_anchors = answers.filter(pc.is_valid(answers["bits"]))
        of_windows = answers.filter(pc.is_valid(answers["at"]))
        block, (row, start, words, home, place) = _parsed(rows, of_anchors, of_windows, settings,
                                                          parts)
        place_in_row = start - block.first[row]
        known = rows.filter(pc.is_valid(rows["id"]))
        if what == "factors":
            times = known["copies"].to_numpy()[row]
            made = [block.ids[row], place_in_row, words, home, place.astype(np.int64)]
            return pa.table(dict(zip(("doc_id", "start", "n_words", "ref_doc", "ref_start"),
                                     [np.repeat(x, times) for x in made], strict=True)))
        change = np.zeros(block.first[-1] + 1, np.int32)
        np.add.at(change, start, 1)
        np.add.at(change, start + words, -1)
        keep = np.cumsum(change[:-1]) == 0
        factors = np.bincount(row, minlength=len(block.ids))
        out: list[tuple] = []
        for i, text in enumerate(known["text"].to_pylist()):
            mine = keep[block.first[i]:block.first[i + 1]]
            left = (text or "").encode().split()
            n = len(left)
            if not mine.all():
                left = list(compress(left, mine.tolist()))
            out.append((n, n - len(left), b" ".join(left), int(factors[i])))
        rest = rows.filter(pc.is_null(rows["id"]))
        for text in rest["text"].to_pylist():
            left = (text or "").encode().split()
            out.append((len(left), 0, b" ".join(left), 0))
        times = np.concatenate([known["copies"].to_numpy(), rest["copies"].to_numpy()]).astype(int)
        end = ([hashlib.sha256(x[2]).hexdigest() for x in out] if what == "digests"
               else [x[2].decode() for x in out])
        ids = known["id"].to_pylist() + [None] * len(rest)
        table = pa.table({
            "doc_id": pa.array(ids, pa.int64()), "n_words": pa.array([x[0] for x in out], pa.int64()),
            "n_removed": pa.array([x[1] for x in out], pa.int64()),
            "kept_sha256" if what == "digests" else "kept": pa.array(end, pa.string()),
            "n_factors": pa.array([x[3] for x in out], pa.int64())})
        return table.take(np.repeat(np.arange(len(out)), times)) if (times > 1).any() else table
    return run


def _run(docs: DataFrame, what: str, settings: Settings | None) -> DataFrame:
    s = settings or Settings()
    spark = docs.sparkSession
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col("doc_id").cast("long").alias("id"),
                        F.col("text").cast("string").alias("text"))
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    # Blocks follow from the amount of text alone: what they ask comes to a message a block and
    # index partition, or one an anchor if that is less.
    blocks = max(1, -(-chars // s.block_chars), min(s.few_blocks, -(-4 * chars // s.block_chars)))
    parts = -(-blocks // s.blocks_per_index)
    dealt = (texts.mapInArrow(_copies, "id long, text string, copies long")
             .withColumn("t", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)).cast("int"))
             .repartition(shuffle, "t"))
    asked = dealt.groupBy("t").applyInArrow(_ask_anchors(s, parts),
                                            "p int, t int, anchors binary, many binary")
    shared = asked.groupBy("p").applyInArrow(_answer_anchors, "t int, p int, bits binary")
    indexed = dealt.groupBy("t").cogroup(shared.groupBy("t")).applyInArrow(
        _ask_windows(s, parts), "p int, t int, windows binary, home binary, place binary")
    places = indexed.groupBy("p").applyInArrow(
        _answer_windows, "t int, p int, at binary, home binary, place binary")
    answers = shared.unionByName(places, allowMissingColumns=True)
    return dealt.groupBy("t").cogroup(answers.groupBy("t")).applyInArrow(
        _finish(s, parts, what), SCHEMAS[what])


def digests(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, n_factors."""
    return _run(docs, "digests", settings)


def remove_repeats(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the kept words joined by spaces), n_factors."""
    return _run(docs, "texts", settings)


def factors(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """doc_id, start, n_words, ref_doc, ref_start: words of a document as found in a smaller one."""
    return _run(docs, "factors", settings)


def oracle_sql(settings: Settings | None = None) -> str:
    """The same in DuckDB by comparing every window with all others."""
    size = (settings or Settings()).window
    return f"""
WITH rows AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''),
                     '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
windows AS (SELECT r, doc_id, i, array_to_string(w[i + 1:i + {size}], ' ') AS run
            FROM (SELECT r, doc_id, w, unnest(range(0, len(w) - {size - 1})) AS i FROM rows)),
least AS (SELECT run, min(doc_id) AS first FROM windows GROUP BY 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + {size})) AS i
         FROM windows JOIN least USING (run) WHERE first < doc_id),
gathered AS (SELECT r, list(i) AS gone FROM gone GROUP BY 1),
kept AS (SELECT r, doc_id, w, CASE WHEN gone IS NULL THEN w ELSE
           list_transform(list_filter(range(0, len(w)), lambda i: NOT list_contains(gone, i)),
                          lambda i: w[i + 1]) END AS left_over
         FROM rows LEFT JOIN gathered USING (r))
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - len(left_over))::BIGINT AS n_removed,
       sha256(array_to_string(left_over, ' ')) AS kept_sha256
FROM kept"""
