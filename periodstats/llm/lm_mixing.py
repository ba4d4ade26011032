"""LM scoring by online logistic context mixing.

Texts are streams of symbols: the most frequent tokens (the head) are one symbol each, any other
token is spelled (escape, its bytes, end of word), so every text has a probability. A symbol is
a path of binary decisions in a Huffman tree. Predictors for a decision:

* order 0: counts of the tree node;
* order 1 and 2: counts of the node hashed with the one or two symbols before it.

Their logits are mixed by weights that a gate (depth in the tree, word or spelling) selects, the
mixed probability is refined by an adaptive probability map, and both learn online while the
text is scored: a block of symbols is predicted with what was learned from the blocks before
it. Every text starts from the same weights, so a score depends on the text and the corpus
counts alone and not on how rows are dealt to tasks. Blocks double up to a bound, and all texts
of a batch are done block by block together.

From the corpus, over all training rows: counts of every token (summed per task, then by an
aggregation), and the decision counts of the predictors, as fixed-size blocks per task that are
summed by a shuffle. The head and the predictor tables are of fixed size and broadcast; counts
of the other tokens are joined.

Defined results: a null or empty text is its end token; a null doc_id belongs to the training
rows; repeated rows train and are scored one by one; without training rows every count is 0
and predictors say one half; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodstats.llm.common import materialise

END = b""  # the token that ends a text


@dataclass(frozen=True)
class Settings:
    head: int = 1 << 16          # most tokens that are symbols of their own
    least_count: int = 3         # and how often such a token occurs; rarer ones teach spelling
    table_bits: int = 18         # slots of each hashed predictor
    flush_tokens: int = 400_000  # distinct tokens counted in a task before they are given out
    split_bytes: int = 2_000_000  # bytes of texts split into words at once
    batch_symbols: int = 60_000  # symbols expanded at once
    first_block: int = 32        # symbols of a text before the first update
    last_block: int = 4096
    start_weights: tuple[float, float, float] = (0.6, 0.25, 0.15)
    apm_steps: int = 24
    apm_prior: float = 24.0


GATES = 10
_SLICE = 1024  # table slots in one row of the count shuffle


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1, F.lit(False))


def _texts(batch: pa.RecordBatch) -> pa.Array:
    return batch.column("text").cast(pa.large_binary()).fill_null(b"")


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words in lower case (A-Z only) of all texts, laid end to end, and how many each text has.

    Only ASCII is looked at, so the bytes need not be valid UTF-8.
    """
    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts.view(pa.large_string())))
    words = parts.flatten()
    some = pc.binary_length(words).to_numpy() > 0  # white space at a border gives empty strings
    before = np.concatenate(([0], np.cumsum(some)))
    counts = np.diff(before[parts.offsets.to_numpy()])
    return words.filter(pa.array(some)).view(pa.large_binary()), counts


def _laid_out(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all strings and the length of each."""
    offsets = np.frombuffer(strings.buffers()[1], dtype=np.int64)[
        strings.offset:strings.offset + len(strings) + 1] if len(strings) else np.zeros(1, np.int64)
    if offsets[0] == offsets[-1]:
        return np.empty(0, dtype=np.uint8), np.diff(offsets)
    data = np.frombuffer(strings.buffers()[2], dtype=np.uint8)
    return data[offsets[0]:offsets[-1]], np.diff(offsets)


def _runs(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of texts of at most ``most`` in all; a larger text comes alone."""
    lo = held = 0
    for i, size in enumerate(sizes.tolist()):
        if i > lo and held + size > most:
            yield lo, i
            lo, held = i, 0
        held += size
    if lo < len(sizes):
        yield lo, len(sizes)


def _pieces(texts: pa.Array, settings: Settings) -> Iterator[tuple[int, int]]:
    return _runs(pc.binary_length(texts).to_numpy(), settings.split_bytes)


# -- corpus counts -------------------------------------------------------------------------


def _count(settings: Settings):
    def merged(parts: list[pa.RecordBatch]) -> pa.Table:
        whole = pa.Table.from_batches(parts).group_by("token", use_threads=False)
        return whole.aggregate([("c", "sum")]).rename_columns({"c_sum": "c"}).select(["token", "c"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            texts = _texts(batch)
            for lo, hi in _pieces(texts, settings):
                times = words_of(texts.slice(lo, hi - lo))[0].value_counts()
                found = times.field("values").cast(pa.binary()), times.field("counts")
                ends = pa.array([END], pa.binary()), pa.array([hi - lo], pa.int64())
                parts += [pa.RecordBatch.from_arrays(list(x), names=["token", "c"])
                          for x in (found, ends)]
                held += len(times) + 1
                if held > 2 * settings.flush_tokens:
                    whole = merged(parts)
                    parts, held = whole.to_batches(), len(whole)
                    if held > settings.flush_tokens:
                        yield from parts
                        parts, held = [], 0
        if parts:
            yield from merged(parts).to_batches()
    return run


def token_counts(training: DataFrame, settings: Settings) -> DataFrame:
    parts = training.select(F.col("text").cast("string")).mapInArrow(
        _count(settings), "token binary, c bigint")
    return materialise(parts.groupBy("token").agg(F.sum("c").alias("c")), "token-counts")


def frequent(counts: DataFrame, settings: Settings) -> DataFrame:
    """The most frequent tokens, by whole classes of like counts, at most ``head`` of them.

    The number of tokens per class (16 a doubling of the count) settles the least class that
    fits; no task and no driver sorts the vocabulary.
    """
    classed = counts.filter(F.col("c") >= settings.least_count).withColumn(
        "class", F.floor(F.log2("c") * 16))
    sizes = {r["class"]: r["count"] for r in classed.groupBy("class").count().collect()}
    least, room = None, settings.head
    for k in sorted(sizes, reverse=True):
        room -= sizes[k]
        if room < 0:
            break
        least = k
    return classed.filter(F.col("class") >= F.lit(least)).select("token", "c")


# -- codes ---------------------------------------------------------------------------------

def huffman(weights: list[int]) -> list[list[tuple[int, int]]]:
    """Per symbol its path of (node, bit); nodes are numbered from 0, the root last."""
    n = len(weights)
    heap = [(w, i) for i, w in enumerate(weights)]
    heapq.heapify(heap)
    parent: dict[int, tuple[int, int]] = {}
    made = n
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        parent[a[1]], parent[b[1]] = (made, 0), (made, 1)
        heapq.heappush(heap, (a[0] + b[0], made))
        made += 1
    out = []
    for i in range(n):
        path, at = [], i
        while at in parent:
            at, bit = parent[at]
            path.append((at - n, bit))
        out.append(path[::-1])
    return out


class Codes:
    """Symbols: head tokens, escape, 256 bytes, end of word; their paths laid end to end."""

    def __init__(self, head: list[tuple[bytes, int]], rest: int) -> None:
        self.words = pa.array([t for t, _ in head], pa.large_binary())
        self.end = [t for t, _ in head].index(END)
        n = len(head)
        self.escape, self.byte, self.stop = n, n + 1, n + 257
        self.symbols = n + 258
        words = huffman([c for _, c in head] + [max(1, rest)])
        bytes_seen = np.ones(257, dtype=np.int64)
        for t, _ in head:
            if t:
                np.add.at(bytes_seen, np.frombuffer(t, dtype=np.uint8), 1)
                bytes_seen[256] += 1
        spelled = huffman(bytes_seen.tolist())
        shift = max(0, n)  # inner nodes of the first tree
        paths = words + [[(a + shift, b) for a, b in p] for p in spelled]
        self.length = np.array([len(p) for p in paths], dtype=np.int64)
        self.start = np.cumsum(self.length) - self.length
        flat = [x for p in paths for x in p]
        node = np.array([a for a, _ in flat], dtype=np.int32)
        bit = np.array([b for _, b in flat], dtype=np.int32)
        self.nodes = shift + 256
        # Gates of the places: words 0 to 7 by depth, spelling 8 and 9.
        symbol = np.repeat(np.arange(self.symbols), self.length)
        depth = np.arange(len(symbol)) - self.start[symbol]
        gate = np.where(symbol > self.escape, 8 + np.minimum(depth, 1), np.minimum(depth >> 1, 7))
        self.places = node << 5 | gate.astype(np.int32) << 1 | bit  # read at once, in ``expand``

    @classmethod
    def of(cls, state: dict) -> Codes:
        """From ``vars`` of another one; a broadcast carries plain values."""
        out = cls.__new__(cls)
        out.__dict__.update(state)
        return out

    def stream(self, texts: pa.Array | list[bytes]) -> tuple[np.ndarray, np.ndarray, Words]:
        """Symbols, the text of each, and the tokens behind them."""
        if isinstance(texts, list):
            texts = pa.array(texts, pa.large_binary())
        words, counts = words_of(texts)
        found = pc.index_in(words, value_set=self.words).fill_null(-1).to_numpy()
        sizes = counts + 1
        ends = np.cumsum(sizes) - 1
        is_word = np.ones(len(found) + len(texts), dtype=bool)
        is_word[ends] = False
        ids = np.full(len(is_word), self.end, dtype=np.int64)
        ids[is_word] = found
        rare = words.filter(pa.array(found < 0))
        spelled, rare_len = _laid_out(rare)
        width = np.ones(len(ids), dtype=np.int64)
        is_rare = ids < 0
        width[is_rare] = rare_len + 2
        at = np.cumsum(width) - width
        out = np.empty(int(width.sum()), dtype=np.int64)
        out[at[~is_rare]] = ids[~is_rare]
        if len(rare):
            first = at[is_rare]
            out[first] = self.escape
            out[first + rare_len + 1] = self.stop
            inside = np.arange(len(spelled)) - np.repeat(np.cumsum(rare_len) - rare_len, rare_len)
            out[np.repeat(first + 1, rare_len) + inside] = spelled + np.int64(self.byte)
        lengths = np.add.reduceat(width, ends + 1 - sizes)
        return out, np.repeat(np.arange(len(texts)), lengths), Words(sizes, ids, rare)


@dataclass(frozen=True)
class Words:
    sizes: np.ndarray  # tokens of each text, its end included
    ids: np.ndarray    # head numbers of the tokens of all texts, -1 outside the head
    rare: pa.Array     # the tokens outside, in order

    def head_counts(self) -> np.ndarray:
        return np.add.reduceat(self.ids >= 0, np.cumsum(self.sizes) - self.sizes, dtype=np.int64)

    def base_sums(self, base: np.ndarray) -> list[float]:
        """Exactly rounded sums of ``base`` over the head tokens of each text."""
        values = base[self.ids[self.ids >= 0]].tolist()
        ends = np.cumsum(self.head_counts()).tolist()
        return [math.fsum(values[a:b]) for a, b in zip([0, *ends], ends)]

    def rare_counts(self) -> tuple[pa.Array, pa.Array]:
        """Distinct tokens outside the head, per text, and how often each occurs there."""
        coded = self.rare.cast(pa.binary()).dictionary_encode()
        of_text = np.repeat(np.arange(len(self.sizes)), self.sizes)[self.ids < 0]
        size = len(coded.dictionary) + 1
        keys, times = np.unique(of_text * size + coded.indices.to_numpy(), return_counts=True)
        bounds = pa.array(np.searchsorted(keys, np.arange(len(self.sizes) + 1) * size), pa.int32())
        return (pa.ListArray.from_arrays(bounds, coded.dictionary.take(pa.array(keys % size))),
                pa.ListArray.from_arrays(bounds, pa.array(times, pa.int32())))


def _hash(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x7FEB352D)
    return (x ^ (x >> np.uint32(15))) * np.uint32(0x846CA68B)


def contexts(symbols: np.ndarray, texts: np.ndarray, none: int) -> tuple[np.ndarray, np.ndarray]:
    """32-bit hashes of the symbol before, and of the two before, within a text."""
    one = np.full(len(symbols), none, dtype=np.uint32)
    two = one.copy()
    same = texts[1:] == texts[:-1]
    one[1:][same] = symbols[:-1][same]
    same = texts[2:] == texts[:-2]
    two[2:][same] = symbols[:-2][same]
    h1 = _hash(one + np.uint32(0x9E3779B9))
    return h1, _hash(two * np.uint32(0x85EBCA6B) + h1)


def expand(codes: Codes, symbols: np.ndarray, h1: np.ndarray, h2: np.ndarray,
           bits: int) -> tuple[np.ndarray, ...]:
    """Decisions of each symbol; per decision its gate, node, bit and slots of orders 1 and 2."""
    n = codes.length[symbols]
    first = np.cumsum(n) - n
    where = np.arange(int(n.sum())) + np.repeat(codes.start[symbols] - first, n)
    place = codes.places[where]
    node = place >> 5
    salt = node.view(np.uint32) * np.uint32(0x9E3779B1)
    shift = np.uint32(32 - bits)
    s1 = ((np.repeat(h1, n) ^ salt) * np.uint32(0xC2B2AE35)) >> shift
    s2 = ((np.repeat(h2, n) ^ salt) * np.uint32(0x27D4EB2F)) >> shift
    return n, place >> 1 & 15, node, (place & 1).astype(np.uint8), s1, s2


# -- decision counts -----------------------------------------------------------------------

def _slots(codes: Codes, settings: Settings) -> int:
    total = codes.nodes + 2 * (1 << settings.table_bits)
    return -(-total // _SLICE) * _SLICE


def _tally(codes, settings: Settings):
    """Rows (slice, counts): decisions and ones per slot, as summed over the task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = Codes.of(codes.value)
        width = 1 << settings.table_bits
        seen = np.zeros((_slots(c, settings), 2), dtype=np.int64)  # zeros and ones per slot
        flat = seen.reshape(-1)
        for batch in batches:
            texts = _texts(batch)
            for lo, hi in _pieces(texts, settings):
                symbols, of_text, _ = c.stream(texts.slice(lo, hi - lo))
                h1, h2 = contexts(symbols, of_text, c.symbols)
                for a in range(0, len(symbols), settings.batch_symbols):
                    to = a + settings.batch_symbols
                    _, _, node, bit, s1, s2 = expand(c, symbols[a:to], h1[a:to], h2[a:to],
                                                     settings.table_bits)
                    base = 0
                    for slot, size in ((node, c.nodes), (s1, width), (s2, width)):
                        flat[2 * base:2 * (base + size)] += np.bincount(
                            (slot << 1) + bit, minlength=2 * size)
                        base += size
        counts = np.stack([seen[:, 0] + seen[:, 1], seen[:, 1]])
        parts = counts.reshape(2, -1, _SLICE)
        some = np.flatnonzero(parts[0].any(axis=1))
        if len(some):
            yield pa.RecordBatch.from_arrays(
                [pa.array(some.astype(np.int32)),
                 pa.array([parts[:, i].astype(np.int64).tobytes() for i in some], pa.binary())],
                names=["slice", "counts"])
    return run


def _sum_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at, total = None, None
    for batch in batches:
        for k, raw in zip(batch.column("slice").to_pylist(), batch.column("counts").to_pylist(),
                          strict=True):
            part = np.frombuffer(raw, dtype=np.int64)
            if k == at:
                total = total + part
                continue
            if at is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                    names=["slice", "counts"])
            at, total = k, part
    if at is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([at], pa.int32()), pa.array([total.tobytes()], pa.binary())],
            names=["slice", "counts"])


def predictor_logits(training: DataFrame, codes: Codes, shared, settings: Settings) -> np.ndarray:
    """Logits of all slots: nodes, then the two hashed tables. Fixed size, whatever the corpus."""
    kind = "slice int, counts binary"
    tallied = training.select(F.col("text").cast("string")).mapInArrow(_tally(shared, settings), kind)
    summed = tallied.repartition("slice").sortWithinPartitions("slice").mapInArrow(_sum_slices, kind)
    counts = np.zeros((_slots(codes, settings) // _SLICE, 2, _SLICE))
    for r in summed.collect():
        counts[r["slice"]] = np.frombuffer(r["counts"], dtype=np.int64).reshape(2, _SLICE)
    n, ones = counts[:, 0].ravel(), counts[:, 1].ravel()
    p = (ones + 0.4) / (n + 0.8)
    return np.clip(np.log(p / (1 - p)), -12, 12).astype(np.float32)


# -- mixing --------------------------------------------------------------------------------

def _at(table: np.ndarray, places: np.ndarray) -> np.ndarray:
    """``table[places]`` for places known to be inside."""
    return np.take(table, places.astype(np.intp, copy=False), mode="clip")


def block_edges(most: int, settings: Settings) -> np.ndarray:
    edges, size = [0], settings.first_block
    while edges[-1] <= most:
        edges.append(edges[-1] + size)
        size = min(2 * size, settings.last_block)
    return np.array(edges)


def log_probabilities(codes: Codes, logits: np.ndarray, symbols: np.ndarray, of_text: np.ndarray,
                      texts: int, settings: Settings) -> np.ndarray:
    """Natural log probability of each text."""
    width = 1 << settings.table_bits
    t0, t1, t2 = (logits[:codes.nodes], logits[codes.nodes:codes.nodes + width],
                  logits[codes.nodes + width:codes.nodes + 2 * width])
    h1, h2 = contexts(symbols, of_text, codes.symbols)
    first = np.searchsorted(of_text, np.arange(texts))
    place = np.arange(len(symbols)) - first[of_text]
    edges = block_edges(int(place.max()), settings)
    block = np.searchsorted(edges, place, "right") - 1
    # In a block, texts that end with it come last: nothing is predicted from what they teach.
    last = block[np.append(first[1:], len(symbols)) - 1]
    turn = 2 * block + (block == last[of_text])
    order = np.argsort(turn, kind="stable")
    bounds = np.searchsorted(turn[order], np.arange(2 * int(block.max()) + 3)).tolist()
    weights = np.repeat(np.array(settings.start_weights)[:, None], texts * GATES, axis=1)
    steps = settings.apm_steps
    centres = (np.arange(steps) + 0.5) / steps * 16 - 8
    apm_ones = np.tile(settings.apm_prior / (1 + np.exp(-centres)), texts * GATES)
    apm_all = np.full(texts * GATES * steps, settings.apm_prior)
    total = np.zeros(texts)
    for lo, going, hi in zip(bounds[:-2:2], bounds[1:-1:2], bounds[2::2], strict=True):
        at = order[lo:hi]
        n, gate, node, bit, s1, s2 = expand(codes, symbols[at], h1[at], h2[at],
                                            settings.table_bits)
        gate = np.repeat(of_text[at] * GATES, n) + gate
        x = [_at(t, s) for t, s in ((t0, node), (t1, s1), (t2, s2))]
        w = weights.astype(np.float32)
        z = _at(w[0], gate) * x[0]
        for j in (1, 2):
            z += _at(w[j], gate) * x[j]
        np.clip(z, -16, 16, out=z)
        p = np.exp(-z)
        p += 1
        np.divide(1, p, out=p)
        z += 8
        z *= steps / 16
        np.clip(z, 0, steps - 1, out=z)
        slot = gate * steps
        slot += z.astype(np.int64)
        chance = _at((apm_ones / apm_all).astype(np.float32), slot)
        chance += p
        chance *= 0.5
        # The chance of what happened: p for a one, 1 - p for a zero.
        chance -= bit == 0
        np.abs(chance, out=chance)
        np.maximum(chance, 1e-7, out=chance)
        np.log(chance, out=chance)
        own = of_text[at]  # in runs: one per text
        runs = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        before = np.append(0, np.cumsum(n))
        for text, a, b in zip(own[runs].tolist(), before[runs].tolist(),
                              before[np.append(runs[1:], len(n))].tolist(), strict=True):
            total[text] += chance[a:b].sum(dtype=np.float64)
        d = int(n[:going - lo].sum())  # decisions of texts that go on
        if not d:
            continue
        # One damped Newton step per gate from the errors of the block; the curvature is
        # shared by the three weights.
        p, gate, x = p[:d], gate[:d], [v[:d] for v in x]
        error, curve = bit[:d] - p, p * (1 - p)
        cells = texts * GATES
        down = np.bincount(gate, curve * (x[0] * x[0] + x[1] * x[1] + x[2] * x[2]), cells) + 20
        for j in range(3):
            weights[j] += np.bincount(gate, error * x[j], cells) / down
        seen = np.bincount(2 * slot[:d] + bit[:d], minlength=2 * len(apm_ones)).reshape(-1, 2)
        apm_ones += seen[:, 1]
        apm_all += seen[:, 0] + seen[:, 1]
    return total


_SCORED = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, n_bytes bigint, "
           "base_head double, score double, rare array<binary>, times array<int>")


def _score(shared, tables, settings: Settings):
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()),
                        ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                        ("n_bytes", pa.int64()), ("base_head", pa.float64()),
                        ("score", pa.float64()), ("rare", pa.list_(pa.binary())),
                        ("times", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, (logits, base) = Codes.of(shared.value), tables.value
        for batch in batches:
            texts = _texts(batch)
            for lo, hi in _pieces(texts, settings):
                symbols, of_text, words = codes.stream(texts.slice(lo, hi - lo))
                ends = np.searchsorted(of_text, np.arange(hi - lo + 1))
                logs = [log_probabilities(codes, logits, symbols[ends[a]:ends[b]],
                                          of_text[ends[a]:ends[b]] - a, b - a, settings)
                        for a, b in _runs(np.diff(ends), settings.batch_symbols)]
                rare, times = words.rare_counts()
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(lo, hi - lo),
                    batch.column("held_out").slice(lo, hi - lo),
                    pa.array(words.sizes, pa.int64()),
                    pa.array(words.head_counts(), pa.int64()),
                    pc.binary_length(texts.slice(lo, hi - lo)).cast(pa.int64()),
                    pa.array(words.base_sums(base), pa.float64()),
                    pa.array(np.concatenate(logs) / math.log(10), pa.float64()),
                    rare, times],
                    schema=schema)
    return run


def score_documents(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Per row its counts, unigram base score, model score (log10) and bits per byte."""
    settings = settings or Settings()
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")) \
        .withColumn("held_out", held_out())
    training = rows.filter("not held_out")
    counts = token_counts(training, settings)
    whole = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    n, v = whole["n"] or 0, whole["v"]
    found = sorted(((bytes(r["token"]), r["c"]) for r in frequent(counts, settings).collect()),
                   key=lambda x: (-x[1], x[0]))
    head = found if any(t == END for t, _ in found) else [*found, (END, 0)]
    known = {t for t, c in head if c}
    codes = Codes(head, n - sum(c for _, c in head))
    shared = spark.sparkContext.broadcast(vars(codes))
    logits = predictor_logits(training, codes, shared, settings)
    scale = n + 0.5 * (v + 1)
    base = np.array([math.log10((c + 0.5) / scale) for _, c in head])
    tables = spark.sparkContext.broadcast((logits, base))
    scored = materialise(rows.mapInArrow(_score(shared, tables, settings), _SCORED)
                         .withColumn("rid", F.monotonically_increasing_id()), "scored")
    # Tokens outside the head: their counts are joined, whatever their number.
    other = scored.select("rid", F.explode(F.arrays_zip("rare", "times")).alias("t")).select(
        "rid", F.col("t.rare").alias("rare"), F.col("t.times").alias("times"))
    rest = counts.withColumnRenamed("token", "__token")
    joined = other.join(rest, F.col("rare") == F.col("__token"), "left")
    c = F.coalesce("c", F.lit(0))
    term = F.col("times") * F.log10((c + 0.5) / F.lit(scale))
    extra = joined.groupBy(F.col("rid").alias("__rid")).agg(
        F.sum(term).alias("base_rare"), F.sum(F.when(c > 0, F.col("times"))).alias("known_rare"))
    out = scored.drop("rare", "times").join(extra, F.col("rid") == F.col("__rid"), "left")
    never = 0 if END in known else 1  # an end that no training row has counted is not known
    return out.select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") - never + F.coalesce("known_rare", F.lit(0))).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base_head") + F.coalesce("base_rare", F.lit(0.0))).alias("base_score"), "score",
        F.when(F.col("n_bytes") > 0, -F.col("score") * math.log2(10) / F.col("n_bytes"))
        .alias("bits_per_byte"))
