"""N-gram Jaccard join with Bayesian candidate pruning.

Texts are sets of five-word shingles; two texts are linked if the Jaccard similarity of their
sets is at least 0.8. The phases, each a Spark job over written intermediates:

1. ``_signatures``: shingle sets, a 128-bit set hash and a MinHash signature per row. Rows with
   equal sets are copies: one representative each goes on, with its number of copies.
2. ``_candidate_edges``: signatures are banded; a bucket (band value) with two or more
   representatives is compared pair by pair inside a task. MinHash values are compared a few
   at a time; a pair goes as soon as the posterior probability that its similarity reaches the
   threshold is below the tolerance. What survives is given as a spanning forest, never as
   pairs. A bucket larger than a block is dealt out as pairs of blocks.
3. Candidate components (``components``: min-label stars in DataFrame joins).
4. ``_verify``: the texts of each component meet in one task (or in pairs of blocks of bounded
   size); similarities are worked out exactly from the shingle sets. Per text the linked
   copies are counted, links between components are kept as a forest.
5. Components of the exact links are the classes.

Chance of missing a link: a pair at similarity 0.8 shares no band with probability
(1 - 0.8^4)^32 = 5e-8 and is pruned with about the tolerance; more similar pairs less.

Defined results: a text without words has no shingles, no links and a class of its own (null
text: empty); a text of one to four words is one shingle; rows with equal sets are copies and
linked, whatever their ids; the class id is the least doc_id of the class, null if all are
null; repeated rows each get a row; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodstats.llm.common import materialise, maybe_in
from periodstats.llm.hashing import hashed_words, mix, shingles

SIGNATURE = 128       # MinHash values a text
ROWS = 4              # MinHash values a band
STEP = 16             # MinHash values compared between two tests


@dataclass(frozen=True)
class Settings:
    words: int = 5
    numerator: int = 4            # threshold as a fraction, so that the check is exact
    denominator: int = 5
    tolerance: float = 1e-9       # posterior probability below which a pair is dropped
    bucket_block: int = 1024      # signatures of a block
    component_block: int = 256    # texts of a block
    component_shingles: int = 400_000

    @property
    def threshold(self) -> float:
        return self.numerator / self.denominator


_MULTIPLIERS = mix(np.arange(1, SIGNATURE + 1, dtype=np.uint64)) | np.uint64(1)


def signature(sets: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """16 bits of each MinHash value, one row a set; sets lie end to end, none is empty."""
    out = np.empty((len(starts), SIGNATURE), dtype=np.uint16)
    for k in range(SIGNATURE):
        least = np.minimum.reduceat(sets * _MULTIPLIERS[k], starts)
        out[:, k] = mix(least) & np.uint64(0xFFFF)
    return out


def set_hash(s: np.ndarray) -> tuple[int, int]:
    with np.errstate(over="ignore"):
        a = mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
        b = mix(s + np.uint64(0x14057B7EF767814F)).sum(dtype=np.uint64)
    return int(a.astype(np.int64)), int(b.astype(np.int64))


def least_matches(threshold: float, tolerance: float) -> tuple[int, ...]:
    """Least matches among STEP, 2 STEP, ... values for which a pair stays.

    With a uniform prior the posterior after m of n matches is Beta(m + 1, n - m + 1), and
    P(similarity >= t) = P(Binomial(n + 1, t) <= m).
    """
    out = []
    for n in range(STEP, SIGNATURE + 1, STEP):
        total = 0.0
        for m in range(n + 1):
            total += math.comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
            if total >= tolerance:
                out.append(m)
                break
    return tuple(out)


def prune(left: np.ndarray, right: np.ndarray, least_of: tuple[int, ...]) -> np.ndarray:
    """Mask of the pairs of signature rows that survive the incremental comparison."""
    alive, matches = np.arange(len(left)), np.zeros(len(left), dtype=np.int64)
    for k, least in enumerate(least_of):
        at = slice(k * STEP, (k + 1) * STEP)
        matches[alive] += (left[alive, at] == right[alive, at]).sum(axis=1)
        alive = alive[matches[alive] >= least]
    out = np.zeros(len(left), dtype=bool)
    out[alive] = True
    return out


# -- signatures --------------------------------------------------------------------------

_SIGNED = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("n_sh", pa.int32()),
                     ("h1", pa.int64()), ("h2", pa.int64()), ("sig", pa.binary())])


def _sign(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, words, counts in hashed_words(batch.column("text")):
                sets = [shingles(w, settings.words)
                        for w in np.split(words, np.cumsum(counts)[:-1])]
                full = [s for s in sets if len(s)]
                sizes = np.array([len(s) for s in full], dtype=np.int64)
                rows = iter(signature(np.concatenate(full), np.cumsum(sizes) - sizes)
                            if full else [])
                hashes = [set_hash(s) if len(s) else (0, 0) for s in sets]
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(lo, hi - lo), batch.column("th").slice(lo, hi - lo),
                    pa.array([len(s) for s in sets], pa.int32()),
                    pa.array([h[0] for h in hashes], pa.int64()),
                    pa.array([h[1] for h in hashes], pa.int64()),
                    pa.array([next(rows).tobytes() if len(s) else None for s in sets],
                             pa.binary())], schema=_SIGNED)
    return run


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int64(): "bigint", pa.int32(): "int", pa.binary(): "binary", pa.bool_(): "boolean"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def _signatures(docs: DataFrame, settings: Settings) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("th"),
                       F.col("text").cast("string"))
    return materialise(rows.mapInArrow(_sign(settings), _ddl(_SIGNED)), "signatures")


def _representatives(signed: DataFrame) -> DataFrame:
    """One row a distinct non-empty set, with doc_id and text hash of one of its rows (a null
    doc_id last); ``rid`` is fixed by the written table."""
    chosen = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "th"))
    least = (signed.filter("n_sh > 0").groupBy("h1", "h2")
             .agg(chosen.alias("rep"), F.count("*").alias("copies"),
                  F.first("n_sh").alias("n_sh"), F.first("sig").alias("sig"))
             .select("h1", "h2", F.col("rep.doc_id").alias("rep_doc"),
                     F.col("rep.th").alias("rep_th"), "copies", "n_sh", "sig"))
    return materialise(least.withColumn("rid", F.monotonically_increasing_id()), "reps")


# -- groups inside sorted partitions --------------------------------------------------------

def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of complete groups from a partition sorted by ``keys``; one group may wait."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        change = np.zeros(batch.num_rows - 1, dtype=bool)
        for k in keys:
            v = batch.column(k).to_numpy(zero_copy_only=False)
            change |= v[1:] != v[:-1]
        first_same = len(held) > 1 and all(
            held[-2].column(k)[-1].equals(batch.column(k)[0]) for k in keys)
        cuts = np.flatnonzero(change)
        if len(held) > 1 and not first_same:
            yield pa.Table.from_batches(held[:-1])
            held = held[-1:]
        if len(cuts):  # what follows the last change may go on in the next batch
            at = int(cuts[-1]) + 1
            yield pa.Table.from_batches([*held[:-1], batch.slice(0, at)])
            held = [batch.slice(at)]
    if held:
        yield pa.Table.from_batches(held)


def group_numbers(table: pa.Table, keys: list[str]) -> np.ndarray:
    change = np.zeros(table.num_rows, dtype=bool)
    for k in keys:
        v = table.column(k).to_numpy()
        change[1:] |= v[1:] != v[:-1]
    return np.cumsum(change)


def spanning_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least node of each node's component among n nodes and the edges a-b."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        np.minimum.at(label, before[a], low)
        np.minimum.at(label, before[b], low)
        label = label[label]
        if np.array_equal(label, before):
            break
    return label


def with_blocks(rows: DataFrame, group: str, blocks: Column) -> DataFrame:
    """Deal each group's rows to pairs of blocks (bi, bj); side tells which block a row is of.

    A group of one block is the single unit (0, 0). Else a row of block i goes to the units
    (i, j) and (j, i) with every other block, and to (i, i).
    """
    own = F.pmod(F.xxhash64("rid"), F.col("__n")).cast("int")
    return (rows.withColumn("__n", blocks.cast("int")).withColumn("__own", own)
            .withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)))
            .withColumns({"bi": F.least("__own", "__other"), "bj": F.greatest("__own", "__other"),
                          "side": F.when(F.col("__own") == F.col("__other"), 0)
                          .when(F.col("__own") < F.col("__other"), 1).otherwise(2)})
            .drop("__n", "__own", "__other")
            .repartition(group, "bi", "bj").sortWithinPartitions(group, "bi", "bj", "rid"))


# -- candidates --------------------------------------------------------------------------

_BANDED = pa.schema([("rid", pa.int64()), ("bucket", pa.int64())])


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n = SIGNATURE // ROWS
    salt = mix(np.arange(1, n + 1, dtype=np.uint64))
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.frombuffer(b"".join(batch.column("sig").to_pylist()), dtype=np.uint64)
        buckets = mix(values.reshape(-1, n) ^ salt).astype(np.int64)
        rid = np.repeat(batch.column("rid").to_numpy(), n)
        yield pa.RecordBatch.from_arrays([pa.array(rid), pa.array(buckets.ravel())],
                                         schema=_BANDED)


_EDGE = pa.schema([("src", pa.int64()), ("dst", pa.int64())])


def _compare(settings: Settings):
    keys = ["bucket", "bi", "bj"]
    least_of = least_matches(settings.threshold, settings.tolerance)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, keys):
            group, side = group_numbers(table, keys), table.column("side").to_numpy()
            rid = table.column("rid").to_numpy()
            sig = np.frombuffer(b"".join(table.column("sig").to_pylist()),
                                dtype=np.uint16).reshape(-1, SIGNATURE)
            # Row i is paired with the later rows of its group, a slice of rows at a time.
            past = np.searchsorted(group, group, "right")
            ahead = past - np.arange(len(group)) - 1
            found_a, found_b = [], []
            at = 0
            while at < len(group):
                to = max(at + 1, int(np.searchsorted(np.cumsum(ahead[at:]), 200_000)) + at)
                a = np.repeat(np.arange(at, min(to, len(group))), ahead[at:to])
                if len(a):
                    first = np.repeat(np.cumsum(ahead[at:to]) - ahead[at:to], ahead[at:to])
                    b = a + 1 + np.arange(len(a)) - first
                    cross = (side[a] == 0) | (side[a] != side[b])
                    a, b = a[cross], b[cross]
                    stay = prune(sig[a], sig[b], least_of)
                    found_a.append(a[stay])
                    found_b.append(b[stay])
                at = to
            if found_a:
                label = spanning_labels(len(group), np.concatenate(found_a),
                                        np.concatenate(found_b))
                moved = np.flatnonzero(label != np.arange(len(label)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rid[moved]), pa.array(rid[label[moved]])], schema=_EDGE)
    return run


def _candidate_edges(reps: DataFrame, settings: Settings) -> DataFrame:
    bands = reps.select("rid", "sig").mapInArrow(_bands, _ddl(_BANDED))
    shared = (bands.groupBy("bucket").agg(F.count("*").alias("m")).filter("m > 1")
              .withColumnRenamed("bucket", "__b"))
    members = bands.join(shared, F.col("bucket") == F.col("__b")).drop("__b")
    signed = members.join(reps.select(F.col("rid").alias("__r"), "sig"),
                          F.col("rid") == F.col("__r")).drop("__r")
    units = with_blocks(signed, "bucket", F.ceil(F.col("m") / settings.bucket_block))
    units = units.select("bucket", "bi", "bj", "side", "rid", "sig")
    return units.mapInArrow(_compare(settings), _ddl(_EDGE))


# -- components --------------------------------------------------------------------------

def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, label): the least node of each component that has an edge.

    Alternating large and small stars: every node's neighbours are attached to the least node
    it knows. Each step is an aggregation and a join, so a node with very many neighbours is
    summed before the shuffle and split in the join. Each round is written.
    """
    def attach(e: DataFrame, larger: bool) -> DataFrame:
        # e: (u, v) with u > v. Large star: neighbours above u; small star: those below.
        if larger:
            both = e.union(e.select("v", "u"))
            low = both.groupBy("u").agg(F.min("v").alias("m")) \
                .select(F.col("u").alias("__u"), F.least("u", "m").alias("m"))
            out = e.join(low, F.col("v") == F.col("__u")).select(F.col("u"), F.col("m").alias("v"))
        else:
            low = e.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "__u")
            out = (e.join(low, F.col("u") == F.col("__u")).filter("v > m")
                   .select(F.col("v").alias("u"), F.col("m").alias("v"))
                   .union(low.select(F.col("__u").alias("u"), F.col("m").alias("v"))))
        return out.filter("u > v").distinct()

    def mark(e: DataFrame) -> tuple:
        total = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        return tuple(e.agg(F.count("*"), total).first())

    e = materialise(edges.select(F.greatest("src", "dst").alias("u"),
                                 F.least("src", "dst").alias("v")).filter("u > v").distinct(),
                    "edges")
    seen = mark(e)
    for _ in range(most_rounds):
        if not seen[0]:
            break
        e = materialise(attach(attach(e, True), False), "stars")
        now = mark(e)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return stars.union(e.select(F.col("v"), F.col("v")).distinct())


# -- exact check -------------------------------------------------------------------------

_CHECKED = pa.schema([("src", pa.int64()), ("dst", pa.int64()), ("links", pa.int64())])


def _intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections; only shingles that two sets share count."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    value, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True,
                                       return_counts=True)
    shared = counts > 1
    number = np.cumsum(shared) - 1
    keep = shared[inverse]
    owner, column = owner[keep], number[inverse[keep]]
    out = np.zeros((n, n), dtype=np.float32)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    width = 4096
    for lo in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(column, [lo, lo + width])
        present = np.zeros((n, width), dtype=np.float32)
        present[owner[a:b], column[a:b] - lo] = 1
        out += present @ present.T
    return np.rint(out).astype(np.int64)


def _verify(settings: Settings):
    keys = ["label", "bi", "bj"]

    def sets_of(table: pa.Table) -> tuple[list[np.ndarray], list[int]]:
        """Shingle sets of the rows that are their representative's text, each once."""
        sets, at, done = [], [], set()
        h1, h2 = table.column("h1").to_numpy(), table.column("h2").to_numpy()
        rid, seen = table.column("rid").to_numpy(), 0
        for chunk in table.column("text").chunks:
            for lo, hi, words, counts in hashed_words(chunk):
                parts = np.split(words, np.cumsum(counts)[:-1])
                for i, w in enumerate(parts, seen + lo):
                    if rid[i] not in done and set_hash(s := shingles(w, settings.words)) \
                            == (h1[i], h2[i]):
                        done.add(rid[i])
                        sets.append(s)
                        at.append(i)
            seen += len(chunk)
        return sets, at

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for many in whole_groups(batches, keys):
            group = group_numbers(many, keys)
            starts = np.flatnonzero(np.diff(group, prepend=-1))
            for lo, hi in zip(starts, [*starts[1:], len(group)], strict=True):
                table = many.slice(lo, hi - lo)
                sets, at = sets_of(table)
                if len(sets) < 2:
                    continue
                rid = table.column("rid").to_numpy()[at]
                side = table.column("side").to_numpy()[at]
                copies = table.column("copies").to_numpy()[at]
                sizes = np.array([len(s) for s in sets], dtype=np.int64)
                inter = _intersections(sets)
                union = sizes[:, None] + sizes[None, :] - inter
                linked = inter * settings.denominator >= union * settings.numerator
                np.fill_diagonal(linked, False)
                linked &= (side[:, None] == 0) | (side[:, None] != side[None, :])
                a, b = np.nonzero(np.triu(linked))
                label = spanning_labels(len(sets), a, b)
                links = linked @ copies
                some = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rid[some]), pa.array(rid[label[some]]), pa.array(links[some])],
                    schema=_CHECKED)
    return run


def _checked_links(docs: DataFrame, reps: DataFrame, candidates: DataFrame,
                   settings: Settings) -> DataFrame:
    """(src, dst, links): per text and unit its linked rows and the forest of exact links."""
    sized = candidates.join(reps.drop("sig"), F.col("node") == F.col("rid")).drop("node")
    sized = materialise(sized, "candidates")
    totals = sized.groupBy("label").agg(F.count("*").alias("m"),
                                        F.sum("n_sh").alias("all_sh")) \
        .withColumnRenamed("label", "__l")
    needed = materialise(
        sized.join(totals, F.col("label") == F.col("__l")).drop("__l", "n_sh"), "needed")
    texts = docs.select(F.col("doc_id").cast("long").alias("__id"),
                        F.xxhash64("text").alias("__th"), F.col("text").cast("string"))
    # Most texts have no candidate partner. A doc_id (or none) may be that of many texts.
    wanted = maybe_in(needed, F.xxhash64("rep_doc", "rep_th"))
    # Rows alike in id and text are one; their texts would all meet the representative.
    texts = texts.filter(wanted(F.xxhash64("__id", "__th"))).groupBy("__id", "__th").agg(
        F.first("text").alias("text"))
    rows = needed.join(texts, F.col("rep_doc").eqNullSafe(F.col("__id"))
                       & (F.col("rep_th") == F.col("__th")))
    blocks = F.greatest(F.ceil(F.col("m") / settings.component_block),
                        F.ceil(F.col("all_sh") / settings.component_shingles))
    units = with_blocks(rows, "label", F.least(blocks, F.col("m"))).select(
        "label", "bi", "bj", "side", "rid", "h1", "h2", "copies", "text")
    return materialise(units.mapInArrow(_verify(settings), _ddl(_CHECKED)), "links")


# -- the join ----------------------------------------------------------------------------

def _classified(docs: DataFrame, settings: Settings) -> DataFrame:
    """Row by row: doc_id, th, class_id, n_links, n_copies (rows with the same set)."""
    signed = _signatures(docs, settings)
    reps = _representatives(signed)
    candidates = components(_candidate_edges(reps, settings))
    checked = _checked_links(docs, reps, candidates, settings)
    links = checked.groupBy(F.col("src").alias("__s")).agg(F.sum("links").alias("links"))
    classes = components(checked)
    found = (reps.drop("sig", "n_sh")
             .join(links, F.col("rid") == F.col("__s"), "left").drop("__s")
             .join(classes, F.col("rid") == F.col("node"), "left").drop("node")
             .withColumn("label", F.coalesce("label", "rid")))
    least = found.groupBy(F.col("label").alias("__l")).agg(F.min("rep_doc").alias("class_id"))
    found = found.join(least, F.col("label") == F.col("__l")).select(
        F.col("h1").alias("__h1"), F.col("h2").alias("__h2"), "class_id", "copies", "links")
    found = materialise(found, "classes")
    rows = signed.drop("sig").join(
        found, (F.col("h1") == F.col("__h1")) & (F.col("h2") == F.col("__h2"))
        & (F.col("n_sh") > 0), "left")
    has = F.col("n_sh") > 0
    return rows.select(
        "doc_id", "th", F.when(has, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.when(has, F.coalesce("links", F.lit(0)) + F.col("copies") - 1).otherwise(0)
        .cast("long").alias("n_links"),
        F.when(has, F.col("copies")).otherwise(1).cast("long").alias("n_copies"),
        has.alias("has_words"))


def similarity_join(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """doc_id, class_id, n_links (other rows at the threshold or above), n_copies; one row a row."""
    return _classified(docs.select("doc_id", "text"), settings or Settings()) \
        .select("doc_id", "class_id", "n_links", "n_copies")


def keep_one_per_class(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """The rows of ``docs`` without those that another row of their class stands for.

    The row with the least (doc_id, text hash) of a class stays; of rows alike in both, one.
    Texts without words all stay.
    """
    own = docs.columns
    rows = materialise(_classified(docs.select("doc_id", "text"), settings or Settings())
                       .filter("has_words"), "classified")
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"),
                   F.col("th").alias("th"))
    best = rows.groupBy(F.col("class_id").alias("__c")).agg(F.min(key).alias("best"),
                                                             F.count("*").alias("n")).filter("n > 1")
    judged = rows.join(best, F.col("class_id").eqNullSafe(F.col("__c")))
    wins = (F.col("best.doc_id").eqNullSafe(F.col("doc_id"))) & (F.col("best.th") == F.col("th"))
    spare = materialise(judged.groupBy("doc_id", "th").agg(
        F.max(wins).alias("wins"), F.count("*").alias("times"))
        .filter("not wins or times > 1"), "spare")
    spare = spare.select(F.col("doc_id").alias("__id"), F.col("th").alias("__th"),
                         F.col("wins").alias("__wins"))
    known = maybe_in(spare, F.xxhash64("__id", "__th"))
    out = docs.withColumn("__t", F.xxhash64(F.col("text").cast("string")))
    out = out.withColumn("__maybe", known(F.xxhash64(F.col("doc_id").cast("long"), "__t")))
    on = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__t") == F.col("__th"))
    judged_rows = out.filter("__maybe").join(spare, on, "left")
    single = judged_rows.filter("__wins is null").select(*own)
    repeated = judged_rows.filter("__wins").select(*own).dropDuplicates(["doc_id", "text"])
    return out.filter("not __maybe").select(*own).unionByName(single).unionByName(repeated)
