"""Spelling variant grouping by dense prefix-suffix tiling.

1. ``corpus_words``: runs of letters, counted over all documents; now and then a run loses one
   letter by a rule of its document and itself, which plants variants.
2. ``tiles``: two words a single edit apart share the first or the last half of the longer one
   (a common prefix and suffix of together at least its length less one cannot both be short).
   So a word takes part in four groups: by leading and by trailing half, as the longer of a
   pair and as the shorter. A group of more than ``block`` words is dealt into blocks by a hash
   of the word, and every pair of its blocks is a tile; no group is compared in one task.
3. ``near_pairs``: tiles are padded code-point matrices, aligned left for the common prefix and
   right for the common suffix, compared all against all; prefix plus suffix reaching the longer
   length less one is a single edit. A pair that shares both halves counts in the leading one.
4. ``variants``: a tile sends one row a word (how many are near, the best of them); rows of a
   word are merged, and roots follow forms by pointer doubling.

Defined results: a null text has no words, a null ``doc_id`` is the empty string in the rule of
step 1; repeated rows count each; a tie for a word's form goes to the smallest in code-point
order; an empty table gives an empty result; extra columns are ignored; words of any length are
compared whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodstats.llm.common import materialise

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Settings:
    min_length: int = 6
    min_count: int = 5
    ratio: int = 5                   # a form occurs at least so many times as often
    drop_every: int = 199            # a run whose checksum this divides loses a letter
    block: int = 1024                # words of a block; a tile is one or two blocks
    cells: int = 1 << 20             # matrix cells compared at once


def corpus_words(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """word, n: every word of enough length and occurrences."""
    s = settings or Settings()
    letters = f"[a-z\\u00C0-\\u00FF]{{{s.min_length},}}"  # a shorter run makes no word
    lower = F.translate(F.col("text").cast("string"), _UPPER, _LOWER)
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(lower, F.lit(letters), F.lit(0))).alias("run"))
    h = F.crc32(F.concat_ws(":", "id", "run"))
    at = F.pmod("h", F.length("run")).cast("int")
    kept = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    return (runs.withColumn("h", h)
            .select(F.when(F.col("h") % s.drop_every == 0, kept).otherwise(F.col("run")).alias("word"))
            .where(F.length("word") >= s.min_length)
            .groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= s.min_count))


def tiles(words: DataFrame, settings: Settings | None = None) -> DataFrame:
    """word, n, longer (length of the longer of a pair), leading, tile, part.

    ``part`` is the word's block in a tile of two blocks, and null in a tile of one.
    """
    s = settings or Settings()
    size = F.length("word")
    roles = F.array(*[F.struct((size + more).alias("longer"), F.lit(lead).alias("leading"))
                      for more in (0, 1) for lead in (True, False)])
    half = F.ceil((F.col("longer") - 1) / 2).cast("int")
    grouped = (words.select("word", "n", F.explode(roles).alias("r")).select("word", "n", "r.*")
               .withColumn("affix", F.when(F.col("leading"), F.col("word").substr(F.lit(1), half))
                           .otherwise(F.col("word").substr(F.length("word") - half + 1, half))))
    group = ["longer", "leading", "affix"]
    sizes = (grouped.groupBy(*group).agg(F.count("*").alias("words"),
                                         F.max(F.length("word") == F.col("longer")).alias("pairs"))
             .where("words > 1 and pairs")
             .withColumn("blocks", F.ceil(F.col("words") / s.block).cast("int")).drop("words", "pairs"))
    mine = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    pair = F.struct(F.least("mine", "other"), F.greatest("mine", "other"))
    return (grouped.join(sizes, group).withColumn("mine", mine)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("word", "n", "longer", "leading", F.xxhash64(*group, pair).alias("tile"),
                    F.when(F.col("mine") != F.col("other"), F.col("mine")).alias("part")))


def _matrix(words: list[bytes], width: int, right: bool) -> np.ndarray:
    pad = bytes.rjust if right else bytes.ljust
    return np.frombuffer(b"".join([pad(w, width, b"\0") for w in words]),
                         dtype=np.uint8).reshape(len(words), width)


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common start of every row of ``a`` with every row of ``b``."""
    alive = np.ones((len(a), len(b)), dtype=bool)
    total = np.zeros(alive.shape, dtype=np.int32)
    for c in range(a.shape[1]):
        alive &= a[:, c, None] == b[None, :, c]
        total += alive
        if c % 8 == 7 and not alive.any():
            break
    return total


def near_pairs(words: list[bytes], longer: np.ndarray, leading: np.ndarray, tile: np.ndarray,
               part: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices (longer word, other word) of all single edits inside the tiles of these rows."""
    size = np.array([len(w) for w in words])
    width = int(size.max())
    left, right = _matrix(words, width, False), _matrix(words, width, True)[:, ::-1]
    long_ones = np.flatnonzero(size == longer)
    half = -(-(longer - 1) // 2)
    found_a, found_b = [], []
    step = max(1, cells // max(1, len(words)))
    for lo in range(0, len(long_ones), step):
        a = long_ones[lo:lo + step]
        same = (tile[a, None] == tile[None, :]) & ((part[a, None] < 0) | (part[a, None] != part))
        # equal lengths: each pair once
        same &= (size[None, :] < size[a, None]) | (np.arange(len(words))[None, :] > a[:, None])
        if not same.any():
            continue
        start, end = _common(left[a], left), _common(right[a], right)
        hit = same & (start + end >= longer[a, None] - 1) & (start < width)
        hit &= leading[a, None] | (start < half[a, None])
        i, j = np.nonzero(hit)
        found_a.append(a[i])
        found_b.append(j)
    if not found_a:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(found_a), np.concatenate(found_b)


def _summary(words: list[bytes], n: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """One row a word with near words: their number and the best of them."""
    me, other = np.concatenate((a, b)), np.concatenate((b, a))
    rank = np.empty(len(words), np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((rank[other], -n[other], me))
    me, other = me[order], other[order]
    first = np.flatnonzero(np.concatenate(([True], me[1:] != me[:-1])))
    text = [w.decode("latin-1") for w in words]
    return pa.RecordBatch.from_arrays(
        [pa.array([text[i] for i in me[first]], pa.string()),
         pa.array(np.diff(np.concatenate((first, [len(me)]))), pa.int64()),
         pa.array([text[i] for i in other[first]], pa.string()),
         pa.array(n[other[first]], pa.int64())], names=["word", "n_near", "best", "best_n"])


def _compare(settings: Settings):
    columns = ["word", "n", "longer", "leading", "tile", "part"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        """Whole tiles, a few at a time: rows come ordered by length and tile."""
        held: list[pa.Table] = []
        count = 0
        for batch in batches:
            table = pa.Table.from_batches([batch]).select(columns)
            held.append(table)
            count += len(table)
            if count < 256:
                continue
            table = pa.concat_tables(held).combine_chunks()
            tile, longer = table["tile"].to_numpy(), table["longer"].to_numpy()
            cut = np.flatnonzero((tile[1:] != tile[:-1]) | (longer[1:] != longer[:-1])) + 1
            lo = 0
            while len(cut):
                at = np.searchsorted(cut, lo + 256)
                if at == len(cut):
                    break
                yield table.slice(lo, cut[at] - lo)
                lo = int(cut[at])
            held = [table.slice(lo)]
            count = len(table) - lo
        if count:
            yield pa.concat_tables(held).combine_chunks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in rows(batches):
            words = [w.encode("latin-1") for w in table["word"].to_pylist()]
            part = table["part"].to_numpy(zero_copy_only=False)
            a, b = near_pairs(words, table["longer"].to_numpy().astype(np.int64),
                              table["leading"].to_numpy(zero_copy_only=False).astype(bool),
                              table["tile"].to_numpy(),
                              np.nan_to_num(part.astype(float), nan=-1).astype(np.int64),
                              settings.cells)
            if len(a):
                yield _summary(words, table["n"].to_numpy(), a, b)
    return run


def with_near(words: DataFrame, settings: Settings | None = None) -> DataFrame:
    """word, n, n_near, best, best_n: near words of each word, and the most frequent of them."""
    s = settings or Settings()
    dealt = tiles(words, s).repartition("tile").sortWithinPartitions("longer", "tile")
    found = dealt.mapInArrow(_compare(s), "word string, n_near long, best string, best_n long")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
    merged = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
    return words.join(merged, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("b.best").alias("best"),
        (-F.col("b.less")).alias("best_n"))


def variants(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """word, form, root, n, n_near, form_n."""
    s = settings or Settings()
    words = materialise(corpus_words(docs, s), "words")
    taken = F.col("best_n") >= s.ratio * F.col("n")
    judged = materialise(with_near(words, s).select(
        "word", "n", "n_near", F.when(taken, F.col("best")).alias("form"),
        F.when(taken, F.col("best_n")).alias("form_n")), "near-words")
    # A form is more frequent than its word by the ratio, so chains end; each round doubles the
    # distance followed, and a table only holds words whose root is not reached yet or known.
    roots = judged.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        jump = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = materialise(roots.join(jump, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"),
            F.col("next").isNotNull().alias("moved")), "roots")
        if roots.where("moved").isEmpty():
            break
        roots = roots.select("word", "root")
    return judged.join(roots.select("word", "root"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def oracle_sql(settings: Settings | None = None) -> str:
    """The same in DuckDB: a checksum by bits, and near words by equal deletions."""
    s = settings or Settings()
    lower = "translate(text, '" + _UPPER + "', '" + _LOWER + "')"
    return f"""
WITH RECURSIVE bits AS (
  SELECT i, i AS c, 0 AS k FROM (SELECT unnest(range(0, 256))::BIGINT AS i)
  UNION ALL
  SELECT i, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1
  FROM bits WHERE k < 8),
tab AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
runs AS (
  SELECT id, run, hex(encode(id || ':' || run)) AS x, count(*) AS times FROM (
    SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all({lower},
           '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents)
  WHERE length(run) >= {s.min_length} GROUP BY 1, 2),
sums AS (
  SELECT run, times, xor(list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(range(0, length(x) // 2),
                   lambda i: ('0x' || x[2 * i + 1:2 * i + 2])::BIGINT)),
    lambda c, b: xor(c // 256, t[(xor(c % 256, b) + 1)::BIGINT])), 4294967295) AS h
  FROM runs, tab),
words AS (
  SELECT word, sum(times)::BIGINT AS n FROM (
    SELECT times, CASE WHEN h % {s.drop_every} = 0 THEN left(run, h % length(run))
           || substr(run, h % length(run) + 2) ELSE run END AS word FROM sums)
  WHERE length(word) >= {s.min_length} GROUP BY 1 HAVING sum(times) >= {s.min_count}),
cut AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest
        FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n AS m FROM cut a JOIN cut b USING (i, rest)
  WHERE a.word <> b.word
  UNION SELECT c.word, w.word, w.n FROM cut c JOIN words w ON w.word = c.rest
  UNION SELECT w.word, c.word, c.n FROM cut c JOIN words w ON w.word = c.rest),
best AS (
  SELECT word, count(*) AS n_near, max(m) AS top,
         (list(other ORDER BY m DESC, encode(other)))[1] AS best FROM near GROUP BY 1),
judged AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN top >= {s.ratio} * w.n THEN best END AS form,
         CASE WHEN top >= {s.ratio} * w.n THEN top END AS form_n
  FROM words w LEFT JOIN best b USING (word)),
chain AS (
  SELECT word, word AS root, form AS next FROM judged
  UNION ALL
  SELECT c.word, j.word, j.form FROM chain c JOIN judged j ON j.word = c.next)
SELECT j.word, j.form, c.root, j.n::BIGINT AS n, j.n_near::BIGINT AS n_near,
       j.form_n::BIGINT AS form_n
FROM judged j JOIN chain c ON c.word = j.word AND c.next IS NULL"""
