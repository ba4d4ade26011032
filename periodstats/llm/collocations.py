"""Phrase collocation mining by direct-address tiling.

1. ``blocks``: each task reads its texts into blocks of bounded size and keeps, a block and
   language, the texts as numbers of the block's own distinct words. The distinct words go to
   the index (dealt by a hash of the word) with their counts.
2. The index sums counts, and gives words that are frequent enough an id by frequency rank
   (rank times partitions plus partition, so ids are unique, and small ones are frequent
   words). It answers each block with the ids of its words.
3. ``count_pairs``: a pair of ids lies in the tile (id >> EDGE_BITS, id >> EDGE_BITS). Tiles
   that hold many of the pairs are counted by address with one dense ``bincount``, all others
   as sorted coordinates. A block counts its pairs so, and the index sums the counts of blocks
   in the same way; a tile belongs to one index partition, and a block sends a pair once.
4. Frequent pairs become units, ranked anew by frequency; a unit and the word after it are a
   pair of the next level, up to ``max_words``. Only occurrences whose two halves are frequent
   are counted, as no others can be.
5. ``collocations``: exact decimal scores of every cut, phrases covered by a longer one
   dropped, the best of each language kept.

What is sent grows with the distinct words and pairs of blocks, however hot a word or language;
no task holds more than a block or an index partition.

Defined results: null texts have no words; a null language is ``und``; repeated rows count each;
ties go as the contract says (fewer words in the first part, then the phrase in byte order); an
empty table gives an empty result; extra columns are ignored; texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from periodstats.llm.common import materialise
from periodstats.llm.hashing import hash_strings, mix

#: A tile is 64 by 64 ids; the tiles of the most frequent ids are looked at for dense counting.
EDGE_BITS = 6
HEAD_TILES = 512


@dataclass(frozen=True)
class Settings:
    max_words: int = 3
    min_count: int = 10
    covered_percent: int = 50        # a phrase goes if a longer one has so much of its count
    top: int = 2000
    block_chars: int = 6_000_000


# -- counting ------------------------------------------------------------------------------

def count_pairs(a: np.ndarray, b: np.ndarray, times: np.ndarray | None = None,
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs and their counts (the sums of ``times``), in no particular order."""
    edge, cells = 1 << EDGE_BITS, 1 << 2 * EDGE_BITS
    weight = np.ones(len(a), np.int64) if times is None else times
    row, column = a >> EDGE_BITS, b >> EDGE_BITS
    head = (row < HEAD_TILES) & (column < HEAD_TILES)
    tile = row[head] * HEAD_TILES + column[head]
    used = np.bincount(tile, minlength=HEAD_TILES * HEAD_TILES)
    dense = used >= cells // 4  # a tile is worth its cells
    number = np.cumsum(dense) - 1
    at = np.flatnonzero(head)[dense[tile]]
    place = (number[row[at] * HEAD_TILES + column[at]] * cells
             + (a[at] % edge) * edge + b[at] % edge)
    counts = np.bincount(place, minlength=int(dense.sum()) * cells)
    if times is not None:
        counts = np.zeros(len(counts), np.int64)
        np.add.at(counts, place, weight[at])
    found = np.flatnonzero(counts)
    tiles = np.flatnonzero(dense)[found // cells]
    dense_a = tiles // HEAD_TILES * edge + found % cells // edge
    dense_b = tiles % HEAD_TILES * edge + found % edge
    rest = np.ones(len(a), dtype=bool)
    rest[at] = False
    key = (a[rest] << 32) | b[rest]
    if times is None:
        key, total = np.unique(key, return_counts=True)
    else:
        order = np.argsort(key, kind="stable")
        key, w = key[order], weight[rest][order]
        heads = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))[:len(key)])
        key, total = key[heads], np.add.reduceat(w, heads) if len(heads) else w
    return (np.concatenate((dense_a, key >> 32)), np.concatenate((dense_b, key & 0xFFFFFFFF)),
            np.concatenate((counts[found], total)))


def _ranked(counts: np.ndarray, tie: np.ndarray, p: int, parts: int) -> np.ndarray:
    """Ids of the partition's own: rank by count, and by ``tie`` among equals."""
    ids = np.empty(len(counts), np.int64)
    ids[np.lexsort((tie, -counts))] = np.arange(len(counts)) * parts + p
    if len(ids) and ids.max() >= 1 << 31:
        raise ValueError("more than 2^31 ids a language")
    return ids


def _zip(values: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(values).tobytes(), codec="zstd", asbytes=True)


def _unzip(data: bytes, n: int, kind: type) -> np.ndarray:
    size = n * np.dtype(kind).itemsize
    return np.frombuffer(pa.decompress(data, decompressed_size=size, codec="zstd"), kind)


# -- blocks of texts -----------------------------------------------------------------------

def encoded(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Numbers of the words of all texts in order, -1 between pieces, and the distinct words."""
    low = pc.ascii_lower(texts.cast(pa.large_string()).fill_null(""))
    ended = pc.binary_join_element_wise(low, pa.scalar(".", pa.large_string()),
                                        pa.scalar("", pa.large_string()))
    marked = pc.replace_substring_regex(ended, pattern=r"[.,;:!?\x0A-\x0D]", replacement=" . ")
    coded = pc.list_flatten(pc.ascii_split_whitespace(marked)).dictionary_encode()
    at, words = coded.indices.to_numpy(), coded.dictionary
    # the mark, and the empty string that white space at a text's border gives, end a piece
    is_word = pc.invert(pc.is_in(words, pa.array(["", "."], pa.large_string()))).to_numpy(
        zero_copy_only=False).astype(bool)
    number = np.where(is_word, np.cumsum(is_word) - 1, -1).astype(np.int32)
    return number[at], words.filter(pa.array(is_word))


def _read(settings: Settings, parts: int):
    def block(number: int, rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(rows)
        for lang in pc.unique(table["lang"]).to_pylist():
            texts = table.filter(pc.equal(table["lang"], lang))["text"].combine_chunks()
            at, words = encoded(texts)
            h = hash_strings(words)
            part = (h % np.uint64(parts)).astype(np.int64)
            order = np.lexsort((h, part))
            place = np.empty(len(order) + 1, np.int32)
            place[order], place[-1] = np.arange(len(order)), -1
            times = np.bincount(at[at >= 0], minlength=len(words))[order]
            words, part = words.take(pa.array(order)), part[order]
            cut = np.searchsorted(part, np.arange(parts + 1))
            asked = np.flatnonzero(np.diff(cut)).tolist()
            runs = [(int(cut[p]), int(cut[p + 1])) for p in asked]
            strings = ["\n".join(words.slice(lo, hi - lo).to_pylist()).encode() for lo, hi in runs]
            yield _batch(block=[number] * (len(runs) + 1), lang=[lang] * (len(runs) + 1),
                         p=[None, *asked], n=[len(at), *[hi - lo for lo, hi in runs]],
                         data=[_zip(place[at]), *strings],
                         counts=[None, *[times[lo:hi].astype(np.int64).tobytes() for lo, hi in runs]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, held, chars = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy()
            ends = np.cumsum(sizes)
            lo = 0
            while lo < len(batch):
                room = settings.block_chars - chars
                base = ends[lo - 1] if lo else 0
                hi = min(len(batch), int(np.searchsorted(ends, base + room)) + 1)
                held.append(batch.slice(lo, hi - lo))
                chars += int(ends[hi - 1] - base)
                lo = hi
                if chars >= settings.block_chars:
                    yield from block(number, held)
                    number, held, chars = number + 1, [], 0
                    pa.default_memory_pool().release_unused()
        if held:
            yield from block(number, held)
    return run


_BLOCK_ROW = "block long, lang string, p int, n long, data binary, counts binary"
_TYPES = {"kind": pa.string(), "block": pa.int64(), "lang": pa.string(), "p": pa.int32(),
          "n": pa.int64(), "data": pa.binary(), "counts": pa.binary(), "a": pa.int64(),
          "b": pa.int64(), "id": pa.int64(), "word": pa.string()}


def _batch(**columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, _TYPES[k]) for k, v in columns.items()],
                                      names=list(columns))


def _rows(names: list[str], rows: list[dict]) -> pa.Table:
    return pa.table({k: pa.array([r.get(k) for r in rows], _TYPES[k]) for k in names})


def _by_lang(rows: pa.Table) -> Iterator[tuple[str, list[dict]]]:
    found: dict[str, list[dict]] = {}
    for r in rows.to_pylist():
        found.setdefault(r["lang"], []).append(r)
    yield from sorted(found.items())


# -- the index -----------------------------------------------------------------------------

_WORD_ROW = ["kind", "block", "lang", "p", "n", "data", "id", "word"]
_WORDS = "kind string, block long, lang string, p int, n long, data binary, id long, word string"


def _index_words(settings: Settings, parts: int):
    """Frequent words with ids, the count of all words, and answers to blocks."""
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        p, out = key[0].as_py(), []
        for lang, asked in _by_lang(rows):
            words = pa.array([w for r in asked for w in r["data"].decode().split("\n")],
                             pa.large_string()).dictionary_encode()
            at = words.indices.to_numpy()
            total = np.zeros(len(words.dictionary), np.int64)
            np.add.at(total, at, np.concatenate([np.frombuffer(r["counts"], np.int64) for r in asked]))
            often = np.flatnonzero(total >= settings.min_count)
            names = words.dictionary.take(pa.array(often)).to_pylist()
            tie = np.empty(len(often), np.int64)
            tie[sorted(range(len(names)), key=names.__getitem__)] = np.arange(len(names))
            ids = np.full(len(total), -1, np.int64)
            ids[often] = _ranked(total[often], tie, p, parts)
            out.append({"kind": "total", "lang": lang, "n": int(total.sum())})
            out += [{"kind": "word", "lang": lang, "n": n, "id": i, "word": w} for n, i, w in
                    zip(total[often].tolist(), ids[often].tolist(), names, strict=True)]
            lo = 0
            for r in asked:
                mine = ids[at[lo:lo + r["n"]]].astype(np.int32)
                lo += r["n"]
                out.append({"kind": "answer", "block": r["block"], "lang": lang, "p": p,
                            "n": len(mine), "data": _zip(mine)})
        return _rows(_WORD_ROW, out)
    return run


_UNIT_ROW = ["kind", "block", "lang", "n", "data", "a", "b", "id"]
_UNITS = "kind string, block long, lang string, n long, data binary, a long, b long, id long"


def _index_pairs(settings: Settings, parts: int, answer: bool):
    """Frequent pairs as units with ids; answers name the units that a block asked for."""
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        p, out = key[0].as_py(), []
        for lang, asked in _by_lang(rows):
            packed = [_unzip(r["data"], 3 * r["n"], np.int64).reshape(3, -1) for r in asked]
            a, b, n = count_pairs(*np.concatenate(packed, axis=1))
            often = n >= settings.min_count
            a, b, n = a[often], b[often], n[often]
            units = (a << 32) | b
            order = np.argsort(units)
            a, b, n, units = a[order], b[order], n[order], units[order]
            ids = _ranked(n, units, p, parts)
            out += [{"kind": "unit", "lang": lang, "a": x, "b": y, "n": f, "id": i} for x, y, f, i in
                    zip(a.tolist(), b.tolist(), n.tolist(), ids.tolist(), strict=True)]
            if not answer or not len(units):
                continue
            for r, (x, y, _) in zip(asked, packed, strict=True):
                wanted = (x << 32) | y
                at = np.minimum(np.searchsorted(units, wanted), len(units) - 1)
                known = units[at] == wanted
                if known.any():
                    out.append({"kind": "answer", "block": r["block"], "lang": lang,
                                "n": int(known.sum()),
                                "data": _zip(np.stack((wanted[known], ids[at[known]])))})
        return _rows(_UNIT_ROW, out)
    return run


# -- occurrences in blocks -----------------------------------------------------------------

def _ask_pairs(level: int, parts: int):
    """Counts of a block's pairs that make ``level`` words, from its texts and the answers."""
    def sequence(texts: dict, answers: list[dict]) -> tuple[np.ndarray, np.ndarray]:
        words = [r for r in answers if r["level"] == 1]
        words.sort(key=lambda r: r["p"])
        ids = np.concatenate([_unzip(r["data"], r["n"], np.int32) for r in words] + [[-1]])
        word = ids[_unzip(texts["data"], texts["n"], np.int32)].astype(np.int64)
        unit = word
        for size in range(2, level):
            known = [_unzip(r["data"], 2 * r["n"], np.int64).reshape(2, -1)
                     for r in answers if r["level"] == size]
            keys, to = np.concatenate([*known, np.empty((2, 0), np.int64)], axis=1)
            order = np.argsort(keys)
            keys, to = keys[order], to[order]
            at, key = _adjacent(unit, word, size)
            longer = np.full(len(word), -1, np.int64)
            if len(keys):
                found = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                known_at = keys[found] == key
                longer[at[known_at]] = to[found[known_at]]
            unit = longer
        return unit, word

    def run(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()  # what the worker's last block left
        out = []
        given = dict(_by_lang(answers))
        for lang, (texts,) in _by_lang(rows):
            if lang not in given:
                continue
            unit, word = sequence(texts, given[lang])
            _, pairs = _adjacent(unit, word, level)
            a, b, n = count_pairs(pairs >> 32, pairs & 0xFFFFFFFF)
            tile = ((a >> EDGE_BITS) << 32) | (b >> EDGE_BITS)
            salt = np.frombuffer(lang.encode().ljust(8, b"\0")[:8], np.uint64)[0]
            part = (mix(tile.astype(np.uint64) ^ salt) % np.uint64(parts)).astype(np.int64)
            order = np.lexsort((b, a, part))
            cut = np.searchsorted(part[order], np.arange(parts + 1))
            for p in np.flatnonzero(np.diff(cut)).tolist():
                at = order[cut[p]:cut[p + 1]]
                out.append({"block": texts["block"], "lang": lang, "p": p, "n": len(at),
                            "data": _zip(np.stack((a[at], b[at], n[at])))})
        return _rows(["block", "lang", "p", "n", "data"], out)
    return run


def _adjacent(unit: np.ndarray, word: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and keys of a unit of ``level`` - 1 words with the word behind it.

    The unit one word on must be known as well: without it the longer phrase is not frequent.
    """
    m = max(0, len(word) - level + 1)
    behind = word[level - 1:level - 1 + m]
    at = np.flatnonzero((unit[:m] >= 0) & (behind >= 0) & (unit[1:m + 1] >= 0)) if m else \
        np.empty(0, np.int64)
    return at, (unit[at] << 32) | behind[at]


# -- phrases -------------------------------------------------------------------------------

def phrases(docs: DataFrame, settings: Settings | None = None) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, k, f) of all frequent phrases of 1 to max_words words; (lang, n)."""
    s = settings or Settings()
    parts = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                        F.col("text").cast("string").alias("text"))
    read = materialise(texts.mapInArrow(_read(s, parts), _BLOCK_ROW), "blocks")
    asked = read.where("p is not null")
    words = materialise(asked.groupBy("p").applyInArrow(_index_words(s, parts), _WORDS), "words")
    totals = words.where("kind = 'total'").groupBy("lang").agg(F.sum("n").alias("n"))
    known = words.where("kind = 'word'").select("lang", "id", F.col("word").alias("phrase"),
                                                F.col("n").alias("f"))
    level = known
    found = known.select("lang", "phrase", F.lit(1).alias("k"), "f")
    answers = words.where("kind = 'answer'").select("block", "lang", "p", "n", "data",
                                                    F.lit(1).alias("level"))
    sequences = read.where("p is null").groupBy("block")
    last = known.select("lang", F.col("id").alias("b"), F.col("phrase").alias("word"))
    for k in range(2, s.max_words + 1):
        pairs = sequences.cogroup(answers.groupBy("block")).applyInArrow(
            _ask_pairs(k, parts), "block long, lang string, p int, n long, data binary")
        units = materialise(pairs.groupBy("p").applyInArrow(
            _index_pairs(s, parts, k < s.max_words), _UNITS), f"units-{k}")
        level = materialise(
            units.where("kind = 'unit'").select("lang", "id", "a", "b", F.col("n").alias("f"))
            .join(level.select("lang", F.col("id").alias("a"), "phrase"), ["lang", "a"])
            .join(last, ["lang", "b"])
            .select("lang", "id", F.concat_ws(" ", "phrase", "word").alias("phrase"), "f"),
            f"phrases-{k}")
        found = found.union(level.select("lang", "phrase", F.lit(k), "f"))
        answers = answers.union(units.where("kind = 'answer'").select(
            "block", "lang", F.lit(None).cast("int"), "n", "data", F.lit(k)))
    return found, totals


def _piece(words: Column, first: Column, size: Column) -> Column:
    return F.concat_ws(" ", F.slice(words, first + 1, size))


def collocations(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score."""
    s = settings or Settings()
    found, totals = phrases(docs, s)
    found = materialise(found, "phrases")
    longer = found.where("k > 1").withColumn("w", F.split("phrase", " "))
    part = found.select("lang", F.col("phrase").alias("part"), F.col("f").alias("part_f"))

    def with_part(df: DataFrame, piece: Column, name: str) -> DataFrame:
        return (df.withColumn("part", piece).join(part, ["lang", "part"])
                .withColumnRenamed("part_f", name).drop("part"))

    cuts = longer.select("*", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = with_part(cuts, _piece(F.col("w"), F.lit(0), F.col("cut")), "l")
    cuts = with_part(cuts, _piece(F.col("w"), F.col("cut"), F.col("k") - F.col("cut")), "r")
    # Counts below 10^12: the products have at most 32 and 25 digits, and the quotient fits a long.
    score = F.expr("cast(f as decimal(12, 0)) * cast(f * 1000000 as decimal(19, 0)) div "
                   "(cast(l as decimal(12, 0)) * cast(r as decimal(12, 0)))")
    scored = cuts.withColumn("score", score).groupBy("lang", "phrase", "k").agg(
        F.first("f").alias("a"), F.min(F.struct("score", "cut", "l", "r")).alias("least"))
    inside = F.expr("flatten(transform(sequence(2, k - 1), m -> transform(sequence(0, k - m), "
                    "i -> concat_ws(' ', slice(w, i + 1, m)))))")
    covers = (longer.where("k > 2").select("lang", F.explode(inside).alias("phrase"), "f")
              .groupBy("lang", "phrase").agg(F.max("f").alias("cover")))
    left = scored.join(covers, ["lang", "phrase"], "left").where(
        F.col("cover").isNull() | (100 * F.col("cover") < s.covered_percent * F.col("a")))
    best = left.select("lang", "phrase", "a", "least.l", "least.r", "least.score")
    # A histogram of scores (eighths of powers of two, some 170 classes a language) says which
    # classes hold the first ``top`` phrases; only their rows meet in a language's window.
    best = best.withColumn("class", F.floor(8 * F.log2(F.col("score") + 1)).cast("int"))
    better = Window.partitionBy("lang").orderBy(F.desc("class")).rowsBetween(
        Window.unboundedPreceding, -1)
    classes = best.groupBy("lang", "class").agg(F.count(F.lit(1)).alias("held")).select(
        "lang", "class", F.coalesce(F.sum("held").over(better), F.lit(0)).alias("ahead"))
    near_top = best.join(classes.where(F.col("ahead") < s.top), ["lang", "class"])
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    top = near_top.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= s.top)
    return top.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def oracle_sql(settings: Settings | None = None) -> str:
    """The same in DuckDB from all contiguous word runs."""
    s = settings or Settings()
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM (
    SELECT lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{upper}', '{lower}'),
                                              '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
runs AS (SELECT lang, w, k, unnest(range(0, len(w) - k + 1)) AS i
         FROM (SELECT lang, w, unnest(range(1, {s.max_words + 1})) AS k FROM pieces)),
f AS (SELECT lang, k, array_to_string(w[i + 1:i + k], ' ') AS phrase, count(*) AS f
      FROM runs GROUP BY 1, 2, 3),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY 1),
cand AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f
         WHERE k > 1 AND f >= {s.min_count}),
cuts AS (SELECT *, unnest(range(1, k)) AS cut FROM cand),
scored AS (
  SELECT c.lang, c.k, c.phrase, c.a, cut, l.f AS l, r.f AS r,
         (1000000::HUGEINT * a * a // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[:cut], ' ')
              JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[cut + 1:], ' ')),
least AS (SELECT * FROM scored
          QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
parts AS (
  SELECT lang, a, array_to_string(w[i + 1:i + m], ' ') AS phrase FROM (
    SELECT lang, a, w, m, unnest(range(0, k - m + 1)) AS i FROM (
      SELECT *, unnest(range(2, k)) AS m FROM cand))),
covers AS (SELECT lang, phrase, max(a) AS cover FROM parts GROUP BY 1, 2),
kept AS (SELECT lang, phrase, a, l, r, score FROM least LEFT JOIN covers USING (lang, phrase)
         WHERE cover IS NULL OR 100 * cover < {s.covered_percent} * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)
           AS rank FROM kept)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score
FROM ranked JOIN totals USING (lang) WHERE rank <= {s.top}"""
