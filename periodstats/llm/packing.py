"""Packing into optimal length buckets.

1. ``sequences``: token counts; a document longer than the largest length is cut into pieces,
   so nothing is truncated or dropped.
2. ``length_histogram``: one count per length, summed before the shuffle; at most ``max_len``
   rows reach the driver.
3. ``best_boundaries``: dynamic programming over that global histogram picks at most
   ``buckets`` padded lengths (multiples of ``step``) with the least total padding.
4. ``batches``: inside each bucket, sequences are dealt to shards by a hash of their identity;
   sequences whose identity is not theirs alone (a repeated id, or none) by their row as well,
   so that one id's rows do not fill one shard.
   The number of shards follows from the histogram, so a shard holds about
   ``batches_per_shard`` full batches however many rows a bucket has; a window numbers the
   rows of each shard and ``token_budget`` cuts them into batches.

Defined results: a null or empty text is one sequence of length 1 (its end token); repeated
rows are packed one by one; ties in the dynamic program go to fewer buckets, then to the
smaller boundary; an empty table gives no batches; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from periodstats.llm.common import WORD, materialise, text_of


@dataclass(frozen=True)
class Settings:
    max_len: int = 2048
    step: int = 16
    buckets: int = 8
    token_budget: int = 32_768
    batches_per_shard: int = 8

    def __post_init__(self) -> None:
        if self.max_len % self.step or self.token_budget < self.max_len:
            raise ValueError("max_len must be a multiple of step and within token_budget")


def word_tokens() -> Column:
    """Words and one end token; the default length of a text."""
    return (F.regexp_count(text_of(), F.lit(f"({WORD})")) + 1).cast("long")


def sequences(docs: DataFrame, settings: Settings, length: Column | None = None) -> DataFrame:
    """doc_id, piece, first_token, n_tokens: every token of every document once."""
    n, top = F.col("__n"), settings.max_len
    pieces = F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / top))
    return (docs.select("doc_id", F.greatest(F.lit(1), length if length is not None
                                             else word_tokens()).cast("long").alias("__n"))
            .select("doc_id", "__n", F.explode(pieces).alias("piece"))
            .select("doc_id", "piece", (F.col("piece") * top).alias("first_token"),
                    F.least(F.lit(top), n - F.col("piece") * top).cast("long").alias("n_tokens")))


def length_histogram(seqs: DataFrame) -> dict[int, int]:
    return {r["n_tokens"]: r["count"] for r in seqs.groupBy("n_tokens").count().collect()}


def best_boundaries(histogram: dict[int, int], settings: Settings) -> list[int]:
    """Padded lengths, increasing; the last holds the longest sequence."""
    if not histogram:
        return []
    step = settings.step
    last = -(-max(histogram) // step)
    count, tokens = np.zeros(last + 1, np.int64), np.zeros(last + 1, np.int64)
    for n, times in histogram.items():
        count[-(-n // step)] += times
        tokens[-(-n // step)] += n * times
    count, tokens = np.cumsum(count), np.cumsum(tokens)
    length = np.arange(last + 1, dtype=np.int64) * step
    cost = length * count - tokens  # one bucket up to j
    levels, back = [cost], []
    for _ in range(1, min(settings.buckets, last)):
        before, cost = cost, np.full(last + 1, np.iinfo(np.int64).max // 4)
        chosen = np.zeros(last + 1, np.int64)
        for j in range(2, last + 1):
            each = before[1:j] + length[j] * (count[j] - count[1:j]) - (tokens[j] - tokens[1:j])
            chosen[j] = np.argmin(each) + 1  # the first of equals
            cost[j] = each[chosen[j] - 1]
        levels.append(cost)
        back.append(chosen)
    k = int(np.argmin([c[last] for c in levels]))
    out, j = [], last
    while True:
        out.append(int(length[j]))
        if not k:
            return out[::-1]
        k -= 1
        j = int(back[k][j])


def batches(seqs: DataFrame, histogram: dict[int, int], settings: Settings) -> DataFrame:
    """One row a sequence: its bucket, padding, and batch (bucket, shard, batch) with its slot."""
    ends = best_boundaries(histogram, settings)
    if not ends:
        ends = [settings.max_len]
    starts = [0, *ends[:-1]]
    rows = [sum(c for n, c in histogram.items() if lo < n <= hi)
            for lo, hi in zip(starts, ends, strict=True)]
    room = [settings.token_budget // e for e in ends]
    shards = [max(1, -(-n // (r * settings.batches_per_shard)))
              for n, r in zip(rows, room, strict=True)]

    def of(values: list[int]) -> Column:  # a value a bucket; the list is as long as `buckets`
        return F.element_at(F.array(*[F.lit(v) for v in values]), F.col("bucket").cast("int") + 1)

    bucket = sum((F.when(F.col("n_tokens") > e, 1).otherwise(0) for e in ends[:-1]), F.lit(0))
    seqs = seqs.withColumn("__row", F.monotonically_increasing_id())
    shared = (seqs.filter("doc_id is not null").groupBy("doc_id", "piece").count().filter("count > 1")
              .select(F.col("doc_id").alias("__id"), F.col("piece").alias("__piece")))
    seqs = seqs.join(shared, (F.col("doc_id") == F.col("__id")) & (F.col("piece") == F.col("__piece")),
                     "left")
    several = F.col("__id").isNotNull() | F.col("doc_id").isNull()
    name = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("piece"),
                       F.when(several, F.col("__row")))
    dealt = F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("long")
    placed = seqs.withColumn("bucket", bucket.cast("long")).withColumns({
        "bucket_len": of(ends).cast("long"), "__room": of(room).cast("long"),
        "shard": F.pmod(dealt, of(shards).cast("long"))})
    order = Window.partitionBy("bucket", "shard").orderBy("n_tokens", "doc_id", "piece", "__row")
    at = F.row_number().over(order).cast("long") - 1
    return (placed.withColumn("__at", at)
            .withColumns({"padding": F.col("bucket_len") - F.col("n_tokens"),
                          "batch": F.floor(F.col("__at") / F.col("__room")),
                          "slot": F.col("__at") % F.col("__room")})
            .select("doc_id", "piece", "first_token", "n_tokens", "bucket", "bucket_len",
                    "padding", "shard", "batch", "slot"))


def pack(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    settings = settings or Settings()
    seqs = materialise(sequences(docs.select("doc_id", "text"), settings), "sequences")
    return batches(seqs, length_histogram(seqs), settings)


def oracle_sql(settings: Settings | None = None) -> str:
    """The same in DuckDB: the dynamic program as a recursive query over lists."""
    s = settings or Settings()
    cost = "({c}*{j} * (cn[{j}+1] - cn[{i}+1]) - (tk[{j}+1] - tk[{i}+1]))"
    first = cost.format(c=s.step, j="j", i="0")
    more = cost.format(c=s.step, j="j", i="i")
    return f"""
WITH RECURSIVE lens AS (
  SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) + 1 AS n
  FROM documents),
seqs AS (
  SELECT doc_id, piece, piece * {s.max_len} AS first_token,
         least({s.max_len}, n - piece * {s.max_len}) AS n_tokens
  FROM (SELECT doc_id, n, unnest(range(0, (n - 1) // {s.max_len} + 1)) AS piece FROM lens)),
steps AS (SELECT (n_tokens + {s.step - 1}) // {s.step} AS j, count(*) AS c, sum(n_tokens) AS t
          FROM seqs GROUP BY 1),
top AS (SELECT max(j)::BIGINT AS last FROM steps),
cum AS (SELECT list(c ORDER BY j) AS cn, list(t ORDER BY j) AS tk FROM (
  SELECT g.j, sum(coalesce(c, 0)) OVER (ORDER BY g.j)::BIGINT AS c,
         sum(coalesce(t, 0)) OVER (ORDER BY g.j)::BIGINT AS t
  FROM (SELECT unnest(range(0, last + 1)) AS j FROM top) g LEFT JOIN steps USING (j))),
dp AS (
  SELECT 1 AS k, cn, tk, last,
         list_transform(range(1, last + 1), lambda j: {{'cost': {first}, 'path': [j]}}) AS best
  FROM cum, top
  UNION ALL
  SELECT k + 1, cn, tk, last, list_transform(range(1, last + 1), lambda j:
    CASE WHEN j <= k THEN {{'cost': 4611686018427387903, 'path': [j]}} ELSE
    struct_extract(list_min(list_transform(range(k, j), lambda i:
      {{'cost': best[i].cost + {more}, 'i': i,
        'b': {{'cost': best[i].cost + {more}, 'path': list_append(best[i].path, j)}}}})), 'b') END)
  FROM dp WHERE k < least({s.buckets}, last)),
ends AS (SELECT path FROM (SELECT best[last].cost AS cost, k, best[last].path AS path FROM dp)
         ORDER BY cost, k LIMIT 1),
buckets AS (SELECT unnest(range(0, len(path))) AS bucket, unnest(path) * {s.step} AS hi,
            unnest(list_prepend(0, path[:-2])) * {s.step} AS lo FROM ends),
sized AS (SELECT bucket, hi, lo, {s.token_budget} // hi AS room,
          greatest(1, (count(n_tokens) + ({s.token_budget} // hi) * {s.batches_per_shard} - 1)
                      // (({s.token_budget} // hi) * {s.batches_per_shard})) AS shards
          FROM buckets LEFT JOIN seqs ON n_tokens > lo AND n_tokens <= hi GROUP BY 1, 2, 3),
dealt AS (
  SELECT doc_id, piece, first_token, n_tokens, bucket, hi AS bucket_len, room,
         ('0x' || md5(coalesce(doc_id::VARCHAR, '') || ':' || piece)[1:8])::BIGINT % shards AS shard
  FROM seqs JOIN sized ON n_tokens > lo AND n_tokens <= hi),
placed AS (SELECT *, row_number() OVER (PARTITION BY bucket, shard
                                        ORDER BY n_tokens, doc_id NULLS FIRST, piece) - 1 AS rn
           FROM dealt)
SELECT doc_id, piece, first_token, n_tokens, bucket, bucket_len, bucket_len - n_tokens AS padding,
       shard, rn // room AS batch, rn % room AS slot
FROM placed"""
