"""Approximate nearest neighbours by an adaptive dimension scan inside probed lists.

Index: centroids are fitted on a bounded sample (``sample_rows`` rows with the least id hash);
every vector is normalised, rotated by one random orthogonal matrix and put into the list of
its nearest centroid. Search: a query probes its ``probes`` nearest lists, and more until
these hold enough candidates; one that still finds fewer than there are (a vec_id in many
lists counts in each) probes all lists. Within a probed list, squared distances are summed over blocks
of rotated dimensions; after each block a hypothesis test compares the distance extrapolated
from the dimensions seen with the k-th best so far, and candidates that are beyond it with
high confidence are abandoned. What remains is scored exactly, as the cosine of the original
vectors in double precision.

A list is dealt to shards of at most ``shard_rows`` candidates and its queries to blocks of at
most ``query_rows``, sized from the list counts, so a list that holds a third of all vectors
is many tasks.

Defined results: vectors that are null, empty, zero, hold null or non-finite components, or
differ in length from the most common one (ties: the shorter) take no part, nor do rows with a
null vec_id; a vec_id that occurs several times is one candidate with its best score, and all
rows with a query's own vec_id are its own; equal rows are one; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from periodstats.llm.common import materialise
from periodstats.llm.ngram_join import group_numbers, whole_groups


@dataclass(frozen=True)
class Settings:
    k: int = 5
    sample_rows: int = 20_000     # bound of the fitting sample
    most_lists: int = 4_096
    rows_per_list: int = 400      # lists wanted: rows / rows_per_list, within most_lists
    probes: float = 0.6           # share of the lists, at every size; at least least_probes
    least_probes: int = 24
    block: int = 16               # dimensions summed between two tests
    epsilon: float = 3.0          # confidence of the test
    shard_rows: int = 8_192
    query_rows: int = 2_048
    rounds: int = 12              # of k-means
    seed: int = 17


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) with finite, non-zero vectors of the most common length."""
    fine = vectors.filter("vec_id is not null and embedding is not null").select(
        F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("v"))
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    fine = fine.filter(F.forall("v", good) & F.exists("v", lambda x: x != 0))
    common = fine.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return fine.filter(F.size("v") == (common["d"] if common else -1))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def fit_centroids(sample: np.ndarray, lists: int, settings: Settings) -> np.ndarray:
    """Spherical k-means on the sample."""
    rng = np.random.default_rng(settings.seed)
    x = _unit(sample)
    centroids = x[rng.permutation(len(x))[:lists]]
    for _ in range(settings.rounds):
        near = np.argmax(x @ centroids.T, axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, x)
        size = np.sqrt((sums * sums).sum(axis=1))
        full = size > 1e-12
        centroids[full] = sums[full] / size[full, None]
    return centroids


def rotation(d: int, seed: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


_INDEXED = "vec_id bigint, list int, v binary, r binary"


def _index(centroids: np.ndarray, turn: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("v"))
            u = _unit(x)
            lists = np.argmax(u @ centroids.T, axis=1).astype(np.int32)
            turned = (u @ turn).astype(np.float32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(lists),
                 pa.array([r.tobytes() for r in x], pa.binary()),
                 pa.array([r.tobytes() for r in turned], pa.binary())],
                names=["vec_id", "list", "v", "r"])
    return run


def _probe(centroids: np.ndarray, sizes: np.ndarray, settings: Settings):
    """Rows (vec_id, list): the lists that each query looks into."""
    some = int(min(max(settings.least_probes, np.ceil(settings.probes * len(centroids))),
                   len(centroids)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.frombuffer(b"".join(batch.column("v").to_pylist())).reshape(batch.num_rows, -1)
            order = np.argsort(-(_unit(x) @ centroids.T), axis=1, kind="stable")
            held = np.cumsum(sizes[order], axis=1)
            # Enough lists for k candidates beside the query's own rows.
            needed = 1 + (held < 4 * settings.k + 1).sum(axis=1)
            n = np.minimum(np.maximum(some, needed), len(centroids))
            at = np.repeat(np.arange(len(x)), n)
            rank = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
            ids = np.asarray(batch.column("vec_id"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[at]), pa.array(order[at, rank].astype(np.int32)),
                 batch.column("v").take(pa.array(at)), batch.column("r").take(pa.array(at))],
                names=["vec_id", "list", "v", "r"])
    return run


def nearest_in_shard(q: np.ndarray, q_turned: np.ndarray, own: int, ids: np.ndarray,
                     x: np.ndarray, norms: np.ndarray, turned: np.ndarray,
                     settings: Settings) -> list[tuple[int, float]]:
    """(vec_id, cosine) of the k best candidates of a shard, each with its best row; an id may
    have several rows."""
    k, d = settings.k, x.shape[1]
    q_norm = np.sqrt((q * q).sum())
    best: list[tuple[float, int]] = []  # (-score, id), one an id
    limit = np.inf                      # squared distance of the k-th best id so far
    chunk = 256
    at = 0
    while at < len(ids):
        alive = np.arange(at, min(len(ids), at + chunk))
        alive = alive[ids[alive] != own]
        seen = np.zeros(len(alive))
        for lo in range(0, d, settings.block):
            hi = min(d, lo + settings.block)
            gap = turned[alive, lo:hi] - q_turned[lo:hi]
            seen += np.einsum("ij,ij->i", gap, gap, dtype=np.float64)
            if np.isfinite(limit) and hi < d:
                # H0: the distance is within the limit; rejected if the part seen, scaled up,
                # is beyond it by more than the test's margin.
                margin = (1 + settings.epsilon / np.sqrt(hi)) ** 2
                stay = seen * (d / hi) <= limit * margin + 1e-6
                alive, seen = alive[stay], seen[stay]
            if not len(alive):
                break
        if len(alive):
            score = (x[alive] * q).sum(axis=1) / (norms[alive] * q_norm)
            best += zip((-score).tolist(), ids[alive].tolist(), strict=True)
            first: dict[int, float] = {}
            for s, i in sorted(best):
                first.setdefault(i, s)
                if len(first) == k:
                    break
            best = [(s, i) for i, s in first.items()]
            if len(best) == k:
                limit = max(0.0, 2 + 2 * best[-1][0])
        at += chunk
        chunk = min(4 * chunk, 8192)
    return [(i, -s) for s, i in best]


_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _search(settings: Settings):
    keys = ["list", "shard", "qblock"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for many in whole_groups(batches, keys):
            group = group_numbers(many, keys)
            starts = np.flatnonzero(np.diff(group, prepend=-1))
            out: list[tuple[int, int, float]] = []
            for lo, hi in zip(starts, [*starts[1:], len(group)], strict=True):
                table = many.slice(lo, hi - lo)
                asks = np.asarray(table.column("asks"))
                if asks.all() or not asks.any():
                    continue
                ids = np.asarray(table.column("vec_id"))
                x = np.frombuffer(b"".join(table.column("v").to_pylist())).reshape(len(ids), -1)
                # A power of two a row brings components near 1: exact, and cosines do not change.
                x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])
                r = np.frombuffer(b"".join(table.column("r").to_pylist()),
                                  dtype=np.float32).reshape(len(ids), -1)
                norms = np.sqrt((x * x).sum(axis=1))
                mine = np.flatnonzero(~asks)
                mine = mine[np.argsort(ids[mine], kind="stable")]
                for j in np.flatnonzero(asks):
                    out += [(ids[j], i, s) for i, s in nearest_in_shard(
                        x[j], r[j], ids[j], ids[mine], x[mine], norms[mine], r[mine], settings)]
            if out:
                a, b, c = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.float64())],
                    schema=_FOUND)
    return run


def _nearest(index: DataFrame, queries: DataFrame, centroids: np.ndarray, sizes: np.ndarray,
             ids: np.ndarray, settings: Settings) -> DataFrame:
    """query_id, rank, vec_id, score; ``sizes`` and ``ids`` are the lists' rows and vec_ids."""
    asked = materialise(queries.mapInArrow(_probe(centroids, ids, settings), _INDEXED), "asked")
    wanted = np.zeros(len(sizes), dtype=np.int64)
    for r in asked.groupBy("list").count().collect():
        wanted[r["list"]] = r["count"]
    per = lambda counts, most: F.element_at(F.array(*[
        F.lit(int(max(1, -(-c // most)))) for c in counts]), F.col("list") + 1)
    shards, blocks = per(sizes, settings.shard_rows), per(wanted, settings.query_rows)
    # Salted by the vector too, so that one id's many rows do not share a shard.
    salt = F.xxhash64("vec_id", "v")
    held = index.filter(F.col("list").isin([int(i) for i in np.flatnonzero(wanted)])).select(
        "list", "vec_id", "v", "r", F.lit(False).alias("asks"),
        F.pmod(salt, shards).cast("int").alias("shard"),
        F.explode(F.sequence(F.lit(0), blocks - 1)).alias("qblock"))
    ask = asked.select(
        "list", "vec_id", "v", "r", F.lit(True).alias("asks"),
        F.explode(F.sequence(F.lit(0), shards - 1)).alias("shard"),
        F.pmod(salt, blocks).cast("int").alias("qblock"))
    columns = ["list", "shard", "qblock", "asks", "vec_id", "v", "r"]
    dealt = (held.select(*columns).unionByName(ask.select(*columns))
             .repartition("list", "shard", "qblock")
             .sortWithinPartitions("list", "shard", "qblock"))
    found = dealt.mapInArrow(_search(settings), "query_id bigint, vec_id bigint, score double")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order))
            .filter(F.col("rank") <= settings.k).select("query_id", "rank", "vec_id", "score"))


def search(vectors: DataFrame, is_query: str, settings: Settings | None = None) -> DataFrame:
    """query_id, rank, vec_id, score for the rows that fulfil ``is_query`` (SQL on vec_id)."""
    settings = settings or Settings()
    spark = vectors.sparkSession
    base = materialise(usable(vectors).distinct(), "vectors")
    rows = base.count()
    if not rows:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    sample = np.array([r["v"] for r in base.orderBy(F.xxhash64("vec_id"), "vec_id", "v")
                       .limit(settings.sample_rows).select("v").collect()])
    lists = int(min(settings.most_lists, len(sample), max(1, rows // settings.rows_per_list)))
    centroids = fit_centroids(sample, lists, settings)
    turn = rotation(sample.shape[1], settings.seed)
    index = materialise(base.mapInArrow(_index(centroids, turn), _INDEXED), "index")
    sizes, ids = np.zeros((2, lists), dtype=np.int64)
    per_list = index.groupBy("list").agg(F.count("*").alias("rows"),
                                         F.countDistinct("vec_id").alias("ids"))
    for r in per_list.collect():  # at most most_lists rows
        sizes[r["list"]], ids[r["list"]] = r["rows"], r["ids"]
    queries = index.filter(is_query).select("vec_id", "v", "r")
    found = materialise(_nearest(index, queries, centroids, sizes, ids, settings), "nearest")
    most = min(settings.k, base.select("vec_id").distinct().count() - 1)
    full = found.filter(F.col("rank") == most).select("query_id")
    short = queries.join(full, F.col("vec_id") == F.col("query_id"), "left_anti")
    if most < 1 or short.isEmpty():
        return found
    # One id's rows fill all the lists probed: look into every list.
    every = replace(settings, probes=1.0)
    return found.join(full, "query_id", "left_semi").unionByName(
        _nearest(index, short, centroids, sizes, ids, every))
