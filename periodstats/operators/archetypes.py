"""Playing-style archetypes: per-position K-Means on standardised per-90 features.

Data path (all distributed):
1. cohort of one season (exposure threshold), reshaped long: one row per (entity, feature of
   the entity's position) - the position -> feature list is a configuration table of at most
   a few dozen rows, broadcast;
2. per (position, feature): non-NULL count (a feature with none is unusable); median imputation
   where NULLs occur (``plans.numbering.exact_medians``: histograms, no sort); mean and
   population deviation of the imputed values from exact decimal sums; a constant feature
   scales to 0. Statistics tables have one row per (position, feature) and are broadcast;
3. status per position: fewer entities than clusters -> ``insufficient_players_for_clustering``;
   fewer than two usable features -> ``insufficient_feature_data``; else clustered;
4. K-Means (``Lloyd``): the scaled features of an entity as one vector, written once. All
   positions and restarts go through the same passes: k passes choose the first centres (each
   restart draws rows with a chance in proportion to their squared distance from the centres it
   has, by a hash of seed, restart and code), then each pass assigns every row to its nearest
   centre and sums rows and vectors per centre. Sums are exact (whole billionths), so neither
   the partitions nor their order can change a centre, and a repeated run or a retried task
   gives the same clusters. A pass moves one row per (position, restart, centre) and task;
5. the restart of least cost is kept; clusters are renumbered canonically (centres sorted in
   descending lexicographic order) and labelled by the feature with the largest standardised
   centre value (first in feature order on ties).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..plans.numbering import exact_medians
from ..session import scratch_path
from ..spec import (MAX_CLUSTERS, MIN_CLUSTERS, NOT_CLUSTERED, TOO_FEW_FEATURES, TOO_FEW_PLAYERS,
                    Spec)
from .scoring import cohort, validate_required_columns

CLUSTERED = "clustered"
MAX_PASSES = 300
UNIT = 1_000_000_000  # vectors and sums of them are whole numbers of this part


def validate_cluster_count(n_clusters: int) -> None:
    allowed = range(MIN_CLUSTERS, MAX_CLUSTERS + 1)
    if n_clusters not in allowed:
        raise ValueError(f"n_clusters={n_clusters}: allowed are {', '.join(map(str, allowed))}")


def _feature_map(spark, spec: Spec) -> DataFrame:
    rows = [(p, f, i) for p, fs in spec.cluster_features.items() for i, f in enumerate(fs)]
    schema = StructType([StructField("position", StringType()), StructField("feature", StringType()),
                         StructField("feature_idx", LongType())])
    return spark.createDataFrame(rows, schema)


def _long(features: DataFrame, season: str, n_clusters: int, spec: Spec
          ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(cohort, one row per entity and feature of its position, status per position)."""
    validate_cluster_count(n_clusters)
    needed = sorted({f for fs in spec.cluster_features.values() for f in fs})
    validate_required_columns(features, ["season", "minutes", "position", *needed], "clustering")
    base = cohort(features, season, spec).where(
        F.col("position").isin(list(spec.cluster_features)))
    kv = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"),
                                      F.col(f).cast("double").alias("raw_value"))
                             for f in needed])).alias("kv")
    long = base.select("code", "season", "position", kv) \
        .select("code", "season", "position", "kv.feature", "kv.raw_value")
    long = long.join(F.broadcast(_feature_map(features.sparkSession, spec)),
                     ["position", "feature"])
    players = base.groupBy("position").agg(F.count(F.lit(1)).cast("bigint").alias("players"))
    usable = long.groupBy("position", "feature").agg(F.count("raw_value").alias("__nn")) \
        .where(F.col("__nn") > 0)
    n_usable = usable.groupBy("position").agg(
        F.count(F.lit(1)).cast("bigint").alias("usable_features"))
    status = players.join(n_usable, "position", "left").fillna(0, ["usable_features"])
    status = status.withColumn(
        "status",
        F.when(F.col("players") < n_clusters, F.lit(TOO_FEW_PLAYERS))
        .when(F.col("usable_features") < 2, F.lit(TOO_FEW_FEATURES))
        .otherwise(F.lit(CLUSTERED)))
    return base, long, status


def cluster_status(features: DataFrame, season: str, n_clusters: int = 4, spec: Spec = Spec()
                   ) -> DataFrame:
    """position, players, usable_features, status: one row per position in the cohort."""
    return _long(features, season, n_clusters, spec)[2]


def cluster_inputs(features: DataFrame, season: str, n_clusters: int = 4, spec: Spec = Spec()
                   ) -> tuple[DataFrame, DataFrame]:
    """(long matrix, status per position).

    long: code, season, position, feature, feature_idx, raw_value, imputed_value, scaled_value
    for usable features of clustered positions."""
    _, long, status = _long(features, season, n_clusters, spec)
    group = ["position", "feature"]
    # one row per (position, feature): which of them miss values, and have any
    gaps = [(r.position, r.feature) for r in long.groupBy(*group).agg(
        F.count("raw_value").alias("known"), F.count(F.lit(1)).alias("n")).collect()
        if 0 < r.known < r.n]
    imputed = long.withColumn("imputed_value", F.col("raw_value"))
    if gaps:
        spark = features.sparkSession
        schema = "position string, feature string"
        some = long.join(F.broadcast(spark.createDataFrame(gaps, schema)), group)
        medians = [(*k, m) for k, m in exact_medians(some, group, "raw_value").items()]
        filled = F.broadcast(spark.createDataFrame(medians, schema + ", __median double"))
        imputed = long.join(filled, group, "left") \
            .withColumn("imputed_value", F.coalesce("raw_value", "__median")).drop("__median")
    # Sums of decimals are exact, so the order of rows does not matter.
    exact = "decimal(38,15)"
    x = F.col("imputed_value")
    means = imputed.where(x.isNotNull()).groupBy(*group).agg(
        (F.sum(x.cast(exact)).cast("double") / F.count(F.lit(1))).alias("__mean"))
    near = imputed.join(F.broadcast(means), group)
    spread = F.sum(F.pow(x - F.col("__mean"), 2).cast(exact)).cast("double") / F.count(F.lit(1))
    stats = near.groupBy(*group, "__mean").agg(
        F.sqrt(spread).alias("__std"), (F.min(x) == F.max(x)).alias("__flat"))
    scaled = imputed.join(F.broadcast(stats), group).withColumn(
        "scaled_value",
        F.when(F.col("__flat") | (F.col("__std") == 0), F.lit(0.0))  # equal, or all but
        .otherwise((F.col("imputed_value") - F.col("__mean")) / F.col("__std")))
    clustered = status.where(F.col("status") == CLUSTERED).select("position")
    scaled = scaled.join(F.broadcast(clustered), "position")
    cols = ["code", "season", "position", "feature", "feature_idx", "raw_value",
            "imputed_value", "scaled_value"]
    return scaled.select(*cols), status


# -- K-Means -------------------------------------------------------------------------------

def vectors(long: DataFrame) -> DataFrame:
    """position, code, v: the scaled features of an entity in feature order, in billionths."""
    per = long.groupBy("position", "code").agg(
        F.sort_array(F.collect_list(F.struct("feature_idx", "scaled_value"))).alias("__kv"))
    return per.select("position", "code", F.transform(
        "__kv", lambda s: F.round(s["scaled_value"] * UNIT).cast("long")).alias("v"))


def _distance(v: Column, centre: Column) -> Column:
    """Squared distance, summed in feature order."""
    parts = F.zip_with(v, centre, lambda a, c: (a / F.lit(float(UNIT)) - c) * (a / F.lit(float(UNIT)) - c))
    return F.aggregate(parts, F.lit(0.0), lambda total, p: total + p)


Centres = dict[tuple[str, int], list[list[float]]]  # (position, restart) -> centres


def _with_centres(rows: DataFrame, centres: Centres) -> DataFrame:
    """rows times restarts, with the restart's centres and the distances from them."""
    table: dict[str, list] = {}
    for (position, restart), c in sorted(centres.items()):
        table.setdefault(position, []).append((restart, c))
    small = rows.sparkSession.createDataFrame(
        list(table.items()),
        "position string, restarts array<struct<restart: int, centres: array<array<double>>>>")
    out = rows.join(F.broadcast(small), "position") \
        .select("position", "code", "v", F.explode("restarts").alias("r")) \
        .select("position", "code", "v", "r.restart", "r.centres")
    return out.withColumn("d", F.transform("centres", lambda c: _distance(F.col("v"), c)))


def first_centres(rows: DataFrame, k: int, restarts: int, seed: int) -> Centres:
    """Centres drawn one by one with a chance in proportion to the squared distance from those
    a restart has: of independent exponential waiting times with these rates the least wins.
    Equal rows have rate 0 once drawn, and come last."""
    positions = [r.position for r in rows.select("position").distinct().collect()]
    centres: Centres = {(p, r): [] for p in positions for r in range(restarts)}
    for j in range(k):
        far = F.coalesce(F.array_min("d"), F.lit(1.0))
        u = (F.pmod(F.xxhash64(F.lit(seed), "restart", F.lit(j), "code"), F.lit(1 << 52)) + 1) \
            / F.lit(float((1 << 52) + 1))
        wait = F.when(far > 0, -F.log(u) / far)
        drawn = _with_centres(rows, centres).groupBy("position", "restart").agg(
            F.min_by("v", F.struct(wait.isNull().alias("none"), wait.alias("wait"), "code")).alias("v"))
        for r in drawn.collect():
            centres[r.position, r.restart].append([x / UNIT for x in r.v])
    return centres


def lloyd(rows: DataFrame, centres: Centres) -> tuple[Centres, dict[tuple[str, int], Decimal], int]:
    """(centres, cost of each restart, passes) when no centre moves any more."""
    active, done, costs, passes = dict(centres), {}, {}, 0
    while active and passes < MAX_PASSES:
        passes += 1
        near = _with_centres(rows, active).withColumn(
            "cluster", F.array_position("d", F.array_min("d")) - 1)
        size = max(len(c[0]) for c in active.values())
        got = near.groupBy("position", "restart", "cluster").agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.array_min("d").cast("decimal(38,12)")).alias("cost"),
            # sums of whole billionths, past 64 bits where there are very many rows
            *[F.sum(F.get("v", F.lit(i)).cast("decimal(28,0)")).alias(f"s{i}") for i in range(size)])
        moved: Centres = {key: [list(c) for c in old] for key, old in active.items()}
        costs |= dict.fromkeys(active, Decimal(0))
        for r in got.collect():  # one row per position, restart and centre
            key = (r.position, r.restart)
            costs[key] += r["cost"]
            width = len(active[key][0])
            moved[key][r.cluster] = [float(r[f"s{i}"] / r["n"] / UNIT) for i in range(width)]
        done |= {key: c for key, c in moved.items() if c == active[key]}
        active = {key: c for key, c in moved.items() if c != active[key]}
    return done | active, costs, passes


def _labels(position: str, names: list[str], centres: list[list[float]]) -> list[tuple]:
    """(position, number of the centre, cluster, cluster_label) with canonical cluster ids."""
    order = sorted(range(len(centres)), key=lambda i: [-v for v in centres[i]])
    return [(position, old, new, f"{position}_{names[centres[old].index(max(centres[old]))]}_profile")
            for new, old in enumerate(order)]


def cluster_playing_styles(features: DataFrame, season: str, n_clusters: int | None = None,
                           spec: Spec = Spec(), restarts: int | None = None) -> DataFrame:
    """Cohort rows with ``cluster`` (-1 when not clustered) and ``cluster_label``."""
    k = spec.n_clusters if n_clusters is None else n_clusters
    restarts = spec.kmeans_restarts if restarts is None else restarts
    long, status = cluster_inputs(features, season, k, spec)
    spark = features.sparkSession
    path = scratch_path(spark, "vectors")
    vectors(long).write.parquet(path)  # read by every pass, and by the result
    rows = spark.read.schema("position string, code bigint, v array<bigint>").parquet(path)
    # one row per configured position and feature
    st = {r["position"]: r["status"] for r in status.collect()}
    usable: dict[str, list[str]] = {}
    for r in sorted(long.select("position", "feature_idx", "feature").distinct().collect()):
        usable.setdefault(r.position, []).append(r.feature)
    base = cohort(features, season, spec).where(
        F.col("position").isin(list(spec.cluster_features)))
    held = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        centres, costs, _ = lloyd(held, first_centres(held, k, restarts, spec.kmeans_seed))
    finally:
        held.unpersist()
    best = {p: min((costs[key], key[1]) for key in centres if key[0] == p)[1]
            for p in {key[0] for key in centres}}
    if best:
        kept = {(p, r): centres[p, r] for p, r in best.items()}
        labels = [row for p, r in best.items() for row in _labels(p, usable[p], centres[p, r])]
        label_df = spark.createDataFrame(
            labels, "position string, nearest bigint, cluster bigint, cluster_label string")
        assigned = _with_centres(rows, kept).withColumn(
            "nearest", F.array_position("d", F.array_min("d")) - 1) \
            .join(F.broadcast(label_df), ["position", "nearest"]) \
            .select("position", "code", "cluster", "cluster_label")
        out = base.join(assigned, ["position", "code"], "left")
    else:
        out = base.withColumns({"cluster": F.lit(None).cast("bigint"),
                                "cluster_label": F.lit(None).cast("string")})
    status_df = spark.createDataFrame(list(st.items()), "position string, status string")
    out = out.join(F.broadcast(status_df), "position", "left")
    return out.withColumns({
        "cluster": F.coalesce(F.col("cluster"), F.lit(-1).cast("bigint")),
        "cluster_label": F.coalesce(
            F.col("cluster_label"),
            F.when(F.col("status") == CLUSTERED, F.lit(NOT_CLUSTERED)).otherwise(F.col("status"))),
    }).drop("status")


def certificates(clustered: DataFrame, long: DataFrame) -> DataFrame:
    """What makes an assignment a K-Means solution, from the assignment and its inputs alone.

    Per position: players, clustered players, clusters in use, misplaced (players nearer to the
    mean of another cluster than to their own, by more than rounding), mislabelled (players
    whose label is not of the feature with the largest mean in their cluster) and unordered
    (clusters whose numbers are not in descending order of their means)."""
    ids = clustered.where("cluster >= 0").select("position", "code", "cluster", "cluster_label")
    values = ids.join(long.select("position", "code", "feature", "feature_idx", "scaled_value"),
                      ["position", "code"])
    means = values.groupBy("position", "cluster", "feature_idx", "feature").agg(
        F.avg("scaled_value").alias("mean"))
    # few rows: positions x clusters x features
    every = means.select("position", F.col("cluster").alias("other"), "feature_idx", "mean")
    far = values.join(F.broadcast(every), ["position", "feature_idx"]).groupBy(
        "position", "code", "cluster", "other").agg(
        F.sum(F.pow(F.col("scaled_value") - F.col("mean"), 2)).alias("d"))
    wrong = far.groupBy("position", "code").agg(
        F.min("d").alias("least"), F.min(F.when(F.col("cluster") == F.col("other"), F.col("d"))).alias("own")) \
        .groupBy("position").agg(F.count_if(F.col("own") > F.col("least") + 1e-6).alias("misplaced"))
    top = means.groupBy("position", "cluster").agg(
        F.max_by("feature", F.struct("mean", -F.col("feature_idx"))).alias("top"),
        F.transform(F.sort_array(F.collect_list(F.struct("feature_idx", "mean"))),
                    lambda s: F.round(s["mean"], 6)).alias("centre"))
    label = F.concat_ws("_", F.col("position"), F.col("top"), F.lit("profile"))
    labelled = ids.join(F.broadcast(top), ["position", "cluster"]).groupBy("position").agg(
        F.count(F.lit(1)).alias("clustered"), F.count_distinct("cluster").alias("clusters"),
        F.count_if(F.col("cluster_label") != label).alias("mislabelled"))
    pairs = top.alias("a").join(top.alias("b"), F.expr(
        "a.position = b.position AND a.cluster < b.cluster")).groupBy("a.position").agg(
        F.count_if(F.expr("a.centre < b.centre")).alias("unordered"))
    out = clustered.groupBy("position").agg(F.count(F.lit(1)).alias("players"))
    for part in (labelled, wrong, pairs):
        out = out.join(part, "position", "left")
    return out.fillna(0)


def cluster_summary(clustered: DataFrame) -> DataFrame:
    """Per position: rows, distinct cluster ids used, distinct labels."""
    return clustered.groupBy("position").agg(
        F.count(F.lit(1)).cast("bigint").alias("players"),
        F.count_distinct(F.when(F.col("cluster") >= 0, F.col("cluster"))).cast("bigint")
        .alias("clusters"),
        F.count_distinct("cluster_label").cast("bigint").alias("labels"))
