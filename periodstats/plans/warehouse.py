"""Layer orchestration: Silver -> Gold -> Features, each materialised once per run.

Every layer is written as Parquet below the shared folder (``spark.checkpoint.dir``) and read
back, as the medallion design intends: each layer is separately readable, downstream jobs
start from a cut lineage (a lost executor recomputes from the written layer, not from the
raw scan), and readers get partition pruning (Silver and Features are partitioned by
``season``) and filter pushdown. Written dimensions also carry real size statistics, so the
planner's broadcast decisions are checked against measured sizes.

Silver, Gold and Features are published by a pointer written after their last table
(``sources.versions``): a build that dies, or a fact whose keys do not resolve, leaves the
version published before in place. Counts of the run (rows per season, rows per table, rows
without a dimension) are observed by the jobs that write the layers and kept beside them.
"""

from __future__ import annotations

import threading
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import conform as silver_ops
from ..operators import features as feature_ops
from ..operators import archetypes, quality, star
from ..session import scratch_path
from ..sources import binding, landing
from ..sources.versions import WHOLE, Layer
from ..spec import (DIM_PLAYER_FIELDS, DIM_SEASON_FIELDS, DIM_TEAM_FIELDS, FACT_FIELDS,
                    FEATURE_FIELDS, RAW_FIELDS, REJECTED_FIELDS, SILVER_FIELDS, L, S, Spec,
                    struct_of)

GOLD_TABLES = ["dim_player", "dim_team", "dim_season", "dim_position",
               "fact_player_season_stats"]
_SCHEMAS = {
    "raw_rows": RAW_FIELDS + [("season", S), ("ingest_seq", L)],
    "raw_teams": [("season", S), ("id", L), ("name", S)],
    "silver": SILVER_FIELDS, "rejected": REJECTED_FIELDS, "dim_player": DIM_PLAYER_FIELDS,
    "dim_team": DIM_TEAM_FIELDS, "dim_season": DIM_SEASON_FIELDS,
    "fact_player_season_stats": FACT_FIELDS, "features": FEATURE_FIELDS,
}
_PARTITIONED = {"raw_rows": "season"}
FACT = "fact_player_season_stats"
FACT_KEYS = {"player": "player_key", "team": "team_key", "season": "season_key",
             "position": "position_key"}
STATUS = struct_of(REJECTED_FIELDS + [("status", S)])
METRICS = "stage string, season string, metric string, value bigint"
#: Order of feature rows, over all files (the season begins with its year).
FEATURE_ORDER = ["season", "position", "code"]


class Warehouse:
    """Builds and serves the layers for one input folder."""

    def __init__(self, spark: SparkSession, sf_dir: str | None, root: str | None = None,
                 spec: Spec = Spec(), frames: list[DataFrame] | None = None,
                 teams: DataFrame | None = None, raw_root: str | None = None,
                 seasons: list[str] | None = None, source: str | None = None):
        """Raw input, in order of precedence:
        * ``raw_root`` + ``seasons``: season files on disk (``<raw_root>/<season>/
          players_raw.csv`` and ``teams.csv``), landed into Bronze and parsed per layout;
        * ``frames``/``teams``: per-layout player frames with ``season`` and ``ingest_seq``,
          and team files with ``season, id, name``;
        * otherwise the TPC-H binding of ``sf_dir``.
        ``source`` is what the manifest says of landed files (default: where they came from)."""
        self.spark, self.sf_dir, self.spec = spark, sf_dir, spec
        self._frames, self._teams = frames, teams
        self.raw_root, self.seasons = raw_root, seasons
        self.source = source or (raw_root if raw_root is not None else landing.SOURCE)
        self.root = root or scratch_path(spark, "warehouse")
        self._built: set[str] = set()
        self._lock = threading.RLock()
        self._shared: dict[str, str] = {}   # table name -> path in a parent warehouse
        self._memo: dict[tuple, DataFrame] = {}
        self._metrics: dict[tuple, int] = {}  # (stage, season or None, metric) -> value

    def fork(self) -> "Warehouse":
        """A warehouse in a fresh folder that reads this one's raw and Silver layers and
        builds its own Gold and Features (a Gold rebuild from the same Silver)."""
        self._ensure("silver")
        child = Warehouse(self.spark, self.sf_dir, spec=self.spec, frames=self._frames,
                          teams=self._teams, raw_root=self.raw_root, seasons=self.seasons,
                          source=self.source)
        for name in ("raw_rows", "raw_teams", "silver"):
            child._shared[name] = self.path(name)
        child._metrics |= {k: v for k, v in self._metrics.items() if k[0] == "silver"}
        child._shared["bronze"] = self.path("bronze")
        child._built |= {"raw", "silver"} | ({"landing"} & self._built)
        return child

    # -- raw inputs ---------------------------------------------------------
    def raw_frames(self) -> list[DataFrame]:
        if self.raw_root is not None:
            _, bronze = self.landing()
            return [landing.bronze_rows(self.spark, bronze, landing.PLAYERS)]
        if self._frames is not None:
            return self._frames
        return binding.raw_season_frames(self.supplier_years())

    def team_files(self) -> DataFrame:
        if self.raw_root is not None:
            _, bronze = self.landing()
            t = landing.bronze_rows(self.spark, bronze, landing.TEAMS)
            return t.select("season", F.col("id").try_cast("bigint").alias("id"), "name")
        if self._teams is not None:
            return self._teams
        return binding.team_files(self.spark, self.sf_dir, self.supplier_years())

    def supplier_years(self) -> DataFrame:
        """The aggregated lineitem table of the binding, written once per run."""
        with self._lock:
            path = self.path("supplier_years")
            if "supplier_years" not in self._built:
                binding.supplier_years(self.spark, self.sf_dir).write.mode("overwrite").parquet(path)
                self._built.add("supplier_years")
        return self.spark.read.parquet(path)

    def conformed(self) -> DataFrame:
        """Raw rows of all seasons in the Silver layout (read from the materialised raw rows)."""
        return silver_ops.conformed_rows([self.read("raw_rows")], self.read("raw_teams"),
                                         self.spec)

    # -- storage ------------------------------------------------------------
    def path(self, name: str) -> str:
        return self._shared.get(name) or f"{self.root}/{name}"

    def _write(self, name: str, df: DataFrame) -> None:
        w = df.write.mode("overwrite")
        if name in _PARTITIONED:
            w = w.partitionBy(_PARTITIONED[name])
        w.parquet(self.path(name))

    def layer(self, name: str) -> Layer:
        return Layer(self.spark, self.path(name))

    def read(self, name: str) -> DataFrame:
        self._ensure(name)
        return self._published(name)

    def _published(self, name: str) -> DataFrame:
        """The published table, without a build."""
        if name == "dim_position":
            return star.dim_position(self.spark)
        fields = _SCHEMAS[name]
        if name in ("silver", "rejected"):
            # one status table partitioned by season; clean / rejected is a row filter
            status = "clean" if name == "silver" else "rejected"
            df = self.layer("silver").read("status", STATUS, "season") \
                .where(F.col("status") == status)
        elif name == "features":
            df = self.layer("features").read("rows", struct_of(fields))
        elif name.startswith("raw_"):
            df = self.spark.read.schema(struct_of(fields)).parquet(self.path(name))
        else:
            df = self.layer("gold").read(name, struct_of(fields))
        return df.select(*[n for n, _ in fields])

    def _ensure(self, name: str) -> None:
        """Build the layer that holds table ``name`` if this run has not built it yet."""
        with self._lock:
            layer = {"silver": "silver", "rejected": "silver", "features": "features",
                     "raw_rows": "raw", "raw_teams": "raw",
                     "dim_position": None}.get(name, "gold")
            if layer is None or layer in self._built:
                return
            getattr(self, f"_build_{layer}")()
            self._built.add(layer)

    # -- layers -------------------------------------------------------------
    def _parallel(self, jobs: dict[str, DataFrame]) -> None:
        """Write independent tables as concurrent Spark jobs (hides per-job latency)."""
        with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
            for f in [pool.submit(self._write, n, df) for n, df in jobs.items()]:
                f.result()

    def _build_raw(self) -> None:
        # the raw season rows conformed to one schema; lineitem is read once, for the
        # supplier-year table below them
        self._parallel({"raw_rows": silver_ops.union_seasons(self.raw_frames()),
                        "raw_teams": self.team_files()})

    def _build_silver(self, seasons: list[str] | None = None) -> None:
        # one pass over the raw rows; clean and rejected rows of a season share its partition,
        # so publishing a season replaces both at once
        rows = self.conformed()
        if seasons is not None:
            rows = rows.where(F.col("season").isin(seasons))
        layer, version = self.layer("silver"), Layer.fresh()
        after, known = layer.current()
        # seasons are read from the names of folders
        found = sorted(r.season for r in self.read("raw_rows").select("season").distinct().collect())
        if seasons is not None:
            found = [s for s in found if s in seasons]
        counts = {("silver", s, f"{status}_rows"): F.count_if((F.col("season") == s)
                                                              & (F.col("status") == status))
                  for s in found for status in ("clean", "rejected")}
        seen = self._write_counted(silver_ops.silver_status(rows), counts,
                                   layer.write_path("status", version), "season")
        # a season that lost all its rows has no folder and points at an empty version
        layer.publish({s: version for s in {*found, *(seasons or [])}}, after=after)
        self._metrics = {k: v for k, v in self._metrics.items()
                         if k[0] != "silver" or seasons is not None and k[1] not in seasons}
        self._metrics |= seen

    def _write_counted(self, df: DataFrame, counts: dict[tuple, F.Column], path: str,
                       by: str | None = None) -> dict[tuple, int]:
        """Write ``df`` and return ``counts`` as the writing job observed them."""
        seen = Observation()
        w = df.observe(seen, *[c.alias(f"c{i}") for i, c in enumerate(counts.values())]).write
        (w.partitionBy(by) if by else w).parquet(path)
        values = seen.get
        return {k: int(values[f"c{i}"] or 0) for i, k in enumerate(counts)}

    def _build_gold(self) -> None:
        silver = self.read("silver")
        layer, version = self.layer("gold"), Layer.fresh()
        after, _ = layer.current()

        def write(name: str, df: DataFrame, more: dict | None = None) -> dict[tuple, int]:
            counts = {("gold", None, f"{name}_rows"): F.count(F.lit(1))} | (more or {})
            return self._write_counted(df, counts, layer.write_path(name, version))

        def written(name: str) -> DataFrame:
            return self.spark.read.schema(struct_of(_SCHEMAS[name])).parquet(
                layer.write_path(name, version))
        # dim_player's numbering checkpoints while the two small dimensions are written
        small = {"dim_season": star.dim_season(silver), "dim_team": star.dim_team(silver)}
        with ThreadPoolExecutor(max_workers=3) as pool:
            players = pool.submit(star.dim_player, silver)
            jobs = [pool.submit(write, n, df) for n, df in small.items()]
            seen = write("dim_player", players.result())
            for job in jobs:
                seen |= job.result()
        positions = star.dim_position(self.spark)
        seen["gold", None, "dim_position_rows"] = positions.count()  # literal rows
        fact = star.fact_table(silver, written("dim_player"), written("dim_team"),
                               written("dim_season"), positions)
        # a key that its dimension does not have is null: left joins keep the row
        seen |= write(FACT, fact, {("gold", None, f"orphaned_{n}_rows"): F.count_if(F.col(k).isNull())
                                   for n, k in FACT_KEYS.items()})
        quality.assert_no_orphan_counts({n: seen["gold", None, f"orphaned_{n}_rows"]
                                         for n in FACT_KEYS})
        layer.publish({WHOLE: version}, after=after)
        self._metrics = {k: v for k, v in self._metrics.items() if k[0] != "gold"} | seen

    def _build_features(self) -> None:
        wide = feature_ops.star_join_wide(
            self.read(FACT), self.read("dim_player"), self.read("dim_team"),
            self.read("dim_season"), self.read("dim_position"), keep_key=True)
        layer, version = self.layer("features"), Layer.fresh()
        after, _ = layer.current()
        # Range partitions, sorted: files in the order of their names are the rows in order, and
        # a season's rows lie in few files.
        ranged = feature_ops.build_features(wide).repartitionByRange(*FEATURE_ORDER) \
            .sortWithinPartitions(*FEATURE_ORDER)
        seasons = [r.season for r in self.read("dim_season").select("season").collect()]
        counts = {("features", None, "feature_rows"): F.count(F.lit(1))} | {
            ("features", s, "feature_rows"): F.count_if(F.col("season") == s) for s in seasons}
        path = layer.write_path("rows", version)
        seen = self._write_counted(ranged, counts, path, "season")
        # rows per file and the least and largest key, one row a file
        rows = self.spark.read.schema(struct_of(FEATURE_FIELDS)).parquet(path)
        key = F.struct("position", "code")
        rows.groupBy("season", F.col("_metadata.file_path").alias("path")).agg(
            F.count(F.lit(1)).alias("rows"), F.min(key).alias("least"), F.max(key).alias("most")) \
            .write.parquet(layer.write_path("files", version))
        layer.publish({WHOLE: version}, after=after)
        seen["features", None, "players"] = self._metrics.get(
            ("gold", None, "dim_player_rows"), 0)  # every player of the fact has a feature row
        self._metrics = {k: v for k, v in self._metrics.items() if k[0] != "features"} | seen

    def feature_files(self) -> DataFrame:
        """season, path, rows, least and most (position, code) of each file of feature rows."""
        self._ensure("features")
        schema = T.StructType.fromDDL(
            "season string, path string, rows bigint, least struct<position: string, code: bigint>, "
            "most struct<position: string, code: bigint>")
        return self.layer("features").read("files", schema)

    def feature_row(self, season: str, position: str, code: int) -> DataFrame:
        """The feature row of one key, from the file that may hold it (looked up in the index)."""
        key = F.struct(F.lit(position).alias("position"), F.lit(code).cast("bigint").alias("code"))
        found = self.feature_files().where(F.col("season") == season) \
            .where((F.col("least") <= key) & (key <= F.col("most"))).select("path").collect()
        names = [n for n, _ in FEATURE_FIELDS]
        schema = struct_of([f for f in FEATURE_FIELDS if f[0] != "season"])
        if not found:
            return self.features().where("false")
        rows = self.spark.read.schema(schema).parquet(*[r.path for r in found])  # one, as keys are unique
        return rows.where((F.col("position") == position) & (F.col("code") == code)) \
            .withColumn("season", F.lit(season)).select(*names)

    def metrics(self) -> DataFrame:
        """stage, season (null: all), metric, value of the layers built by this warehouse, as the
        jobs that wrote them counted; no layer is read."""
        self.build_all()
        known = dict(self._metrics)
        clean = {s: n for (stage, s, m), n in known.items() if (stage, m) == ("silver", "clean_rows")}
        known["silver", None, "total_clean_rows"] = sum(clean.values())
        known["silver", None, "total_rejected_rows"] = sum(
            n for (stage, _, m), n in known.items() if (stage, m) == ("silver", "rejected_rows"))
        known["silver", None, "seasons_processed"] = sum(n > 0 for n in clean.values())
        known["gold", None, "orphaned_fact_rows"] = sum(
            known["gold", None, f"orphaned_{n}_rows"] for n in FACT_KEYS)
        return self.spark.createDataFrame([(*k, v) for k, v in sorted(known.items(), key=str)], METRICS)

    # -- incremental reload ---------------------------------------------------
    def reload_seasons(self, seasons: list[str]) -> None:
        """Rebuild the raw rows and Silver of ``seasons`` only and swap their partitions in
        (dynamic partition overwrite); Gold and Features are rebuilt on next read, because
        surrogate keys are dense over all seasons."""
        with self._lock:
            self._ensure("silver")
            seasons = [str(s) for s in seasons]
            if self.raw_root is not None:
                self._built.discard("landing")
                landing.land(self.spark, self.raw_root, self.path("bronze"), seasons,
                             self.source)
                self._built.add("landing")
            self._built.discard("supplier_years")
            raw = silver_ops.union_seasons(self.raw_frames()) \
                .where(F.col("season").isin(seasons))
            raw.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
                .partitionBy("season").parquet(self.path("raw_rows"))
            self._build_silver(seasons)
            self._built -= {"gold", "features", "files_status"}
            if self.raw_root is None:
                self._built.discard("landing")  # raw files are rewritten from the new rows
            self._memo.clear()

    # -- files: raw season files and the Bronze landing ------------------------
    def landing(self) -> tuple[str, str]:
        """Write the raw season files once, land them into Bronze; (raw_root, bronze_root)."""
        with self._lock:
            if "landing" not in self._built:
                if self.raw_root is not None:   # files already on disk: land them as they are
                    landing.land(self.spark, self.raw_root, self.path("bronze"), self.seasons,
                                 self.source)
                    self._built.add("landing")
                    return self.raw_root, self.path("bronze")
                frames = self._frames if self._frames is not None else \
                    binding.layout_frames(self.read("raw_rows"))  # no second lineitem pass
                landing.write_raw_files(frames, self.read("raw_teams"), self.path("raw"))
                seasons = [r.season for r in self.team_files().select("season").distinct()
                           .collect()]  # one row per configured season
                landing.land(self.spark, self.path("raw"), self.path("bronze"), sorted(seasons),
                             self.source)
                self._built.add("landing")
        return (self.raw_root or self.path("raw")), self.path("bronze")

    def silver_from_files(self) -> tuple[DataFrame, DataFrame]:
        """(clean, rejected) computed from the landed Bronze files instead of the binding;
        the status pass is written once per run."""
        with self._lock:
            if "files_status" not in self._built:
                _, bronze = self.landing()
                players = landing.bronze_rows(self.spark, bronze, landing.PLAYERS)
                teams = landing.bronze_rows(self.spark, bronze, landing.TEAMS)
                rows = silver_ops.conformed_rows([players], teams, self.spec)
                silver_ops.silver_status(rows).write.mode("overwrite") \
                    .partitionBy("status", "season").parquet(self.path("files_status"))
                self._built.add("files_status")
        fields = _SCHEMAS["rejected"] + [("status", S)]
        st = self.spark.read.schema(struct_of(fields)).parquet(self.path("files_status"))
        return (st.where(F.col("status") == "clean").select(*[n for n, _ in SILVER_FIELDS]),
                st.where(F.col("status") == "rejected").select(*[n for n, _ in REJECTED_FIELDS]))

    def clusters(self, season: str, n_clusters: int) -> DataFrame:
        """Cluster assignments of one season, fitted once per run and written."""
        key = ("clusters", season, n_clusters)
        with self._lock:
            if key not in self._memo:
                out = archetypes.cluster_playing_styles(self.features(), season, n_clusters,
                                                        self.spec)
                path = self.path(f"clusters/season={season}/k={n_clusters}")
                out.write.mode("overwrite").parquet(path)
                self._memo[key] = self.spark.read.schema(out.schema).parquet(path)
        return self._memo[key]

    # -- convenience --------------------------------------------------------
    def silver(self) -> DataFrame:
        return self.read("silver")

    def rejected(self) -> DataFrame:
        return self.read("rejected")

    def features(self) -> DataFrame:
        return self.read("features")

    def gold(self) -> dict[str, DataFrame]:
        return {t: self.read(t) for t in GOLD_TABLES}

    def build_all(self) -> None:
        for name in ("silver", "fact_player_season_stats", "features"):
            self._ensure(name)


_CACHE: dict[tuple, Warehouse] = {}
_CACHE_LOCK = threading.Lock()


def _contents(spark: SparkSession, sf_dir: str) -> tuple:
    """Names, sizes and times of what lies in the input folder."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(sf_dir)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime())
                        for f in fs.listStatus(path)))


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The run's warehouse for ``sf_dir``: built once per application and state of the folder."""
    key = _key(spark, sf_dir)
    with _CACHE_LOCK:
        if key not in _CACHE:
            _CACHE[key] = Warehouse(spark, sf_dir)
        return _CACHE[key]


def _key(spark: SparkSession, sf_dir: str) -> tuple:
    return spark.sparkContext.applicationId, sf_dir, _contents(spark, sf_dir)


def serve(wh: Warehouse) -> None:
    """Let ``warehouse`` give this one for its folder from now on."""
    key = _key(wh.spark, wh.sf_dir)
    with _CACHE_LOCK:
        _CACHE[key] = wh
