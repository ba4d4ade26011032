"""Raw season data derived from the driver's TPC-H-like tables.

One entity-period ("player-season") is one supplier-year of ``lineitem ⋈ supplier ⋈ nation``.
The mapping of lineitem facts onto the raw columns is a fixed test binding (see FIXTURES.md,
part B); it also plants the data faults the cleaning layer must catch: a position code
outside the map, negative and missing exposure, duplicate rows, a missing name, entities that
change team, and columns that only exist from one season on.

Plan shape: lineitem is aggregated to one row per (supplier, year) *before* any join, with a
partial (map-side) aggregate, so the shuffle carries at most one row per supplier-year per
task. The supplier join is left to the planner (broadcast when the statistics say it is
small, sort-merge otherwise); ``nation`` has 25 rows by definition and is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed binding parameter: the season whose file layout first carries ``starts`` and the
# expected-goal columns. The seasons themselves are the years that occur in the data.
LAYOUT_CHANGE_YEAR = 1998
N_TEAMS = 25


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _dec(c: Column) -> Column:
    return c.cast("decimal(18,2)")


def _dsum(name: str) -> Column:
    # order-independent sum of a double column: exact decimal sum, then double
    return F.sum(_dec(F.col(name))).cast("double")


def _cnt(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")


def supplier_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (supplier, year of any shipped line); the only pass over lineitem.

    A line without a date belongs to no season; ``season_coverage`` counts such lines."""
    li = read_table(spark, sf_dir, "lineitem").where(F.col("l_shipdate").isNotNull())
    disc, tax = _dec(F.col("l_discount")), _dec(F.col("l_tax"))
    agg = li.groupBy(
        F.col("l_suppkey").alias("code"),
        F.year("l_shipdate").cast("bigint").alias("yr"),
    ).agg(
        F.count(F.lit(1)).alias("n"),
        _dsum("l_quantity").alias("qty"),
        _dsum("l_extendedprice").alias("ext"),
        _dsum("l_discount").alias("disc"),
        _dsum("l_tax").alias("tax"),
        F.sum("l_linenumber").cast("bigint").alias("bps"),
        _cnt(F.col("l_returnflag") == "R").alias("flag_r"),
        _cnt(F.col("l_returnflag") == "A").alias("flag_a"),
        _cnt(F.col("l_returnflag") == "N").alias("flag_n"),
        _cnt(F.col("l_linestatus") == "F").alias("status_f"),
        _cnt(F.col("l_linestatus") == "O").alias("status_o"),
        _cnt(disc == 0).alias("disc_zero"),
        _cnt(tax == 0).alias("tax_zero"),
        _cnt(F.col("l_linenumber") == 7).alias("line_seven"),
        _cnt(F.col("l_quantity") == 50).alias("qty_fifty"),
        _cnt(F.col("l_quantity") == 1).alias("qty_one"),
        _cnt(disc == F.lit(0.10).cast("decimal(18,2)")).alias("disc_ten"),
    )
    sup = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nat = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    # supplier joined on its own (the planner sees its real size), nation broadcast after
    out = agg.join(sup, agg.code == sup.s_suppkey, "inner")
    return out.join(F.broadcast(nat), out.s_nationkey == nat.n_nationkey, "inner")


def _player_columns(df: DataFrame, with_new_columns: bool) -> DataFrame:
    code, yr = F.col("code"), F.col("yr")
    season = yr.cast("string")
    element_type = (F.col("n_regionkey") + 1).cast("bigint")
    qty = F.col("qty").cast("bigint")
    minutes = (
        F.when((code % 11 == 3) & (yr == 1996), -qty)
        .when((code % 13 == 5) & (yr == 1997), F.lit(None).cast("bigint"))
        .otherwise(qty)
    )
    transfer = F.when((yr >= 1999) & (code % 5 == 2), 1).otherwise(0)
    influence = F.col("ext") / 1000.0
    creativity = F.col("disc") * 10.0
    threat = F.col("tax") * 10.0
    goals, assists = F.col("flag_r"), F.col("flag_a")
    total_points = (4 * goals + 3 * assists + F.col("status_f")).cast("bigint")
    cols = {
        "code": code,
        "web_name": F.when((yr == 2001) & (code % 9 == 1), F.lit(None).cast("string"))
        .otherwise(F.concat(F.col("s_name"), F.lit("/"), season)),
        "first_name": F.lit("Supplier"),
        "second_name": F.col("s_name"),
        "element_type": element_type,
        "team": ((F.col("s_nationkey") + transfer + yr) % N_TEAMS).cast("bigint"),
        "minutes": minutes,
        "goals_scored": goals,
        "assists": assists,
        "clean_sheets": F.col("status_f"),
        "goals_conceded": F.col("status_o"),
        "own_goals": F.col("disc_zero"),
        "yellow_cards": F.col("tax_zero"),
        "red_cards": F.col("line_seven"),
        "saves": F.when(element_type == 1, F.col("flag_n")).otherwise(F.lit(0).cast("bigint")),
        "penalties_missed": F.col("qty_fifty"),
        "penalties_saved": F.col("qty_one"),
        "bonus": F.col("disc_ten"),
        "bps": F.col("bps"),
        "influence": influence,
        "creativity": creativity,
        "threat": threat,
        "ict_index": (influence + creativity + threat) / 10.0,
        "now_cost": (40 + code % 60).cast("bigint"),
        "selected_by_percent": F.lit(100.0) * F.col("disc") / F.col("n"),
        "total_points": total_points,
        "points_per_game": total_points / F.col("n"),
    }
    if with_new_columns:
        cols["starts"] = F.col("n")
        cols["expected_goals"] = F.col("tax") * 8.0
        cols["expected_assists"] = F.col("disc") * 6.5
        cols["expected_goal_involvements"] = cols["expected_goals"] + cols["expected_assists"]
    out = df.select(
        *[c.alias(n) for n, c in cols.items()],
        season.alias("season"),
        # the planted duplicate: a second file row for some entities in 2000
        F.explode(
            F.when((code % 7 == 0) & (yr == 2000), F.array(F.lit(1), F.lit(2)))
            .otherwise(F.array(F.lit(1))).cast("array<bigint>")
        ).alias("ingest_seq"),
    )
    second = F.col("ingest_seq") == 2
    return out.withColumns({
        "minutes": F.when(second, F.col("minutes") + 1).otherwise(F.col("minutes")),
        "goals_scored": F.when(second, F.col("goals_scored") + 1).otherwise(F.col("goals_scored")),
    })


def raw_season_frames(years: DataFrame) -> list[DataFrame]:
    """Raw player rows, one frame per file layout, each with its own column set.

    Seasons before ``LAYOUT_CHANGE_YEAR`` physically lack ``starts`` and the three
    expected-goal columns, exactly as old season files do. ``years`` is the written
    supplier-year table, so splitting it by layout reads no lineitem row again.
    """
    return [_player_columns(years.where(F.col("yr") < LAYOUT_CHANGE_YEAR), False),
            _player_columns(years.where(F.col("yr") >= LAYOUT_CHANGE_YEAR), True)]


NEW_COLUMNS = ("starts", "expected_goals", "expected_assists", "expected_goal_involvements")


def layout_frames(rows: DataFrame) -> list[DataFrame]:
    """Split conformed raw rows back into the per-layout frames of the season files: seasons
    before ``LAYOUT_CHANGE_YEAR`` without the columns their files never had."""
    year = F.substring("season", 1, 4).cast("int")
    old = rows.where(year < LAYOUT_CHANGE_YEAR).drop(*NEW_COLUMNS)
    new = rows.where(year >= LAYOUT_CHANGE_YEAR)
    return [old, new]


def team_files(spark: SparkSession, sf_dir: str, years: DataFrame) -> DataFrame:
    """Per-season team lookup (``season, id, name``): raw team ids are re-used each season.

    Built from ``nation`` (a fixed 25 rows) with one generated row per season that occurs.
    """
    nat = read_table(spark, sf_dir, "nation")
    seasons = sorted(r["yr"] for r in years.select("yr").distinct().collect())  # one row a year
    yr = F.explode(F.array(*[F.lit(int(s)) for s in seasons]).cast("array<int>")).alias("yr")
    per_season = nat.select("n_nationkey", "n_name", yr)
    return per_season.select(
        F.col("yr").cast("string").alias("season"),
        ((F.col("n_nationkey") + F.col("yr")) % N_TEAMS).cast("bigint").alias("id"),
        F.col("n_name").alias("name"),
    )
