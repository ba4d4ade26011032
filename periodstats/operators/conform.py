"""Silver: schema conformance, season-scoped team lookup, validation and de-duplication.

Plan notes
* Each file layout is read as its own frame and conformed to one declared schema, then the
  frames are unioned *by name* (a positional union over files with different headers
  silently swaps columns).
* The team lookup is keyed by (season, team): raw team ids are re-used by other clubs in
  other seasons. The lookup has (#seasons x #teams) rows, a size fixed by configuration,
  so it is broadcast.
* Validity is one boolean per row in which an unknown rule result counts as failed, so a
  row can never drop out of both the clean and the rejected output.
* "Keep the first copy per (code, season)" is a partial aggregate ``min(ingest_seq)`` plus
  an equi-join on (code, season, ingest_seq). Unlike a window over (code, season), a key
  with a very large number of copies is hashed over many tasks on the join side and
  pre-combined map-side on the aggregate side.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (DataType, DoubleType, FloatType, LongType, StringType,
                               StructType)

from ..functions.columns import all_true, label_map
from ..spec import RAW_SCHEMA, REJECTED_FIELDS, SILVER_FIELDS, Spec

SILVER_COLUMNS = [n for n, _ in SILVER_FIELDS]
REJECTED_COLUMNS = [n for n, _ in REJECTED_FIELDS]


def _cast(column: str, have: DataType, want: DataType) -> Column:
    """A value of the wanted type or NULL. A whole number written as ``1000.0`` is one, and
    NaN stands for a missing value."""
    c = F.col(column)
    if isinstance(want, LongType) and isinstance(have, (StringType, DoubleType, FloatType)):
        number = c.try_cast("double")
        whole = F.when(number == F.floor(number), number.try_cast("bigint"))
        return F.coalesce(c.try_cast("bigint"), whole) if isinstance(have, StringType) else whole
    out = c if have == want else c.try_cast(want)
    return F.when(~F.isnan(out), out) if isinstance(want, DoubleType) else out


def conform(df: DataFrame, schema: StructType = RAW_SCHEMA,
            keep: tuple[str, ...] = ("season", "ingest_seq")) -> DataFrame:
    """Force ``df`` to ``schema``: missing columns become typed NULLs, extra ones are dropped,
    present ones are cast with ``try_cast`` (a bad value becomes NULL and is judged by the
    validity rules instead of failing the job)."""
    have = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for f in schema.fields:
        if f.name not in have:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            cols.append(_cast(f.name, have[f.name], f.dataType).alias(f.name))
    return df.select(*cols, *[F.col(k) for k in keep if k in have])


def union_seasons(frames: list[DataFrame], schema: StructType = RAW_SCHEMA) -> DataFrame:
    conformed = [conform(f, schema) for f in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), conformed)


def team_lookup(teams: DataFrame) -> DataFrame:
    """Prune and rename a team file: ``id -> team``, ``name -> team_name``; an id that is no
    number is no team's (also where the optimizer reads a file's header before it is left out)."""
    return teams.select("season", F.col("id").try_cast("bigint").alias("team"),
                        F.col("name").alias("team_name"))


def conformed_rows(frames: list[DataFrame], teams: DataFrame, spec: Spec = Spec()) -> DataFrame:
    """All raw rows of all seasons in the Silver column layout (before validation)."""
    players = union_seasons(frames)
    # a user's file: broadcast only if the planner measures it small
    joined = players.join(team_lookup(teams), ["season", "team"], "left")
    start = F.substring("season", 1, 4).cast("bigint")
    out = joined.withColumns({
        "season_start_year": start,
        "season_end_year": start + 1,
        "position": label_map("element_type", spec.position_map),
    })
    return out.select(*SILVER_COLUMNS)


VALIDITY_RULES = {
    "minutes": lambda: F.col("minutes") >= 0,
    "now_cost": lambda: F.col("now_cost") > 0,
    "position": lambda: F.col("position").isNotNull(),
    "team_name": lambda: F.col("team_name").isNotNull(),
    "code": lambda: F.col("code").isNotNull(),
}


def with_validity(rows: DataFrame) -> DataFrame:
    rules = {k: r() for k, r in VALIDITY_RULES.items()}
    failed = [F.when(~F.coalesce(c, F.lit(False)), F.lit(k)) for k, c in rules.items()]
    return rows.withColumns({"is_valid": all_true(list(rules.values())),
                             "reject_reason": F.concat_ws(",", *failed)})


def silver_status(rows: DataFrame) -> DataFrame:
    """Every input row once, with ``status`` ('clean' or 'rejected') and ``reject_reason``.

    One pass: the first copy per (code, season) among valid rows comes from a partial
    aggregate joined back on (code, season, ingest_seq); a row is clean when it is valid and
    is that first copy. Later valid copies are rejected as ``duplicate``."""
    status = with_validity(rows)
    first = status.where("is_valid").groupBy("code", "season") \
        .agg(F.min("ingest_seq").alias("ingest_seq")).withColumn("is_first", F.lit(True))
    marked = status.join(first, ["code", "season", "ingest_seq"], "left")
    clean = F.col("is_valid") & F.col("is_first").isNotNull()
    return marked.select(
        *SILVER_COLUMNS,
        F.when(clean, F.lit(None).cast("string"))
        .when(F.col("is_valid"), F.lit("duplicate"))
        .otherwise(F.col("reject_reason")).alias("reject_reason"),
        F.when(clean, F.lit("clean")).otherwise(F.lit("rejected")).alias("status"))


def split_clean_rejected(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean, rejected). Duplicates are judged among valid rows only; later copies are
    rejected with reason ``duplicate``. Nothing is lost: clean + rejected = input."""
    st = silver_status(rows)
    return (st.where(F.col("status") == "clean").select(*SILVER_COLUMNS),
            st.where(F.col("status") == "rejected").select(*REJECTED_COLUMNS))


def season_counts(clean: DataFrame, rejected: DataFrame) -> DataFrame:
    """Per-season clean and rejected counts (rejected includes duplicates): one pass."""
    both = clean.select("season", F.lit(True).alias("ok")).unionByName(
        rejected.select("season", F.lit(False).alias("ok")))
    return both.groupBy("season").agg(
        F.count_if(F.col("ok")).cast("bigint").alias("clean_rows"),
        F.count_if(~F.col("ok")).cast("bigint").alias("rejected_rows"),
    )


def xg_available_seasons(clean: DataFrame, first_xg_year: int) -> DataFrame:
    """Seasons that carry expected-goal data, decided from the data (any non-NULL value),
    with the calendar rule (start year >= ``first_xg_year``) beside it as a check."""
    return clean.groupBy("season", "season_start_year").agg(
        (F.count("expected_goals") > 0).alias("has_xg_data"),
    ).select("season", "has_xg_data",
             (F.col("season_start_year") >= first_xg_year).alias("by_year_rule"))
