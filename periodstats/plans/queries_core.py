"""Silver, Gold, Features and scoring queries."""

from __future__ import annotations

from ..operators import scoring
from ..spec import (FACT_FIELDS, FEATURE_FIELDS, OUTLIER_OUTPUT_COLUMNS, REJECTED_FIELDS,
                    SILVER_FIELDS, D)
from . import oracle as O
from .catalog import SEASON, SPEC, register
from .warehouse import warehouse

_FEATURE_TYPES = dict(FEATURE_FIELDS)


@register("silver_clean", SILVER_FIELDS,
          O.with_ctes(O.SILVER, f"SELECT {O.SILVER_COLS} FROM clean"))
def silver_clean(spark, sf):
    return warehouse(spark, sf).silver()


@register("silver_rejected", REJECTED_FIELDS,
          O.with_ctes(O.SILVER, f"SELECT {O.SILVER_COLS}, reject_reason FROM rejected"))
def silver_rejected(spark, sf):
    return warehouse(spark, sf).rejected()


@register("fact_player_season", FACT_FIELDS, O.with_ctes(O.GOLD, "SELECT * FROM fact"))
def fact_player_season(spark, sf):
    return warehouse(spark, sf).read("fact_player_season_stats")


@register("feature_table", FEATURE_FIELDS,
          O.with_ctes(O.FEATURES, f"SELECT {O.FEATURE_COLS} FROM features"))
def feature_table(spark, sf):
    return warehouse(spark, sf).features()


_OUT = [(c, _FEATURE_TYPES.get(c, D)) for c in OUTLIER_OUTPUT_COLUMNS]


@register("discovery_topn", _OUT, O.with_ctes(
    O.scores(SEASON, SPEC.min_minutes),
    f"SELECT {', '.join(OUTLIER_OUTPUT_COLUMNS)} FROM scored "
    f"ORDER BY discovery_score DESC NULLS LAST, code LIMIT {SPEC.top_n}"))
def discovery_topn(spark, sf):
    return scoring.detect_value_outliers(warehouse(spark, sf).features(), SEASON, spec=SPEC)
