"""Declared schemas, fixed values and run parameters of the entity-period data model.

One row of the model is one entity (a "player") in one period (a "season"). The column
names follow the football layout the library was first written for; the TPC-H binding in
``sources.binding`` fills the same columns from the driver tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

L, D, S, B = LongType(), DoubleType(), StringType(), BooleanType()

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference for equal results)
# ---------------------------------------------------------------------------
# element_type code -> position label
POSITION_MAP = {1: "GK", 2: "DEF", 3: "MID", 4: "FWD"}
# dim_position rows: (position_key, position_code, position_name)
POSITION_ROWS = [
    (1, "GK", "Goalkeeper"),
    (2, "DEF", "Defender"),
    (3, "MID", "Midfielder"),
    (4, "FWD", "Forward"),
]
# clustering features per position, in this order (first wins on ties)
CLUSTER_FEATURES_BY_POSITION = {
    "GK": ["saves_per_90", "clean_sheets_per_90", "goals_conceded_per_90", "bps_per_90"],
    "DEF": ["clean_sheets_per_90", "goals_per_90", "assists_per_90", "bps_per_90", "threat_per_90"],
    "MID": ["goals_per_90", "assists_per_90", "creativity_per_90", "threat_per_90", "influence_per_90"],
    "FWD": ["goals_per_90", "assists_per_90", "threat_per_90", "creativity_per_90", "bps_per_90"],
}
MIN_MINUTES_FOR_CLUSTERING = 1000
DEFAULT_N_CLUSTERS = 4
MIN_CLUSTERS = 3
MAX_CLUSTERS = 5
DEFAULT_TOP_N = 15
KMEANS_SEED = 42
KMEANS_RESTARTS = 10
HIDDEN_GEM_WEIGHT = 0.70
OVERPERFORMANCE_WEIGHT = 0.30
RAW_FILES = ("players_raw.csv", "teams.csv")
# Core raw columns every season is conformed to (``starts`` is missing in early layouts).
CORE_FIELDS = [
    ("code", L), ("web_name", S), ("first_name", S), ("second_name", S),
    ("element_type", L), ("team", L), ("minutes", L), ("starts", L),
    ("goals_scored", L), ("assists", L), ("clean_sheets", L), ("goals_conceded", L),
    ("own_goals", L), ("yellow_cards", L), ("red_cards", L), ("saves", L),
    ("penalties_missed", L), ("penalties_saved", L), ("bonus", L), ("bps", L),
    ("influence", D), ("creativity", D), ("threat", D), ("ict_index", D),
    ("now_cost", L), ("selected_by_percent", D), ("total_points", L), ("points_per_game", D),
]
# Actual-versus-expected inputs, absent before the layout change.
XG_FIELDS = [("expected_goals", D), ("expected_assists", D), ("expected_goal_involvements", D)]
# (feature name, numerator columns) of the per-90 rates, in output order.
PER_90 = [
    ("goals_per_90", ["goals_scored"]),
    ("assists_per_90", ["assists"]),
    ("goal_involvements_per_90", ["goals_scored", "assists"]),
    ("clean_sheets_per_90", ["clean_sheets"]),
    ("goals_conceded_per_90", ["goals_conceded"]),
    ("saves_per_90", ["saves"]),
    ("bonus_per_90", ["bonus"]),
    ("bps_per_90", ["bps"]),
    ("influence_per_90", ["influence"]),
    ("creativity_per_90", ["creativity"]),
    ("threat_per_90", ["threat"]),
    ("ict_index_per_90", ["ict_index"]),
    ("points_per_90", ["total_points"]),
]
RESIDUAL_FIELDS = ["goals_minus_xg", "assists_minus_xa", "goal_involvements_minus_xgi",
                   "goals_minus_xg_per_90", "assists_minus_xa_per_90",
                   "goal_involvements_minus_xgi_per_90"]
VALUE_FIELDS = ["cost_millions", "points_per_million"]
HISTORY_FIELDS = ["points_per_game_prev_season", "points_per_game_yoy_change",
                  "points_per_90_prev_season", "points_per_90_yoy_change",
                  "points_consistency_std", "goals_per_90_trend_slope",
                  "assists_per_90_trend_slope"]
OUTLIER_OUTPUT_COLUMNS = [
    "web_name", "team_name", "position", "minutes", "cost_millions", "total_points",
    "points_per_million", "selected_by_percent", "goals_per_90", "assists_per_90",
    "goals_minus_xg_per_90", "assists_minus_xa_per_90", "hidden_gem_score",
    "overperformance_score", "discovery_score",
]
# labels of rows that are in no cluster
TOO_FEW_PLAYERS = "insufficient_players_for_clustering"
TOO_FEW_FEATURES = "insufficient_feature_data"
NOT_CLUSTERED = "not_clustered"
# ---------------------------------------------------------------------------

RAW_FIELDS = CORE_FIELDS + XG_FIELDS
RAW_SCHEMA = StructType([StructField(n, t) for n, t in RAW_FIELDS])

SILVER_FIELDS = CORE_FIELDS + XG_FIELDS + [
    ("team_name", S), ("season", S), ("season_start_year", L), ("season_end_year", L),
    ("position", S), ("ingest_seq", L),
]
REJECTED_FIELDS = SILVER_FIELDS + [("reject_reason", S)]

#: Raw columns that describe a player rather than a season of one.
_DESCRIPTIVE = ("code", "web_name", "first_name", "second_name", "element_type", "team")
MEASURE_COLUMNS = [n for n, _ in RAW_FIELDS if n not in _DESCRIPTIVE]
_TYPES = dict(RAW_FIELDS)
FACT_FIELDS = [("fact_id", L), ("player_key", L), ("team_key", L), ("season_key", L),
               ("position_key", L)] + [(c, _TYPES[c]) for c in MEASURE_COLUMNS]
DIM_PLAYER_FIELDS = [("player_key", L), ("code", L), ("web_name", S), ("first_name", S),
                     ("second_name", S)]
DIM_TEAM_FIELDS = [("team_key", L), ("team_name", S)]
DIM_SEASON_FIELDS = [("season_key", L), ("season", S), ("start_year", L)]
DIM_POSITION_FIELDS = [("position_key", L), ("position_code", S), ("position_name", S)]

# Star-join projection feeding the feature table (``position_code AS position``).
WIDE_FIELDS = [("code", L), ("web_name", S), ("team_name", S), ("season", S),
               ("start_year", L), ("position", S)] + [
    (c, _TYPES[c]) for c in MEASURE_COLUMNS]

FEATURE_FIELDS = (
    WIDE_FIELDS
    + [(n, D) for n, _ in PER_90]
    + [(n, D) for n in RESIDUAL_FIELDS]
    + [(n, D) for n in VALUE_FIELDS]
    + [(n, D) for n in HISTORY_FIELDS]
    + [("seasons_of_history", L), ("has_previous_season", B), ("has_xg_data", B),
       ("has_xa_data", B)]
)

def struct_of(fields) -> StructType:
    return StructType([StructField(n, t) for n, t in fields])


@dataclass(frozen=True)
class Spec:
    """Run parameters. Defaults equal the reference's constants."""

    min_minutes: int = MIN_MINUTES_FOR_CLUSTERING
    n_clusters: int = DEFAULT_N_CLUSTERS
    top_n: int = DEFAULT_TOP_N
    kmeans_seed: int = KMEANS_SEED
    kmeans_restarts: int = KMEANS_RESTARTS
    position_map: dict = field(default_factory=lambda: dict(POSITION_MAP))
    cluster_features: dict = field(default_factory=lambda: {
        k: list(v) for k, v in CLUSTER_FEATURES_BY_POSITION.items()})
