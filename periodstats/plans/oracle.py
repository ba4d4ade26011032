"""DuckDB SQL oracles: the same results computed from the raw driver tables in plain SQL.

Each oracle is a chain of CTEs that restates a layer independently of the Spark code:
binding -> silver -> gold -> features -> scores. Windows that the Spark side computes in a
distributed way (dense keys, ranks) are plain SQL window functions here.
"""

from __future__ import annotations

from ..spec import (CLUSTER_FEATURES_BY_POSITION, FEATURE_FIELDS, MEASURE_COLUMNS, PER_90,
                    POSITION_MAP, POSITION_ROWS, WIDE_FIELDS)

LAYOUT_CHANGE_YEAR, N_TEAMS = 1998, 25  # stated here on their own, as FIXTURES.md gives them


def _cnt(cond: str) -> str:
    return f"CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT)"


def _dsum(c: str) -> str:
    return f"CAST(sum(CAST({c} AS DECIMAL(18,2))) AS DOUBLE)"


_POS_CASE = "CASE " + " ".join(
    f"WHEN element_type = {k} THEN '{v}'" for k, v in POSITION_MAP.items()) + " END"
_POS_VALUES = ", ".join(f"({k}, '{c}', '{n}')" for k, c, n in POSITION_ROWS)

BINDING = f"""
agg AS (
  SELECT l_suppkey AS code, CAST(year(l_shipdate) AS BIGINT) AS yr, count(*) AS n,
    {_dsum('l_quantity')} AS qty, {_dsum('l_extendedprice')} AS ext,
    {_dsum('l_discount')} AS disc, {_dsum('l_tax')} AS tax,
    CAST(sum(l_linenumber) AS BIGINT) AS bps,
    {_cnt("l_returnflag = 'R'")} AS flag_r, {_cnt("l_returnflag = 'A'")} AS flag_a,
    {_cnt("l_returnflag = 'N'")} AS flag_n, {_cnt("l_linestatus = 'F'")} AS status_f,
    {_cnt("l_linestatus = 'O'")} AS status_o,
    {_cnt('CAST(l_discount AS DECIMAL(18,2)) = 0')} AS disc_zero,
    {_cnt('CAST(l_tax AS DECIMAL(18,2)) = 0')} AS tax_zero,
    {_cnt('l_linenumber = 7')} AS line_seven, {_cnt('l_quantity = 50')} AS qty_fifty,
    {_cnt('l_quantity = 1')} AS qty_one,
    {_cnt('CAST(l_discount AS DECIMAL(18,2)) = 0.10')} AS disc_ten
  FROM lineitem
  WHERE l_shipdate IS NOT NULL
  GROUP BY 1, 2
),
base AS (
  SELECT a.*, s.s_name, s.s_nationkey, nt.n_regionkey
  FROM agg a JOIN supplier s ON a.code = s.s_suppkey
  JOIN nation nt ON s.s_nationkey = nt.n_nationkey
),
p0 AS (
  SELECT code, yr,
    CASE WHEN yr = 2001 AND code % 9 = 1 THEN NULL
         ELSE s_name || '/' || CAST(yr AS VARCHAR) END AS web_name,
    'Supplier' AS first_name, s_name AS second_name,
    CAST(n_regionkey + 1 AS BIGINT) AS element_type,
    CAST((s_nationkey + CASE WHEN yr >= 1999 AND code % 5 = 2 THEN 1 ELSE 0 END + yr)
         % {N_TEAMS} AS BIGINT) AS team,
    CASE WHEN code % 11 = 3 AND yr = 1996 THEN -CAST(qty AS BIGINT)
         WHEN code % 13 = 5 AND yr = 1997 THEN NULL
         ELSE CAST(qty AS BIGINT) END AS minutes,
    CASE WHEN yr >= {LAYOUT_CHANGE_YEAR} THEN CAST(n AS BIGINT) END AS starts,
    flag_r AS goals_scored, flag_a AS assists, status_f AS clean_sheets,
    status_o AS goals_conceded, disc_zero AS own_goals, tax_zero AS yellow_cards,
    line_seven AS red_cards,
    CASE WHEN n_regionkey + 1 = 1 THEN flag_n ELSE CAST(0 AS BIGINT) END AS saves,
    qty_fifty AS penalties_missed, qty_one AS penalties_saved, disc_ten AS bonus, bps,
    ext / 1000.0::DOUBLE AS influence, disc * 10.0::DOUBLE AS creativity,
    tax * 10.0::DOUBLE AS threat,
    (ext / 1000.0::DOUBLE + disc * 10.0::DOUBLE + tax * 10.0::DOUBLE) / 10.0::DOUBLE
      AS ict_index,
    CAST(40 + code % 60 AS BIGINT) AS now_cost,
    100.0::DOUBLE * disc / n AS selected_by_percent,
    CAST(4 * flag_r + 3 * flag_a + status_f AS BIGINT) AS total_points,
    CAST(4 * flag_r + 3 * flag_a + status_f AS BIGINT) / n AS points_per_game,
    CASE WHEN yr >= {LAYOUT_CHANGE_YEAR} THEN tax * 8.0::DOUBLE END AS expected_goals,
    CASE WHEN yr >= {LAYOUT_CHANGE_YEAR} THEN disc * 6.5::DOUBLE END AS expected_assists,
    CASE WHEN yr >= {LAYOUT_CHANGE_YEAR} THEN tax * 8.0::DOUBLE + disc * 6.5::DOUBLE END
      AS expected_goal_involvements,
    CAST(yr AS VARCHAR) AS season
  FROM base
),
seqs AS (SELECT * FROM (VALUES (1), (2)) v(seq)),
raw AS (
  SELECT p0.* REPLACE (
      CASE WHEN seq = 2 THEN minutes + 1 ELSE minutes END AS minutes,
      CASE WHEN seq = 2 THEN goals_scored + 1 ELSE goals_scored END AS goals_scored),
    CAST(seq AS BIGINT) AS ingest_seq
  FROM p0 JOIN seqs ON seq = 1 OR (code % 7 = 0 AND yr = 2000)
),
teams AS (
  SELECT CAST(y.yr AS VARCHAR) AS season,
    CAST((n_nationkey + y.yr) % {N_TEAMS} AS BIGINT) AS team, n_name AS team_name
  FROM nation, (SELECT DISTINCT yr FROM base) y
)"""

_RULES = [
    ("minutes", "minutes >= 0"), ("now_cost", "now_cost > 0"),
    ("position", "position IS NOT NULL"), ("team_name", "team_name IS NOT NULL"),
    ("code", "code IS NOT NULL"),
]
_VALID = " AND ".join(f"coalesce({c}, false)" for _, c in _RULES)
_REASON = "concat_ws(',', " + ", ".join(
    f"CASE WHEN NOT coalesce({c}, false) THEN '{k}' END" for k, c in _RULES) + ")"

SILVER_COLS = ("code, web_name, first_name, second_name, element_type, team, minutes, starts, "
               "goals_scored, assists, clean_sheets, goals_conceded, own_goals, yellow_cards, "
               "red_cards, saves, penalties_missed, penalties_saved, bonus, bps, influence, "
               "creativity, threat, ict_index, now_cost, selected_by_percent, total_points, "
               "points_per_game, expected_goals, expected_assists, expected_goal_involvements, "
               "team_name, season, season_start_year, season_end_year, position, ingest_seq")

SILVER = f"""{BINDING},
conformed AS (
  SELECT r.*, t.team_name,
    CAST(substr(r.season, 1, 4) AS BIGINT) AS season_start_year,
    CAST(substr(r.season, 1, 4) AS BIGINT) + 1 AS season_end_year,
    {_POS_CASE} AS position
  FROM raw r LEFT JOIN teams t ON r.season = t.season AND r.team = t.team
),
status AS (
  SELECT {SILVER_COLS}, {_VALID} AS is_valid, {_REASON} AS reject_reason FROM conformed
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY code, season ORDER BY ingest_seq) AS rn
  FROM status WHERE is_valid
),
clean AS (SELECT {SILVER_COLS} FROM ranked WHERE rn = 1),
rejected AS (
  SELECT {SILVER_COLS}, reject_reason FROM status WHERE NOT is_valid
  UNION ALL
  SELECT {SILVER_COLS}, 'duplicate' AS reject_reason FROM ranked WHERE rn > 1
)"""

_MEASURES = ", ".join(MEASURE_COLUMNS)
_FACT_MEASURES = ", ".join(f"c.{m}" for m in MEASURE_COLUMNS)

GOLD = f"""{SILVER},
dim_position AS (
  SELECT CAST(k AS BIGINT) AS position_key, c AS position_code, nm AS position_name
  FROM (VALUES {_POS_VALUES}) v(k, c, nm)
),
dim_season AS (
  SELECT CAST(row_number() OVER (ORDER BY season) AS BIGINT) AS season_key, season,
    CAST(substr(season, 1, 4) AS BIGINT) AS start_year
  FROM (SELECT DISTINCT season FROM clean)
),
dim_team AS (
  SELECT CAST(row_number() OVER (ORDER BY team_name) AS BIGINT) AS team_key, team_name
  FROM (SELECT DISTINCT team_name FROM clean WHERE team_name IS NOT NULL)
),
latest AS (
  SELECT code,
    arg_max(web_name, season) FILTER (WHERE web_name IS NOT NULL) AS web_name,
    arg_max(first_name, season) FILTER (WHERE first_name IS NOT NULL) AS first_name,
    arg_max(second_name, season) FILTER (WHERE second_name IS NOT NULL) AS second_name
  FROM clean GROUP BY code
),
dim_player AS (
  SELECT CAST(row_number() OVER (ORDER BY code) AS BIGINT) AS player_key, code, web_name,
    first_name, second_name
  FROM latest
),
fact AS (
  SELECT CAST(row_number() OVER (ORDER BY c.season, c.ingest_seq, c.code) AS BIGINT) AS fact_id,
    p.player_key, t.team_key, s.season_key, pos.position_key, {_FACT_MEASURES}
  FROM clean c
  LEFT JOIN dim_player p ON c.code = p.code
  LEFT JOIN dim_team t ON c.team_name = t.team_name
  LEFT JOIN dim_season s ON c.season = s.season
  LEFT JOIN dim_position pos ON c.position = pos.position_code
)"""

_WIDE_SELECT = ", ".join(
    ["p.code", "p.web_name", "t.team_name", "s.season", "s.start_year",
     "pos.position_code AS position"] + [f"f.{m}" for m in MEASURE_COLUMNS])

WIDE = f"""{GOLD},
wide AS (
  SELECT {_WIDE_SELECT}, f.player_key
  FROM fact f
  JOIN dim_player p ON f.player_key = p.player_key
  JOIN dim_team t ON f.team_key = t.team_key
  JOIN dim_season s ON f.season_key = s.season_key
  JOIN dim_position pos ON f.position_key = pos.position_key
)"""

_N90 = "(CASE WHEN minutes <> 0 THEN minutes END / 90.0::DOUBLE)"
_PER90 = ",\n    ".join(f"({' + '.join(nums)}) / {_N90} AS {name}" for name, nums in PER_90)
_H = "OVER (PARTITION BY code ORDER BY start_year)"
_HX = ("OVER (PARTITION BY code ORDER BY start_year "
       "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
FEATURE_COLS = ", ".join(n for n, _ in FEATURE_FIELDS)

FEATURES = f"""{WIDE},
f1 AS (
  SELECT *,
    {_PER90},
    goals_scored - expected_goals AS goals_minus_xg,
    assists - expected_assists AS assists_minus_xa,
    goals_scored + assists - expected_goal_involvements AS goal_involvements_minus_xgi,
    (goals_scored - expected_goals) / {_N90} AS goals_minus_xg_per_90,
    (assists - expected_assists) / {_N90} AS assists_minus_xa_per_90,
    (goals_scored + assists - expected_goal_involvements) / {_N90}
      AS goal_involvements_minus_xgi_per_90,
    now_cost / 10.0::DOUBLE AS cost_millions,
    total_points / (CASE WHEN now_cost / 10.0::DOUBLE <> 0 THEN now_cost / 10.0::DOUBLE END)
      AS points_per_million
  FROM wide
),
f2 AS (
  SELECT *,
    lag(points_per_game) {_H} AS points_per_game_prev_season,
    lag(points_per_90) {_H} AS points_per_90_prev_season,
    stddev_samp(points_per_game) {_HX} AS points_consistency_std,
    count(goals_per_90) {_HX} AS x_goals,
    count(assists_per_90) {_HX} AS x_assists,
    CAST(row_number() {_H} AS BIGINT) AS seasons_of_history
  FROM f1
),
features AS (
  SELECT *,
    points_per_game - points_per_game_prev_season AS points_per_game_yoy_change,
    points_per_90 - points_per_90_prev_season AS points_per_90_yoy_change,
    CASE WHEN x_goals >= 2 THEN regr_slope(goals_per_90, x_goals) {_HX} END
      AS goals_per_90_trend_slope,
    CASE WHEN x_assists >= 2 THEN regr_slope(assists_per_90, x_assists) {_HX} END
      AS assists_per_90_trend_slope,
    seasons_of_history >= 2 AS has_previous_season,
    expected_goals IS NOT NULL AS has_xg_data,
    expected_assists IS NOT NULL AS has_xa_data
  FROM f2
)"""


def _z(src: str, pop: str) -> str:
    return (f"CASE WHEN coalesce(min({src}) OVER w = max({src}) OVER w, true) THEN 0.0::DOUBLE "
            f"ELSE ({src} - avg({src}) OVER w) / stddev_pop({src}) OVER w END")


def scores(season: str, min_minutes: int) -> str:
    return f"""{FEATURES},
cohort AS (
  SELECT * FROM features WHERE season = '{season}' AND minutes >= {min_minutes}
),
z AS (
  SELECT *,
    {_z('points_per_million', 'x')} AS points_per_million_zscore,
    {_z('selected_by_percent', 'x')} AS ownership_zscore,
    CASE WHEN goals_minus_xg_per_90 IS NOT NULL THEN {_z('goals_minus_xg_per_90', 'x')} END
      AS goals_minus_xg_zscore,
    CASE WHEN assists_minus_xa_per_90 IS NOT NULL THEN {_z('assists_minus_xa_per_90', 'x')} END
      AS assists_minus_xa_zscore
  FROM cohort
  WINDOW w AS (PARTITION BY season, position)
),
s1 AS (
  SELECT *, points_per_million_zscore - ownership_zscore AS hidden_gem_score,
    CASE WHEN goals_minus_xg_per_90 IS NOT NULL AND assists_minus_xa_per_90 IS NOT NULL
      THEN goals_minus_xg_zscore + assists_minus_xa_zscore END AS overperformance_score
  FROM z
),
scored AS (
  SELECT *,
    CASE WHEN goals_minus_xg_per_90 IS NOT NULL AND assists_minus_xa_per_90 IS NOT NULL
      THEN 0.7::DOUBLE * hidden_gem_score + 0.3::DOUBLE * overperformance_score
      ELSE hidden_gem_score END AS discovery_score
  FROM s1
)"""


def with_ctes(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


CLUSTER_FEATURES = CLUSTER_FEATURES_BY_POSITION
WIDE_COLS = ", ".join(n for n, _ in WIDE_FIELDS)
