"""A small hand-written league: movers, gaps, a tie on points, a player without minutes.

Two file layouts: the older season lacks ``starts`` and the xG columns. Raw club id 1 names
another club in each season.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from periodstats.spec import RAW_FIELDS

OLD, NEW = SEASONS = ["2019-20", "2023-24"]
CLUBS = {OLD: {1: "Ashford", 2: "Brackley", 7: "Corby"},
         NEW: {1: "Corby", 2: "Brackley", 5: "Ashford"}}

# season, code, name, position, club, minutes, goals, assists, points, cost, owned (file order)
LEAGUE = """
2019-20  401  Abara    1  1  2700   0   0  120  45   8.5
2019-20  403  Castell  2  1  1800   2   1   96  48   4.0
2019-20  404  Drago    2  2   900   0   2   40  42   1.2
2019-20  406  Fonta    3  7  1350   6   3  101  66  12.0
2019-20  407  Gysin    3  2  3000   4  11  140  70   9.9
2019-20  410  Jarvo    4  7  1980  11   2  150  88  25.0
2019-20  412  Lind     4  1    90   0   0    4  50   0.1
2023-24  401  Abara    1  5  2700   0   1  130  50  11.0
2023-24  402  Brandt   1  2     0   0   0    0  40   0.3
2023-24  403  Castell  2  1  2250   1   4  110  52   6.1
2023-24  405  Ellery   2  2  1000   3   0   80  44   2.5
2023-24  406  Fonta    3  1  2430   9   6  160  78  21.5
2023-24  407  Gysin    3  2  2880   4   8  160  72   9.4
2023-24  408  Hale     3  5  1080   1   1   55  47   0.8
2023-24  409  Ivo      3  5  1620   5   2   90  55   3.3
2023-24  410  Jarvo    4  1   450   1   0   18  80   2.0
2023-24  411  Kestrel  4  2  2520  14   3  171  95  30.2
"""

# code, name, minutes, then per 90: goals, assists, creativity, threat, influence; points per
# million, owned, goals minus xG, assists minus xA (three styles; one row a minute short of the
# cohort, one exactly on its edge, one without residuals)
MIDFIELD = """
51  Finch  2100  0.62  0.20  2.0  6.0  3.0  24.0  18.0   0.10   0.02
52  Frost  1900  0.58  0.22  2.2  5.6  3.2  22.5  14.0   0.06   0.00
53  Flint  1500  0.66  0.18  1.9  6.3  2.9  26.0   9.0   0.14  -0.01
61  Crane  2600  0.12  0.48  6.1  2.1  3.1  20.0   7.5  -0.02   0.09
62  Crisp  1000  0.10  0.52  6.4  2.0  3.3  29.0   0.6  -0.01   0.12
63  Croft  1700  0.15  0.44  5.8  2.3  2.8  18.0   5.0   0.00   0.05
71  Wren   3100  0.05  0.08  1.2  1.0  7.0  15.0   3.0  -0.03  -0.02
72  Wills   999  0.04  0.06  1.0  0.9  7.4  31.0   0.2  -0.05  -0.04
73  Wade   2800  0.06  0.10  1.4  1.1  6.8  14.0   2.5  -0.04  -0.03
74  Wolfe  1200  0.05  0.07  1.1  1.2  7.2  16.0   1.0   -      -
"""
FINISHERS, CREATORS, WORKERS = {51, 52, 53}, {61, 62, 63}, {71, 73, 74}


def _table(text: str) -> list[list[str]]:
    return [line.split() for line in text.strip().splitlines()]


def raw_rows(season: str) -> list[dict]:
    """The season's raw file rows; columns outside the table follow from minutes and goals."""
    out = []
    for s, code, name, pos, club, *nums in _table(LEAGUE):
        if s != season:
            continue
        minutes, goals, assists, points, cost = map(int, nums[:5])
        games, back = minutes // 90, int(pos) <= 2
        row = dict.fromkeys([c for c, _ in RAW_FIELDS], 0) | {
            "code": int(code), "web_name": name, "first_name": name[0], "second_name": name,
            "element_type": int(pos), "team": int(club), "minutes": minutes, "starts": games,
            "goals_scored": goals, "assists": assists, "total_points": points, "now_cost": cost,
            "clean_sheets": games // 3 if back else 0, "goals_conceded": games if back else 0,
            "saves": 3 * games if pos == "1" else 0, "bps": 2 * points, "bonus": goals,
            "influence": minutes / 8, "creativity": 16.0 * assists, "threat": 32.0 * goals,
            "ict_index": minutes / 64 + goals, "selected_by_percent": float(nums[5]),
            "points_per_game": round(points / games, 1) if games else 0.0,
            "expected_goals": goals / 2 + 0.25, "expected_assists": assists / 2,
            "expected_goal_involvements": (goals + assists) / 2 + 0.25}
        if season == OLD:
            row = {c: v for c, v in row.items() if c != "starts" and "expected" not in c}
        out.append(row)
    return out


def players_frame(spark, season: str, rows: list[dict]):
    """One season's raw frame with only the columns present in ``rows`` (its own layout)."""
    types = dict(RAW_FIELDS)
    cols = [c for c, _ in RAW_FIELDS if c in rows[0]]
    schema = ", ".join(f"{c} {types[c].simpleString()}" for c in cols)
    data = [tuple(r[c] for c in cols) for r in rows]
    df = spark.createDataFrame(data, schema)
    seq = F.monotonically_increasing_id() + 1  # file order of a one-partition frame
    return df.coalesce(1).withColumns({"season": F.lit(season), "ingest_seq": seq})


def teams_frame(spark, names_by_season: dict[str, dict[int, str]]):
    rows = [(s, k, n) for s, m in names_by_season.items() for k, n in m.items()]
    return spark.createDataFrame(rows, "season string, id bigint, name string")


def season_frames(spark):
    return [players_frame(spark, s, raw_rows(s)) for s in SEASONS], teams_frame(spark, CLUBS)


def feature_rows(spark, position: str = "MID"):
    names = ["goals_per_90", "assists_per_90", "creativity_per_90", "threat_per_90",
             "influence_per_90", "points_per_million", "selected_by_percent",
             "goals_minus_xg_per_90", "assists_minus_xa_per_90"]
    flat = ["cost_millions", "clean_sheets_per_90", "goals_conceded_per_90", "saves_per_90",
            "bps_per_90"]
    data = [(int(code), name, NEW, "Corby", position, int(minutes), 70,
             *[None if v == "-" else float(v) for v in vals], *[4.0] * len(flat))
            for code, name, minutes, *vals in _table(MIDFIELD)]
    return spark.createDataFrame(
        data, "code bigint, web_name string, season string, team_name string, position string, "
              "minutes bigint, total_points bigint, "
              + ", ".join(f"{c} double" for c in names + flat))
