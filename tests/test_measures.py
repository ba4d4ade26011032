"""BI measures on hand-made rows: ratio of sums, ties, calendar gaps, arg-max tie-break."""

from __future__ import annotations

from periodstats.operators import measures


def _rows(spark):
    data = [  # fact_id, season, start_year, code, web_name, position, goals, minutes, points, cost
        (1, "2019-20", 2019, 1, "A", "MID", 3, 900, 50, 50),
        (2, "2019-20", 2019, 2, "B", "MID", 1, 1800, 50, 100),
        (3, "2019-20", 2019, 3, "C", "FWD", 0, 0, 20, 40),
        (4, "2021-22", 2021, 1, "A", "MID", 5, 1000, 80, 80),
        (5, "2021-22", 2021, 2, "B", "MID", 5, 1000, 40, 40),
    ]
    rows = spark.createDataFrame(data, "fact_id bigint, season string, start_year bigint, "
                                       "code bigint, web_name string, position string, "
                                       "goals_scored bigint, minutes bigint, "
                                       "total_points bigint, now_cost bigint")
    return rows.drop("web_name").withColumnRenamed("code", "player_key")


def _players(spark):
    return spark.createDataFrame([(1, 1, "A"), (2, 2, "B"), (3, 3, "C")],
                                 "player_key bigint, code bigint, web_name string")


def test_goals_per_90_is_ratio_of_sums_and_zero_when_undefined(spark):
    got = {(r.season, r.position): r.goals_per_90 for r in
           measures.goals_per_90(_rows(spark), by=("season", "position")).collect()}
    assert abs(got[("2019-20", "MID")] - 4 / (2700 / 90)) < 1e-12
    assert got[("2019-20", "FWD")] == 0.0


def test_season_over_season_uses_previous_calendar_season(spark):
    got = {r.season: (r.previous_season_points, r.points_change) for r in
           measures.season_over_season(_rows(spark)).collect()}
    assert got == {"2019-20": (None, 120), "2021-22": (None, 120)}  # 2020-21 is missing


def test_value_rank_ties_share_rank_with_gaps(spark):
    got = {r.fact_id: r.value_rank for r in measures.value_rank(_rows(spark)).collect()}
    # 2019-20 values: A 10.0, B 5.0, C 5.0 -> 1, 2, 2 ; 2021-22: A 10.0, B 10.0 -> 1, 1
    assert got == {1: 1, 2: 2, 3: 2, 4: 1, 5: 1}


def test_top_scorer_row_first_fact_wins_tie(spark):
    got = {r.season: (r.web_name, r.total_points) for r in
           measures.top_scorer_row(_rows(spark), _players(spark)).collect()}
    assert got == {"2019-20": ("A", 50), "2021-22": ("A", 80)}


def test_season_leaders_keep_ties(spark):
    got = sorted((r.season, r.code) for r in measures.season_leaders(_rows(spark), _players(spark)).collect())
    assert got == [("2019-20", 1), ("2021-22", 1), ("2021-22", 2)]


def test_measures_under_slicers(spark):
    rows, players = _rows(spark), _players(spark)
    got = {(r.season, r.position): r.web_name
           for r in measures.top_scorer_row(rows, players, ("season", "position")).collect()}
    assert got == {("2019-20", "MID"): "A", ("2019-20", "FWD"): "C", ("2021-22", "MID"): "A"}
    got = {(r.season, r.position, r.points_change)
           for r in measures.season_over_season(rows, by=("position",)).collect()}
    assert got == {("2019-20", "MID", 100), ("2019-20", "FWD", 20), ("2021-22", "MID", 120)}
    got = {r.fact_id: r.value_rank for r in measures.value_rank(rows, ("season", "position")).collect()}
    assert got == {1: 1, 2: 2, 3: 1, 4: 1, 5: 1}


def test_cube_equals_each_level_by_itself(spark):
    import random
    rng = random.Random(2)
    facts = [(rng.randrange(1, 4), rng.randrange(1, 4), rng.choice([1, 2, 2, 2, 2, 3]), rng.randrange(9),
              rng.randrange(0, 200, 40), rng.randrange(90)) for _ in range(120)]
    facts = [f for f in facts if f[0] != 2 or f[1] != 2]  # a group without a season before
    years = {1: ("2018-19", 2018), 2: ("2019-20", 2019), 3: ("2021-22", 2021)}
    fact = spark.createDataFrame(facts, "season_key bigint, position_key bigint, team_key bigint, "
                                        "goals_scored bigint, minutes bigint, total_points bigint")
    got = measures.cube(
        fact, spark.createDataFrame([(k, *v) for k, v in years.items()],
                                    "season_key bigint, season string, start_year bigint"),
        spark.createDataFrame([(k, f"P{k}", "x") for k in (1, 2, 3)],
                              "position_key bigint, position_code string, position_name string"),
        spark.createDataFrame([(k, f"T{k}") for k in (1, 2, 3)], "team_key bigint, team_name string"))
    want = set()
    for s in (None, 1, 2, 3):
        for p in (None, 1, 2, 3):
            for t in (None, 1, 2, 3):
                def rows_of(s, p=p, t=t):
                    return [f for f in facts if s in (None, f[0]) and p in (None, f[1]) and t in (None, f[2])]
                rows = rows_of(s)
                if not rows:
                    continue
                goals, minutes = sum(f[3] for f in rows), sum(f[4] for f in rows)
                points = sum(f[5] for f in rows)
                last = [k for k, (_, y) in years.items() if s and y == years[s][1] - 1]
                change = points - sum(f[5] for k in last for f in rows_of(k)) if s else None
                want.add((s and years[s][0], p and f"P{p}", t and f"T{t}", goals, points,
                          round(goals / (minutes / 90) if minutes else 0.0, 9),
                          max(f[5] for f in facts if s in (None, f[0])), change))
    assert {(*r[:5], round(r[5], 9), *r[6:]) for r in got.collect()} == want
