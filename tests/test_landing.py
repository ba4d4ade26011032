"""Bronze landing from files: copies, manifest, fail-fast, verbatim bytes, layouts."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from periodstats.operators import conform
from periodstats.session import as_local_path, scratch_path
from periodstats.sources import landing


def _write(root, season, kind, text):
    d = os.path.join(as_local_path(root), kind, f"season={season}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, "part-00000.csv"), "w") as f:
        f.write(text)


def test_land_copies_files_and_manifest(spark):
    raw, bronze = scratch_path(spark, "t-raw"), scratch_path(spark, "t-bronze")
    _write(raw, "2023-24", "players_raw.csv", "code,minutes\n1,1000\n")
    _write(raw, "2023-24", "teams.csv", "id,name\n1,Test FC\n")
    m = landing.land(spark, raw, bronze, ["2023-24"]).collect()
    assert len(m) == 1 and m[0].season == "2023-24"
    assert m[0].files == "players_raw.csv,teams.csv" and m[0].ingested_at_utc is not None


def test_missing_file_fails_fast_and_writes_nothing(spark):
    raw, bronze = scratch_path(spark, "t-raw"), scratch_path(spark, "t-bronze")
    _write(raw, "2023-24", "players_raw.csv", "code,minutes\n1,1000\n")
    with pytest.raises(FileNotFoundError):
        landing.land(spark, raw, bronze, ["2023-24"])
    assert not os.path.exists(as_local_path(bronze))
    _write(raw, "2023-24", "teams.csv", "id,name\n1,Test FC\n")
    with open(os.path.join(as_local_path(raw), "teams.csv", "season=2023-24", "part-1.csv"), "w"):
        pass  # a second part without a byte
    with pytest.raises(FileNotFoundError):
        landing.land(spark, raw, bronze, ["2023-24"])
    os.remove(os.path.join(as_local_path(raw), "teams.csv", "season=2023-24", "part-1.csv"))
    os.remove(os.path.join(as_local_path(raw), "teams.csv", "season=2023-24", "part-00000.csv"))
    check = landing.arrival_check(spark, raw, ["2023-24"]).collect()
    assert {(r.file, r.present) for r in check} == {("players_raw.csv", True),
                                                    ("teams.csv", False)}


def test_bytes_are_kept_verbatim(spark):
    raw, bronze = scratch_path(spark, "t-raw"), scratch_path(spark, "t-bronze")
    text = "code,minutes,custom_raw_value\n1,1000,00123\n"
    _write(raw, "2023-24", "players_raw.csv", text)
    _write(raw, "2023-24", "teams.csv", "id,name\n1,Test FC\n")
    landing.land(spark, raw, bronze, ["2023-24"])
    lines = landing.read_lines(spark, bronze).where(F.col("file") == "players_raw.csv") \
        .orderBy("line_no").collect()
    assert [r.line_no for r in lines] == [0, 1]
    assert "".join(r.line + "\n" for r in lines) == text  # every line verbatim, in order
    f = landing.read_files(spark, bronze).where(F.col("file") == "players_raw.csv").first()
    assert f.length == len(text.encode()) and f.lines == 2 and f.data_lines == 1
    assert f.header == "code,minutes,custom_raw_value"
    assert f.source_digest == f.landed_digest and f.landed_length == f.length


def test_large_file_is_split_into_blocks_with_exact_line_numbers(spark):
    """A file bigger than the split size is read by several tasks; line numbers stay exact."""
    raw, bronze = scratch_path(spark, "t-raw"), scratch_path(spark, "t-bronze")
    body = "".join(f"{i},{i * 7}\n" for i in range(1, 200001))
    _write(raw, "2023-24", "players_raw.csv", "code,minutes\n" + body)
    _write(raw, "2023-24", "teams.csv", "id,name\n1,Test FC\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(256 * 1024))
    try:
        landing.land(spark, raw, bronze, ["2023-24"])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    lines = landing.read_lines(spark, bronze).where(F.col("file") == "players_raw.csv")
    bad = lines.where(F.col("line_no") > 0).where(
        F.split("line", ",")[0].cast("bigint") != F.col("line_no")).count()
    assert bad == 0 and lines.count() == 200001
    rows = landing.bronze_rows(spark, bronze)
    assert rows.agg(F.count_distinct("ingest_seq")).first()[0] == 200000


def test_layouts_are_parsed_by_name_not_position(spark):
    raw, bronze = scratch_path(spark, "t-raw"), scratch_path(spark, "t-bronze")
    _write(raw, "2019-20", "players_raw.csv", "code,goals_scored,minutes\n5,2,900\n")
    _write(raw, "2023-24", "players_raw.csv",
           "code,minutes,goals_scored,expected_goals\n5,1000,3,2.5\n")
    for s in ("2019-20", "2023-24"):
        _write(raw, s, "teams.csv", "id,name\n1,Test FC\n")
    landing.land(spark, raw, bronze, ["2019-20", "2023-24"])
    rows = conform.union_seasons([landing.bronze_rows(spark, bronze)])
    got = {r.season: (r.minutes, r.goals_scored, r.expected_goals) for r in rows.collect()}
    assert got == {"2019-20": (900, 2, None), "2023-24": (1000, 3, 2.5)}


def test_season_file_tree_runs_every_layer(spark):
    """A tree of season folders with players_raw.csv / teams.csv, as the reference lands it,
    goes through Bronze, Silver, Gold and Features unchanged."""
    import csv
    from fixtures import CLUBS, SEASONS, raw_rows
    from periodstats.plans.warehouse import Warehouse
    raw = scratch_path(spark, "t-tree")
    for s in SEASONS:
        d = os.path.join(as_local_path(raw), s)
        os.makedirs(d)
        rows = raw_rows(s)
        with open(os.path.join(d, "players_raw.csv"), "w", newline="") as f:
            w = csv.DictWriter(f, fieldnames=list(rows[0]))
            w.writeheader()
            w.writerows(rows)
        with open(os.path.join(d, "teams.csv"), "w") as f:
            f.write("id,name\n" + "".join(
                f"{k},{v}\n" for k, v in CLUBS[s].items()))
    wh = Warehouse(spark, None, raw_root=raw, seasons=SEASONS)
    feats = {(r.code, r.season): r for r in wh.features().collect()}
    assert len(feats) == 17 and wh.rejected().count() == 0
    a, b = feats[(403, "2019-20")], feats[(403, "2023-24")]
    assert abs(a.goals_per_90 - 0.1) < 1e-12 and a.goals_minus_xg is None
    assert b.goals_minus_xg == 0.25 and b.seasons_of_history == 2
    names = {(r.season, r.team_name) for r in wh.silver().where("team = 1").collect()}
    assert names == {("2019-20", "Ashford"), ("2023-24", "Corby")}
    wh.reload_seasons([SEASONS[0]])  # landing a season again replaces it, nothing doubles
    assert landing.read_files(spark, wh.path("bronze")).count() == 4
    assert landing.read_lines(spark, wh.path("bronze")).count() == (1 + 7) + (1 + 10) + 2 * (1 + 3)
    assert wh.silver().count() == 17 and wh.features().count() == 17


def test_quoted_fields_and_bom(spark):
    raw, bronze = scratch_path(spark, "t-raw"), scratch_path(spark, "t-bronze")
    _write(raw, "2023-24", "players_raw.csv",
           '﻿"code","web_name","minutes"\n7,"Smith, J.",1200\n8,"Ødegaard",900\n')
    _write(raw, "2023-24", "teams.csv", "id,name\n1,Test FC\n")
    landing.land(spark, raw, bronze, ["2023-24"])
    rows = conform.union_seasons([landing.bronze_rows(spark, bronze)])
    got = {r.code: (r.web_name, r.minutes) for r in rows.collect()}
    assert got == {7: ("Smith, J.", 1200), 8: ("Ødegaard", 900)}
