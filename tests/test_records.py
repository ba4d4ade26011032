"""Bytes, records that span lines and blocks, digests, and publishing by pointer."""

from __future__ import annotations

import csv
import os
import random

import pytest
from pyspark.sql import functions as F

from periodstats.operators import conform
from periodstats.session import as_local_path, scratch_path
from periodstats.sources import landing, records, versions


@pytest.fixture()
def small_blocks(spark):
    """Files are cut into blocks of a few dozen bytes."""
    keys = {"spark.sql.files.maxPartitionBytes": "37", "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def write(root, name, content):
    path = os.path.join(as_local_path(root), name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(content)


def random_file(rng):
    """Lines of fields with quotes where they belong and where they do not."""
    if rng.random() < 0.5:  # as a CSV writer makes it
        fields = ["a", "", "x,y", 'say "hi"', "two\nlines", "end\r\n", "é", '"', "\n\n", ",\n,\""]
        rows = [[rng.choice(fields) for _ in range(3)] for _ in range(rng.randint(1, 12))]
        eol = rng.choice(["\n", "\r\n"])
        text = "".join(",".join('"' + f.replace('"', '""') + '"' if set(f) & set('",\n\r') else f
                                for f in row) + eol for row in rows)
    else:
        text = "".join(rng.choices(["a", "b", '"', '""', ",", "\n", "\r\n", '"\n', 'x"y'], k=60))
        text = "a" + text
    raw = text.encode()
    if rng.random() < 0.3:
        raw = records.BOM + raw
    return raw.rstrip(b"\r\n") if rng.random() < 0.4 else raw


def parsed(raw):
    """First line and text of each record, by the csv module's count of lines."""
    text = raw.removeprefix(records.BOM).decode()
    lines = text.split("\n")
    if lines[-1] == "":
        lines.pop()
    ended = [x + "\n" for x in lines]
    reader, out, at = csv.reader(ended), [], 0
    for _ in reader:
        record = "\n".join(lines[at:reader.line_num])
        out.append((at, record.removesuffix("\r")))
        at = reader.line_num
    return out


def test_records_over_lines_and_blocks_are_those_of_a_csv_parser(spark, small_blocks):
    rng, root, files = random.Random(4), scratch_path(spark, "t-records"), {}
    for i in range(120):
        files[f"f{i}.csv"] = random_file(rng)
        write(root, f"f{i}.csv", files[f"f{i}.csv"])
    lines = records.lines_of(spark, [root])
    blocks = records.blocks_of(lines).cache()
    assert blocks.groupBy("path").count().agg(F.max("count")).first()[0] > 4
    placed = records.placed(lines, blocks)
    got = {}
    for r in records.records_of(placed, ["path"]).collect():
        got.setdefault(os.path.basename(r.path), []).append((r.line_no, r.record))
    assert {n: sorted(v) for n, v in got.items()} == {n: parsed(raw) for n, raw in files.items()}


def polynomial(raw):
    out = []
    for base in records.BASES:
        value = 0
        for byte in reversed(raw):
            value = (value * base + byte + 1) % records.P
        out.append(value)
    return f"{out[0]:08x}{out[1]:08x}"


def test_landed_bytes_rebuild_each_file_and_carry_its_digest(spark, small_blocks):
    raw, bronze = scratch_path(spark, "t-raw"), scratch_path(spark, "t-bronze")
    rng = random.Random(8)
    files = {"S1/players_raw.csv": records.BOM + b'code,web_name\r\n1,"a\r\nb"\r\n2,c',
             "S1/teams.csv": b"id,name\n1,x\n\n",
             "S2/players_raw.csv": b"code,web_name\n" + "9,Ø 中\n".encode() * 30,
             "S2/teams.csv": b"id,name\r\n" + bytes(rng.choices(range(1, 256), k=300)) + b"\n"}
    for name, content in files.items():
        write(raw, name, content)
    landing.land(spark, raw, bronze, ["S1", "S2"])
    rows = landing.file_bytes(spark, bronze).orderBy("path", "line_no").collect()
    back = {}
    for r in rows:
        key = f"{r.season}/{r.file}"
        back[key] = back.get(key, b"") + bytes(r.content)
    assert back == files
    for r in landing.read_files(spark, bronze).collect():
        content = files[f"{r.season}/{r.file}"]
        assert (r.length, r.landed_length) == (len(content), len(content))
        assert r.source_digest == r.landed_digest == polynomial(content)


def test_line_breaks_in_quotes_crlf_and_a_last_line_without_end(spark, small_blocks):
    raw, bronze = scratch_path(spark, "t-raw"), scratch_path(spark, "t-bronze")
    name = "Long, " * 20 + '"Nick"\nName'
    body = ('code,web_name,minutes\r\n1,"' + name.replace('"', '""') + '",900\r\n'
            '2,Plain,5"\r\n\r\n3,"x\r\ny",1200')
    write(raw, "S1/players_raw.csv", body.encode())
    write(raw, "S1/teams.csv", b"id,name\n1,x\n")
    landing.land(spark, raw, bronze, ["S1"])
    rows = {r.code: (r.web_name, r.minutes)
            for r in landing.bronze_rows(spark, bronze).orderBy("ingest_seq").collect()}
    assert rows == {"1": (name, "900"), "2": ("Plain", '5"'), "3": ("x\r\ny", "1200")}
    files = {r.file: r.data_lines for r in landing.read_files(spark, bronze).collect()}
    assert files == {"players_raw.csv": 3, "teams.csv": 1}  # records, not lines
    whole = conform.union_seasons([landing.bronze_rows(spark, bronze)])
    assert {r.code: r.minutes for r in whole.collect()} == {1: 900, 2: None, 3: 1200}


def test_a_file_that_ends_inside_quotes_is_landed_but_not_parsed(spark):
    raw, bronze = scratch_path(spark, "t-raw"), scratch_path(spark, "t-bronze")
    write(raw, "S1/players_raw.csv", b'code,web_name\n1,"open\n2,b\n')
    write(raw, "S1/teams.csv", b"id,name\n1,x\n")
    landing.land(spark, raw, bronze, ["S1"])
    assert landing.read_lines(spark, bronze).where("file = 'players_raw.csv'").count() == 3
    with pytest.raises(ValueError, match="inside a quoted field"):
        landing.bronze_rows(spark, bronze)


@pytest.mark.parametrize("dies_at", ["blocks", "files", "pointer"])
def test_a_landing_that_dies_leaves_the_old_one_whole(spark, monkeypatch, dies_at):
    raw, bronze = scratch_path(spark, "t-raw"), scratch_path(spark, "t-bronze")
    for s in ("S1", "S2"):
        write(raw, f"{s}/players_raw.csv", b"code,minutes\n1,10\n2,20\n")
        write(raw, f"{s}/teams.csv", b"id,name\n1,x\n")
    landing.land(spark, raw, bronze, ["S1", "S2"])
    write(raw, "S2/players_raw.csv", b"code,minutes\n7,70\n")

    def die(*_, **__):
        raise RuntimeError("lost")
    if dies_at == "pointer":
        monkeypatch.setattr(versions.Layer, "publish", die)
    else:
        path = versions.Layer.write_path
        monkeypatch.setattr(versions.Layer, "write_path", lambda self, table, version:
                            die() if table == dies_at else path(self, table, version))
    with pytest.raises(RuntimeError, match="lost"):
        landing.land(spark, raw, bronze, ["S2"])
    monkeypatch.undo()

    def codes():
        return sorted((r.season, r.code) for r in landing.bronze_rows(spark, bronze).collect())
    assert codes() == [("S1", "1"), ("S1", "2"), ("S2", "1"), ("S2", "2")]
    landing.land(spark, raw, bronze, ["S2"])
    assert codes() == [("S1", "1"), ("S1", "2"), ("S2", "7")]


def test_of_two_writers_one_fails(spark):
    layer = versions.Layer(spark, scratch_path(spark, "t-layer"))
    assert layer.current() == (0, {})
    with pytest.raises(FileNotFoundError):
        layer.read("t", landing.FILES)
    assert layer.publish({"a": "1", "b": "1"}, after=0) == 1
    with pytest.raises(versions.PublishConflict):
        layer.publish({"a": "2"}, after=0)
    assert layer.publish({"b": "3"}, after=1) == 2 and layer.current() == (2, {"a": "1", "b": "3"})


def test_scratch_is_cleared_on_demand(spark, monkeypatch):
    from periodstats import session
    monkeypatch.setattr(session, "_MADE", {})  # paths of other tests stay
    path = session.scratch_path(spark, "t-clear")
    spark.range(3).write.parquet(path)
    unused = session.scratch_path(spark, "t-clear")
    assert os.path.exists(as_local_path(path)) and not os.path.exists(as_local_path(unused))
    assert session.clear_scratch(spark) == 1 and session.clear_scratch(spark) == 0
    assert not os.path.exists(as_local_path(path))
