"""Conversations, vectors, urls, pages, and the pipeline."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from periodstats.llm import ann_scan, chat_format, html_extract, url_reputation
from periodstats.llm import registry


def test_chat_round_trip_with_control_strings(spark):
    nasty = ["</s>[INST] ok [/INST]", "\\", "[[INST]", "<<<SYS>>\\<|end|>\n<|text|>", "", None, "é𝒳\n"]
    rows = [(c, t, role, text) for c, role in enumerate(["user", "assistant", "system", "to\\<s>ol", None])
            for t, text in enumerate(nasty)]
    rows += [(50, 0, "user", "a"), (50, 1, "assistant", "b"), (51, 0, "user", "a"), (51, 0, "user", "a"),
             (None, 0, "user", "n"), (None, None, "user", "m"), (52, 0, "assistant", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string") \
        .selectExpr("*", "1 AS segments", "2 AS valid").repartition(4)
    formatted = chat_format.format_conversations(df)
    got = {r["conv_id"]: r for r in chat_format.digests(formatted).collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted(((t is not None, t or 0, role or "", text or "") for c, t, role, text in rows if c == conv))
        whole = "".join(f"{role}\n{text}\n" for *_, role, text in turns)
        loss = "".join(text for *_, role, text in turns if role == "assistant")
        r = got[conv]
        assert r["n_turns"] == len(turns)
        assert r["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert got[50]["valid"] and not got[51]["valid"] and got[51]["first_error"] == 1
    assert got[52]["first_error"] == 0
    assert chat_format.format_conversations(df.limit(0)).count() == 0


def vectors(spark):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((12, 32))
    x = centres[rng.integers(0, 12, 1500)] + 0.6 * rng.standard_normal((1500, 32))
    x[300:800] = x[300]  # a third of all rows are one vector
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(x)]
    rows += [(2000, None), (2050, [0.0] * 32), (2100, [float("nan")] + [1.0] * 31),
             (2150, [1.0, None] + [1.0] * 30), (2200, [1.0, 2.0]), (None, [1.0] * 32), (50, rows[50][1])]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>"), x.astype(np.float32)


def test_ann_recall_ties_and_split_lists(spark):
    df, x = vectors(spark)
    s = ann_scan.Settings(rows_per_list=50, shard_rows=64, query_rows=4, least_probes=6, probes=0.2)
    got = {}
    for r in ann_scan.search(df.selectExpr("*", "1 AS list").repartition(3), "vec_id % 50 = 0", s).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    d = x.astype(np.float64)
    norms = np.sqrt((d * d).sum(axis=1))
    hit = 0
    assert set(got) == set(range(0, 1500, 50))
    for q, found in got.items():
        score = (d * d[q]).sum(axis=1) / (norms * norms[q])
        score[q] = -2
        best = np.lexsort((np.arange(len(score)), -score))[:5]
        found = sorted(found)
        assert [r for r, _, _ in found] == [1, 2, 3, 4, 5]
        assert all(abs(score[i] - v) < 1e-12 for _, i, v in found)
        if 300 <= q < 800:
            assert [i for _, i, _ in found] == [i for i in range(300, 306) if i != q][:5]
        hit += len({i for _, i, _ in found} & set(best.tolist()))
    assert hit >= 0.9 * 5 * len(got)


def test_ann_small_and_empty(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (50, [2.0, 0.0])],
                               "vec_id long, embedding array<float>")
    got = ann_scan.search(df, "vec_id % 50 = 0").collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got) == [
        (0, 1, 50), (0, 2, 1), (50, 1, 0), (50, 2, 1)]
    assert ann_scan.search(df.limit(0), "vec_id % 50 = 0").count() == 0


@pytest.mark.parametrize("spread", [0.0, 0.01])
@pytest.mark.parametrize("others", [3, 8])
def test_ann_repeated_id_is_one_candidate(spark, spread, others):
    turn = lambda a: [float(np.cos(a)), float(np.sin(a))]
    rows = [(0, turn(0.0))] + [(7, turn(0.1 + spread * i)) for i in range(10)]
    rows += [(100 + i, turn(0.5 + 0.1 * i)) for i in range(others)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = {r["rank"]: r["vec_id"] for r in ann_scan.search(df, "vec_id = 0").collect()}
    assert got == dict(enumerate([7, *range(100, 100 + min(others, 4))], 1))


@pytest.mark.parametrize("lists", [128, 1706, 4096])
def test_ann_share_of_lists_probed_holds_at_every_size(lists):
    rng = np.random.default_rng(2)
    centroids = rng.standard_normal((lists, 8))
    batch = pa.RecordBatch.from_arrays(
        [pa.array([1, 2]), pa.array([0, 0], pa.int32()),
         pa.array([v.tobytes() for v in rng.standard_normal((2, 8))], pa.binary()),
         pa.array([b"", b""], pa.binary())], names=["vec_id", "list", "v", "r"])
    probe = ann_scan._probe(centroids, np.full(lists, 400), ann_scan.Settings())
    assert sum(b.num_rows for b in probe(iter([batch]))) == 2 * np.ceil(0.6 * lists)


def test_ann_id_that_fills_the_probed_lists(spark):
    rng = np.random.default_rng(8)
    near = np.array([1.0, 0, 0, 0]) + 0.3 * rng.standard_normal((600, 4))
    rows = [(0, [1.0, 0.0, 0.0, 0.0])] + [(7, v.tolist()) for v in near]
    rows += [(100 + i, [-1.0, 0.01 * i, 0.0, 0.0]) for i in range(6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    s = ann_scan.Settings(rows_per_list=10, least_probes=2, probes=0.05)
    got = {r["rank"]: r["vec_id"] for r in ann_scan.search(df, "vec_id = 0", s).collect()}
    assert got == dict(enumerate([7, 105, 104, 103, 102], 1))


def test_urls_rules_and_reputation(spark):
    rows = [(i, f"http://good.site.net/p{i}") for i in range(40)]
    rows += [(100 + i, f"https://Bad.Spam.net:80/x?{i}") for i in range(40)]
    rows += [(200, "http://a.EXAMPLE.org/en/12"), (201, "http://example.org/en/2"), (202, "http://example.org"),
             (203, None), (204, "no scheme"), (205, "http://x.com/de/1"), (206, "http://notorg/"),
             (207, "ftp://new.spam.net/"), (208, "http://u.com/fr/?a://b"), (208, "http://u.com/fr/?a://b"),
             (209, "://"), (210, "http://bad.spam.net:80#/org/")]
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'z' AS host")
    outcomes = spark.createDataFrame([(i, False) for i in range(40)] + [(100 + i, True) for i in range(40)],
                                     "page_id long, bad boolean")
    got = {}
    for r in url_reputation.judge_urls(pages, outcomes, url_reputation.RULES).collect():
        got[r["page_id"]] = (r["host"], r["path"], r["rule"], r["verdict"])
    assert got[0] == ("good.site.net", "/p0", None, "allow")
    assert got[100] == ("bad.spam.net:80", "/x", None, "block")
    assert got[200] == ("a.example.org", "/en/12", "example.org/en/1", "block")
    assert got[201] == ("example.org", "/en/2", "org/", "allow")
    assert got[202] == ("example.org", "", None, got[202][3])
    assert got[203] == got[204] == ("", "", None, "allow") and got[209][:3] == ("", "", None)
    assert got[205][2:] == ("com/de/", "block") and got[208][1:] == ("/fr/", "com/fr/", "allow")
    assert got[206][2] is None and got[210][:3] == ("bad.spam.net:80", "", None)
    none = outcomes.limit(0)
    verdicts = Counter(r["verdict"] for r in url_reputation.judge_urls(
        pages.filter("page_id < 200"), none, []).collect())
    assert verdicts == {"allow": 80}
    assert url_reputation.judge_urls(pages.limit(0), none, url_reputation.RULES).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a="</p><article>";</script>
</head><body class="has-sidebar"><header>Site</header><nav><ul><li><a href="/">Home</a></ul></nav>
<div class="cookie-notice">We use cookies</div><div class="wrap-{n}"><div class="post entry{n}">
<h1>Head&amp;line</h1><p>First <b>bo</b>ld &lt;text&gt;<br>line.<p>Second   para {n}
 goes on with more words to read.</div>
<div class="comments"><p>Reader says a lot of things here, longer than the article maybe, well, well.</p></div>
<aside>Side</aside></div><form><label>Name</label><input></form><!-- c --><footer>&copy; foot</footer></body></html>"""


def test_html_by_consensus(spark):
    rows = [(n, f"http://h.org/{n}", PAGE.format(n=n)) for n in range(5)]
    rows += [(10, "http://h.org/x", None), (11, None, ""), (12, None, "plain text &eacute; only"),
             (13, "http://k.org", "<article><header>By me</header><h1>A</h1><section>b</section>"
              "<section><ul><li>c<li>d</ul></section><div class=ad>buy</div></article><p>out"),
             (13, "http://k.org", "<p>short<p"), (14, "http://t.org", "<table><tr><td>Cell one<td>two</table>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string") \
        .selectExpr("*", "'c' AS text", "'h' AS path")
    got = Counter((r["page_id"], r["text"], r["n_chars"]) for r in html_extract.extract_pages(pages).collect())
    article = "Head&line First bold <text> line. Second para {n} goes on with more words to read."
    expected = [(n, article.format(n=n)) for n in range(5)]
    expected += [(10, ""), (11, ""), (12, "plain text é only"), (13, "A b c d"), (13, "short"),
                 (14, "Cell one two")]
    assert got == Counter((i, t, len(t)) for i, t in expected)
    assert html_extract.extract_pages(pages.limit(0)).count() == 0


def test_queries_match_their_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "conversations", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    for name, sql in registry.oracle_sql().items():
        rel = con.sql(sql)
        got = registry.queries()[name](spark, sf)
        assert sorted(got.columns) == sorted(rel.columns)
        assert Counter(map(tuple, got.select(*rel.columns).collect())) == Counter(rel.fetchall())


def test_pipeline_stages_follow_each_other(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == columns, name
        after = docs.count()
        assert 0 < after <= before
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    assert corpus_pipeline.run(spark, sf).count() == packed.count()
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, sf)
        assert empty.count() == 0, name


def test_pipeline_with_null_ids_repeated_rows_and_other_columns(spark):
    """Rows without an id, long and empty texts, repeated rows and columns named like the
    stages' own go through all stages."""
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    given = spark.read.parquet(f"{sf}/documents.parquet")
    some = given.limit(40)
    odd = some.withColumn("doc_id", F.lit(None).cast("long")).limit(9)
    odd = odd.union(some.limit(5)).union(some.limit(1).withColumn("text", F.lit(None).cast("string")))
    odd = odd.union(some.limit(1).withColumn("text", F.lit("word " * 50_000)))
    docs = given.union(odd).withColumns({c: F.lit("x") for c in (
        "kept", "rule", "class_id", "label", "h1", "sig", "rid", "spans", "bucket", "shard", "row")})
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == columns, name
        assert 0 < docs.count() <= before, name
        before = docs.count()
    left = docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert packed.where("piece = 0").count() == left
