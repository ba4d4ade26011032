"""Hot ids, repeated rows, odd markup and odd magnitudes: work stays in proportion, results right."""

from __future__ import annotations

import math
import re
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from periodstats.llm import (ann_scan, html_extract, ngram_join, packing, quality_rules,
                             url_reputation)
from periodstats.llm.common import table

SF = "/root/testdata/sf0.01"


def test_rows_without_id_or_of_one_id_are_dealt_over_shards(docs_of):
    rows = [(None, "a b c")] * 3000 + [(7, "a b c")] * 3000 + [(i, "a b c") for i in range(100, 3100)]
    s = packing.Settings(max_len=64, token_budget=256, batches_per_shard=1)
    out = packing.pack(docs_of(rows), s).cache()
    assert out.count() == 9000
    shards = [r["count"] for r in out.groupBy("bucket", "shard").count().collect()]
    assert max(shards) < 10 * (sum(shards) / len(shards))
    full = out.groupBy("bucket", "shard", "batch").agg(F.sum("bucket_len").alias("t"),
                                                       F.count("*").alias("n"),
                                                       F.count_distinct("slot").alias("slots"))
    assert full.where(f"t > {s.token_budget} OR n <> slots").count() == 0


def test_labels_and_rows_of_one_id_do_not_multiply(spark):
    stats = quality_rules.text_statistics(spark.createDataFrame(
        [(7, f"word{i} " * 60) for i in range(300)] + [(i, "other words " * 40) for i in range(20, 40)],
        "doc_id long, text string"), ["doc_id"])
    labels = spark.createDataFrame([(7, i % 2) for i in range(200)] + [(i, 1) for i in range(20, 40)],
                                   "doc_id long, quality int")
    s = quality_rules.Settings()
    cells = quality_rules.labelled_cells(stats, labels, s)
    total = np.sum(list(cells.counts.values()), axis=0)
    pairs = stats.filter(~quality_rules.base_failed()).join(labels, "doc_id").count()
    assert total.sum() == pairs  # weighs as the pairs, which are never made


def test_outcomes_count_once_a_host_however_many_rows_carry_the_id(spark):
    pages = spark.createDataFrame(
        [(7, "http://user@a.example.net:80/x")] * 300 + [(7, "http://b.example.net/")]
        + [(i, f"http://a.example.net/{i}") for i in range(100, 110)] + [(None, None)],
        "page_id long, url string")
    outcomes = spark.createDataFrame([(7, True)] * 20 + [(i, False) for i in range(100, 110)],
                                     "page_id long, bad boolean")
    s = url_reputation.Settings()
    levels = url_reputation.reputation(url_reputation.parsed(pages, s), outcomes, s)
    hosts = {r["host"]: r for r in levels["host"].collect()}
    assert set(hosts) == {"a.example.net", "b.example.net"}
    strength = {h: r["a"] + r["b"] for h, r in hosts.items()}
    assert strength["a.example.net"] - strength["b.example.net"] == pytest.approx(10)


def test_posteriors_equal_a_second_computation(spark):
    """Shrinkage from suffix to domain to host, worked out again row by row."""
    rng = np.random.default_rng(3)
    hosts = [f"h{i}.d{i % 7}.{'net' if i % 2 else 'org'}" for i in range(30)]
    rate = {h: rng.beta(2, 3) for h in hosts}
    rows = [(i, hosts[rng.integers(30)]) for i in range(900)]
    bad = [(i, bool(rng.random() < rate[h])) for i, h in rows if i % 3]
    s = url_reputation.Settings()
    got = {r["page_id"]: (r["bad_share"], r["bad_bound"]) for r in url_reputation.judge_urls(
        spark.createDataFrame([(i, f"http://{h}/") for i, h in rows], "page_id long, url string"),
        spark.createDataFrame(bad, "page_id long, bad boolean"), [], s).collect()}
    of = dict(rows)
    level = {h: (h.split(".")[-1], ".".join(h.split(".")[-2:]), h) for h in hosts}
    mean = {}
    whole = (sum(b for _, b in bad) + 1) / (len(bad) + 2)
    post = {}
    for k in range(3):
        n, w = Counter(), Counter()
        for i, b in bad:
            n[level[of[i]][k]] += 1
            w[level[of[i]][k]] += b
        above = {level[h][k]: (whole if not k else mean[level[h][k - 1]]) for h in hosts}
        noise = sum(n[x] * above[x] * (1 - above[x]) for x in n)
        seen = sum((w[x] - n[x] * above[x]) ** 2 for x in n)
        room = sum(n[x] * above[x] * (1 - above[x]) * (n[x] - 1) for x in n)
        rho = (seen - noise) / room
        strength = min(max(1 / rho - 1 if rho > 1e-9 else s.most_strength, s.least_strength),
                       s.most_strength)
        for x in n:
            a, b = w[x] + above[x] * strength, n[x] - w[x] + (1 - above[x]) * strength
            mean[x], post[x] = a / (a + b), (a, b)
    for i, h in rows:
        a, b = next(post[x] for x in reversed(level[h]) if x in post)
        m = a / (a + b)
        bound = m - s.z * math.sqrt(m * (1 - m) / (a + b + 1))
        assert got[i] == (pytest.approx(m, abs=1e-6), pytest.approx(bound, abs=1e-6))


def test_equal_rows_meet_their_representative_once(docs_of):
    words = [f"w{i}" for i in range(60)]
    near = " ".join([*words[:30], "x", *words[31:]])
    rows = [(7, " ".join(words))] * 300 + [(8, near), (9, "something else entirely of six words")]
    got = Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in
                  ngram_join.similarity_join(docs_of(rows)).collect())
    linked = 5 * (56 - 5) >= 4 * (56 + 5)
    assert got == {(7, 7, 299 + linked): 300, (8, 7 if linked else 8, 300 * linked): 1, (9, 9, 0): 1}


def test_components_of_any_magnitude_score_exactly(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(120, 8))
    scale = np.where(np.arange(120) % 3 == 0, 1e200, np.where(np.arange(120) % 3 == 1, 1e-200, 1.0))
    rows = [(i, [float(x) for x in v * c]) for i, (v, c) in enumerate(zip(base, scale, strict=True))]
    df = spark.createDataFrame(rows, "vec_id long, vector array<double>")
    name = [c for c in table(spark, SF, "embeddings").columns if c != "vec_id"][0]
    kind = dict(table(spark, SF, "embeddings").dtypes)[name]
    df = df.select("vec_id", F.col("vector").cast("array<double>").alias(name))
    got = {}
    for r in ann_scan.search(df, "vec_id % 10 = 0").collect():
        got.setdefault(r["query_id"], {})[r["vec_id"]] = r["score"]
    assert kind and len(got) == 12
    unit = base / np.linalg.norm(base, axis=1)[:, None]
    for q, found in got.items():
        assert len(found) == 5
        for i, score in found.items():
            assert score == pytest.approx(float(unit[q] @ unit[i]), abs=1e-12)


def test_cut_off_tags_and_deep_pages_take_time_in_proportion():
    tag = "<div " + " ".join(f'data-a{i}="v{i}"' for i in range(200))
    pages = {"cut off": f"<article><p>Some words here.</p>{tag}",
             "lone quotes": "<article><p>Some words here.</p></article>" + "<a '\" <b \"' " * 5000,
             "only tags": "<article><p>Some words here.</p></article>" + "<a " * 50_000,
             "deep": "<div>" * 100_000 + "<article><p>Some words here.</p></article>" + "</span>" * 50_000}
    for name, page in pages.items():
        began = time.time()
        assert html_extract.extract(page, None).startswith("Some words here."), name
        assert time.time() - began < 5, name
    quoted = '<article class="a>b" title=\'x > y\'><p>One <b title=">">two</b> it\'s</p><p a=" >three</p></article>'
    assert html_extract.extract(quoted, None) == "One two it's three"


def test_extraction_of_all_pages_equals_regular_expressions(spark):
    """The tables' pages keep their article in one element, found here by expressions."""
    import html
    pages = table(spark, SF, "pages")
    got = {r["page_id"]: r["text"] for r in html_extract.extract_pages(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        page = re.sub(r"(?s)<!--.*?-->|<(script|style|nav|header|footer|aside|form|figure)\b.*?</\1>",
                      " ", r["html"] or "")
        page = re.sub(r"(?s)<(div|section|ul)\b[^>]*(?:class|id)=\"[^\"]*\".*?</\1>", " ", page)
        page = re.search(r"(?s)<article\b[^>]*>(.*?)</article>", page)[1]
        page = re.sub(r"(?s)</?(?:a|b|em|i|span|strong)\b[^>]*>", "", page)
        assert got[r["page_id"]] == " ".join(html.unescape(re.sub(r"<[^>]*>", " ", page)).split())
