"""Repeats, spelling variants and collocations against brute force, with awkward rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from periodstats.llm import collocations, repeats, spelling

RANDOM = random.Random(11)
WORDS = ["".join(RANDOM.choices("abcdef", k=RANDOM.randint(1, 5))) for _ in range(60)]


def prose(n, rng=RANDOM):
    return " ".join(rng.choices(WORDS, k=n))


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# -- repeats -------------------------------------------------------------------------------

def repeated_rows():
    passage, other = prose(40), prose(13)
    rows = [(1, prose(30) + " " + passage), (2, passage + "\n" + prose(20)),
            (5, prose(5) + "\t" + other + " " + prose(7)), (4, other), (9, other + " " + other),
            (3, None), (6, ""), (7, " \n "), (8, "few words only"), (10, "few words only"),
            (None, passage), (None, None), (11, prose(6000) + " " + passage),
            (12, passage[:len(passage) // 2]), (13, passage), (13, passage), (13, "x " + passage),
            (14, "a b " * 40), (15, "b a " * 9), (16, passage + " " + other + " " + passage)]
    rows += [(100 + i, prose(i % 9) + " " + passage + " " + prose(i % 4)) for i in range(30)]
    return rows


def without_repeats(rows, size):
    first = {}
    texts = [(doc, (text or "").split()) for doc, text in rows]
    for doc, w in texts:
        for i in range(len(w) - size + 1):
            if doc is not None:
                key = tuple(w[i:i + size])
                first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, w in texts:
        gone = set()
        for i in range(len(w) - size + 1):
            if doc is not None and first[tuple(w[i:i + size])] < doc:
                gone.update(range(i, i + size))
        out.append((doc, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


@pytest.mark.parametrize("settings", [repeats.Settings(), repeats.Settings(window=5, anchor=5),
                                      repeats.Settings(window=4, anchor=1, block_chars=500)])
def test_repeats_equal_brute_force(docs_of, settings):
    rows = repeated_rows()
    expected = Counter(without_repeats(rows, settings.window))
    got = repeats.remove_repeats(docs_of(rows), settings).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got) == expected
    got = repeats.digests(docs_of(rows), settings).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got) == \
        Counter((d, n, m, hashlib.sha256(k.encode()).hexdigest()) for d, n, m, k in expected.elements())


def test_factors_point_at_equal_words_of_a_smaller_document(docs_of):
    rows = [r for r in repeated_rows() if r[0] != 13]  # one text an id, to look words up
    words = {doc: (text or "").split() for doc, text in rows}
    found = repeats.factors(docs_of(rows)).collect()
    covered = Counter()
    for f in found:
        assert f["n_words"] >= 13 and f["ref_doc"] < f["doc_id"]
        here = words[f["doc_id"]][f["start"]:f["start"] + f["n_words"]]
        assert here == words[f["ref_doc"]][f["ref_start"]:f["ref_start"] + f["n_words"]]
        covered.update({(f["doc_id"], i) for i in range(f["start"], f["start"] + f["n_words"])})
    removed = {doc: n for doc, _, n, _ in without_repeats(rows, 13) if doc is not None}
    assert Counter(doc for doc, _ in covered) == Counter({d: n for d, n in removed.items() if n})
    assert any(f["n_words"] >= 40 for f in found)  # a whole passage is one factor


def test_repeats_of_empty_tables(docs_of, spark):
    empty = docs_of([(1, "x")]).where("doc_id > 5")
    assert repeats.digests(empty).collect() == []
    assert repeats.factors(docs_of([(None, None), (1, None)])).collect() == []


def test_a_row_held_by_a_third_of_the_table_is_read_once_a_batch(spark, docs_of):
    """Equal rows are folded before the shuffle, so they do not fill one block."""
    rows = [(7, "same words again " * 6)] * 3000 + [(i, prose(20)) for i in range(6000)]
    got = Counter((r["doc_id"], r["n_removed"]) for r in repeats.digests(docs_of(rows)).collect())
    assert sum(got.values()) == 9000 and got[7, 0] + got[7, 18] >= 3000


# -- spelling ------------------------------------------------------------------------------

def near(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def spelled(rows, s):
    n = Counter()
    for doc, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % s.drop_every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= s.min_length and c >= s.min_count}
    out = {}
    for w in n:
        others = sorted((-n[v], v) for v in n if v != w and near(v, w))
        form = others[0][1] if others and -others[0][0] >= s.ratio * n[w] else None
        out[w] = [form, len(others)]
    rows = set()
    for w in n:
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        rows.add((w, out[w][0], root, n[w], out[w][1], out[w][0] and n[out[w][0]]))
    return rows


def spelling_rows():
    rng = random.Random(3)
    base = ["".join(rng.choices("abéñ", k=rng.randint(6, 9))) for _ in range(25)]
    words = {}
    for b in base:
        words[b] = rng.choice([40, 200, 900])
        for _ in range(6):
            i = rng.randrange(len(b))
            words[rng.choice([b[:i] + b[i + 1:], b[:i] + "x" + b[i + 1:], b[:i] + "y" + b[i:]])] = \
                rng.choice([1, 5, 8, 30])
    words |= {"aaaaaa": 300, "aaaaaaa": 50, "aaaaaaaa": 9, "short": 99, "z" * 3000: 6,
              "z" * 1500 + "q" + "z" * 1500: 40}
    rows = [(i % 50, " ".join([w.upper() if i % 3 == 0 else w] * n))
            for i, (w, n) in enumerate(words.items())]
    return rows + [(None, None), (60, ""), (None, "naïve-naïveté naïveté2naïveté " * 5)]


@pytest.mark.parametrize("settings", [spelling.Settings(), spelling.Settings(drop_every=3, block=4),
                                      spelling.Settings(min_length=1, min_count=1, ratio=1, cells=64)])
def test_variants_equal_brute_force(docs_of, settings):
    rows = spelling_rows()
    if settings.ratio == 1:  # a form as frequent as its word could name it back
        settings = spelling.Settings(min_length=2, min_count=1, ratio=2, cells=64)
    got = [tuple(r) for r in spelling.variants(docs_of(rows), settings)
           .select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(got) == len(set(got)) and set(got) == spelled(rows, settings)


def test_variants_of_an_empty_table(docs_of):
    assert spelling.variants(docs_of([(1, None)])).collect() == []


def test_a_large_group_is_dealt_into_pairs_of_blocks(spark):
    """A third of all words share a half; no tile holds more than two blocks of about its size."""
    rng = random.Random(1)
    words = {"common" + "".join(rng.choices("abcdefgh", k=6)) for _ in range(900)}
    words |= {"".join(rng.choices("abcdefgh", k=12)) for _ in range(1800)}
    df = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    s = spelling.Settings(block=64)
    largest = spelling.tiles(df, s).groupBy("tile").count().agg({"count": "max"}).first()[0]
    assert largest < 4 * s.block
    got = {r["word"]: r["n_near"] for r in spelling.with_near(df, s).collect()}
    sample = sorted(words)[::40]
    assert {w: sum(near(w, v) for v in words if v != w) for w in sample} == \
        {w: got[w] for w in sample}


# -- collocations --------------------------------------------------------------------------

def mined(rows, s):
    """rows: (lang, text)."""
    f, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, s.max_words + 1):
                f.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    cand = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= s.min_count}
    scored = {}
    for (lang, p), a in cand.items():
        cuts = [(1000000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        covered = any(la == lang and len(q) > len(p) and 100 * b >= s.covered_percent * a
                      and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                      for (la, q), b in cand.items())
        if not covered:
            scored[lang, " ".join(p)] = (-score, -a, f[lang, p[:k]], f[lang, p[k:]])
    out = set()
    for lang in total:
        best = sorted((v[0], v[1], p.encode(), v[2], v[3]) for (la, p), v in scored.items() if la == lang)
        out |= {(lang, i + 1, p.decode(), -a, left, right, total[lang], -score)
                for i, (score, a, p, left, right) in enumerate(best[:s.top])}
    return out


def piece_rows():
    rng = random.Random(9)
    names = ["The", "of", "é𝒳", "#1", "A-b"] + WORDS[:14]
    rows = []
    for i in range(260):
        w = rng.choices(names, k=rng.randint(1, 60))
        text = "".join(x + rng.choice([" ", " ", " ", "\t ", ". ", "\n", " ,", "! "]) for x in w)
        rows.append((rng.choice(["en", "en", "de", None, ""]), text))
    return rows + [("en", None), ("xx", ""), ("en", " \t. ."), ("de", "the of " * 3000),
                   ("en", "one phrase that is long " * 12), (None, "\x0b\x0c\x1c\x1d a\x85b c ")]


@pytest.mark.parametrize("settings", [collocations.Settings(),
                                      collocations.Settings(max_words=4, min_count=5, top=30,
                                                            block_chars=700),
                                      collocations.Settings(max_words=2, covered_percent=80)])
def test_collocations_equal_brute_force(spark, settings):
    rows = piece_rows()
    docs = spark.createDataFrame(rows, "lang string, text string").selectExpr(
        "*", "'x' AS phrase", "1 AS n", "'y' AS word").repartition(3)
    got = [tuple(r) for r in collocations.collocations(docs, settings).collect()]
    assert len(got) == len(set(got)) and set(got) == mined(rows, settings)


def test_collocations_of_empty_tables(spark):
    for rows in ([], [("en", None)], [(None, "one two")]):
        docs = spark.createDataFrame(rows, "lang string, text string")
        assert collocations.collocations(docs).collect() == []


@pytest.mark.parametrize("span", [60, 5000, 200_000])
def test_pairs_are_counted_alike_dense_and_sparse(span):
    rng = np.random.default_rng(2)
    a = (rng.zipf(1.2, 60_000) % span).astype(np.int64)
    b = (rng.zipf(1.2, 60_000) % span).astype(np.int64)
    expected = Counter(zip(a.tolist(), b.tolist(), strict=True))
    x, y, n = collocations.count_pairs(a, b)
    assert dict(zip(zip(x.tolist(), y.tolist(), strict=True), n.tolist(), strict=True)) == expected
    half = len(a) // 2
    parts = [collocations.count_pairs(a[:half], b[:half]), collocations.count_pairs(a[half:], b[half:])]
    x, y, n = collocations.count_pairs(*(np.concatenate(c) for c in zip(*parts, strict=True)))
    assert dict(zip(zip(x.tolist(), y.tolist(), strict=True), n.tolist(), strict=True)) == expected


def test_pieces_of_odd_characters():
    at, words = collocations.encoded(pa.array(["  A b.b\x0b\x1cA  ", None, "", "É é"]))
    words = words.to_pylist()
    pieces = [[]]
    for i in at.tolist():
        pieces.append([]) if i < 0 else pieces[-1].append(words[i])
    assert [p for p in pieces if p] == [["a", "b"], ["b"], ["\x1ca"], ["É", "é"]]
