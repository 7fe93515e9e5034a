"""Phrase mining, ranked search and vector search against plain versions, on awkward rows too."""

import collections
import math
import random
import re

import numpy as np
import pyarrow.parquet as pq
import pytest

from shelfline.llm import collocation, ranked_search, vector_search

SMALL = "/root/testdata/sf0.001"
rng = random.Random(5)


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# Phrases --------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def spoken():
    """(text, lang): frequent phrases, overlaps, cuts that tie, null and empty rows, one long text."""
    words = [f"w{i}" for i in range(12)]
    rows = [(" ".join(rng.choice(words) for _ in range(rng.randint(1, 40))), rng.choice(["en", "de", None])) for _ in range(150)]
    rows += [("New York City, new york", "en")] * 40 + [("a a a a a! a a", "de")] * 9
    rows += [("one\ttwo  three.four five;six\x0bseven", None)] * 31 + [("Ünd Ä\x85x é", "en")] * 30
    rows += [(None, "en"), ("", "fr"), (" \t\n", "fr"), (None, None), ("x y " * 6_000, "de"), ("", None)]
    return rows


def plain_phrases(rows, least, top):
    counts, total = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", fold(text)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(ws)
            for k in range(1, 5):
                counts.update((lang, tuple(ws[i:i + k])) for i in range(len(ws) - k + 1))
    kept = {x: f for x, f in counts.items() if f >= least and len(x[1]) > 1}
    out = collections.defaultdict(list)
    for (lang, p), a in kept.items():
        if any(100 * f >= 80 * a for (other, q), f in kept.items() if other == lang and len(q) > len(p)
               and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))):
            continue
        cuts = []
        for k in range(1, len(p)):
            l, r = counts[lang, p[:k]], counts[lang, p[k:]]
            cuts.append((2_000_000 * a // (l + r), k, l, r))
        score, _, l, r = min(cuts)
        out[lang].append((-score, -a, " ".join(p).encode(), l, r))
    return sorted((lang, i + 1, p.decode(), -a, l, r, total[lang], -s) for lang, rows in out.items()
                  for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top]))


@pytest.mark.parametrize("options", [{}, {"fraction": 0.0}, {"fraction": 1.0, "slack": 1.0}, {"slots": 64}])
def test_phrases_do_not_depend_on_the_sample(spark, spoken, options):
    frame = spark.createDataFrame([(t, x, 1, "p", 2.0) for t, x in spoken],
                                  "text string, lang string, n long, phrase string, score double").repartition(4)
    got = collocation.collocations(frame, top=40, **({"slots": 1 << 16} | options))
    assert sorted(map(tuple, got.collect())) == plain_phrases(spoken, 30, 40)


def test_border_failures_lead_to_more_passes(spark, spoken):
    frame = spark.createDataFrame(spoken, "text string, lang string")
    rows = frame.selectExpr("coalesce(text, '') AS text", "coalesce(lang, 'und') AS lang", "false AS sampled")
    blocks = collocation.stage(collocation._blocks(rows), "blocks", "sampled")
    _, passes = collocation.frequent(blocks, 4, 30, 0.1, 0.6, 1 << 16)
    assert passes == 4  # nothing is proposed: words, pairs, triples, and phrases of four


def test_phrases_of_nothing(spark):
    assert collocation.collocations(spark.createDataFrame([], "text string, lang string"), slots=1 << 12).count() == 0


def test_hashes_that_clash_are_told_apart(spark, monkeypatch, spoken):
    monkeypatch.setattr(collocation, "_mix", lambda h: h & np.uint64(0xFF0))
    blocks = collocation.stage(collocation._blocks(spark.createDataFrame(
        [(t or "", x or "und", True) for t, x in spoken], "text string, lang string, sampled boolean")), "blocks", "sampled")
    rows = [r.asDict() for r in blocks.collect()]
    for r in rows:
        places, hashes = np.frombuffer(r["places"], np.int32), np.frombuffer(r["hashes"], np.uint64)
        _, pairs = [*collocation.phrase_hashes(places, hashes, 2)]
        assert len(np.unique(pairs[0][pairs[1]])) <= 256


# Ranked search ----------------------------------------------------------------------------------


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_rank(docs, items, top):
    found = [(i, collections.Counter(TERM.findall(fold(t)))) for i, t in docs]
    found = [(i, c, sum(c.values())) for i, c in found if c]
    N, L = len(found), sum(n for _, _, n in found)
    df = collections.Counter(t for _, c, _ in found for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c, n in found:
            m = 10 + 90 * n * N // L
            s = sum(math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                    for t in set(TERM.findall(fold(text))) if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, k + 1, i, -s) for k, (s, _, _, i) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def library():
    given = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{SMALL}/documents.parquet").to_pylist()]
    return given + [(9000 + i, "same text twice") for i in range(15)] + [
        (9001, "same text twice"), (None, "same text twice"), (None, None), (9100, None), (9101, ""), (9102, "!?"),
        (9103, "word " * 70_000 + "needle"), (9104, "Needle ÜBER x1 über"), (9105, "needle " * 300),
    ]


@pytest.fixture(scope="module")
def asked():
    given = [(str(r["item_id"]), r["text"]) for r in pq.read_table(f"{SMALL}/benchmark.parquet").to_pylist()]
    return given + [("t", "same SAME twice"), ("t", "needle word"), (None, "Über"), ("e", ""), ("n", None), ("u", "unheardof zzzz9")]


@pytest.mark.parametrize("sizes", [{}, {"SHARD_TERMS": 3_000}, {"SHARD_DOCS": 7}])
def test_ranked_search(spark, monkeypatch, library, asked, sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(ranked_search, name, value)
    docs = spark.createDataFrame([(i, t, 1, "t", 7) for i, t in library],
                                 "doc_id long, text string, rank int, term string, score long").repartition(2)
    items = spark.createDataFrame([(i, t, 3) for i, t in asked], "item_id string, text string, doc_id long")
    got = sorted(map(tuple, ranked_search.rank(docs, items).collect()), key=repr)
    assert got == plain_rank(library, asked, 10)


def test_ranked_search_in_blocks_of_items(spark, library, asked):
    docs = ranked_search.documents(spark.createDataFrame(library, "doc_id long, text string").repartition(3))
    items = spark.createDataFrame(asked, "item_id string, text string")
    n, total = ranked_search.statistics(docs)
    terms = ranked_search.query_terms(items, "item_id", "text")
    index = ranked_search.build_index(docs, n, total)
    one, many = (sorted(map(tuple, ranked_search.search(index, terms, n, total, 10_000, b).collect()), key=repr) for b in (10_000, 5))
    assert one == many and one


def test_ranked_search_of_nothing(spark, library, asked):
    docs, none = spark.createDataFrame(library[:20], "doc_id long, text string"), spark.createDataFrame([], "doc_id long, text string")
    items, no_items = (spark.createDataFrame(x, "item_id string, text string") for x in (asked, []))
    assert ranked_search.rank(none, items).count() == 0
    assert ranked_search.rank(docs, no_items).count() == 0


def test_shards_in_small_windows_and_blocks(monkeypatch):
    monkeypatch.setattr(ranked_search, "BLOCK", 4)
    monkeypatch.setattr(ranked_search, "WINDOW_DOCS", 16)
    r = np.random.default_rng(4)
    for _ in range(200):
        n = int(r.integers(1, 300))
        m = r.integers(1, 400, n)
        lists, scores = [], np.zeros(n, np.int64)
        for _ in range(int(r.integers(1, 9))):
            doc = np.flatnonzero(r.random(n) < r.choice([0.03, 0.3, 0.9]))
            if len(doc):
                tf, w = r.choice([1, 2, 300, 70_000], len(doc)), int(r.integers(1, 9_000))
                e = ranked_search.encode(np.zeros(len(doc), np.int64), doc, tf, m[doc])
                lists.append(ranked_search.Postings(w, int(e["peak"][0]), e["heads"].tobytes(), e["body"].tobytes()))
                scores[doc] += w * ranked_search.impact(tf, m[doc])
        doc, score = ranked_search.best_of_shard(lists, m, 10)
        want = [i for i in np.lexsort((np.arange(n), -scores)) if scores[i] > 0][:10]
        assert doc.tolist() == want and score.tolist() == scores[want].tolist()


def test_blocks_are_left_compressed():
    n = 40_000
    m = np.full(n, 100, np.int64)
    m[:20] = 1  # the best documents stand in front
    pairs = [(0, np.arange(0, n, 2)), (1, np.arange(0, n, 3)), (2, np.arange(0, 40))]
    lists = []
    for weight, (_, doc) in zip((1, 1, 900), pairs):
        e = ranked_search.encode(np.zeros(len(doc), np.int64), doc, np.ones(len(doc), np.int64), m[doc])
        lists.append(ranked_search.Postings(weight, int(e["peak"][0]), e["heads"].tobytes(), e["body"].tobytes()))
    doc, score = ranked_search.best_of_shard(lists, m, 5)
    assert doc.tolist() == [0, 6, 12, 18, 2] and score[0] > score[-1]
    assert len(lists[0].open) < 40 and len(lists[0].heads) > 150


# Vectors ----------------------------------------------------------------------------------------


def plain_nearest(rows, every, top):
    good = [(i, v) for i, v in rows if v and len(v) == 16 and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for a, (q, v) in enumerate(good):
        if q is not None and q % every == 0:
            scores = []
            for b, (i, w) in enumerate(good):
                if a != b:
                    s = 0.0
                    for x, y in zip(v, w):
                        s += x * y
                    scores.append((-s, i is None, i or 0, i))
            out += [(q, k + 1, i, -s) for k, (s, _, _, i) in enumerate(sorted(scores)[:top])]
    return out


@pytest.fixture(scope="module")
def points():
    r = np.random.default_rng(1)
    base = r.normal(size=(40, 16))
    x = (base[r.integers(0, 40, 1500)] * 3 + r.normal(size=(1500, 16))).astype(np.float32)
    x[300:700] = x[5]  # copies hold many of the rows
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    rows += [(2000, None), (2020, [0.0] * 16), (2040, [float("nan")] + [1.0] * 15), (2060, [float("inf")] * 16),
             (2080, [None] + [1.0] * 15), (2100, [1.0, 2.0]), (None, x[7].tolist()), (20, x[8].tolist()), (20, x[8].tolist()), (2120, [])]
    return rows


@pytest.fixture(scope="module")
def vectors(spark, points):
    return spark.createDataFrame([(i, v, "r", 1.0, 2) for i, v in points],
                                 "vec_id long, embedding array<float>, row string, score double, h int").repartition(5)


def test_vectors_exactly_where_all_lists_are_read(vectors, points):
    got = sorted(map(tuple, vector_search.nearest(vectors, least_probes=10_000).collect()), key=repr)
    assert got == sorted(plain_nearest(points, 20, 20), key=repr)


def test_vectors_by_lists(vectors, points, monkeypatch):
    monkeypatch.setattr(vector_search, "SEGMENT", 16)
    want = collections.defaultdict(list)
    for q, _, _, s in plain_nearest(points, 20, 20):
        want[q].append(s)
    got = vector_search.nearest(vectors, list_size=20).collect()
    assert collections.Counter(r.query_id for r in got) == {q: len(s) for q, s in want.items()}
    hits = sum(r.score >= min(want[r.query_id]) for r in got)
    assert hits >= 0.9 * len(got)


def test_few_vectors_and_none(spark, points):
    few = spark.createDataFrame(points[:7], "vec_id long, embedding array<double>")
    got = sorted(map(tuple, vector_search.nearest(few, every=3).collect()), key=repr)
    assert got == sorted(plain_nearest(points[:7], 3, 20), key=repr)
    assert vector_search.nearest(few.where("vec_id = 1"), every=1).count() == 0
    assert vector_search.nearest(few.where("false")).count() == 0


def test_a_walk_finds_the_nearest_centroids():
    r = np.random.default_rng(2)
    c = vector_search.balanced_centroids(r.normal(size=(20_000, 8)).astype(np.float32), 1_000)
    near = vector_search._nearest(c, c, 25)[:, 1:]
    graph = vector_search.Graph(c, near)
    q = r.normal(size=(200, 8)).astype(np.float32)
    found, gap = graph.walk(q, 32)
    true = vector_search._nearest(q, c, 10)
    assert np.mean([len(set(a[:10]) & set(b)) / 10 for a, b in zip(found, true)]) > 0.97
    assert (np.diff(gap, axis=1) >= -1e-4).all()
