"""Every operator against a plain version of itself, on given rows and on awkward ones."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash

from shelfline.llm import (
    decontaminate, exact, extract, katz, packing, simhash, token_count, token_store, toxicity, units,
)
from shelfline.llm.common import free_name
from shelfline.llm.queries import vocabulary

SMALL = "/root/testdata/sf0.001"
SPACE = re.compile(r"[\x20\x09-\x0D]+")
rng = random.Random(3)
WORDS = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(300)]


def prose(n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


PASSAGE = prose(30)


@pytest.fixture(scope="module")
def rows():
    """(doc_id, text) with nulls, empty texts, repeated rows, copies, near copies and one long text."""
    given = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{SMALL}/documents.parquet").to_pylist()]
    base = prose(200)
    words = base.split()
    near = [" ".join([*words[:i], "other", *words[i + 1:]]) for i in (0, 50, 120)]
    return given + [
        (5000, None), (5001, ""), (5002, " \t\n "), (None, "no id"), (None, None), (5003, base), (5004, base.replace(" ", "\n", 9)),
        (5005, near[0]), (5006, near[1]), (5007, near[2]), (5008, prose(60_000)), (5009, base), (5009, base),
        (5010, prose(20) + ". " + PASSAGE + ". " + prose(5)), (5011, PASSAGE), (5012, "a"), (5013, "Ünïcode <|endoftext|> 中文, x"),
        (5014, " ".join(["same"] * 500)),
    ]


@pytest.fixture(scope="module")
def docs(spark, rows):
    """The rows with columns whose names the operators use themselves."""
    wide = [(i, t, "k", 1, 2.0, "s", 7, True) for i, t in rows]
    return spark.createDataFrame(
        wide, "doc_id long, text string, key string, n long, score double, sha string, length long, kept boolean"
    ).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_exact_groups(docs, rows, empty):
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[SPACE.sub(" ", t or "")].append(i)
    want = []
    for norm, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        want += [(i, keep, len(ids), i == keep, hashlib.sha256(norm.encode()).hexdigest()) for i in ids]
    want.sort(key=repr)
    assert collected(exact.duplicate_groups(docs)) == want
    assert collected(exact.duplicate_groups(docs, hex_digits=1)) == want  # digests that clash
    assert exact.duplicate_groups(empty).count() == 0


def test_exact_keeps_one_row_of_each_text(docs, rows):
    left = exact.keep_first(docs)
    assert left.columns == docs.columns
    texts = [SPACE.sub(" ", r.text or "") for r in left.collect()]
    assert sorted(texts) == sorted({SPACE.sub(" ", t or "") for _, t in rows})


def fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(docs, rows, empty):
    short = [(i, t) for i, t in rows if len(t or "") < 20_000 or i == 5008]
    fps = {t: fingerprint(t) for _, t in short}
    ids = [i for i, _ in rows]
    of = [fps[t] if t in fps else fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if (of[a] ^ of[b]).bit_count() <= 3:
                root[find(a)] = find(b)
    least = collections.defaultdict(list)
    for n, i in enumerate(ids):
        least[find(n)].append(i)
    best = {k: min((i for i in v if i is not None), default=None) for k, v in least.items()}
    want = sorted(((i, f"{f:016x}", best[find(n)]) for n, (i, f) in enumerate(zip(ids, of))), key=repr)
    assert collected(simhash.near_groups(docs)) == want
    assert len({w[2] for w in want if w[0] in (5003, 5005, 5006, 5007)}) < 4
    kept = [r.doc_id for r in simhash.keep_one(docs).collect()]
    assert {i for i in kept if i is not None} == {i for i in best.values() if i is not None}
    assert simhash.near_groups(empty).count() == 0


@pytest.mark.parametrize("full", [1, 4096])
def test_simhash_links_are_complete(spark, full):
    """Dense and sparse fingerprints, with buckets cut again and not: the same components."""
    r = np.random.default_rng(5)
    base = r.integers(0, 1 << 62, 150)
    fps = {int(b) ^ (1 << int(x)) ^ (1 << int(y)) for b in base for x, y in r.integers(0, 62, (4, 2))}
    fps |= {int(x) for x in r.integers(0, 1 << 10, 200)}
    fps = sorted(fps)
    near = [(a, b) for n, a in enumerate(fps) for b in fps[:n] if (a ^ b).bit_count() <= 3]
    label = {f: f for f in fps}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in near:
        x, y = find(a), find(b)
        label[max(x, y)] = min(x, y)
    frame = spark.createDataFrame([(f,) for f in fps], "fp long")
    got = {r.a: r.b for r in simhash.components(simhash.links(frame, 3, full)).collect()}
    assert {f: got.get(f, f) for f in fps} == {f: find(f) for f in fps}


ITEMS = [(1, PASSAGE), (2, "a"), (3, None), (4, ""), (5, prose(40)), (5, prose(12)), (None, "Ünïcode"), (6, "same " * 30)]


def words_of(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))


def test_decontamination(spark, docs, rows, empty):
    bench = spark.createDataFrame([(i, t, 1) for i, t in ITEMS], "item_id long, text string, start int")
    windows = collections.defaultdict(set)
    for i, t in ITEMS:
        own = words_of(t)
        for k in range(max(1, len(own) - 9) if own else 0):
            windows[tuple(own[k:k + 10])].add(i)
    lengths = {len(w) for w in windows}
    want = []
    for doc_id, text in rows:
        own, hit, items = words_of(text), set(), set()
        for size in lengths:
            for k in range(len(own) - size + 1):
                found = windows.get(tuple(own[k:k + size]))
                if found:
                    hit.update(range(k, k + size))
                    items |= found
        names = sorted(str(i) for i in items if i is not None)
        sha = hashlib.sha256(",".join(names).encode()).hexdigest()
        want.append((doc_id, len(own), len(hit), len(names), sha, bool(hit)))
    assert collected(decontaminate.contamination(docs, bench)) == sorted(want, key=repr)
    assert decontaminate.contamination(empty, bench).count() == 0
    assert decontaminate.contamination(docs, bench.limit(0)).where("contaminated").count() == 0
    left = decontaminate.keep_clean(docs, bench)
    assert left.columns == docs.columns and 5011 not in [r.doc_id for r in left.collect()]


def test_decontamination_near_matches(spark):
    docs = spark.createDataFrame([(1, "one x two y three"), (2, "one " + "z " * 50 + "two three")], "doc_id long, text string")
    bench = spark.createDataFrame([(9, "three two one")], "item_id long, text string")
    index = decontaminate.build_index(docs, decontaminate.test_terms(bench))
    found = decontaminate.matches(index, bench, 3, slop=3, block_words=1).collect()
    assert {(r.ord, r.kind) for r in found} == {(0, "near")} or {(r.shard, r.kind) for r in found} == {(0, "near")}


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary())


def test_token_counts(docs, rows, empty):
    t = library()
    want = []
    for i, text in rows:
        n = len(t.encode(text or "", add_special_tokens=False).ids)
        want.append((i, len((text or "").encode()), n, n > 2048))
    assert collected(token_count.token_counts(docs, vocabulary())) == sorted(want, key=repr)
    assert token_count.token_counts(empty, vocabulary()).count() == 0


def test_packing(docs, rows, empty):
    t, size = library(), 4096
    want = collections.Counter()
    total = 0
    for i, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [1]
        total += len(ids)
        for n, at in enumerate(range(0, len(ids), size)):
            part = np.array(ids[at:at + size], "<u4")
            want[(i, n, at, len(part), zlib.crc32(part.tobytes()))] += 1
    got = packing.pack_documents(docs, vocabulary()).collect()
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = collections.defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= size
    assert len(bins) <= math.ceil(1.03 * total / size) + 1
    assert packing.pack_documents(empty, vocabulary()).count() == 0


def test_packed_sequences_hold_the_ids(docs):
    packed = packing.pack_documents(docs.where("doc_id < 20"), vocabulary(), keep_ids=True)
    parts = {(r.sequence_id, r.offset): r.ids for r in packed.collect()}
    for r in packing.sequences(packed).collect():
        for (sequence, offset), ids in parts.items():
            if sequence == r.sequence_id:
                assert r.ids[offset:offset + len(ids)] == ids


def test_best_fit_takes_the_tightest_bin_and_closes_the_fullest():
    bins = packing.BestFit(10, 2)
    assert [bins.add(n) for n in (6, 7, 3, 5, 4)] == [(0, 0), (1, 0), (1, 7), (2, 0), (0, 6)]
    bins = packing.BestFit(10, 1)
    assert [bins.add(n) for n in (6, 7, 4)] == [(0, 0), (1, 0), (2, 0)]


def test_token_store(spark, docs, rows, empty, tmp_path):
    t = library()
    got = sorted(token_store.round_trip(docs, vocabulary()).collect(), key=lambda r: r.start)
    ids = {}
    for i, text in rows:
        own = np.array(t.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        ids.setdefault(i, []).append((len(own), zlib.crc32(own.tobytes())))
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i))
    end = 0
    for r in got:
        assert r.start == end
        end += r.n_tokens
        ids[r.doc_id].remove((r.n_tokens, r.ids_crc32))
    path = str(tmp_path / "store")
    token_store.write_store(docs, path, vocabulary(), shard_bytes=4000)
    found = token_store.fetch(spark, path, [5012, 5000, 77777])
    assert {k: v.tolist() for k, v in found.items()} == {5012: t.encode("a", add_special_tokens=False).ids + [2], 5000: [2]}
    assert token_store.round_trip(empty, vocabulary()).count() == 0


def test_perfect_hash_is_minimal():
    keys = np.random.default_rng(1).integers(-1 << 60, 1 << 60, 5000)
    table = token_store.PerfectHash.build(keys)
    again = token_store.PerfectHash.unpack(table.pack())
    assert sorted(again.slots(keys).tolist()) == list(range(len(keys)))


def katz_by_hand(rows):
    """The same model with dictionaries, every probability by its definition."""
    def tokens(text):
        return re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())) + [None]

    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    c1, c2 = collections.Counter(), collections.Counter()
    for (_, text), out in zip(rows, held):
        if not out:
            own = tokens(text)
            c1.update(own)
            c2.update(zip([b"<start>", *own], own))
    n, v = sum(c1.values()), len(c1)
    coc = [collections.Counter(c.values()) for c in (c1, c2)]
    d1, d2 = (katz.good_turing([c[r] for r in range(1, katz.K + 2)]) for c in coc)
    disc = lambda d, c: d[c] * c if c <= katz.K else c
    p1 = {w: disc(d1, c) / (n + 1) for w, c in c1.items()}
    unknown = 1 - sum(p1.values())
    after, total = collections.defaultdict(dict), collections.Counter()
    for (a, w), c in c2.items():
        after[a][w] = c
        total[a] += c
    alpha = {a: (1 - sum(disc(d2, c) for c in ws.values()) / (total[a] + 1)) / (1 - sum(p1[w] for w in ws))
             for a, ws in after.items()}

    def p(a, w):
        if w in after.get(a, ()):
            return disc(d2, after[a][w]) / (total[a] + 1)
        return alpha.get(a, 1.0) * p1.get(w, unknown)

    for a in [b"<start>", *list(c1)[:20]]:  # every distribution adds up to one
        assert abs(sum(p(a, w) for w in c1) + p(a, b"never seen") - 1) < 1e-9
    out = []
    for (i, text), h in zip(rows, held):
        own = tokens(text)
        base = sum(math.log10((c1[w] + 1) / (n + v + 1)) for w in own)
        score = sum(math.log10(p(a, w)) for a, w in zip([b"<start>", *own], own))
        out.append((i, h, len(own), sum(c1[w] > 0 for w in own), n, base, score))
    return out


@pytest.mark.parametrize("hot", [0.001, 0.05, 1.0])
def test_katz(docs, rows, monkeypatch, hot):
    monkeypatch.setattr(katz.hot_words, "__defaults__", (hot,))
    monkeypatch.setattr(katz, "BUCKET_TOKENS", 20_000)
    got = collected(katz.score_corpus(docs))
    want = sorted(katz_by_hand(rows), key=repr)
    key = lambda r: (repr(r[:5]), r[5])
    for a, b in zip(sorted(got, key=key), sorted(want, key=key)):
        assert a[:5] == b[:5]
        assert a[5] == pytest.approx(b[5], rel=1e-9) and a[6] == pytest.approx(b[6], rel=1e-9)
    out = [r for r in want if r[1]]
    assert sum(r[6] for r in out) > sum(r[5] for r in out)  # better than the base on held-out texts


def test_katz_without_training(spark, empty):
    assert katz.score_corpus(empty).count() == 0
    only = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    r = katz.score_corpus(spark.createDataFrame([(only, "a b")], "doc_id long, text string")).first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.score) == (3, 0, 0, 0.0)


def page_blocks(html):
    return "\n".join(extract.blocks(extract.parse(html))[0])


@pytest.mark.parametrize("html, text", [
    ("", ""), ("plain &amp; simple", "plain & simple"),
    ("<nav>menu</nav><article><h1>T</h1><p>one<p>two <b>bold\n</b> end<script>x</script></article><footer>f</footer>", "T\none\ntwo bold end"),
    ("<body><div class='ad-box'>buy</div><div id=main-part><p>text&nbsp;here</p></div><aside>side</aside></body>", "text here"),
    ("<main><div>a<div>b</div>c</div><form>f<input></form></main>", "a\nb\nc"),
    ("<article><header><h1>T</h1></header><p>x</p><section id=comments><article><p>troll</p></article></section></article>", "T\nx"),
    ("<article><ul><li>1<li>2</ul><table><tr><td>a<td>b</table><!-- c --></article>", "1\n2\na\nb"),
    ("<header>H</header><p>t</p><p hidden>h</p><p style='display: none'>n</p>", "t"),
    ("<p>unclosed <i>x", "unclosed x"), ("</p></div>odd<br>break", "odd break"),
])
def test_page_text(html, text):
    assert page_blocks(html) == text


def test_templates_go_and_copies_stay(spark):
    box = "<div><p>Call us any time</p><p>Open daily</p></div>"
    pages = [(n, f"http://host.example/{n}", f"<body>{box}<div><p>Story {n} {prose(20)}</p></div></body>") for n in range(12)]
    copy = f"<article><p>{PASSAGE}</p><div><a href=x>next</a> <a>more</a></div></article>"
    pages += [(100 + n, f"http://copies.example/{n}", copy.replace("</p>", f" {n}</p><p>shared words</p>")) for n in range(12)]
    pages += [(200, None, None), (201, "", ""), (None, "x", "<p>y</p>"), (0, *pages[0][1:])]
    frame = spark.createDataFrame([(*p, "t", 1) for p in pages], "page_id long, url string, html string, text string, key int")
    got = {r.page_id: r for r in extract.main_text(frame).collect()}
    for n in range(12):
        assert got[n].text.startswith(f"Story {n} ") and "Call" not in got[n].text
        assert got[100 + n].text == f"{PASSAGE} {n}\nshared words"
    assert (got[200].text, got[201].text, got[None].text) == ("", "", "y")
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert extract.main_text(frame.limit(0)).count() == 0


def test_counts_delete_unnamed_notices_inside_articles(spark):
    """Against a plain count: boxes without a telling name on a share of a host's pages."""
    def page(host, n):
        own = f"<p>Story {n} {prose(15)}</p><p>{PASSAGE}</p><blockquote>Quoted everywhere</blockquote>"
        boxes = {"all": "<div><p>Join our readers</p><p>Today only</p></div>",
                 "half": "<table><tr><td>Open</td><td>daily</td></tr></table>" if n % 2 else "",
                 "third": "<section><p>A series of three</p></section>" if n % 3 == 0 else "",
                 "list": "<ul><li><a href=x>next story</a></li></ul>" if n % 5 == 0 else ""}
        return "".join(["<article><h1>Daily</h1>", own, *boxes.values(), "</article>"]) if host == "many" else \
            f"<article>{own}{boxes['all']}</article>"

    rows = [(n, f"https://many.example/{n}", page("many", n)) for n in range(100)]
    rows += [(500 + n, f"https://few.example/{n}", page("few", n)) for n in range(9)]
    got = {r.page_id: r.text.split("\n") for r in extract.main_text(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for n in range(100):
        want = ["Daily", got[n][1], PASSAGE, "Quoted everywhere"]
        assert got[n] == want + (["A series of three"] if n % 3 == 0 else [])
        assert got[n][1].startswith(f"Story {n} ")
    for n in range(9):  # too few pages to tell
        assert got[500 + n][-2:] == ["Join our readers", "Today only"]


def test_deep_and_long_pages_take_time_by_their_size():
    import time

    def took(html):
        start = time.perf_counter()
        out = extract.blocks(extract.parse(html))
        return time.perf_counter() - start, out

    for n in (20_000, 40_000):
        seconds, (texts, spans, _) = took("<article>" + "<div>word " * n + "</div>" * n + "</article>")
        assert len(texts) == len(spans) == n and seconds < n / 8_000
        seconds, (texts, _, _) = took("<span>" * n + "<li>x</b>" * n)
        assert len(texts) == n and seconds < n / 4_000


def test_given_pages(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    import html as h

    for r in extract.main_text(pages).join(pages.select("page_id", "html"), "page_id").collect():
        article = re.search(r"<article>(.*)</article>", r.html, re.S)[1].replace("<br>", " ")
        parts = [" ".join(h.unescape(re.sub(r"<[^>]+>", "", x)).split()) for x in re.split(r"</?p>|</?h1>", article)]
        assert r.text == "\n".join(x for x in parts if x)


def test_repeated_units(docs, rows, empty):
    seen, own = collections.defaultdict(set), {}
    for i, t in rows:
        for _, _, u in units.units(t or "", 8):
            seen[u].add((i is None, i or 0))
    want = []
    for i, t in rows:
        text, gone, local = t or "", set(), set()
        for a, b, u in units.units(text, 8):
            first = min(seen[u])
            if u in local or (first != (i is None, i or 0) and not first[0]):
                gone.update(range(a, b))
            local.add(u)
        left = "".join(c for k, c in enumerate(text) if k not in gone)
        spans = sum(1 for k in gone if k - 1 not in gone)
        want.append((i, left, spans, len(gone)))
    got = [(r.doc_id, r.text, len(r.removed), r.n_removed_chars) for r in units.remove_repeats(docs).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    cleaned = {g[0]: g[1] for g in got}
    assert cleaned[5011] == ""  # the passage stands alone in a line and came before
    assert units.remove_repeats(empty).count() == 0


def test_repeated_passages_of_short_lines(spark):
    """Passages in lines or sentences under eight words go whole, wherever they begin and end."""
    r = random.Random(9)
    word = lambda: "".join(r.choice("fghij") for _ in range(7))
    lines = [" ".join(word() for _ in range(n)) for n in (3, 7, 1, 1, 5, 2, 6, 7, 4, 7, 3, 7, 2)]
    poem, speech = "\n".join(lines), ". ".join([*lines, " ".join(word() for _ in range(9)), "so be it"]) + "."
    alone = [" ".join(word() for _ in range(3)) for _ in range(8)]
    texts = [
        (1, f"{alone[0]}\n{poem}\n{alone[1]}"), (2, f"{alone[2]}\n{alone[3]}\n{poem}\n{alone[4]}"), (3, poem),
        (4, f"{alone[5]}. {speech}"), (5, f"{alone[6]}. {alone[7]}! {speech}"),
        (6, "\n".join(["ha"] * 20)), (7, "too short\nto be one"), (8, "too short\nto be one"),
    ]
    got = {x.doc_id: x for x in units.remove_repeats(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got[1].text == texts[0][1]
    assert got[2].text.split() == f"{alone[2]} {alone[3]} {alone[4]}".split() and got[3].text == ""
    assert got[5].text.split() == f"{alone[6]}. {alone[7]}!".split()
    assert got[6].text.split() == ["ha"] * 8  # the first occurrence stays
    assert got[7].text == got[8].text == "too short\nto be one"


def test_gradients_are_right():
    s = toxicity.Settings(window=5, word_slots=8, gram_slots=8, vectors=8, width=2, hidden=2, attention=2)
    net = toxicity.Network.fresh(s)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    words = toxicity.features([b"one", b"two", b"three"], s)
    index = np.array([[0, 1], [1, 2], [2, 0], [0, 0], [1, 0]])
    mask, label = np.array([[1, 1], [1, 1], [1, 1], [1, 0], [1, 0]], bool), np.array([1.0, 0.0])
    odds = (np.array([0.5, -0.2, 0.1]), np.linspace(-1, 1, len(words[1])))
    _, grads = net.gradients(index, words, odds, mask, label)
    for name in grads:
        flat, step = net.weights[name].reshape(-1), 1e-3
        for k in range(0, len(flat), max(1, len(flat) // 5)):
            old = flat[k]
            flat[k] = old + step
            up, _ = net.gradients(index, words, odds, mask, label)
            flat[k] = old - step
            down, _ = net.gradients(index, words, odds, mask, label)
            flat[k] = old
            assert (up - down) / (2 * step) == pytest.approx(float(grads[name].reshape(-1)[k]), abs=2e-3)


def test_windows_cover_texts():
    for n in (0, 1, 63, 64, 65, 200, 1000):
        starts = toxicity.window_starts(n, 64, 52)
        assert {i for s in starts for i in range(s, min(s + 64, n))} == set(range(n))


def test_evidence_counts_whole_texts(spark):
    """Against plain sets, long texts included; and a text's toxic words teach wherever they lie."""
    s = toxicity.Settings()
    texts = [(n % 2, " ".join(f"w{(n * 7 + k) % 97}" for k in range(3 + 40 * n)) + (" venom" * 3 if n % 2 else "")) for n in range(20)]
    texts += [(0, ""), (1, " ")]
    found = toxicity.count_evidence(spark.createDataFrame(texts, "label int, text string"), s)
    words, grams = np.zeros((2, s.word_slots), int), np.zeros((2, s.gram_slots), int)
    for label, text in texts:
        if text.strip():
            slots, own, _ = toxicity.features(toxicity.split(text.encode()), s)
            for k in set(slots.tolist()):
                words[label, k] += 1
            for k in set(own.tolist()):
                grams[label, k] += 1
    assert found.texts.tolist() == [10, 10] and (found.words == words).all() and (found.grams == grams).all()
    for at in (0, 700, 1499, 2990):
        text = [b"w%d" % (k % 97) for k in range(3000)]
        text[at] = b"venom"
        starts = toxicity.teaching_windows(text, found.odds(s.shrink, 1), s)
        assert len(starts) == s.bag and any(i <= at < i + s.window for i in starts)
    assert toxicity.teaching_windows(text[:64], found.odds(s.shrink, 1), s) == [0]


@pytest.fixture(scope="module")
def network(spark):
    return toxicity.learn(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"),
                          spark.read.parquet("/root/testdata/sf0.1/labels.parquet"))


def test_toxicity_on_held_out_rows(spark, network):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = toxicity.score(docs, network).join(labels, "doc_id").where("held_out").select("toxic", "score", "predicted").toPandas()
    hit = got[got.toxic == 1]
    assert hit.predicted.mean() > 0.85
    assert got[got.toxic == 0].predicted.mean() < 0.05
    order = got.score.rank()
    n1, n0 = len(hit), len(got) - len(hit)
    assert (order[got.toxic == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0) > 0.94


def test_toxicity_of_awkward_rows(spark, docs, rows, network, empty):
    got = toxicity.score(docs, network).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert {r.doc_id for r in got if r.held_out} == {
        i for i, _ in rows if i is not None and zlib.crc32(str(i).encode()) % 4 == 2}
    assert toxicity.score(empty, network).count() == 0
    none = toxicity.learn(docs, spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int"))
    assert {r.score for r in toxicity.score(docs, none).collect()} == {0.0}
    assert toxicity.keep_clean(docs, spark.createDataFrame([], "doc_id long, toxic int")).columns == docs.columns


def test_texts_without_words_get_the_share_of_all_labels(spark):
    """More than 2,000 labelled rows of each class: the bound on learned rows leaves the share alone."""
    texts = [(i, ("bad trash" if i % 5 == 0 else "good words") + f" {i % 7}") for i in range(14_000)]
    empty = [(20_000, None), (20_001, ""), (20_002, " \t\n ")]
    docs = spark.createDataFrame(texts + empty, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i, _ in texts], "doc_id long, toxic int")
    learned = [i for i, _ in texts if zlib.crc32(str(i).encode()) % 4 != 2]
    toxic = sum(i % 5 == 0 for i in learned)
    assert toxic > 2000 and len(learned) - toxic > 2000
    net = toxicity.learn(docs, labels)
    assert net.base_rate == pytest.approx(toxic / len(learned))
    got = {r.doc_id: r for r in toxicity.score(docs.where("doc_id >= 20000"), net).collect()}
    assert all(got[i].score == net.base_rate and got[i].predicted == 0 for i, _ in empty)
    kept = {r.doc_id for r in toxicity.keep_clean(docs, labels).collect()}
    assert {i for i, _ in empty} <= kept and not any(i % 5 == 0 for i in kept if i < 20_000)


def test_fast_scoring_equals_the_network(network):
    text = ("trash and other words " * 40 + "end").encode()
    scorer, s = toxicity.Scorer(network), network.settings
    words = toxicity.split(text)
    for start, logit in zip(toxicity.window_starts(len(words), s.window, s.stride), scorer.many([text])[1]):
        part = words[start:start + s.window]
        gates = network.project(network.inputs(toxicity.features(part, s)))[:, None]
        assert network.forward(gates, np.ones((len(part), 1), bool))[0][0] == pytest.approx(logit, abs=1e-3)


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for name, step in corpus_pipeline.STAGES[:-1]:
        left = step(spark, docs, SMALL)
        assert left.columns == docs.columns, name
        path = str(tmp_path / name)
        left.write.parquet(path)
        before, docs = docs.count(), spark.read.parquet(path)
        assert 0 < docs.count() <= before
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).select("doc_id").distinct().count() == docs.count()
    nothing = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for name, step in corpus_pipeline.STAGES:
        nothing = step(spark, nothing, SMALL) if name != "best_fit_packing" else nothing
        assert nothing.count() == 0


def test_free_name(docs):
    assert free_name(docs, "Score") == "Score_" and free_name(docs, "free") == "free"
