"""Which rows the pipeline's stages keep, against plain versions; null and repeated ids included."""

import random
import re

import pytest
import xxhash

import corpus_pipeline
from shelfline.llm import decontaminate, katz, simhash, toxicity
from shelfline.llm.queries import vocabulary

SMALL = "/root/testdata/sf0.001"
SPACE = re.compile(r"[\x20\x09-\x0D]+")
rng = random.Random(11)


def prose(n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="module")
def rows(spark):
    given = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    item = max((r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()), key=len)
    base, other = prose(120), prose(120)
    near = base.replace(base.split()[60], "changed")
    mine = [
        (None, base), (None, near), (None, prose(90)), (None, prose(80)), (None, item), (None, None), (None, other), (None, other),
        (7001, other), (7002, base), (7003, near), (7003, prose(70)), (7004, item + " " + prose(30)), (7004, prose(60)),
        (7005, ""), (7006, None), (7007, " \n"), (7008, other.replace(" ", "  ")), (7009, prose(3_000)), (7009, prose(50)),
    ]
    return given + mine


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "s", 1) for i, t in rows], "doc_id long, text string, sha string, hash int").repartition(4)


def kept(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


def exact_by_hand(rows):
    best = {}
    for i, t in rows:
        key = SPACE.sub(" ", t or "")
        best[key] = min(best.get(key, (True, 0)), (i is None, i or 0))
    seen, out = set(), []
    for i, t in rows:
        key = SPACE.sub(" ", t or "")
        if (i is None, i or 0) == best[key] and key not in seen:
            seen.add(key)
            out.append(key)
    return sorted(out), best


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_by_hand(rows):
    fps = [fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for a in range(len(rows)):
            for b in range(a):
                if label[a] != label[b] and (fps[a] ^ fps[b]).bit_count() <= 3:
                    low, high = sorted((label[a], label[b]))
                    label = [low if x == high else x for x in label]
                    changed = True
    return label


def contaminated_by_hand(text, items):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    words = cut(text)
    windows = {tuple(w[i:i + 10]) for w in map(cut, items) if w for i in range(max(1, len(w) - 9))}
    return any(tuple(words[i:i + n]) in windows for n in {len(w) for w in windows} for i in range(len(words) - n + 1))


def test_toxicity_stage(spark, rows):
    docs = frame(spark, rows)
    got = kept(corpus_pipeline.drop_toxic(spark, docs, SMALL))
    net = toxicity.learn(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    one = toxicity.Scorer(net)
    want = []
    for i, t in rows:
        owner, logit = one.many([(t or "").encode()])
        score = 1 / (1 + 2.718281828459045 ** -max(logit)) if len(owner) else net.base_rate
        want += [(i, t)] if score < 0.3 else []
    assert got == sorted(want, key=repr)
    assert 0 < len(want) < len(rows)


def test_exact_stage(spark, rows):
    texts, best = exact_by_hand(rows)
    got = kept(corpus_pipeline.drop_copies(spark, frame(spark, rows), SMALL))
    assert sorted(SPACE.sub(" ", t or "") for _, t in got) == texts
    assert all((i is None, i or 0) == best[SPACE.sub(" ", t or "")] for i, t in got)


def test_simhash_stage(spark, rows):
    docs = kept(corpus_pipeline.drop_copies(spark, frame(spark, rows), SMALL))
    label = groups_by_hand(docs)
    got = kept(corpus_pipeline.drop_near_copies(spark, frame(spark, docs), SMALL))
    left = {}
    for row in got:
        group = label[docs.index(row)]
        assert group not in left  # one of each group
        left[group] = row
    assert set(left) == set(label)
    for group, (i, _) in left.items():
        ids = [j for (j, _), g in zip(docs, label) if g == group and j is not None]
        assert i == (min(ids) if ids else None)


def test_rows_without_an_id_go_for_themselves_only(spark):
    texts = [prose(60) for _ in range(3)]
    docs = frame(spark, [(1, texts[0]), (None, texts[0]), (None, texts[1]), (None, texts[2])])
    assert kept(simhash.keep_one(docs)) == sorted([(1, texts[0]), (None, texts[1]), (None, texts[2])], key=repr)
    items = spark.createDataFrame([(1, texts[1])], "item_id long, text string")
    assert kept(decontaminate.keep_clean(docs, items)) == sorted([(1, texts[0]), (None, texts[0]), (None, texts[2])], key=repr)


def test_decontamination_stage(spark, rows):
    items = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    want = sorted(((i, t) for i, t in rows if not contaminated_by_hand(t, items)), key=repr)
    got = corpus_pipeline.drop_benchmark(spark, frame(spark, rows), SMALL)
    assert got.columns == ["doc_id", "text", "sha", "hash"]
    assert kept(got) == want and len(want) < len(rows)


def test_packing_stage(spark, rows):
    import tokenizers
    library = tokenizers.Tokenizer.from_file(vocabulary())
    some = [(i, t) for i, t in dict(rows).items() if i is not None]
    got = corpus_pipeline.pack(spark, frame(spark, some), SMALL).collect()
    length = {}
    for r in got:
        length[r.doc_id] = length.get(r.doc_id, 0) + r.length
    assert length == {i: len(library.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in some}
    taken = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == taken.get(r.sequence_id, 0)
        taken[r.sequence_id] = r.offset + r.length
    assert max(taken.values()) <= 4096


def test_short_texts_in_many_partitions(spark):
    words = [prose(1) for _ in range(300)]
    texts = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 2)))) for i in range(1_000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    def scores(n):
        return sorted((r.doc_id, r.held_out, r.n_tokens, r.n_known, round(r.score, 9)) for r in katz.score_corpus(docs.repartition(n)).collect())
    assert scores(40) == scores(1)
