"""Windows as a table: hot passages, windows in blocks, windows without postings."""

import random

import pytest

from shelfline.llm import decontaminate


def spans(docs, items, size):
    """(doc, item) -> places of any window of the item, overlapping ones joined, word by word."""
    out = set()
    for doc_id, text in docs:
        own = decontaminate.words((text or "").encode())
        for item_id, item in items:
            terms = decontaminate.words((item or "").encode())
            n = min(size, len(terms))
            windows = {tuple(terms[i:i + n]) for i in range(len(terms) - n + 1)} if n else set()
            last = None
            for s in range(len(own)):
                if n and tuple(own[s:s + n]) in windows:
                    if last and s <= last[1]:
                        last = (last[0], s + n)
                    else:
                        if last:
                            out.add((doc_id, item_id, *last))
                        last = (s, s + n)
            if last:
                out.add((doc_id, item_id, *last))
    return out


@pytest.mark.parametrize("block_words", [1, 12, 2_000_000])
def test_places_of_hot_passages(spark, block_words):
    rng = random.Random(3)
    prose = lambda n: " ".join(rng.choice("alpha beta gamma delta eps zeta eta".split()) for _ in range(n))
    shared = prose(30)
    items = [(i, shared if i % 3 == 0 else prose(12)) for i in range(24)]  # a third share one passage
    items += [(100, "word that nobody wrote"), (101, "beta"), (102, ""), (103, None), (None, prose(9))]
    docs = [(i, prose(rng.randrange(60))) for i in range(40)]
    docs += [(50, shared), (51, f"{prose(5)} {shared} {shared}"), (52, ""), (53, None), (54, "beta " * 30)]
    docs_df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("item_id", "coalesce(text, '') AS text")
    index = decontaminate.build_index(docs_df, decontaminate.test_terms(bench), shard_words=200)
    ids = index.selectExpr("shard", "posexplode(doc_ids) AS (ord, doc_id)")
    found = decontaminate.matches(index, bench, 4, block_words=block_words).join(ids, ["shard", "ord"])
    rows = [(r.doc_id, r.item_id, r.start, r.end) for r in found.collect()]
    assert len(rows) == len(set(rows))
    assert set(rows) == spans(docs, items, 4)


def test_bitmap_is_the_union_of_all_tasks(spark):
    texts = [f"term{i} other{i}" for i in range(200)]
    bench = spark.createDataFrame([(t,) for t in texts], "text string").repartition(7)
    want = {decontaminate.term(w) % decontaminate.SLOTS for t in texts for w in t.encode().split()}
    bits = decontaminate.np.unpackbits(decontaminate.np.frombuffer(decontaminate.test_terms(bench), "u1"))
    assert set(bits.nonzero()[0].tolist()) == want
