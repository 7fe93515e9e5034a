"""A word bigram model with Katz backoff, learned from and evaluated on whole corpora.

Counts up to ``K`` are discounted after Good and Turing; what a context's discounted
probabilities leave is given to the words not seen after it, in proportion to their unigram
probabilities and normalised exactly. Unigrams are discounted likewise and leave their rest to
one unknown word. In every context and in the unigrams one unseen event is counted, so that
something is left even where all counts are large:

    p(w | v) = d(c(v,w)) c(v,w) / (c(v) + 1)    where c(v,w) > 0
             = alpha(v) p(w)                     elsewhere
    p(w)     = d'(c(w)) c(w) / (N + 1)           where c(w) > 0, else what they leave

Work is dealt by words. A token (v, w) goes to the bucket of w, where both c(v,w) and c(w) are
known once all tokens of the corpus have arrived; it then adds its share of the document's
score, including that of w as the next token's context. Only the tokens of held-out texts that
a context has not seen need a second, much smaller step for alpha(v). A word that makes up
more than ``HOT`` of all tokens would overload its bucket, so such words (at most 1/HOT) are
counted first; pairs of two of them are scored where they are read, pairs with one of them go
to the other word's bucket.

Words are known by 64-bit hashes. Tables are staged Parquet, cut by kind and bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from .common import documents, stage

K = 5  # the largest count that is discounted
HOT = 0.001
START, END = 1, 2
BLOCK_WORDS = 1_500_000
BUCKET_TOKENS = 2_000_000
CACHE_WORDS = 200_000
TABLE = "kind string, bucket long, block long, payload binary, ids array<long>"


def _small(a: np.ndarray) -> np.ndarray:
    """Whole numbers from 0 on in the narrowest type that holds them."""
    if a.dtype.kind not in "iu" or not len(a) or a.min() < 0:
        return a
    return a.astype(np.min_scalar_type(int(a.max())))


def freeze(**arrays: np.ndarray) -> bytes:
    """Arrays of any lengths as one compressed value."""
    rows = [(k, (v := np.ascontiguousarray(_small(np.asarray(a)))).dtype.str, v.tobytes()) for k, a in arrays.items()]
    columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.binary()))]
    batch = pa.RecordBatch.from_arrays(columns, ["name", "type", "data"])
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))
    with pa.ipc.new_stream(sink, batch.schema, options=options) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def thaw(payload: bytes) -> dict[str, np.ndarray]:
    """The arrays of ``freeze``, whole numbers in the types it chose, but never unsigned 64-bit ones."""
    out = {}
    for row in pa.ipc.open_stream(payload).read_all().to_pylist():
        a = np.frombuffer(row["data"], row["type"])
        out[row["name"]] = a.astype(np.int64) if a.dtype == np.uint64 else a
    return out


def _runs(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values and lengths of the runs of equal values."""
    first = np.flatnonzero(np.r_[True, a[1:] != a[:-1]]) if len(a) else np.empty(0, np.int64)
    return a[first], np.diff(np.r_[first, len(a)])


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(7)) == 2, F.lit(False))


class Reader:
    """Texts to arrays of word hashes, the end included."""

    def __init__(self):
        self.cache: dict[bytes, int] = {}

    def ids(self, text: bytes) -> np.ndarray:
        words = text.lower().split()
        cache = self.cache
        try:
            found = [*map(cache.__getitem__, words)]
        except KeyError:
            if len(cache) > CACHE_WORDS:
                cache.clear()
            for w in set(words).difference(cache):
                cache[w] = (xxhash.xxh64_intdigest(w) >> 1) | 8  # positive, and none of the marks
            found = [*map(cache.__getitem__, words)]
        found.append(END)
        return np.array(found, np.int64)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, np.ndarray, np.ndarray]]:
    """Documents in blocks: ids, held-out marks, tokens one after the other, lengths."""
    reader, ids, held, tokens, size = Reader(), [], [], [], 0
    for batch in batches:
        for doc_id, out, text in zip(batch["doc_id"].to_pylist(), batch["held_out"].to_pylist(),
                                     batch["text"].cast(pa.binary()).to_pylist()):
            ids.append(doc_id)
            held.append(out)
            tokens.append(reader.ids(text))
            size += len(tokens[-1])
            if size >= BLOCK_WORDS:
                yield ids, held, np.concatenate(tokens), np.array([*map(len, tokens)])
                ids, held, tokens, size = [], [], [], 0
    if ids:
        yield ids, held, np.concatenate(tokens), np.array([*map(len, tokens)])


@dataclass(frozen=True)
class Hot:
    """Frequent words with exact counts, and the exact counts of pairs of them."""

    words: np.ndarray  # sorted
    counts: np.ndarray
    pairs: np.ndarray  # sorted: place of v * len(words) + place of w
    pair_counts: np.ndarray

    def place(self, ids: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.words, ids), len(self.words) - 1)
        return np.where(self.words[at] == ids, at, -1)

    def pair_count(self, v: np.ndarray, w: np.ndarray) -> np.ndarray:
        if not len(self.pairs):
            return np.zeros(len(v), np.int64)
        key = v * len(self.words) + w
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.pair_counts[at], 0)


def _before(tokens: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    previous = np.r_[np.int64(START), tokens[:-1]]
    previous[np.cumsum(lengths)[:-1]] = START
    return previous


def hot_words(train: DataFrame, share: float = HOT) -> tuple[Hot, int]:
    """Words with a large share of the training tokens, and the number of these tokens.

    A word with that share of all tokens has it in some block, so each block names its own
    candidates; their exact counts take a second look.
    """
    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, tokens, _ in _blocks(batches):
            own, n = np.unique(tokens, return_counts=True)
            often = n >= share * len(tokens)
            yield pa.RecordBatch.from_pydict({"word": np.r_[0, own[often]], "n": np.r_[len(tokens), n[often]]})

    rows = train.mapInArrow(candidates, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    most = rows.orderBy(F.desc("n"), "word").limit(int(1 / share) + 1).collect()  # one row is the total
    total = next((r.n for r in most if r.word == 0), 0)
    words = np.array(sorted({START, END, *(r.word for r in most if r.word)}), np.int64)

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = Hot(words, np.zeros(len(words), np.int64), words[:0], words[:0])
        for _, _, tokens, lengths in _blocks(batches):
            w, v = hot.place(tokens), hot.place(_before(tokens, lengths))
            single, n = np.unique(w[w >= 0], return_counts=True)
            pair, m = np.unique((v * len(words) + w)[(v >= 0) & (w >= 0)], return_counts=True)
            start = np.searchsorted(words, START)
            yield pa.RecordBatch.from_pydict({
                "pair": np.r_[np.full(len(single) + 1, False), np.full(len(pair), True)],
                "key": np.r_[single, start, pair], "n": np.r_[n, len(lengths), m],
            })

    rows = train.mapInArrow(exact, "pair boolean, key long, n long").groupBy("pair", "key").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(len(words), np.int64)
    for r in rows:
        if not r.pair:
            counts[r.key] = r.n
    pairs = np.array(sorted((r.key, r.n) for r in rows if r.pair), np.int64).reshape(-1, 2)
    return Hot(words, counts, pairs[:, 0].copy(), pairs[:, 1].copy()), total


def _sums(doc: np.ndarray, n_docs: int, r: np.ndarray, cw: np.ndarray) -> dict[str, np.ndarray]:
    """Per document: what its tokens add, apart from the discounts. ``r`` is c(v,w), ``cw`` c(w)."""
    base = np.log10(cw + 1)
    often = np.where(r > K, np.log10(np.maximum(r, 1)), 0)
    out = {"base": np.bincount(doc, base, n_docs), "often": np.bincount(doc, often, n_docs),
           "known": np.bincount(doc, cw > 0, n_docs).astype(np.int64)}
    for k in range(1, K + 1):
        out[f"h{k}"] = np.bincount(doc, r == k, n_docs).astype(np.int64)
    return out


def _dealt(docs: DataFrame, hot: Hot, buckets: int) -> DataFrame:
    """Tokens in compressed arrays by bucket, and what each block can settle by itself."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        for ids, held, tokens, lengths in _blocks(batches):
            doc = np.repeat(np.arange(len(ids), dtype=np.int64), lengths)
            before = _before(tokens, lengths)
            hw, hv = hot.place(tokens), hot.place(before)
            out = np.array(held, bool)
            both = (hw >= 0) & (hv >= 0)
            r, cw = hot.pair_count(hv[both], hw[both]), hot.counts[hw[both]]
            sums = _sums(doc[both], len(ids), r, cw)
            new = np.flatnonzero(r == 0)
            spot = xxhash.xxh64_intdigest(number.to_bytes(8, "little")) % buckets
            rows = [("docs", spot, freeze(n=lengths, held=out), ids),
                    ("stat", spot, freeze(doc=np.arange(len(ids)), **sums), None)]
            if len(new):
                rows.append(("unseen", spot, freeze(
                    doc=doc[both][new], v=before[both][new], cw=cw[new]), None))
            left = np.flatnonzero(~both)
            key = np.where(hw[left] < 0, tokens[left], before[left])
            bucket = (key >> 20) % buckets
            del hw, hv, both, r, cw, key
            order = np.lexsort((doc[left], tokens[left], bucket))
            left, bucket = left[order], bucket[order]
            cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(left) else []
            for a, b in zip(cuts, [*cuts[1:], len(left)]):
                at = left[a:b]
                w, n = _runs(tokens[at])
                v, place = np.unique(before[at], return_inverse=True)
                rows.append(("tokens", int(bucket[a]), freeze(
                    w=w, n=n, v=v, place=place, doc=doc[at], train=np.packbits(~out)), None))
            for i in range(0, len(rows), 16):
                part = rows[i:i + 16]
                yield pa.RecordBatch.from_arrays([
                    pa.array([x[0] for x in part]), pa.array([x[1] for x in part], pa.int64()),
                    pa.array([number] * len(part), pa.int64()), pa.array([x[2] for x in part], pa.binary()),
                    pa.array([x[3] for x in part], pa.list_(pa.int64())),
                ], ["kind", "bucket", "block", "payload", "ids"])
            number += 1

    return docs.mapInArrow(run, TABLE)


def _settle(bucket: int, parts: list[tuple[int, dict]], hot: Hot) -> Iterator[tuple]:
    """All tokens of a bucket: count them, and turn them into tables and sums per document."""
    w = np.concatenate([np.repeat(p["w"], p["n"]) for _, p in parts])
    v = np.concatenate([p["v"][p["place"]] for _, p in parts])
    train = np.concatenate([np.unpackbits(p["train"])[p["doc"]] for _, p in parts])
    sizes = [len(p["doc"]) for _, p in parts]
    order = np.lexsort((v, w))
    w_, v_ = w[order], v[order]
    fresh_w = np.r_[True, w_[1:] != w_[:-1]]
    fresh = fresh_w | np.r_[True, v_[1:] != v_[:-1]]
    group = np.empty(len(w), np.int32)
    group[order] = np.cumsum(fresh, dtype=np.int32) - 1
    gw, gv = w_[fresh], v_[fresh]
    first = fresh_w[fresh]
    del w, w_, v_, order, fresh, fresh_w
    c2 = np.bincount(group, train, len(gw)).astype(np.int64)
    word = np.cumsum(first) - 1
    uw = gw[first]
    c1 = np.bincount(word, c2, len(uw)).astype(np.int64)
    at = hot.place(uw)
    own = at < 0
    c1 = np.where(own, c1, hot.counts[np.maximum(at, 0)])
    cg = c1[word]
    seen = c2 > 0
    yield "unigrams", bucket, freeze(w=uw[own & (c1 > 0)], n=c1[own & (c1 > 0)])
    own_w, n_w = _runs(gw[seen])
    yield "bigrams", bucket, freeze(w=own_w, n_w=n_w, v=gv[seen], n=c2[seen], cw=cg[seen])
    begin = 0
    for (block, p), size in zip(parts, sizes):
        mine = slice(begin, begin + size)
        begin += size
        r, cw = c2[group[mine]], cg[group[mine]]
        docs, dense = np.unique(p["doc"], return_inverse=True)
        yield "stat", block, freeze(doc=docs, **_sums(dense, len(docs), r, cw))
        new = np.flatnonzero(r == 0)
        if len(new):
            yield "unseen", block, freeze(doc=p["doc"][new], v=v[mine][new], cw=cw[new])


def _tables(docs: DataFrame, hot: Hot, buckets: int) -> DataFrame:
    def emit(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array([x[0] for x in rows]), pa.array([x[1] for x in rows], pa.int64()),
            pa.array([x[2] for x in rows], pa.int64()), pa.array([x[3] for x in rows], pa.binary()),
            pa.array([x[4] for x in rows], pa.list_(pa.int64())),
        ], ["kind", "bucket", "block", "payload", "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, dict]] = []
        now = None

        def close() -> Iterator[pa.RecordBatch]:
            for kind, key, payload in _settle(now, held, hot):
                block = key if kind in ("stat", "unseen") else -1
                yield emit([(kind, now, block, payload, None)])

        for batch in batches:
            for row in batch.to_pylist():
                if row["kind"] != "tokens":
                    yield emit([(row["kind"], row["bucket"], row["block"], row["payload"], row["ids"])])
                    continue
                if row["bucket"] != now:
                    if held:
                        yield from close()
                    held, now = [], row["bucket"]
                held.append((row["block"], thaw(row["payload"])))
        if held:
            yield from close()

    dealt = _dealt(docs, hot, buckets).repartition(buckets, "bucket").sortWithinPartitions("bucket", "kind", "block")
    return stage(dealt.mapInArrow(run, TABLE), "katz", "kind")


def good_turing(n: list[int]) -> np.ndarray:
    """Discounts of counts 0..K from numbers of things seen 1..K+1 times; 1 where undefined."""
    d = np.ones(K + 1)
    if not n[0] or n[0] <= (K + 1) * n[K]:
        return d
    ratio = (K + 1) * n[K] / n[0]
    for r in range(1, K + 1):
        if n[r - 1]:
            value = ((r + 1) * n[r] / (r * n[r - 1]) - ratio) / (1 - ratio)
            if 0 < value < 1:
                d[r] = value
    return d


@dataclass(frozen=True)
class Model:
    hot: Hot
    tokens: int  # N
    words: int  # V
    uni: np.ndarray  # discounts
    bi: np.ndarray
    unknown: float

    def unigram(self, c: np.ndarray) -> np.ndarray:
        c = np.asarray(c, np.int64)
        return np.where(c > 0, self.uni[np.where(c <= K, c, 0)] * c / (self.tokens + 1), self.unknown)

    def mass(self, c: np.ndarray) -> np.ndarray:
        """Discounted counts of seen pairs."""
        return self.bi[np.where(c <= K, c, 0)] * c


def _figures(table: DataFrame, hot: Hot, tokens: int) -> Model:
    """Counts of counts of both orders, summed over the buckets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for kind, payload in zip(batch["kind"].to_pylist(), batch["payload"].to_pylist()):
                n = np.bincount(np.minimum(thaw(payload)["n"], K + 2), minlength=K + 3)
                yield pa.RecordBatch.from_pydict({"kind": [kind] * (K + 3), "r": [*range(K + 3)], "n": n.astype(np.int64)})

    rows = table.where("kind IN ('unigrams', 'bigrams')").select("kind", "payload") \
        .mapInArrow(run, "kind string, r long, n long").groupBy("kind", "r").agg(F.sum("n").alias("n")).collect()
    words = hot.counts[hot.words != START]
    own = {"unigrams": words, "bigrams": hot.pair_counts}
    n = {k: np.bincount(np.minimum(c[c > 0], K + 2), minlength=K + 3) for k, c in own.items()}
    for r in rows:
        n[r.kind][r.r] += r.n
    uni, bi = (good_turing(n[k][1:K + 2].tolist()) for k in ("unigrams", "bigrams"))
    lost = sum((1 - uni[r]) * r * int(n["unigrams"][r]) for r in range(1, K + 1))
    return Model(hot, tokens, int(n["unigrams"][1:].sum()), uni, bi, (1 + lost) / (tokens + 1))


def _contexts(table: DataFrame, model: Model, wanted: bytes, slots: int) -> DataFrame:
    """``v, gain``: log10 of alpha(v) (c(v) + 1), for contexts whose bit is set in ``wanted``."""
    hot = model.hot

    def batch_of(v: np.ndarray, n: np.ndarray, cw: np.ndarray) -> pa.RecordBatch:
        own, at = np.unique(v, return_inverse=True)
        return pa.RecordBatch.from_pydict({
            "v": own, "n": np.bincount(at, n, len(own)), "mass": np.bincount(at, model.mass(n), len(own)),
            "below": np.bincount(at, model.unigram(cw), len(own)),
        })

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(np.frombuffer(wanted, np.uint8)).astype(bool)
        for batch in batches:
            for payload in batch["payload"].to_pylist():
                p = thaw(payload)
                v = p["v"].astype(np.int64)  # a block's largest may need a byte only
                keep = bits[(v >> 8) % slots]
                yield batch_of(v[keep], p["n"][keep], p["cw"][keep])

    schema = "v long, n double, mass double, below double"
    rows = table.where("kind = 'bigrams'").select("payload").mapInArrow(run, schema)
    size = len(hot.words)
    pairs = batch_of(hot.words[hot.pairs // size], hot.pair_counts, hot.counts[hot.pairs % size])
    rows = rows.unionByName(table.sparkSession.createDataFrame(
        [tuple(r.values()) for r in pairs.to_pylist()], schema))  # a row for each hot word at most
    sums = rows.groupBy("v").agg(*[F.sum(c).alias(c) for c in ("n", "mass", "below")])
    left = 1 - F.col("mass") / (F.col("n") + 1)
    return sums.select("v", F.log10(left / (1 - F.col("below")) * (F.col("n") + 1)).alias("gain"))


def _unseen(table: DataFrame, model: Model) -> DataFrame:
    """``block, doc, v, n, backed``: tokens that their context has not seen, with their log10 p(w)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, payload in zip(batch["block"].to_pylist(), batch["payload"].to_pylist()):
                p = thaw(payload)
                yield pa.RecordBatch.from_pydict({
                    "block": np.full(len(p["v"]), block, np.int64), "doc": p["doc"].astype(np.int32), "v": p["v"].astype(np.int64),
                    "backed": np.log10(model.unigram(p["cw"])),
                })

    rows = table.where("kind = 'unseen'").select("block", "payload")
    return rows.mapInArrow(run, "block long, doc int, v long, backed double")


def _per_document(table: DataFrame, model: Model) -> DataFrame:
    """Sums over all buckets, one row per document."""
    hot = model.hot
    start, end = (float(np.log10(hot.counts[np.searchsorted(hot.words, m)] + 1)) for m in (START, END))
    logs = [float(np.log10(max(model.bi[r] * r, 1e-300))) for r in range(K + 1)]
    per_token = float(np.log10(model.tokens + model.words + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(ids, head, sums) -> pa.RecordBatch:
            n = head["n"].astype(np.int64)
            return pa.RecordBatch.from_pydict({
                "block": np.full(len(n), now, np.int64), "doc": np.arange(len(n), dtype=np.int32), "doc_id": pa.array(ids, pa.int64()),
                "held_out": head["held"], "n_tokens": n, "n_known": sums["known"].astype(np.int64),
                "base_score": sums["base"] - per_token * n,
                # each token's context has its count in the denominator: the start, and all but the end
                "seen": sums["often"] - (sums["base"] - end + start) + sum(logs[k] * sums[f"h{k}"] for k in range(1, K + 1)),
            })

        now, ids, head, sums = None, None, None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["kind"] == "docs":  # comes first in its block
                    if head is not None:
                        yield close(ids, head, sums)
                    now, ids, head = row["block"], row["ids"], thaw(row["payload"])
                    sums = {k: np.zeros(len(ids)) for k in ("base", "often", "known", *(f"h{i}" for i in range(1, K + 1)))}
                    continue
                p = thaw(row["payload"])
                for k, total in sums.items():
                    np.add.at(total, p["doc"], p[k])
        if head is not None:
            yield close(ids, head, sums)

    rows = table.where("kind IN ('docs', 'stat')").select("kind", "block", "payload", "ids")
    return rows.repartition("block").sortWithinPartitions("block", "kind").mapInArrow(
        run, "block long, doc int, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, seen double"
    )


def score_corpus(docs: DataFrame, slots: int = 1 << 24) -> DataFrame:
    """Learn from the documents that are not held out and score all of them.

    Columns: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``. A null or
    empty text is one token, the end. Rows that repeat an id are read one by one; a null id is
    not held out; other columns are ignored. Without training rows the unknown word has
    probability 1.
    """
    clean = documents(docs).withColumn("held_out", is_held_out(F.col("doc_id")))
    hot, tokens = hot_words(clean.where("NOT held_out"))
    all_tokens = max(tokens, 1) * 7 // 6
    buckets = max(1, -(-all_tokens // BUCKET_TOKENS))
    table = _tables(clean, hot, buckets)
    model = _figures(table, hot, tokens)
    unseen = _unseen(table, model)
    bits = np.zeros(slots, bool)
    asked = unseen.select(F.pmod(F.shiftright("v", 8), F.lit(slots)).alias("slot")).distinct()
    bits[[r.slot for r in asked.toLocalIterator()]] = True  # of fixed size, whatever is asked
    gains = stage(_contexts(table, model, np.packbits(bits).tobytes(), slots), "contexts")
    hot_ids = hot.words.tolist()
    frequent = F.broadcast(gains.where(F.col("v").isin(hot_ids)))
    is_hot = F.col("v").isin(hot_ids)
    gained = unseen.where(is_hot).join(frequent, "v", "left").unionByName(
        unseen.where(~is_hot).join(gains.where(~is_hot), "v", "left"))
    extra = gained.groupBy("block", "doc").agg(F.sum(F.col("backed") + F.coalesce("gain", F.lit(0.0))).alias("extra"))
    rows = _per_document(table, model).join(extra, ["block", "doc"], "left")
    return rows.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score",
        (F.col("seen") + F.coalesce("extra", F.lit(0.0))).alias("score"),
    )
