"""Benchmark passages in documents, found through a positional inverted index.

The index is cut into shards of documents, so that all postings a phrase needs lie in one row
of a staged table, and no term, however frequent, meets in one task. Benchmark windows are a
table as well: a join on the term that is rarest in the corpus brings each different window to
the shards that may hold it, where it is asked in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .common import documents, free_name, join_classes, stage, text_hash

_KEEP = {*range(48, 58), *range(97, 123), *range(128, 256)}
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b in _KEEP else 32 for b in range(256))
SLOTS = 1 << 22
SHARD = "shard long, doc_ids array<long>, n_words array<int>, terms array<long>, counts array<int>, postings binary"
FOUND = "shard long, ord int, window long, start long, end long, kind string"
CACHE_WORDS = 300_000
BATCH_WINDOWS = 10_000
CANDIDATES = 2_000_000  # starts that are held at a time


def words(text: bytes) -> list[bytes]:
    """Lower-cased runs of letters, digits and characters beyond ASCII."""
    return text.translate(TABLE).split()


def term(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word) or 1


def test_terms(benchmark: DataFrame) -> bytes:
    """A bit for each hashed term of the benchmark: of fixed size, however large that is.

    Tasks send whole words of their bitmaps, which Spark combines: at most ``SLOTS / 64`` rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(SLOTS, bool)
        for batch in batches:
            for text in batch["text"].cast(pa.binary()).to_pylist():
                bits[[term(w) % SLOTS for w in words(text)]] = True
        parts = np.packbits(bits).view(np.int64)
        at = np.flatnonzero(parts)
        yield pa.RecordBatch.from_pydict({"at": pa.array(at, pa.int32()), "bits": pa.array(parts[at])})

    found = benchmark.mapInArrow(run, "at int, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    parts = np.zeros(SLOTS // 64, np.int64)
    parts[found["at"].to_numpy()] = found["bits"].to_numpy()
    return parts.tobytes()


def _shard_row(number: int, ids: list, terms: list[np.ndarray]) -> dict:
    """Postings of one shard. Each document starts one place after the end of the one before."""
    gap = np.zeros(1, np.int64)
    flat = np.concatenate([x for t in terms for x in (t, gap)])
    at = np.flatnonzero(flat)
    order = np.argsort(flat[at], kind="stable")
    places, sorted_terms = at[order].astype("<u4"), flat[at][order]
    own, first, counts = np.unique(sorted_terms, return_index=True, return_counts=True)
    steps = np.diff(places, prepend=np.uint32(0)).astype("<u4")  # wraps at a new term, undone by the sum
    return {"shard": number, "doc_ids": ids, "n_words": [len(t) for t in terms], "terms": own, "counts": counts,
            "postings": steps.tobytes()}


def build_index(docs: DataFrame, bits: bytes, shard_words: int = 2_000_000) -> DataFrame:
    """The staged index: positions of every term whose bit is set, for every document."""
    schema = pa.schema([
        ("shard", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("n_words", pa.list_(pa.int32())),
        ("terms", pa.list_(pa.int64())), ("counts", pa.list_(pa.int32())), ("postings", pa.binary()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(np.frombuffer(bits, np.uint8)).tobytes()
        cache: dict[bytes, int] = {}
        number, ids, terms, held = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].cast(pa.binary()).to_pylist()):
                own = words(text)
                try:
                    found = [*map(cache.__getitem__, own)]
                except KeyError:
                    if len(cache) > CACHE_WORDS:
                        cache.clear()
                    for w in set(own).difference(cache):
                        t = term(w)
                        cache[w] = t if wanted[t % SLOTS] else 0
                    found = [*map(cache.__getitem__, own)]
                ids.append(doc_id)
                terms.append(np.array(found, np.uint64).view(np.int64))
                held += len(own) + 1
                if held >= shard_words:
                    yield pa.RecordBatch.from_pylist([_shard_row(number, ids, terms)], schema)
                    number, ids, terms, held = number + 1, [], [], 0
        if ids:
            yield pa.RecordBatch.from_pylist([_shard_row(number, ids, terms)], schema)

    return stage(documents(docs).mapInArrow(run, SHARD), "index")


class Postings:
    """One shard's index, ready for intersections."""

    def __init__(self, shard: pa.Table):
        n_words, terms, counts, postings = (
            shard[c].combine_chunks()[0] for c in ("n_words", "terms", "counts", "postings")
        )
        self.terms = terms.values.to_numpy()
        self.counts = counts.values.to_numpy().astype(np.int64)
        self.places = np.cumsum(np.frombuffer(postings.as_buffer(), "<u4"), dtype=np.uint32).astype(np.int64)
        self.first = np.cumsum(np.r_[0, self.counts])
        self.key = (np.repeat(np.arange(len(self.terms)), self.counts) << 36) + self.places
        lengths = n_words.values.to_numpy().astype(np.int64)
        self.base = np.cumsum(np.r_[0, lengths + 1])

    def lookup(self, terms: np.ndarray) -> np.ndarray:
        if not len(self.terms):
            return np.full(terms.shape, -1)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def starts(self, which: np.ndarray, shift: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and offset-adjusted postings of one term per row."""
        counts = self.counts[which]
        rows = np.repeat(np.arange(len(which)), counts)
        inner = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
        return rows, self.places[self.first[which][rows] + inner] - shift[rows]

    def nearest(self, which: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Distance from each place to its term's nearest posting."""
        at = np.searchsorted(self.key, (which << 36) + place)
        low, high = self.first[which], self.first[which + 1]
        right = np.where(at < high, np.abs(self.places[np.minimum(at, len(self.places) - 1)] - place), 1 << 40)
        left = np.where(at > low, np.abs(place - self.places[np.maximum(at - 1, 0)]), 1 << 40)
        return np.minimum(left, right)


def _search(index: Postings, windows: np.ndarray, lengths: np.ndarray, slop: int | None):
    """(window, start, exact) of all matches. ``windows`` is padded with zeros."""
    at = index.lookup(windows)
    at[windows == 0] = -2
    whole = np.flatnonzero(~(at == -1).any(axis=1))
    weight = np.where(at[whole] >= 0, index.counts[np.maximum(at[whole], 0)], 1 << 40) if len(whole) else None
    out = []
    if not len(whole):
        return out
    order = np.argsort(weight, axis=1, kind="stable")
    load = np.cumsum(weight[np.arange(len(whole)), order[:, 0]])
    for part in np.split(np.arange(len(whole)), np.searchsorted(load, np.arange(CANDIDATES, load[-1], CANDIDATES))):
        if not len(part):
            continue
        mine, by = whole[part], order[part]
        rare = by[:, 0]
        rows, start = index.starts(at[mine, rare], rare)
        anchors = (rows, start)
        for k in range(1, windows.shape[1]):
            offset = by[rows, k]
            which = at[mine[rows], offset]
            want = ((np.maximum(which, 0)) << 36) + start + offset
            place = np.minimum(np.searchsorted(index.key, want), len(index.key) - 1)
            good = (which == -2) | ((start + offset >= 0) & (index.key[place] == want))
            rows, start = rows[good], start[good]
        out.append((mine[rows], start, np.ones(len(rows), bool)))
        if slop is not None:
            rows, start = anchors
            place = start + rare[rows]
            reach = lengths[mine[rows]] - 1 + slop
            good = np.ones(len(rows), bool)
            doc = np.searchsorted(index.base, place, "right")
            for k in range(1, windows.shape[1]):
                which = at[mine[rows], by[rows, k]]
                gap = index.nearest(np.maximum(which, 0), place)
                good &= (which == -2) | (gap <= reach)
            inside = (place - index.base[doc - 1] >= 0) & (place < index.base[doc] - 1)
            good &= inside
            out.append((mine[rows[good]], place[good], np.zeros(int(good.sum()), bool)))
    return out


def test_windows(benchmark: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """``window, terms`` of all different windows, staged, and ``window, item_id`` of those that have them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item_id, text in zip(batch["item_id"].to_pylist(), batch["text"].cast(pa.binary()).to_pylist()):
                own = np.array([term(w) for w in words(text)], np.uint64).view(np.int64)
                if not len(own):
                    continue
                rows = np.lib.stride_tricks.sliding_window_view(own, min(size, len(own)))
                for i in range(0, len(rows), BATCH_WINDOWS):
                    part = rows[i:i + BATCH_WINDOWS]
                    ends = np.arange(len(part) + 1, dtype=np.int32) * part.shape[1]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([item_id] * len(part), pa.int64()), pa.ListArray.from_arrays(ends, part.ravel())],
                        ["item_id", "terms"],
                    )

    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = stage(items.mapInArrow(run, "item_id long, terms array<long>").distinct(), "item_windows")
    windows = stage(rows.select("terms").distinct().withColumn("window", F.monotonically_increasing_id()), "windows")
    return windows, rows.join(windows, "terms").select("window", "item_id")


def _asked(index: DataFrame, windows: DataFrame) -> DataFrame:
    """``shard, window, terms``: a window meets the shards that have its rarest term.

    Windows with a term that no document has are in none.
    """
    postings = index.select("shard", F.explode(F.arrays_zip("terms", "counts")).alias("p")) \
        .select("shard", F.col("p.terms").alias("term"), F.col("p.counts").alias("n"))
    parts = windows.select("window", F.explode(F.array_distinct("terms")).alias("term"))
    classes = parts.groupBy("term").agg(F.count("*").alias("n_windows")).join(
        postings.groupBy("term").agg(F.sum("n").alias("n")), "term")
    known = join_classes(parts, stage(classes, "terms"), "term", F.col("n_windows"))
    rarest = known.groupBy("window").agg(
        F.min_by("term", F.struct("n", "term")).alias("term"), F.every(F.col("n").isNotNull()).alias("whole")
    ).where("whole").join(windows, "window")
    return stage(postings.select("shard", "term").join(rarest, "term").select("shard", "window", "terms"), "asked")


def occurrences(index: DataFrame, windows: DataFrame, size: int = 10, slop: int | None = None,
                block_words: int = 2_000_000) -> DataFrame:
    """``shard, ord, window, start, end, kind``: where the windows of ``test_windows`` occur.

    A shard is asked for windows of ``block_words`` words at a time; overlapping places of a
    window in a document are one row. See ``matches`` for ``kind`` and ``slop``.
    """
    schema = pa.schema([("shard", pa.int64()), ("ord", pa.int32()), ("window", pa.int64()), ("start", pa.int64()),
                        ("end", pa.int64()), ("kind", pa.string())])

    def search(shard: pa.Table, asked: pa.Table) -> pa.Table:
        if not len(shard) or not len(asked):
            return schema.empty_table()
        postings, own = Postings(shard), asked["terms"].combine_chunks()
        lengths = own.value_lengths().to_numpy().astype(np.int64)
        padded = np.zeros((len(own), size), np.int64)
        padded[np.arange(size) < lengths[:, None]] = own.flatten().to_numpy()
        names = asked["window"].to_numpy()
        spans: dict[tuple, list] = {}
        rows = set()
        for which, start, exact in _search(postings, padded, lengths, slop):
            doc = np.searchsorted(postings.base, start, "right") - 1
            place = start - postings.base[doc]
            for w, d, s, n, e in zip(names[which].tolist(), doc.tolist(), place.tolist(),
                                     lengths[which].tolist(), exact.tolist()):
                if e:
                    spans.setdefault((d, w), []).append((s, s + n))
                else:
                    rows.add((d, w, s, s + 1, "near"))
        for (d, w), own_spans in spans.items():
            own_spans.sort()
            low, high = own_spans[0]
            for s, e in own_spans[1:]:
                if s > high:
                    rows.add((d, w, low, high, "phrase"))
                    low = s
                high = max(high, e)
            rows.add((d, w, low, high, "phrase"))
        number = shard["shard"][0].as_py()
        flat = [(number, *r) for r in sorted(rows)]
        return pa.table([pa.array([r[i] for r in flat], f.type) for i, f in enumerate(schema)], schema=schema)

    asked, per_block = _asked(index, windows), max(1, block_words // size)
    blocks = asked.groupBy("shard").agg(F.ceil(F.count("*") / per_block).alias("n"))
    left = index.select("shard", "n_words", "terms", "counts", "postings").join(
        blocks.select("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("block")), "shard")
    right = asked.join(blocks, "shard").withColumn("block", F.pmod(F.xxhash64("window"), "n"))
    return left.groupBy("shard", "block").cogroup(
        right.select("shard", "block", "window", "terms").groupBy("shard", "block")).applyInArrow(search, FOUND)


def matches(index: DataFrame, benchmark: DataFrame, size: int = 10, slop: int | None = None,
            block_words: int = 2_000_000) -> DataFrame:
    """``shard, ord, item_id, start, end, kind``: where windows of ``size`` words occur.

    ``kind`` is ``phrase`` for windows that occur word by word; overlapping ones of an item are
    one row. With ``slop`` there are also ``near`` rows: places of a window's rarest term with
    every other term of it no more than ``size - 1 + slop`` words away.
    """
    windows, owners = test_windows(benchmark, size)
    found = occurrences(index, windows, size, slop, block_words).join(owners, "window")
    of_item = Window.partitionBy("shard", "ord", "item_id", "kind").orderBy("start", "end")
    before = F.max("end").over(of_item.rowsBetween(Window.unboundedPreceding, -1))
    # Places that are near are one word each and stay apart; phrases that touch are one.
    first = before.isNull() | (F.col("start") > before) | ((F.col("kind") == "near") & (F.col("start") >= before))
    marked = found.withColumn("first", first.cast("int"))
    return marked.withColumn("span", F.sum("first").over(of_item)) \
        .groupBy("shard", "ord", "item_id", "kind", "span").agg(F.min("start").alias("start"), F.max("end").alias("end")) \
        .select("shard", "ord", "item_id", "start", "end", "kind")


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``.

    A word is hit when it lies in an occurrence of any window of ``size`` consecutive words of
    a benchmark item; an item of fewer words is one window. Null and empty texts have no words.
    Rows that repeat an id are judged one by one; benchmark rows that share an ``item_id`` are
    one item, those with a null one count as hits but not as items. Without benchmark rows
    nothing is hit. Other columns of either table are ignored.
    """
    items = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    index = build_index(docs, test_terms(items))
    windows, owners = test_windows(items, size)
    found = stage(occurrences(index, windows, size), "occurrences")
    ahead = Window.partitionBy("shard", "ord").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.col("start"), F.coalesce(F.max("end").over(ahead), F.lit(0)))
    hits = found.select("shard", "ord", F.greatest(F.col("end") - fresh, F.lit(0)).alias("more")) \
        .groupBy("shard", "ord").agg(F.sum("more").alias("n_hit"))
    named = found.select("shard", "ord", "window").distinct().join(owners, "window").where("item_id IS NOT NULL").groupBy("shard", "ord").agg(
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items")
    )
    all_docs = index.select("shard", F.posexplode(F.arrays_zip("doc_ids", "n_words")).alias("ord", "d")) \
        .select("shard", "ord", F.col("d.doc_ids").alias("doc_id"), F.col("d.n_words").cast("long").alias("n_words"))
    both = all_docs.join(hits, ["shard", "ord"], "left").join(named, ["shard", "ord"], "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    items_ = F.coalesce("items", F.array().cast("array<string>"))
    return both.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(items_).cast("long").alias("n_items"),
        F.sha2(F.array_join(items_, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """``docs`` without the rows whose text is contaminated, all columns kept; ids play no part.

    Texts are known by a 64-bit hash; should one hash stand for a contaminated text and another
    one, the next seed is taken.
    """
    text, name = F.coalesce(F.col("text"), F.lit("")), free_name(docs, "hash")
    for seed in count():
        key = F.xxhash64(F.lit(seed), text)
        gone = stage(contamination(docs.select(key.alias("doc_id"), "text"), benchmark, size).where("contaminated").select(
            F.col("doc_id").alias(name)).distinct(), "contaminated")
        marked = docs.withColumn(name, key)
        texts = marked.join(gone, name, "left_semi").groupBy(name).agg(F.count_distinct(text_hash(F.col("text"))).alias("n"))
        if texts.where("n > 1").isEmpty():
            return marked.join(gone, name, "left_anti").select(*docs.columns)
