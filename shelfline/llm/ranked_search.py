"""Ranked search over whole corpora: block-max MaxScore on a sharded inverted index.

The index holds a posting list for every term of every shard of documents. A list is cut into
blocks of ``BLOCK`` postings; next to it stand, uncompressed, its largest impact and for each
block its first and last document and its own largest impact. A query is answered shard by
shard. The bounds of whole lists split its terms into essential ones, whose postings are all
read, and others, which together cannot lift a document into the result. A document found by
essential terms meets the others from the largest bound down and is given up as soon as its
score and the maxima of the blocks it would lie in stay at or below the tenth best; only blocks
that some document still needs are decompressed. The shards' heaps are merged at the end.

    impact(t, d) = (10^9 tf) div (1000 tf + 8 m(d)),  m(d) = 10 + (90 n(d) N) div L
    score(q, d)  = sum over the terms of q of w(t) impact(t, d)

The number of documents N and of terms L are counted first, so maxima are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import documents, stage

SHARD_TERMS = 2_000_000
SHARD_DOCS = 60_000  # document numbers in a shard take two bytes
BLOCK = 128
WINDOW_DOCS = 4_096
SALTS = 64
_UPPER = {c: c + 32 for c in range(65, 91)}
_FOLD = bytes(
    _UPPER.get(c, c) if c >= 0x80 or chr(c).isalnum() else 32 for c in range(256)
)
# first and last document, largest impact, number of postings, bytes of a document gap and of a tf
HEAD = np.dtype([("first", "<u2"), ("last", "<u2"), ("peak", "<i4"), ("size", "u1"), ("gap", "u1"), ("tf", "u1")])
POSTINGS = "shard long, term string, df long, peak long, heads binary, body binary"
INDEX = f"kind string, {POSTINGS}, ids array<long>, lengths array<long>"


def terms_of(text: bytes) -> list[bytes]:
    """Runs of ASCII letters, digits and characters beyond ASCII, lower-cased in A-Z."""
    return text.translate(_FOLD).split()


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def _norm(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    return 10 + 90 * n.astype(np.int64) * n_docs // max(n_terms, 1)


def statistics(docs: DataFrame) -> tuple[int, int]:
    """Documents with a term, and their terms with repeats."""
    word = np.frombuffer(_FOLD, np.uint8) != 32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = total = 0
        for batch in batches:
            for text in batch["text"].cast(pa.binary()).to_pylist():
                inside = word[np.frombuffer(text, np.uint8)]
                n = int(np.count_nonzero(inside[1:] > inside[:-1])) + int(bool(len(inside)) and bool(inside[0]))
                some += n > 0
                total += n
        yield pa.RecordBatch.from_pydict({"some": [some], "total": [total]})

    row = docs.select("text").mapInArrow(run, "some long, total long").agg(F.sum("some"), F.sum("total")).first()
    return row[0] or 0, row[1] or 0


def _widths(most: np.ndarray) -> np.ndarray:
    return np.where(most < 1 << 8, 1, np.where(most < 1 << 16, 2, 4)).astype(np.int64)


def _write(out: np.ndarray, at: np.ndarray, values: np.ndarray, width: np.ndarray) -> None:
    """``values`` as little-endian numbers of ``width`` bytes at the places ``at``."""
    for k in range(4):
        wide = width > k
        if not wide.any():
            return
        out[at[wide] + k] = (values[wide] >> (8 * k)) & 255


def encode(code: np.ndarray, doc: np.ndarray, tf: np.ndarray, m: np.ndarray) -> dict[str, np.ndarray]:
    """Posting lists, given in order of term and document, as heads and bodies one after the other.

    A block holds the gaps between its documents, then the frequencies, each in as many bytes
    as its largest needs.
    """
    n = len(code)
    new_term = np.r_[True, code[1:] != code[:-1]]
    first = np.flatnonzero(new_term)
    df = np.diff(np.r_[first, n])
    inner = np.arange(n) - np.repeat(first, df)
    start = np.flatnonzero(inner % BLOCK == 0)
    size = np.diff(np.r_[start, n])
    block = np.repeat(np.arange(len(start)), size)
    gap = np.r_[0, doc[1:] - doc[:-1]]
    gap[start] = 0
    peak = impact(tf, m)
    heads = np.zeros(len(start), HEAD)
    heads["first"], heads["last"], heads["size"] = doc[start], doc[start + size - 1], size
    heads["peak"] = np.maximum.reduceat(peak, start)
    gap_width, tf_width = _widths(np.maximum.reduceat(gap, start)), _widths(np.maximum.reduceat(tf, start))
    heads["gap"], heads["tf"] = gap_width, tf_width
    bytes_of = size * (gap_width + tf_width)
    at = np.cumsum(bytes_of) - bytes_of
    body = np.zeros(int(bytes_of.sum()), np.uint8)
    place = np.arange(n) - start[block]
    _write(body, at[block] + place * gap_width[block], gap, gap_width[block])
    _write(body, at[block] + (size * gap_width)[block] + place * tf_width[block], tf, tf_width[block])
    list_of = np.cumsum(new_term)[start] - 1  # the list each block belongs to
    blocks = np.bincount(list_of, minlength=len(first))
    return {"first": first, "df": df, "peak": np.maximum.reduceat(peak, first), "heads": heads, "blocks": blocks,
            "body": body, "bytes": np.bincount(list_of, bytes_of, len(first)).astype(np.int64)}


class Postings:
    """A term's list in a shard; blocks are decompressed when they are asked for."""

    def __init__(self, weight: int, peak: int, heads: bytes, body: bytes) -> None:
        self.weight, self.bound = weight, weight * peak
        self.heads = np.frombuffer(heads, HEAD)
        self.body = body
        sizes = self.heads["size"].astype(np.int64) * (self.heads["gap"].astype(np.int64) + self.heads["tf"])
        self.at = np.cumsum(sizes) - sizes
        self.last = self.heads["last"].astype(np.int64)
        self.peaks = weight * self.heads["peak"].astype(np.int64)
        self.open: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def block(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        if i not in self.open:
            h, at = self.heads[i], int(self.at[i])
            n, g, t = int(h["size"]), int(h["gap"]), int(h["tf"])
            gaps = np.frombuffer(self.body, f"<u{g}", n, at).astype(np.int64)
            self.open[i] = (np.cumsum(gaps) + int(h["first"]), np.frombuffer(self.body, f"<u{t}", n, at + n * g).astype(np.int64))
        return self.open[i]

    def between(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents from ``low`` to before ``high`` with their frequencies."""
        a = int(np.searchsorted(self.last, low))
        b = int(np.searchsorted(self.heads["first"], high))
        if a >= b:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        parts = [self.block(i) for i in range(a, b)]
        doc, tf = (np.concatenate([p[j] for p in parts]) for j in (0, 1))
        keep = slice(*np.searchsorted(doc, (low, high)))
        return doc[keep], tf[keep]

    def lookup(self, docs: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """Frequencies of ascending ``docs``, which lie in ``blocks`` if anywhere."""
        out = np.zeros(len(docs), np.int64)
        for i in np.unique(blocks):
            doc, tf = self.block(int(i))
            mine = np.flatnonzero(blocks == i)
            at = np.minimum(np.searchsorted(doc, docs[mine]), len(doc) - 1)
            out[mine] = np.where(doc[at] == docs[mine], tf[at], 0)
        return out


def best_of_shard(lists: list[Postings], m: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and scores of a shard's ``top`` documents, best first, equal ones by number.

    Documents come in ascending numbers, so one that only reaches the ``top``-th score is later
    than all that hold it, and a bound at or below it is enough to give a document up.
    """
    lists = sorted(lists, key=lambda p: p.bound)
    sums = np.cumsum([0, *(p.bound for p in lists)])  # sums[i]: all lists before i together
    best_doc, best_score, least = np.empty(0, np.int64), np.empty(0, np.int64), 0
    for low in range(0, len(m), WINDOW_DOCS):
        high = min(low + WINDOW_DOCS, len(m))
        split = int(np.searchsorted(sums, least, "right")) - 1  # lists before it cannot reach the result together
        if split >= len(lists):
            break
        score = np.zeros(high - low, np.int64)
        for p in lists[split:]:
            doc, tf = p.between(low, high)
            score[doc - low] += p.weight * impact(tf, m[doc])
        alive = np.flatnonzero(score)
        alive = alive[score[alive] + sums[split] > least]
        score = score[alive]
        alive = alive + low
        for i in range(split - 1, -1, -1):
            if not len(alive):
                break
            p = lists[i]
            block = np.minimum(np.searchsorted(p.last, alive), len(p.last) - 1)
            there = (p.heads["first"][block] <= alive) & (alive <= p.last[block])
            hope = score + np.where(there, p.peaks[block], 0) + sums[i] > least
            alive, score, block, there = alive[hope], score[hope], block[hope], there[hope]
            if there.any():
                tf = p.lookup(alive[there], block[there])
                score[there] += p.weight * impact(tf, m[alive[there]])
            hope = score + sums[i] > least
            alive, score = alive[hope], score[hope]
        best_doc, best_score = np.r_[best_doc, alive], np.r_[best_score, score]
        order = np.lexsort((best_doc, -best_score))[:top]
        best_doc, best_score = best_doc[order], best_score[order]
        if len(best_score) == top:
            least = int(best_score[-1])
    return best_doc, best_score


def _binaries(buffer: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Consecutive parts of a buffer as a column, without a copy of each."""
    offsets = np.r_[0, np.cumsum(lengths)].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(buffer)])


def build_index(docs: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """The staged index: a row for each term of a shard, and one for the shard's documents.

    Shards close at ``SHARD_TERMS`` terms or ``SHARD_DOCS`` documents, so that a task holds one
    at a time; a longer document is a shard by itself.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        codes: dict[bytes, int] = {}
        ids: list = []
        held: list[np.ndarray] = []
        size = 0

        def close() -> Iterator[pa.RecordBatch]:
            order = np.array(sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0)), np.int64)
            lengths = np.array([len(held[i]) for i in order], np.int64)
            code = np.concatenate([held[i] for i in order])
            pair = code.astype(np.int64) << 16 | np.repeat(np.arange(len(order)), lengths)
            pair, tf = np.unique(pair, return_counts=True)
            doc = pair & 0xFFFF
            e = encode(pair >> 16, doc, tf, _norm(lengths, n_docs, n_terms)[doc])
            words = [*codes]
            n = len(words)
            step, head_at, body_at = 20_000, np.r_[0, np.cumsum(e["blocks"])], np.r_[0, np.cumsum(e["bytes"])]
            none = pa.nulls
            for a in range(0, n, step):
                b = min(a + step, n)
                own = e["heads"][head_at[a]:head_at[b]]
                yield pa.RecordBatch.from_arrays([
                    pa.array(["list"] * (b - a)), pa.array(np.full(b - a, number)),
                    pa.array(words[a:b], pa.binary()).cast(pa.string()), pa.array(e["df"][a:b]), pa.array(e["peak"][a:b]),
                    _binaries(own.view(np.uint8), e["blocks"][a:b] * HEAD.itemsize),
                    _binaries(e["body"][body_at[a]:body_at[b]], e["bytes"][a:b]),
                    none(b - a, pa.list_(pa.int64())), none(b - a, pa.list_(pa.int64())),
                ], names)
            yield pa.RecordBatch.from_arrays([
                pa.array(["docs"]), pa.array([number]), none(1, pa.string()), none(1, pa.int64()), none(1, pa.int64()),
                none(1, pa.binary()), none(1, pa.binary()), pa.array([[ids[i] for i in order]], pa.list_(pa.int64())),
                pa.array([lengths], pa.list_(pa.int64())),
            ], names)

        names = [c.split()[0] for c in INDEX.split(", ")]
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].cast(pa.binary()).to_pylist()):
                words = terms_of(text)
                if not words:
                    continue
                try:
                    own = [*map(codes.__getitem__, words)]
                except KeyError:
                    for w in words:
                        codes.setdefault(w, len(codes))
                    own = [*map(codes.__getitem__, words)]
                ids.append(doc_id)
                held.append(np.array(own, np.int32))
                size += len(own)
                if size >= SHARD_TERMS or len(ids) >= SHARD_DOCS:
                    yield from close()
                    codes, ids, held, size, number = {}, [], [], 0, number + 1
        if ids:
            yield from close()

    return stage(docs.mapInArrow(run, INDEX), "index", "kind")


def query_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``item, item_id, term``: each different term of each row of the query set."""
    rows = items.select(F.col(id_col).alias("item_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema["item_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            found = [sorted(set(terms_of(t))) for t in batch["text"].cast(pa.binary()).to_pylist()]
            sizes = [len(f) for f in found]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(number + np.arange(len(found)), sizes)),
                batch["item_id"].take(pa.array(np.repeat(np.arange(len(found)), sizes))),
                pa.array([t for f in found for t in f], pa.binary()).cast(pa.string()),
            ], ["item", "item_id", "term"])
            number += len(found)

    return stage(rows.mapInArrow(run, f"item long, item_id {kind.simpleString()}, term string"), "queries")


def _weight(n_docs: int) -> Column:
    return F.floor(1000 * F.log(F.lit(float(2 * n_docs + 2)) / (2 * F.col("df") + 1).cast("double"))).cast("long")


def search(index: DataFrame, terms: DataFrame, n_docs: int, n_terms: int, top: int, block_items: int = 256) -> DataFrame:
    """``item, doc_id, score``: each item's best documents of every shard.

    Items are dealt into blocks of about ``block_items``. A block's terms meet the lists of all
    shards in an ordinary join, and a task answers one block of items on one shard: its rows
    are the block's items, the shard's documents and the lists between them.
    """
    lists = index.where("kind = 'list'")
    n_blocks = max(1, -(-terms.select(F.count_distinct("item")).first()[0] // block_items))
    terms = terms.withColumn("part", F.pmod(F.xxhash64("item"), F.lit(n_blocks)))
    asked = terms.select("term").distinct()
    found = stage(lists.select("shard", "term", "df", "peak", "heads", "body").join(asked, "term", "left_semi"), "found")
    weights = found.groupBy("term").agg(F.sum("df").alias("df")).select("term", _weight(n_docs).alias("w")).where("w > 0")
    per_part = stage(terms.select("part", "term").distinct().join(weights, "term"), "weights")
    empty = F.lit(None)
    rows = found.join(per_part, "term").select(
        "part", "shard", F.lit(1).alias("kind"), "term", "w", "peak", "heads", "body",
        empty.cast("array<long>").alias("ids"), empty.cast("array<long>").alias("lengths"))
    shards = index.where("kind = 'docs'").select("shard", "ids", "lengths")
    every = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)).cast("array<long>")).alias("part")
    none = [empty.cast(t).alias(c) for c, t in (("term", "string"), ("w", "long"), ("peak", "long"), ("heads", "binary"), ("body", "binary"))]
    rows = rows.unionByName(shards.select(every, "shard", F.lit(0).alias("kind"), *none, "ids", "lengths"))
    # A block's items are few and short, and go to each shard.
    asking = terms.groupBy("part").agg(F.collect_list(F.struct("item", "term")).alias("asked"))  # of block_items items
    asking = stage(asking, "asking")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, m, ids, lists, asked = None, None, None, {}, {}

        def answer() -> pa.RecordBatch:
            items, docs, scores = [], [], []
            for item, words in asked.items():
                mine = [lists[w] for w in words if w in lists]
                if mine:
                    doc, score = best_of_shard(mine, m, top)
                    items += [item] * len(doc)
                    docs += [ids[i] for i in doc]
                    scores.append(score)
            return pa.RecordBatch.from_arrays([
                pa.array(items, pa.int64()), pa.array(docs, pa.int64()),
                pa.array(np.concatenate([np.empty(0, np.int64), *scores]))], ["item", "doc_id", "score"])

        for batch in batches:
            for row in batch.to_pylist():
                if (row["part"], row["shard"]) != now:
                    if lists:
                        yield answer()
                    now, lists, asked = (row["part"], row["shard"]), {}, {}
                if row["kind"] == 0:
                    ids, m = row["ids"], _norm(np.array(row["lengths"], np.int64), n_docs, n_terms)
                    for x in row["asked"] or ():
                        asked.setdefault(x["item"], []).append(x["term"])
                else:
                    lists[row["term"]] = Postings(row["w"], row["peak"], row["heads"], row["body"])
        if lists:
            yield answer()

    # One block of items meets all shards: a salt keeps them from one task.
    copies = asking.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    heads = rows.where("kind = 0").withColumn("salt", F.pmod(F.xxhash64("shard"), F.lit(SALTS)).cast("int"))
    whole = heads.join(copies, ["part", "salt"]).drop("salt").unionByName(rows.where("kind = 1").withColumn(
        "asked", empty.cast(asking.schema["asked"].dataType)))
    return whole.repartition("part", "shard").sortWithinPartitions("part", "shard", "kind").mapInArrow(
        run, "item long, doc_id long, score long")


def rank(docs: DataFrame, items: DataFrame, top: int = 10, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Each item's ``top`` documents: ``item_id, rank, doc_id, score``, scores above 0 only.

    Terms are runs of ASCII letters and digits and of characters beyond ASCII, lower-cased in
    A-Z; an item's terms count once each. A term weighs floor(1000 ln((2N + 2) / (2 df + 1))).
    Equal scores rank by ascending id, null ids last. Null and empty texts have no terms and are
    never found; items without a known term give no rows. Rows that repeat an id, of documents
    or of items, count one by one. Other columns are ignored.
    """
    clean = documents(docs, id_col, text_col)
    n_docs, n_terms = statistics(clean)
    terms = query_terms(items, item_col, item_text_col)
    index = build_index(clean, n_docs, n_terms)
    found = search(index, terms, n_docs, n_terms, top)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    names = terms.select("item", "item_id").distinct()
    return best.join(names, "item").select("item_id", "rank", "doc_id", "score")
