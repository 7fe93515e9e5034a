"""Near duplicates by fingerprints whose bits differ in few places, complete for every distance.

Fingerprints are searched in a hierarchical index: sorted by Gray rank, so that neighbours
differ in few bits; each group of neighbours factors out the bits all its members share, and
groups of groups do the same on every level above. Two groups whose shared bits already differ
too often are dropped together; two that cannot differ too often are linked without a look at
their members.

To spread the work, a fingerprint is looked for in the bucket of each of ``max_bits + 1`` parts
of it: two fingerprints with at most ``max_bits`` differences agree in one part at least.
Buckets that are too full are cut again by the same rule on the other bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import documents, join_classes, stage, text_hash, without
from .components import components

FAN = 16  # members of a group, on every level
PAIRS = 1_000_000  # pairs of groups looked at together
SHINGLES = 1 << 16  # hashes counted together


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """Majority bits of the XXH64 (seed 42) of all word shingles, repeats included."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths).tolist()
    ends = ends.tolist()
    if len(words) > shingle:
        starts, ends = starts[:1 - shingle] if shingle > 1 else starts, ends[shingle - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest, total = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for i in range(0, len(starts), SHINGLES):
        hashes = [digest(joined[a:b], 42) for a, b in zip(starts[i:i + SHINGLES], ends[i:i + SHINGLES])]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(total * 2 > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, sha: Column | None = None) -> DataFrame:
    """``doc_id, sha, fp`` of every row; texts without words have the fingerprint 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t, shingle) for t in batch["text"].cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["sha"], pa.array(np.array(fps, np.uint64).view(np.int64), pa.int64())],
                ["doc_id", "sha", "fp"],
            )

    rows = documents(docs).withColumn("sha", F.lit("") if sha is None else sha)
    return rows.mapInArrow(run, "doc_id long, sha string, fp long")


def gray_rank(fp: Column) -> Column:
    """Place of a bit pattern in the Gray sequence, as a signed long in that order."""
    for step in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, step))
    return fp.bitwiseXOR(F.lit(-(1 << 63)))


def _part(width: int, parts: int, n: int) -> tuple[int, int]:
    """First bit and number of bits of part ``n`` of ``width`` bits."""
    low, high = width * n // parts, width * (n + 1) // parts
    return low, high - low


def _bits(fp: Column, low: int, size: int) -> Column:
    return F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << size) - 1))


def _others(fp: Column, low: int, size: int) -> Column:
    """``fp`` without the bits of one part."""
    below = fp.bitwiseAND(F.lit((1 << low) - 1))
    return F.shiftleft(F.shiftrightunsigned(fp, low + size), low).bitwiseOR(below) if low + size < 64 else below


def _dealt(rows: DataFrame, parts: int, full: int) -> DataFrame:
    """``bucket, fp``: each fingerprint once for each of its buckets."""
    first = [_part(64, parts, n) for n in range(parts)]
    keyed = rows.select("fp", F.explode(F.array(*[
        F.struct(F.lit(n).alias("n"), _bits(F.col("fp"), *p).alias("value"), _others(F.col("fp"), *p).alias("rest"))
        for n, p in enumerate(first)
    ])).alias("k")).select("fp", "k.*")
    crowded = keyed.groupBy("n", "value").count().where(F.col("count") > full).select("n", "value", F.lit(True).alias("cut"))
    # at most parts * 2^(64 / parts) buckets exist, so this side is bounded
    marked = keyed.join(F.broadcast(crowded), ["n", "value"], "left") if 64 // parts <= 16 else \
        keyed.join(crowded, ["n", "value"], "left")
    plain = marked.where("cut IS NULL").select(F.xxhash64("n", "value", F.lit(-1), F.lit(-1)).alias("bucket"), "fp")
    rest = 64 - min(size for _, size in first)
    again = F.explode(F.array(*[
        F.struct(F.lit(m).alias("m"), _bits(F.col("rest"), *_part(rest, parts, m)).alias("inner")) for m in range(parts)
    ])).alias("q")
    cut = marked.where("cut").select("fp", "n", "value", again).select(
        F.xxhash64("n", "value", "q.m", "q.inner").alias("bucket"), "fp"
    )
    return plain.unionByName(cut)


class Forest:
    """One index tree for each bucket in a batch of rows sorted by (bucket, Gray rank)."""

    def __init__(self, bucket: np.ndarray, fps: np.ndarray):
        self.fps, self.label = fps, np.arange(len(fps))
        self.levels = []  # (mask, pattern, first child, number of children) of each level's groups
        owner, mask, pattern = bucket, np.full(len(fps), ~np.uint64(0)), fps
        while True:
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            sizes = np.diff(np.r_[starts, len(owner)])
            if self.levels and sizes.max() == 1:
                break
            inner = np.arange(len(owner)) - np.repeat(starts, sizes)
            first = np.flatnonzero(inner % FAN == 0)
            count = np.diff(np.r_[first, len(owner)])
            head = np.repeat(pattern[first], count)
            same = np.bitwise_and.reduceat(mask & ~(pattern ^ head), first)
            self.levels.append((same, pattern[first] & same, first, count))
            owner, mask, pattern = owner[first], same, pattern[first] & same

    def _join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Give the members of linked pairs the smallest label of either side."""
        while True:
            left, right = self.label[a], self.label[b]
            differ = left != right
            if not differ.any():
                return
            a, b = a[differ], b[differ]
            low, high = np.minimum(left[differ], right[differ]), np.maximum(left[differ], right[differ])
            np.minimum.at(self.label, high, low)
            while True:
                jumped = self.label[self.label]
                if (jumped == self.label).all():
                    break
                self.label = jumped

    def _expand(self, level: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All pairs of a child of ``a`` and a child of ``b``; with itself, a group gives each pair once."""
        _, _, first, count = self.levels[level]
        n = count[a] * count[b]
        pair = np.repeat(np.arange(len(a)), n)
        inner = np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n)
        wide = count[b][pair]
        x, y = first[a][pair] + inner // wide, first[b][pair] + inner % wide
        keep = (a[pair] != b[pair]) | (x <= y)
        return x[keep], y[keep]

    def link(self, max_bits: int) -> np.ndarray:
        """The smallest linked row of each row's component inside its bucket."""
        top = len(self.levels) - 1
        roots = np.arange(len(self.levels[top][0]))
        work = [(top, roots[i:i + 4096], roots[i:i + 4096]) for i in range(0, len(roots), 4096)]
        while work:
            level, a, b = work.pop()
            x, y = self._expand(level, a, b)
            if level == 0:
                near = (np.bitwise_count(self.fps[x] ^ self.fps[y]) <= max_bits) & (x != y)
                self._join(x[near], y[near])
                continue
            mask, pattern, _, _ = self.levels[level - 1]
            shared = mask[x] & mask[y]
            least = np.bitwise_count((pattern[x] ^ pattern[y]) & shared).astype(np.int64)
            near = least <= max_bits
            most = least + np.bitwise_count(~shared)
            sure = np.flatnonzero(near & (most <= max_bits))
            if len(sure):  # no two members can differ more: link all with one member
                number, left = self._members(level - 1, x[sure])
                lead = left[np.searchsorted(number, np.arange(len(sure)))]
                other, right = self._members(level - 1, y[sure])
                self._join(np.r_[lead[number], lead[other]], np.r_[left, right])
                near[sure] = False
            x, y = x[near], y[near]
            step = max(1, PAIRS // (FAN * FAN))
            work += [(level - 1, x[i:i + step], y[i:i + step]) for i in range(0, len(x), step)]
        return self.label

    def _members(self, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each of ``nodes``, its number in the list and its rows."""
        number, rows = np.arange(len(nodes)), nodes
        for down in range(level, -1, -1):
            _, _, first, count = self.levels[down]
            n = count[rows]
            inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            number, rows = np.repeat(number, n), np.repeat(first[rows], n) + inner
        return number, rows


def links(rows: DataFrame, max_bits: int = 3, full: int = 4096) -> DataFrame:
    """``a, b``: edges that connect all different fingerprints of ``rows(fp)`` within ``max_bits``.

    Not all pairs: within a bucket each fingerprint is linked with one other of its component.
    """
    dealt = _dealt(rows, max_bits + 1, full)

    def solve(bucket: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        label = Forest(bucket, fps.view(np.uint64)).link(max_bits)
        moved = np.flatnonzero(label != np.arange(len(label)))
        return pa.RecordBatch.from_arrays(
            [pa.array(fps[moved], pa.int64()), pa.array(fps[label[moved]], pa.int64())], ["a", "b"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_bucket, held_fp = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            held_bucket = np.r_[held_bucket, batch["bucket"].to_numpy(zero_copy_only=False)]
            held_fp = np.r_[held_fp, batch["fp"].to_numpy(zero_copy_only=False)]
            if len(held_bucket) >= 100_000 and held_bucket[0] != held_bucket[-1]:
                cut = int(np.searchsorted(held_bucket, held_bucket[-1]))  # the last bucket may go on
                yield solve(held_bucket[:cut], held_fp[:cut])
                held_bucket, held_fp = held_bucket[cut:], held_fp[cut:]
        if len(held_bucket):
            yield solve(held_bucket, held_fp)

    order = ["bucket", gray_rank(F.col("fp"))]
    return dealt.repartition("bucket").sortWithinPartitions(*order).mapInArrow(run, "a long, b long").distinct()


def _headed(mine: DataFrame, max_bits: int) -> DataFrame:
    """``mine(doc_id, sha, fp)``, staged, with the ``head`` of each row's group.

    That is the row with the smallest id, null ids last, and of those the smallest hash.
    """
    head = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "sha")
    nodes = stage(mine.groupBy("fp").agg(F.min(head).alias("least"), F.count("*").alias("n_docs")), "nodes")
    joined = components(links(nodes.select("fp"), max_bits))
    root = F.coalesce("b", "fp").alias("root")
    rooted = stage(nodes.join(joined.withColumnRenamed("a", "fp"), "fp", "left").select("fp", root, "least", "n_docs"), "roots")
    totals = rooted.groupBy("root").agg(F.min("least").alias("head"), F.count("*").alias("n"))
    named = join_classes(rooted, totals, "root", F.col("n")).select("fp", "head", "n_docs")
    return join_classes(mine, stage(named, "components"), "fp", F.col("n_docs"))


def near_groups(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id``.

    Documents whose fingerprints differ in at most ``max_bits`` bits are linked, those with
    equal ones included; ``component_id`` is the smallest id that links lead to. Texts without
    words, null ones too, have fingerprint 0 and are linked like others. Null ids never name a
    component unless it has no other id. Repeated rows each get their row; other columns are
    ignored; an empty table gives no rows.
    """
    out = _headed(stage(fingerprints(docs, shingle), "fingerprints"), max_bits)
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                      F.col("head.doc_id").alias("component_id"))


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """``docs`` with one text of each group, that of the smallest id; all columns kept.

    Rows are told apart by id and text, so a row goes only for its own group. Of several texts
    under the smallest id, or of nothing but null ids, the one with the smallest hash stays;
    rows that repeat an id and its text stay or go together.
    """
    out = _headed(stage(fingerprints(docs, shingle, text_hash(F.col("text"))), "fingerprints"), max_bits)
    kept = F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("sha") == F.col("head.sha"))
    return without(docs, out.where(~kept))
