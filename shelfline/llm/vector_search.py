"""Nearest neighbours by balanced posting lists, for the largest inner product.

Centroids come from halving a bounded sample again and again at the median, so lists are of
like size. A vector belongs to its nearest centroid's list, and one near a boundary also to
those of the other centroids that are hardly farther away, unless two of these lie close to each
other. Centroids are found by walking a neighbour graph held in memory. A query reads the lists
whose centroid is at most some ratio farther than the nearest one, a ratio that is set by
comparing a few queries with everything; the vectors in them are
compared exactly, and the lists' results merged.

The largest inner product is made a smallest distance by one more component that brings every
vector to the length of the longest; a query has 0 there.

Equal vectors are one entry of the index, with the smallest ids that any result can need, and
equal queries are asked once, so that copies cost nothing. Lists that have grown beyond
``SEGMENT`` are read in segments, and many queries of one list in parts, by different tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import join_classes, stage

SEGMENT = 4_096
ENTRIES = 64  # centroids where a walk may begin
DEGREE = 24
QUERY_ROWS = 256
HELD = 1_000_000  # hits of a task before they are merged
SLACK = 1e-9  # by which the fast product may be off


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column as rows of one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def balanced_centroids(sample: np.ndarray, n: int, rounds: int = 4) -> np.ndarray:
    """``n`` centroids of groups of equal size, neighbours next to each other where possible."""
    work, out = [(np.arange(len(sample)), min(n, len(sample)))], []
    while work:
        rows, parts = work.pop()
        points = sample[rows]
        if parts <= 1:
            out.append(points.mean(0))
            continue
        low = parts // 2
        cut = len(rows) * low // parts
        middle = points.mean(0)
        far = points[np.argmax(((points - middle) ** 2).sum(1))]
        axis = far - middle
        for _ in range(rounds):
            order = np.argpartition(points @ axis, cut)
            axis = points[order[cut:]].mean(0) - points[order[:cut]].mean(0)
        order = np.argpartition(points @ axis, cut)
        work += [(rows[order[cut:]], parts - low), (rows[order[:cut]], low)]
    return np.asarray(out, np.float32)


def _nearest(points: np.ndarray, centroids: np.ndarray, k: int) -> np.ndarray:
    gap = (centroids ** 2).sum(1) - 2 * points @ centroids.T
    near = np.argpartition(gap, min(k, gap.shape[1] - 1), axis=1)[:, :k]
    return np.take_along_axis(near, np.argsort(np.take_along_axis(gap, near, 1), 1), 1)


@dataclass(frozen=True)
class Graph:
    """Centroids with, for each, the numbers of its neighbours."""

    centroids: np.ndarray
    links: np.ndarray

    def walk(self, points: np.ndarray, pool: int) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroids that are found, nearest first, with squared distances.

        Every point goes on from its best centroids not yet left, a few at a time, until its
        ``pool`` best are all left.
        """
        n, rows = len(self.centroids), np.arange(len(points))[:, None]
        pool = min(pool, n)
        steps = max(4, pool // 16)
        length = (points ** 2).sum(1)[:, None]
        square = (self.centroids ** 2).sum(1)
        begin = np.unique(np.linspace(0, n - 1, min(n, max(ENTRIES, pool))).astype(np.int64))
        gap = square[begin] - 2 * points @ self.centroids[begin].T
        order = np.argsort(gap, 1, kind="stable")[:, :pool]
        found, gap = begin[order], np.take_along_axis(gap, order, 1)
        seen = np.zeros((len(points), n + 1), bool)
        seen[rows, found] = True
        left = np.zeros(found.shape, bool)
        while True:
            # places of the best not left; those that have none stand still
            turn = np.argsort(left, 1, kind="stable")[:, :steps]
            fresh = ~np.take_along_axis(left, turn, 1)
            if not fresh.any():
                return found, np.maximum(gap + length, 0)
            np.put_along_axis(left, turn, True, 1)
            at = np.take_along_axis(found, turn, 1)
            near = self.links[at].reshape(len(points), -1)
            near = np.where(np.repeat(fresh, self.links.shape[1], 1) & ~seen[rows, near], near, n)
            near = np.sort(near, 1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = n
            seen[rows, near] = True
            some = np.minimum(near, n - 1)
            far = square[some] - 2 * np.einsum("rd,rkd->rk", points, self.centroids[some])
            far[near == n] = np.inf
            found, gap, left = np.c_[found, some], np.c_[gap, far], np.c_[left, near == n]
            order = np.argsort(gap, 1, kind="stable")[:, :pool]
            found, gap, left = (np.take_along_axis(a, order, 1) for a in (found, gap, left))


def build_graph(df: DataFrame, centroids: np.ndarray, degree: int = DEGREE, rows: int = 1024) -> Graph:
    """Each centroid's nearest others, found block by block on the executors.

    ``df`` only lends its session. Two of the links lead along the order of the centroids, which
    holds the graph together.
    """
    n = len(centroids)
    degree = min(degree, n - 1)
    if degree < 1:
        return Graph(centroids, np.zeros((n, 1), np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch["id"].to_pylist():
                mine = np.arange(block * rows, min((block + 1) * rows, n))
                near = _nearest(centroids[mine], centroids, degree + 1)
                own = near == mine[:, None]
                own[~own.any(1), -1] = True  # copies of a centroid may hide it
                yield pa.RecordBatch.from_pydict({
                    "node": mine, "links": pa.array(near[~own].reshape(len(mine), degree).tolist(), pa.list_(pa.int64()))})

    spark = df.sparkSession
    blocks = -(-n // rows)
    found = spark.range(0, blocks, 1, blocks).mapInArrow(run, "node long, links array<long>").collect()
    links = np.empty((n, degree + 2), np.int64)
    for r in found:
        links[r.node, :degree] = r.links
    links[:, degree], links[:, degree + 1] = (np.arange(n) + 1) % n, (np.arange(n) - 1) % n
    return Graph(centroids, links)


def clean_vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``row, vec_id, v, h`` of the vectors that take part, staged.

    Those that are null or zero, that hold null or non-finite components or that are of another
    length than most take no part.
    """
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v")).where(
        v.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0))
    rows = stage(rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "v", F.xxhash64("v").alias("h")), "vectors")
    sizes = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(2).collect()
    return rows.where(F.size("v") == sizes[0]["size"]) if len(sizes) > 1 else rows


def _entries(rows: DataFrame, most: int) -> DataFrame:
    """``entry, v, ids, rows``: each different vector with its ``most`` smallest ids."""
    order = Window.partitionBy("h", "v").orderBy(F.asc_nulls_last("vec_id"), "row")
    first = rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most)
    member = F.struct("place", "vec_id", "row")
    found = first.groupBy("h", "v").agg(F.array_sort(F.collect_list(member)).alias("m"))  # ``most`` at most
    return stage(found.select(F.element_at("m.row", 1).alias("entry"), "v", F.col("m.vec_id").alias("ids"),
                              F.col("m.row").alias("rows")), "entries")


def _flat(x: np.ndarray) -> np.ndarray:
    """Queries beside lifted vectors."""
    return np.c_[x.astype(np.float32), np.zeros(len(x), np.float32)]


def _lifted(x: np.ndarray, longest: float) -> np.ndarray:
    x = x.astype(np.float32)
    rest = np.sqrt(np.maximum(longest ** 2 - (x.astype(np.float64) ** 2).sum(1), 0)).astype(np.float32)
    return np.c_[x, rest]


def _assigned(entries: DataFrame, graph: Graph, longest: float, copies: int, ratio: float, pool: int) -> DataFrame:
    """``list, entry, v, ids, rows``: every entry in its lists."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), QUERY_ROWS):
                part = batch.slice(a, QUERY_ROWS)
                near, gap = graph.walk(_lifted(_matrix(part["v"]), longest), pool)
                near, gap = near[:, :copies], gap[:, :copies]
                take = gap <= (1 + ratio) ** 2 * gap[:, :1] + 1e-12
                take[:, 0] = True
                for j in range(1, near.shape[1]):  # not where a list taken before is nearer to this one's centroid
                    for i in range(j):
                        apart = ((graph.centroids[near[:, j]] - graph.centroids[near[:, i]]) ** 2).sum(1)
                        take[:, j] &= ~take[:, i] | (apart > gap[:, j])
                row, col = np.nonzero(take)
                out = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([pa.array(near[row, col]), *out.columns], ["list", *out.schema.names])

    v = entries.schema["v"].dataType.simpleString()
    return entries.mapInArrow(run, f"list long, entry long, v {v}, ids array<long>, rows array<long>")


def _asked(queries: DataFrame, graph: Graph, sizes: np.ndarray, pool: int, least: int, ratio: float, enough: int) -> DataFrame:
    """``list, q, v``: the lists each query reads.

    These are all among the ``pool`` nearest whose centroid is within ``ratio`` of the nearest,
    and at least ``least`` lists and as many as hold ``enough`` entries.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), QUERY_ROWS):
                part = batch.slice(a, QUERY_ROWS)
                near, gap = graph.walk(_flat(_matrix(part["v"])), pool)
                held = np.cumsum(sizes[near], 1) - sizes[near]  # in the lists before
                row, col = np.nonzero((gap <= ratio ** 2 * gap[:, :1]) | (np.arange(near.shape[1]) < least) | (held < enough))
                out = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([pa.array(near[row, col]), out["q"], out["v"]], ["list", "q", "v"])

    v = queries.schema["v"].dataType.simpleString()
    return queries.select("q", "v").mapInArrow(run, f"list long, q long, v {v}")


def _calibrated(entries: DataFrame, lists: DataFrame, queries: DataFrame, graph: Graph, recall: float, top: int,
                n_queries: int) -> tuple[float, int]:
    """The distance ratio that finds ``recall`` of the true neighbours, and the lists it takes at most.

    About ``n_queries`` queries are compared with every entry. For each of their neighbours the
    nearest of its lists says which ratio would have found it.
    """
    n = queries.count()
    some = F.pmod(F.xxhash64("q", F.lit(7)), F.lit(1 << 30)) < int(min(1.0, n_queries / max(n, 1)) * (1 << 30))
    chosen = queries.where(some).select("q", "v").toArrow()
    if not len(chosen):
        chosen = queries.select("q", "v").limit(1).toArrow()
    if not len(chosen):
        return 1.0, 1
    q, points = chosen["q"].to_numpy(), _matrix(chosen["v"].combine_chunks())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), SEGMENT):
                part = Segment()
                own = batch["entry"].slice(a, SEGMENT)
                one = pa.ListArray.from_arrays(pa.array(range(len(own) + 1), pa.int32()), own)
                part.add(pa.RecordBatch.from_arrays([batch["v"].slice(a, SEGMENT), one, one], ["v", "ids", "rows"]))
                part.close()
                yield _hits(*part.best(q, points.astype(np.float64), top))

    true = _merged(entries.select("entry", "v").mapInArrow(run, HITS), top).select("q", F.explode("rows").alias("entry"))
    places = lists.select("entry", "list").join(F.broadcast(true), "entry").groupBy("q", "entry").agg(
        F.collect_set("list").alias("lists")).collect()  # n_queries * top rows of a few lists
    gap = ((_flat(points) ** 2).sum(1)[:, None] + (graph.centroids ** 2).sum(1) - 2 * _flat(points) @ graph.centroids.T)
    ratio = np.sqrt(np.maximum(gap, 0) / np.maximum(gap.min(1, keepdims=True), 1e-12))
    at = {int(x): i for i, x in enumerate(q)}
    needed = np.sort([ratio[at[r.q], r.lists].min() for r in places])
    found = float(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))]) * (1 + 1e-6)
    return found, int((ratio <= found).sum(1).max())


def exact_scores(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products row by row, added up in the order of the components."""
    total = np.zeros(len(x))
    for j in range(x.shape[1]):
        total += x[:, j] * y[:, j]
    return total


def _order(q: np.ndarray, score: np.ndarray, ids: np.ndarray, rows: np.ndarray, top: int) -> np.ndarray:
    """Places of each query's ``top`` best, by score, then id, null ids (the largest number) last."""
    order = np.lexsort((rows, ids, -score, q))
    q = q[order]
    first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else np.empty(0, np.int64)
    inner = np.arange(len(q)) - np.repeat(first, np.diff(np.r_[first, len(q)]))
    return order[inner < top]


def _best(parts: list[list[np.ndarray]], top: int) -> list[np.ndarray]:
    """Each query's best of several hits, a vector that was in several lists once."""
    q, score, ids, rows = (np.concatenate(c) for c in zip(*parts))
    order = np.lexsort((rows, q))
    once = order[np.r_[True, (q[order][1:] != q[order][:-1]) | (rows[order][1:] != rows[order][:-1])]] if len(q) else order
    q, score, ids, rows = q[once], score[once], ids[once], rows[once]
    keep = _order(q, score, ids, rows, top)
    return [q[keep], score[keep], ids[keep], rows[keep]]


NO_ID = np.iinfo(np.int64).max
HITS = "q long, scores array<double>, ids array<long>, rows array<long>"


def _hits(q: np.ndarray, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
    """One row for each query of the ordered ``q``."""
    first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else np.empty(0, np.int64)
    offsets = pa.array(np.r_[first, len(q)], pa.int32())
    lists = [pa.ListArray.from_arrays(offsets, pa.array(a)) for a in (score, ids, rows)]
    return pa.RecordBatch.from_arrays([pa.array(q[first]), *lists], ["q", "scores", "ids", "rows"])


class Segment:
    """A part of a list: its vectors, and every id they stand for."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, ...]] = []

    def add(self, batch: pa.RecordBatch) -> None:
        sizes = np.diff(batch["ids"].offsets.to_numpy())
        ids = batch["ids"].flatten().fill_null(NO_ID).to_numpy(zero_copy_only=False)
        self.parts.append((_matrix(batch["v"]).astype(np.float64), sizes, ids, batch["rows"].flatten().to_numpy()))

    def close(self) -> None:
        self.x, sizes, self.ids, self.rows = (np.concatenate(p) for p in zip(*self.parts))
        self.of = np.repeat(np.arange(len(sizes)), sizes)

    def best(self, q: np.ndarray, points: np.ndarray, top: int) -> list[np.ndarray]:
        near = (points @ self.x.T)[:, self.of]
        if near.shape[1] > top:
            limit = np.partition(near, near.shape[1] - top, 1)[:, near.shape[1] - top]
            at, entry = np.nonzero(near >= (limit - SLACK * (1 + np.abs(limit)))[:, None])
        else:
            at, entry = (a.ravel() for a in np.indices(near.shape))
        score = exact_scores(points[at], self.x[self.of[entry]])
        keep = _order(q[at], score, self.ids[entry], self.rows[entry], top)
        return [q[at][keep], score[keep], self.ids[entry][keep], self.rows[entry][keep]]


def _compared(lists: DataFrame, asked: DataFrame, sizes: DataFrame, top: int) -> DataFrame:
    """The hits of every query in every part of its lists."""
    share = lambda key, n: F.pmod(F.xxhash64(key), F.col(n)).cast("long")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    v = lists.select(
        "list", F.lit(0).alias("kind"), "entry", "v", "ids", "rows"
    ).join(F.broadcast(sizes), "list").withColumn("segment", share("entry", "segments")).withColumn("part", every("parts"))
    null = F.lit(None).cast("array<long>")
    q = asked.join(F.broadcast(sizes), "list").select(
        "list", F.lit(1).alias("kind"), F.col("q").alias("entry"), "v", null.alias("ids"), null.alias("rows"),
        every("segments").alias("segment"), share("q", "parts").alias("part"))
    both = v.select(q.columns).unionByName(q)
    key = ["list", "segment", "part"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, ready = None, Segment(), False
        found: list[list[np.ndarray]] = []
        size = 0
        for batch in batches:
            marks = np.stack([batch[c].to_numpy() for c in (*key, "kind")], 1)
            cuts = np.flatnonzero(np.r_[True, (marks[1:] != marks[:-1]).any(1)])
            for a, b in zip(cuts, [*cuts[1:], len(batch)]):
                part = batch.slice(a, b - a)
                if (mine := tuple(marks[a, :3])) != now:
                    now, held, ready = mine, Segment(), False
                if marks[a, 3] == 0:
                    held.add(part)
                    continue
                if not held.parts:
                    continue
                if not ready:
                    held.close()
                    ready = True
                q, points = part["entry"].to_numpy(), _matrix(part["v"]).astype(np.float64)
                for i in range(0, len(q), QUERY_ROWS):
                    found.append(held.best(q[i:i + QUERY_ROWS], points[i:i + QUERY_ROWS], top))
                    size += len(found[-1][0])
                if size > HELD:  # lists of one task that a query reads are merged here
                    found = [_best(found, top)]
                    size = len(found[0][0])
                    if size > HELD // 2:
                        yield _hits(*found[0])
                        found, size = [], 0
        if found:
            yield _hits(*_best(found, top))

    return both.repartition(*key).sortWithinPartitions(*key, "kind").mapInArrow(run, HITS)


def _merged(hits: DataFrame, top: int) -> DataFrame:
    """One row per query: its best hits of all lists, a vector that was in several once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            sizes = np.diff(batch["ids"].offsets.to_numpy())
            new = [np.repeat(batch["q"].to_numpy(), sizes), *(batch[c].flatten().to_numpy() for c in ("scores", "ids", "rows"))]
            held = _best([held, new] if held else [new], top)
            last = held[0] == held[0][-1] if len(held[0]) else np.empty(0, bool)  # may go on
            if not last.all():
                yield _hits(*(c[~last] for c in held))
                held = [c[last] for c in held]
        if held and len(held[0]):
            yield _hits(*held)

    return hits.repartition("q").sortWithinPartitions("q").mapInArrow(run, HITS)


def nearest(table: DataFrame, top: int = 20, every: int = 20, list_size: int = 192, most_lists: int = 16_384,
            per_list: int = 32, copies: int = 4, copy_ratio: float = 0.1, recall: float = 0.96, least_probes: int = 4,
            n_calibrate: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``top`` nearest found of every ``every``-th id.

    Queries are the rows whose id ``every`` divides; candidates are all rows but the query's own.
    Nearness is the inner product in double precision, ties go to the smaller id, null ids last.
    The index is fitted on at most ``per_list * most_lists`` vectors, chosen by hash, and holds
    all. There is a list for every ``list_size`` different vectors, ``most_lists`` at most; beyond
    that lists grow and are read in segments. ``copies``: lists of one vector at most;
    ``copy_ratio``: how much farther than the nearest centroid theirs may be. The ratio up to
    which a query reads lists is the one that finds ``recall`` of the true neighbours of about
    ``n_calibrate`` queries, which are compared with all vectors; ``least_probes`` lists are
    read in any case.

    Vectors that are null, zero, of another length than most, or hold null or non-finite
    components take no part. Rows that repeat an id are rows by themselves. Other columns are
    ignored; an empty table gives no rows.
    """
    vectors = clean_vectors(table, id_col, vector_col)
    entries = _entries(vectors, top + 1)
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    n, longest = entries.agg(F.count("*"), F.max(length)).first()
    if not n:
        return table.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    n_lists = int(min(max(1, -(-n // list_size)), most_lists))
    share = min(1.0, per_list * n_lists / n)
    sample = entries.where(F.pmod(F.xxhash64("entry"), F.lit(1 << 30)) < int(share * (1 << 30))).select("v").toArrow()
    points = _lifted(_matrix(sample["v"].combine_chunks()), longest) if len(sample) else np.zeros((0, 0), np.float32)
    if not len(points):  # a sample of hardly any rows may be empty
        points = _lifted(_matrix(entries.select("v").limit(1).toArrow()["v"].combine_chunks()), longest)
    graph = build_graph(table, balanced_centroids(points, n_lists))
    lists = stage(_assigned(entries, graph, longest, copies, copy_ratio, 2 * copies + 8), "lists")
    held = lists.groupBy("list").agg(F.count("*").alias("n_held"))  # of most_lists rows
    sizes = np.zeros(len(graph.centroids), np.int64)
    for r in held.collect():
        sizes[r.list] = r.n_held

    rows = vectors.where(F.col("vec_id") % every == 0)
    queries = stage(rows.groupBy("h", "v").agg(F.min("row").alias("q"), F.count("*").alias("n_rows")), "queries")
    ratio, most = _calibrated(entries, lists, queries, graph, recall, top + 1, n_calibrate)
    asked = stage(_asked(queries, graph, sizes, most * 5 // 4 + 32, least_probes, ratio, copies * (top + 1)), "asked")
    counts = asked.groupBy("list").agg(F.count("*").alias("n_asked")).join(held, "list")
    parts = lambda c: F.ceil(F.col(c) / SEGMENT).cast("long")
    cut = stage(counts.select("list", parts("n_held").alias("segments"), parts("n_asked").alias("parts")), "cuts")
    best = stage(_merged(_compared(lists, asked, cut, top + 1), top + 1), "hits")

    same = F.struct("h", "v").alias("key")
    answers = stage(best.join(queries, "q").select(same, "scores", "ids", "rows", "n_rows"), "answers")
    found = join_classes(rows.select("row", "vec_id", same), answers, "key", F.col("n_rows"))
    hit = F.arrays_zip("scores", "ids", "rows")
    others = F.slice(F.filter(hit, lambda x: x["rows"] != F.col("row")), 1, top)
    return found.select(F.col("vec_id").alias("query_id"), F.posexplode(others).alias("rank", "hit")).select(
        "query_id", (F.col("rank") + 1).cast("int").alias("rank"),
        F.when(F.col("hit.ids") < NO_ID, F.col("hit.ids")).alias("vec_id"), F.col("hit.scores").alias("score"))
