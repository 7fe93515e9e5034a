"""Repeated passages, removed line by line and sentence by sentence from all but their first document."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import documents, join_classes, stage

LINE = regex.compile(r"[^\n]+")
SENTENCE = regex.compile(r"\S(?:[^.!?\n]|[.!?](?!\s|$))*+[.!?]*")


def units(text: str, min_words: int) -> list[tuple[int, int, str]]:
    """``start, end, normalised`` of the units of a text, in order of their places.

    Units are each line, each sentence in a line of several, and for each sentence of fewer than
    ``min_words`` words the least run of sentences from it on, and the least run up to it, that
    has as many. So wherever a passage of whole sentences or lines begins, its units are the
    same, and they hold all its words. Only a text that is shorter as a whole has none. A unit
    that overlaps the first equal one is left out: it is no repeat of it. So of a text that goes
    on repeating short lines, fewer than ``min_words`` words at its end may lie in no unit.

    Offsets count characters of the text. Normalised is lower case with single spaces and no
    marks at the end.
    """
    found: set[tuple[int, int, str]] = set()
    parts: list[tuple[int, int, list[str]]] = []
    for line in LINE.finditer(text):
        words = line[0].lower().split()
        if not words:
            continue
        if len(words) >= min_words:
            found.add((*line.span(), _normal(words)))
        own = [(*s.span(), s[0].lower().split()) for s in SENTENCE.finditer(text, *line.span())]
        parts += own if len(own) > 1 else [(*line.span(), words)]
        if len(own) > 1:
            found.update((a, b, _normal(w)) for a, b, w in own if len(w) >= min_words)
    for n, (_, _, words) in enumerate(parts):
        if len(words) < min_words:
            for step in (1, -1):
                size, m = len(words), n
                while size < min_words and 0 <= m + step < len(parts):
                    m += step
                    size += len(parts[m][2])
                if size >= min_words:
                    run = parts[min(n, m):max(n, m) + 1]
                    found.add((run[0][0], run[-1][1], _normal([w for part in run for w in part[2]])))
    ends: dict[str, int] = {}  # where the first of equal units ends
    out = []
    for unit in sorted(found):
        low, high, words = unit
        if words not in ends or low >= ends[words]:
            ends.setdefault(words, high)
            out.append(unit)
    return out


def _normal(words: list[str]) -> str:
    return " ".join(words).rstrip(".!?,;: ")


def digest(unit: str) -> tuple[int, int]:
    both = np.frombuffer(xxhash.xxh3_128_digest(unit.encode("utf-8", "surrogatepass")), "<i8")
    return int(both[0]), int(both[1])


def _occurrences(docs: DataFrame, min_words: int) -> DataFrame:
    """``doc_id, mark, d1, d2, again`` of each different unit of a row; ``again``: the row repeats it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, again, sizes = [], [], []
            for text in batch["text"].to_pylist():
                own: dict[bytes, bool] = {}
                for _, _, u in units(text, min_words):
                    key = xxhash.xxh3_128_digest(u.encode())
                    own[key] = key in own
                keys += own
                again += own.values()
                sizes.append(len(own))
            both = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
            owner = pa.array(np.repeat(np.arange(len(sizes)), sizes))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(owner), batch["mark"].take(owner), pa.array(both[:, 0].copy()),
                 pa.array(both[:, 1].copy()), pa.array(again, pa.bool_())],
                ["doc_id", "mark", "d1", "d2", "again"],
            )

    return docs.mapInArrow(run, "doc_id long, mark int, d1 long, d2 long, again boolean")


def remove_repeats(docs: DataFrame, min_words: int = 8, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``doc_id, text, removed, n_removed_chars``: texts without passages that came before.

    Units are lines, the sentences of a line and runs of short ones (``units``), compared in
    lower case with single spaces and by a 128-bit digest. The first occurrence by (doc_id,
    position) stays; ``removed`` lists the others as ``struct<start, end>`` in characters of the
    original text, in order and merged where they touch or overlap. A line break stays where a
    unit goes, but those inside a run go with it. Null texts are empty. Rows that repeat an id are one document: they share the decision about each unit.
    A null id ranks last; among nothing but null ids every row keeps its units. Other columns
    are ignored.
    """
    # Rows with one id, or none, are told apart by their texts, so that none gathers another's units.
    mark = F.pmod(F.xxhash64("text"), F.lit(1 << 16)).cast("int").alias("mark")
    clean = documents(docs, id_col, text_col).select("doc_id", mark, "text")
    found = stage(_occurrences(clean, min_words), "units")
    shared = found.groupBy("d1", "d2").agg(
        F.min("doc_id").alias("first_id"), F.count("*").alias("n"), F.max("doc_id").alias("last_id"),
        F.count("doc_id").alias("known"),
    ).where("n > 1 AND first_id IS NOT NULL AND (first_id <> last_id OR known < n)")
    shared = stage(shared.select(F.struct("d1", "d2").alias("key"), "first_id", "n"), "shared")
    keyed = found.select("doc_id", "mark", F.struct("d1", "d2").alias("key"))
    repeated = join_classes(keyed, shared, "key", F.col("n")).where(
        "first_id IS NOT NULL AND NOT (doc_id <=> first_id)"
    ).select("doc_id", "mark", F.struct("key.d1", "key.d2").alias("unit")).distinct()
    inside = found.where("again").select("doc_id", "mark").distinct().withColumn(
        "unit", F.lit(None).cast(repeated.schema["unit"].dataType))
    # As many as a text has units; texts that are in no list lose nothing and are not read again.
    per_row = repeated.unionByName(inside).groupBy("doc_id", "mark").agg(F.collect_list("unit").alias("gone")) \
        .select(F.col("doc_id").alias("gone_id"), F.col("mark").alias("gone_mark"), "gone")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = [], []
            for text, gone in zip(batch["text"].to_pylist(), batch["gone"].to_pylist()):
                if gone is None:
                    texts.append(text)
                    spans.append([])
                    continue
                listed = {(g["d1"], g["d2"]) for g in gone}
                seen: set = set()
                cut: list[list[int]] = []
                for low, high, unit in units(text, min_words):
                    key = digest(unit)
                    if key in listed or key in seen:
                        if cut and low <= cut[-1][1]:
                            cut[-1][1] = max(cut[-1][1], high)
                        else:
                            cut.append([low, high])
                    seen.add(key)
                ends = [0, *(e for _, e in cut)]
                starts = [*(s for s, _ in cut), len(text)]
                texts.append("".join(text[a:b] for a, b in zip(ends, starts)))
                spans.append([{"start": a, "end": b} for a, b in cut])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(texts, pa.string()), pa.array(spans, kind),
                 pa.array([sum(x["end"] - x["start"] for x in s) for s in spans], pa.int64())],
                ["doc_id", "text", "removed", "n_removed_chars"],
            )

    same = F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.col("mark") == F.col("gone_mark"))
    both = clean.join(per_row, same, "left").select("doc_id", "text", "gone")
    return both.mapInArrow(run, "doc_id long, text string, removed array<struct<start:long,end:long>>, n_removed_chars long")
