"""Packing of documents into sequences: online best fit with a fixed number of open bins."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import documents, stage
from .tokens import encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class BestFit:
    """Bins of one task. ``open_bins`` may be open at once; then the fullest closes first.

    Bins are kept by their free space, and bit f of ``free`` says that some bin has f places
    left. The best fit is the lowest set bit from the wanted length on, the fullest bin the
    lowest set bit of all.
    """

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.open_bins = capacity, open_bins
        self.free, self.bins = 0, [[] for _ in range(capacity + 1)]
        self.opened = self.n_open = 0

    def _take(self, space: int) -> int:
        bins = self.bins[space]
        bin_ = bins.pop()
        if not bins:
            self.free &= ~(1 << space)
        self.n_open -= 1
        return bin_

    def add(self, length: int) -> tuple[int, int]:
        """The bin and the offset in it for a piece of ``length`` tokens."""
        fitting = self.free >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            bin_ = self._take(space)
        else:
            if self.n_open == self.open_bins:
                self._take((self.free & -self.free).bit_length() - 1)
            space, bin_ = self.capacity, self.opened
            self.opened += 1
        left = space - length
        if left:
            self.bins[left].append(bin_)
            self.free |= 1 << left
            self.n_open += 1
        return bin_, self.capacity - space


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1,
           keep_ids: bool = False) -> DataFrame:
    """Documents as pieces of at most ``capacity`` tokens; only longer documents are cut."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer).encode, np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].cast(pa.binary()).to_pylist()):
                ids = encode(text) + end
                for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    row = (doc_id, n, at // 4, len(part) // 4, zlib.crc32(part))
                    rows.append((*row, np.frombuffer(part, "<u4")) if keep_ids else row)
            columns = zip(*rows) if rows else [[]] * (5 + keep_ids)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, kinds)], names[:5 + keep_ids]
            )

    schema = PIECES + (", ids array<long>" if keep_ids else "")
    return documents(docs).mapInArrow(run, schema)


def pack(parts: DataFrame, capacity: int = 4096, open_bins: int = 512,
         rows_per_task: int = 50_000) -> DataFrame:
    """Adds ``sequence_id, offset`` to rows with a ``length`` of at most ``capacity``.

    The rows are dealt evenly to tasks, whatever their keys, and arrive there in hashed order:
    mixed lengths suit a bounded number of bins. Each task numbers its own sequences, so the
    number of half-empty last bins is that of the tasks, not of the documents.
    """
    tasks = max(1, -(-parts.count() // rows_per_task))
    keys = [c for c in ("doc_id", "piece", "start", "ids_crc32") if c in parts.columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, base = BestFit(capacity, open_bins), TaskContext.get().partitionId() << 40
        for batch in batches:
            placed = [bins.add(n) for n in batch["length"].to_pylist()]
            ids, offsets = zip(*placed) if placed else ((), ())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([base + i for i in ids], pa.int64()), pa.array(offsets, pa.int64())],
                [*batch.schema.names, "sequence_id", "offset"],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema)
    return parts.repartition(tasks).sortWithinPartitions(F.xxhash64(*keys), *keys).mapInArrow(
        run, schema + ", sequence_id long, offset long"
    )


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 4096, open_bins: int = 512,
                   end_id: int = 1, keep_ids: bool = False) -> DataFrame:
    """One row per piece of a document with its place in a sequence.

    Columns: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``, and with
    ``keep_ids`` the piece's ``ids``. A document's ids end with ``end_id``, so an empty or null
    text is one piece of one token. Rows that repeat an id are packed one by one; a null id
    stays null; other columns are ignored; an empty table gives no rows.
    """
    return pack(stage(pieces(docs, tokenizer, capacity, end_id, keep_ids), "pieces"), capacity, open_bins)


def sequences(packed: DataFrame) -> DataFrame:
    """The filled sequences, ``sequence_id, ids``, from pieces packed with ``keep_ids``.

    A sequence is bounded by its capacity, so gathering its pieces in one row is safe.
    """
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten("parts.ids").alias("ids"))
