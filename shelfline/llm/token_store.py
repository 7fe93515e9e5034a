"""Token ids in files, with constant-time access by document key.

A store is a Parquet folder with one row per shard. A shard covers a range of documents in
ascending order and holds

* ``payload``: the raw ids, 16 bits each where the vocabulary allows it, else 32;
* ``offsets``: where each document starts in the payload, and where the last one ends;
* ``levels``, ``ordinals``, ``prints``: a minimal perfect hash of the document keys, and for
  each of its slots the document's ordinal in the shard and a fingerprint of its key.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import documents, new_folder
from .tokens import encoder

SHARD = """shard long, first_id long, last_id long, n_docs long, n_ids long, id_bytes int, keys array<long>,
payload binary, offsets binary, levels array<binary>, ordinals binary, prints binary"""


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser over keys and a seed."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (_mix(keys, -2) >> np.uint64(32)).astype("<u4")


class PerfectHash:
    """Keys to 0..n-1 without storing them.

    Level by level, keys are hashed into a bit array of twice their number; those alone in
    their place are settled there and set its bit, the others go on to the next level. A key's
    slot is the number of set bits before its own.
    """

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.ranks, before = [], 0
        for bits in levels:
            self.ranks.append(before + np.r_[0, np.cumsum(bits)])
            before = int(self.ranks[-1][-1])
        self.size = before

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, left = [], keys
        while len(left):
            size = max(2 * len(left), 8)
            place = _mix(left, len(levels)) % np.uint64(size)
            alone = np.bincount(place.astype(np.int64), minlength=size) == 1
            levels.append(alone)
            left = left[~alone[place.astype(np.int64)]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 where no level has its bit. Unknown keys may get a slot."""
        found = np.full(len(keys), -1, np.int64)
        for n, bits in enumerate(self.levels):
            open_ = np.flatnonzero(found < 0)
            place = (_mix(keys[open_], n) % np.uint64(len(bits))).astype(np.int64)
            set_ = bits[place]
            found[open_[set_]] = self.ranks[n][place[set_]]
        return found

    def pack(self) -> list[bytes]:
        return [np.uint32(len(b)).astype("<u4").tobytes() + np.packbits(b).tobytes() for b in self.levels]

    @classmethod
    def unpack(cls, levels: list[bytes]) -> PerfectHash:
        return cls([np.unpackbits(np.frombuffer(x, np.uint8, offset=4))[:int(np.frombuffer(x, "<u4", 1)[0])]
                    .astype(bool) for x in levels])


class Shard:
    """A shard row, ready for lookups."""

    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["payload"], f"<u{row['id_bytes']}")
        self.offsets = np.frombuffer(row["offsets"], "<u8").astype(np.int64)
        self.hash = PerfectHash.unpack(row["levels"])
        self.ordinals = np.frombuffer(row["ordinals"], "<u4").astype(np.int64)
        self.prints = np.frombuffer(row["prints"], "<u4")

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Ordinals of the first document with each key; -1 where the fingerprint differs."""
        keys = np.asarray(keys, np.int64)
        if not self.hash.size:
            return np.full(len(keys), -1, np.int64)
        slots = self.hash.slots(keys)
        good = (slots >= 0) & (self.prints[slots] == fingerprints(keys))
        return np.where(good, self.ordinals[slots], -1)

    def read(self, ordinal: int) -> np.ndarray:
        return self.ids[self.offsets[ordinal]:self.offsets[ordinal + 1]]


def _shard(number: int, keys: list, ids: list[bytes], id_bytes: int) -> dict:
    wide = np.frombuffer(b"".join(ids), "<u4")
    offsets = np.cumsum([0, *(len(x) // 4 for x in ids)]).astype("<u8")
    known = np.array([k for k in keys if k is not None], np.int64)
    first = len(keys) - len(known)  # null keys sort first and are not indexed
    own, at = np.unique(known, return_index=True)
    table = PerfectHash.build(own)
    slots = table.slots(own)
    ordinals, prints = np.empty(len(own), "<u4"), np.empty(len(own), "<u4")
    ordinals[slots], prints[slots] = at + first, fingerprints(own)
    return {
        "shard": number, "first_id": int(own[0]) if len(own) else None, "last_id": int(own[-1]) if len(own) else None,
        "n_docs": len(keys), "n_ids": len(wide), "id_bytes": id_bytes, "keys": keys,
        "payload": wide.astype(f"<u{id_bytes}").tobytes(), "offsets": offsets.tobytes(),
        "levels": table.pack(), "ordinals": ordinals.tobytes(), "prints": prints.tobytes(),
    }


def write_store(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, shard_bytes: int = 16 << 20) -> None:
    """Encode every text, append ``end_id``, and write shards in ascending ``doc_id`` order.

    Documents are dealt by ranges of (id, text hash), so even an id that a third of all rows
    share is split. A shard closes once its ids reach ``shard_bytes``; a document is never
    split. Null texts are empty; null ids come first and are stored, but not indexed; other
    columns are ignored.
    """
    schema = pa.schema([
        ("shard", pa.int64()), ("first_id", pa.int64()), ("last_id", pa.int64()), ("n_docs", pa.int64()),
        ("n_ids", pa.int64()), ("id_bytes", pa.int32()), ("keys", pa.list_(pa.int64())), ("payload", pa.binary()),
        ("offsets", pa.binary()), ("levels", pa.list_(pa.binary())), ("ordinals", pa.binary()), ("prints", pa.binary()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        id_bytes = 2 if max(enc.split.ids, end_id + 1) <= 1 << 16 else 4
        number, keys, ids, held = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            for key, text in zip(batch["doc_id"].to_pylist(), batch["text"].cast(pa.binary()).to_pylist()):
                keys.append(key)
                ids.append(enc.encode(text) + end)
                held += len(ids[-1]) * id_bytes // 4
                if held >= shard_bytes:
                    yield pa.RecordBatch.from_pylist([_shard(number, keys, ids, id_bytes)], schema)
                    number, keys, ids, held = number + 1, [], [], 0
        if keys:
            yield pa.RecordBatch.from_pylist([_shard(number, keys, ids, id_bytes)], schema)

    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    documents(docs).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, SHARD) \
        .write.option("compression", "zstd").parquet(path)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every stored document, looked up by its key.

    ``start`` counts the ids of all documents before it in the whole store. A document whose
    key the index does not lead to raises an error.
    """
    table = spark.read.schema(SHARD).parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard, keys = Shard(row), row["keys"]
                nulls = sum(k is None for k in keys)
                known = np.array(keys[nulls:], np.int64)
                at = shard.find(known)
                if (at < 0).any():
                    raise ValueError(f"shard {row['shard']}: the index misses keys")
                fresh = np.r_[True, known[1:] != known[:-1]][:len(known)]
                runs = np.flatnonzero(fresh)
                again = np.arange(len(known)) - np.repeat(runs, np.diff(np.r_[runs, len(known)]))
                places = np.r_[np.arange(nulls), at + again].astype(np.int64)
                low, high = shard.offsets[places], shard.offsets[places + 1]
                ids = memoryview(shard.ids.astype("<u4").tobytes())
                sums = [zlib.crc32(ids[4 * a:4 * b]) for a, b in zip(low.tolist(), high.tolist())]
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array([row["shard"]] * len(keys), pa.int64()), "doc_id": pa.array(keys, pa.int64()),
                    "own": low, "n_tokens": high - low, "ids_crc32": pa.array(sums, pa.int64()),
                })

    found = table.mapInArrow(run, "shard long, doc_id long, own long, n_tokens long, ids_crc32 long")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = table.select("shard", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    return found.join(base, "shard").select(
        "doc_id", (F.col("base") + F.col("own")).alias("start"), "n_tokens", "ids_crc32"
    )


def fetch(spark: SparkSession, path: str, keys: list[int]) -> dict[int, np.ndarray]:
    """The ids of a few documents. Only shards whose key range holds one of them are read."""
    table, found = spark.read.schema(SHARD).parquet(path), {}
    wanted = [(F.col("first_id") <= k) & (F.col("last_id") >= k) for k in keys]
    for row in table.where(F.expr("false") if not wanted else _any(wanted)).drop("keys").toLocalIterator():
        shard = Shard(row.asDict())
        for key, at in zip(keys, shard.find(np.array(keys, np.int64)).tolist()):
            if at >= 0 and row["first_id"] <= key <= row["last_id"]:
                found.setdefault(key, shard.read(at).astype(np.int64))
    return found


def _any(conditions: list) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write a store to the shared folder and read every document back from it."""
    path = new_folder(docs.sparkSession, "store")
    write_store(docs, path, tokenizer, end_id)
    return read_store(docs.sparkSession, path)
