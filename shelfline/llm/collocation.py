"""Phrases whose words stand together more often than apart, mined after Toivonen.

A sample proposes the phrases that are frequent in it at a lowered threshold. One pass over all
texts then counts these and their negative border: every phrase that is not proposed but whose
parts (all but the last word, all but the first) are. A border phrase that turns out frequent
is a failure of the sample; it makes longer phrases possible that nobody has counted, so a
further pass counts those whose parts are now known to be frequent, until a pass finds nothing
that could be extended. Phrases have ``longest`` words at most, so there are at most as many
passes. The sample decides only how much is counted when; the result is that of a full count.

Texts are read once and staged as blocks: the different words of a block, and the text as
numbers of these words. Phrases are counted by 64-bit hashes, summed up in each block first, and the
sets that the passes ask for are bit fields of bounded size: a wrong hit counts a phrase in vain,
a hash clash only adds to a count, so none loses a frequent phrase. The phrases that pass are
counted once more as text, which decides.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import stage

BLOCK_WORDS = 500_000  # of one language
HELD_WORDS = 4_000_000  # of all languages in a task
BUCKET_WORDS = 1_000_000  # a pass has a range of hashes for so many words
HELD_COUNTS = 4_000_000
SLOTS = 1 << 26
SCALE = 2_000_000
BREAK = -1  # the place of a piece's end among word numbers
_FOLD = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0a\x0b\x0c\x0d\x09", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 10 + b" "
)
BLOCKS = "sampled boolean, lang string, words binary, hashes binary, places binary"


class Numbers(dict):
    """Words to numbers, new ones in turn."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self) - 1
        return number


class Block:
    """Texts of one language: word numbers with breaks, and the words behind the numbers."""

    def __init__(self) -> None:
        self.numbers = Numbers({b"\n": BREAK})
        self.places: list[np.ndarray] = []
        self.size = 0

    def add(self, text: bytes) -> None:
        words = text.translate(_FOLD).replace(b"\n", b" \n ").split(b" ")
        found = [*map(self.numbers.__getitem__, filter(None, words)), BREAK]
        self.places.append(np.array(found, np.int32))
        self.size += len(found)

    def row(self, lang: str, sampled: bool) -> tuple:
        words = [*self.numbers][1:]
        seed = xxhash.xxh64_intdigest(lang.encode())
        hashes = np.array([xxhash.xxh64_intdigest(w, seed=seed) for w in words], np.uint64)
        return sampled, lang, b"\n".join(words), hashes.tobytes(), np.concatenate(self.places).tobytes()


def _emit(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.bool_(), pa.string(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)],
        ["sampled", "lang", "words", "hashes", "places"],
    )


def _blocks(docs: DataFrame) -> DataFrame:
    """The texts as blocks, sampled ones apart; the language is part of every hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, bool], Block] = {}
        size = 0
        for batch in batches:
            for lang, sampled, text in zip(batch["lang"].to_pylist(), batch["sampled"].to_pylist(),
                                           batch["text"].cast(pa.binary()).to_pylist()):
                block = held.setdefault((lang, sampled), Block())
                before = block.size
                block.add(text)
                size += block.size - before
                if block.size >= BLOCK_WORDS:
                    size -= block.size
                    yield _emit([held.pop((lang, sampled)).row(lang, sampled)])
                if size >= HELD_WORDS:  # many languages: none is full, together they are
                    for key in [*held]:
                        yield _emit([held.pop(key).row(*key)])
                    size = 0
        for key in [*held]:
            yield _emit([held.pop(key).row(*key)])

    return docs.mapInArrow(run, BLOCKS)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def phrase_hashes(places: np.ndarray, hashes: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length: the hash of the phrase from every place on, and whether it ends in time.

    The lowest two bits hold the number of words less one.
    """
    word = np.zeros(len(places) + longest, np.uint64)
    inside = np.zeros(len(places) + longest, bool)
    inside[:len(places)] = places >= 0
    word[:len(places)][inside[:len(places)]] = hashes[places[places >= 0]]
    n = len(places)
    whole, ends = word[:n].copy(), inside[:n].copy()
    for k in range(longest):
        if k:
            whole = _mix(whole * np.uint64(0x9E3779B97F4A7C15) + word[k:n + k])
            ends = ends & inside[k:n + k]
        whole = (whole & ~np.uint64(3)) | np.uint64(k)
        yield whole, ends


class Bits:
    """A set of hashes as a bit field of bounded size, which travels compressed."""

    def __init__(self, field: bytes) -> None:
        self.field = np.frombuffer(zlib.decompress(field), np.uint8)
        self.mask = np.uint64(len(self.field) * 8 - 1)

    def has(self, h: np.ndarray) -> np.ndarray:
        slot = (h >> np.uint64(8)) & self.mask
        return (self.field[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1

    def extends(self, h: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Where the phrase and the next one of its length are members, so that both may be one longer one."""
        member = ends & self.has(h)
        return member & np.r_[member[1:], False]


def bit_field(hashes: DataFrame, slots: int = SLOTS) -> bytes:
    """The members' slots, set in ranges on the executors and put together here.

    A field has 16 slots or more for each of the staged ``hashes``, ``slots`` at most.
    """
    slots = min(slots, 1 << max(16, (16 * hashes.count()).bit_length()))
    span = min(1 << 18, slots)  # bits of one range
    slot = F.shiftrightunsigned("h", 8).bitwiseAND(F.lit(slots - 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(0, np.uint8)
        now = -1

        def close() -> pa.RecordBatch:
            field = np.packbits(bits, bitorder="little").tobytes()
            return pa.RecordBatch.from_pydict({"part": [now], "field": pa.array([field], pa.binary())})

        for batch in batches:
            s = batch["slot"].to_numpy(zero_copy_only=False)
            part = s // span
            for p in np.unique(part):
                if p != now:
                    if now >= 0:
                        yield close()
                    now, bits = int(p), np.zeros(span, np.uint8)
                bits[s[part == p] % span] = 1
        if now >= 0:
            yield close()

    rows = hashes.select(slot.alias("slot")).withColumn("part", F.floor(F.col("slot") / span))
    dealt = rows.repartition("part").sortWithinPartitions("part").drop("part")
    field = bytearray(slots // 8)
    for r in dealt.mapInArrow(run, "part long, field binary").toLocalIterator():  # slots / 8 bytes in all
        field[r.part * span // 8:(r.part + 1) * span // 8] = r.field
    return zlib.compress(field, 1)


def _count(blocks: DataFrame, longest: int, least: int, now: bytes | None, done: list[bytes], buckets: int) -> DataFrame:
    """``h, n`` of the phrases that occur ``least`` times, of those a pass asks for.

    ``now``: the field of the phrases that may be extended; None counts everything. ``done``:
    the fields of earlier passes, which have counted what these allow. A block's counts travel
    as arrays, one for each range of hashes.
    """
    edges = np.array([(i << 64) // buckets for i in range(1, buckets)], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field, before = now and Bits(now), [*map(Bits, done)]
        for batch in batches:
            for hashes, places in zip(batch["hashes"], batch["places"]):
                hashes, places = (np.frombuffer(x.as_buffer(), t) for x, t in ((hashes, np.uint64), (places, np.int32)))
                asked: np.ndarray | None = None
                counts = []
                for k, (h, ends) in enumerate(phrase_hashes(places, hashes, longest)):
                    if k == 0 or not field:
                        wanted = ends if not before or k else np.zeros(len(ends), bool)
                    else:
                        wanted = ends & asked
                    counts.append(np.unique(h[wanted], return_counts=True))
                    if field and k + 1 < longest:
                        asked = field.extends(h, ends)
                        for b in before:
                            asked &= ~b.extends(h, ends)
                own, n = (np.concatenate(c) for c in zip(*counts))
                order = np.argsort(own)
                own, n = own[order], n[order].astype(np.uint32)
                cuts = [0, *np.searchsorted(own, edges).tolist(), len(own)]
                some = [i for i in range(buckets) if cuts[i] < cuts[i + 1]]
                yield pa.RecordBatch.from_arrays([
                    pa.array(some, pa.int32()), pa.array([own[cuts[i]:cuts[i + 1]].tobytes() for i in some], pa.binary()),
                    pa.array([n[cuts[i]:cuts[i + 1]].tobytes() for i in some], pa.binary())], ["bucket", "h", "n"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held, size = -1, [], 0

        def total() -> tuple[np.ndarray, np.ndarray]:
            h, n = (np.concatenate(c) for c in zip(*held))
            order = np.argsort(h)
            h = h[order]
            first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
            return h[first], np.add.reduceat(n[order], first)

        def close() -> pa.RecordBatch:
            h, n = total()
            often = n >= least
            return pa.RecordBatch.from_arrays([pa.array(h[often].view(np.int64)), pa.array(n[often])], ["h", "n"])

        for batch in batches:
            for b, h, n in zip(batch["bucket"].to_pylist(), batch["h"], batch["n"]):
                if b != bucket and held:
                    yield close()
                    held, size = [], 0
                bucket = b
                held.append((np.frombuffer(h.as_buffer(), np.uint64).copy(), np.frombuffer(n.as_buffer(), np.uint32).astype(np.int64)))
                size += len(held[-1][0])
                if size > HELD_COUNTS:
                    held = [total()]
                    size = 0
        if held:
            yield close()

    counted = blocks.select("hashes", "places").mapInArrow(run, "bucket int, h binary, n binary")
    return counted.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(add, "h long, n long")


def frequent(blocks: DataFrame, longest: int, least: int, fraction: float, slack: float,
             slots: int = SLOTS) -> tuple[bytes, int]:
    """A bit field that holds every phrase with ``least`` occurrences, and the passes it took."""
    lowered = max(2, int(least * fraction * slack))
    words = blocks.agg(F.sum(F.length("places"))).first()[0] or 0
    buckets = max(1, words // 4 // BUCKET_WORDS)  # a place takes four bytes
    few = max(1, int(buckets * fraction * longest))
    proposed = stage(_count(blocks.where("sampled"), longest, lowered, None, [], few), "proposed")
    fields = [bit_field(proposed, slots)]
    found = stage(_count(blocks, longest, least, fields[0], [], buckets), "counted")
    short = F.col("h").bitwiseAND(F.lit(3)) < longest - 1  # can be extended
    passes = 1
    bits = fields[0]

    def outside(rows: DataFrame, field: bytes) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = Bits(field)
            for batch in batches:
                h = batch["h"].to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([pa.array(h[~known.has(h.view(np.uint64))])], ["h"])

        return rows.select("h").mapInArrow(run, "h long")

    while not outside(found.where(short), bits).isEmpty():  # the border holds phrases that may go on
        bits = bit_field(found, slots)
        more = stage(_count(blocks, longest, least, bits, fields, buckets), "counted")
        fields.append(bits)
        found = found.unionByName(more)
        passes += 1
    return bit_field(found, slots), passes


def _phrases(blocks: DataFrame, longest: int, least: int, field: bytes) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, size, f`` of the frequent ones, counted as text, and ``lang, n``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = Bits(field)
        for batch in batches:
            for lang, words, hashes, places in zip(*(batch[c].to_pylist() for c in ("lang", "words", "hashes", "places"))):
                words = words.split(b"\n")
                hashes, places = np.frombuffer(hashes, np.uint64), np.frombuffer(places, np.int32)
                texts, sizes, counts = [None], [0], [int((places >= 0).sum())]
                for k, (h, ends) in enumerate(phrase_hashes(places, hashes, longest)):
                    at = np.flatnonzero(ends & wanted.has(h))
                    if not len(at):
                        break
                    _, first, own, n = np.unique(h[at], return_index=True, return_inverse=True, return_counts=True)
                    mine, lead = places[at[:, None] + np.arange(k + 1)], places[at[first][:, None] + np.arange(k + 1)]
                    if (mine != lead[own]).any():  # one hash for several phrases: the words decide
                        lead, n = np.unique(mine, axis=0, return_counts=True)
                    texts += [b" ".join([words[i] for i in row]) for row in lead.tolist()]
                    sizes += [k + 1] * len(lead)
                    counts += n.tolist()
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(texts), pa.string()), pa.array(texts, pa.binary()).cast(pa.string()),
                    pa.array(sizes, pa.int8()), pa.array(counts, pa.int64()),
                ], ["lang", "phrase", "size", "f"])

    rows = blocks.drop("sampled").mapInArrow(run, "lang string, phrase string, size byte, f long")
    summed = stage(rows.groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f")).where(
        (F.col("size") == 0) | (F.col("f") >= least)), "phrases")
    return summed.where("size > 0"), summed.where("size = 0").select("lang", F.col("f").alias("n"))


def _cuts(longest: int) -> Column:
    """Every way to cut a phrase in two, with the number of words in front."""
    words = F.split("phrase", " ")
    return F.explode(F.transform(F.sequence(F.lit(1), F.col("size") - 1), lambda k: F.struct(
        k.cast("int").alias("k"), F.array_join(F.slice(words, F.lit(1), k), " ").alias("front"),
        F.array_join(F.slice(words, k + 1, F.lit(longest)), " ").alias("rest"),
    )))


def _inner(longest: int) -> Column:
    """The phrases of two words or more that lie inside a phrase, itself left out."""
    words, size = F.split("phrase", " "), F.col("size").cast("int")
    runs = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda k: F.transform(
        F.sequence(F.lit(1), size - k + 1), lambda i: F.array_join(F.slice(words, i, k), " "))))
    return F.explode(F.array_distinct(runs))


def _with_parts(cuts: DataFrame, phrases: DataFrame, side: str, share: int = 1000) -> DataFrame:
    """``cuts`` with the frequency of one side; sides that very many cuts share are broadcast.

    There are at most ``share`` such sides, whatever the input.
    """
    f = phrases.select("lang", F.col("phrase").alias(side), F.col("f").alias(f"f_{side}"))
    total = cuts.count()
    often = cuts.groupBy("lang", side).agg(F.count("*").alias("n_cuts")).where(F.col("n_cuts") * share > total)
    often = stage(often.drop("n_cuts"), "often")
    key = ["lang", side]
    hot = F.broadcast(stage(f.join(F.broadcast(often), key, "left_semi"), "often"))
    cold = cuts.join(F.broadcast(often), key, "left_anti").join(f, key)
    return cuts.join(hot, key).unionByName(cold)


def collocations(docs: DataFrame, least: int = 30, top: int = 2000, longest: int = 4, covered: int = 80,
                 fraction: float = 0.1, slack: float = 1.0, slots: int = SLOTS,
                 text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Each language's best phrases: ``lang, rank, phrase, a, l, r, n, score``.

    Texts are lower-cased in A-Z, cut into pieces at ``. , ; : ! ?`` and line breaks and into
    words at spaces and tabs. A phrase of 2 to ``longest`` words (four at most) that occurs
    ``a >= least`` times inside pieces scores floor(2,000,000 a / (l + r)) at its worst cut, l
    and r being the counts of the two parts; of equal cuts the one nearest the front counts. A
    phrase is dropped when a longer one that holds it occurs at least ``covered`` percent as
    often. ``n`` is the language's number of words.

    ``fraction`` of the rows propose; the result does not depend on it. Null texts are empty, a
    null language is ``und``; empty languages and tables give no rows; repeated rows count each;
    other columns are ignored.
    """
    if not 2 <= longest <= 4:
        raise ValueError("phrases have two to four words")
    row = F.pmod(F.xxhash64(F.col(text_col)), F.lit(1 << 20))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        text.alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
        (row < int(fraction * (1 << 20))).alias("sampled"),
    )
    blocks = stage(_blocks(rows), "blocks", "sampled")
    field, _ = frequent(blocks, longest, least, fraction, slack, slots)
    phrases, words = _phrases(blocks, longest, least, field)
    candidates = phrases.where("size > 1")
    claims = candidates.where("size > 2").select("lang", _inner(longest).alias("phrase"), F.col("f").alias("longer"))
    kept = candidates.withColumn("longer", F.lit(0).cast("long")).unionByName(
        claims.withColumn("f", F.lit(None).cast("long")).withColumn("size", F.lit(None).cast("byte"))
    ).groupBy("lang", "phrase").agg(F.max("f").alias("a"), F.max("size").alias("size"), F.max("longer").alias("longer"))
    kept = kept.where((F.col("longer").cast("decimal(20,0)") * 100 < F.col("a").cast("decimal(20,0)") * covered))
    cuts = stage(kept.select("lang", "phrase", "a", _cuts(longest).alias("c")).select("lang", "phrase", "a", "c.*"), "cuts")
    both = _with_parts(_with_parts(cuts, phrases, "front"), phrases, "rest")
    whole = lambda c: F.col(c).cast("decimal(20,0)")
    score = F.expr(f"CAST({SCALE} AS DECIMAL(8,0)) * CAST(a AS DECIMAL(20,0)) div "
                   "(CAST(f_front AS DECIMAL(20,0)) + CAST(f_rest AS DECIMAL(20,0)))")
    scored = both.select("lang", "phrase", "a", F.struct(
        score.cast("long").alias("score"), "k", F.col("f_front").alias("l"), F.col("f_rest").alias("r")).alias("cut"))
    worst = stage(scored.groupBy("lang", "phrase", "a").agg(F.min("cut").alias("cut")).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "cut.score"), "scored")
    best = [F.desc("score"), F.desc("a"), "phrase"]
    # A language's best are the best of its shares' best; a share has 100,000 phrases or so.
    salts = worst.count() // 100_000 + 16
    salt = F.pmod(F.xxhash64("phrase"), F.lit(salts))
    first = worst.withColumn("salt", salt).withColumn(
        "place", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*best))).where(F.col("place") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long"))
    # There are at most as many rows here as ``top`` for each language.
    return ranked.where(F.col("rank") <= top).join(F.broadcast(words) if _few(words) else words, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _few(rows: DataFrame, most: int = 10_000) -> bool:
    return rows.limit(most + 1).count() <= most
