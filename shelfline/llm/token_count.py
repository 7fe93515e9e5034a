"""Token counts by merging pairs in arrays, all sequences of a batch in step."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import documents
from .tokens import CACHE_BYTES, CACHE_WORDS, Splitter, load

NONE = np.int64(1) << 40  # above every rank


class MergeTable:
    """Merges of a byte-pair vocabulary as sorted arrays: (left, right) -> rank, merged symbol."""

    def __init__(self, path: str):
        _, spec = load(path)
        model = spec["model"]
        self.vocab, self.end = model["vocab"], model.get("end_of_word_suffix") or ""
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([self.vocab[a] for a, _ in pairs], np.int64)
        right = np.array([self.vocab[b] for _, b in pairs], np.int64)
        made = np.array([self.vocab[a + b] for a, b in pairs], np.int64)
        born = np.full(max(self.vocab.values()) + 1, -1, np.int64)
        np.maximum.at(born, made, np.arange(len(pairs)))
        if (np.maximum(born[left], born[right]) >= np.arange(len(pairs))).any():
            raise ValueError("a merge uses a symbol that only a later merge makes")
        self.width = np.int64(len(born))
        key = left * self.width + right
        order = np.argsort(key, kind="stable")
        self.key, self.rank, self.made = key[order], order.astype(np.int64), made[order]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.rank[at], NONE), self.made[at]


def merge_in_step(symbols: np.ndarray, lengths: np.ndarray, table: MergeTable) -> np.ndarray:
    """Symbols left of each sequence after all merges.

    ``symbols`` holds the sequences one after the other. In each round every sequence applies
    its own lowest-ranked pair wherever it occurs, from the left without overlap. No merge can
    enable one of a lower rank, so this is the order in which the vocabulary was learned.
    Sequences without a pair left drop out.
    """
    counts = np.asarray(lengths, np.int64).copy()
    active = np.flatnonzero(counts > 1)
    owner = np.repeat(np.arange(len(counts)), counts)
    keep = counts[owner] > 1
    symbols, owner = symbols[keep].astype(np.int64), owner[keep]
    while len(active):
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        sizes = np.diff(np.r_[starts, len(owner)])
        rank, made = np.full(len(symbols), NONE), np.zeros(len(symbols), np.int64)
        rank[:-1], made[:-1] = table.ranks(symbols[:-1], symbols[1:])
        rank[starts + sizes - 1] = NONE  # the last symbol has no right neighbour
        least = np.minimum.reduceat(rank, starts)
        hit = (rank == np.repeat(least, sizes)) & (rank < NONE)
        at = np.flatnonzero(hit)
        if len(at) > 1 and (np.diff(at) == 1).any():  # a a a: every other hit of a run counts
            first = np.r_[True, np.diff(at) != 1]
            run = np.flatnonzero(first)
            place = np.arange(len(at)) - np.repeat(run, np.diff(np.r_[run, len(at)]))
            at = at[place % 2 == 0]
        symbols[at] = made[at]
        stay = np.ones(len(symbols), bool)
        stay[at + 1] = False
        np.subtract.at(counts, owner[at], 1)
        done = np.repeat((least == NONE), sizes) | (counts[owner] < 2)
        stay &= ~done
        symbols, owner = symbols[stay], owner[stay]
        active = owner
    return counts


class Counter:
    """Tokens per text; each different word is merged once while the cache holds it."""

    def __init__(self, path: str):
        self.split, self.table = Splitter(path), MergeTable(path)
        if not self.split.by_word:
            raise ValueError("this counter needs a vocabulary that drops white space")
        self.words: dict[bytes, int] = {}

    def _sequence(self, piece: str) -> list[int]:
        vocab, end = self.table.vocab, self.table.end
        return [vocab[c] for c in piece[:-1]] + [vocab[piece[-1] + end]]

    def _parts(self, word: str) -> tuple[list[str], int]:
        """Pre-tokens of a word and how many special strings it holds."""
        if not self.split.marks.search(word):
            return self.split.pieces(word), 0
        rest = self.split.marks.split(word)
        return [p for r in rest if r for p in self.split.pieces(r)], len(rest) - 1

    def learn(self, words: list[bytes], into: dict[bytes, int]) -> None:
        numbers: dict[str, int] = {}
        owners, which, base = [], [], []
        for n, word in enumerate(words):
            pieces, special = self._parts(word.decode())
            base.append(special)
            for p in pieces:
                which.append(numbers.setdefault(p, len(numbers)))
                owners.append(n)
        sequences = [self._sequence(p) for p in numbers]
        lengths = np.fromiter(map(len, sequences), np.int64, len(sequences))
        flat = np.fromiter((s for q in sequences for s in q), np.int64, int(lengths.sum()))
        left = merge_in_step(flat, lengths, self.table)
        total = np.array(base, np.int64)
        np.add.at(total, np.array(owners, np.int64), left[np.array(which, np.int64)])
        into.update(zip(words, total.tolist()))

    def count(self, texts: list[bytes]) -> list[int]:
        split = [t.split() for t in texts]
        fresh = {w for words in split for w in words}.difference(self.words)
        if len(self.words) + len(fresh) > CACHE_WORDS:
            self.words.clear()
            fresh = {w for words in split for w in words}
        known, long = self.words, {}
        if fresh:
            short = [w for w in fresh if len(w) <= CACHE_BYTES]
            self.learn(short, known)
            self.learn([w for w in fresh if len(w) > CACHE_BYTES], long)
        if not long:
            return [sum(map(known.__getitem__, words)) for words in split]
        return [sum(known[w] if w in known else long[w] for w in words) for words in split]


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 2048, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row.

    ``tokenizer`` is the path of a byte-pair vocabulary file on every machine. Texts are neither
    cut nor padded; special strings inside them count as one token, as the library reads them.
    A null text is empty and has no tokens; repeated rows are counted one by one; a null id
    stays null; other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer).count
        for batch in batches:
            texts = batch["text"].cast(pa.binary()).to_pylist()
            n_tokens = []
            for i in range(0, len(texts), 500):
                n_tokens += count(texts[i:i + 500])
            n_bytes = [*map(len, texts)]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch["doc_id"], "n_bytes": pa.array(n_bytes, pa.int64()),
                "n_tokens": pa.array(n_tokens, pa.int64()),
                "over_limit": pa.array([n > limit for n in n_tokens], pa.bool_()),
            })

    return documents(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )
