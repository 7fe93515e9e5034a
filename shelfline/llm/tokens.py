"""Token ids of a vocabulary file, looked up word by word.

Where a tokenizer drops white space before it splits, a text's ids are the ids of its words
one after the other. So each different word is encoded once by the library and then looked up.
A tokenizer of another kind encodes whole texts.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np
import regex

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs one worker per core

CACHE_WORDS = 500_000  # memory bound of a worker; a full cache starts anew
CACHE_BYTES = 64  # longer words are encoded each time
PLAIN = regex.compile(r"[!-~¡-į]*")  # code points that need no Unicode normalisation


@lru_cache(maxsize=4)
def load(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path), json.loads(open(path, encoding="utf-8").read())


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(rest)}


class Splitter:
    """Pre-tokens of words, in the alphabet of the vocabulary, as the tokenizer file states them."""

    def __init__(self, path: str):
        self.tokenizer, spec = load(path)
        steps = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        norms = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        split = steps[0] if steps else {}
        self.by_word = (
            norms == ["NFC", "Replace", "Lowercase"] and len(steps) == 2 and split.get("type") == "Split"
            and split.get("behavior") == "Removed" and split.get("invert") and steps[1]["type"] == "ByteLevel"
            and not steps[1]["add_prefix_space"] and not steps[1]["use_regex"]
        )
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.marks = regex.compile("|".join(map(regex.escape, self.special)) or r"(?!)")
        self.pattern = regex.compile(split["pattern"]["Regex"]) if self.by_word else None
        self.alphabet = byte_alphabet()
        self.ids = len(spec["model"]["vocab"]) + len(self.special)

    def pieces(self, word: str) -> list[str]:
        """Pre-tokens of one stretch without white space and special strings."""
        if PLAIN.fullmatch(word):
            found = self.pattern.findall(word.lower())
            return found if word.isascii() else [
                p if p.isascii() else p.encode().decode("latin-1").translate(self.alphabet) for p in found
            ]
        clean = self.tokenizer.normalizer.normalize_str(word)
        return [p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(clean)]


class Encoder:
    """Texts to little-endian 32-bit ids; special strings are read as the library's default does."""

    def __init__(self, path: str):
        self.split = Splitter(path)
        self.model = self.split.tokenizer.model
        self.words: dict[bytes, bytes] = {}
        self.known: dict[str, bytes] = {}

    def _word(self, raw: bytes) -> bytes:
        if raw.isalpha():  # ASCII letters: one pre-token
            return np.array([t.id for t in self.model.tokenize(raw.lower().decode())], "<u4").tobytes()
        if raw[:-1].isalpha() and raw[-1] in b".,":
            return self._word(raw[:-1]) + self._piece(chr(raw[-1]))
        word = raw.decode()
        if self.split.marks.search(word) or not PLAIN.fullmatch(word):
            ids = self.split.tokenizer.encode(word, add_special_tokens=False).ids
            return np.array(ids, "<u4").tobytes()
        return b"".join([*map(self._piece, self.split.pieces(word))])

    def _piece(self, piece: str) -> bytes:
        ids = self.known.get(piece)
        if ids is None:
            ids = np.array([t.id for t in self.model.tokenize(piece)], "<u4").tobytes()
            if len(piece) <= CACHE_BYTES:
                if len(self.known) >= CACHE_WORDS // 4:
                    self.known.clear()
                self.known[piece] = ids
        return ids

    def encode(self, text: bytes) -> bytes:
        if not self.split.by_word:
            ids = self.split.tokenizer.encode(text.decode(), add_special_tokens=False).ids
            return np.array(ids, "<u4").tobytes()
        words = text.split()
        try:
            return b"".join([*map(self.words.__getitem__, words)])
        except KeyError:
            pass
        cache, out = self.words, []
        for word in words:
            ids = cache.get(word)
            if ids is None:
                ids = self._word(word)
                if len(word) <= CACHE_BYTES:
                    if len(cache) >= CACHE_WORDS:
                        cache.clear()
                    cache[word] = ids
            out.append(ids)
        return b"".join(out)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and file, so that its cache lives through many tasks."""
    return Encoder(path)
