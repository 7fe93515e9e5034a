"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

A word enters by what it is (a hashed word vector) and how it is spelled (the mean of hashed
vectors of its character n-grams), each with its evidence: the shrunken log odds of toxic texts
among those that have the word or n-gram. In training a text's own contribution is left out of
that evidence, else a word that only this text has would seem to explain its label. The network
reads windows of words in both directions, weighs the states by attention and gives one logit
per window. A document's logit is the largest of its windows, in training too, where a toxic
text is known to have a toxic window, but not which.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import documents, free_name, stage

EDGES = b".,;:!?\"'()[]{}<>|*&%$#@-_/\\"
CACHE_WORDS = 150_000
CHUNK = 50_000  # words whose features are worked out at a time
TASKS = 8  # that count the evidence of the bounded sample


@dataclass(frozen=True)
class Settings:
    """``max_rows`` bounds the labelled rows of each class that are learned from. Of each of them
    all words count as evidence, and the ``bag`` windows with the most of it teach the network;
    scoring reads every window of every text."""

    window: int = 64
    stride: int = 52
    word_slots: int = 1 << 17
    gram_slots: int = 1 << 17
    vectors: int = 1 << 12
    width: int = 6
    hidden: int = 8
    attention: int = 8
    max_rows: int = 2000
    bag: int = 6
    epochs: int = 4
    batch: int = 48
    rounds: int = 50
    rate: float = 0.01
    table_rate: float = 0.1
    shrink: float = 2.0
    seed: int = 7


def split(text: bytes) -> list[bytes]:
    return text.decode().lower().encode().split()


def window_starts(n_words: int, window: int, stride: int) -> list[int]:
    """Starts of overlapping windows that together hold all words; the last one ends with the text."""
    if n_words <= window:
        return [0] if n_words else []
    starts = [*range(0, n_words - window, stride)]
    return [*starts, n_words - window]


def features(words: list[bytes], s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word slots, n-gram slots of all words one after the other, and where each word's begin."""
    bare = [b"^" + (w.strip(EDGES) or w) + b"$" for w in words]
    slots = np.array([zlib.crc32(w) for w in bare], np.int64) % s.word_slots
    lengths = np.fromiter(map(len, bare), np.int64, len(bare))
    flat = np.frombuffer(b"".join(bare), np.uint8).astype(np.uint64)
    ends = np.repeat(np.cumsum(lengths), lengths)
    at = np.arange(len(flat))
    owner = np.repeat(np.arange(len(bare)), lengths)
    grams, owners = [], []
    with np.errstate(over="ignore"):
        for n in (3, 4, 5):
            first = np.flatnonzero(at + n <= ends)
            h = np.full(len(first), n, np.uint64)
            for k in range(n):
                h = (h ^ flat[first + k]) * np.uint64(0x100000001B3)
            grams.append(((h ^ (h >> np.uint64(29))) % np.uint64(s.gram_slots)).astype(np.int64))
            owners.append(owner[first])
    grams, owners = np.concatenate(grams), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    counts = np.bincount(owners, minlength=len(bare))
    return slots, grams[order], np.r_[0, np.cumsum(counts)]


def _gathered(at: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sums of the rows of ``values`` by place."""
    return np.stack([np.bincount(at, v, size) for v in values.T], axis=1).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


@dataclass
class Network:
    settings: Settings
    base_rate: float = 0.0
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def fresh(cls, s: Settings) -> Network:
        rng, h = np.random.default_rng(s.seed), s.hidden
        draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        return cls(s, 0.0, {
            "word": draw(s.vectors, s.width, scale=0.1), "gram": draw(s.vectors, s.width, scale=0.1),
            "word_odds": np.zeros(s.word_slots, np.float32), "gram_odds": np.zeros(s.gram_slots, np.float32),
            "w": draw(2 * s.width + 3, 6 * h, scale=0.3), "b": np.zeros(6 * h, np.float32),
            "uf": draw(h, 3 * h, scale=0.3), "ub": draw(h, 3 * h, scale=0.3),
            "a": draw(2 * h, s.attention, scale=0.5), "v": draw(s.attention, scale=0.5),
            "o": draw(2 * h, scale=0.5), "c": np.full(1, -1.0, np.float32),
        })

    def inputs(self, words: tuple, odds: tuple | None = None) -> np.ndarray:
        """Inputs of words given by their ``features``; ``odds`` replaces the tables' evidence."""
        slots, grams, at = words
        s, n = self.settings, len(slots)
        word_odds, gram_odds = odds or (self.weights["word_odds"][slots], self.weights["gram_odds"][grams])
        some, size = np.flatnonzero(np.diff(at)), np.maximum(np.diff(at), 1)[:, None].astype(np.float32)
        x = np.zeros((n, 2 * s.width + 3), np.float32)
        x[:, :s.width] = self.weights["word"][slots % s.vectors]
        x[:, -3] = word_odds
        if len(some):
            x[some, s.width:2 * s.width] = np.add.reduceat(self.weights["gram"][grams % s.vectors], at[some])
            x[some, -2] = np.add.reduceat(gram_odds, at[some])
            x[some, -1] = np.maximum.reduceat(gram_odds, at[some])
        x[:, s.width:2 * s.width] /= size
        x[:, -2] /= size[:, 0]
        return x

    def project(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights["w"] + self.weights["b"]

    def read(self, gates: np.ndarray, mask: np.ndarray, u: np.ndarray, order: range, keep: bool = False):
        """States of one direction; ``gates`` is (time, batch, 3 hidden)."""
        h, (steps, n, _) = self.settings.hidden, gates.shape
        state, states, trace = np.zeros((n, h), np.float32), np.empty((steps, n, h), np.float32), {}
        full = mask.all(axis=1)
        for t in order:
            g = gates[t]
            inner = state @ u
            zr = _sigmoid(g[:, :2 * h] + inner[:, :2 * h])
            z, r = zr[:, :h], zr[:, h:]
            new = np.tanh(g[:, 2 * h:] + r * inner[:, 2 * h:])
            after = new + z * (state - new)
            if not full[t]:
                after = np.where(mask[t][:, None], after, state)
            if keep:
                trace[t] = (state, z, r, new, inner[:, 2 * h:])
            state = after
            states[t] = state
        return states, trace

    def forward(self, gates: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Logits of windows; ``gates`` is (time, batch, 6 hidden), ``mask`` (time, batch)."""
        h, w = self.settings.hidden, self.weights
        steps = gates.shape[0]
        ahead, trace_f = self.read(gates[:, :, :3 * h], mask, w["uf"], range(steps), keep)
        back, trace_b = self.read(gates[:, :, 3 * h:], mask, w["ub"], range(steps - 1, -1, -1), keep)
        states = np.concatenate([ahead, back], axis=2)
        hidden = np.tanh(states @ w["a"])
        score = np.where(mask, hidden @ w["v"], -1e9)
        score = np.exp(score - score.max(axis=0))
        score /= score.sum(axis=0)
        pooled = np.einsum("tb,tbh->bh", score, states)
        logit = pooled @ w["o"] + w["c"][0]
        return logit, (states, hidden, score, pooled, trace_f, trace_b)

    def _back_through(self, grad_states, trace, u, order, mask):
        h = self.settings.hidden
        grad_gates = np.zeros((*grad_states.shape[:2], 3 * h), np.float32)
        grad_u, flow = np.zeros_like(u), np.zeros(grad_states.shape[1:], np.float32)
        for t in order:
            state, z, r, new, inner_n = trace[t]
            total = grad_states[t] + flow
            live = mask[t][:, None]
            d = np.where(live, total, 0)
            d_new = d * (1 - z) * (1 - new * new)
            d_z = d * (state - new) * z * (1 - z)
            d_r = d_new * inner_n * r * (1 - r)
            d_inner = np.concatenate([d_z, d_r, d_new * r], axis=1)
            grad_gates[t] = np.concatenate([d_z, d_r, d_new], axis=1)
            grad_u += state.T @ d_inner
            flow = np.where(live, d * z + d_inner @ u.T, total)
        return grad_gates, grad_u

    def gradients(self, index: np.ndarray, words: tuple, odds: tuple, mask: np.ndarray, label: np.ndarray):
        """Loss and gradients; ``index`` (time, batch) points into the words."""
        w, h = self.weights, self.settings.hidden
        x = self.inputs(words, odds)
        gates = self.project(x)[index]
        logit, (states, hidden, score, pooled, trace_f, trace_b) = self.forward(gates, mask, keep=True)
        p = _sigmoid(logit)
        loss = float(np.mean(np.logaddexp(0, logit) - label * logit))
        d_logit = ((p - label) / len(label)).astype(np.float32)
        g = {"o": pooled.T @ d_logit, "c": d_logit.sum(keepdims=True)}
        d_pooled = d_logit[:, None] * w["o"]
        d_states = score[:, :, None] * d_pooled[None]
        d_score = np.einsum("tbh,bh->tb", states, d_pooled)
        d_raw = score * (d_score - (score * d_score).sum(axis=0))
        g["v"] = np.einsum("tbk,tb->k", hidden, d_raw)
        d_hidden = d_raw[:, :, None] * w["v"] * (1 - hidden * hidden)
        g["a"] = np.einsum("tbh,tbk->hk", states, d_hidden)
        d_states = d_states + d_hidden @ w["a"].T
        steps = len(index)
        gate_f, g["uf"] = self._back_through(d_states[:, :, :h], trace_f, w["uf"], range(steps - 1, -1, -1), mask)
        gate_b, g["ub"] = self._back_through(d_states[:, :, h:], trace_b, w["ub"], range(steps), mask)
        d_gates = np.concatenate([gate_f, gate_b], axis=2).reshape(-1, 6 * h)
        d_project = _gathered(index.reshape(-1), d_gates, len(x))
        g["w"], g["b"] = x.T @ d_project, d_project.sum(axis=0)
        d_x = d_project @ w["w"].T
        slots, grams, at = words
        width, size = self.settings.width, np.diff(at)
        vectors = self.settings.vectors
        g["word"] = _gathered(slots % vectors, d_x[:, :width], vectors)
        shared = d_x[:, width:2 * width] / np.maximum(size, 1)[:, None]
        g["gram"] = _gathered(grams % vectors, np.repeat(shared, size, axis=0), vectors)
        return loss, g

    def step(self, g: dict, moment: dict, n: int, rate: float) -> None:
        """Adam, but plain steps for the hashed vectors: so what many texts share is learned first."""
        norm = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
        for k, x in g.items():
            x = x * min(1.0, 1 / max(norm, 1e-9))
            if k in ("word", "gram"):
                self.weights[k] -= rate / self.settings.rate * self.settings.table_rate * x
                continue
            m, v = moment[k]
            m += 0.1 * (x - m)
            v += 0.001 * (x * x - v)
            self.weights[k] -= rate * (m / (1 - 0.9 ** n) / (np.sqrt(v / (1 - 0.999 ** n)) + 1e-8))


class Sample:
    """Windows of labelled texts with the features of their words."""

    def __init__(self, bags: list[tuple[int, list[list[bytes]]]], s: Settings):
        numbers: dict[bytes, int] = {}
        windows = [w for _, ws in bags for w in ws]
        self.index = np.zeros((len(windows), s.window), np.int32)
        self.mask = np.zeros((len(windows), s.window), bool)
        for n, words in enumerate(windows):
            self.index[n, :len(words)] = [numbers.setdefault(w, len(numbers)) for w in words]
            self.mask[n, :len(words)] = True
        self.bag = np.repeat(np.arange(len(bags)), [len(ws) for _, ws in bags])
        self.label = np.array([y for y, _ in bags])
        parts, words = [], [*numbers]
        del numbers, windows
        for i in range(0, len(words), CHUNK):
            slots, grams, at = features(words[i:i + CHUNK], s)
            parts.append((slots.astype(np.int32), grams.astype(np.int32), np.diff(at)))
        self.slots, self.grams, size = (np.concatenate(x) for x in zip(*parts))
        self.at = np.r_[0, np.cumsum(size)]

    def words(self, ids: np.ndarray) -> tuple:
        size = self.at[ids + 1] - self.at[ids]
        inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        return self.slots[ids], self.grams[np.repeat(self.at[ids], size) + inner], np.r_[0, np.cumsum(size)]


@dataclass(frozen=True)
class Evidence:
    """How many clean and how many toxic texts have each slot of words and n-grams, (2, slots)."""

    texts: np.ndarray
    words: np.ndarray
    grams: np.ndarray

    def odds(self, shrink: float, without: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Log odds of toxic texts against their share; what few texts have is drawn to zero.

        ``without`` takes a text of that label out of its own evidence.
        """
        own = np.zeros((2, 1)) if without is None else np.eye(2)[without][:, None]
        share = self.texts[:, None] / max(1, self.texts.sum())
        out = []
        for counts in (self.words - own, self.grams - own):
            ratio = (np.maximum(counts, 0) + shrink) / (counts.sum(axis=0).clip(0) * share + shrink)
            out.append((np.log(ratio[1]) - np.log(ratio[0])).astype(np.float32))
        return out[0], out[1]


def count_evidence(sample: DataFrame, s: Settings) -> Evidence:
    """Evidence of whole texts ``label, text``; one array of fixed size a task goes to the driver."""
    sizes = (2, 2 * s.word_slots, 2 * s.gram_slots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, words, grams = (np.zeros((2, n // 2), np.int32) for n in sizes)
        for batch in batches:
            for label, text in zip(batch["label"].to_pylist(), batch["text"].cast(pa.binary()).to_pylist()):
                own = [*dict.fromkeys(split(text))]
                found = [features(own[i:i + CHUNK], s)[:2] for i in range(0, len(own), CHUNK)]
                if found:
                    texts[label] += 1
                    for counts, slots in zip((words, grams), zip(*found)):
                        counts[label, np.unique(np.concatenate(slots))] += 1
        flat = zlib.compress(np.concatenate([x.ravel() for x in (texts, words, grams)]).tobytes(), 1)
        yield pa.RecordBatch.from_pydict({"counts": pa.array([flat], pa.binary())})

    total = np.zeros(sum(sizes), np.int64)
    for row in sample.coalesce(TASKS).mapInArrow(run, "counts binary").toLocalIterator():
        total += np.frombuffer(zlib.decompress(row.counts), np.int32)
    texts, words, grams = (x.reshape(2, -1) for x in np.split(total, np.cumsum(sizes)[:-1]))
    return Evidence(texts[:, 0], words, grams)


def teaching_windows(words: list[bytes], odds: tuple[np.ndarray, np.ndarray], s: Settings) -> list[int]:
    """Starts of a text's windows; of more than ``bag``, those whose words speak most for toxic."""
    starts = window_starts(len(words), s.window, s.stride)
    if len(starts) <= s.bag:
        return starts
    value, own = {}, [*dict.fromkeys(words)]
    for i in range(0, len(own), CHUNK):
        slots, grams, at = features(own[i:i + CHUNK], s)
        some, size = np.flatnonzero(np.diff(at)), np.maximum(np.diff(at), 1)
        spelled = np.zeros(len(slots))
        if len(some):
            spelled[some] = np.add.reduceat(odds[1][grams], at[some])
        value.update(zip(own[i:i + CHUNK], np.maximum(odds[0][slots] + spelled / size, 0).tolist()))
    sums = np.cumsum(np.r_[0, [value[w] for w in words]])
    first = np.array(starts)
    best = np.argsort(sums[first] - sums[first + s.window], kind="stable")[:s.bag]
    return sorted(first[best].tolist())


def fit(bags: list[tuple[int, list[list[bytes]]]], found: Evidence, base_rate: float, s: Settings = Settings()) -> Network:
    """Learn from ``(label, windows)`` of labelled texts; each window is a list of words.

    ``found`` is the evidence of these texts as a whole. ``base_rate`` is the share of toxic texts among all labelled ones, of which these may be a sample.
    In the first epoch every window of a text carries its label; later a toxic text teaches with
    its most toxic window, a clean one with that and any others.
    """
    net, rng = Network.fresh(s), np.random.default_rng(s.seed)
    net.base_rate = base_rate
    bags = [b for b in bags if b[1]]
    if len({y for y, _ in bags}) < 2:
        return Network(s, base_rate)
    data = Sample(bags, s)
    net.weights["word_odds"], net.weights["gram_odds"] = found.odds(s.shrink)
    without = [found.odds(s.shrink, y) for y in (0, 1)]

    def evidence(words: tuple, toxic_text: np.ndarray) -> tuple:
        slots, grams, at = words
        marks = np.repeat(toxic_text, np.diff(at))
        return (np.where(toxic_text, without[1][0][slots], without[0][0][slots]),
                np.where(marks, without[1][1][grams], without[0][1][grams]))

    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.weights.items()}
    label = data.label[data.bag]
    toxic, clean = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    hard = clean
    total, n = s.epochs * s.rounds, 0
    for epoch in range(s.epochs):
        if epoch:
            logit = np.empty(len(label), np.float32)
            for y in (0, 1):
                part = np.flatnonzero(label == y)
                gates = Scorer(net).gates_of(data, lambda words: evidence(words, np.full(len(words[0]), y == 1)))
                logit[part] = Scorer(net).read(data.index[part], data.mask[part], gates)
                del gates
            best = np.lexsort((logit, data.bag))[np.r_[np.diff(data.bag) != 0, True]]
            toxic, hard = best[data.label == 1], best[data.label == 0]
        for _ in range(s.rounds):
            chosen = np.r_[rng.choice(toxic, s.batch), rng.choice(hard, s.batch), rng.choice(clean, s.batch // 2)]
            marked = 2 * data.index[chosen].astype(np.int64) + label[chosen][:, None]  # a word of a toxic text is another entry
            ids, index = np.unique(marked.T, return_inverse=True)
            words = data.words(ids // 2)
            _, grads = net.gradients(
                index.reshape(s.window, -1), words, evidence(words, ids % 2 == 1), data.mask[chosen].T,
                label[chosen].astype(np.float32),
            )
            n += 1
            net.step(grads, moment, n, s.rate * min(1.0, 2 * (1 - n / (total + 1))))
    return net


class Scorer:
    """Scores texts; gate inputs of each different word are computed once while they are held."""

    def __init__(self, net: Network):
        self.net, w, h = net, net.weights, net.settings.hidden
        half = np.r_[np.full(2 * h, 0.5), np.ones(h)].astype(np.float32)  # sigmoid(x) from tanh(x / 2)
        self.scale = np.r_[half, half]
        self.u = np.stack([w["uf"] * half, w["ub"] * half])
        self.rows: dict[bytes, int] = {}
        self.table = np.zeros((2, 0, 3 * h), np.float32)

    def _gates(self, words: tuple, odds: tuple | None = None) -> np.ndarray:
        gates = self.net.project(self.net.inputs(words, odds)) * self.scale
        return gates.reshape(len(gates), 2, -1).transpose(1, 0, 2)

    def _index(self, words: list[bytes]) -> np.ndarray:
        try:
            return np.array([*map(self.rows.__getitem__, words)], np.int64)
        except KeyError:
            pass
        if not self.table.shape[1]:
            self.table = np.zeros((2, CACHE_WORDS, self.table.shape[2]), np.float32)
        fresh = [*set(words).difference(self.rows)]
        for i in range(0, len(fresh), 20_000):
            part = fresh[i:i + 20_000]
            at = len(self.rows)
            self.table[:, at:at + len(part)] = self._gates(features(part, self.net.settings))
            self.rows.update(zip(part, range(at, at + len(part))))
        return np.array([*map(self.rows.__getitem__, words)], np.int64)

    def gates_of(self, data: Sample, odds) -> np.ndarray:
        """Gate inputs of all words of a sample, with the evidence that ``odds`` gives for them."""
        n = len(data.slots)
        out = np.empty((2, n, 3 * self.net.settings.hidden), np.float32)
        for i in range(0, n, CHUNK):
            words = data.words(np.arange(i, min(i + CHUNK, n)))
            out[:, i:i + CHUNK] = self._gates(words, odds(words))
        return out

    def read(self, windows: np.ndarray, mask: np.ndarray, table: np.ndarray, size: int = 512) -> np.ndarray:
        out = np.empty(len(windows), np.float32)
        whole = mask.all(axis=1)
        for rows in (np.flatnonzero(whole), np.flatnonzero(~whole)):
            for i in range(0, len(rows), size):
                part = rows[i:i + size]
                out[part] = self._logits(windows[part], mask[part], table)
        return out

    def _logits(self, windows: np.ndarray, mask: np.ndarray, table: np.ndarray) -> np.ndarray:
        """As ``Network.forward``, both directions in step."""
        w, h, (n, steps) = self.net.weights, self.net.settings.hidden, windows.shape
        order, real, full = np.ascontiguousarray(windows.T), mask.T, bool(mask.all())
        state, states = np.zeros((2, n, h), np.float32), np.empty((steps, n, 2 * h), np.float32)
        gates = np.empty((2, n, 3 * h), np.float32)
        for t in range(steps):
            back = steps - 1 - t
            np.take(table[0], order[t], axis=0, out=gates[0], mode="clip")
            np.take(table[1], order[back], axis=0, out=gates[1], mode="clip")
            inner = state @ self.u
            zr = gates[:, :, :2 * h] + inner[:, :, :2 * h]
            np.tanh(zr, out=zr)
            zr += 1
            zr *= 0.5
            new = zr[:, :, h:] * inner[:, :, 2 * h:]
            new += gates[:, :, 2 * h:]
            np.tanh(new, out=new)
            after = state - new
            after *= zr[:, :, :h]
            after += new
            if not full:
                after = np.where(np.stack([real[t], real[back]])[:, :, None], after, state)
            state = after
            states[t, :, :h], states[back, :, h:] = state[0], state[1]
        flat = states.reshape(-1, 2 * h)
        weight = (np.tanh(flat @ w["a"]) @ w["v"]).reshape(steps, n)
        if not full:
            weight = np.where(real, weight, -1e9)
        weight = np.exp(weight - weight.max(axis=0))
        value = (flat @ w["o"]).reshape(steps, n)
        return (weight * value).sum(axis=0) / weight.sum(axis=0) + w["c"][0]

    def many(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """For the windows of all texts, the number of the text and the logit."""
        s = self.net.settings
        owners, windows, masks, logits = [], [], [], []
        inner = np.arange(s.window)

        def flush() -> None:
            if windows:
                logits.append(self.read(np.concatenate(windows), np.concatenate(masks), self.table))
                windows.clear()
                masks.clear()

        for n, text in enumerate(texts):
            words = split(text)
            for low in range(0, len(words), 1000 * s.stride):  # pieces of a long text overlap like windows
                part = words[low:low + 1000 * s.stride + s.window - s.stride]
                if low and len(part) <= s.window - s.stride:
                    continue
                if len(self.rows) + len(part) > CACHE_WORDS:
                    flush()
                    self.rows.clear()
                index = self._index(part)
                starts = np.array(window_starts(len(part), s.window, s.stride))
                place = starts[:, None] + inner
                windows.append(index[np.minimum(place, len(part) - 1)])
                masks.append(place < len(part))
                owners.append(np.full(len(starts), n))
            if sum(map(len, windows)) >= 8192:
                flush()
        flush()
        none = np.empty(0)
        return np.concatenate(owners) if owners else none.astype(int), np.concatenate(logits) if logits else none


def learn(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> Network:
    """Fit on labelled rows that are not held out: at most ``max_rows`` of each class, by hash.

    Labels without a document, null labels and null ids are left out; of several labels of an
    id the highest counts, of several texts the first in byte order. The base rate is counted over all these rows, before the bound. With
    labels of one class only, every text gets that rate.
    """
    clean = documents(docs)
    known = labels.where(F.col("toxic").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")) \
        .agg(F.max("toxic").alias("toxic")).where(~held_out(F.col("doc_id")))
    there = clean.select("doc_id").join(known, "doc_id").distinct()
    n = {r.toxic: r["count"] for r in there.groupBy("toxic").count().collect()}
    base_rate = n.get(1, 0) / max(1, n.get(0, 0) + n.get(1, 0))
    order = F.xxhash64(F.col("doc_id"), F.lit(s.seed))
    ids = [r for label in (0, 1) for r in
           there.where(F.col("toxic") == label).orderBy(order).limit(s.max_rows).collect()]
    chosen = docs.sparkSession.createDataFrame([(r.doc_id, int(r.toxic)) for r in ids], "doc_id long, label int")
    sample = stage(clean.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text")), "sample")
    found = count_evidence(sample, s)
    odds = [found.odds(s.shrink, y) for y in (0, 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = []
            for label, text in zip(batch["label"].to_pylist(), batch["text"].cast(pa.binary()).to_pylist()):
                words = split(text)
                bags.append([b" ".join(words[i:i + s.window]).decode() for i in teaching_windows(words, odds[label], s)])
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["label"], pa.array(bags, pa.list_(pa.string()))], ["doc_id", "label", "windows"]
            )

    rows = sample.mapInArrow(run, "doc_id long, label int, windows array<string>").collect()
    bags = [(r.label, [w.encode().split() for w in r.windows]) for r in sorted(rows, key=lambda r: r.doc_id)]
    return fit(bags, found, base_rate, s)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def _scored(docs: DataFrame, net: Network, text_col: str, name: str) -> DataFrame:
    """``docs`` with one more column, the score of each row's whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(net) if net.weights else None
        for batch in batches:
            texts = [t or b"" for t in batch[text_col].cast(pa.binary()).to_pylist()]
            top = np.full(len(texts), -np.inf)
            for i in range(0, len(texts) if scorer else 0, 256):
                owner, logit = scorer.many(texts[i:i + 256])
                np.maximum.at(top, owner + i, logit)
            with np.errstate(over="ignore"):
                value = np.where(np.isfinite(top), 1 / (1 + np.exp(-top)), net.base_rate)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(value)], [*batch.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def score(docs: DataFrame, net: Network, threshold: float = 0.3) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row, from all windows of its text.

    Texts without words, null ones too, get the share of toxic rows in the labels. Repeated
    rows get equal scores; a null id stays null and is not held out; other columns are ignored.
    """
    return _scored(documents(docs), net, "text", "score").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``docs`` without the rows whose text the network rejects; all columns kept."""
    name = free_name(docs, "score")
    return _scored(docs, learn(docs, labels), "text", name).where(F.col(name) < threshold).drop(name)
