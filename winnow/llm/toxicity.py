"""Toxicity of whole texts: a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word's input joins a hashed word vector and the mean of its hashed character trigrams. Texts are read as overlapping
windows; a text scores as its highest window. Inputs of the gates are worked out once a distinct word of a batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.llm.tables import light
from winnow.llm.wordforms import Forms, core, draw, held_out
from winnow.llm.words import Words, text_slices

WORDS, TRIGRAMS = 1 << 14, 1 << 14
THRESHOLD = 0.3


@dataclass(frozen=True)
class Shape:
    window: int = 64
    stride: int = 48
    word: int = 8
    char: int = 16
    hidden: int = 12


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def word_codes(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed word, hashed trigrams, and where each word's trigrams begin."""
    cores = [core(w) for w in words]
    own = np.fromiter((xxhash.xxh3_64_intdigest(w) % WORDS for w in cores), np.int64, len(cores))
    grams, begins = Forms(cores).ngrams(3, TRIGRAMS)
    return own, grams, begins


def windows(offsets: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, first word and length of every window; the last one ends with the text. No words, no window."""
    sizes = np.diff(offsets)
    count = np.where(sizes > shape.window, 1 + -(-(sizes - shape.window) // shape.stride), (sizes > 0).astype(np.int64))
    owner = np.repeat(np.arange(len(sizes)), count)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    first = np.minimum(number * shape.stride, np.maximum(0, sizes[owner] - shape.window))
    return owner, offsets[:-1][owner] + first, np.minimum(shape.window, sizes[owner] - first)


def summed(rows: np.ndarray, at: np.ndarray, count: int) -> np.ndarray:
    """Sums of the rows that share a place."""
    order = np.argsort(at, kind="stable")
    places, begin = np.unique(at[order], return_index=True)
    out = np.zeros((count, rows.shape[1]), rows.dtype)
    if len(places):
        out[places] = np.add.reduceat(rows[order], begin, axis=0)
    return out


class Network:
    """Parameters by name, the forward pass, and its gradients."""

    def __init__(self, shape: Shape = Shape(), seed: int = 3):
        rng, s = np.random.default_rng(seed), shape
        self.shape = shape
        width, hidden = s.word + s.char, s.hidden
        draw_ = lambda *size, scale: rng.normal(0, scale, size).astype(np.float32)
        self.p = {"word": draw_(WORDS, s.word, scale=0.1), "char": draw_(TRIGRAMS, s.char, scale=0.3),
                  "attend": draw_(2 * hidden, hidden, scale=0.3), "query": draw_(hidden, scale=0.3),
                  "out": draw_(2 * hidden, scale=0.3), "bias": np.full(1, -1.0, np.float32)}
        for way in ("f", "b"):
            self.p[f"in_{way}"] = draw_(width, 3 * hidden, scale=width ** -0.5)
            self.p[f"gate_{way}"] = np.zeros(3 * hidden, np.float32)
            self.p[f"state_{way}"] = draw_(hidden, 3 * hidden, scale=hidden ** -0.5)

    def inputs(self, codes: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        own, grams, begins = codes
        counts = np.diff(np.append(begins, len(grams)))[:, None].astype(np.float32)
        chars = np.add.reduceat(self.p["char"][grams], begins, axis=0) / counts if len(own) else np.zeros((0, self.shape.char), np.float32)
        return np.concatenate([self.p["word"][own], chars], 1), counts

    def run(self, gates: np.ndarray, at: np.ndarray, here: np.ndarray, way: str, keep: list | None = None) -> np.ndarray:
        """States ``(windows, steps, hidden)`` of one direction; ``at`` are words, ``here`` marks steps inside."""
        n, hidden = self.shape.hidden, self.p[f"state_{way}"]
        state = np.zeros((len(at), n), np.float32)
        out = np.zeros((*at.shape, n), np.float32)
        steps = range(at.shape[1]) if way == "f" else range(at.shape[1] - 1, -1, -1)
        for t in steps:
            x, u = gates[at[:, t]], state @ hidden
            zr = sigmoid(x[:, :2 * n] + u[:, :2 * n])
            z, r = zr[:, :n], zr[:, n:]
            new = np.tanh(x[:, 2 * n:] + r * u[:, 2 * n:])
            m = here[:, t, None]
            if keep is not None:
                keep.append((t, state, z, r, new, u[:, 2 * n:], m))
            state = state + m * (1 - z) * (new - state)
            out[:, t] = state
        return out

    def scores(self, codes, at: np.ndarray, here: np.ndarray, batch: int = 2048) -> np.ndarray:
        """Score of every window."""
        count = len(codes[0])
        gates = {way: np.zeros((count, 3 * self.shape.hidden), np.float32) for way in ("f", "b")}
        for k in range(0, count, 16384):  # the character vectors of all words at once would be the largest array
            part = np.arange(k, min(k + 16384, count))
            x, _ = self.inputs(cut_codes(codes, part))
            for way in gates:
                gates[way][part] = x @ self.p[f"in_{way}"] + self.p[f"gate_{way}"]
        return np.concatenate([self.pooled(gates, at[k:k + batch], here[k:k + batch])[0] for k in range(0, len(at), batch)] or [np.zeros(0, np.float32)])

    def pooled(self, gates: dict, at: np.ndarray, here: np.ndarray, keep: dict | None = None):
        kept = {way: ([] if keep is not None else None) for way in ("f", "b")}
        states = np.concatenate([self.run(gates[way], at, here, way, kept[way]) for way in ("f", "b")], 2)
        hidden = np.tanh(states @ self.p["attend"])
        logits = np.where(here > 0, hidden @ self.p["query"], -1e9)
        share = np.exp(logits - logits.max(1, keepdims=True))
        share /= share.sum(1, keepdims=True)
        pooled = (share[:, :, None] * states).sum(1)
        score = sigmoid(pooled @ self.p["out"] + self.p["bias"])
        if keep is not None:
            keep.update(kept=kept, states=states, hidden=hidden, share=share, pooled=pooled)
        return score, share

    def gradients(self, codes, at: np.ndarray, here: np.ndarray, gold: np.ndarray, weight: np.ndarray) -> dict:
        """Of the weighted log loss of a batch of windows."""
        x, counts = self.inputs(codes)
        gates = {way: x @ self.p[f"in_{way}"] + self.p[f"gate_{way}"] for way in ("f", "b")}
        k: dict = {}
        score, _ = self.pooled(gates, at, here, k)
        g, n = {}, self.shape.hidden
        slope = ((score - gold) * weight).astype(np.float32) / len(at)
        g["bias"], g["out"] = slope.sum(keepdims=True), slope @ k["pooled"]
        d_pooled = slope[:, None] * self.p["out"]
        d_states = k["share"][:, :, None] * d_pooled[:, None]
        d_share = (k["states"] * d_pooled[:, None]).sum(2)
        d_logit = k["share"] * (d_share - (k["share"] * d_share).sum(1, keepdims=True))
        g["query"] = (d_logit[:, :, None] * k["hidden"]).sum((0, 1))
        d_hidden = d_logit[:, :, None] * self.p["query"] * (1 - k["hidden"] ** 2)
        g["attend"] = np.tensordot(k["states"], d_hidden, ((0, 1), (0, 1)))
        d_states = d_states + d_hidden @ self.p["attend"].T
        d_x = np.zeros_like(x)
        for way, part in (("f", slice(0, n)), ("b", slice(n, 2 * n))):
            state_w = self.p[f"state_{way}"]
            d_in, d_w = np.zeros((*at.shape, 3 * n), np.float32), np.zeros_like(state_w)
            d_next = np.zeros((len(at), n), np.float32)
            for t, state, z, r, new, u, m in reversed(k["kept"][way]):
                d = d_next + d_states[:, t, part]
                d_new = d * m * (1 - z) * (1 - new ** 2)
                d_z = d * m * (state - new) * z * (1 - z)
                d_r = d_new * u * r * (1 - r)
                d_u = np.concatenate([d_z, d_r, d_new * r], 1)
                d_w += state.T @ d_u
                d_in[:, t] = np.concatenate([d_z, d_r, d_new], 1)
                d_next = d * (1 - m * (1 - z)) + d_u @ state_w.T
            d_gates = summed(d_in.reshape(-1, 3 * n), at.ravel(), len(x))
            g[f"state_{way}"], g[f"gate_{way}"], g[f"in_{way}"] = d_w, d_gates.sum(0), x.T @ d_gates
            d_x += d_gates @ self.p[f"in_{way}"].T
        own, grams, begins = codes
        g["word"] = summed(d_x[:, :self.shape.word], own, WORDS)
        g["char"] = summed(np.repeat(d_x[:, self.shape.word:] / counts, np.diff(np.append(begins, len(grams))), 0), grams, TRIGRAMS)
        return g


class Adam:
    def __init__(self, params: dict, rate: float):
        self.rate, self.t = rate, 0
        self.first, self.second = ({k: np.zeros_like(v) for k, v in params.items()} for _ in range(2))

    def step(self, params: dict, grads: dict) -> None:
        self.t += 1
        for k, g in grads.items():
            self.first[k] += 0.1 * (g - self.first[k])
            self.second[k] += 0.01 * (g * g - self.second[k])
            params[k] -= self.rate * (self.first[k] / (1 - 0.9 ** self.t)) / (np.sqrt(self.second[k] / (1 - 0.99 ** self.t)) + 1e-7)


def grid(first: np.ndarray, length: np.ndarray, codes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Word codes ``(windows, steps)`` and marks of the steps inside."""
    step = np.arange(window)
    here = step < length[:, None]
    return codes[np.where(here, first[:, None] + step, first[:, None])], here.astype(np.float32)


def cut_codes(codes, used: np.ndarray):
    """Features of some of the words only."""
    own, grams, begins = codes
    counts = np.diff(np.append(begins, len(grams)))[used]
    ends = np.cumsum(counts)
    at = np.repeat(begins[used] - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)
    return own[used], grams[at], ends - counts


def leaning(words: Words, features: np.ndarray, begins: np.ndarray, gold: np.ndarray, buckets: int) -> np.ndarray:
    """Log ratio of a feature's rates among toxic and clean texts that have it, drawn to 0 where it is rare.

    ``features`` of each distinct word start at ``begins``; texts are taken one at a time.
    """
    found = np.zeros((2, buckets))
    counts = np.diff(np.append(begins, len(features)))
    for text, y in enumerate(gold):
        used = np.unique(words.codes[words.offsets[text]:words.offsets[text + 1]])
        n = counts[used]
        at = np.repeat(begins[used] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        found[int(y), np.unique(features[at])] += 1
    return np.log((found[1] + 2) / (found[0] * (gold.sum() / max(1, (1 - gold).sum())) + 2)).astype(np.float32)


def fit(texts: list[str], gold: list[int], shape: Shape = Shape(), epochs: int = 8, steps: int = 400, batch: int = 128, rate: float = 0.01, seed: int = 5) -> Network:
    """Train on labelled texts. A label holds for a text's windows together: a toxic text teaches by its
    highest window only, a clean one by its highest and one drawn.

    The first component of word and trigram vectors starts from the leaning of the feature; the windows of the
    first epoch are chosen by it, later ones by the network.
    """
    net, rng = Network(shape), np.random.default_rng(seed)
    words = Words(pa.array(texts, pa.large_string()), fold="unicode")
    owner, first, length = windows(words.offsets, shape)
    label = np.array(gold, np.float32)
    if not len(owner) or label.min() == label.max():
        return net
    codes = own, grams, begins = word_codes(words.distinct)
    lean = {"word": leaning(words, own, np.arange(len(own)), label, WORDS), "char": leaning(words, grams, begins, label, TRIGRAMS)}
    for name in lean:
        net.p[name][:, 0] = 0.5 * lean[name]
    by_word = lean["word"][own] + np.add.reduceat(lean["char"][grams], begins) / np.diff(np.append(begins, len(grams)))
    begin = np.searchsorted(owner, np.arange(len(texts)))
    count = np.bincount(owner, minlength=len(texts))
    some = np.flatnonzero(count)
    share = float(label[some].mean())
    optimiser = Adam(net.p, rate)
    epochs = max(epochs, -(-steps * batch // int(len(some) * (2 - share))))
    for epoch in range(epochs):
        at, here = grid(first, length, words.codes, shape.window)
        score = net.scores(codes, at, here) if epoch else np.where(here > 0, by_word[at], -9).max(1)
        top = np.lexsort((score, owner))[np.cumsum(count[some]) - 1]
        drawn = begin[some] + rng.integers(0, count[some])
        chosen_all = np.unique(np.concatenate([top, drawn[label[some] == 0]]))
        optimiser.rate = rate * (1 - epoch / epochs)
        for chosen in np.array_split(rng.permutation(chosen_all), max(1, len(chosen_all) // batch)):
            at, here = grid(first[chosen], length[chosen], words.codes, shape.window)
            used, back = np.unique(at, return_inverse=True)
            y = label[owner[chosen]]
            weight = np.where(y > 0, min(4.0, 0.5 / max(share, 1e-3)), 1.0).astype(np.float32)
            optimiser.step(net.p, net.gradients(cut_codes(codes, used), back.reshape(at.shape), here, y, weight))
    return net


def train(docs: DataFrame, labels: DataFrame, most: int = 1200, id: str = "doc_id", text: str = "text", label: str = "toxic") -> Network:
    """Fit on about ``most`` documents of each label among rows that are not held out (a documented bound)."""
    known = labels.filter(~held_out(id) & F.col(label).isin(0, 1)).select(F.col(id).cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
    drawn = draw(known, "y", most)
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).join(drawn, "doc_id")
    rows = sorted((r["doc_id"], r["text"], r["y"]) for r in rows.collect())
    return fit([t for _, t, _ in rows], [y for *_, y in rows])


def text_scores(net: Network, texts: pa.Array) -> np.ndarray:
    words = Words(texts, fold="unicode")
    owner, first, length = windows(words.offsets, net.shape)
    out = np.zeros(len(texts))
    if len(owner):
        at, here = grid(first, length, words.codes, net.shape.window)
        np.maximum.at(out, owner, net.scores(word_codes(words.distinct), at, here).astype(np.float64))
    return out


def score(docs: DataFrame, net: Network, id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every whole text.

    Null, empty or wordless text: score 0. Repeated rows are scored each. A network fitted on one label or on nothing
    keeps its drawn weights and rejects nothing with certainty. No rows in, no rows out. Other columns are not read.
    """
    rows = light(docs).select(F.col(id).cast("long").alias("doc_id"), held_out(id).alias("held_out"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_slices(batch, limit=3 << 20):
                s = text_scores(net, texts)
                yield pa.RecordBatch.from_arrays([part["doc_id"], part["held_out"], pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                                                 names=["doc_id", "held_out", "score", "predicted"])

    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def clean(docs: DataFrame, net: Network, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows, all columns, whose text scores below ``threshold``; nothing is shuffled."""
    where = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named = batch.rename_columns([f"c{k}" for k in range(batch.num_columns)])
            for part, texts in text_slices(named, f"c{where}", 3 << 20):
                yield part.filter(pa.array(text_scores(net, texts) < threshold)).rename_columns(batch.schema.names)

    return light(docs).mapInArrow(run, docs.schema)
