"""Language of words and documents by a linear-chain conditional random field.

Word scores are sums of learned weights of affixes, character n-grams and a lexicon; learned transitions tie neighbours.
Forward-backward gives each word's language probabilities, so code-switched text is labelled word by word; a document's
language is the one with the largest mean over its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.llm.tables import light
from winnow.llm.wordforms import Forms, core, draw, held_out
from winnow.llm.words import Words, text_slices

BUCKETS = 1 << 15
GRAMS, AFFIXES = (2, 3), (1, 2, 3)


class ChainModel:
    """Weights of hashed features, of the lexicon, and transitions between ``labels``."""

    def __init__(self, labels: list[str]):
        n = len(labels)
        self.labels = labels
        self.weights = np.zeros((BUCKETS, n), np.float32)
        self.lexicon: dict[str, np.ndarray] = {}
        self.trust = np.ones(1, np.float32)
        self.moves = np.zeros((n, n), np.float32)

    def features(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Hashed features and the word each belongs to; words without a letter have none."""
        forms, spelled = Forms(words), np.array([bool(w) for w in words], bool)
        ids, owners = [], []
        for width in GRAMS:
            h, begins = forms.ngrams(width, BUCKETS)
            ids.append(h)
            owners.append(np.repeat(np.arange(len(words)), np.diff(np.append(begins, len(h)))))
        for width in AFFIXES:
            h = forms.affixes(width, BUCKETS).astype(np.int64)
            ids.append(h.T.ravel())
            owners.append(np.tile(np.arange(len(words)), 2))
        ids, owners = np.concatenate(ids), np.concatenate(owners)
        keep = spelled[owners] if len(words) else np.zeros(0, bool)
        return ids[keep], owners[keep]

    def lexical(self, words: list[str]) -> np.ndarray:
        none = np.zeros(len(self.labels), np.float32)
        return np.array([self.lexicon.get(w, none) for w in words], np.float32).reshape(len(words), len(self.labels))

    def emissions(self, words: list[str]) -> np.ndarray:
        """Scores ``(words, labels)`` of distinct words."""
        ids, owners = self.features(words)
        out = self.trust * self.lexical(words)
        for k in range(len(self.labels)):
            out[:, k] += np.bincount(owners, self.weights[ids, k], len(words))
        return out

    def posteriors(self, scores: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Forward-backward over many texts at once, longest first, so that a step touches only texts that go on."""
        lengths = np.diff(offsets)
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = offsets[:-1][order], lengths[order]
        emit = np.exp(scores - scores.max(1, keepdims=True)) if len(scores) else scores
        step = np.exp(self.moves)
        forward, backward = np.zeros_like(emit), np.zeros_like(emit)
        longest = int(lengths[0]) if len(lengths) else 0
        going = np.searchsorted(-lengths, -np.arange(longest), side="left")  # texts longer than t
        state = None
        for t in range(longest):
            at = starts[:going[t]] + t
            state = emit[at] if t == 0 else (state[:going[t]] @ step) * emit[at]
            state = state / state.sum(1, keepdims=True)
            forward[at] = state
        state = np.zeros((0, len(self.labels)), emit.dtype)
        for t in range(longest - 1, -1, -1):
            n, at = going[t], starts[:going[t]] + t
            grown = np.ones((n, len(self.labels)), emit.dtype)
            if len(state):
                grown[:len(state)] = (emit[starts[:len(state)] + t + 1] * state) @ step.T
            state = grown / grown.sum(1, keepdims=True)
            backward[at] = state
        both = forward * backward
        return both / both.sum(1, keepdims=True)


def spliced(texts: list[list[list[int]]], rng: np.random.Generator, count: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Training chains: one to three stretches of texts in drawn languages, so that transitions see switches."""
    words, gold = np.zeros((count, length), np.int64), np.zeros((count, length), np.int64)
    for row in range(count):
        cuts = np.sort(rng.integers(1, length, rng.integers(0, 3)))
        for a, b in zip([0, *cuts], [*cuts, length]):
            label = int(rng.integers(len(texts)))
            text = texts[label][rng.integers(len(texts[label]))]
            start = rng.integers(max(1, len(text) - (b - a)))
            piece = (text[start:start + b - a] * (b - a))[:b - a]
            words[row, a:b], gold[row, a:b] = piece, label
    return words, gold


def fit(samples: list[tuple[str, str]], steps: int = 250, chains: int = 128, length: int = 40, rate: float = 0.3, seed: int = 7) -> ChainModel:
    """Maximise the conditional likelihood of labelled chains by AdaGrad."""
    labels = sorted({lang for _, lang in samples})
    model = ChainModel(labels)
    if not labels:
        return model
    split = Words(pa.array([t for t, _ in samples], pa.large_string()), fold="unicode")
    words = [core(w) for w in split.distinct]
    distinct = sorted(set(words) - {""})
    number = {w: k for k, w in enumerate(distinct)}
    coded = np.array([number.get(w, -1) for w in words], np.int64)[split.codes]
    texts: list[list[list[int]]] = [[] for _ in labels]
    seen = np.zeros((len(distinct), len(labels)))
    for k, (_, lang) in enumerate(samples):
        own = coded[split.offsets[k]:split.offsets[k + 1]]
        own = own[own >= 0]
        if len(own):
            texts[labels.index(lang)].append(own.tolist())
            seen[:, labels.index(lang)] += np.bincount(own, minlength=len(distinct))
    for k, own in enumerate(texts):
        if not own:
            texts[k] = [[0]] if distinct else []
    if not distinct:
        return model
    share = np.log((seen + 0.5) / (seen.sum(0) + 1))
    share -= share.mean(1, keepdims=True)
    often = np.argsort(-seen.sum(1), kind="stable")[:20_000]
    model.lexicon = {distinct[k]: np.clip(share[k], -3, 3).astype(np.float32) for k in often if seen[k].sum() > 2}
    ids, owners = model.features(distinct)
    lexical = model.lexical(distinct)
    starts = np.searchsorted(owners[np.argsort(owners, kind="stable")], np.arange(len(distinct) + 1))
    ids = ids[np.argsort(owners, kind="stable")]
    rng, n = np.random.default_rng(seed), len(labels)
    sums = [np.full_like(model.weights, 1e-6), np.full_like(model.moves, 1e-6), np.full_like(model.trust, 1e-6)]
    for _ in range(steps):
        drawn, gold = spliced(texts, rng, chains, length)
        used, back = np.unique(drawn, return_inverse=True)
        counts = starts[used + 1] - starts[used]
        feats = ids[np.repeat(starts[used] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())]
        owner = np.repeat(np.arange(len(used)), counts)
        scores = model.trust * lexical[used]
        for k in range(n):
            scores[:, k] += np.bincount(owner, model.weights[feats, k], len(used))
        each = scores[back.reshape(drawn.shape)]
        flat = each.reshape(-1, n)
        post = model.posteriors(flat, np.arange(0, chains * length + 1, length)).reshape(chains, length, n)
        step = np.exp(model.moves)
        emit = np.exp(each - each.max(2, keepdims=True))
        # expected transitions: forward state, move, emission, backward state, by way of the posteriors' parts
        expected, found = np.zeros((n, n)), np.zeros((n, n))
        ahead = np.ones((chains, n))
        behind = np.zeros((chains, length, n))
        state = emit[:, 0] / emit[:, 0].sum(1, keepdims=True)
        behind[:, 0] = state
        for t in range(1, length):
            state = (state @ step) * emit[:, t]
            state /= state.sum(1, keepdims=True)
            behind[:, t] = state
        for t in range(length - 1, 0, -1):
            pair = behind[:, t - 1, :, None] * step[None] * (emit[:, t] * ahead)[:, None]
            pair /= pair.sum((1, 2), keepdims=True)
            expected += pair.sum(0)
            ahead = (emit[:, t] * ahead) @ step.T
            ahead /= ahead.sum(1, keepdims=True)
        np.add.at(found, (gold[:, :-1].ravel(), gold[:, 1:].ravel()), 1)
        slope = (np.eye(n)[gold.ravel()] - post.reshape(-1, n)) / chains
        by_word = np.stack([np.bincount(back.ravel(), slope[:, k], len(used)) for k in range(n)], 1)
        grads = [np.stack([np.bincount(feats, by_word[owner, k], BUCKETS) for k in range(n)], 1) - 1e-5 * model.weights,
                 (found - expected) / chains, np.array([(by_word * lexical[used]).sum() / length])]
        for value, grad, total in zip((model.weights, model.moves, model.trust), grads, sums):
            total += grad ** 2
            value += (rate * grad / np.sqrt(total)).astype(np.float32)
    return model


def train(docs: DataFrame, most: int = 250, id: str = "doc_id", text: str = "text", lang: str = "lang") -> ChainModel:
    """Fit on about ``most`` documents of each language among rows that are not held out (a documented bound)."""
    known = docs.filter(~held_out(id) & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    rows = sorted((r["doc_id"] or 0, r["text"], r["lang"]) for r in draw(known, "lang", most).collect())
    return fit([(t, l) for _, t, l in rows])


def label_slice(model: ChainModel, texts: pa.Array) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words of the texts, whether each has a letter, and its language probabilities."""
    words = Words(texts, fold="unicode")
    cores = [core(w) for w in words.distinct]
    spelled = np.array([bool(c) for c in cores], bool)
    scores = model.emissions(cores)
    return words, spelled[words.codes], model.posteriors(scores[words.codes], words.offsets)


def predict(docs: DataFrame, model: ChainModel, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score``; the score is the mean probability over words with letters.

    Null text, or text without a letter: ``und`` and 0. Repeated rows are scored each. Without a labelled
    row there is no language to choose from: ``und``. No rows in, no rows out. Other columns are not read.
    """
    rows = light(docs).select(F.col(id).cast("long").alias("doc_id"), held_out(id).alias("held_out"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_slices(batch):
                lettered = np.asarray(pc.match_substring_regex(texts, r"\p{L}"))
                names, best = np.full(len(texts), "und", object), np.zeros(len(texts))
                if model.labels:
                    words, spelled, post = label_slice(model, texts)
                    # a text whose letters all stand inside marks still counts all of its words
                    owner = np.repeat(np.arange(len(texts)), np.diff(words.offsets))
                    some = np.bincount(owner, spelled, len(texts)) > 0
                    use = spelled | ~some[owner]
                    mass = np.stack([np.bincount(owner, post[:, k] * use, len(texts)) for k in range(len(model.labels))], 1)
                    total = mass.sum(1)
                    known = lettered & (total > 0)
                    names[known] = np.array(model.labels, object)[mass.argmax(1)][known]
                    best[known] = np.clip((mass.max(1) / np.maximum(total, 1e-12))[known], 0, 1)
                yield pa.RecordBatch.from_arrays([part["doc_id"], part["held_out"], pa.array(names, pa.string()), pa.array(best)],
                                                 names=["doc_id", "held_out", "lang_pred", "score"])

    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def label_words(docs: DataFrame, model: ChainModel, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, position, word, lang, score`` for every word with a letter, so switches inside a text show."""
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_slices(batch, limit=1 << 20):
                words, spelled, post = label_slice(model, texts)
                owner = np.repeat(np.arange(len(texts)), np.diff(words.offsets))
                at = np.flatnonzero(spelled)
                names = np.array(model.labels, object)[post.argmax(1)] if model.labels else np.full(len(post), "und", object)
                yield pa.RecordBatch.from_arrays([
                    part["doc_id"].take(pa.array(owner[at])), pa.array(at - words.offsets[owner[at]]),
                    pa.array(np.array(words.distinct, object)[words.codes[at]], pa.string()), pa.array(names[at], pa.string()),
                    pa.array(post.max(1)[at].astype(np.float64) if model.labels else np.zeros(len(at))),
                ], names=["doc_id", "position", "word", "lang", "score"])

    return rows.mapInArrow(run, "doc_id long, position long, word string, lang string, score double")
