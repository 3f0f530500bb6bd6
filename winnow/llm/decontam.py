"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment of words.

Test items are read in blocks of bounded size; a block's seed table travels to the tasks, documents never do. An item's
seeds are its n-grams without the most common ones, as many of these as every match can do without: where a match must share
several n-grams, one pass over all documents counts in how many of them each stands. At 0.6 of the score and three
words a match can do without none, so all are seeds and nothing is counted. The last pass aligns items with the stretches around seeds.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.llm.tables import light
from winnow.llm.words import Words, text_slices

MATCH, MISS, GAP = 2, -1, 1
#: Words of test items handled in one pass.
BLOCK_WORDS = 400_000
ENDS = re.compile(r"^[\W_]+|[\W_]+$")


def bare(word: str) -> str:
    return word if word.isalnum() else ENDS.sub("", word)


def item_words(text: str | None) -> list[str]:
    return [w for w in map(bare, (text or "").lower().split()) if w]


@dataclass
class Block:
    """Test items as codes into their own vocabulary, and the sorted keys of their n-grams."""

    ids: list
    words: list[list[str]]
    width: int

    def __post_init__(self):
        self.code = {w: k + 1 for k, w in enumerate(sorted({w for ws in self.words for w in ws}))}
        self.items = [np.array([self.code[w] for w in ws], np.int64) for ws in self.words]
        grams = [(key, k, p) for k, item in enumerate(self.items) for p, key in enumerate(self.keys(item))]
        self.grams = np.array(grams, np.int64).reshape(-1, 3)
        self.known = np.unique(self.grams[:, 0])

    def keys(self, codes: np.ndarray) -> np.ndarray:
        """Keys of all runs of ``width`` codes; -1 where a word is not in any item. Where keys wrap round, a
        clash only proposes a stretch that the alignment turns down."""
        n = len(codes) - self.width + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        key, whole = np.zeros(n, np.uint64), np.ones(n, bool)
        for k in range(self.width):
            part = codes[k:k + n]
            key = key * np.uint64(len(self.code) + 1) + part.astype(np.uint64)
            whole &= part > 0
        return np.where(whole, (key & np.uint64((1 << 63) - 1)).astype(np.int64), -1)

    def spare(self, least: float) -> np.ndarray:
        """Places of each item's n-grams that may be left out while every match of ``least`` still shares one of the rest.

        ``m`` matched words in ``r`` runs share ``m - (width - 1) * r`` places or more, and have ``r - 1`` edits at
        least, for which ``2 * m - (r - 1) >= 2 * least * n``; the fewest are shared where all ``n`` words match.
        """
        n = np.array([len(item) for item in self.items], float)
        shared = n - (self.width - 1) * (2 * (1 - least) * n + 1) if self.width > 1 else least * n
        return np.maximum(np.ceil(np.round(shared, 9)).astype(np.int64) - 1, 0)

    def seed(self, found: dict[int, int], least: float) -> None:
        """Keep each item's n-grams that stand in documents, but for the most common ones that it can spare."""
        often = np.array([found.get(int(k), 0) for k in self.known], np.int64)
        count = often[np.searchsorted(self.known, self.grams[:, 0])] if len(self.grams) else np.zeros(0, np.int64)
        keep = count > 0
        for k, n in enumerate(self.spare(least)):
            own = np.flatnonzero(keep & (self.grams[:, 1] == k))
            keep[own[np.argsort(-count[own], kind="stable")[:n]]] = False
        self.choose(keep)

    def choose(self, keep: np.ndarray) -> None:
        chosen = self.grams[keep]
        self.grams = chosen[np.argsort(chosen[:, 0], kind="stable")]
        self.known = np.unique(self.grams[:, 0])

    def coded(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Codes of words that are not mere marks, their text's offsets, and their places among all words."""
        words = Words(texts, fold="unicode")
        cores = [bare(w) for w in words.distinct]
        own = np.fromiter((self.code.get(w, 0) if w else -1 for w in cores), np.int64, len(cores))
        codes = own[words.codes]
        there = codes >= 0
        at = np.flatnonzero(there)
        return codes[at], np.concatenate([[0], np.cumsum(there)])[words.offsets], at - np.repeat(words.offsets[:-1], np.diff(words.offsets))[at]

    def hits(self, codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions and keys of runs inside one text whose key is known."""
        keys = self.keys(codes)
        if not len(self.known) or not len(keys):
            return np.zeros(0, np.int64), keys[:0]
        at = np.minimum(np.searchsorted(self.known, keys), len(self.known) - 1)
        spots = np.flatnonzero((self.known[at] == keys) & (keys >= 0))
        owner = np.searchsorted(offsets, spots, side="right") - 1
        spots = spots[spots + self.width <= offsets[owner + 1]]
        return spots, keys[spots]


def blocks(items: DataFrame, id: str, text: str, width: int) -> Iterator[Block]:
    """Test items streamed through the driver, a block of bounded size at a time."""
    ids, words, held = [], [], 0
    for row in items.select(F.col(id).alias("i"), F.col(text).cast("string").alias("t")).toLocalIterator():
        own = item_words(row["t"])
        if len(own) >= width:
            ids.append(row["i"])
            words.append(own)
            held += len(own)
        if held >= BLOCK_WORDS:
            yield Block(ids, words, width)
            ids, words, held = [], [], 0
    if ids:
        yield Block(ids, words, width)


def align(rows: list[np.ndarray], columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Smith-Waterman of several pairs at once: best scores and where the alignments end (row, column).

    Gaps along a row are a running maximum, so each row of the table is one vector step.
    """
    n, m = max(map(len, rows)), max(map(len, columns))
    a, b = np.full((len(rows), n), -1, np.int64), np.full((len(rows), m), -2, np.int64)
    for k, (x, y) in enumerate(zip(rows, columns)):
        a[k, :len(x)], b[k, :len(y)] = np.where(x > 0, x, -1), y
    tilt = GAP * np.arange(m + 1)
    last = np.zeros((len(rows), m + 1), np.int64)
    best, row, column = (np.zeros(len(rows), np.int64) for _ in range(3))
    for i in range(n):
        now = np.maximum(last - GAP, 0)
        now[:, 1:] = np.maximum(now[:, 1:], last[:, :-1] + np.where(a[:, i, None] == b, MATCH, MISS))
        now[:, 0] = 0
        last = np.maximum.accumulate(now + tilt, 1) - tilt
        top = last.argmax(1)
        value = last[np.arange(len(rows)), top]
        better = value > best
        best, row, column = np.where(better, value, best), np.where(better, i + 1, row), np.where(better, top, column)
    return best, row, column


def found(block: Block, texts: pa.Array, least: float) -> list[tuple[int, int, float, int, int]]:
    """(text, item, score, first word, words) of the best alignment of each pair that reaches ``least``."""
    codes, offsets, places = block.coded(texts)
    spots, keys = block.hits(codes, offsets)
    near: dict[tuple[int, int], list[int]] = defaultdict(list)
    first = np.searchsorted(block.grams[:, 0], keys, side="left")
    last = np.searchsorted(block.grams[:, 0], keys, side="right")
    for spot, owner, a, b in zip(spots, np.searchsorted(offsets, spots, side="right") - 1, first, last):
        for item in np.unique(block.grams[a:b, 1]):
            near[int(owner), int(item)].append(int(spot))
    jobs = []
    for (owner, item), at in near.items():
        own = block.items[item]
        # a match has at most n * (3 - 2 * least) words
        reach = math.ceil(max(2.0, 3 - 2 * least) * len(own))
        cuts = np.flatnonzero(np.diff(at) > reach) + 1
        for group in np.split(np.array(at), cuts):
            low, high = max(offsets[owner], group[0] - reach), min(offsets[owner + 1], group[-1] + block.width + reach)
            # long stretches are cut so that any match lies in one of the parts
            for start in range(low, high - reach, reach) if high - low > 4 * reach else [low]:
                stretch = codes[start:min(start + 2 * reach, high)] if high - low > 4 * reach else codes[low:high]
                # no alignment scores more than twice the item's words that stand in the stretch
                if np.isin(own, stretch).sum() >= least * len(own):
                    jobs.append((owner, item, start, stretch))
    jobs.sort(key=lambda j: (len(j[3]), len(block.items[j[1]])))
    best: dict[tuple[int, int], tuple] = {}
    for start in range(0, len(jobs), 128):
        part = jobs[start:start + 128]
        score, row, column = align([j[3] for j in part], [block.items[j[1]] for j in part])
        good = [k for k in range(len(part)) if score[k] >= least * MATCH * len(block.items[part[k][1]])]
        if not good:
            continue
        # the same alignment read backwards ends where it begins
        _, back, _ = align([part[k][3][:row[k]][::-1] for k in good], [block.items[part[k][1]][:column[k]][::-1] for k in good])
        for k, length in zip(good, back):
            owner, item, low, _ = part[k]
            a, b = low + row[k] - length, low + row[k] - 1
            value = (-score[k] / (MATCH * len(block.items[item])), int(places[a]), int(places[b] - places[a] + 1))
            best[owner, item] = min(best.get((owner, item), value), value)
    return [(o, i, -v[0], v[1], v[2]) for (o, i), v in best.items()]


def seeded(docs: DataFrame, items: DataFrame, width: int, least: float, id: str, text: str) -> Iterator[Block]:
    """Blocks with their seeds; document counts over all documents choose them where there is a choice."""
    own = light(docs).select(F.col(text).cast("string").alias("text"))
    for block in blocks(items, id, text, width):
        if not block.spare(least).any():
            block.choose(np.ones(len(block.grams), bool))
            yield block
            continue

        def count(batches: Iterator[pa.RecordBatch], block: Block = block) -> Iterator[pa.RecordBatch]:
            total: dict[int, int] = defaultdict(int)
            for batch in batches:
                for _, texts in text_slices(batch):
                    codes, offsets, _ = block.coded(texts)
                    spots, keys = block.hits(codes, offsets)
                    owner = np.searchsorted(offsets, spots, side="right")
                    for key, n in zip(*np.unique(np.unique(np.stack([keys, owner]), axis=1)[0], return_counts=True)):
                        total[int(key)] += int(n)
            yield pa.RecordBatch.from_pydict({"key": list(total), "n": list(total.values())}, pa.schema([("key", pa.int64()), ("n", pa.int64())]))

        counted = own.mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
        block.seed({r["key"]: r["n"] for r in counted.collect()}, least)  # one row an n-gram of the block
        yield block


def leaks(docs: DataFrame, items: DataFrame, least: float = 0.6, width: int = 3, id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``doc_id, item_id, score, first_word, n_words`` of every document and item aligned with a score of ``least``.

    Aligned are the stretches that share ``width`` words in a row with the item; a copy with words put in so densely that
    no ``width`` words of it stay together is not looked at.

    The score is the alignment's (match 2, mismatch and gap -1) over that of the item with itself; a copy scores 1. Words are
    compared in lower case without marks at their ends; ``first_word`` counts words between spaces.

    Null, empty or wordless texts and items of fewer than ``width`` words match nothing. Repeated rows and ids are
    reported each. No documents or no items: no rows. Other columns are not read.
    """
    cut = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = "doc_id long, item_id string, score double, first_word long, n_words long"
    out = None
    for block in seeded(docs, items, width, least, item_id, text):
        def run(batches: Iterator[pa.RecordBatch], block: Block = block) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part, texts in text_slices(batch):
                    ids = part["doc_id"].to_pylist()
                    rows = [(ids[o], str(block.ids[i]), s, a, n) for o, i, s, a, n in found(block, texts, least)]
                    columns = list(zip(*rows)) or [[]] * 5
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64()))],
                                                     names=["doc_id", "item_id", "score", "first_word", "n_words"])

        now = cut.mapInArrow(run, schema)
        out = now if out is None else out.unionByName(now)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def decontaminate(docs: DataFrame, items: DataFrame, least: float = 0.6, width: int = 3, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """The rows, all columns, in which no item is found; nothing is shuffled."""
    where = docs.columns.index(text)
    for block in list(seeded(docs, items, width, least, item_id, text)):
        def run(batches: Iterator[pa.RecordBatch], block: Block = block) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                named = batch.rename_columns([f"c{k}" for k in range(batch.num_columns)])
                for part, texts in text_slices(named, f"c{where}"):
                    clean = np.ones(len(texts), bool)
                    clean[[o for o, *_ in found(block, texts, least)]] = False
                    yield part.filter(pa.array(clean)).rename_columns(batch.schema.names)

        docs = docs.mapInArrow(run, docs.schema)
    return docs
