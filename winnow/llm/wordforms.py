"""Character features of distinct words, and bounded draws of labelled rows for fitting."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnow.llm.words import mix

EDGES = re.compile(r"^[\W\d_]+|[\W\d_]+$")


def core(word: str) -> str:
    """The word without what is not a letter at its ends."""
    return word if word.isalpha() else EDGES.sub("", word)


class Forms:
    """Code points of words between two boundary marks, one after another."""

    def __init__(self, words: list[str]):
        self.points = np.frombuffer("".join([f"\x02{w}\x03" for w in words]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes

    def ngrams(self, width: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashed character n-grams of all words and where each word's begin; every word has at least one up to width 3."""
        h = np.full(len(self.points), width, np.uint64)
        for k in range(width):
            h = mix(h + np.roll(self.points, -k) * np.uint64(0x9E3779B97F4A7C15))
        counts = np.maximum(1, self.ends - self.starts - width + 1)
        begins = np.cumsum(counts) - counts
        at = np.repeat(self.starts - begins, counts) + np.arange(counts.sum())
        return (h[at] % np.uint64(buckets)).astype(np.int64), begins

    def affixes(self, width: int, buckets: int) -> np.ndarray:
        """``(words, 2)``: hashed first and last ``width`` letters, or the whole word where it is shorter."""
        first = np.full(len(self.starts), 2 * width, np.uint64)
        last = first + np.uint64(1)
        for k in range(1, width + 1):
            a, b = np.minimum(self.starts + k, self.ends - 1), np.maximum(self.ends - 1 - k, self.starts)
            first = mix(first + self.points[a] * np.uint64(0x9E3779B97F4A7C15))
            last = mix(last + self.points[b] * np.uint64(0x9E3779B97F4A7C15))
        return np.stack([first, last], 1).view(np.uint64).astype(np.uint64) % np.uint64(buckets)


def held_out(id: str) -> Column:
    """True for rows that nothing is learned from: crc32 of the id as text leaves 2 on division by 4."""
    return F.crc32(F.coalesce(F.col(id).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def draw(rows: DataFrame, label: str, most: int, id: str = "doc_id") -> DataFrame:
    """About ``most`` rows of each label, all where there are fewer: those whose hashed id is lowest.

    Counts of the labels (a bounded list) set the share, so no row is shuffled to be drawn.
    """
    counts = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}
    keep = F.lit(False)
    for value, n in counts.items():
        share = F.lit(int(min(1.0, most / n) * (1 << 30)))
        keep = keep | ((F.col(label) == F.lit(value)) & (F.pmod(F.xxhash64(F.col(id), F.lit(11)), F.lit(1 << 30)) < share))
    return rows.filter(keep).limit(int(most * max(1, len(counts)) * 1.5))
