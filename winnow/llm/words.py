"""Words as integer codes, a batch at a time.

Texts are split and dictionary-encoded by Arrow; hashing, features and tokens are then made once a distinct
word and gathered by code, which is what keeps per-word Python out of the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Bytes of text handled at once in a task; a longer single text is a slice of its own.
SLICE_BYTES = 4 << 20

# freed buffers go back to the system: a worker serves stage after stage
pa.set_memory_pool(pa.system_memory_pool())


def text_slices(batch: pa.RecordBatch, text: str = "text", limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Parts of a batch with about ``limit`` bytes of text, and their texts with nulls as empty ones."""
    column = pc.fill_null(batch.column(batch.schema.get_field_index(text)).cast(pa.large_string()), "")
    ends = np.cumsum(np.asarray(pc.binary_length(column), dtype=np.int64)) if len(column) else np.zeros(0, np.int64)
    start = 0
    while start < len(column):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start), column.slice(start, stop - start)
        start = stop


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (fixed multipliers of a public finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """Words of several texts: ``codes`` into ``distinct``, texts cut at ``offsets``."""

    def __init__(self, texts: pa.Array, fold: str = "ascii"):
        if fold == "ascii":
            parts = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        else:
            parts = pc.utf8_split_whitespace(pc.utf8_lower(texts))
        offsets = np.asarray(parts.offsets, dtype=np.int64)
        flat = parts.values.slice(offsets[0], offsets[-1] - offsets[0])
        full = np.asarray(pc.greater(pc.binary_length(flat), 0))
        encoded = flat.filter(pa.array(full)).dictionary_encode()
        self.codes = np.asarray(encoded.indices, dtype=np.int64)
        self.distinct: list[str] = encoded.dictionary.to_pylist()
        self.offsets = np.concatenate([[0], np.cumsum(full)])[offsets - offsets[0]]

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of every word occurrence."""
        own = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in self.distinct), np.uint64, len(self.distinct))
        return own[self.codes]


def shingle_hashes(hashes: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words, and the offsets of each text's runs.

    A text of fewer words has its whole sequence as one run; a text without words has none.
    """
    lengths = np.diff(offsets)
    counts = np.where(lengths >= width, lengths - width + 1, (lengths > 0).astype(np.int64))
    ends = np.concatenate([[0], np.cumsum(counts)])
    total = int(ends[-1])
    first = np.repeat(offsets[:-1] - ends[:-1], counts) + np.arange(total)
    last = np.repeat(offsets[1:], counts)
    out = np.zeros(total, np.uint64)
    padded = np.append(hashes, np.uint64(0))
    for k in range(width):
        at = first + k
        present = at < last
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + np.where(present, padded[np.minimum(at, len(hashes))], np.uint64(k)))
    return out, ends
