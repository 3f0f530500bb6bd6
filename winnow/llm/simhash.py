"""SimHash fingerprints of documents and the search for near ones in permuted block tables."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnow.llm.tables import light, partitions, range_bucket
from winnow.llm.words import Words, mix, shingle_hashes, text_slices

BITS = 128


def votes(terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Signed sums of the weights over the 128 hash bits of each term; whole numbers, so order does not count."""
    total = np.zeros(BITS, np.int64)
    for start in range(0, len(terms), 8192):
        h = terms[start:start + 8192]
        raw = np.stack([h, mix(h ^ np.uint64(0xC2B2AE3D27D4EB4F))], 1).astype(">u8").view(np.uint8)
        w = weights[start:start + 8192]
        ones = w.astype(np.float32) @ np.unpackbits(raw, axis=1).astype(np.float32)
        total += 2 * np.rint(ones).astype(np.int64) - int(w.sum())
    return total


def fingerprints(texts: pa.Array) -> np.ndarray:
    """``(texts, 2)`` 64-bit words, high one first.

    Terms are single words and pairs of words in lower case. A term found ``f`` times weighs ``1 + ln f``; a single
    word of fewer than eight letters weighs less by the square of its length, as short words are the common ones.
    A text without words votes for nothing and has fingerprint 0.
    """
    words = Words(texts, fold="unicode")
    own = np.fromiter(map(len, words.distinct), np.float64, len(words.distinct))
    share = np.minimum(1, own / 8) ** 2
    hashes = words.hashes()
    pairs, ends = shingle_hashes(hashes, words.offsets, 2)
    out = np.zeros((len(texts), 2), np.uint64)
    for k in range(len(texts)):
        a, b = words.offsets[k], words.offsets[k + 1]
        if a == b:
            continue
        single, at, found = np.unique(hashes[a:b], return_index=True, return_counts=True)
        double, met = np.unique(pairs[ends[k]:ends[k + 1]], return_counts=True)
        terms = np.concatenate([single, double])
        weights = np.concatenate([(1 + np.log(found)) * share[words.codes[a:b][at]], 1 + np.log(met)])
        signs = votes(terms, np.maximum(1, np.rint(16 * weights)).astype(np.int64)) > 0
        out[k] = np.packbits(signs).view(">u8").astype(np.uint64)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine that the share of differing bits stands for, 0 where it is negative."""
    apart = np.bitwise_count(a ^ b).sum(1)
    return np.maximum(0, np.cos(np.pi * apart / BITS))


def hexes(prints: np.ndarray) -> list[str]:
    return [f"{int(h):016x}{int(l):016x}" for h, l in prints]


def fingerprint(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``fingerprint`` (32 hex digits) of every whole text; null text is an empty one.

    One row out for each row in; equal texts have equal fingerprints. Other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_slices(batch):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(hexes(fingerprints(texts)), pa.string())], names=["doc_id", "fingerprint"])

    return docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, "doc_id long, fingerprint string")


def with_next(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited text and of the next document.

    The next document is that of the next id (equal ids: by a hash of the text; nulls first; after the last: the first). The
    edited text has its last ``floor(n / 2)`` code points replaced by the first as many of the next. Rows are
    dealt by id range; the first row of each range is also sent to the range before. A single row is its own
    next. No rows in, no rows out.
    """
    spark = light(docs).sparkSession
    parts = partitions(docs)
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.shiftrightunsigned(F.xxhash64("text"), 1))
    rows = rows.withColumn("range", range_bucket(rows, "doc_id", F.col("tie"), parts))
    order = F.struct(F.coalesce("doc_id", F.lit(-(2**63))).alias("k"), "tie")
    firsts = sorted((r["range"], r["f"]["k"], r["f"]["tie"]) for r in rows.groupBy("range").agg(F.min(order).alias("f")).collect())
    before = [(firsts[k - 1][0], n, a, t) for k, (n, a, t) in enumerate(firsts)]
    heads = spark.createDataFrame(before, "before int, range int, k long, tie long").select("range", "before", F.struct("k", "tie").alias("first"))
    joined = rows.join(F.broadcast(heads), "range")  # one row a range
    own = F.struct(F.col("range").alias("to"), F.lit(False).alias("extra"))
    extra = F.struct(F.col("before").alias("to"), F.lit(True).alias("extra"))
    sent = F.explode(F.when(order == F.col("first"), F.array(own, extra)).otherwise(F.array(own)))
    dealt = joined.select("doc_id", "tie", "text", sent.alias("sent")).select("doc_id", "tie", "text", "sent.*")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the row that waits for its next: range, id, text
        for batch in batches:
            for part, texts in text_slices(batch):
                to, extra = part["to"].to_pylist(), part["extra"].to_pylist()
                ids, own = part["doc_id"].to_pylist(), texts.to_pylist()
                if held:
                    to, extra, ids, own = [held[0], *to], [False, *extra], [held[1], *ids], [held[2], *own]
                at = [k for k in range(len(own) - 1) if not extra[k] and to[k] == to[k + 1]]
                held = None if extra[-1] else (to[-1], ids[-1], own[-1])
                if not at:
                    continue
                edited = [own[k][:len(own[k]) - len(own[k]) // 2] + own[k + 1][:len(own[k]) // 2] for k in at]
                plain = fingerprints(pa.array(own, pa.large_string()))
                changed = fingerprints(pa.array(edited, pa.large_string()))
                mine, other = plain[at], plain[[k + 1 for k in at]]
                yield pa.RecordBatch.from_arrays([
                    pa.array([ids[k] for k in at], pa.int64()), pa.array([len(own[k]) for k in at], pa.int64()),
                    pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()),
                    pa.array(hexes(mine), pa.string()), pa.array(hexes(changed), pa.string()),
                    pa.array(likeness(mine, changed)), pa.array(likeness(mine, other)),
                ], names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    ordered = dealt.repartitionById(parts, "to").sortWithinPartitions("to", "extra", F.col("doc_id").asc_nulls_first(), "tie")
    return ordered.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def tables(prints: DataFrame, radius: int, blocks: int) -> DataFrame:
    """Every fingerprint once a table: ``print, hi, lo, key, mask, upto``.

    The bits are cut into ``blocks``; each choice of ``blocks - radius`` of them is a table whose permuted key leads
    with those blocks. Two fingerprints at most ``radius`` bits apart agree on at least that many blocks.
    """
    word = lambda from_: F.conv(F.substring("print", from_, 16), 16, -10).cast("long")
    cut = prints.select("print", word(1).alias("hi"), word(17).alias("lo"))
    edges = [round(k * BITS / blocks) for k in range(blocks + 1)]
    chosen = []
    for table in combinations(range(blocks), blocks - radius):
        bits = [F.substring(F.concat(F.lpad(F.bin("hi"), 64, "0"), F.lpad(F.bin("lo"), 64, "0")), edges[b] + 1, edges[b + 1] - edges[b]) for b in table]
        mask = sum(1 << b for b in table)
        chosen.append(F.struct(F.xxhash64(F.lit(mask), *bits).alias("key"), F.lit(mask).alias("mask"), F.lit((2 << table[-1]) - 1).alias("upto")))
    return cut.select("print", "hi", "lo", F.explode(F.array(*chosen)).alias("t")).select("print", "hi", "lo", "t.*")


def agreeing(a: str, b: str, blocks: int) -> Column:
    """Bit mask of the blocks in which two fingerprints agree."""
    edges = [round(k * BITS / blocks) for k in range(blocks + 1)]
    mask = F.lit(0)
    for k in range(blocks):
        same = F.lit(True)
        for name, base in (("hi", 0), ("lo", 64)):
            first, last = max(edges[k], base), min(edges[k + 1], base + 64)
            if first < last:
                bits = ((1 << (last - first)) - 1) << (64 - (last - base))
                bits -= (1 << 64) * (bits >> 63)
                apart = F.col(f"{a}.{name}").bitwiseXOR(F.col(f"{b}.{name}"))
                same = same & (apart.bitwiseAND(F.lit(bits)) == 0)
        mask = mask + F.when(same, 1 << k).otherwise(0)
    return mask


def neighbours(queries: DataFrame, prints: DataFrame, radius: int = 3, blocks: int = 5) -> DataFrame:
    """Pairs of different fingerprints at most ``radius`` bits apart: ``query, print, apart``; all of them, each once.

    Both inputs have a ``print`` column and are made distinct first, so copies cost one row. A pair met in
    several tables counts in the first: its agreeing blocks up to the table's last one are the table's. Candidates are
    judged inside the join; hot keys are left to the engine's skew handling.
    """
    q = tables(queries.select("print").distinct(), radius, blocks).alias("q")
    p = tables(prints.select("print").distinct(), radius, blocks).alias("p")
    apart = sum(F.bit_count(F.col(f"q.{w}").bitwiseXOR(F.col(f"p.{w}"))) for w in ("hi", "lo"))
    first = agreeing("q", "p", blocks).bitwiseAND(F.col("q.upto")) == F.col("q.mask")
    near = q.join(p, (F.col("q.key") == F.col("p.key")) & (F.col("q.mask") == F.col("p.mask")) & (apart > 0) & (apart <= radius) & first)
    return near.select(F.col("q.print").alias("query"), F.col("p.print").alias("print"), apart.alias("apart"))
