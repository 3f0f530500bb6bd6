"""Filter interaction audit: what each document filter removes, in every order of application."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnow.llm.tables import light, pinned
from winnow.llm.words import text_slices

FILTERS = "ABCDE"
#: Bit of each filter in a combination.
BIT = {name: 1 << k for k, name in enumerate(FILTERS)}
MARKS = b"#$%&*|"


def distinct_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Words (runs without ASCII white space) of each text, and how many of them differ; case counts."""
    parts = pc.ascii_split_whitespace(texts)
    offsets = np.asarray(parts.offsets, dtype=np.int64)
    flat = parts.values.slice(offsets[0], offsets[-1] - offsets[0])
    full = np.asarray(pc.greater(pc.binary_length(flat), 0))
    owner = np.repeat(np.arange(len(texts)), np.diff(offsets))[full]
    codes = np.asarray(flat.filter(pa.array(full)).dictionary_encode().indices, dtype=np.int64)
    pairs = np.unique(owner * (codes.max(initial=0) + 1) + codes)
    return np.bincount(owner, minlength=len(texts)), np.bincount(pairs // (codes.max(initial=0) + 1), minlength=len(texts))


def failures_in_text(docs: DataFrame, id: str, text: str, part: str) -> DataFrame:
    """``doc_id, hash, part, failed``: bits of the filters A to D that each row's own text fails."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        upper, mark = np.zeros(256, np.int64), np.zeros(256, np.int64)
        upper[ord("A"):ord("Z") + 1], mark[list(MARKS)] = 1, 1
        for batch in batches:
            for rows, texts in text_slices(batch):
                words, distinct = distinct_words(texts)
                points = np.asarray(pc.utf8_length(texts), dtype=np.int64)
                sizes = np.asarray(pc.binary_length(texts), dtype=np.int64)
                ends = np.concatenate([[0], np.cumsum(sizes)])
                first = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset] if len(texts) else 0
                held = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[first:first + ends[-1]]
                sums = [np.concatenate([[0], np.cumsum(table[held])]) for table in (upper, mark)]
                capitals, marks = (s[ends[1:]] - s[ends[:-1]] for s in sums)
                failed = (
                    (words < 200) * BIT["A"] + (100 * distinct < 50 * words) * BIT["B"]
                    + (100 * capitals > 2 * points) * BIT["C"] + (marks > 0) * BIT["D"]
                )
                yield pa.RecordBatch.from_arrays(
                    [rows["doc_id"], rows["hash"], rows["part"], pa.array(failed.astype(np.int64))], names=["doc_id", "hash", "part", "failed"])

    return keyed(docs, id, text, part).mapInArrow(run, "doc_id long, hash long, part string, failed long")


def keyed(docs: DataFrame, id: str, text: str, part: str) -> DataFrame:
    """``doc_id, text, hash, part`` with null texts and parts as empty ones."""
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    return docs.select(
        F.col(f"`{id}`").cast("long").alias("doc_id"), body.alias("text"), F.xxhash64(body).alias("hash"),
        F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"))


def later_copies(docs: DataFrame, id: str, text: str, part: str) -> DataFrame:
    """``doc_id, hash, part`` of rows whose exact text a smaller ``doc_id`` has too.

    The self-join is a left-semi one on hash, exact text and smaller id. Hashes that only one id holds are told first from
    the narrow columns; then one row a distinct text, with its least id, stands for all rows that could be found,
    so a row meets one partner however many copies there are. Both sides are written, so that a hot text can be split.
    """
    rows = keyed(docs, id, text, part)
    held = rows.groupBy("hash").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    repeated = pinned(held.filter("low < high").select("hash"), "audit-repeated")
    some = pinned(rows.join(repeated, "hash"), "audit-copies")
    first = pinned(some.groupBy("hash", "text").agg(F.min("doc_id").alias("least")), "audit-first")
    same = (some["hash"] == first["hash"]) & (some["text"] == first["text"]) & (first["least"] < some["doc_id"])
    return some.join(first, same, "left_semi").select("doc_id", "hash", "part")


def combinations(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """``part, failed`` (bits of the filters), ``n``, ``good``, ``toxic``: documents of each combination of failures."""
    own = failures_in_text(light(docs), id, text, part).withColumn("n", F.lit(1).cast("long"))
    copies = later_copies(docs, id, text, part).select("doc_id", "hash", "part", F.lit(BIT["E"]).cast("long").alias("failed"), F.lit(0).cast("long").alias("n"))
    # rows that repeat id, text and part fail alike and are counted by n
    each = own.unionByName(copies).groupBy("doc_id", "hash", "part").agg(F.bit_or("failed").alias("failed"), F.sum("n").alias("n"))
    known = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic"))
    counted = lambda c: F.sum(F.when(F.col(c) == 1, F.col("n")).otherwise(0)).alias(c)
    return each.join(known, "doc_id", "left").groupBy("part", "failed").agg(F.sum("n").alias("n"), counted("good"), counted("toxic"))


def audit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """Per part, order of the five filters and step: documents kept, removed, redundant, only failing here, labelled ones lost.

    A: under 200 words. B: under half of the words differ. C: over 2 % capitals A to Z. D: holds one of ``#$%&*|``. E: the same
    text has a smaller id. ``shapley`` adds up what the step's filter removes in all orders: a combination of ``m``
    failures is removed by each of its filters in ``120 / m`` orders.

    Null text: empty (fails A). Null part: the empty string. Null id: its text may have a smaller id only where it is not null
    itself, so it never fails E and no row fails E because of it; it has no labels. Rows that repeat an id are documents of their
    own. A document with several label rows is good or toxic if one of them says so. No rows in, no rows out. Other columns are not read.
    """
    cells = combinations(docs, labels, id, text, part).groupBy("part").agg(F.collect_list(F.struct("failed", "n", "good", "toxic")).alias("cells"))
    steps = F.array(*[
        F.struct(
            F.lit("".join(order)).alias("filter_order"), F.lit(k + 1).alias("step"), F.lit(BIT[name]).cast("long").alias("own"),
            F.lit(sum(BIT[b] for b in order[:k])).cast("long").alias("before"))
        for order in permutations(FILTERS) for k, name in enumerate(order)
    ])
    at = cells.select("part", "cells", F.inline(steps))
    own, before = F.col("own"), F.col("before")

    def total(column: str, test) -> Column:
        return F.aggregate("cells", F.lit(0).cast("long"), lambda s, c: s + F.when(test(c["failed"]), c[column]).otherwise(0))

    here = lambda m: (m.bitwiseAND(own) != 0) & (m.bitwiseAND(before) == 0)
    share = F.aggregate("cells", F.lit(0).cast("long"), lambda s, c: s + F.when(
        c["failed"].bitwiseAND(own) != 0, c["n"] * (F.lit(120) / F.greatest(F.bit_count(c["failed"]), F.lit(1))).cast("long")).otherwise(0))
    return at.select(
        "part", "filter_order", "step",
        total("n", lambda m: m.bitwiseAND(own.bitwiseOR(before)) == 0).alias("kept"), total("n", here).alias("removed"),
        total("n", lambda m: (m.bitwiseAND(own) != 0) & (m.bitwiseAND(before) != 0)).alias("redundant"),
        total("n", lambda m: m == own).alias("unique_fails"), total("good", here).alias("good_lost"),
        total("toxic", here).alias("toxic_lost"), share.alias("shapley"))
