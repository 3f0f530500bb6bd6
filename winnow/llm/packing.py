"""Packing documents into sequences as a cutting-stock problem.

Documents longer than a sequence are cut into full pieces and one remainder. A histogram of piece lengths (bounded by the
sequence length, whatever the corpus size) goes to the driver, where column generation solves the linear program over
packing patterns: a knapsack by dynamic programming prices the columns, the optimal pattern counts are rounded down, and
best-fit patterns take the rest. Spark then ranks the pieces of each length class and reads off each piece's sequence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from winnow.llm.tables import light, partitions, pinned, range_bucket
from winnow.llm.tokens import crc32, encoder, with_end
from winnow.llm.words import text_slices


def pieces(docs: DataFrame, tokenizer: str, length: int = 2048, end_id: int = 1, keep_ids: bool = False,
           id: str = "doc_id", text: str = "text") -> DataFrame:
    """Token pieces of at most ``length``: ``doc_id, start, length, ids_crc32, doc_tokens`` (and ``ids``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        for batch in batches:
            for part, texts in text_slices(batch):
                ids, ends = with_end(*own.encode(texts), end_id)
                sizes = np.diff(ends)
                counts = -(-sizes // length)
                row = np.repeat(np.arange(len(sizes)), counts)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)) * length
                held = np.minimum(length, sizes[row] - start)
                a = ends[row] + start
                columns = [part.column(0).take(pa.array(row)), pa.array(start), pa.array(held),
                           pa.array([crc32(ids[x:x + n]) for x, n in zip(a, held)], pa.int64()), pa.array(sizes[row])]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                if keep_ids:
                    columns.append(pa.array([ids[x:x + n].astype(np.int64) for x, n in zip(a, held)], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + (", ids array<long>" if keep_ids else "")
    return light(docs).select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, schema)


def knapsack(values: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the best value in ``room`` and how often each item is taken."""
    best, choice = np.zeros(room + 1), np.full(room + 1, -1)
    order = np.argsort(sizes, kind="stable")
    values, sizes = values[order], sizes[order]
    for c in range(1, room + 1):
        n = np.searchsorted(sizes, c, side="right")
        best[c] = best[c - 1]
        if n:
            gain = best[c - sizes[:n]] + values[:n]
            k = int(gain.argmax())
            if gain[k] > best[c] + 1e-12:
                best[c], choice[c] = gain[k], k
    taken, c = np.zeros(len(values), np.int64), room
    while c > 0:
        if choice[c] < 0:
            c -= 1
        else:
            taken[choice[c]] += 1
            c -= int(sizes[choice[c]])
    out = np.zeros_like(taken)
    out[order] = taken
    return float(best[room]), out


def best_fit(demand: np.ndarray, sizes: np.ndarray, room: int) -> list[tuple[np.ndarray, int]]:
    """Patterns, largest class first, each repeated as often as what is left allows."""
    left, out = demand.copy(), []
    largest_first = np.argsort(-sizes)
    while left.any():
        pattern, free = np.zeros_like(left), room
        for k in largest_first:
            if left[k] and sizes[k] <= free:
                n = int(min(left[k], free // sizes[k]))
                pattern[k], free = n, free - n * int(sizes[k])
                if not free:
                    break
        times = int((left[pattern > 0] // pattern[pattern > 0]).min())
        left -= times * pattern
        out.append((pattern, times))
    return out


def first_basis(need: np.ndarray, size: np.ndarray, room: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Best-fit patterns in fractional counts as a starting basis.

    Every pattern uses a class up, and that class is in no later pattern, so the columns are triangular. Classes used up
    at the same time get a column of their own at count 0.
    """
    m, left = len(need), need.astype(float)
    columns = [np.eye(m, dtype=np.int64)[k] * (room // size[k]) for k in range(m)]
    counts, largest_first = np.zeros(m), np.argsort(-size)
    while (left > 0).any():
        pattern, free = np.zeros(m, np.int64), room
        for k in largest_first:
            if left[k] > 0 and size[k] <= free:
                pattern[k] = min(np.ceil(left[k]), free // size[k])
                free -= int(pattern[k] * size[k])
        held = np.flatnonzero(pattern)
        share = left[held] / pattern[held]
        ended = held[share <= share.min() * (1 + 1e-12)]
        columns[ended[0]], counts[ended[0]] = pattern, share.min()
        left = np.maximum(left - share.min() * pattern, 0)
        left[ended] = 0
    return columns, counts


def solve(demand: np.ndarray, sizes: np.ndarray, room: int, gap: float = 1e-4, rounds: int = 1500) -> list[tuple[np.ndarray, int]]:
    """Patterns and how often each is used, covering ``demand`` exactly.

    Revised simplex with column generation on ``min sum x, A x = demand``, started from best-fit patterns. It stops when no
    pattern prices above one, when the value is within ``gap`` of the dual bound or of the space the pieces need, or after ``rounds``.
    Counts are rounded down and best-fit patterns take the rest; the cover is exact whichever it was.
    """
    used = np.flatnonzero(demand)
    need, size = demand[used].astype(np.int64), sizes[used]
    m = len(used)
    if not m:
        return []
    columns, x = first_basis(need, size, room)
    bound = float(need @ size) / room
    inverse = np.linalg.inv(np.array(columns, float).T)
    for step in range(rounds):
        price = inverse.sum(0)
        worth, pattern = knapsack(np.maximum(price, 0), size, room)
        bound = max(bound, float(np.maximum(price, 0) @ need) / max(worth, 1.0))
        if worth <= 1 + 1e-9 or x.sum() <= bound * (1 + gap):
            break
        move = inverse @ pattern
        can = move > 1e-9
        ratio = np.full(m, np.inf)
        ratio[can] = x[can] / move[can]
        out = int(ratio.argmin())
        columns[out] = pattern
        pivot = inverse[out] / move[out]
        inverse -= np.outer(move, pivot)
        inverse[out] = pivot
        if step % 100 == 99:
            inverse = np.linalg.inv(np.array(columns, float).T)
        x = np.maximum(inverse @ need, 0)
    left, plan = need.copy(), []
    for k in np.argsort(-x):
        column = columns[k]
        held = column > 0
        times = int(min(np.floor(x[k] + 1e-6), (left[held] // column[held]).min()))
        if times:
            left -= times * column
            plan.append((column, times))
    plan += best_fit(left, size, room)
    out = []
    for column, times in plan:
        full = np.zeros(len(demand), np.int64)
        full[used] = column
        out.append((full, times))
    return out


def slots(plan: list[tuple[np.ndarray, int]], classes: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per class: rank bounds, first sequence, pieces a sequence and slot within it, one entry a pattern."""
    bounds, first, each, slot = ([[] for _ in range(classes)] for _ in range(4))
    filled, sequence = np.zeros(classes, np.int64), 0
    for pattern, times in plan:
        at = 0
        for k in np.flatnonzero(pattern):
            bounds[k].append(filled[k])
            first[k].append(sequence)
            each[k].append(pattern[k])
            slot[k].append(at)
            filled[k] += pattern[k] * times
            at += int(pattern[k])
        sequence += times
    return [tuple(np.array(v, np.int64) for v in four) for four in zip(bounds, first, each, slot)]


def assign(cut: DataFrame, length: int = 2048, step: int = 4) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces: a pattern a sequence, pieces side by side.

    ``step`` tokens make a length class (the linear program has ``length / step`` rows). Pieces of a class are ranked by
    document, in ranges of ids: counts per range and class are all that is summed across ranges. A
    hot length is one class over many ranges, so no task holds it.
    """
    if length % step:
        raise ValueError("step must divide length")
    classes = length // step
    kind = F.ceil(F.col("length") / step).cast("int") - 1
    tie = F.shiftrightunsigned(F.xxhash64("doc_id", "start", "ids_crc32"), 1)
    rows = cut.withColumn("kind", kind).withColumn("tie", tie)
    rows = rows.withColumn("range", range_bucket(rows, "doc_id", tie, 2 * partitions(rows)))
    counts = rows.groupBy("range", "kind").agg(F.count("*").alias("n"))
    total = np.zeros(classes, np.int64)
    for row in counts.groupBy("kind").agg(F.sum("n").alias("n")).collect():  # one row a class
        total[row["kind"]] = row["n"]
    placed = slots(solve(total, np.arange(1, classes + 1), length // step), classes)
    before = counts.select("range", "kind", (F.sum("n").over(Window.partitionBy("kind").orderBy("range")) - F.col("n")).alias("before"))
    within = F.row_number().over(Window.partitionBy("range", "kind").orderBy("doc_id", "tie", "start", "length"))
    ranked = rows.join(before, ["range", "kind"]).withColumn("rank", F.col("before") + within - 1)
    keep = [c for c in cut.columns]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, ranks = np.asarray(batch["kind"]), np.asarray(batch["rank"])
            sequence, slot = np.zeros(len(kinds), np.int64), np.zeros(len(kinds), np.int64)
            for k in np.unique(kinds):
                at = kinds == k
                bounds, first, each, own = placed[k]
                p = np.searchsorted(bounds, ranks[at], side="right") - 1
                inside = ranks[at] - bounds[p]
                sequence[at] = first[p] + inside // each[p]
                slot[at] = own[p] + inside % each[p]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in keep), pa.array(sequence), pa.array(slot)], names=[*keep, "sequence_id", "slot"])

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema) + ", sequence_id long, slot long"
    placed_rows = ranked.select(*keep, "kind", "rank").mapInArrow(place, types)
    offset = F.sum("length").over(Window.partitionBy("sequence_id").orderBy("slot")) - F.col("length")
    return placed_rows.withColumn("offset", offset.cast("long")).drop("slot")


def pack(docs: DataFrame, tokenizer: str, length: int = 2048, end_id: int = 1, step: int = 4, keep_ids: bool = False,
         id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of all documents with ``sequence_id`` and gapless ``offset``.

    A reader pads a sequence to ``length`` unless its fill is a power of two. Null or empty text: the end id alone. Very long
    text: full pieces and a remainder. Null or repeated ids are rows like others. No rows in, no
    rows out. Other columns are not read. ``keep_ids`` carries each piece's ids.
    """
    return assign(pinned(pieces(docs, tokenizer, length, end_id, keep_ids, id, text), "pieces"), length, step)
