"""Repeated substrings: Burrows-Wheeler transforms of shards, merged by refining their interleave.

A byte string of ``length`` bytes has one anchor, the ``gram`` bytes with the least hash in it. Strings next to each other that share their
anchor make a region, and equal strings lie in regions with equal anchors. So the anchors deal the work: only regions whose anchor
stands in other surroundings too can hold strings repeated elsewhere, and those of one anchor go to one bucket. Each task
transforms the regions it holds as a shard of every bucket; a bucket's task merges the shards' transforms, which finds the strings
that several regions share without sorting suffixes again.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.llm.tables import light, pinned
from winnow.llm.words import mix, text_slices

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
LOW = np.uint64(0xFFFFFFFF)
#: A null id stands for the least whole number.
NO_ID = -(2**63)


@dataclass(frozen=True)
class Repeats:
    """Strings of ``length`` bytes; ``gram`` (a power of two) bytes make an anchor.

    ``block`` bytes are looked at together, a bucket is meant to hold the regions of ``share`` bytes of text, a merge ``merge`` bytes.
    An anchor that one block shows in ``hot`` surroundings is dealt string by string; by default as many as keep a
    bucket at ``capacity`` regions when every block shows fewer. None of these changes the result.
    """

    length: int = 100
    gram: int = 32
    block: int = 4 << 20
    share: int = 32 << 20
    merge: int = 2 << 20
    capacity: int = 1 << 20
    hot: int | None = None

    def limit(self, total: int) -> int:
        return self.hot or max(2, self.capacity // max(1, math.ceil(total / self.block)))


# --- tables of regions as bytes, a column after another ------------------------------------------------

PLACE = {"doc": "<u4", "start": "<u4", "count": "<u4"}
REGION = {"anchor": "<u4", "c1": "<u8", "c2": "<u4", **PLACE}
WANTED = {"anchor": "<u4", "single": "<u1", **PLACE}
OWNERS = ("id", "tie", "part")


def packed(layout: dict, owners: dict, rows: dict) -> bytes:
    """Rows and the documents they name."""
    used, doc = np.unique(rows["doc"], return_inverse=True)
    columns = [np.asarray(owners[k])[used].astype("<i8") for k in OWNERS]
    columns += [(doc if k == "doc" else rows[k]).astype(t) for k, t in layout.items()]
    return b"".join([np.array([len(used), len(doc)], "<i8").tobytes(), *(c.tobytes() for c in columns)])


def unpacked(layout: dict, blobs: Iterable[bytes]) -> tuple[dict, dict]:
    """The documents and rows of several such tables, one after another."""
    owners, rows = {k: [np.zeros(0, np.int64)] for k in OWNERS}, {k: [np.zeros(0, t)] for k, t in layout.items()}
    before = 0
    for blob in blobs:
        docs, count = np.frombuffer(blob, "<i8", 2)
        at = 16
        for k in OWNERS:
            owners[k].append(np.frombuffer(blob, "<i8", docs, at))
            at += 8 * int(docs)
        for k, t in layout.items():
            column = np.frombuffer(blob, t, count, at)
            rows[k].append(column + np.uint32(before) if k == "doc" else column)
            at += column.nbytes
        before += int(docs)
    return {k: np.concatenate(v) for k, v in owners.items()}, {k: np.concatenate(v) for k, v in rows.items()}


def taken(rows: dict, which: np.ndarray) -> dict:
    return {k: v[which] for k, v in rows.items()}


def ranks(owners: dict) -> np.ndarray:
    """Place of each document in the order of id and hash of the text; rows that repeat both share it."""
    order = np.lexsort((owners["tie"], owners["id"]))
    id, tie = owners["id"][order], owners["tie"][order]
    new = np.ones(len(order), bool)
    new[1:] = (id[1:] != id[:-1]) | (tie[1:] != tie[:-1])
    out = np.zeros(len(order), np.int64)
    out[order] = np.cumsum(new) - 1
    return out


def dealt(layout: dict, owners: dict, rows: dict, to: np.ndarray) -> Iterator[tuple[int, bytes, int]]:
    """``to``, table and number of rows for every destination."""
    order = np.argsort(to, kind="stable")
    cuts = np.flatnonzero(np.diff(to[order], prepend=-1, append=-1))
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield int(to[order[a]]), packed(layout, owners, taken(rows, order[a:b])), int(b - a)


def batch(kinds: list[tuple[int, int, bytes, int]]) -> pa.RecordBatch:
    goal, kind, blob, size = zip(*kinds) if kinds else ((), (), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(goal, pa.int32()), pa.array(kind, pa.int32()), pa.array(blob, pa.binary()), pa.array(size, pa.int64())], names=["goal", "kind", "blob", "size"])


TABLES = "goal int, kind int, blob binary, size long"
TO_BUCKET, MARK, REMOVED, TO_CUT, SHARD, TEXT = range(6)


def by_goal(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple[int, bytes]]]]:
    """Tables of one destination after another, from rows sorted by it."""
    goal, held = None, []
    for rows in batches:
        for g, kind, blob in zip(rows["goal"].to_pylist(), rows["kind"].to_pylist(), rows["blob"].to_pylist()):
            if g != goal and held:
                yield goal, held
                held = []
            goal = g
            held.append((kind, blob))
    if held:
        yield goal, held


# --- regions -------------------------------------------------------------------------------------------


def held_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and where each ends (from 0)."""
    ends = np.concatenate([[0], np.cumsum(np.asarray(pc.binary_length(texts), dtype=np.int64))])
    first = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset] if len(texts) else 0
    return np.frombuffer(texts.buffers()[2] or b"", np.uint8)[first:first + ends[-1]], ends


def regions(held: np.ndarray, ends: np.ndarray, rule: Repeats) -> dict:
    """``doc, start`` (in ``held``), ``count`` (strings), 64-bit ``hash`` of the anchor; a long text is looked at block by block."""
    found = []
    owner = np.repeat(np.arange(len(ends) - 1, dtype=np.int64), np.diff(ends))
    table = mix(np.arange(256, dtype=np.uint64) + GOLDEN)
    width = rule.length - rule.gram + 1
    for base in range(0, len(held), rule.block):
        part = held[base:base + rule.block + rule.length - 1]
        if len(part) < rule.length:
            break
        h, step, factor = table[part], 1, GOLDEN
        while step < rule.gram:
            h = h[:-step] * factor + h[step:]
            factor = np.multiply(factor, factor, dtype=np.uint64) if isinstance(factor, np.ndarray) else np.uint64(int(factor) * int(factor) & 0xFFFFFFFFFFFFFFFF)
            step *= 2
        h = mix(h)
        least, span = (h & ~LOW) | np.arange(len(h), dtype=np.uint64), 1
        while 2 * span <= width:
            least, span = np.minimum(least[:-span], least[span:]), 2 * span
        if width > span:
            least = np.minimum(least[:span - width], least[width - span:])
        spot = (least & LOW).astype(np.int64)
        doc = owner[base:base + len(spot)]
        last = ends[doc + 1] - rule.length  # start of the document's last string
        change = np.ones(len(spot), bool)
        change[1:] = (spot[1:] != spot[:-1]) | (doc[1:] != doc[:-1])
        starts = np.flatnonzero(change & (np.arange(base, base + len(spot)) <= last))
        edges = np.append(np.flatnonzero(change), len(spot))
        stops = np.minimum(edges[np.searchsorted(edges, starts, side="right")] + base, last[starts] + 1)
        found.append((doc[starts], starts + base, stops - starts - base, h[spot[starts]]))
    parts = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)]
    return dict(zip(("doc", "start", "count", "hash"), parts))


def digests(held: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    view = memoryview(np.ascontiguousarray(held))
    raw = b"".join([xxhash.xxh3_128_digest(view[a:b]) for a, b in zip(starts.tolist(), (starts + sizes).tolist())])
    both = np.frombuffer(raw, "<u8").reshape(-1, 2)
    return both[:, 0], both[:, 1]


def firsts(keys: list[np.ndarray], rank: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order by keys and place, where each run of equal keys begins in it, and whether a row is its run's first (or repeats it)."""
    order = np.lexsort((start, rank, *reversed(keys)))
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.any([k[order[1:]] != k[order[:-1]] for k in keys], axis=0)
    head = order[np.flatnonzero(new)][np.cumsum(new) - 1] if len(order) else order
    return order, new, (rank[order] == rank[head]) & (start[order] == start[head])


def anchored(docs: DataFrame, rule: Repeats, buckets: int, limit: int) -> DataFrame:
    """Tables of regions for each bucket, and of sure copies.

    A block's equal regions fold: the first goes to the bucket of its content's anchor, the rest are copies of it. A
    hot anchor's regions go on undecided, and a mark tells the bucket.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for part, texts in text_slices(rows, limit=rule.block):
                owners = {k: np.asarray(part[k], dtype=np.int64) for k in OWNERS}
                own = ranks(owners)
                once = np.zeros(len(own), bool)
                once[np.unique(own, return_index=True)[1]] = True
                held, ends = held_bytes(texts)
                found = regions(held, ends, rule)
                found = taken(found, once[found["doc"]])
                c1, c2 = digests(held, found["start"], found["count"] + rule.length - 1)
                anchor = (found["hash"] & LOW).astype("<u4")
                bucket = ((found["hash"] >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
                table = {"anchor": anchor, "c1": c1, "c2": (c2 & LOW).astype("<u4"), "doc": found["doc"],
                         "start": found["start"] - ends[found["doc"]], "count": found["count"], "bucket": bucket}
                order, new, first = firsts([bucket, anchor, table["c1"], table["c2"]], own[table["doc"]], table["start"])
                table = taken(table, order)
                out = [(int(g), REMOVED, blob, n) for g, blob, n in dealt(PLACE, owners, taken(table, ~first), owners["part"][table["doc"][~first]])]
                table = taken(table, first)
                group = np.cumsum(np.diff(table["bucket"] << 32 | table["anchor"].astype(np.int64), prepend=-1) != 0) - 1
                hot = np.bincount(group, minlength=1)[group] >= limit if len(group) else np.zeros(0, bool)
                some = taken(table, hot)
                if hot.any():
                    some["single"] = np.ones(len(some["doc"]), np.uint8)
                    out += [(g, TO_CUT, blob, n) for g, blob, n in dealt(WANTED, owners, some, owners["part"][some["doc"]])]
                    mark = taken(some, np.flatnonzero(np.diff(group[hot], prepend=-1)))
                    out += [(g, MARK, blob, n) for g, blob, n in dealt(REGION, owners, mark, mark["bucket"])]
                rest = taken(table, ~hot)
                out += [(g, TO_BUCKET, blob, n) for g, blob, n in dealt(REGION, owners, rest, rest["bucket"])]
                # what is decided travels with the rest, spread over all buckets
                yield batch([(g, k, b, n) for g, k, b, n in out])

    return docs.mapInArrow(run, TABLES)


def decided(tables: DataFrame, rule: Repeats, buckets: int) -> DataFrame:
    """Tables of copies (``REMOVED``) and of regions to be cut out (``TO_CUT``) by part of the documents."""
    spread = F.when(F.col("kind").isin(REMOVED, TO_CUT), F.pmod(F.xxhash64("goal", "size", "blob"), F.lit(buckets)).cast("int")).otherwise(F.col("goal"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def through() -> Iterator[pa.RecordBatch]:
            for rows in batches:
                done = np.isin(np.asarray(rows["kind"]), (REMOVED, TO_CUT))
                if done.any():
                    ready.append(rows.filter(pa.array(done)).select(["part", "kind", "blob", "size"]).rename_columns(["goal", "kind", "blob", "size"]))
                if not done.all():
                    yield rows.filter(pa.array(~done))

        ready: list[pa.RecordBatch] = []
        for _, tables in by_goal(through()):
            yield from ready
            ready.clear()
            owners, rows = unpacked(REGION, [b for k, b in tables if k == TO_BUCKET])
            marked = unpacked(REGION, [b for k, b in tables if k == MARK])[1]["anchor"]
            rank = ranks(owners)
            order, new, first = firsts([rows["anchor"], rows["c1"], rows["c2"]], rank[rows["doc"]], rows["start"])
            rows = taken(rows, order)
            copies = taken(rows, ~first)
            heads = taken(rows, new)
            group = np.cumsum(np.diff(heads["anchor"].astype(np.int64), prepend=-1) != 0) - 1
            single = np.isin(heads["anchor"], marked)
            wanted = (np.bincount(group, minlength=1)[group] > 1 if len(group) else np.zeros(0, bool)) | single
            heads["single"] = single
            heads = taken(heads, wanted)
            yield batch([(g, REMOVED, b, n) for g, b, n in dealt(PLACE, owners, copies, owners["part"][copies["doc"]])]
                        + [(g, TO_CUT, b, n) for g, b, n in dealt(WANTED, owners, heads, owners["part"][heads["doc"]])])
        yield from ready

    placed = tables.select(spread.alias("goal"), "kind", "blob", "size", F.col("goal").alias("part"))
    return placed.repartitionById(buckets, "goal").sortWithinPartitions("goal").mapInArrow(run, TABLES)


# --- transforms of shards --------------------------------------------------------------------------------


def transform(held: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Burrows-Wheeler transform of several strings, each with an end of its own that sorts by its number before all bytes.

    Returns the bytes (0 at an end), the rows that hold an end, and whose it is. The first rows are the ends themselves.
    """
    count = len(sizes)
    stops = np.cumsum(sizes + 1) - 1
    total = len(held) + count
    symbol = np.zeros(total, np.int64)
    inner = np.ones(total, bool)
    inner[stops] = False
    symbol[inner] = held.astype(np.int64) + 1
    own = np.repeat(np.arange(count), sizes + 1)
    stop = stops[own]
    place = np.arange(total)
    key = np.zeros(total, np.int64)
    for k in range(7):
        at = place + k
        key = key << 9 | np.where(at < stop, symbol[np.minimum(at, total - 1)], 0)
    key[stops] = np.arange(count) - count  # ends first, in order
    depth, order = 7, np.argsort(key)
    while True:
        sorted_key = key[order]
        new = np.ones(total, bool)
        new[1:] = sorted_key[1:] != sorted_key[:-1]
        if new.all():
            break
        rank = np.empty(total, np.int64)
        rank[order] = np.cumsum(new) - 1
        key = rank * total + rank[np.minimum(place + depth, stop)]
        depth, order = 2 * depth, np.argsort(key)
    before = order - 1
    starts = stops - sizes
    opens = np.zeros(total, bool)
    opens[starts] = True
    rows = np.flatnonzero(opens[order])
    out = np.where(opens[order], 0, symbol[before] - 1).astype(np.uint8)
    return out, rows, own[order[rows]]


def placed_by_bucket(keys: np.ndarray) -> np.ndarray:
    """Stable order by whole numbers below 2**32, by their lower and then their upper half."""
    order = np.argsort((keys & 0xFFFF).astype(np.uint16), kind="stable")
    upper = (keys >> 16).astype(np.uint16)[order]
    return order[np.argsort(upper, kind="stable")] if upper.any() else order


class Merge:
    """Transforms of several shards whose rows are brought into one order, a common prefix at a time.

    ``back`` leads from a row to the row of the suffix that is one symbol longer. The interleave of all rows by their first
    ``h`` symbols, ties in the shards' own order, is refined: dealt by the ``g`` symbols before each row (known by number
    from the interleave at ``g``), it becomes the interleave by ``g + h``. Rows that are alone with their
    prefix are left out from then on, since a longer one cannot be repeated.
    """

    def __init__(self, shards: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.bases = np.concatenate([[0], np.cumsum([len(s[0]) for s in shards])]).astype(np.int64)
        self.back = np.zeros(self.bases[-1], np.int64)
        head = np.zeros(self.bases[-1], np.int64)
        self.ends = []
        for base, (symbols, rows, whose) in zip(self.bases, shards):
            symbol = symbols.astype(np.uint16) + 1
            symbol[rows] = 0
            order = np.argsort(symbol, kind="stable")
            inner = order[len(rows):]
            self.back[base + inner] = base + np.arange(len(rows), len(symbols))
            self.back[base + rows] = base + whose
            head[base:base + len(symbols)] = symbol[order]
            self.ends.append(base + np.arange(len(rows)))
        self.first = head

    def repeated(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows whose first ``length`` symbols are those of another row, in order, and where each interval of equal ones begins."""
        order = placed_by_bucket(self.first)
        ends = int(np.count_nonzero(self.first == 0))
        order, name = self._named(order[ends:], self.first[order[ends:]])
        depth, back, kept = 1, self.back, []
        whole = (order, name, depth, back)
        while 2 * depth <= length:
            kept.append(whole)
            order, name = self._refined(order, name, name, back)
            back, depth = back[back], 2 * depth
            whole = (order, name, depth, back)
        for _, part, g, step in reversed(kept):
            if depth + g <= length:
                order, name = self._refined(order, name, part, step)
                depth += g
        numbers = name[order]
        return order, np.flatnonzero(np.diff(numbers, prepend=-1))

    def _named(self, order: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The order without rows that are alone, and each row's number of its interval (-1: alone)."""
        new = np.ones(len(order) + 1, bool)
        for k, key in enumerate(keys):
            new[1:-1] = (key[1:] != key[:-1]) | (new[1:-1] if k else False)
        alone = new[:-1] & new[1:]
        name = np.full(self.bases[-1], -1, np.int64)
        name[order[~alone]] = np.cumsum(new[:-1] & ~alone)[~alone] - 1
        return order[~alone], name

    def _refined(self, order: np.ndarray, name: np.ndarray, part: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        longer, after = step[order], name[order]
        known = part[longer] >= 0
        longer, after = longer[known], after[known]
        dealt_to = placed_by_bucket(part[longer])
        longer, after = longer[dealt_to], after[dealt_to]
        return self._named(longer, part[longer], after)

    def places(self, sizes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Number of the string (over all shards) and offset of every row, read off by walking back from the ends."""
        string, offset = np.zeros(self.bases[-1], np.int64), np.zeros(self.bases[-1], np.int64)
        at, left = np.concatenate(self.ends), np.concatenate(sizes).astype(np.int64)
        number = np.arange(len(at))
        while len(at):
            string[at], offset[at] = number, left
            on = left > 0
            at, left, number = self.back[at[on]], left[on] - 1, number[on]
        return string, offset


def shard_table(owners: dict, rows: dict, held: np.ndarray, sizes: np.ndarray) -> bytes:
    symbols, at, whose = transform(held, sizes)
    table = packed(PLACE, owners, rows)
    return b"".join([np.array([len(table), len(symbols), len(at)], "<i8").tobytes(), table, at.astype("<u4").tobytes(), whose.astype("<u4").tobytes(), symbols.tobytes()])


def shard_parts(blob: bytes) -> tuple[bytes, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    size, length, ends = map(int, np.frombuffer(blob, "<i8", 3))
    at = 24 + size
    return blob[24:at], (np.frombuffer(blob, np.uint8, length, at + 8 * ends), np.frombuffer(blob, "<u4", ends, at).astype(np.int64),
                         np.frombuffer(blob, "<u4", ends, at + 4 * ends).astype(np.int64))


def by_document(layout: dict, blobs: list[bytes]) -> tuple[dict, dict, dict[tuple[int, int], np.ndarray]]:
    """The rows of each document, found by id and hash of its text."""
    owners, rows = unpacked(layout, blobs)
    rank = ranks(owners)[rows["doc"]] if len(rows["doc"]) else np.zeros(0, np.int64)
    order = np.lexsort((rows["start"], rank))
    cuts = np.flatnonzero(np.diff(rank[order], prepend=-1, append=-1))
    spots = {}
    for a, b in zip(cuts[:-1], cuts[1:]):
        doc = rows["doc"][order[a]]
        spots[int(owners["id"][doc]), int(owners["tie"][doc])] = order[a:b]
    return owners, rows, spots


def with_texts(docs: DataFrame, tables: DataFrame, parts: int) -> DataFrame:
    """Tables of each part of the documents, followed by its texts."""
    texts = docs.select(F.col("part").cast("int").alias("goal"), F.lit(TEXT).alias("kind"), F.col("text").cast("binary").alias("blob"), "id", "tie", "doc_id")
    none = F.lit(None).cast("long")
    both = tables.select("goal", "kind", "blob", none.alias("id"), none.alias("tie"), none.alias("doc_id")).unionByName(texts)
    return both.repartitionById(parts, "goal").sortWithinPartitions("goal", "kind", "id", "tie")


def texts_after_tables(batches: Iterator[pa.RecordBatch], layout: dict, limit: int) -> Iterator[tuple[int, tuple, pa.RecordBatch, pa.Array]]:
    """Rows with texts, a few megabytes at a time, beside the tables of their part."""
    goal, blobs, known = None, [], None
    for rows in batches:
        goals = np.asarray(rows["goal"])
        cuts = np.flatnonzero(np.diff(goals, prepend=-1, append=-1))
        for a, b in zip(cuts[:-1], cuts[1:]):
            if goals[a] != goal:
                goal, blobs, known = goals[a], [], None
            run = rows.slice(a, b - a)
            tables = pc.sum(pc.not_equal(run["kind"], TEXT)).as_py()
            blobs += run["blob"].slice(0, tables).to_pylist()
            if tables < len(run):
                if known is None:
                    known, blobs = by_document(layout, blobs), []
                own = run.slice(tables)
                column = own.schema.get_field_index("blob")
                for part, texts in text_slices(own.set_column(column, "blob", own["blob"].cast(pa.large_binary())), "blob", limit):
                    yield int(goal), known, part, texts


def shards(docs: DataFrame, tables: DataFrame, rule: Repeats, parts: int, merges: int) -> DataFrame:
    """The wanted regions of each part, cut out of the texts and transformed as one shard for each merge."""

    def flush(texts: list, owners: dict, rows: list[dict]) -> Iterator[pa.RecordBatch]:
        if not texts:
            return
        held, table = np.concatenate(texts), {k: np.concatenate([r[k] for r in rows]) for k in rows[0]}
        sizes = table["count"].astype(np.int64) + rule.length - 1
        starts = np.cumsum(sizes) - sizes
        goal = (mix(table["anchor"].astype(np.uint64)) % np.uint64(merges)).astype(np.int64)
        single = table["single"] > 0
        out = []
        if single.any():  # strings of hot anchors, each for itself
            counts = table["count"][single].astype(np.int64)
            which = np.repeat(np.flatnonzero(single), counts)
            nth = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
            alone = {"doc": table["doc"][which], "start": table["start"][which] + nth, "count": np.ones(len(which), np.uint32)}
            at = starts[which] + nth
            c1, c2 = digests(held, at, np.full(len(at), rule.length))
            rank = ranks(owners)
            order, new, first = firsts([c1, c2], rank[alone["doc"]], alone["start"])
            copies = taken(alone, order[~first])
            out += [(g, REMOVED, b, n) for g, b, n in dealt(PLACE, owners, copies, owners["part"][copies["doc"]])]
            heads = order[new]
            keep = np.flatnonzero(~single)
            table = {k: np.concatenate([table[k][keep], alone[k][heads]]) for k in PLACE}
            goal = np.concatenate([goal[keep], (c1[heads] % np.uint64(merges)).astype(np.int64)])
            starts, sizes = np.concatenate([starts[keep], at[heads]]), np.concatenate([sizes[keep], np.full(len(heads), rule.length)])
        order = np.argsort(goal, kind="stable")
        cuts = np.flatnonzero(np.diff(goal[order], prepend=-1, append=-1))
        for a, b in zip(cuts[:-1], cuts[1:]):
            mine = order[a:b]
            ends = np.cumsum(sizes[mine])
            cut = held[np.repeat(starts[mine] - ends + sizes[mine], sizes[mine]) + np.arange(ends[-1])]
            out.append((int(goal[mine[0]]), SHARD, shard_table(owners, taken({k: table[k] for k in PLACE}, mine), cut, sizes[mine]), len(mine)))
        yield batch(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        goal, done, texts, rows, size, owners = None, set(), [], [], 0, None
        for now, known, part, bodies in texts_after_tables(batches, WANTED, rule.block):
            if now != goal or size > rule.block:
                yield from flush(texts, owners, rows)
                texts, rows, size = [], [], 0
                if now != goal:
                    done = set()
            goal, (owners, table, spots) = now, known
            for k, key in enumerate(zip(part["id"].to_pylist(), part["tie"].to_pylist())):
                if key in spots and key not in done:
                    done.add(key)
                    mine = taken(table, spots[key])
                    body = np.frombuffer(bodies[k].as_buffer(), np.uint8)
                    sizes = mine["count"].astype(np.int64) + rule.length - 1
                    ends = np.cumsum(sizes)
                    texts.append(body[np.repeat(mine["start"].astype(np.int64) - ends + sizes, sizes) + np.arange(ends[-1])])
                    rows.append(mine)
                    size += int(ends[-1])
        yield from flush(texts, owners, rows)

    return with_texts(docs, tables.filter(F.col("kind") == TO_CUT), parts).mapInArrow(run, TABLES)


def merged(tables: DataFrame, rule: Repeats, merges: int) -> DataFrame:
    """Tables of the strings (``REMOVED``, by part of the documents) that an earlier place holds too, from shards' transforms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, tables in by_goal(batches):
            parts = [shard_parts(b) for k, b in tables]
            each = [unpacked(PLACE, [p[0]])[1]["count"].astype(np.int64) + rule.length - 1 for p in parts]
            owners, rows = unpacked(PLACE, [p[0] for p in parts])
            merge = Merge([p[1] for p in parts])
            order, heads = merge.repeated(rule.length)
            if not len(order):
                continue
            string, offset = merge.places(each)
            region, nth = string[order], offset[order]
            place = ranks(owners)[rows["doc"][region]] << 32 | (rows["start"][region].astype(np.int64) + nth)
            least = np.repeat(np.minimum.reduceat(place, heads), np.diff(np.append(heads, len(order))))
            later = np.flatnonzero(place != least)
            turn = later[np.lexsort((nth[later], region[later]))]
            region, nth = region[turn], nth[turn]
            if not len(turn):
                continue
            new = np.ones(len(turn), bool)
            new[1:] = (region[1:] != region[:-1]) | (nth[1:] != nth[:-1] + 1)
            spots = np.flatnonzero(new)
            runs = {"doc": rows["doc"][region[spots]], "start": rows["start"][region[spots]] + nth[spots], "count": np.diff(np.append(spots, len(turn)))}
            yield batch([(g, REMOVED, b, n) for g, b, n in dealt(PLACE, owners, runs, owners["part"][runs["doc"]])])

    return tables.repartitionById(merges, "goal").sortWithinPartitions("goal").mapInArrow(run, TABLES)


def without_repeats(docs: DataFrame, rule: Repeats = Repeats(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``kept`` (bytes), ``n_bytes``, ``n_removed``, ``n_spans``, and ``spans`` (start, end of each removed run).

    A byte goes when a string of ``rule.length`` bytes over it also starts earlier: in a smaller ``doc_id``, or before it in the same document.
    Strings are judged on the input; matches never cross documents.

    Null text: no bytes, nothing removed. Null id: taken for the least whole number. Rows with one id and different
    texts follow each other by a hash of the text; rows that repeat id and text are one document, with the same result each.
    Texts shorter than ``rule.length`` stay whole. No rows in, no rows out. Other columns are not read.
    """
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = light(docs).select(F.col(f"`{id}`").cast("long").alias("doc_id"), body.alias("text"), F.xxhash64(body).alias("tie"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets, parts = max(1, math.ceil(total / rule.share)), max(1, math.ceil(2 * total / rule.share))
    rows = rows.withColumn("id", F.coalesce("doc_id", F.lit(NO_ID)))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("id", "tie"), F.lit(parts)))
    first = pinned(decided(anchored(rows.filter(F.octet_length("text") >= rule.length), rule, buckets, rule.limit(total)), rule, buckets), "repeats-first")
    size = first.filter(F.col("kind") == TO_CUT).agg(F.sum("size")).first()[0] or 0
    merges = max(1, math.ceil(size * 1.3 * rule.length / rule.merge))
    cut = shards(rows, first, rule, parts, merges)
    found = cut.filter(F.col("kind") == SHARD)
    copies = first.filter(F.col("kind") == REMOVED)
    if rule.hot or rule.limit(total) < rule.capacity:
        cut = pinned(cut, "repeats-shards")
        found, copies = cut.filter(F.col("kind") == SHARD), copies.unionByName(cut.filter(F.col("kind") == REMOVED))
    removed = copies.unionByName(pinned(merged(found, rule, merges), "repeats-merged"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (owners, table, spots), part, bodies in texts_after_tables(batches, PLACE, rule.block):
            kept, sizes, gone, spans = [], [], [], []
            for k, key in enumerate(zip(part["id"].to_pylist(), part["tie"].to_pylist())):
                body = bodies[k].as_buffer()
                sizes.append(body.size)
                if key not in spots:
                    kept.append(body.to_pybytes())
                    gone.append(0)
                    spans.append([])
                    continue
                start = table["start"][spots[key]].astype(np.int64)
                stop = np.maximum.accumulate(start + table["count"][spots[key]] + rule.length - 1)
                new = np.append(True, start[1:] > stop[:-1])
                a, b = start[new], stop[np.append(np.flatnonzero(new)[1:] - 1, len(stop) - 1)]
                view, edges = memoryview(body), [0, *np.stack([a, b], 1).ravel().tolist(), body.size]
                kept.append(b"".join(view[x:y] for x, y in zip(edges[::2], edges[1::2])))
                gone.append(int((b - a).sum()))
                spans.append([{"start": int(x), "end": int(y)} for x, y in zip(a, b)])
            yield pa.RecordBatch.from_arrays([
                part["doc_id"], pa.array(kept, pa.binary()), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(list(map(len, spans)), pa.int64()),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))], names=["doc_id", "kept", "n_bytes", "n_removed", "n_spans", "spans"])

    return with_texts(rows, removed, parts).mapInArrow(
        run, "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long, spans array<struct<start:long,end:long>>")
