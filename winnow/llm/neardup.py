"""Near duplicates: fast similarity sketches, banding, exact verification, connected components."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from winnow.llm.tables import light, partitions, pinned
from winnow.llm.words import Words, mix, shingle_hashes, text_slices

EMPTY = np.iinfo(np.uint64).max
GOLDEN = 0x9E3779B97F4A7C15
#: Sets side by side in one comparison, and shingles they may hold together.
TILE_SETS, TILE_SHINGLES = 256, 1 << 20
NO_DOC = 2**63 - 1
#: Slots that a node's edges are dealt to, and the largest bit filter (2 to that power).
SPOKES, FILTER_BITS = 64, 26


@dataclass(frozen=True)
class NearDup:
    """``width`` words a shingle; linked at ``100 * shared >= percent * union``.

    ``bands`` of ``rows`` coordinates each: at 80 % likeness a pair misses every one of 42 bands of 6 with
    a probability of 3e-6.
    """

    width: int = 5
    percent: int = 80
    bands: int = 42
    rows: int = 6

    @property
    def bins(self) -> int:
        return self.bands * self.rows


def sketches(elements: np.ndarray, offsets: np.ndarray, bins: int) -> np.ndarray:
    """Fast similarity sketches of several sets; ``(sets, bins)``.

    Round ``i`` throws every element into one hashed bin with value ``i`` plus a fraction, bins keep
    their least value. After ``bins`` rounds, round ``bins + j`` throws all elements into bin ``j``, so every coordinate
    of a non-empty set is filled. A set whose bins are all full takes no further part: later values are larger.
    """
    count = len(offsets) - 1
    out = np.full(count * bins, EMPTY, np.uint64)
    owner = np.repeat(np.arange(count), np.diff(offsets))
    for i in range(2 * bins):
        if not len(elements):
            break
        h = mix(elements + np.uint64((i * GOLDEN) & 0xFFFFFFFFFFFFFFFF))
        place = (h % np.uint64(bins)).astype(np.int64) if i < bins else i - bins
        np.minimum.at(out, owner * bins + place, np.uint64(i << 54) | (mix(h) >> np.uint64(10)))
        open_sets = (out.reshape(count, bins) == EMPTY).any(1)
        live = open_sets[owner]
        if not live.all():
            elements, owner = elements[live], owner[live]
    return out.reshape(count, bins)


def band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.repeat(mix(np.arange(bands, dtype=np.uint64) + np.uint64(GOLDEN))[None], len(sketch), 0)
    for r in range(rows):
        keys = mix(keys * np.uint64(GOLDEN) + sketch[:, r::rows])
    return keys


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, and their offsets."""
    words = Words(texts)
    hashes, ends = shingle_hashes(words.hashes(), words.offsets, width)
    own = [np.unique(hashes[a:b]) for a, b in zip(ends[:-1], ends[1:])]
    sizes = np.fromiter(map(len, own), np.int64, len(own))
    return (np.concatenate(own) if own else hashes), np.concatenate([[0], np.cumsum(sizes)])


def set_names(elements: np.ndarray, offsets: np.ndarray) -> list[str | None]:
    return [xxhash.xxh3_128_hexdigest(elements[a:b].tobytes()) if b > a else None for a, b in zip(offsets[:-1], offsets[1:])]


def signatures(docs: DataFrame, rule: NearDup, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``hash`` (of the text), ``n`` (set size), ``set`` (128-bit name of the shingle set) and its ``bands``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_slices(batch):
                elements, offsets = shingle_sets(texts, rule.width)
                keys = band_keys(sketches(elements, offsets, rule.bins), rule.bands, rule.rows).view(np.int64)
                full = np.diff(offsets) > 0
                spots = np.concatenate([[0], np.cumsum(full * rule.bands)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    part["doc_id"], part["hash"], pa.array(np.diff(offsets)), pa.array(set_names(elements, offsets), pa.string()),
                    pa.ListArray.from_arrays(pa.array(spots), pa.array(keys[full].ravel())),
                ], names=["doc_id", "hash", "n", "set", "bands"])

    body = F.col(text).cast("string")
    cut = docs.select(F.col(id).cast("long").alias("doc_id"), body.alias("text"), F.xxhash64(body).alias("hash"))
    return cut.mapInArrow(run, "doc_id long, hash long, n long, set string, bands array<long>")


def linked(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int) -> Iterator[tuple[int, int]]:
    """Links between ``left`` and ``right`` members of a tile, as a spanning forest.

    Intersections of all pairs come from one product of presence matrices, a block of shingles at a time; shingles held
    by one set alone cannot be shared and are left out.
    """
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    names, code, held = np.unique(flat, return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    shared = held[code] > 1
    code, owner = (np.cumsum(held > 1) - 1)[code[shared]], owner[shared]
    common = np.zeros((len(left), len(right)), np.float32)
    lpos, rpos = np.full(len(sets), -1), np.full(len(sets), -1)
    lpos[left], rpos[right] = np.arange(len(left)), np.arange(len(right))
    block = 4096
    order = np.argsort(code, kind="stable")
    code, owner = code[order], owner[order]
    for start in range(0, int(code[-1]) + 1 if len(code) else 0, block):
        a, b = np.searchsorted(code, [start, start + block])
        width = min(block, int(code[-1]) + 1 - start)
        sides = []
        for pos, n in ((lpos, len(left)), (rpos, len(right))):
            at = pos[owner[a:b]]
            m = np.zeros((n, width), np.float32)
            m[at[at >= 0], code[a:b][at >= 0] - start] = 1
            sides.append(m)
        common += sides[0] @ sides[1].T
    both = np.rint(common).astype(np.int64)
    union = sizes[left][:, None] + sizes[right][None] - both
    parent = list(range(len(sets)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, j in zip(*np.nonzero(100 * both >= percent * union)):
        a, b = find(int(left[i])), find(int(right[j]))
        if a != b:
            parent[a] = b
            yield int(left[i]), int(right[j])


def buckets(sets: DataFrame, look: int) -> DataFrame:
    """``bucket, member, n, early``: the buckets of all keys that several sets share; ``early`` are those of the first ``look`` bands.

    A key's last bit says whether its band is early, so that a key and a member are all that one exchange carries for each set and band.
    """
    short = F.xxhash64("set")
    early = lambda key, band: F.when(band < look, key.bitwiseAND(F.lit(-2))).otherwise(key.bitwiseOR(F.lit(1)))
    over = Window.partitionBy("bucket")
    counted = sets.select(F.explode(F.transform("bands", early)).alias("bucket"), short.alias("member")).select(
        "*", F.min("member").over(over).alias("low"), F.max("member").over(over).alias("high"))
    shared = counted.filter("low < high").select("bucket", "member")
    return pinned(shared.join(sets.select(short.alias("member"), "n"), "member").withColumn("early", F.expr("bucket & 1 = 0")), "buckets")


def mixed(entries: DataFrame, roots: DataFrame | None) -> DataFrame:
    """``bucket, member, n, root, size, held``: the buckets whose members are of several components. Buckets of the same members are kept once."""
    own = entries.select("bucket", "member", "n")
    own = own.withColumn("root", F.col("member")) if roots is None else own.join(roots, "member", "left").withColumn("root", F.coalesce("root", "member"))
    over = Window.partitionBy("bucket")
    counted = own.select(
        "*", F.min("root").over(over).alias("low"), F.max("root").over(over).alias("high"), F.count("*").over(over).alias("size"), F.sum("n").over(over).alias("held"),
        F.sum(F.col("member").cast("decimal(20,0)")).over(over).alias("sum1"), F.bit_xor(F.xxhash64("member")).over(over).alias("sum2"))
    several = pinned(counted.filter("low < high").drop("low", "high"), "mixed")
    once = several.groupBy("size", "held", "sum1", "sum2").agg(F.min("bucket").alias("bucket")).select("bucket")
    return several.join(once, "bucket", "left_semi").drop("sum1", "sum2")


def tiles_for(size: Column, held: Column) -> Column:
    return F.greatest(F.ceil(size / TILE_SETS), F.ceil(held / TILE_SHINGLES), F.lit(1)).cast("int")


def starred(entries: DataFrame) -> DataFrame:
    """Tiles of a first look: each with itself and with the bucket's first. Copies of a set do not grow with its bucket."""
    tiles = tiles_for(F.col("size"), F.col("held"))
    own = F.pmod(F.xxhash64("member", F.lit(7)), tiles).cast("int")
    other = F.when(F.col("own") == 0, F.sequence(F.lit(0), F.col("tiles") - 1)).otherwise(F.array(F.lit(0), "own"))
    return entries.select("bucket", "member", tiles.alias("tiles"), own.alias("own")).select("bucket", "member", "own", F.explode(other).alias("other"))


def crossed(entries: DataFrame) -> DataFrame:
    """Tiles of the members outside a bucket's largest component, with each other and with that component's."""
    shares = entries.groupBy("bucket", "root").agg(F.count("*").alias("k"), F.sum("n").alias("m"))
    main = shares.groupBy("bucket").agg(F.max(F.struct("k", "m", "root")).alias("main"))
    both = entries.join(main, "bucket").select(
        "bucket", "member", (F.col("root") == F.col("main.root")).alias("inside"),
        tiles_for(F.col("size") - F.col("main.k"), F.col("held") - F.col("main.m")).alias("few"), tiles_for(F.col("main.k"), F.col("main.m")).alias("many"))
    deal = lambda n: F.pmod(F.xxhash64("member", F.lit(7)), F.col(n)).cast("int")
    own = F.when(F.col("inside"), F.col("few") + deal("many")).otherwise(deal("few"))
    other = F.sequence(F.lit(0), F.when(F.col("inside"), F.col("few")).otherwise(F.col("few") + F.col("many")) - 1)
    return both.select("bucket", "member", own.alias("own"), F.explode(other).alias("other"))


def links(docs: DataFrame, sets: DataFrame, rule: NearDup, id: str, text: str) -> DataFrame:
    """Verified links ``(a, b)`` between set names that span the likeness graph.

    Sets that share a band key meet in tiles and are compared by their shingles. A first look at a sixth of the bands
    finds most components; then every bucket that still holds several of them is compared across them, in all bands. Nothing is capped, and
    no pair that fails leaves its task. A set's shingles travel to a few tiles, not to one for every band and tile of its bucket.
    """
    entries = buckets(sets, max(1, rule.bands // 6))
    first = pinned(compared(docs, sets, starred(mixed(entries.filter("early"), None)), rule, id, text), "links")
    roots = components(first).select(F.xxhash64("node").alias("member"), F.xxhash64("root").alias("root"))
    rest = compared(docs, sets, crossed(mixed(entries, roots)), rule, id, text)
    return first.unionByName(rest)


def compared(docs: DataFrame, sets: DataFrame, dealt: DataFrame, rule: NearDup, id: str, text: str) -> DataFrame:
    """Links found in tiles ``bucket, member, own, other``, by shingles made anew from the sets' own texts.

    Shingles are exchanged twice: by set, where copies meet and tiles are joined, and by tile.
    """
    short = F.xxhash64("set")
    tiles = dealt.select("bucket", "member", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    asked = pinned(tiles.join(sets.select(short.alias("member"), "set"), "member").drop("member"), "tiles")
    wanted = pinned(asked.select("set").distinct().join(sets.select("set", "rep", "rep_hash"), "set"), "wanted")

    def remake(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_slices(batch):
                elements, offsets = shingle_sets(texts, rule.width)
                raw = pa.array([elements[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(set_names(elements, offsets), pa.string()), raw], names=["set", "shingles"])

    made = of_representatives(docs, wanted, id, text).mapInArrow(remake, "set string, shingles binary")
    # the texts' filter lets other rows through; a second one keeps most of their shingles from being sent
    own = sieved(made.withColumn("key", short), wanted.select(short.alias("key")))[0]
    own = own.groupBy("set").agg(F.any_value("shingles").alias("shingles"))
    rows = asked.join(own, "set").select("bucket", "i", "j", "own", "set", "shingles")

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def flush(parts: list[pd.DataFrame]) -> pd.DataFrame:
            group = pd.concat(parts, ignore_index=True)
            kept = [np.frombuffer(s, np.uint64) for s in group["shingles"]]
            own, i, j = group["own"].to_numpy(), group["i"].iloc[0], group["j"].iloc[0]
            left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
            if not len(left) or not len(right):
                return pd.DataFrame({"a": [], "b": []}, dtype=str)
            pairs = [(a, b) for a, b in linked(kept, left, right, rule.percent) if a != b]
            return pd.DataFrame({"a": group["set"].to_numpy()[[p[0] for p in pairs]], "b": group["set"].to_numpy()[[p[1] for p in pairs]]}, dtype=object)

        for group in groups(frames, ["bucket", "i", "j"]):
            yield flush(group)

    dealt = rows.repartition(partitions(rows), "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    return dealt.mapInPandas(compare, "a string, b string")


def row_key(doc: Column, hash: Column) -> Column:
    return F.xxhash64(F.isnull(doc), F.coalesce(doc, F.lit(0)), hash)


def sieved(rows: DataFrame, keys: DataFrame, key: str = "key") -> tuple[DataFrame, DataFrame]:
    """``rows`` split by a bit filter of ``keys``: those that may have one of them, and those that surely have none.

    The filter has some 16 bits a key and at most ``FILTER_BITS``, so the broadcast is bounded; beyond that it lets
    more rows through, which the join behind it settles.
    """
    count = keys.count()
    bits = 1 << min(FILTER_BITS, max(10, (16 * count).bit_length()))
    slot = lambda c: F.pmod(F.col(c), F.lit(bits))
    words = keys.select(slot(key).alias("s")).groupBy(F.shiftright("s", 6).alias("_word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(s & 63 as int))")).alias("_bits"))
    seen = rows.withColumn("_slot", slot(key)).join(F.broadcast(words), F.shiftright("_slot", 6) == F.col("_word"), "left")
    hit = F.coalesce(F.expr("(shiftright(_bits, cast(_slot & 63 as int)) & 1) = 1"), F.lit(False))
    out = lambda c: seen.filter(c).select(*[F.col(f"`{n}`") for n in rows.columns])
    return out(hit), out(~hit)


def of_representatives(docs: DataFrame, wanted: DataFrame, id: str, text: str) -> DataFrame:
    """``text`` of the rows that stand for the wanted sets, found by id and hash of the text; other rows with the same filter bits too."""
    body = F.col(f"`{text}`").cast("string")
    rows = docs.select(row_key(F.col(f"`{id}`").cast("long"), F.xxhash64(body)).alias("key"), body.alias("text"))
    return sieved(rows, wanted.select(row_key(F.col("rep"), F.col("rep_hash")).alias("key")))[0].select("text")


def groups(frames: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[list[pd.DataFrame]]:
    """Runs of equal keys in frames sorted by them, each as a list of pieces."""
    held: list[pd.DataFrame] = []
    last = None
    for frame in frames:
        if not len(frame):
            continue
        k = frame[keys].to_numpy()
        cuts = np.concatenate([[0], np.flatnonzero((k[1:] != k[:-1]).any(1)) + 1, [len(frame)]])
        for a, b in zip(cuts[:-1], cuts[1:]):
            now = tuple(k[a])
            if held and now != last:
                yield held
                held = []
            held.append(frame.iloc[a:b])
            last = now
    if held:
        yield held


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)``: the least node of each connected component, by alternating large and small stars.

    Every round is a few aggregations and joins on keys and ends in a written table. A node's edges are dealt to ``SPOKES`` slots
    whose minima are put together and handed back, so that no task holds a hub. The stars are final when a round changes no edge.
    """
    def stars(e: DataFrame, both: bool) -> DataFrame:
        if both:
            e = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        e = e.withColumn("s", F.pmod(F.xxhash64("b"), F.lit(SPOKES)))
        slots = e.groupBy("a", "s").agg(F.min("b").alias("m"))
        least = slots.groupBy("a").agg(F.min("m").alias("m"), F.collect_set("s").alias("s")).select("a", F.least("a", "m").alias("m"), "s")
        near = e.join(least.select("a", "m", F.explode("s").alias("s")), ["a", "s"])
        if both:  # larger neighbours hang below the least one
            return near.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        return near.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()

    def seal(e: DataFrame):
        return e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").cast("decimal(20,0)"))).first()

    now = pinned(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    before = seal(now)
    while before[0]:
        now = pinned(stars(stars(now, True), False), "stars")
        after = seal(now)
        if after == before:
            break
        before = after
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def judged(docs: DataFrame, rule: NearDup, id: str, text: str) -> DataFrame:
    """``doc_id, hash, n_shingles, component_id, kept`` for every row."""
    signed = pinned(signatures(light(docs), rule, id, text), "signatures")
    sets = signed.filter("set is not null").groupBy("set").agg(
        F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "hash")).alias("least"), F.any_value("n").alias("n"), F.any_value("bands").alias("bands"))
    sets = pinned(sets.select("set", F.col("least.doc_id").alias("rep"), F.col("least.hash").alias("rep_hash"), "n", "bands"), "sets")
    found = links(docs, sets, rule, id, text)
    named = sets.select("set", F.struct(F.coalesce("rep", F.lit(NO_DOC)).alias("doc"), F.col("set").alias("set")).alias("node"))
    edges = found.distinct().join(named.select(F.col("set").alias("a"), F.col("node").alias("na")), "a") \
        .join(named.select(F.col("set").alias("b"), F.col("node").alias("nb")), "b").select(F.col("na").alias("a"), F.col("nb").alias("b"))
    rooted = components(edges).select(F.col("node")["set"].alias("set"), F.col("root")["doc"].alias("root"))
    # written, so that the join with all rows reads both sides from exchanges and a hot set can be split
    least = pinned(sets.select("set", "rep").join(rooted, "set", "left").select("set", F.coalesce("root", "rep").alias("root")), "roots")
    joined = signed.select("doc_id", "hash", "n", "set").join(least, "set", "left")
    component = F.when(F.col("set").isNull(), F.col("doc_id")).otherwise(F.nullif(F.col("root"), F.lit(NO_DOC)))
    return joined.select(
        "doc_id", "hash", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def near_duplicates(docs: DataFrame, rule: NearDup = NearDup(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``n_shingles``, ``component_id`` and ``kept``.

    Documents are linked when their sets of ``rule.width``-word shingles reach ``rule.percent``; a component's id is
    the least ``doc_id`` in it. Copies fold into one set first, so groups of copies cost one comparison however many they are.

    Null, empty or wordless text: size 0, linked with nothing, kept. Fewer words than a shingle: the
    sequence is the one shingle. Null ``doc_id``: never a component's id unless the component has no other; such rows are kept only
    then. A repeated ``doc_id`` is kept or dropped by its own text's component. No rows in, no rows out. Other columns
    are not read.
    """
    return judged(docs, rule, id, text).drop("hash")


def deduplicate(docs: DataFrame, rule: NearDup = NearDup(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows, all columns, that :func:`near_duplicates` keeps. Rows that repeat both id and text stay together."""
    dropped = judged(docs, rule, id, text).filter(~F.col("kept")).select(F.col("doc_id").alias("_dup_id"), F.col("hash").alias("_dup_hash")).distinct()
    dropped = pinned(dropped, "dropped")
    own, hash = F.col(f"`{id}`").cast("long"), F.xxhash64(F.col(f"`{text}`").cast("string"))
    doubtful, clear = sieved(docs.withColumn("_dup_key", row_key(own, hash)), dropped.select(row_key(F.col("_dup_id"), F.col("_dup_hash")).alias("_dup_key")), "_dup_key")
    same = own.eqNullSafe(F.col("_dup_id")) & (hash == F.col("_dup_hash"))
    # rows that surely stay are not shuffled
    return clear.unionByName(doubtful.join(dropped, same, "left_anti")).drop("_dup_key")
