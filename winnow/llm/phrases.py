"""Phrase collocations by dynamic itemset counting: longer phrases start while shorter ones are still being counted."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from winnow.llm.tables import light, pinned
from winnow.llm.words import mix, text_slices
from winnow.session import scratch_path

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
SPACES, BREAKS = b" \t", b".,;:!?\n\x0b\x0c\r"
#: Bytes of text counted at once in a task.
COUNTED = 3 << 20
NEVER = 255


@dataclass(frozen=True)
class Mining:
    """``least`` occurrences make a phrase frequent; ``longest`` words at most; the corpus is scanned in ``shards``.

    ``slots``, a power of two, bounds what travels to the tasks: two bytes a slot and length. A bucket of numbers
    stands for ``share`` bytes of text.
    """

    least: int = 30
    longest: int = 4
    shards: int = 3
    slots: int = 1 << 22
    share: int = 32 << 20
    cover: int = 80
    top: int = 2000


class Slots:
    """The first and last step at which a phrase hashed to a slot became frequent; bounded, so only a sieve.

    What it lets through wrongly is settled when phrases are counted by their letters: a slot's span holds the steps of all in it.
    """

    def __init__(self, size: int):
        self.first, self.last = np.full(size, NEVER, np.uint8), np.zeros(size, np.uint8)

    def add(self, slots: np.ndarray, step: int) -> None:
        self.first[slots] = np.minimum(self.first[slots], step)
        self.last[slots] = step

    def folded(self) -> Slots:
        """The same in as few slots as its phrases need, eight for each."""
        taken = int(np.count_nonzero(self.first != NEVER))
        out = Slots(min(len(self.first), 1 << max(10, (8 * taken - 1).bit_length())))
        out.first, out.last = self.first.reshape(-1, len(out.first)).min(0), self.last.reshape(-1, len(out.last)).max(0)
        return out


class Pieces:
    """Words of several texts with the piece each stands in; words are codes into ``distinct``."""

    def __init__(self, texts: pa.Array):
        sizes = np.asarray(pc.binary_length(texts), dtype=np.int64)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        first = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset] if len(texts) else 0
        held = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[first:first + ends[-1]]
        lower, kind = np.arange(256, dtype=np.uint8), np.zeros(256, np.uint8)
        lower[ord("A"):ord("Z") + 1] += 32
        kind[list(SPACES)], kind[list(BREAKS)] = 1, 2
        kinds = kind[held]
        letter = kinds == 0
        first_byte, last_byte = np.ones(len(held), bool), np.ones(len(held), bool)
        first_byte[1:], last_byte[:-1] = ~letter[:-1], ~letter[1:]
        first_byte[ends[:-1][sizes > 0]] = True
        last_byte[ends[1:][sizes > 0] - 1] = True
        starts, stops = np.flatnonzero(letter & first_byte), np.flatnonzero(letter & last_byte) + 1
        self.doc = np.repeat(np.arange(len(sizes)), np.diff(np.searchsorted(starts, ends)))
        # both rise along the text, so two words share a piece where the sums agree
        self.piece = np.cumsum(kinds == 2, dtype=np.int32)[starts] + self.doc
        offsets = np.concatenate([[0], np.cumsum(stops - starts)]).astype(np.int64)
        flat = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(lower[held[letter]])])
        encoded = flat.dictionary_encode()
        self.codes = np.asarray(encoded.indices, dtype=np.int64)
        self.distinct: pa.Array = encoded.dictionary


def numbered(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and 32-bit number of each hashed phrase, and both as one hash: what a phrase is known by until it is spelled."""
    bucket, number = hashes & np.uint64(0xFFFFFFFF), hashes >> np.uint64(32)
    bucket = bucket % np.uint64(buckets)
    return bucket.astype(np.int64), number.astype("<u4"), mix(number << np.uint64(32) | bucket)


PACKED = "shard int, langs array<string>, codes binary, hashes binary, tongues binary, letters binary, ends binary"
OPENS = np.uint32(1 << 31)


def packed(docs: DataFrame, rule: Mining) -> DataFrame:
    """Slices of the texts as word numbers, cut once: ``codes`` into the slice's different words, flagged where a piece begins.

    A different word has its hash (with its language), its language's number in ``langs``, and its letters.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in text_slices(batch, limit=COUNTED):
                cut = Pieces(texts)
                if not len(cut.codes):
                    continue
                langs = rows["lang"].dictionary_encode()
                names = langs.dictionary.to_pylist()
                pairs, codes = np.unique(np.asarray(langs.indices, dtype=np.int64)[cut.doc] * len(cut.distinct) + cut.codes, return_inverse=True)
                tongue, which = np.divmod(pairs, len(cut.distinct))
                salt = np.fromiter((xxhash.xxh3_64_intdigest(v) for v in names), np.uint64, len(names))
                own = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in cut.distinct.to_pylist()), np.uint64, len(cut.distinct))
                opens = np.append(True, cut.piece[1:] != cut.piece[:-1])
                words = cut.distinct.take(pa.array(which))
                sizes = np.asarray(pc.binary_length(words), dtype=np.int64)
                letters = bytes(words.buffers()[2])[:int(sizes.sum())]
                fields = [codes.astype("<u4") | np.where(opens, OPENS, np.uint32(0)), mix(own[which] ^ salt[tongue]), tongue.astype("<u4"), None, np.cumsum(sizes)]
                blobs = [letters if f is None else f.tobytes() for f in fields]
                shard = xxhash.xxh3_64_intdigest(blobs[0]) % rule.shards
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard], pa.int32()), pa.array([names], pa.list_(pa.string())), *(pa.array([b], pa.binary()) for b in blobs)],
                    names=["shard", "langs", "codes", "hashes", "tongues", "letters", "ends"])

    return docs.mapInArrow(run, PACKED)


class Runs:
    """Phrases of a packed slice by length: the hash they are known by at every place, and which places hold one."""

    def __init__(self, batch: pa.RecordBatch, row: int, buckets: int):
        field = lambda name: batch[name][row].as_buffer()
        codes = np.frombuffer(field("codes"), "<u4")
        self.codes, self.piece = (codes & ~OPENS).astype(np.int64), np.cumsum(codes >= OPENS, dtype=np.int32)
        self.hashes, self.tongues = np.frombuffer(field("hashes"), np.uint64), np.frombuffer(field("tongues"), "<u4")
        self.langs, self.buckets = pa.array(batch["langs"][row].as_py(), pa.string()), buckets
        self.field = field

    def words(self) -> pa.Array:
        letters, ends = self.field("letters"), np.frombuffer(self.field("ends"), np.int64)
        return pa.Array.from_buffers(pa.large_string(), len(ends), [None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int64)), letters])

    def lengths(self, known: list[Slots]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray | None]]:
        """Length, places, the phrases' hashes there and their parts' slots, for phrases with parts that are frequent so far.

        Places thin out from length to length: only those are looked at where both parts have been frequent at some step.
        A word's place is its number, a longer phrase's that of its first word.
        """
        yield 1, np.arange(len(self.hashes)), self.hashes, None
        for length, sieve in enumerate(known, 1):
            if length == 1:
                slot = (numbered(self.hashes, self.buckets)[2] % np.uint64(len(sieve.first))).astype(np.int64)
                places = np.flatnonzero((sieve.first[slot] < NEVER)[self.codes])
                own, chain = slot[self.codes[places]], self.hashes[self.codes[places]]
            else:
                own = (numbered(chain, self.buckets)[2] % np.uint64(len(sieve.first))).astype(np.int64)
                often = sieve.first[own] < NEVER
                places, chain, own = places[often], chain[often], own[often]
            both = np.flatnonzero(places[1:] == places[:-1] + 1)
            both = both[self.piece[places[both]] == self.piece[places[both] + length]]
            slots = np.stack([own[both], own[both + 1]])
            places = places[both]
            chain = mix(chain[both] * GOLDEN + self.hashes[self.codes[places + length]])
            yield length + 1, places, chain, slots

    def different(self, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Where in ``at`` every different phrase stands once, and their counts."""
        keys = self.codes[at]
        for k in range(1, length):
            keys = (keys if k == 1 else np.unique(keys, return_inverse=True)[1]) * len(self.hashes) + self.codes[at + k]
        _, spots, counts = np.unique(keys, return_index=True, return_counts=True)
        return spots, counts


SCANNED = "len int, bucket int, blob binary, lang string, c long"
SPELLED = pa.schema([("lang", pa.string()), ("len", pa.int32()), ("phrase", pa.string()), ("c", pa.int64())])
DEALT = SPELLED.append(pa.field("bucket", pa.int32()))
#: Phrases that a task holds before it hands them on, and how many it hands on at once.
KEPT, SENT = 1 << 17, 1 << 13


def planes(values: np.ndarray) -> bytes:
    """Numbers below 2**32, all their first bytes, then all their second ones, and so on: small ones leave runs of zeros to compress."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def from_planes(blob: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def squeezed(blob: bytes) -> bytes:
    """Compressed by zstd behind the size: a table is written once and exchanged with each of the steps that count it."""
    return len(blob).to_bytes(8, "little") + pa.Codec("zstd", compression_level=1).compress(blob, asbytes=True)


def full_size(blob: bytes) -> int:
    return int.from_bytes(blob[:8], "little")


def opened(blob: bytes) -> pa.Buffer:
    return pa.Codec("zstd").decompress(memoryview(blob)[8:], decompressed_size=full_size(blob))


def counted(runs: Runs, step: int, rule: Mining, known: list[Slots]) -> Iterator[pa.RecordBatch]:
    """Tables of numbers and counts by length and bucket: all words in the first cycle, and the phrases whose turn it is."""
    rows = {"len": [], "bucket": [], "blob": [], "lang": [], "c": []}

    def add(length, bucket, blob, lang, c):
        for key, v in zip(rows, (length, bucket, blob, lang, c)):
            rows[key].append(v)

    held = np.bincount(runs.codes, minlength=len(runs.hashes))
    if step < rule.shards:
        for name, c in zip(runs.langs.to_pylist(), np.bincount(runs.tongues, held).tolist()):
            add(0, None, None, name, int(c))
    for length, _, chain, slots in runs.lengths(known):
        counts = held
        if length > 1:
            sieve = known[length - 2]
            begin, end = sieve.first[slots].max(0), sieve.last[slots].max(0).astype(np.int64)
            chain, counts = np.unique(chain[(begin < step) & (step <= end + rule.shards)], return_counts=True)
        elif step >= rule.shards:
            continue
        bucket, number, _ = numbered(chain, runs.buckets)
        keys = bucket << 32 | number.astype(np.int64)
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        cuts = np.flatnonzero(np.diff(keys >> 32, prepend=-1, append=-1))
        for a, b in zip(cuts[:-1], cuts[1:]):
            add(length, int(keys[a] >> 32), squeezed(planes(np.diff(keys[a:b] & 0xFFFFFFFF, prepend=0)) + planes(counts[a:b])), None, None)
    kinds = (pa.int32(), pa.int32(), pa.binary(), pa.string(), pa.int64())
    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), kinds)], names=list(rows))


def spelled(runs: Runs, known: list[Slots]) -> Iterator[pa.RecordBatch]:
    """Occurrences, by letters, of the phrases whose number is frequent, and the bucket of each."""
    words, held = runs.words(), np.bincount(runs.codes, minlength=len(runs.hashes))
    for length, places, chain, _ in runs.lengths(known[:-1]):
        sieve = known[length - 1]
        bucket, _, known_by = numbered(chain, runs.buckets)
        often = np.flatnonzero(sieve.first[(known_by % np.uint64(len(sieve.first))).astype(np.int64)] < NEVER)
        if length == 1:
            first, counts = places[often], held[often]
            phrase = words.take(pa.array(first))
        else:
            spots, counts = runs.different(places[often], length)
            often = often[spots]
            where = places[often]
            first = runs.codes[where]
            phrase = pc.binary_join_element_wise(*[words.take(pa.array(runs.codes[where + k])) for k in range(length)], pa.scalar(" ", pa.large_string()))
        yield pa.RecordBatch.from_arrays([
            runs.langs.take(pa.array(runs.tongues[first].astype(np.int64))), pa.array(np.full(len(first), length, np.int32)), phrase.cast(pa.string()),
            pa.array(counts.astype(np.int64)), pa.array(bucket[often].astype(np.int32))], schema=DEALT)


def summed(parts: list[pa.RecordBatch]) -> pa.Table:
    schema = parts[0].schema
    keys = [name for name in schema.names if name != "c"]
    sums = pa.Table.from_batches(parts).group_by(keys, use_threads=False).aggregate([("c", "sum")])
    return sums.rename_columns({"c_sum": "c"}).select(schema.names).cast(schema)


def folded(batches: Iterator[pa.RecordBatch], most: int = KEPT, sent: int = SENT) -> Iterator[pa.RecordBatch]:
    """The same phrases added up before they leave the task, some ``most`` at a time; they leave in batches of at most ``sent``."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        for start in range(0, len(batch), most):
            held.append(batch.slice(start, most))
            count += len(held[-1])
            if count > most:
                sums = summed(held)
                held, count = sums.combine_chunks().to_batches(), len(sums)
                if count > most // 2:
                    yield from sums.to_batches(max_chunksize=sent)
                    held, count = [], 0
    if held:
        yield from summed(held).to_batches(max_chunksize=sent)


def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's sums, a blob for each bucket: Spark exchanges a few long values, not a row for every phrase."""
    for sums in folded(batches, sent=KEPT):
        # neighbours begin alike, which compresses well
        sums = sums.take(pc.sort_indices(sums, sort_keys=[("bucket", "ascending"), ("lang", "ascending"), ("phrase", "ascending")]))
        bucket = np.asarray(sums["bucket"])
        cuts = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1))
        sums = sums.select(SPELLED.names)
        blobs = [squeezed(sums.slice(a, b - a).serialize().to_pybytes()) for a, b in zip(cuts[:-1], cuts[1:])]
        yield pa.RecordBatch.from_arrays([pa.array(bucket[cuts[:-1]], pa.int32()), pa.array(blobs, pa.binary())], names=["bucket", "blob"])


def added(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Phrases with ``least`` occurrences or more in the blobs of whole buckets; what is held grows with the different phrases alone."""
    held: list[pa.RecordBatch] = []
    count, most = 0, KEPT
    for batch in batches:
        for blob in batch["blob"]:
            held.append(pa.ipc.read_record_batch(opened(blob.as_py()), SPELLED))
            count += len(held[-1])
            if count > most:
                held = summed(held).combine_chunks().to_batches()
                count = sum(map(len, held))
                most = max(KEPT, 2 * count)
    if held:
        sums = summed(held)
        often = sums.filter(pc.greater_equal(sums["c"], least)).rename_columns(["lang", "len", "phrase", "f"])
        yield from often.to_batches(max_chunksize=SENT)


def over(slices: DataFrame, buckets: int, known: list[Slots], look, schema: str, after=iter) -> tuple[DataFrame, object]:
    """``look`` at all packed slices; the sieve is sent as small as its phrases allow."""
    sent = slices.sparkSession.sparkContext.broadcast([k.folded() for k in known])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from after(piece for batch in batches for row in range(len(batch)) for piece in look(Runs(batch, row, buckets), sent.value))

    return slices.mapInArrow(run, schema), sent


def frequent_numbers(scans: list[DataFrame], rule: Mining, buckets: int) -> DataFrame:
    """``len, hash`` of the phrases whose numbers reach ``least`` in these scans. Phrases that share a number only make it more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            # number and count side by side in 64 bits, sorted in place: a bucket takes little more than its blobs
            both = np.empty(sum(map(full_size, held)) // 8, "<u8")
            end = 0
            while held:
                blob = opened(held.pop()).to_pybytes()
                part = both[end:end + len(blob) // 8]
                np.cumsum(from_planes(blob[:len(blob) // 2]), dtype="<u8", out=part)
                part <<= np.uint64(32)
                part |= from_planes(blob[len(blob) // 2:])
                end += len(part)
            both.sort()
            numbers = both.view("<u4")[1::2]
            heads = np.flatnonzero(np.append(True, numbers[1:] != numbers[:-1]))
            numbers = numbers[heads]
            both &= np.uint64(0xFFFFFFFF)
            often = np.add.reduceat(both, heads) >= rule.least
            number = numbers[often].astype(np.uint64)
            hashes = mix(number << np.uint64(32) | np.uint64(now[1])).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(hashes), now[0], np.int32)), pa.array(hashes)], names=["len", "hash"])

        now, held = None, []
        for batch in batches:
            for length, bucket, blob in zip(batch["len"].to_pylist(), batch["bucket"].to_pylist(), batch["blob"].to_pylist()):
                if (length, bucket) != now and held:
                    yield flush()
                    held = []
                now = (length, bucket)
                held.append(blob)
        if held:
            yield flush()

    tables = reduce(DataFrame.unionByName, scans).filter("len > 0").select("len", "bucket", "blob")
    return tables.repartitionById(buckets, "bucket").sortWithinPartitions("bucket", "len").mapInArrow(run, "len int, hash long")


#: Slices are read back one at a time: a page and a row group end as soon as they hold one, and none is tried as a dictionary.
SLICE_FILES = {"parquet.block.size": 8 << 20, "parquet.block.size.row.check.min": 1, "parquet.page.size.row.check.min": 1, "parquet.enable.dictionary": False}


def few_by_few(df: DataFrame, most: int) -> None:
    """Slices, megabytes long, go to Python alone, tables some at a time; whatever else travels as Arrow does so by :func:`light`."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(most))


def frequent(docs: DataFrame, rule: Mining = Mining(), lang: str = "lang", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """``lang, len, phrase, f`` of every phrase that occurs ``least`` times or more, and ``lang, n`` (word occurrences).

    Shards are scanned in a cycle. Words are counted from the first step on; a longer phrase from the step after both its parts (without
    the last, without the first word) became frequent; each for one full cycle. So lengths are counted side by side, and a phrase never
    counted has a part that is not frequent. While most phrases are still rare, they are counted by numbers in packed tables; two
    that share one only seem more frequent. At the end those left are counted by their letters. Between steps
    only the newly frequent phrases' slots reach the driver.
    """
    spark = light(docs).sparkSession
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    cut = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"), body.alias("text"))
    path = scratch_path(spark, "phrase-shards")
    packed(cut, rule).write.options(**SLICE_FILES).partitionBy("shard").parquet(path)
    slices = spark.read.schema(PACKED).parquet(path)
    buckets = max(1, -(-(slices.agg(F.sum(F.octet_length("codes"))).first()[0] or 0) // rule.share))
    known = [Slots(rule.slots) for _ in range(rule.longest)]
    reached = spark.createDataFrame([], "len int, hash long")
    scans: list[DataFrame] = []
    step, until = 0, rule.shards - 1
    while step <= until:
        shard = slices.filter(F.col("shard") == step % rule.shards).select("langs", "codes", "hashes", "tongues")
        looked, sent = over(shard, buckets, known[:-1], lambda runs, sieve, step=step: counted(runs, step, rule, sieve), SCANNED)
        few_by_few(docs, 1)
        scans.append(pinned(looked, "phrase-scan"))
        sent.destroy()
        few_by_few(docs, 64)
        new = frequent_numbers(scans[-rule.shards:], rule, buckets).join(reached, ["len", "hash"], "left_anti")
        new = pinned(new.withColumn("slot", F.col("hash").bitwiseAND(F.lit(rule.slots - 1)).cast("int")), "phrase-reached")
        light(docs)
        reached = reached.unionByName(new.drop("slot"))
        hit = new.select("len", "slot").distinct().toArrow()
        lengths, slots = np.asarray(hit["len"]), np.asarray(hit["slot"])
        for length in range(1, rule.longest + 1):
            known[length - 1].add(slots[lengths == length], step)
        if (lengths < rule.longest).any():
            until = max(until, step + rule.shards)
        step += 1
    words = reduce(DataFrame.unionByName, scans[:rule.shards]).filter("len = 0").groupBy("lang").agg(F.sum("c").alias("n"))
    looked, sent = over(slices, buckets, known, spelled, "bucket int, blob binary", by_bucket)
    few_by_few(docs, 1)
    sums = looked.repartitionById(buckets, "bucket").mapInArrow(lambda batches: added(batches, rule.least), "lang string, len int, phrase string, f long")
    sums = pinned(sums, "phrase-frequent")
    sent.destroy()
    light(docs)
    return sums, words


def collocations(docs: DataFrame, rule: Mining = Mining(), lang: str = "lang", text: str = "text") -> DataFrame:
    """The ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    A phrase of two words or more with ``a`` occurrences is cut into a first part (``l``) and the rest (``r``); its score is
    ``floor(2000000 a / (l + r))`` at the cut where that is least, the earliest of equal ones. A phrase inside a
    longer one that makes up ``cover`` percent of its occurrences goes. Order: score, ``a``, both descending, then the phrase's bytes.

    Null or empty text: no words. Null language: ``und``. Words are cut at spaces and tabs, pieces at ``.,;:!?`` and
    line ends, A to Z are lower-cased, nothing else is. Repeated rows count each. No frequent phrase, or no rows in: no rows out. Other
    columns are not read.
    """
    known, words = frequent(docs, rule, lang, text)
    big = lambda c: c.cast("decimal(20,0)")
    long = known.filter("len > 1").select("lang", "len", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    part = lambda start, size: F.array_join(F.slice("w", start, size), " ")
    cuts = long.select("lang", "phrase", "a", "w", "len", F.explode(F.sequence(F.lit(1), F.col("len") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("head"), part(F.col("k") + 1, F.col("len") - F.col("k")).alias("tail"))
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"]) \
        .join(known.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r")), ["lang", "tail"]) \
        .withColumn("score", F.expr("(cast(2000000 as decimal(18,0)) * cast(a as decimal(19,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"))
    least = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    spans = F.array(*[
        F.struct(F.lit(size).alias("size"), F.lit(start).alias("start")) for size in range(2, rule.longest) for start in range(1, rule.longest - size + 2)])
    inner = long.filter("len > 2").select("lang", "a", "w", "len", F.inline(spans)) \
        .filter("size < len and start + size - 1 <= len").select("lang", part(F.col("start"), F.col("size")).alias("phrase"), "a")
    covered = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = least.join(covered, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (100 * big(F.col("longer")) < rule.cover * big(F.col("a"))))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    ranked = left.select("lang", "phrase", "a", "cut.*").withColumn("rank", rank).filter(F.col("rank") <= rule.top)
    return ranked.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
