"""Token-id files with a minimal perfect hash index.

A shard file holds raw little-endian ids (16 or 32 bits) of documents in ascending key order, between a 16-byte head
and a directory of keys and lengths. Index files, chosen by key hash, hold a minimal perfect hash from keys to
slots; a slot stores a key fingerprint, the shard, the token offset and the length, so a lookup costs a fixed number of
reads. Files appear under their final names by a rename of a finished copy, so a task that is repeated writes the same again.
"""

from __future__ import annotations

import io
import json
import re
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winnow.llm.tables import light, partitions, pinned, range_bucket
from winnow.llm.tokens import crc32, encoder, with_end
from winnow.llm.words import mix, text_slices

MAGIC, INDEX_MAGIC = b"WNTOKEN1", b"WNINDEX1"
GAMMA, LEVELS = 2.0, 48
#: Bytes of ids read or written at once.
CHUNK = 8 << 20


def place(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder or address, and the path on it."""
    folder = re.sub(r"^file:/+", "file:///", folder)
    return (pafs.LocalFileSystem(), folder) if folder.startswith("/") else pafs.FileSystem.from_uri(folder)


# --- minimal perfect hash -------------------------------------------------------------------------


class PerfectHash:
    """Bit arrays by level: a key that is alone at its bit is placed there, the others go on to the next level.

    The slot of a key is the number of bits set before its own. Keys left after ``LEVELS`` levels are kept sorted.
    """

    def __init__(self, levels: list[np.ndarray], rest: np.ndarray):
        self.levels, self.rest = levels, rest
        self.sizes = [len(b) for b in levels]
        self.ranks = [np.concatenate([[0], np.cumsum(b)]).astype(np.int64) for b in levels]
        self.bases = np.concatenate([[0], np.cumsum([r[-1] for r in self.ranks])]).astype(np.int64)

    @staticmethod
    def _spot(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys + np.uint64((level * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, left = [], keys
        while len(left) and len(levels) < LEVELS:
            size = max(64, int(len(left) * GAMMA))
            spot = cls._spot(left, len(levels), size)
            once = np.bincount(spot, minlength=size) == 1
            levels.append(once)
            left = left[~once[spot]]
        return cls(levels, np.sort(left))

    def slot(self, keys: np.ndarray) -> np.ndarray:
        """Slots of the keys; any slot, or -1, for keys that were not built in."""
        out = np.full(len(keys), -1, np.int64)
        live = np.arange(len(keys))
        for level, (bits, rank, base) in enumerate(zip(self.levels, self.ranks, self.bases)):
            spot = self._spot(keys[live], level, len(bits))
            hit = bits[spot]
            out[live[hit]] = base + rank[spot[hit]]
            live = live[~hit]
            if not len(live):
                return out
        if len(self.rest):
            at = np.minimum(np.searchsorted(self.rest, keys[live]), len(self.rest) - 1)
            found = self.rest[at] == keys[live]
            out[live[found]] = self.bases[-1] + at[found]
        return out

    def dump(self, out) -> None:
        out.write(struct.pack("<II", len(self.levels), len(self.rest)))
        for bits in self.levels:
            out.write(struct.pack("<Q", len(bits)))
            out.write(np.packbits(bits).tobytes())
        out.write(self.rest.astype("<u8").tobytes())

    @classmethod
    def load(cls, raw: io.BytesIO) -> PerfectHash:
        count, rest = struct.unpack("<II", raw.read(8))
        levels = []
        for _ in range(count):
            (size,) = struct.unpack("<Q", raw.read(8))
            levels.append(np.unpackbits(np.frombuffer(raw.read(-(-size // 8)), np.uint8), count=size).astype(bool))
        return cls(levels, np.frombuffer(raw.read(8 * rest), "<u8"))


def key_hash(keys: np.ndarray) -> np.ndarray:
    """One to one on 64-bit keys, so no two keys share a hash."""
    return mix(keys.astype(np.int64).view(np.uint64))


def fingerprint(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)) >> np.uint64(32)).astype(np.uint32)


SLOT = np.dtype([("fingerprint", "<u4"), ("shard", "<u4"), ("position", "<u8"), ("offset", "<u8"), ("length", "<u8"), ("rows", "<u8")])


# --- writing --------------------------------------------------------------------------------------


class Shard:
    """One shard file while it is written."""

    def __init__(self, folder: str, number: int, width: int):
        self.fs, base = place(folder)
        self.final = f"{base}/shard-{number:06d}.bin"
        self.draft = f"{self.final}.{uuid.uuid4().hex}"
        self.number, self.kind = number, f"<u{width}"
        self.out = self.fs.open_output_stream(self.draft)
        self.out.write(MAGIC + struct.pack("<II", width, 0))
        self.keys: list[np.ndarray] = []
        self.nulls: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []
        self.docs = self.tokens = 0

    def add(self, keys: np.ndarray, nulls: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> dict:
        self.out.write(ids.astype(self.kind).tobytes())
        rows = {"shard": np.full(len(sizes), self.number), "position": self.docs + np.arange(len(sizes)),
                "offset": self.tokens + np.cumsum(sizes) - sizes, "length": sizes}
        self.docs, self.tokens = self.docs + len(sizes), self.tokens + int(sizes.sum())
        self.keys.append(keys)
        self.nulls.append(nulls)
        self.sizes.append(sizes)
        return rows

    def close(self) -> None:
        self.out.write(np.concatenate(self.keys).astype("<i8").tobytes())
        self.out.write(np.concatenate(self.nulls).astype("u1").tobytes())
        self.out.write(np.concatenate(self.sizes).astype("<u8").tobytes())
        self.out.write(struct.pack("<QQ", self.docs, self.tokens))
        self.out.close()
        self.fs.move(self.draft, self.final)


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1, id: str = "doc_id", text: str = "text",
          shards: int | None = None) -> dict:
    """Write shards, index and manifest below ``folder`` (shared by all executors); returns the manifest.

    Rows are in ascending order of ``id`` (a whole number), equal ids by a hash of their text, nulls first. Null
    or empty text: the end id alone. Repeated rows are written each; their key's slot counts them and points at the first.
    An id that fills several shards is cut by the hash. No rows in: no shard and an empty index.
    Other columns are not read.
    """
    spark = light(docs).sparkSession
    shards = shards or partitions(docs)
    rows = docs.select(F.col(id).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    rows = rows.withColumn("tie", F.shiftrightunsigned(F.xxhash64("text"), 1))
    rows = rows.withColumn("bucket", range_bucket(rows, "key", F.col("tie"), shards))
    fs, base = place(folder)
    fs.create_dir(base)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        width, shard = 2 if own.size <= 1 << 16 else 4, None
        for batch in batches:
            for part, texts in text_slices(batch):
                ids, ends = with_end(*own.encode(texts), end_id)
                buckets = np.asarray(part["bucket"])
                keys = np.asarray(pa.compute.fill_null(part["key"], 0))
                nulls = np.asarray(pa.compute.is_null(part["key"]))
                cuts = np.concatenate([[0], np.flatnonzero(buckets[1:] != buckets[:-1]) + 1, [len(buckets)]])
                for a, b in zip(cuts[:-1], cuts[1:]):
                    if shard is None or shard.number != buckets[a]:
                        if shard:
                            shard.close()
                        shard = Shard(folder, int(buckets[a]), width)
                    placed = shard.add(keys[a:b], nulls[a:b], ids[ends[a]:ends[b]], np.diff(ends[a:b + 1]))
                    yield pa.RecordBatch.from_arrays([part["key"].slice(a, b - a), *(pa.array(v, pa.int64()) for v in placed.values())],
                                                     names=["key", *placed])
        if shard:
            shard.close()

    ordered = rows.repartitionById(shards, "bucket").sortWithinPartitions("bucket", F.col("key").asc_nulls_first(), "tie")
    listed = pinned(ordered.mapInArrow(run, "key long, shard long, position long, offset long, length long"), "directory")
    sizes = {r["shard"]: (r["docs"], r["tokens"]) for r in listed.groupBy("shard").agg(F.count("*").alias("docs"), F.sum("length").alias("tokens")).collect()}
    first = F.min(F.struct("shard", "position", "offset", "length")).alias("first")
    keyed = listed.filter("key is not null").groupBy("key").agg(first, F.count("*").alias("rows"))
    parts = shards
    keyed = keyed.select("key", "first.*", "rows", F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int").alias("part"))

    def index(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = list(frames)  # 44 bytes a key, a bounded share of the keys
        for number, own in pd.concat(held, ignore_index=True).groupby("part") if held else ():
            hashes = key_hash(own["key"].to_numpy())
            table = PerfectHash.build(hashes)
            slots = np.zeros(len(own), SLOT)
            at = table.slot(hashes)
            slots["fingerprint"][at] = fingerprint(hashes)
            for c in ("shard", "position", "offset", "length", "rows"):
                slots[c][at] = own[c].to_numpy()
            target, root = place(folder)
            draft = f"{root}/index-{number:06d}.{uuid.uuid4().hex}"
            with target.open_output_stream(draft) as out:
                out.write(INDEX_MAGIC + struct.pack("<Q", len(own)))
                table.dump(out)
                out.write(slots.tobytes())
            target.move(draft, f"{root}/index-{number:06d}.mph")
            yield pd.DataFrame({"part": [number], "n": [len(own)]})

    built = pinned(keyed.repartitionById(parts, "part").mapInPandas(index, "part int, n long"), "index")
    manifest = {
        "end_id": end_id, "index_parts": parts, "keys": {str(r["part"]): r["n"] for r in built.collect()},
        "null_rows": listed.filter("key is null").count(),
        "shards": [{"shard": s, "docs": sizes[s][0], "tokens": sizes[s][1]} for s in sorted(sizes)],
    }
    with fs.open_output_stream(f"{base}/manifest.json") as out:
        out.write(json.dumps(manifest).encode())
    return manifest


# --- reading --------------------------------------------------------------------------------------


def manifest(folder: str) -> dict:
    fs, base = place(folder)
    with fs.open_input_stream(f"{base}/manifest.json") as raw:
        return json.loads(raw.read())


class Index:
    """One index file."""

    def __init__(self, folder: str, part: int):
        fs, base = place(folder)
        with fs.open_input_stream(f"{base}/index-{part:06d}.mph") as raw:
            blob = io.BytesIO(raw.read())
        if blob.read(8) != INDEX_MAGIC:
            raise ValueError("not an index file")
        (n,) = struct.unpack("<Q", blob.read(8))
        self.table = PerfectHash.load(blob)
        self.slots = np.frombuffer(blob.read(n * SLOT.itemsize), SLOT)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys are there, and their slots. A foreign key passes with a chance of 2^-32."""
        hashes = key_hash(keys)
        at = self.table.slot(hashes)
        got = self.slots[np.maximum(at, 0)]
        return (at >= 0) & (got["fingerprint"] == fingerprint(hashes)), got


def located(keys: DataFrame, folder: str, id: str = "doc_id") -> DataFrame:
    """Look up distinct keys in the index: ``key, shard, position, offset, length, rows``; absent keys give no row."""
    held = manifest(folder)
    parts, present = held["index_parts"], {int(k) for k in held["keys"]}
    asked = keys.select(F.col(id).cast("long").alias("key")).filter("key is not null").distinct()
    asked = asked.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, own = None, None
        for batch in batches:
            part, wanted = np.asarray(batch["part"]), np.asarray(batch["key"])
            for p in np.unique(part):
                if p not in present:
                    continue
                if p != number:
                    number, own = p, Index(folder, int(p))
                k = wanted[part == p]
                there, got = own.find(k)
                names = ["shard", "position", "offset", "length", "rows"]
                yield pa.RecordBatch.from_arrays([pa.array(k[there]), *(pa.array(got[c][there].astype(np.int64)) for c in names)], names=["key", *names])

    dealt = asked.repartitionById(parts, F.col("part")).sortWithinPartitions("part")
    return dealt.mapInArrow(run, "key long, shard long, position long, offset long, length long, rows long")


class ShardReader:
    """Random access to one shard file."""

    def __init__(self, folder: str, number: int):
        fs, base = place(folder)
        self.file = fs.open_input_file(f"{base}/shard-{number:06d}.bin")
        head = self.file.read_at(16, 0)
        if head[:8] != MAGIC:
            raise ValueError("not a shard file")
        (self.width,) = struct.unpack("<I", head[8:12])
        self.docs, self.tokens = struct.unpack("<QQ", self.file.read_at(16, self.file.size() - 16))

    def ids(self, offset: int, length: int) -> np.ndarray:
        return np.frombuffer(self.file.read_at(length * self.width, 16 + offset * self.width), f"<u{self.width}").astype(np.uint32)

    def lengths(self, position: int, count: int) -> np.ndarray:
        """Lengths of ``count`` rows from ``position``, from the directory."""
        start = self.file.size() - 16 - 8 * (self.docs - position)
        return np.frombuffer(self.file.read_at(8 * count, start), "<u8").astype(np.int64)

    def close(self) -> None:
        self.file.close()


def read(spark: SparkSession, keys: DataFrame, folder: str, id: str = "doc_id", keep_ids: bool = False) -> DataFrame:
    """Rows of the given keys, by the index: ``key, start, n_tokens, ids_crc32`` (and ``ids``).

    ``start`` counts the ids of all rows before. A key's repeated rows follow each other from its slot on,
    through as many shards as they fill; null keys are the first rows of the first shards.
    """
    held = manifest(folder)
    docs = {s["shard"]: s["docs"] for s in held["shards"]}
    order, start = sorted(docs), {}
    total = 0
    for s in held["shards"]:
        start[s["shard"]], total = total, total + s["tokens"]
    found = located(keys, folder, id).select("key", "shard", "position", "offset", "rows")
    nulls = held["null_rows"] and keys.filter(F.col(id).isNull()).limit(1).count()
    if nulls:
        found = found.unionByName(spark.range(1).select(
            F.lit(None).cast("long").alias("key"), F.lit(order[0]).cast("long").alias("shard"), F.lit(0).cast("long").alias("position"),
            F.lit(0).cast("long").alias("offset"), F.lit(held["null_rows"]).cast("long").alias("rows")))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A key's rows as runs, one a shard."""
        for batch in batches:
            b = batch.to_pydict()
            out = {k: [] for k in ("key", "shard", "position", "offset", "rows")}
            for key, shard, position, offset, rows in zip(*(b[k] for k in out)):
                at = order.index(shard) if rows > docs[shard] - position else None
                while rows:
                    n = min(rows, docs[shard] - position)
                    for v, k in zip((key, shard, position, offset, n), out):
                        out[k].append(v)
                    rows -= n
                    if rows:
                        at += 1
                        shard, position, offset = order[at], 0, 0
            yield pa.RecordBatch.from_pydict(out, pa.schema([(k, pa.int64()) for k in out]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, number = None, None
        for batch in batches:
            b = batch.to_pydict()
            out = {k: [] for k in ("key", "start", "n_tokens", "ids_crc32", *(["ids"] if keep_ids else []))}
            for key, shard, position, offset, rows in zip(b["key"], b["shard"], b["position"], b["offset"], b["rows"]):
                if shard != number:
                    if reader:
                        reader.close()
                    reader, number = ShardReader(folder, shard), shard
                done = 0
                while done < rows:
                    step = min(rows - done, 4096)
                    for n in reader.lengths(position + done, step):
                        ids = reader.ids(offset, int(n))
                        for v, k in zip((key, start[shard] + offset, int(n), crc32(ids), ids.astype(np.int64)), out):
                            out[k].append(v)
                        offset += int(n)
                    done += step
                if len(out["key"]) >= 2048 or keep_ids:
                    yield pa.RecordBatch.from_pydict(out, schema)
                    out = {k: [] for k in out}
            yield pa.RecordBatch.from_pydict(out, schema)
        if reader:
            reader.close()

    schema = pa.schema([("key", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
                       + ([("ids", pa.list_(pa.int64()))] if keep_ids else []))
    kinds = "key long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if keep_ids else "")
    dealt = found.mapInArrow(spread, "key long, shard long, position long, offset long, rows long")
    return dealt.repartition(max(1, len(order)), "shard").sortWithinPartitions("shard", "offset").mapInArrow(run, kinds)
