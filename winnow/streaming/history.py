"""Account history of a stream: the counts of :func:`winnow.operators.features.account_history`, row by row as time passes.

A row waits in its account's state until the watermark has passed it. No earlier row can come then, so an account's rows leave in
the order of time and id, and every one sees exactly the history that a batch over all rows would show it. Accounts share states,
a slot of them each, since a call for a state costs far more than a row.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from winnow.functions.scalar import DAY_US, micros
from winnow.operators.features import _counters, valid_windows

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# a row travels as JSON that gives back its values to the microsecond
EXACT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
WAITING = pa.schema([("account", pa.string()), ("t", pa.int64()), ("id", pa.string()), ("kind", pa.int64()), ("row", pa.binary())])
#: Waiting rows in one value of the state.
CHUNK = 10_000


class AccountHistory(StatefulProcessor):
    """State of a slot of accounts: rows that wait, and for every account its rows seen so far, the last time, and the times and source
    numbers inside the widest window. Both are kept as column chunks, so that a call moves few and long values."""

    def __init__(self, counters: Sequence[tuple[str, int, str | None]], sources: Sequence[str]):
        self.counters = [(name, days, None if s is None else list(sources).index(s)) for name, days, s in counters]
        self.widest = max((days for _, days, _ in counters), default=0) * DAY_US

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "chunk binary")
        self.past = handle.getValueState("past", "accounts binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first, chunks = None, []
        for frame in rows:
            if len(frame):
                cells = [frame.iloc[:, k] for k in range(-len(WAITING), 0)]  # the columns of WAITING come last
                fresh = pa.table([pa.array(c.tolist(), f.type) for c, f in zip(cells, WAITING)], schema=WAITING)
                least = pc.min(fresh["t"]).as_py()
                first = least if first is None else min(first, least)
                chunks.append((to_bytes(fresh),))
        if chunks:
            self.waiting.appendList(chunks)
            self._wake(first)
        yield from ()

    def _wake(self, t: int) -> None:
        self.handle.registerTimer(-(-t // 1000))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        if not self.waiting.exists():
            return
        held = pa.concat_tables([from_bytes(chunk) for chunk, in self.waiting.get()])
        early = np.asarray(held["t"]) <= passed
        if not early.any():
            return
        rest = held.filter(pa.array(~early))
        if len(rest):
            self.waiting.put([(to_bytes(rest.slice(at, CHUNK)),) for at in range(0, len(rest), CHUNK)])
            self._wake(pc.min(rest["t"]).as_py())
        else:
            self.waiting.clear()
        yield self._emitted(held.filter(pa.array(early)))

    def _emitted(self, ready: pa.Table) -> pd.DataFrame:
        names, ids, t, kinds = ready["account"].to_pylist(), ready["id"].to_pylist(), np.asarray(ready["t"]), np.asarray(ready["kind"])
        order = np.array(sorted(range(len(names)), key=lambda i: (names[i], t[i], ids[i])))
        names, t, kinds = [names[i] for i in order], t[order], kinds[order]
        cuts = [0, *[i for i in range(1, len(names)) if names[i] != names[i - 1]], len(names)]
        past = past_of(from_bytes(self.past.get()[0])) if self.past.exists() else {}
        out = {"cum_leads_account": [], "days_since_prev_lead": [], **{c[0]: [] for c in self.counters}}
        none = np.zeros(0, np.int64)
        for a, b in zip(cuts[:-1], cuts[1:]):
            seen, last, times, sources = past.get(names[a], (0, None, none, none))
            now = t[a:b]
            times, sources = np.concatenate([times, now]), np.concatenate([sources, kinds[a:b]])
            out["cum_leads_account"].append(seen + np.arange(b - a))
            since = np.diff(now, prepend=now[0] if last is None else last) // DAY_US
            if last is None:
                since[0] = -1
            out["days_since_prev_lead"].append(since)
            end = np.searchsorted(times, now)
            for name, days, wanted in self.counters:
                start = np.searchsorted(times, now - days * DAY_US)
                if wanted is None:
                    out[name].append(end - start)
                else:
                    upto = np.concatenate([[0], np.cumsum(sources == wanted)])
                    out[name].append(upto[end] - upto[start])
            keep = np.searchsorted(times, now[-1] - self.widest)  # no later row looks further back
            past[names[a]] = (seen + b - a, int(now[-1]), times[keep:], sources[keep:])
        self.past.update((to_bytes(past_table(past)),))
        return pd.DataFrame({"row": ready["row"].take(pa.array(order)).to_pylist(), **{n: np.concatenate(v) for n, v in out.items()}})

    def close(self) -> None:
        pass


def to_bytes(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def from_bytes(chunk: bytes) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(bytes(chunk))).read_all()


def past_table(past: dict[str, tuple]) -> pa.Table:
    """One row an account: its name, rows seen, last time, and the times and source numbers that are kept."""
    ends = pa.array(np.concatenate([[0], np.cumsum([len(p[2]) for p in past.values()])]), pa.int32())
    lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate([p[k] for p in past.values()]), pa.int64())) for k in (2, 3)]
    return pa.table([pa.array(list(past), pa.string()), *[pa.array([p[k] for p in past.values()], pa.int64()) for k in (0, 1)], *lists],
                    names=["account", "seen", "last", "times", "kinds"])


def past_of(table: pa.Table) -> dict[str, tuple]:
    whole = table.combine_chunks()
    times, kinds = (whole[c].chunk(0) for c in ("times", "kinds"))
    ends, t, k = np.asarray(times.offsets), np.asarray(times.values), np.asarray(kinds.values)
    return {name: (seen, last, t[a:b], k[a:b]) for name, seen, last, a, b in zip(
        whole["account"].to_pylist(), whole["seen"].to_pylist(), whole["last"].to_pylist(), ends[:-1], ends[1:])}


def stream_history(rows: DataFrame, account: str, time: str, row_id: str, windows: Sequence[int] = (), source: str | None = None,
                   sources: Sequence[str] = (), delay: str = "0 seconds", slots: int = 2048) -> DataFrame:
    """``rows`` (a stream) with the columns that ``account_history`` adds to a batch.

    A row leaves when the watermark, the latest time seen less ``delay``, has reached it; rows that come later than that are late and
    are dropped. Rows without account or time have no history and leave at once. Ties of time go by the id's text. Accounts are
    dealt to ``slots`` states by hash; a state holds its accounts' waiting rows and times within the widest window. More slots make
    states smaller; the number is part of a checkpoint and cannot change on restart.
    """
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    counters = _counters(valid_windows(windows), sources)
    features = {"cum_leads_account": "int", "days_since_prev_lead": "int", **{name: "bigint" for name, *_ in counters}}
    at, owner = F.col(f"`{time}`"), F.col(f"`{account}`")
    kind = F.lit(-1)
    for k, s in enumerate(sources if source else ()):
        kind = F.when(F.col(f"`{source}`") == s, k).otherwise(kind)
    packed = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns]), {**EXACT, "ignoreNullFields": "false"}).cast("binary")
    timed = rows.filter(owner.isNotNull() & at.isNotNull()).select(
        F.pmod(F.xxhash64(owner.cast("string")), F.lit(slots)).cast("int").alias("_slot"), at.cast("timestamp").alias("_time"),
        owner.cast("string").alias("_account"), micros(at).alias("_t"),
        F.coalesce(F.col(f"`{row_id}`").cast("string"), F.lit("")).alias("_id"), kind.alias("_kind"), packed.alias("_row"))
    schema = "row binary, " + ", ".join(f"`{n}` {t}" for n, t in features.items())
    told = timed.withWatermark("_time", delay).groupBy("_slot").transformWithStateInPandas(
        AccountHistory(counters, sources), schema, outputMode="Append", timeMode="EventTime")
    parsed = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema])
    out = told.select(F.from_json(F.col("row").cast("string"), parsed, EXACT).alias("r"), *[f"`{n}`" for n in features]).select("r.*", *[f"`{n}`" for n in features])
    none = rows.filter(owner.isNull() | at.isNull()).select("*", *[
        F.lit(-1 if n == "days_since_prev_lead" else 0).cast(t).alias(n) for n, t in features.items()])
    return out.unionByName(none)
