from datetime import datetime, timedelta

import numpy as np
from pyspark.sql import functions as F

from winnow.operators.features import account_history
from winnow.streaming.history import stream_history
from winnow.streaming.scoring import read_record_stream

SCHEMA = "lead string, acc int, at timestamp_ntz, src string, price double, note string"


def rows_of(seed, n=240):
    rng = np.random.default_rng(seed)
    days = np.sort(rng.integers(0, 400, n))
    out = []
    for i, d in enumerate(days):
        at = datetime(2024, 1, 1) + timedelta(days=int(d), microseconds=int(rng.choice([0, 1, 5_000_001])))
        acc = None if rng.random() < 0.05 else int(rng.choice([1, 1, 1, 2, 3, 4, 5]))
        out.append((f"L{rng.integers(0, 10**6)}-{i}", acc, at, str(rng.choice(["Web", "App", "Else"])), float(rng.normal()), None if i % 7 else "ü, \"q\""))
    return out


def test_stream_equals_batch_over_batches_and_a_restart(spark, tmp_path):
    rows = rows_of(1)
    last = max(r[2] for r in rows)
    closing = [("end", 99, last + timedelta(days=10), "Web", 0.0, None)]  # moves the watermark past every row
    parts = [rows[:70], rows[70:71], rows[71:160], rows[160:] + closing]
    folder, state = str(tmp_path / "in"), str(tmp_path / "state")

    def put(part, k):
        shuffled = spark.createDataFrame(part, SCHEMA).orderBy(F.xxhash64("lead")).coalesce(1)
        shuffled.write.mode("append").parquet(folder)

    def drain():
        stream = stream_history(read_record_stream(spark, folder, SCHEMA, "parquet", files_per_batch=1), "acc", "at", "lead", (30, 90), "src", ("Web", "App"), delay="2 days")
        query = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", state).trigger(availableNow=True).start()
        query.awaitTermination()

    for k, part in enumerate(parts[:2]):
        put(part, k)
    drain()
    early = spark.read.parquet(str(tmp_path / "out")).count()
    for k, part in enumerate(parts[2:]):
        put(part, k)
    drain()
    got = spark.read.parquet(str(tmp_path / "out")).filter("lead <> 'end'")
    want = account_history(spark.createDataFrame(rows, SCHEMA), "acc", "at", "lead", (30, 90), "src", ("Web", "App"))
    columns = sorted(want.columns)
    assert {f.name: f.dataType for f in got.schema} == {f.name: f.dataType for f in want.schema}
    key = lambda r: tuple(str(v) for v in r)
    assert 0 < early < len(rows)
    a, b = (sorted(map(key, d.select(columns).collect())) for d in (got, want))
    assert [x for x in zip(a, b) if x[0] != x[1]][:3] == [] and len(a) == len(b)


def test_late_rows_are_dropped_and_waiting_rows_stay(spark, tmp_path):
    at = lambda d: datetime(2024, 1, 1) + timedelta(days=d)
    row = lambda name, d, acc=1: (name, acc, at(d), "Web", 0.0, None)
    folder = str(tmp_path / "in")
    for part in ([row("a", 0), row("b", 20)], [row("late", 5), row("c", 19), row("d", 40)], [row("none", 0, None), row("e", 41)]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        stream = stream_history(read_record_stream(spark, folder, SCHEMA, "parquet", files_per_batch=1), "acc", "at", "lead", (30,), delay="3 days")
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "s")).trigger(availableNow=True).start().awaitTermination()
    got = {r["lead"]: (r["cum_leads_account"], r["days_since_prev_lead"], r["lead_cnt_L1M"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {"a": (0, -1, 0), "c": (1, 19, 1), "b": (2, 1, 2), "none": (0, -1, 0)}


def test_engineered_features_on_a_stream_equal_the_batch(spark, tmp_path):
    from winnow.operators.features import FeatureEngineer

    rows = rows_of(4, 80)
    batch = spark.createDataFrame(rows, SCHEMA)
    model = FeatureEngineer("at", "acc", "src", "lead", windows=(30,), late="2 days").fit(batch)
    folder = str(tmp_path / "in")
    end = ("end", 99, max(r[2] for r in rows) + timedelta(days=10), "Web", 0.0, None)
    spark.createDataFrame([*rows, end], SCHEMA).write.parquet(folder)
    scored = model.transform(read_record_stream(spark, folder, SCHEMA, "parquet"))
    scored.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "s")).trigger(availableNow=True).start().awaitTermination()
    got, want = spark.read.parquet(str(tmp_path / "out")).filter("lead <> 'end'"), model.transform(batch)
    columns = sorted(want.columns)
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(got.columns) == columns
    assert sorted(map(key, got.select(columns).collect())) == sorted(map(key, want.select(columns).collect()))


def test_accounts_share_states(spark, tmp_path):
    rows = rows_of(7, 120)
    end = ("end", 99, max(r[2] for r in rows) + timedelta(days=10), "Web", 0.0, None)
    folder = str(tmp_path / "in")
    for part in (rows[:50], [*rows[50:], end]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    stream = stream_history(read_record_stream(spark, folder, SCHEMA, "parquet", files_per_batch=1), "acc", "at", "lead", (30, 90), "src", ("Web",), "1 day", slots=2)
    query = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "s")).trigger(availableNow=True).start()
    query.awaitTermination()
    # two states of waiting rows, two of the past, and their timers at most, for six accounts
    assert max(o["numRowsTotal"] for p in query.recentProgress for o in p["stateOperators"]) <= 10
    got, want = spark.read.parquet(str(tmp_path / "out")).filter("lead <> 'end'"), account_history(spark.createDataFrame(rows, SCHEMA), "acc", "at", "lead", (30, 90), "src", ("Web",))
    key = lambda r: tuple(str(v) for v in r)
    columns = sorted(want.columns)
    assert sorted(map(key, got.select(columns).collect())) == sorted(map(key, want.select(columns).collect()))
