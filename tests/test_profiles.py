from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from winnow.operators import profiles as P


@pytest.fixture(scope="module")
def events(spark):
    rng = np.random.default_rng(2)
    n = 20_000
    day = rng.integers(0, 9, n)
    x = rng.lognormal(3, 1 + 0.2 * (day % 3))
    rows = [(datetime(2024, 3, 1) + timedelta(days=int(d), hours=5), None if i % 11 == 0 else float(v), float("nan") if i % 13 == 0 else 1e9 + float(v), f"k{int(v * 50)}")
            for i, (d, v) in enumerate(zip(day, x))]
    return spark.createDataFrame(rows, "at timestamp_ntz, x double, y double, k string").repartition(6).cache()


def test_merged_days_equal_the_whole(spark, events, tmp_path):
    path = str(tmp_path / "states")
    states = P.daily_states(events, "at", ["x", "y"], ["k"])
    P.store_states(states.filter("day < '2024-03-06'"), path)
    P.store_states(states.filter("day >= '2024-03-05'"), path)  # one day twice: it replaces itself
    got = {r["feature"]: r for r in P.merged_profile(P.stored_states(spark, path), (0.01, 0.5, 0.99)).collect()}
    local = events.toPandas()
    for c in ("x", "y"):
        want, r = local[c].dropna(), got[c]
        assert (r["rows"], r["count"], r["missing"]) == (20_000, len(want), 20_000 - len(want))
        assert r["min"] == want.min() and r["max"] == want.max()
        assert r["mean"] == pytest.approx(want.mean(), rel=1e-12) and r["std"] == pytest.approx(want.std(), rel=1e-6)
        for p, name in ((0.01, "q1"), (0.5, "q50"), (0.99, "q99")):
            assert abs((want <= r[name]).mean() - p) <= P.RANK_ERROR + 1 / len(want)
        assert abs(r["nunique"] / want.nunique() - 1) <= 2 * P.DISTINCT_ERROR
    k = got["k"]
    assert k["count"] == 20_000 and k["mean"] is None and k["q50"] is None and abs(k["nunique"] / local["k"].nunique() - 1) <= 2 * P.DISTINCT_ERROR


def test_spans_open_their_days_only(spark, events, tmp_path):
    path = str(tmp_path / "states")
    P.store_states(P.daily_states(events, "at", ["x"]), path)
    some = P.stored_states(spark, path, "2024-03-03", "2024-03-04")
    assert {r["day"] for r in some.select("day").distinct().collect()} == {date(2024, 3, 3), date(2024, 3, 4)}
    assert "PartitionFilters: [isnotnull(day" in some._jdf.queryExecution().executedPlan().toString()
    got = P.merged_profile(some).first()
    want = events.filter(F.col("at").cast("date").between("2024-03-03", "2024-03-04")).toPandas()["x"]
    assert got["rows"] == len(want) and got["mean"] == pytest.approx(want.mean())


def test_empty_and_missing_columns(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1), None, None), (None, None, "a")], "at timestamp_ntz, x double, k string")
    got = {r["feature"]: r for r in P.merged_profile(P.daily_states(df, "at", ["x"], ["k"])).collect()}
    assert (got["x"]["count"], got["x"]["mean"], got["x"]["std"], got["x"]["q50"], got["x"]["nunique"]) == (0, None, None, None, 0)
    assert (got["k"]["count"], got["k"]["missing"], got["k"]["nunique"]) == (1, 1, 1)
    assert P.merged_profile(P.daily_states(df.limit(0), "at", ["x"])).count() == 0
