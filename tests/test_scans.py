"""What stands behind a table runs once, however often the operator reads it."""

import pytest
from pyspark.sql import functions as F

from winnow.operators import features as FE
from winnow.operators.cleaning import BasicCleaner
from winnow.operators.kernels import exact_quantiles

N = 400


@pytest.fixture
def counted(spark):
    """A table and the number of rows its source has given out."""
    seen = spark.sparkContext.accumulator(0)

    def passed(frames):
        for f in frames:
            seen.add(len(f))
            yield f

    rows = spark.createDataFrame([(k, float(k * 7 % 101), None if k % 9 == 0 else float(k % 13)) for k in range(N)], "id long, a double, b double")
    return rows.mapInPandas(passed, rows.schema), seen


def test_quantiles_read_their_source_once(counted):
    df, seen = counted
    cut = exact_quantiles(df, ["a", "b"], (0.25, 0.5), task_rows=50)
    assert seen.value == N and cut == exact_quantiles(df, ["a", "b"], (0.25, 0.5))


def test_robust_scale_reads_train_once(counted):
    df, seen = counted
    model = FE.fit_robust_scale(df, ("a", "b"))
    assert seen.value == N and model.center["b"] == 6.0


def test_cleaner_reads_train_once(counted):
    df, seen = counted
    model = BasicCleaner(outlier_method="winsorize").fit(df.select("a", "b"))
    assert seen.value == N and set(model.bounds) == {"a", "b"}


def test_correlations_read_their_source_once(counted):
    from winnow.operators import stat_tests as ST

    df, seen = counted
    tau = ST.kendall(df, ("a", "b")).first()["r"]
    assert seen.value == N
    rho = ST.spearman(df, ("a", "b"), "id").first()["r"]
    assert seen.value == 2 * N
    pdf = df.select("a", "b").toPandas()
    assert rho == pytest.approx(pdf.dropna().rank().corr()["a"]["b"], abs=1e-9) and -1 < tau < 1


def test_spearman_cut_joins_and_empty_columns(spark):
    from winnow.operators import stat_tests as ST

    rows = [(k, float(k * 31 % 97), None if k % 5 == 0 else float(k * 17 % 53), None) for k in range(300)]
    df = spark.createDataFrame(rows, "id long, a double, b double, none double")
    got = {(r["feature_a"], r["feature_b"]): r["r"] for r in ST.spearman(df, ("a", "b", "none"), "id", task_rows=40).collect()}
    pdf = df.select("a", "b").toPandas().dropna().rank()
    assert got["a", "b"] == pytest.approx(pdf.corr()["a"]["b"], abs=1e-9) and got["a", "none"] is None and got["b", "none"] is None


def test_isotonic_fit_reads_its_rows_once(counted):
    from winnow.operators.calibration import fit_isotonic

    df, seen = counted
    fit_isotonic(df.select((F.col("a") / 100).alias("s"), (F.col("a") % 2).cast("int").alias("y")), "s", "y")
    assert seen.value == N


def test_duplicates_by_hashed_cells_tell_signed_zeros_and_order(spark):
    from winnow.operators.selection import duplicate_columns

    rows = [(0.0, -0.0, 0.0, 1, 2, None, float("nan")), (1.0, 1.0, 1.0, 2, 1, 3.0, float("nan")), (None, None, None, 3, 3, 4.0, 1.0)]
    df = spark.createDataFrame(rows, "a double, z double, b double, i int, j int, n double, m double")
    assert {(r["feature"], r["kept"]) for r in duplicate_columns(df, df.columns).collect()} == {("b", "a")}
    plan = duplicate_columns(df.select("a", "i"), ["a", "i"])
    assert plan.columns == ["feature", "kept"] and plan.count() == 0


def test_selector_takes_stored_rows_as_they_are(spark, monkeypatch):
    from winnow.operators import kernels
    from winnow.operators.selection import SmartFeatureSelector
    from winnow.roles import ColumnRoles

    written = []
    monkeypatch.setattr(kernels, "stored", lambda df, label: written.append(label) or df)
    df = spark.range(60).select(F.col("id").alias("lead"), (F.col("id") % 2).cast("int").alias("y"), (F.col("id") % 7).cast("double").alias("a"), F.rand(3).alias("b"))
    SmartFeatureSelector(target_correlation_min=0.0).fit(df, ColumnRoles(target="y", group=None, time=None, source=None, ids=("lead",)), keep_cached=True)
    assert written == []
