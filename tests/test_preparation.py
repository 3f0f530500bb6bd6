"""Splits, cleaning, features: properties and leak checks."""

import numpy as np
import pandas as pd
import pytest
from frames import pipeline_leads, to_spark
from pyspark.sql import functions as F

from winnow.functions import scalar as S
from winnow.operators import features as FE
from winnow.operators import splits as SP
from winnow.operators.cleaning import BasicCleaner, _forest_steps, _unsplit_depth, hashed_rows, outlier_share
from winnow.roles import ColumnRoles, detect_date_column, measure_columns
from winnow.sources import files

ROLES = ColumnRoles(
    target="Target_IsConverted", group="account_Id", time="LeadCreatedDate", source="Source_Final__c", ids=("LeadId",)
)


@pytest.fixture(scope="module")
def leads(spark):
    return to_spark(spark, pipeline_leads()).cache()


# ---------------------------------------------------------------- sources


@pytest.mark.parametrize("sep", [",", ";"])
def test_datamart_types_and_null_literals(spark, tmp_path, sep):
    lines = ["LeadId,Score,Flag,When", "a,1.5,1,2024-01-05", "b,NULL,NULL,not a date", "NULL,x,2.0,2024-02-30"]
    (tmp_path / "d.csv").write_text("\n".join(lines).replace(",", sep))
    df = files.read_datamart(
        spark, str(tmp_path / "d.csv"), {"LeadId": "str", "Score": "float32", "Flag": "int8"}, dates=("When", "Absent")
    )
    assert dict(df.dtypes) == {"LeadId": "string", "Score": "float", "Flag": "tinyint", "When": "timestamp_ntz"}
    rows = [tuple(r) for r in df.collect()]
    assert rows[0][:3] == ("a", 1.5, 1) and str(rows[0][3]) == "2024-01-05 00:00:00"
    assert rows[1] == ("b", None, None, None)
    assert rows[2] == (None, None, 2, None)


def test_json_list_and_object(spark, tmp_path):
    (tmp_path / "list.json").write_text('[{"id": 1, "p": 0.5}, {"id": 2, "p": 0.7}]')
    (tmp_path / "one.json").write_text('{"id": 3,\n "p": 0.9}')
    got = [r["id"] for r in files.read_records(spark, str(tmp_path), "id bigint, p double", multiline=True).orderBy("id").collect()]
    assert got == [1, 2, 3]


def test_split_storage_prunes(spark, leads, tmp_path):
    files.write_split(leads.withColumn("split", F.when(F.col("LeadId") < 5, "train").otherwise("test")), str(tmp_path / "s"))
    df = files.read_split(spark, str(tmp_path / "s"), "train")
    assert df.count() == 5
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_roles(leads):
    assert detect_date_column(["a", "relative_date", "X_YearMonth", "LeadCreatedDate"]) == "LeadCreatedDate"
    assert "num_feature1" in measure_columns(leads) and "account_Id" not in measure_columns(leads)
    inferred = ColumnRoles.infer(leads, target="Target_IsConverted", ids=("LeadId",))
    assert inferred.time == "LeadCreatedDate" and "Target_IsConverted" not in inferred.numeric


# ---------------------------------------------------------------- splits


def test_time_group_split_keeps_groups_whole(leads):
    df = SP.time_group_split(leads, "LeadCreatedDate", "account_Id", "2023-07-31", "2023-12-31").cache()
    assert SP.split_overlap(df, "account_Id").count() == 0
    assert {r["split"]: r["count"] for r in df.groupBy("split").count().collect()} == {"train": 500, "validation": 300, "test": 200}


def test_null_groups_and_dates_are_dropped(spark):
    df = spark.sql("""SELECT * FROM VALUES (1, 'a', TIMESTAMP_NTZ '2024-01-01'), (2, NULL, TIMESTAMP_NTZ '2024-01-01'),
        (3, 'a', CAST(NULL AS TIMESTAMP_NTZ)), (4, 'a', TIMESTAMP_NTZ '2025-01-01') AS t(id, g, t)""")
    got = {r["id"]: r["split"] for r in SP.time_group_split(df, "t", "g", "2024-06-30", "2024-12-31").collect()}
    assert got == {1: "train", 4: "train"}
    got = {r["id"] for r in SP.time_group_split(df, "t", "g", "2024-06-30", "2024-12-31", truncate_future="2024-12-31").collect()}
    assert got == {1}


def test_force_balance_fills_test_then(leads):
    df = SP.time_group_split(leads, "LeadCreatedDate", "account_Id", "2024-12-31", "2025-12-31", force_balance=True).cache()
    sizes = {r["split"]: r["groups"] for r in SP.split_report(df, "account_Id", "Target_IsConverted", "LeadCreatedDate").collect()}
    assert sizes == {"train": 90, "validation": 9, "test": 1}
    assert SP.split_overlap(df, "account_Id").count() == 0


def test_stratified_group_split_rates(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"account_Id": np.repeat(np.arange(3000), 3)})
    pdf["y"] = (rng.random(len(pdf)) < 0.2).astype(int)
    df = SP.stratified_group_split(spark.createDataFrame(pdf), "account_Id", "y").cache()
    rates = [r[0] for r in df.groupBy("split").agg(F.avg("y")).select("avg(y)").collect()]
    assert len(rates) == 3 and max(rates) - min(rates) < 0.05
    assert SP.split_overlap(df, "account_Id").count() == 0
    share = df.filter("split = 'test'").select("account_Id").distinct().count() / 3000
    assert abs(share - 0.2) < 0.01


def test_percentage_split_with_zero_shares(leads):
    df = SP.percentage_split(leads, "LeadCreatedDate", "account_Id", test_size=0.0, val_size=0.0)
    assert [r["split"] for r in df.select("split").distinct().collect()] == ["train"]


def test_folds_are_balanced_and_whole(leads):
    df = SP.group_kfold(leads, "account_Id", "Target_IsConverted", 4)
    assert df.groupBy("account_Id").agg(F.count_distinct("fold").alias("n")).filter("n > 1").count() == 0
    rows = SP.stratified_row_kfold(leads, "LeadId", "Target_IsConverted", 5).groupBy("fold").agg(
        F.count("*").alias("n"), F.sum("Target_IsConverted").alias("y")).collect()
    assert max(r["y"] for r in rows) - min(r["y"] for r in rows) <= 1


def test_date_based_split_without_validation_end(leads):
    df = SP.date_based_split(leads, "LeadCreatedDate", "account_Id", "2023-07-31")
    assert {r["split"] for r in df.select("split").distinct().collect()} == {"train", "hold"}


# ---------------------------------------------------------------- cleaning


def test_cleaner_never_touches_target_or_keys(spark):
    n = 400
    pdf = pd.DataFrame({"LeadId": np.arange(n), "account_Id": np.arange(n) % 7, "Target_IsConverted": (np.arange(n) % 20 == 0).astype(int),
                        "x": np.r_[np.zeros(n - 1), 1e6]})
    model = BasicCleaner().fit(spark.createDataFrame(pdf), ROLES)
    out = model.transform(spark.createDataFrame(pdf)).toPandas()
    assert out["Target_IsConverted"].sum() == 20 and (out["account_Id"] == pdf["account_Id"]).all()
    assert out["x"].max() < 1e6


def test_cleaner_uses_train_statistics_only(spark, leads):
    pdf = pipeline_leads()
    pdf.loc[::10, "num_feature1"] = np.nan
    train = to_spark(spark, pdf[:500])
    model = BasicCleaner(outlier_method=None).fit(train, ROLES)
    shifted = pdf[500:].assign(num_feature1=lambda d: d["num_feature1"] + 100)
    out = model.transform(to_spark(spark, shifted)).toPandas()
    filled = out.loc[shifted["num_feature1"].isna().to_numpy(), "num_feature1"]
    assert np.allclose(filled, pdf[:500]["num_feature1"].median())


def test_integer_bounds_are_truncated(spark):
    df = spark.createDataFrame([(i, 1000 if i == 0 else i % 5) for i in range(100)], "LeadId long, c long")
    model = BasicCleaner().fit(df, ROLES)
    low, high = model.bounds["c"]
    top = model.transform(df).agg(F.max("c")).first()[0]
    assert top == int(high) and low < 0


@pytest.mark.parametrize("method", ["zscore", "iqr", "winsorize", None])
def test_all_null_column_survives(spark, method):
    df = spark.createDataFrame([(1, None, 2.0), (2, None, 3.0)], "LeadId long, a double, b double")
    out = BasicCleaner(outlier_method=method).fit(df, ROLES).transform(df).toPandas()
    assert out["a"].isna().all() and out["b"].notna().all()


def test_isolation_forest_replaces_far_values(spark):
    rng = np.random.default_rng(1)
    x = np.r_[rng.normal(size=2000), np.full(20, 50.0), np.full(20, -60.0)]
    df = spark.createDataFrame(pd.DataFrame({"LeadId": np.arange(len(x)), "x": x}))
    model = BasicCleaner(outlier_method="iforest", iforest_contamination=0.05).fit(df, ROLES)
    out = model.transform(df).toPandas()
    assert out["x"].abs().max() < 10
    share = outlier_share(df, model).first()["share"]
    assert 0.02 <= share <= 0.06
    again = BasicCleaner(outlier_method="iforest", iforest_contamination=0.05).fit(df, ROLES)
    assert again.outlier_ranges == model.outlier_ranges
    dealt_anew = BasicCleaner(outlier_method="iforest", iforest_contamination=0.05).fit(df.repartition(7, "x"), ROLES)
    assert dealt_anew.outlier_ranges == model.outlier_ranges


def test_sampled_rows_are_the_least_digests(spark):
    df = spark.range(3000).select("id", (F.col("id") % 7).cast("double").alias("x")).unionByName(
        spark.range(4000).select(F.lit(-1).cast("long").alias("id"), F.lit(100.0).alias("x")))
    got = hashed_rows(df, ["x"], 500, 3)
    plain = df.select("x", F.xxhash64(F.lit(3), F.col("id").cast("string"), F.col("x").cast("string")).alias("h")).orderBy("h").limit(500).toPandas()
    assert len(got) == 500 and got["x"].tolist() == plain["x"].tolist()
    assert len(hashed_rows(df, ["x"], 50_000, 3)) == 7000


def test_steps_equal_a_plain_forest():
    """Mean depth of every value, walked tree by tree over the same rows."""
    rng = np.random.default_rng(0)
    pool = rng.normal(size=400).round(1)
    cuts, depth = _forest_steps(pool, 4, 100, 5)
    draws = np.random.default_rng(5)

    trees = []
    for t in range(4):
        def grow(x, level):
            if level >= 7 or len(x) <= 1 or x[0] == x[-1]:
                return level + _unsplit_depth(len(x))
            cut = draws.uniform(x[0], x[-1])
            k = min(max(int((x <= cut).sum()), 1), len(x) - 1)
            return cut, grow(x[:k], level + 1), grow(x[k:], level + 1)
        trees.append(grow(np.sort(pool[t * 100:(t + 1) * 100]), 0))

    def depth_of(node, v):
        while isinstance(node, tuple):
            node = node[1] if v < node[0] else node[2]
        return node

    for v in rng.normal(size=100):
        want = np.mean([depth_of(t, v) for t in trees])
        assert depth[np.searchsorted(cuts, v, side="right")] == pytest.approx(want)


# ---------------------------------------------------------------- features


def _history(pdf, windows, sources):
    """Brute force over one account at a time."""
    rows = []
    for _, g in pdf.groupby("account"):
        g = g.sort_values(["t", "id"])
        for i, r in enumerate(g.itertuples()):
            prev = g["t"].iloc[i - 1] if i else None
            row = {"id": r.id, "cum_leads_account": i, "days_since_prev_lead": -1 if prev is None else (r.t - prev).days}
            for w in windows:
                hit = g[(g["t"] >= r.t - pd.Timedelta(days=w)) & (g["t"] < r.t)]
                row[f"lead_cnt_{FE.window_label(w)}"] = len(hit)
                for s in sources:
                    row[f"lead_cnt_{s}_{FE.window_label(w)}"] = int((hit["source"] == s).sum())
            rows.append(row)
    return pd.DataFrame(rows).set_index("id").sort_index()


@pytest.mark.parametrize("task_rows", [60, 1_000_000])
def test_account_history_with_a_hot_account(spark, task_rows):
    """One account holds a third of the rows, and a third of those one instant."""
    rng = np.random.default_rng(11)
    n = 600
    pdf = pd.DataFrame({
        "id": rng.permutation(n), "account": rng.integers(0, 30, n), "source": rng.choice(["Web", "App"], n),
        "t": pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.integers(0, 100 * 86400, n), unit="s"),
    })
    pdf.loc[: n // 3, "account"] = 99
    pdf.loc[: n // 9, "t"] = pd.Timestamp("2024-02-10 12:00:00")
    df = to_spark(spark, pdf).repartition(6)
    out = FE.account_history(df, "account", "t", "id", (1, 30), "source", ["Web", "App"], task_rows).toPandas().set_index("id").sort_index()
    want = _history(pdf, (1, 30), ["Web", "App"])
    assert len(out) == n
    for c in want.columns:
        assert (out[c] == want[c]).all(), c


def test_many_busy_accounts_and_missing_ones(spark, monkeypatch):
    """More busy accounts than a literal list may hold; rows without account stand alone."""
    monkeypatch.setattr(FE, "MAX_HOT_KEYS", 2)
    rng = np.random.default_rng(12)
    n = 300
    pdf = pd.DataFrame({"id": np.arange(n), "account": rng.integers(0, 8, n).astype(float), "source": "Web",
                        "t": pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.integers(0, 50, n), unit="D")})
    pdf.loc[:20, "account"] = np.nan
    df = to_spark(spark, pdf)
    out = FE.account_history(df, "account", "t", "id", (30,), frame_rows=30).toPandas().set_index("id").sort_index()
    known = pdf.dropna(subset=["account"])
    want = _history(known, (30,), [])
    assert len(out) == n
    assert (out.loc[want.index, list(want.columns)] == want).all().all()
    alone = out.loc[:20]
    assert (alone["cum_leads_account"] == 0).all() and (alone["days_since_prev_lead"] == -1).all() and (alone["lead_cnt_L1M"] == 0).all()


def test_window_labels_and_repair():
    assert FE.valid_windows((0, -5, 90)) == [1, 1, 90]
    assert [FE.window_label(w) for w in (30, 90, 45)] == ["L1M", "L3M", "45D"]


def test_engineer_freezes_train_state(spark, leads):
    train = leads.filter("LeadId < 500").withColumn("Channel_Final__c", F.col("cat_feature2")).withColumn("Recordtypedevelopername", F.col("cat_feature1"))
    rest = leads.filter("LeadId >= 500").withColumn("Channel_Final__c", F.lit("new")).withColumn("Recordtypedevelopername", F.col("cat_feature1"))
    spec = FE.FeatureEngineer("LeadCreatedDate", "account_Id", "Source_Final__c", "LeadId", "Channel_Final__c", "Recordtypedevelopername")
    model = spec.fit(train)
    out = model.transform(rest).toPandas()
    assert (out["account_total_leads"] == 0).all() and (out["src_chan_freq_enc"] == 0).all()
    onehot = [c for c in out.columns if c.startswith("is_src_")]
    assert (out[onehot].sum(axis=1) == 1).all() and set(out["RecordType_bucketed"]) <= {"A", "B", "C", "RARE"}
    again = model.transform(train).toPandas()
    assert again["src_chan_freq_enc"].between(0, 1).all()
    assert (again["_ym_date"].astype(str).str[:7] == again["LeadCreatedDate"].dt.strftime("%Y-%m")).all()
    for label in ("L1M", "L3M", "L6M"):
        ratio = [c for c in again.columns if c.startswith("ratio_") and c.endswith(label)]
        total = again[ratio].sum(axis=1)
        assert np.allclose(total[again[f"lead_cnt_{label}"] > 0], 1) and np.allclose(total[again[f"lead_cnt_{label}"] == 0], 0)


def test_encoders_treat_unseen_levels(spark):
    train = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("a", 3.0)], "c string, x double")
    new = spark.createDataFrame([("zz", None), (None, 5.0)], "c string, x double")
    out = FE.onehot(new, "c", FE.levels(train, "c")).toPandas()
    assert (out[["c_a", "c_b"]].sum(axis=1) == 0).all()
    vec = FE.vector_encoder(["x"], ["c"]).fit(train).transform(new).select("features").toPandas()["features"]
    assert list(vec[0].toArray()) == [0.0, 0.0, 0.0] and list(vec[1].toArray())[1:] == [0.0, 0.0] and vec[1][0] > 0
    te = FE.fit_target_encoding(train.withColumn("y", F.lit(1)), "c", "y").transform(new).toPandas()
    assert np.allclose(te["c_te"], 1.0)


def test_ratios_and_products(spark):
    df = spark.createDataFrame([(1.0, 0.0, None), (4.0, 2.0, 1.0)], "a double, b double, c double")
    out = FE.pairwise_ratios(df, ["a", "b", "c"]).toPandas()
    assert list(out["a_DIV_b"].round(4)) == [1e6, 2.0] and list(out["a_DIV_c"].round(4)) == [0.0, 4.0]
    assert list(FE.pairwise_ratios(df, ["a", "b"], epsilon=1e-5, limit=None, shift=False).toPandas()["a_DIV_b"].round(3)) == [1e5, 2.0]
    assert list(FE.pairwise_products(df, ["a", "b", "c"]).toPandas()["a_X_c"]) == [0.0, 4.0]
    assert len(FE.ratio_pairs([str(i) for i in range(30)])) == 15


def test_scalar_edges(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 0.1, 0.25, 0.3, 0.75, 0.8, 1.0, None)], "p double")
    rows = df.select(S.assign_segment(F.col("p")), S.cut_right_closed(F.col("p"))).collect()
    assert [r[0] for r in rows] == ["Low", "Low", "Medium", "Medium", "High", "High", "High", None]
    assert [r[1] for r in rows] == [None, "Low", "Low", "Medium", "Medium", "High", "High", None]
    with pytest.raises(ValueError):
        S.assign_segment(F.col("p"), (0.0, 0.5, 1.0))


def test_yearmonth_and_names(spark):
    df = spark.createDataFrame([("52024", ' a "b" '), ("122023", "__"), ("132023", "x{y}"), ("abc", "ok")], "ym string, n string")
    rows = df.select(S.parse_yearmonth(F.col("ym")).cast("string"), S.clean_name(F.col("n"))).collect()
    assert [r[0] for r in rows] == ["2024-05-01", "2023-12-01", None, None]
    assert [r[1] for r in rows] == ["a_b", "feature", "x_y", "ok"]
