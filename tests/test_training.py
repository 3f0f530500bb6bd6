"""Training with engineered history and a voted ensemble; saved scorers give equal rows."""

import pytest
from pyspark.sql import functions as F

from winnow.config import TrainConfig
from winnow.plans import jobs
from winnow.plans.scoring import Scorer
from winnow.roles import ColumnRoles


def test_engineered_ensemble_is_saved_whole(spark, tmp_path):
    rows = [(k, f"acc{k % 37}", f"2024-{k % 12 + 1:02d}-{k % 28 + 1:02d} 10:00:00", ["Web", "App", "Shop"][k % 3], float(k % 17), f"c{k % 5}",
             int((k % 37) % 3 == 0 or k % 11 == 0), ["train", "train", "validation", "test"][(k % 37) % 4]) for k in range(900)]
    df = spark.createDataFrame(rows, "lead_id long, account_id string, created string, source string, x double, kind string, y int, split string") \
        .withColumn("created", F.col("created").cast("timestamp_ntz"))
    roles = ColumnRoles.infer(df.drop("split"), target="y", group="account_id", time="created", source="source", ids=("lead_id",))
    trained = jobs.train_job(df, roles, TrainConfig(family="baseline_lr", engineer=True, windows=(30,), record_type="kind", ensemble=("baseline_lr", "random_forest"), select=False))
    scorer = trained.scorer
    assert scorer.engineered is not None and set(scorer.members) == {"baseline_lr", "random_forest"} and sum(scorer.weights) == pytest.approx(1)
    names = set(trained.importances.select("feature").toPandas()["feature"]) if hasattr(trained, "importances") else set()
    derived = scorer.features(df.filter("split = 'train'").drop("split"))
    assert {"cum_leads_account", "is_src_Web", "RecordType_bucketed", "account_total_leads"} <= set(derived.columns)
    test = df.filter("split = 'test'").drop("split")
    before = {r.lead_id: r for r in scorer.transform(test).collect()}
    scorer.save(str(tmp_path / "s"))
    after = {r.lead_id: r for r in Scorer.load(str(tmp_path / "s")).transform(test).collect()}
    assert len(before) == test.count() and before.keys() == after.keys()
    assert all(before[k].conversion_probability == pytest.approx(after[k].conversion_probability) for k in before)
    assert names is not None


def test_search_points_and_metrics(spark):
    from winnow.operators import models as M

    points = M.grid_points(M.GRIDS["lightgbm"], 50, 1)
    assert len({tuple(p.items()) for p in points}) == 50 and all(p[k] in M.GRIDS["lightgbm"][k] for p in points for k in p)
    assert set(M.GRIDS) == set(M.DEFAULTS) and len(M.grid_points({"C": [1, 2]}, 9, 1)) == 2
    from pyspark.ml.linalg import Vectors

    rows = spark.createDataFrame([(k, Vectors.dense([float(k % 7), float(k % 3)]), float(k % 7 > 3)) for k in range(210)], ["id", "features", "label"])
    for metric in ("average_precision", "f1"):
        best, value, fitted = M.search(rows, "ridge_lr", {"C": [0.01, 10.0]}, "id", trials=2, folds=2, metric=metric)
        assert best["C"] in (0.01, 10.0) and 0.5 < value <= 1 and fitted.family == "ridge_lr"
