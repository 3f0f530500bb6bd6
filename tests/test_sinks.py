"""Sinks, small helpers of the jobs, and the run of every step."""

from frames import pipeline_leads, to_spark
from pyspark.sql import functions as F

from winnow.config import ImportanceConfig, SplitConfig, TestConfig, TrainConfig
from winnow.operators import importance as I
from winnow.operators import selection as FS
from winnow.plans import jobs
from winnow.roles import ColumnRoles
from winnow.sources import files

ROLES = ColumnRoles(
    target="Target_IsConverted", group="account_Id", time="LeadCreatedDate", source="Source_Final__c", ids=("LeadId",)
)


def test_cached_table_keeps_types_and_prunes(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.5, "a"), (2, None, None)], "id long, x double, s string")
    again = files.cache_parquet(df, str(tmp_path / "c"))
    assert again.schema == df.schema and sorted(map(tuple, again.collect())) == sorted(map(tuple, df.collect()))
    plan = again.filter("id = 1").select("x")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), EqualTo(id,1)]" in plan and "ReadSchema: struct<id:bigint,x:double>" in plan
    assert files.cache_parquet(df.limit(1), str(tmp_path / "c")).count() == 1


def test_predictions_are_written_as_csv_and_json(spark, tmp_path):
    df = spark.createDataFrame([("L1", 0.25, "Low"), ("L2", 0.9, "High")], "lead_id string, conversion_probability double, segment string")
    files.write_predictions(df, str(tmp_path / "p"))
    csv = spark.read.option("header", True).csv(str(tmp_path / "p/csv"))
    assert csv.columns == df.columns and {tuple(r) for r in csv.collect()} == {("L1", "0.25", "Low"), ("L2", "0.9", "High")}
    assert {(r["lead_id"], r["conversion_probability"]) for r in spark.read.json(str(tmp_path / "p/json")).collect()} == {("L1", 0.25), ("L2", 0.9)}


def test_report_tables_have_a_folder_each(spark, tmp_path):
    files.write_tables({"a": spark.range(3), "b": spark.range(2).withColumn("t", F.lit("x"))}, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t/a")).count() == 3 and spark.read.parquet(str(tmp_path / "t/b")).columns == ["id", "t"]
    files.write_tables({"a": spark.range(1)}, str(tmp_path / "t"), "json")
    assert spark.read.json(str(tmp_path / "t/a")).count() == 1


def test_fold_table_and_lists_by_type(spark):
    long = spark.createDataFrame([("x", 0, 1.0), ("x", 1, 3.0), ("y", 1, 2.0)], "feature string, fold int, importance double")
    got = {r["feature"]: tuple(r)[1:] for r in I.fold_table(long, 3).collect()}
    assert got == {"x": (1.0, 3.0, None), "y": (None, 2.0, None)}
    df = spark.createDataFrame([(1.0, "a", 2)], "n double, c string, m int")
    ranked = spark.createDataFrame([("c", 0.5), ("n", 0.5), ("m", 0.1)], "feature string, importance double")
    assert FS.split_by_type(ranked, df, 2) == {"num_cols": ["n"], "cat_cols": ["c"]}
    assert FS.split_by_type(ranked, df, 9) == {"num_cols": ["n", "m"], "cat_cols": ["c"]}


def test_every_step_runs_and_steps_can_be_left_out(spark, tmp_path):
    df = to_spark(spark, pipeline_leads(400))
    common = dict(
        split=SplitConfig("2023-07-31", "2023-12-31", "2024-12-31"), tests=TestConfig(kinds=("chi_square",)),
        importance=ImportanceConfig(methods=("attribution",), folds=2, family="baseline_lr", params={"max_iter": 5}),
        train=TrainConfig(family="baseline_lr", params={"max_iter": 5}, search_trials=4))
    out = jobs.run_all(df, ROLES, path=str(tmp_path / "split"), **common)
    assert {"data", "report", "statistics", "tests", "importance", "selection", "training", "evaluation"} <= set(out)
    assert files.read_split(spark, str(tmp_path / "split"), "train").count() == out["metadata"]["rows"]["train"]
    scored = out["training"].scorer.transform(df)
    assert scored.count() == 400 and scored.filter("conversion_probability between 0 and 1").count() == 400
    few = jobs.run_all(df, ROLES, skip=("statistics", "tests", "importance", "select", "train"), **common)
    assert set(few) == {"data", "cleaner", "metadata", "report"}
