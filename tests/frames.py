"""Seeded frames for the property tests."""

from __future__ import annotations

import numpy as np
import pandas as pd


def pipeline_leads(n: int = 1000, seed: int = 42) -> pd.DataFrame:
    """Three periods with disjoint accounts; conversion depends on category and source."""
    rng = np.random.default_rng(seed)
    part = np.repeat([0, 1, 2], [n // 2, 3 * n // 10, n - n // 2 - 3 * n // 10])
    months = {0: [12023, 22023, 72023], 1: [82023, 102023, 122023], 2: [12024, 22024, 32024]}
    accounts = {0: (1, 41), 1: (41, 71), 2: (71, 101)}
    ym = np.array([rng.choice(months[p]) for p in part])
    acc = np.array([rng.integers(*accounts[p]) for p in part])
    cat = rng.choice(list("ABC"), n)
    rate = pd.Series(cat).map({"A": 0.1, "B": 0.3, "C": 0.6}).to_numpy() + (acc % 10) * 0.01
    created = [
        pd.Timestamp(year=int(str(v)[-4:]), month=int(str(v)[:-4]), day=int(rng.integers(1, 28))) for v in ym
    ]
    return pd.DataFrame({
        "YearMonth": ym, "account_Id": acc, "LeadId": np.arange(n), "num_feature1": rng.normal(size=n),
        "num_feature2": rng.normal(5, 2, n), "num_feature3": rng.normal(-2, 3, n), "cat_feature1": cat,
        "cat_feature2": rng.choice(list("XYZ"), n),
        "Source_Final__c": rng.choice(["Web", "App", "Ecommerce", "Social Media"], n),
        "Target_IsConverted": (rng.random(n) < rate).astype(int), "LeadCreatedDate": created,
    })


def to_spark(spark, pdf: pd.DataFrame):
    """NaN to NULL; timestamps without a zone."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(pdf)
    return df.select(*[
        F.nanvl(F.col(f"`{f.name}`"), F.lit(None).cast("double")).alias(f.name) if f.dataType.typeName() == "double"
        else (F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name) if f.dataType.typeName() == "timestamp" else F.col(f"`{f.name}`"))
        for f in df.schema
    ])
