"""Saved scoring artefacts and the batch scoring chain.

Every stage of the chain is row-local, or a join with a static keyed table, so the same
``Scorer.transform`` runs on a batch and on a stream.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winnow.functions.scalar import SEGMENT_EDGES, SEGMENT_LABELS, assign_segment, temporal_parts
from winnow.operators.calibration import Calibrator
from winnow.operators.cleaning import CleanerModel
from winnow.operators.evaluation import evaluate_all
from winnow.operators.features import FeatureModel, KeyedState, pairwise_ratios
from winnow.operators.models import Fitted, add_probabilities, positive_probability, vote


@dataclass
class ScoringSpec:
    """What the chain does besides its fitted parts."""

    ids: list[str]
    time: str | None = None
    account: str | None = None
    ratio_columns: list[str] = field(default_factory=list)
    edges: list[float] = field(default_factory=lambda: list(SEGMENT_EDGES))
    labels: list[str] = field(default_factory=lambda: list(SEGMENT_LABELS))


@dataclass
class Scorer:
    """``model`` ends with the classifier; cleaner, account totals, engineered features and calibrator are optional.

    With ``members`` the model holds the encoding alone and the score is the members' weighted mean. Engineered
    history is counted on the rows that are scored.
    """

    spec: ScoringSpec
    model: PipelineModel
    cleaner: CleanerModel | None = None
    totals: KeyedState | None = None
    calibrator: Calibrator | None = None
    engineered: FeatureModel | None = None
    members: dict[str, Fitted] = field(default_factory=dict)
    weights: list[float] = field(default_factory=list)

    def features(self, df: DataFrame) -> DataFrame:
        """Clean, then derive: date parts, account totals, ratios."""
        out = self.cleaner.transform(df) if self.cleaner else df
        if self.engineered:
            out = self.engineered.transform(out)
        else:
            if self.spec.time and self.spec.time in out.columns:
                out = out.select("*", *temporal_parts(F.col(self.spec.time)))
            if self.totals:
                out = self.totals.transform(out)
        if self.spec.ratio_columns:
            out = pairwise_ratios(out, self.spec.ratio_columns)
        return out

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """ids, kept columns, raw score, conversion probability and segment."""
        rows = self.model.transform(self.features(df))
        if self.members:
            rows, columns = add_probabilities(rows, self.members)
            rows = rows.withColumn("raw_score", vote(columns, self.weights))
        else:
            rows = rows.withColumn("raw_score", positive_probability(self.model.stages[-1]))
        if self.calibrator:
            rows = self.calibrator.transform(rows, "raw_score", "conversion_probability")
        else:
            rows = rows.withColumn("conversion_probability", F.col("raw_score"))
        segment = assign_segment(F.col("conversion_probability"), self.spec.edges, self.spec.labels)
        wanted = [c for c in dict.fromkeys([*self.spec.ids, *keep]) if c in rows.columns]
        return rows.select(*wanted, "raw_score", "conversion_probability", segment.alias("segment"))

    def evaluate(self, df: DataFrame, target: str) -> DataFrame:
        scored = self.transform(df, [target]).filter(F.col(target).isNotNull())
        return evaluate_all(scored, "conversion_probability", target, self.spec.ids[0], self.spec.edges, self.spec.labels)

    # ------------------------------------------------------------ persistence

    def save(self, path: str) -> None:
        """Spark ML parts and keyed state in their own formats, small state as one JSON row."""
        spark = SparkSession.getActiveSession()
        self.model.write().overwrite().save(f"{path}/model")
        if self.totals:
            self.totals.table.write.mode("overwrite").parquet(f"{path}/totals")
        if self.calibrator:
            PipelineModel([self.calibrator.model]).write().overwrite().save(f"{path}/calibrator")
        if self.engineered:
            self.engineered.save(f"{path}/engineered")
        for name, member in self.members.items():
            PipelineModel([member.model]).write().overwrite().save(f"{path}/members/{name}")
        state = {
            "engineered": self.engineered is not None,
            "members": {n: m.family for n, m in self.members.items()}, "weights": self.weights,
            "spec": asdict(self.spec),
            "cleaner": asdict(self.cleaner) if self.cleaner else None,
            "totals": [self.totals.keys, self.totals.value, self.totals.default] if self.totals else None,
            "calibrator": self.calibrator.kind if self.calibrator else None,
        }
        spark.createDataFrame([(json.dumps(state),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/state")

    @classmethod
    def load(cls, path: str) -> "Scorer":
        spark = SparkSession.getActiveSession()
        state = json.loads(spark.read.text(f"{path}/state").first()[0])
        totals = calibrator = cleaner = None
        if state["totals"]:
            keys, value, default = state["totals"]
            totals = KeyedState(keys, spark.read.parquet(f"{path}/totals"), value, default)
        if state["calibrator"]:
            calibrator = Calibrator(state["calibrator"], PipelineModel.load(f"{path}/calibrator").stages[0])
        if state["cleaner"]:
            cleaner = CleanerModel(**state["cleaner"])
        engineered = FeatureModel.load(spark, f"{path}/engineered") if state["engineered"] else None
        members = {n: Fitted(family, PipelineModel.load(f"{path}/members/{n}").stages[0]) for n, family in state["members"].items()}
        return cls(ScoringSpec(**state["spec"]), PipelineModel.load(f"{path}/model"), cleaner, totals, calibrator,
                   engineered, members, state["weights"])


def linear_scorer(weights: dict[str, float], intercept: float, extra: str = "") -> PipelineModel:
    """A fixed logistic scorer as a saved-and-loadable pipeline: adds ``conversion_probability``."""
    margin = " + ".join([f"CAST({intercept} AS DOUBLE)", *[f"CAST({w} AS DOUBLE) * {c}" for c, w in weights.items()]])
    sql = f"SELECT *, 1 / (1 + exp(-({margin}))) AS conversion_probability{extra} FROM __THIS__"
    return PipelineModel([SQLTransformer(statement=sql)])


def score_columns(df: DataFrame, model: PipelineModel, row_id: str) -> DataFrame:
    """The three output columns of the wrapped scorer."""
    scored = model.transform(df)
    return scored.select(
        F.col(row_id).alias("lead_id"), "conversion_probability", assign_segment(F.col("conversion_probability")).alias("segment")
    )
