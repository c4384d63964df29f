"""Fraud model: MLlib gradient-boosted trees, run registry, champion gate.

Training reads the fact's feature columns and label as a DataFrame; nothing
is collected.  Runs are recorded as rows of a JSON table (params and metrics),
the champion is a row of an alias table naming a run; the model itself is a
saved ``PipelineModel``.
"""
from __future__ import annotations

import json
import uuid

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from . import metrics
from .features import FEATURES

# Model hyper-parameters (trees, depth, learning rate, row and
# column sampling) and the promotion margin.
GBT_PARAMS = {"maxIter": 400, "maxDepth": 6, "stepSize": 0.05, "subsamplingRate": 0.9,
              "featureSubsetStrategy": "0.8"}
PROMOTION_MARGIN = 0.01


def build_pipeline(label_col: str = "label", weight_col: str | None = "weight", **params) -> Pipeline:
    p = dict(GBT_PARAMS)
    p.update(params)
    gbt = GBTClassifier(featuresCol="features", labelCol=label_col, seed=42, **p)
    if weight_col:
        gbt = gbt.setWeightCol(weight_col)
    return Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="keep"), gbt])


def prepare(df: DataFrame, label_col: str) -> DataFrame:
    """Model input: features with NULL -> 0, integer label, class weight."""
    d = df.select(*FEATURES, F.col(label_col).cast("int").alias("label"), *(
        [c for c in ("event_date", "transaction_id", "split") if c in df.columns])).fillna(0, subset=FEATURES)
    return metrics.with_class_weight(d)


def train(train_df: DataFrame, **params) -> PipelineModel:
    return build_pipeline(**params).fit(train_df)


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    from pyspark.ml.functions import vector_to_array
    return model.transform(df).withColumn("score", vector_to_array("probability")[1])


def evaluate(model: PipelineModel, test_df: DataFrame) -> dict:
    curve = metrics.pr_curve(score(model, test_df), "score", "label")
    ap = metrics.average_precision(curve).first()[0]
    auc = metrics.roc_auc(curve).first()[0]
    thr = metrics.best_threshold(curve).first()
    return {"pr_auc": float(ap or 0.0), "roc_auc": float(auc or 0.0),
            "alert_threshold": float(thr["threshold"]) if thr and thr["threshold"] is not None else 0.5}


class Registry:
    """Runs, models and the champion alias under one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def log_run(self, model: PipelineModel, params: dict, metrics_: dict) -> str:
        run_id = uuid.uuid4().hex
        model.write().overwrite().save(f"{self.root}/models/{run_id}")
        row = [(run_id, json.dumps(params, sort_keys=True), metrics_.get("pr_auc"), metrics_.get("roc_auc"),
                metrics_.get("alert_threshold"))]
        self.spark.createDataFrame(row, "run_id string, params string, pr_auc double, roc_auc double,"
                                        " alert_threshold double") \
            .coalesce(1).write.mode("append").json(f"{self.root}/runs")
        return run_id

    def runs(self) -> DataFrame:
        return self.spark.read.schema("run_id string, params string, pr_auc double, roc_auc double,"
                                      " alert_threshold double").json(f"{self.root}/runs")

    def champion(self) -> str | None:
        try:
            a = self.spark.read.schema("alias string, run_id string, seq long").json(f"{self.root}/aliases")
        except AnalysisException:
            return None
        row = a.filter(F.col("alias") == "champion").orderBy(F.col("seq").desc()).first()
        return None if row is None else row["run_id"]

    def set_champion(self, run_id: str) -> None:
        seq = self.spark.range(1).select(F.unix_micros(F.current_timestamp())).first()[0]
        self.spark.createDataFrame([("champion", run_id, seq)], "alias string, run_id string, seq long") \
            .coalesce(1).write.mode("append").json(f"{self.root}/aliases")

    def load(self, run_id: str) -> PipelineModel:
        return PipelineModel.load(f"{self.root}/models/{run_id}")

    def load_champion(self) -> PipelineModel | None:
        rid = self.champion()
        return None if rid is None else self.load(rid)


def champion_gate(registry: Registry, candidate_run: str, test_df: DataFrame,
                  margin: float = PROMOTION_MARGIN, candidate_pr_auc: float | None = None) -> tuple[bool, float, float]:
    """Promote the candidate iff its PR-AUC beats the champion's by ``margin``.
    Both are scored on the same evaluation window (the candidate's test set), the
    candidate only if its PR-AUC on it isn't given; no champion counts as 0."""
    cand = evaluate(registry.load(candidate_run), test_df)["pr_auc"] if candidate_pr_auc is None else candidate_pr_auc
    champ_id = registry.champion()
    champ = evaluate(registry.load(champ_id), test_df)["pr_auc"] if champ_id else 0.0
    promote = cand > champ + margin
    if promote:
        registry.set_champion(candidate_run)
    return promote, cand, champ
