"""Job entry points: daily batch build, streaming scorer, weekly retrain.

Each is a plain function over a SparkSession; scheduling is left to whatever
runs ``spark-submit``.  Intermediate results are written as Parquet tables
under ``warehouse``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import features as feat, metrics, model as mdl, staging
from ..session import checkpoint_dir, ensure_utc
from ..sources import files
from ..streaming import ingest as ing, scoring
from . import daily


def batch_build(spark: SparkSession, landing: str, warehouse: str, checkpoints: str | None = None,
                run_quality: bool = True, hot_card_rows: int | None = feat.HOT_CARD_ROWS,
                as_of: str | None = None) -> dict[str, int]:
    """Ingest -> silver -> fact, dimensions and marts by what has arrived -> quality
    gate -> publish (:mod:`cardsentry.plans.daily`).  With ``as_of``, source freshness
    is recorded and a table past its error threshold stops the build."""
    ckpt = checkpoints or f"{checkpoint_dir(spark)}/ingest"
    return daily.daily_build(spark, landing, warehouse, ckpt, run_quality, hot_card_rows, as_of)


def published_fact(spark: SparkSession, warehouse: str) -> DataFrame:
    return daily.Warehouse(spark, warehouse).gold("fct_transactions")


def streaming_job(spark: SparkSession, warehouse: str, registry_root: str, checkpoints: str | None = None,
                  once: bool = False, stateful: bool = True):
    """Score new bronze transactions with the champion model (rule score if
    no champion exists yet).  By default card history lives in the state
    store (``applyInPandasWithState``); ``stateful=False`` uses the
    foreachBatch scorer with a table of card histories."""
    ensure_utc(spark)
    ckpt = checkpoints or f"{checkpoint_dir(spark)}/scoring"
    path = f"{warehouse}/bronze/raw_transactions"
    s = staging.silver({t: ing.read_topic(spark, f"{warehouse}/bronze", t) for t in ("cards", "merchants")})
    reg = mdl.Registry(spark, registry_root)
    champ = reg.load_champion()
    fn = scoring.model_score(champ) if champ is not None else scoring.rule_score
    schema, columns = ing.physical(spark), ing.stored_schema(spark, path, files.TOPICS["transactions"])
    view = lambda rows: ing.typed(rows, columns)
    if stateful:
        from ..streaming import stateful as st
        return st.start_stateful_scoring(spark, path, schema, s["cards"], s["merchants"], f"{warehouse}/gold/live_fraud_alerts", ckpt,
                                         score_fn=fn, once=once, view=view)
    scorer = scoring.Scorer(spark, s["cards"], s["merchants"], f"{warehouse}/gold/live_fraud_alerts",
                            f"{warehouse}/gold/card_state", score_fn=fn)
    return scoring.start_scoring(spark, path, schema, scorer, ckpt, once=once, view=view)


def retrain_job(spark: SparkSession, warehouse: str, registry_root: str, as_of: str,
                maturity_days: int = 45, **gbt_params) -> dict:
    """Train on mature chargeback labels, split at the 0.8 date quantile,
    promote only on a PR-AUC gain over the champion."""
    ensure_utc(spark)
    fact = published_fact(spark, warehouse)
    data = metrics.mature_labels(fact, as_of, maturity_days)
    split = metrics.quantile_split(data)
    prepared = mdl.prepare(split.withColumn("is_confirmed_fraud", F.col("label")), "is_confirmed_fraud")
    tr, te = prepared.filter("split = 'train'"), prepared.filter("split = 'test'")
    model = mdl.train(tr, **gbt_params)
    m = mdl.evaluate(model, te)
    reg = mdl.Registry(spark, registry_root)
    run = reg.log_run(model, {**mdl.GBT_PARAMS, **gbt_params, "as_of": as_of}, m)
    promoted, cand, champ = mdl.champion_gate(reg, run, te, candidate_pr_auc=m["pr_auc"])
    return {"run_id": run, "promoted": promoted, "candidate_pr_auc": cand, "champion_pr_auc": champ, **m}


def train_job(spark: SparkSession, warehouse: str, registry_root: str, split_date: str,
              **gbt_params) -> dict:
    """Train on the ground-truth label with a fixed-date split (train before,
    evaluate on and after ``split_date``), log the run with PR-AUC, ROC-AUC,
    the F1-optimal alert threshold and the classification report."""
    ensure_utc(spark)
    fact = published_fact(spark, warehouse)
    data = metrics.time_split(mdl.prepare(fact, "is_fraud_label"), split_date)
    tr, te = data.filter("split = 'train'"), data.filter("split = 'test'")
    model = mdl.train(tr, **gbt_params)
    m = mdl.evaluate(model, te)
    report = metrics.classification_report(mdl.score(model, te), m["alert_threshold"])
    reg = mdl.Registry(spark, registry_root)
    run = reg.log_run(model, {**mdl.GBT_PARAMS, **gbt_params, "split_date": split_date}, m)
    report.write.mode("overwrite").parquet(f"{registry_root}/reports/{run}")
    return {"run_id": run, **m}


def daily_pipeline(spark: SparkSession, landing: str, warehouse: str, registry_root: str, split_date: str,
                   as_of: str | None = None, **gbt_params) -> dict:
    """The daily job: ingest -> silver -> gold (+ quality gate) -> train."""
    counts = batch_build(spark, landing, warehouse, as_of=as_of)
    return {"counts": counts, "training": train_job(spark, warehouse, registry_root, split_date, **gbt_params)}
