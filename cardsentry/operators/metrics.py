"""Model-evaluation metrics and training-set preparation, all as Spark plans.

The precision/recall curve needs cumulative counts over scores in descending
order.  An unpartitioned window would pull every row into one task, so the
curve is built as a two-level prefix sum: rows are first aggregated to one row
per distinct score, these are dealt out by range of score and written, each
range gets the totals of all higher ranges as an offset (a window over one row
for each range), and the running sum inside a range is an ordinary partitioned
window.  The result is exact; where the ranges are cut only balances the work.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.expr import count_if
from ..session import checkpoint_dir
from . import skew


def time_split(df: DataFrame, split_date: str, date_col: str = "event_date") -> DataFrame:
    """'train' strictly before ``split_date``, 'test' on or after it."""
    d = F.col(date_col).cast("date")
    return df.withColumn("split", F.when(d < F.lit(split_date).cast("date"), F.lit("train"))
                         .when(d.isNotNull(), F.lit("test")))


def quantile_split_day(df: DataFrame, q: float = 0.8, date_col: str = "event_date") -> Column:
    """Scalar subquery: the ``q`` quantile of the day number (linear
    interpolation).  ``percentile`` keeps a value->count map, so its state is
    bounded by the number of distinct days, not by the rows."""
    day = F.datediff(F.col(date_col).cast("date"), F.lit("1970-01-01").cast("date"))
    return df.select(F.percentile(day, q).alias("_q")).scalar()


def quantile_split(df: DataFrame, q: float = 0.8, date_col: str = "event_date") -> DataFrame:
    day = F.datediff(F.col(date_col).cast("date"), F.lit("1970-01-01").cast("date"))
    cut = quantile_split_day(df, q, date_col)
    return df.withColumn("split", F.when(day <= cut, F.lit("train")).when(day.isNotNull(), F.lit("test")))


def mature_labels(fact: DataFrame, as_of: str, maturity_days: int = 45,
                  label_col: str = "is_confirmed_fraud") -> DataFrame:
    """Rows old enough for their chargeback label to be final."""
    cutoff = F.date_sub(F.lit(as_of).cast("date"), maturity_days)
    return fact.filter(F.col("event_date") <= cutoff).withColumn("label", F.col(label_col).cast("int"))


def with_class_weight(df: DataFrame, label_col: str = "label", weight_col: str = "weight") -> DataFrame:
    """Positives weighted (n - pos) / max(pos, 1), negatives 1."""
    stats = df.agg(F.count(F.lit(1)).alias("n"), count_if(F.col(label_col) == 1).alias("pos"))
    w = stats.select(((F.col("n") - F.col("pos")) / F.greatest(F.col("pos"), F.lit(1))).alias("w")).scalar()
    return df.withColumn(weight_col, F.when(F.col(label_col) == 1, w).otherwise(F.lit(1.0)))


def _per_score(scored: DataFrame, score_col: str, label_col: str) -> DataFrame:
    lab = F.col(label_col).cast("boolean")
    return scored.groupBy(F.col(score_col).alias("score")).agg(
        count_if(lab).alias("pos"), count_if(~lab).alias("neg"))


def pr_curve(scored: DataFrame, score_col: str = "score", label_col: str = "label", ranges: int | None = None) -> DataFrame:
    """One row per distinct score (descending): counts at the score and
    cumulative true/false positives when alerting at ``score >= threshold``.

    Columns: threshold, pos, neg, tp, fp, precision, recall, f1, n_pos, n_neg.
    ``ranges``: into how many ranges the scores are dealt out (default: four for
    each core, at most the session's shuffle partitions); the curve is the same for any.
    """
    spark = scored.sparkSession
    checkpoint_dir(spark)
    per = skew.dealt_by_range(_per_score(scored, score_col, label_col), [F.col("score").desc()], ranges or min(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism))
    run = Window.partitionBy("_range").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    tot = per.groupBy("_range").agg(F.sum("pos").alias("_bp"), F.sum("neg").alias("_bn"))
    # Offsets and grand totals over the range table (``ranges`` rows at most).
    prior = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    off = tot.select("_range", F.coalesce(F.sum("_bp").over(prior), F.lit(0)).alias("_op"),
                     F.coalesce(F.sum("_bn").over(prior), F.lit(0)).alias("_on"),
                     F.sum("_bp").over(every).cast("bigint").alias("n_pos"),
                     F.sum("_bn").over(every).cast("bigint").alias("n_neg"))
    cur = (per.join(F.broadcast(off), "_range")
           .withColumn("tp", (F.sum("pos").over(run) + F.col("_op")).cast("bigint"))
           .withColumn("fp", (F.sum("neg").over(run) + F.col("_on")).cast("bigint")))
    p = F.col("tp") / (F.col("tp") + F.col("fp"))
    r = F.col("tp") / F.nullif(F.col("n_pos"), F.lit(0))
    return cur.select(
        F.col("score").alias("threshold"), "pos", "neg", "tp", "fp",
        p.alias("precision"), r.alias("recall"),
        F.when((p + r) > 0, F.lit(2.0) * p * r / (p + r)).otherwise(F.lit(0.0)).alias("f1"),
        "n_pos", "n_neg")


def average_precision(curve: DataFrame) -> DataFrame:
    """Step-wise AP: sum over thresholds of (recall gain) x precision."""
    return curve.agg(F.sum(F.col("pos") / F.nullif(F.col("n_pos"), F.lit(0)) * F.col("precision"))
                     .alias("average_precision"))


def roc_auc(curve: DataFrame) -> DataFrame:
    """Area under ROC with ties counted half (trapezoid between thresholds)."""
    tp_before = F.col("tp") - F.col("pos")
    term = (F.col("neg") / F.nullif(F.col("n_neg"), F.lit(0)) * (tp_before + F.col("pos") / 2.0)
            / F.nullif(F.col("n_pos"), F.lit(0)))
    return curve.agg(F.sum(term).alias("roc_auc"))


def best_threshold(curve: DataFrame) -> DataFrame:
    """Threshold with the highest F1 (ties: the highest threshold)."""
    best = F.max(F.struct("f1", "threshold"))
    return curve.agg(best.alias("_b")).select(F.col("_b.threshold").alias("threshold"),
                                               F.col("_b.f1").alias("f1"))


def classification_report(scored: DataFrame, threshold: float | Column, score_col: str = "score",
                          label_col: str = "label") -> DataFrame:
    """Per-class precision/recall/F1/support plus accuracy, macro and weighted
    averages, from one aggregation of the confusion counts."""
    pred = F.col(score_col) >= threshold
    lab = F.col(label_col).cast("boolean")
    c = scored.agg(count_if(pred & lab).alias("tp"), count_if(pred & ~lab).alias("fp"),
                   count_if(~pred & lab).alias("fn"), count_if(~pred & ~lab).alias("tn"))

    def prf(tp, fp, fn):
        p = F.coalesce(tp / F.nullif(tp + fp, F.lit(0)), F.lit(0.0))
        r = F.coalesce(tp / F.nullif(tp + fn, F.lit(0)), F.lit(0.0))
        f = F.when(p + r > 0, F.lit(2.0) * p * r / (p + r)).otherwise(F.lit(0.0))
        return p, r, f

    tp, fp, fn, tn = (F.col(x).cast("double") for x in ("tp", "fp", "fn", "tn"))
    p1, r1, f1 = prf(tp, fp, fn)
    p0, r0, f0 = prf(tn, fn, fp)
    s1, s0 = tp + fn, tn + fp
    n = s0 + s1
    rows = [
        ("0", p0, r0, f0, s0), ("1", p1, r1, f1, s1),
        ("accuracy", F.lit(None).cast("double"), F.lit(None).cast("double"), (tp + tn) / n, n),
        ("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n),
        ("weighted avg", (p0 * s0 + p1 * s1) / n, (r0 * s0 + r1 * s1) / n, (f0 * s0 + f1 * s1) / n, n),
    ]
    return c.select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("class"), p.alias("precision"), r.alias("recall"), f.alias("f1_score"),
                 s.cast("bigint").alias("support")) for k, p, r, f, s in rows])).alias("r")).select("r.*")
