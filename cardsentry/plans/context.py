"""Lazily built pipeline tables for one (session, data folder) pair."""
from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.expr import broadcast_if_small
from ..operators import features as feat, gold, scd2, staging
from ..session import ensure_utc
from ..sources import testdata


class Pipeline:
    """Bronze -> silver -> gold over the driver tables, built on first use.

    Nothing is executed here; every property is a lazy plan, so a report that
    needs only the fact reads only the columns the fact needs.
    """

    _MEMO: dict = {}

    def __init__(self, spark: SparkSession, sf_dir: str, hot_card_rows: int | None = feat.HOT_CARD_ROWS):
        ensure_utc(spark)
        self.spark, self.sf_dir, self.hot_card_rows = spark, sf_dir, hot_card_rows

    @classmethod
    def get(cls, spark: SparkSession, sf_dir: str, hot_card_rows: int | None = feat.HOT_CARD_ROWS) -> "Pipeline":
        """Per-session memo of the lazy plans (the driver tables are read-only):
        building a plan is driver-side work that does not depend on the data."""
        key = (id(spark), sf_dir, hot_card_rows)
        hit = cls._MEMO.get(key)
        if hit is None or hit.spark is not spark:            # ids can be reused by a new session
            hit = cls._MEMO[key] = cls(spark, sf_dir, hot_card_rows)
        ensure_utc(spark)
        return hit

    @cached_property
    def raw(self) -> dict[str, DataFrame]:
        return testdata.raw_tables(self.spark, self.sf_dir)

    @cached_property
    def silver(self) -> dict[str, DataFrame]:
        return staging.silver(self.raw)

    @cached_property
    def dims(self) -> tuple[DataFrame, DataFrame]:
        """Silver cards and merchants, each hinted for broadcast iff its
        row-count check passed (checked once per pipeline)."""
        s = self.silver
        return broadcast_if_small(s["cards"]), broadcast_if_small(s["merchants"])

    def compute_features(self, txn: DataFrame, hot_card_rows: int | None = feat.HOT_CARD_ROWS) -> DataFrame:
        c, m = self.dims
        return feat.compute_features(txn, c, m, hot_card_rows=hot_card_rows, broadcast_dims=False)

    @cached_property
    def features(self) -> DataFrame:
        return self.compute_features(self.silver["transactions"], self.hot_card_rows)

    @cached_property
    def fact(self) -> DataFrame:
        s = self.silver
        return gold.fct_transactions(self.features, s["auth_events"], s["chargebacks"])

    @cached_property
    def dim_merchant(self) -> DataFrame:
        return gold.dim_merchant(self.silver["merchants"])

    @cached_property
    def alerts(self) -> DataFrame:
        return testdata.live_fraud_alerts(self.spark, self.sf_dir, self.raw["transactions"])

    def card_history(self, n_snapshots: int = 2) -> DataFrame:
        """Card SCD2 history after S1 (2024-01-01), S2 (2024-01-15) and, for
        three snapshots, S1 again at 2024-01-22 (removed cards reappear)."""
        snaps = [(testdata.card_snapshot(self.spark, self.sf_dir, 1), testdata.SNAPSHOT_1),
                 (testdata.card_snapshot(self.spark, self.sf_dir, 2), testdata.SNAPSHOT_2),
                 (testdata.card_snapshot(self.spark, self.sf_dir, 1), testdata.SNAPSHOT_3)][:n_snapshots]
        h = None
        for snap, ts in snaps:
            h = scd2.scd2_apply(h, snap, "card_id", testdata.CARD_CHECK_COLS, ts)
        return h

    @cached_property
    def dim_card(self) -> DataFrame:
        return gold.dim_card(self.card_history(2), self.silver["accounts"])

    @cached_property
    def agg_fraud_by_hour(self) -> DataFrame:
        return gold.agg_fraud_by_hour(self.fact)

    @cached_property
    def agg_merchant_risk(self) -> DataFrame:
        return gold.agg_merchant_risk(self.fact, self.dim_merchant)

    @cached_property
    def exposure(self) -> DataFrame:
        return gold.mart_chargeback_exposure(self.fact)

    @cached_property
    def model_performance(self) -> DataFrame:
        return gold.mart_model_performance(self.fact, self.alerts)


def ntz(df: DataFrame) -> DataFrame:
    """Report form of timestamps: wall-clock UTC without a zone, independent of
    the reader's session time zone."""
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name)
                       if f.dataType.typeName() == "timestamp" else F.col(f.name)
                       for f in df.schema.fields])


# Rounding used when features are reported (trig differs in the last bit
# between engines): km to 3, speed to 2, z-score to 6, log to 9 decimals.
FEATURE_ROUND = {
    "amount_log": 9, "geo_distance_from_home_km": 3, "geo_distance_from_prev_km": 3,
    "mcc_risk": 9, "amount_zscore": 6, "implied_speed_kmh": 2,
}


def report_rounded(df: DataFrame) -> DataFrame:
    return ntz(df.select(*[F.round(c, FEATURE_ROUND[c]).alias(c) if c in FEATURE_ROUND else F.col(c)
                           for c in df.columns]))
