"""Per-transaction behavioural features (one row per transaction).

One function serves the batch fact and the streaming scorer, so both paths
compute the same vector.  All windows share the partition key ``card_id`` and
one sort order ``(epoch, event_ts, transaction_id)``: the row frames use the
full order (a total order, so results do not depend on ties) and the range
frames use its prefix ``epoch``, so the plan has a single exchange and a single
sort for every window.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.expr import broadcast_if_small
from ..functions.geo import haversine_km
from . import skew

# Feature vector, in model order.
FEATURES = [
    "amount_log", "seconds_since_prev", "geo_distance_from_home_km",
    "geo_distance_from_prev_km", "is_new_device", "mcc_risk", "amount_zscore",
    "txn_count_60s", "txn_count_1h", "implied_speed_kmh",
]
LABELS = ["is_fraud_label", "fraud_type_label"]
# Look-back of the rolling amount statistics (rows) and the
# velocity windows (seconds); 999999 marks "no previous transaction".
AMOUNT_ROWS = 50
VELOCITY_SECONDS = (60, 3600)
NO_PREVIOUS = 999999
VELOCITY = {f"_cnt_{s}": s for s in VELOCITY_SECONDS}
#: Rows of a card above which its windows are evaluated in slices of as many.
HOT_CARD_ROWS = 2_000_000

ORDER = ("epoch", "event_ts", "transaction_id")
SPEC = skew.SliceSpec(key="card_id", epoch="epoch", order=ORDER,
                      rows_back=AMOUNT_ROWS, secs_back=max(VELOCITY_SECONDS))

TXN_COLS = ["transaction_id", "card_id", "merchant_id", "amount_usd", "event_ts", "event_date",
            "entry_mode", "device_id", "lat", "lon", "is_fraud_label", "fraud_type_label"]
CARD_COLS = ["card_id", "account_id", "home_lat", "home_lon", "primary_device_id"]
MERCHANT_COLS = ["merchant_id", "merchant_category", "baseline_fraud_rate"]
OUTPUT_COLS = ["transaction_id", "card_id", "merchant_id", "account_id", "merchant_category",
               "event_ts", "event_date", "entry_mode", "amount_usd", *FEATURES, *LABELS]


def with_epoch(df: DataFrame) -> DataFrame:
    return df.withColumn("epoch", F.unix_timestamp("event_ts"))


def row_windows(df: DataFrame, parts: list[str]) -> DataFrame:
    """Add prev_* and the rolling amount statistics.

    Amounts keep every decimal they have.  The 50-row mean and deviation are
    aggregates of their frame, evaluated in its order, so they depend on the rows
    alone; a history of equal amounts has a deviation of exactly 0.
    """
    w = Window.partitionBy(*parts).orderBy(*ORDER)
    before = w.rowsBetween(-AMOUNT_ROWS, -1)
    return df.select(
        "*",
        F.lag("event_ts").over(w).alias("prev_ts"),
        F.lag("epoch").over(w).alias("prev_epoch"),
        F.lag("lat").over(w).alias("prev_lat"),
        F.lag("lon").over(w).alias("prev_lon"),
        F.avg("amount_usd").over(before).alias("card_amount_mean"),
        F.stddev_samp("amount_usd").over(before).alias("card_amount_std"),
    )


def windowed(df: DataFrame, parts: list[str]) -> DataFrame:
    """``row_windows`` and the velocity counts, all in one sort."""
    by_sec = Window.partitionBy(*parts).orderBy("epoch")
    # Range frames on whole seconds; they include same-second peers.
    return row_windows(df, parts).select(
        "*", *[F.count(F.lit(1)).over(by_sec.rangeBetween(-s, 0)).alias(c) for c, s in VELOCITY.items()])


def sliced_windows(rows: DataFrame, slice_rows: int) -> DataFrame:
    """The columns of ``windowed`` for rows of hot cards, no card in one task."""
    dealt = skew.dealt_rows(rows, SPEC, slice_rows)
    counts = skew.trailing_counts(dealt, "card_id", "epoch", VELOCITY)
    sliced = skew.drop_context(row_windows(skew.slices_of(dealt, SPEC, slice_rows), ["card_id", skew.SLICE]))
    return skew.with_counts(sliced, counts, "card_id", "epoch")


def feature_columns(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    gap = F.col("epoch") - F.col("prev_epoch")
    prev_km = F.coalesce(haversine_km("lat", "lon", "prev_lat", "prev_lon"), F.lit(0.0))
    std = F.col("card_amount_std")
    return df.select(
        *[c for c in OUTPUT_COLS if c not in FEATURES],
        F.log1p("amount_usd").alias("amount_log"),
        F.coalesce(gap, F.lit(NO_PREVIOUS).cast("bigint")).alias("seconds_since_prev"),
        haversine_km("lat", "lon", "home_lat", "home_lon").alias("geo_distance_from_home_km"),
        prev_km.alias("geo_distance_from_prev_km"),
        F.when(F.col("device_id") != F.col("primary_device_id"), F.lit(1)).otherwise(F.lit(0))
         .alias("is_new_device"),
        F.coalesce(F.col("baseline_fraud_rate"), F.lit(0.0)).alias("mcc_risk"),
        F.when(std.isNull() | (std == 0), F.lit(0.0))
         .otherwise((F.col("amount_usd") - F.col("card_amount_mean")) / std).alias("amount_zscore"),
        F.col(f"_cnt_{VELOCITY_SECONDS[0]}").alias("txn_count_60s"),
        F.col(f"_cnt_{VELOCITY_SECONDS[1]}").alias("txn_count_1h"),
        F.when(F.coalesce(gap, F.lit(0)) <= 0, F.lit(0.0))
         .otherwise(prev_km / (gap / F.lit(3600.0))).alias("implied_speed_kmh"),
        *keep,
    ).select(*OUTPUT_COLS, *keep)


def compute_features(txn: DataFrame, cards: DataFrame, merchants: DataFrame,
                     hot_card_rows: int | None = HOT_CARD_ROWS, broadcast_dims: bool | str = "auto",
                     max_broadcast_rows: int = 1_000_000, keep: tuple[str, ...] = ()) -> DataFrame:
    """Feature rows for staged transactions.

    ``txn``/``cards``/``merchants`` are the silver tables (stg_*).  Dimension
    joins are left joins; unknown cards or merchants give NULL context and the
    documented defaults.  ``broadcast_dims``: True for callers that checked
    the dimension sizes themselves (the streaming scorer, once per stream);
    "auto" broadcasts each dimension only after a row-count check against
    ``max_broadcast_rows`` and otherwise shuffles (the card join then shares
    the window's card_id partitioning); False leaves it to the planner.

    ``hot_card_rows``: cards with more rows than this (rows without card count as
    one) are evaluated in slices of so many rows (see
    :mod:`cardsentry.operators.skew`); results are identical.  None: never.

    ``keep``: further columns of ``txn`` that the feature rows carry.
    """
    t = with_epoch(txn.select(*TXN_COLS, *keep))
    c = cards.select(*CARD_COLS)
    m = merchants.select(*MERCHANT_COLS)
    if broadcast_dims == "auto":
        c, m = broadcast_if_small(c, max_broadcast_rows), broadcast_if_small(m, max_broadcast_rows)
    elif broadcast_dims:
        c, m = F.broadcast(c), F.broadcast(m)
    # Merchants first: the later card join and all windows then share one
    # hash partitioning on card_id.
    base = t.join(m, "merchant_id", "left")

    hot = skew.hot_keys(t, SPEC, hot_card_rows) if hot_card_rows else None
    if hot is None:
        return feature_columns(windowed(base.join(c, "card_id", "left"), ["card_id"]), keep)

    cold, hot_rows = skew.split_hot(base, "card_id", hot)
    cold_f = feature_columns(windowed(cold.join(c, "card_id", "left"), ["card_id"]), keep)
    # Dims of hot cards: at most one row per hot card, broadcast below a checked bound.
    hot_dims = broadcast_if_small(c.join(broadcast_if_small(hot), "card_id", "left_semi"), max_broadcast_rows)
    hot_f = feature_columns(sliced_windows(hot_rows, hot_card_rows).join(hot_dims, "card_id", "left"), keep)
    return cold_f.unionByName(hot_f)


def card_windows(txn: DataFrame, hot_card_rows: int | None = HOT_CARD_ROWS) -> DataFrame:
    """The raw window columns (prev_*, rolling stats, velocity) of staged
    transactions, without dimension context; used for inspection and tests."""
    t = with_epoch(txn.select(*TXN_COLS))
    hot = skew.hot_keys(t, SPEC, hot_card_rows) if hot_card_rows else None
    if hot is None:
        w = windowed(t, ["card_id"])
    else:
        cold, hot_rows = skew.split_hot(t, "card_id", hot)
        w = windowed(cold, ["card_id"]).unionByName(sliced_windows(hot_rows, hot_card_rows))
    return w.withColumnRenamed(f"_cnt_{VELOCITY_SECONDS[0]}", "txn_count_60s") \
            .withColumnRenamed(f"_cnt_{VELOCITY_SECONDS[1]}", "txn_count_1h")


def last_per_key(df: DataFrame, key: str, order: list[str], cols: list[str]) -> DataFrame:
    """Latest row per key as an aggregate (``max_by`` over a struct of the
    order columns): partial aggregation keeps a hot key to one row per task
    before the shuffle, unlike a ``row_number`` window."""
    o = F.struct(*order)
    return df.groupBy(key).agg(*[F.max_by(c, o).alias(c) for c in cols])
