"""Whole-table check of the micro-batch feature path."""
from __future__ import annotations

from pyspark.sql import functions as F

import uuid

from ..operators import features as feat
from ..session import scratch_path
from ..streaming import scoring
from ..streaming.stateful import stateful_features
from .catalog import register
from .context import Pipeline, report_rounded
from .oracle import q
from .queries_core import _sql_feats


@register("str_07_stream_batch_parity", q(f"SELECT {_sql_feats(feat.OUTPUT_COLS)} FROM features"))
def str_07(spark, sf_dir):
    """All transactions scored in four event-time micro-batches (days 1-8,
    9-16, 17-24, 25-31) with bounded card history carried between them; the
    features equal the batch features."""
    p = Pipeline.get(spark, sf_dir)
    cards, merchants = p.dims
    batch_of = F.floor((F.dayofmonth("event_ts") - 1) / 8).cast("int")
    f = scoring.features_in_batches(p.silver["transactions"], cards, merchants, batch_of, [0, 1, 2, 3])
    return report_rounded(f)


@register("str_10_state_store_features", q(f"SELECT {_sql_feats(feat.OUTPUT_COLS)} FROM features"))
def str_10(spark, sf_dir):
    """All transactions land in four event-time batches (days 1-8, 9-16, 17-24,
    25-31) in the shared checkpoint folder, the last hour of each batch once
    more in the next, and are streamed through the state-store feature operator;
    the written features equal the batch features."""
    p = Pipeline.get(spark, sf_dir)
    cards, merchants = p.dims
    txn = p.silver["transactions"].select(*feat.TXN_COLS)
    root = scratch_path(spark, f"str10-{uuid.uuid4().hex}")
    day = F.floor((F.dayofmonth("event_ts") - 1) / 8)
    again = F.floor((F.dayofmonth(F.expr("event_ts + INTERVAL 1 HOUR")) - 1) / 8) == day + 1
    # The stateful operator keeps the partition count it starts with (one
    # state store per partition); size it to the cores, not the batch default.
    prev = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions",
                   str(max(1, min(int(prev), spark.sparkContext.defaultParallelism))))
    try:
        for k in range(4):
            txn.filter((day == k) | (again & (day == k - 1))).write.mode("append").parquet(f"{root}/in")
            stream = spark.readStream.schema(txn.schema).parquet(f"{root}/in")
            (stateful_features(stream, cards, merchants).writeStream.format("parquet").option("checkpointLocation", f"{root}/ck")
             .trigger(availableNow=True).start(f"{root}/out").awaitTermination())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", prev)
    return report_rounded(spark.read.parquet(f"{root}/out"))
