"""Job entry points end to end on a landing zone derived from sf0.001."""
import os

from pyspark.sql import functions as F

from cardsentry.operators import quality
from cardsentry.plans import pipeline
from cardsentry.plans.daily import Warehouse
from cardsentry.sources import files, testdata
from reference_files import write_reference_array

SF = "/root/testdata/sf0.001"


def _landing(spark, root):
    t = testdata.transactions(spark, SF)
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
    txn = t.select(F.col("transaction_id").cast("string").alias("transaction_id"),
                   F.col("card_id").cast("string").alias("card_id"),
                   F.col("merchant_id").cast("string").alias("merchant_id"), "amount", "currency",
                   F.date_format("ts", iso).alias("ts"), "event_date", "lat", "lon", "device_id", "entry_mode",
                   "is_fraud", "fraud_type")
    files.write_partitioned_jsonl(txn, f"{root}/transactions")
    a = testdata.auth_events(spark, SF, t)
    files.write_partitioned_jsonl(a.select(F.col("transaction_id").cast("string").alias("transaction_id"),
                                           "approved", "reason", F.date_format("auth_ts", iso).alias("auth_ts"),
                                           "event_date"), f"{root}/auth_events")
    c = testdata.chargebacks(spark, SF, t)
    files.write_partitioned_jsonl(c.select("chargeback_id", F.col("transaction_id").cast("string").alias("transaction_id"),
                                           "amount", "reason_code", F.date_format("settle_ts", iso).alias("settle_ts"),
                                           "settle_date"), f"{root}/chargebacks", "settle_date")
    os.makedirs(f"{root}/reference", exist_ok=True)
    write_reference_array(testdata.cards(spark, SF).withColumn("card_id", F.col("card_id").cast("string"))
                                .withColumn("account_id", F.col("account_id").cast("string")),
                                f"{root}/reference/cards.json")
    write_reference_array(testdata.merchants(spark, SF).withColumn("merchant_id", F.col("merchant_id").cast("string")),
                                f"{root}/reference/merchants.json")
    write_reference_array(testdata.accounts(spark, SF).withColumn("account_id", F.col("account_id").cast("string")),
                                f"{root}/reference/accounts.json")


def test_batch_stream_retrain(spark, tmp):
    land, wh = f"{tmp}/landing", f"{tmp}/wh"
    _landing(spark, land)
    import datetime as _dt
    now = _dt.datetime.now(_dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    counts = pipeline.batch_build(spark, land, wh, f"{tmp}/ck", as_of=now)
    gold = Warehouse(spark, wh).gold
    fresh = spark.read.parquet(f"{wh}/quality/freshness")
    assert fresh.count() == 6 and fresh.filter("status <> 'pass'").count() == 0
    assert counts["fct_transactions"] == 1000
    assert gold("agg_fraud_by_hour").count() > 0
    assert Warehouse(spark, wh).quarantine("transactions").count() == 0
    q = spark.read.parquet(f"{wh}/quality/runs").where("batch = 0")
    assert q.filter("status = 'fail'").count() == 0 and q.count() == len(quality.default_checks()) + 4
    # a re-delivered file (same transactions, later ingestion) must not duplicate facts
    dup = spark.read.json(f"{land}/transactions").limit(10)
    dup.write.mode("append").json(f"{land}/transactions/event_date=2024-01-05")
    counts2 = pipeline.batch_build(spark, land, wh, f"{tmp}/ck")
    assert counts2["fct_transactions"] == 1000
    sq = pipeline.streaming_job(spark, wh, f"{tmp}/registry", f"{tmp}/ck/scoring", once=True)
    sq.awaitTermination()
    alerts = Warehouse(spark, wh).alerts()
    assert alerts.count() == 1000
    assert alerts.select("transaction_id").distinct().count() == 1000
    tr = pipeline.train_job(spark, wh, f"{tmp}/registry", "2024-01-24", maxIter=3, maxDepth=3)
    rep = spark.read.parquet(f"{tmp}/registry/reports/{tr['run_id']}")
    assert sorted(r["class"] for r in rep.collect()) == ["0", "1", "accuracy", "macro avg", "weighted avg"]
    res = pipeline.retrain_job(spark, wh, f"{tmp}/registry", as_of="2024-03-20", maxIter=3, maxDepth=3)
    assert res["run_id"] and "pr_auc" in res
