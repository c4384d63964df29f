"""Batch file sources, reject counting, materialisation."""
from pyspark.sql import functions as F

from cardsentry.operators import staging
from cardsentry.sources import files, testdata
from cardsentry.sources.tables import materialize


def test_jsonl_dataset_partition_discovery(spark, tmp):
    t = testdata.transactions(spark, "/root/testdata/sf0.001").withColumn("ts", F.col("ts").cast("string"))
    n = files.write_partitioned_jsonl(t, f"{tmp}/txn", "event_date", drop=["currency"])
    assert n == 1000
    back = files.read_jsonl_dataset(spark, f"{tmp}/txn")
    assert back.count() == 1000 and "currency" not in back.columns
    assert back.select("event_date").distinct().count() == t.select("event_date").distinct().count()
    typed = files.read_jsonl_dataset(spark, f"{tmp}/txn", files.schema_of(spark, files.TRANSACTIONS_SCHEMA))
    assert dict(typed.dtypes)["event_date"] == "date"


def test_read_table_projects(spark, tmp):
    df = testdata.merchants(spark, "/root/testdata/sf0.001")
    df.write.parquet(f"{tmp}/m.parquet")
    df.write.option("header", True).csv(f"{tmp}/m.csv")
    a = files.read_table(spark, f"{tmp}/m.parquet", ["merchant_id", "category"])
    b = files.read_table(spark, f"{tmp}/m.csv", ["merchant_id", "category"])
    assert a.columns == ["merchant_id", "category"] and sorted(a.collect()) == sorted(b.collect())
    plan = a._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<merchant_id:bigint,category:string>" in plan


def test_rejects_count_bad_values(spark):
    raw = spark.createDataFrame([("1.5", "2024-01-01 00:00:00"), ("abc", "not a time"), (None, None)],
                                "amount string, ts string")
    r = staging.rejects(raw, {"amount": "double", "ts": "timestamp"}).first()
    assert r["amount_rejects"] == 1 and r["ts_rejects"] == 1


def test_materialize(spark, tmp):
    df = spark.range(5)
    assert materialize(df, "ephemeral", "x") is df
    assert materialize(df, "view", "cs_test_view").count() == 5
    assert spark.table("cs_test_view").count() == 5
    assert materialize(df, "table", "t", f"{tmp}/t").count() == 5


def test_partition_upsert_is_idempotent(spark, tmp):
    from cardsentry.sources.tables import upsert_partitions
    p = f"{tmp}/fact"
    base = spark.range(40).select(F.col("id").alias("transaction_id"), (F.col("id") % 5).alias("event_date"),
                                  F.lit("v1").alias("label"))
    upsert_partitions(spark, p, base, "transaction_id")
    upd = spark.range(30, 50).select(F.col("id").alias("transaction_id"), (F.col("id") % 5).alias("event_date"),
                                     F.lit("v2").alias("label"))
    upsert_partitions(spark, p, upd, "transaction_id")
    once = sorted(spark.read.parquet(p).collect())
    upsert_partitions(spark, p, upd, "transaction_id")        # replay
    assert sorted(spark.read.parquet(p).collect()) == once
    assert len(once) == 50 and sum(r["label"] == "v2" for r in once) == 20


def test_nested_files_replaced_partitions_and_row_count(spark, tmp):
    df = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-02")], "transaction_id string, event_date string")
    assert files.write_partitioned_jsonl(df, f"{tmp}/j") == 2
    assert files.write_partitioned_jsonl(df, f"{tmp}/j") == 2  # replaced, not doubled
    df.limit(1).write.json(f"{tmp}/j/plain/deeper")
    back = files.read_jsonl_dataset(spark, f"{tmp}/j")
    assert back.count() == 3 and back.filter("event_date is not null").count() == 2
    assert dict(back.dtypes)["event_date"] == "date"


def test_null_keys_are_not_duplicates(spark):
    from cardsentry.operators.staging import dedup_latest
    df = spark.createDataFrame([(None, 1), (None, 1), (None, 2), ("a", 1), ("a", 3)], "k string, t int")
    assert sorted(map(tuple, dedup_latest(df, "k", "t").collect()), key=str) == [("a", 3), (None, 1), (None, 1), (None, 2)]
