"""The incremental fact against a full rebuild: several days, late rows, late labels,
redelivered and moved rows, and what a run reads."""
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from cardsentry.functions import expr
from cardsentry.operators import dirty, features as feat, gold, staging
from cardsentry.plans import daily
from cardsentry.plans.context import Pipeline
from cardsentry.sources import keyed

SF = "/root/testdata/sf0.001"


def rebuild(txn, auth, cb, cards, merchants):
    return gold.fct_transactions(feat.compute_features(txn, cards, merchants), auth, cb)


def rows(df):
    cols = [F.round(c, 6).alias(c) if c in feat.FEATURES else F.col(c).cast("string").alias(c) for c in gold.FACT_COLS]
    return sorted(map(tuple, df.select(*cols).collect()), key=str)


def staged(spark):
    s = Pipeline.get(spark, SF).silver
    # the few cards that there are get many rows, so the 50-row frame ends inside the data
    txn = s["transactions"].withColumn("card_id", F.when(F.col("card_id") % 3 == 0, F.lit(None)).otherwise(F.col("card_id") % 4 + 1))
    return txn, s["auth_events"], s["chargebacks"], s["cards"], s["merchants"]


def test_days_late_rows_and_labels_equal_a_rebuild(spark, tmp):
    txn, auth, cb, cards, merchants = (daily.kept(x, "test") for x in staged(spark))
    wh, day = daily.Warehouse(spark, f"{tmp}/wh"), F.dayofmonth("event_ts")
    tid = F.col("transaction_id")
    late = tid % 37 == 0
    early_auth = tid % 41 == 3                            # authorisations that come before their transaction
    moved = txn.where(tid % 101 == 5).withColumns({"event_ts": F.col("event_ts") - F.expr("INTERVAL 3 DAYS"), "event_date": F.date_sub("event_date", 3), "amount_usd": F.col("amount_usd") + 1})
    other_card = txn.where(tid % 101 == 6).withColumn("card_id", F.lit(2).cast("long"))
    batches = [
        (txn.where((day <= 10) & ~late), auth.where((F.dayofmonth("auth_ts") <= 10) | early_auth), cb.limit(0)),
        (txn.where((day > 10) & (day <= 20) & ~late), auth.where((F.dayofmonth("auth_ts") > 10) & (F.dayofmonth("auth_ts") <= 20) & ~early_auth), cb.where("transaction_id % 2 = 0")),
        (txn.where((day > 20) | late), auth.where((F.dayofmonth("auth_ts") > 20) & ~early_auth), cb.where("transaction_id % 2 = 1")),
        (moved.unionByName(other_card).unionByName(txn.where(tid % 101 == 9)), auth.where(tid % 53 == 0).withColumns({"is_approved": F.lit(False), "decline_reason": F.lit("revised")}),
         cb.where(tid % 3 == 0).withColumn("reason_code", F.lit("revised"))),
        (txn.limit(0), auth.limit(0), cb.limit(0)),
    ]
    seen = [None, None, None]
    keys = ["transaction_id", "transaction_id", "chargeback_id"]
    for batch, new in enumerate(batches):
        for k, df in enumerate(new):
            df = df.withColumn("_n", F.lit(batch))
            seen[k] = df if seen[k] is None else seen[k].unionByName(df)
        touched = daily.update_fact(wh, batch, dict(zip(("transactions", "auth_events", "chargebacks"), new)), cards, merchants)
        latest = [staging.dedup_latest(df, key, "_n").drop("_n") for df, key in zip(seen, keys)]
        if batch > 1:
            assert rows(wh.fact.read(batch)) == rows(rebuild(*latest, cards, merchants)), batch
        if batch in (1, 3):
            wh.compact()
    assert touched == []
    assert wh.card_days().agg(F.sum("n")).first()[0] == txn.count()
    # marts by date add up to those of the whole fact
    fact, dim = wh.fact.read(), gold.dim_merchant(merchants)
    mine, whole = daily.merchant_risk(daily.merchant_days(fact), dim), gold.agg_merchant_risk(fact, dim)
    assert sorted(mine.select(*whole.columns).collect()) == sorted(whole.collect())


def test_needed_days_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(dirty, "AMOUNT_ROWS", 5)
    rng = random.Random(3)
    txn = [(k, rng.choice([1, 2, None]), f"2024-01-{rng.randint(1, 28):02d} {rng.choice([0, 1, 12, 23]):02d}:{rng.randint(0, 59):02d}:00") for k in range(90)]
    txn += [(200, 1, None), (201, None, None)]
    df = spark.createDataFrame(txn, "transaction_id long, card_id long, ts string").select("transaction_id", "card_id", F.col("ts").cast("timestamp").alias("event_ts")).withColumn("event_date", F.to_date("event_ts"))
    changed = [3, 40, 77, 200]
    marks = dirty.markers(df.where(F.col("transaction_id").isin(changed)))
    counts = dirty.count_changes(df)
    got = {(r.card_id, r.day): r.dirty for r in dirty.needed_days(dirty.touched_counts(counts, marks), marks).collect()}
    data = sorted(df.select("transaction_id", "card_id", F.unix_timestamp("event_ts").alias("e"), F.to_date("event_ts").alias("d")).collect(), key=lambda r: (r.card_id or 0, r.e is not None, r.e or 0, r.transaction_id))
    for card in {r.card_id for r in data}:
        own = [r for r in data if r.card_id == card]
        need = set()
        for i, r in enumerate(own):
            back = set(range(max(0, i - 5), i)) | {j for j, x in enumerate(own) if r.e is not None and x.e is not None and r.e - 3600 <= x.e <= r.e}
            if i in {j for j, x in enumerate(own) if x.transaction_id in changed} or any(own[j].transaction_id in changed for j in back):
                assert got.get((card, r.d)) is True, (card, r)
                need |= back | {i}
        # what the dirty days' rows look back to is read too
        for i, r in enumerate(own):
            if got.get((card, r.d)):
                need |= set(range(max(0, i - 5), i + 1)) | {j for j, x in enumerate(own) if r.e is not None and x.e is not None and r.e - 3600 <= x.e <= r.e}
        assert all((card, own[j].d) in got for j in need)
    assert len(got) < len({(r.card_id, r.d) for r in data})


def test_a_run_reads_and_writes_what_the_change_needs(spark, tmp):
    """Of 60 days one gets a row: the run reads few date folders and writes few bytes."""
    n = 15_000
    txn = spark.range(n).select(
        F.col("id").alias("transaction_id"), (F.col("id") % 40).alias("card_id"), F.lit(1).cast("long").alias("merchant_id"), (F.col("id") % 90 + 1).cast("double").alias("amount_usd"),
        F.lit("USD").alias("currency"), F.expr("timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id * 345)").alias("event_ts"), F.lit(0.0).alias("lat"), F.lit(0.0).alias("lon"),
        F.lit("d").alias("device_id"), F.lit("chip").alias("entry_mode"), F.lit(False).alias("is_fraud_label"), F.lit(None).cast("string").alias("fraud_type_label")).withColumn("event_date", F.to_date("event_ts"))
    p = Pipeline.get(spark, SF)
    cards, merchants = p.silver["cards"], p.silver["merchants"]
    none = p.silver["auth_events"].limit(0), p.silver["chargebacks"].limit(0)
    wh = daily.Warehouse(spark, f"{tmp}/wh")
    held = (F.col("event_date") == "2024-01-21") & (F.col("card_id") == 7)
    late = daily.kept(txn.where(held).limit(1), "late")
    first = daily.kept(txn.join(late.select("transaction_id"), "transaction_id", "left_anti"), "first")
    daily.update_fact(wh, 0, {"transactions": first, "auth_events": none[0], "chargebacks": none[1]}, cards, merchants)
    wh.compact()
    size = lambda: sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(f"{tmp}/wh") for f in names if f.endswith(".parquet"))
    before = size()
    asked = []
    real = daily.on_dates
    daily.on_dates = lambda df, dates, column="event_date": (asked.append(len(dates)), real(df, dates, column))[1]
    try:
        touched = daily.update_fact(wh, 1, {"transactions": late, "auth_events": none[0], "chargebacks": none[1]}, cards, merchants)
    finally:
        daily.on_dates = real
    assert len(touched) <= 12 and max(asked) <= 24 and size() - before < before / 4
    assert rows(wh.fact.read(1).where("card_id = 7")) == rows(rebuild(txn.where("card_id = 7"), *none, cards, merchants))


def test_a_failed_gate_publishes_nothing(spark, tmp):
    from test_pipeline import _landing

    land, root = f"{tmp}/landing", f"{tmp}/wh"
    _landing(spark, land)
    daily.daily_build(spark, land, root, f"{tmp}/ck", compact=False)
    wh = daily.Warehouse(spark, root)
    assert wh.published() == 0 and wh.gold("dim_card").count() == 150 and wh.gold("agg_merchant_risk").count() > 0
    before = rows(wh.gold("fct_transactions"))
    bad = spark.read.json(f"{land}/transactions").limit(1).withColumns({"transaction_id": F.lit("bad"), "amount": F.lit(-1.0), "entry_mode": F.lit("magstripe")}).drop("event_date")
    bad.write.mode("append").json(f"{land}/transactions/event_date=2024-01-05")
    with pytest.raises(AssertionError, match="amount_usd"):
        daily.daily_build(spark, land, root, f"{tmp}/ck")
    assert wh.published() == 0 and rows(wh.gold("fct_transactions")) == before
    aside = spark.read.parquet(f"{root}/quarantine/checks").where("batch = 1").collect()
    assert {"accepted_range_stg_transactions_amount_usd", "accepted_values_stg_transactions_entry_mode"} <= {r.check_name for r in aside} and all('"bad"' in r.row for r in aside)
    # the row comes again, mended: the batch is made anew
    good = bad.withColumns({"amount": F.lit(5.0), "entry_mode": F.lit("chip")})
    good.write.mode("append").json(f"{land}/transactions/event_date=2024-01-05")
    daily.daily_build(spark, land, root, f"{tmp}/ck")
    assert wh.published() == 1 and wh.gold("fct_transactions").count() == 1001
    assert wh.gold("fct_transactions").where("transaction_id = 'bad'").first().amount_usd == 5.0


def test_repeated_rows_of_a_batch_count_once(spark, tmp):
    """Transactions and dimension rows that come twice: one fact row each, as when readers
    chose among them; the silver table and the fact need no aggregate to be read."""
    txn, auth, cb, cards, merchants = (daily.kept(x, "test") for x in staged(spark))
    twice, cut = txn.where("transaction_id % 5 = 0"), F.lit("2024-01-20").cast("timestamp")
    wh = daily.Warehouse(spark, f"{tmp}/wh")
    some = twice.unionByName(twice.withColumn("amount_usd", F.col("amount_usd") + 1)).unionByName(txn)
    for batch, rows_ in enumerate([some.where(F.col("event_ts") < cut), some.where(F.col("event_ts") >= cut)]):
        mine = [x.join(rows_.select("transaction_id"), "transaction_id", "left_semi") for x in (auth, cb)]
        daily.update_fact(wh, batch, {"transactions": rows_, "auth_events": mine[0], "chargebacks": mine[1]}, cards.unionByName(cards.where("card_id = 1")), merchants)
    best = txn.where("transaction_id % 5 <> 0").unionByName(twice.withColumn("amount_usd", F.col("amount_usd") + 1))
    plain = ["transaction_id", "card_id", "amount_usd", "is_approved", "is_confirmed_fraud"]
    assert sorted(wh.fact.read().select(*plain).collect(), key=str) == sorted(rebuild(best, auth, cb, cards, merchants).select(*plain).collect(), key=str)
    for table in (wh.transactions, wh.fact):
        files_ = spark.read.parquet(table.root).where(F.col("transaction_id").isNotNull())
        assert files_.groupBy("transaction_id", "_label").count().where("count > 1").isEmpty()
        assert "SortAggregate" not in table.read()._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("bound", [2, 100_000])
def test_tables_are_broadcast_by_their_rows(spark, tmp, monkeypatch, bound):
    """However small its files, a table of more rows than the bound isn't built on the driver
    by any join of a run; one of few rows is broadcast.  The fact is the same."""
    monkeypatch.setattr(expr, "BUILD_ROWS", bound, raising=False)
    txn, auth, cb, cards, merchants = (daily.kept(x, "test") for x in staged(spark))
    late, cut = F.col("transaction_id") % 37 == 0, F.lit("2024-01-20").cast("timestamp")
    again = txn.where("transaction_id % 101 = 5 and event_ts < '2024-01-20'").withColumn("amount_usd", F.col("amount_usd") + 1)
    batches = [(txn.where((F.col("event_ts") < cut) & ~late), auth.where(F.col("auth_ts") < cut), cb.limit(0)),
               (txn.where((F.col("event_ts") >= cut) | late).unionByName(again), auth.where(F.col("auth_ts") >= cut), cb)]
    plans, wh = [], daily.Warehouse(spark, f"{tmp}/wh")
    for module, name in ((daily, "kept"), (keyed, "overwrite_partitions")):
        real = getattr(module, name)
        monkeypatch.setattr(module, name, lambda df, *a, real=real: (plans.append(df._jdf.queryExecution().executedPlan().toString()), real(df, *a))[1])
    for batch, new in enumerate(batches):
        daily.update_fact(wh, batch, dict(zip(("transactions", "auth_events", "chargebacks"), new)), cards, merchants)
    wh.compact()
    keys = [x for plan in plans for x in re.findall(r"BroadcastHashJoin \[([^\]]*)\]", plan)]
    built = [x for x in keys if x.startswith(("transaction_id", "chargeback_id", "coalesce(card_id"))]
    assert bool(built) == (bound > 2), built
    best = staging.dedup_latest(txn.withColumn("_n", F.lit(0)).unionByName(again.withColumn("_n", F.lit(1))), "transaction_id", "_n").drop("_n")
    assert rows(wh.fact.read()) == rows(rebuild(best, auth, cb, cards, merchants))
