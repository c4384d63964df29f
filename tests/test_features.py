"""Feature edge cases against hand computation."""
import math
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from cardsentry.functions.geo import haversine_km
from cardsentry.operators import features as feat

T0 = datetime(2024, 1, 1, 12, 0, 0)
TXN_DDL = ("transaction_id long, card_id long, merchant_id long, amount_usd double, event_ts timestamp,"
           " event_date date, entry_mode string, device_id string, lat double, lon double,"
           " is_fraud_label boolean, fraud_type_label string")


def _txn(spark, rows):
    full = [(i, c, m, a, ts, ts.date(), "online", d, la, lo, False, None) for (i, c, m, a, ts, d, la, lo) in rows]
    return spark.createDataFrame(full, TXN_DDL)


def _dims(spark):
    cards = spark.createDataFrame([(1, 10, 0.0, 0.0, "D1"), (2, 20, 0.0, 0.0, "D2")],
                                  "card_id long, account_id long, home_lat double, home_lon double, primary_device_id string")
    merch = spark.createDataFrame([(7, "gambling", 0.05)], "merchant_id long, merchant_category string, baseline_fraud_rate double")
    return cards, merch


def test_haversine_london_paris(spark):
    df = spark.createDataFrame([(51.5074, -0.1278, 48.8566, 2.3522), (0.0, 0.0, 0.0, 180.0),
                                (10.0, 10.0, 10.0, 10.0), (0.0, 179.0, 0.0, 181.0)], "a double, b double, c double, d double")
    km = [r[0] for r in df.select(haversine_km("a", "b", "c", "d")).collect()]
    assert 330 < km[0] < 360
    assert abs(km[1] - math.pi * 6371.0) < 1e-6
    assert km[2] == 0.0
    assert abs(km[3] - 2 * 6371.0 * math.asin(math.sin(math.radians(1.0)))) < 1e-6


def test_edges(spark):
    rows = [
        (1, 1, 7, 10.0, T0, "D1", 0.0, 0.0),                            # first txn of card 1
        (2, 1, 7, 10.0, T0 + timedelta(microseconds=500), "D1", 1.0, 0.0),  # same second
        (3, 1, 99, 10.0, T0 + timedelta(seconds=60), None, 1.0, 0.0),   # exactly 60 s, null device, unknown merchant
        (4, 1, 7, 40.0, T0 + timedelta(seconds=61), "X9", 2.0, 0.0),    # new device
        (5, 3, 7, 5.0, T0, "D3", 0.0, 0.0),                             # unknown card
        (6, 1, 7, 10.0, T0 + timedelta(seconds=3661), "D1", 2.0, 0.0),  # exactly 3600 s after id 4
    ]
    cards, merch = _dims(spark)
    out = {r["transaction_id"]: r for r in feat.compute_features(_txn(spark, rows), cards, merch).collect()}
    assert out[1]["seconds_since_prev"] == 999999 and out[1]["geo_distance_from_prev_km"] == 0.0
    assert out[1]["implied_speed_kmh"] == 0.0 and out[1]["amount_zscore"] == 0.0
    assert out[2]["seconds_since_prev"] == 0 and out[2]["implied_speed_kmh"] == 0.0   # same second -> 0
    assert out[1]["txn_count_60s"] == 2 and out[2]["txn_count_60s"] == 2             # same-second peers count
    assert out[3]["txn_count_60s"] == 3                                               # 60 s boundary included
    assert out[4]["txn_count_60s"] == 2                                               # ids 3, 4 (61 s drops 1, 2)
    assert out[6]["txn_count_1h"] == 2                                                # ids 4 and 6
    assert out[3]["is_new_device"] == 0 and out[4]["is_new_device"] == 1
    assert out[3]["mcc_risk"] == 0.0 and out[1]["mcc_risk"] == 0.05
    assert out[5]["geo_distance_from_home_km"] is None and out[5]["account_id"] is None
    assert out[3]["amount_zscore"] == 0.0                                             # std of constant amounts is 0
    # id 4: mean 10, std 0 over prior -> 0; id 6: prior [10,10,10,40]
    prior = [10.0, 10.0, 10.0, 40.0]
    m = sum(prior) / 4
    sd = math.sqrt(sum((x - m) ** 2 for x in prior) / 3)
    assert abs(out[6]["amount_zscore"] - (10.0 - m) / sd) < 1e-12
    d = out[4]["geo_distance_from_prev_km"]
    assert abs(out[4]["implied_speed_kmh"] - d / (1 / 3600.0)) < 1e-9


def test_rows_frame_drops_old_rows(spark):
    rows = [(i, 1, 7, float(i), T0 + timedelta(seconds=10 * i), "D1", 0.0, 0.0) for i in range(53)]
    cards, merch = _dims(spark)
    out = {r["transaction_id"]: r for r in feat.card_windows(_txn(spark, rows)).collect()}
    assert out[52]["card_amount_mean"] == sum(range(2, 52)) / 50
    assert out[1]["card_amount_std"] is None


def test_ties_are_deterministic(spark):
    rows = [(10, 1, 7, 1.0, T0, "D1", 0.0, 0.0), (9, 1, 7, 2.0, T0, "D1", 5.0, 0.0)]
    cards, merch = _dims(spark)
    out = {r["transaction_id"]: r for r in feat.compute_features(_txn(spark, rows), cards, merch).collect()}
    assert out[9]["seconds_since_prev"] == 999999   # id 9 sorts first on equal timestamps
    assert out[10]["geo_distance_from_prev_km"] > 0


def test_hot_card_slicing_is_exact(spark):
    """All sf0.001 transactions moved onto one card with bursts and gaps:
    sliced evaluation must equal the plain window."""
    from cardsentry.plans.context import Pipeline
    p = Pipeline(spark, "/root/testdata/sf0.001")
    t = p.silver["transactions"].withColumn("card_id", F.lit(3).cast("bigint"))
    # compress half the rows into bursts so slices have very different sizes
    t = t.withColumn("event_ts", F.when(F.col("transaction_id") % 2 == 0,
                                        F.col("event_ts") - F.expr("INTERVAL 3 DAYS")).otherwise(F.col("event_ts")))
    c, m = p.silver["cards"], p.silver["merchants"]
    plain = feat.compute_features(t, c, m)
    sliced = feat.compute_features(t, c, m, hot_card_rows=25)
    cols = ["transaction_id"] + feat.FEATURES
    a = sorted(plain.select(*cols).collect())
    b = sorted(sliced.select(*cols).collect())
    assert len(a) == len(b) == t.count()
    for x, y in zip(a, b):
        for u, v in zip(x, y):
            assert (u is None and v is None) or abs(u - v) <= 1e-9 * max(1.0, abs(u)), (x, y)


def test_single_exchange_for_all_windows(spark):
    from cardsentry.plans.context import Pipeline
    p = Pipeline(spark, "/root/testdata/sf0.001")
    s = p.silver
    w = feat.card_windows(s["transactions"])
    plan = w._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(card_id") == 1
    assert plan.count("Sort [card_id") == 1


def test_scan_is_pruned(spark):
    from cardsentry.plans.context import Pipeline
    p = Pipeline(spark, "/root/testdata/sf0.001")
    df = p.silver["transactions"].select("transaction_id", "amount_usd")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,value:double>" in plan or "event_id:bigint,value:double" in plan


def test_top_k_per_key_exact(spark):
    from cardsentry.operators.skew import top_k_per_key
    rows = [(i % 3, i, float((i * 7919) % 101)) for i in range(600)]     # key 0..2, 200 rows each
    df = spark.createDataFrame(rows, "k long, transaction_id long, v double")
    got = sorted((r.k, r.transaction_id) for r in top_k_per_key(df, "k", ["v", "transaction_id"], 5, salts=7).collect())
    want = []
    for k in range(3):
        mine = sorted([r for r in rows if r[0] == k], key=lambda r: (r[2], r[1]), reverse=True)[:5]
        want += [(k, r[1]) for r in mine]
    assert got == sorted(want)


def test_hot_key_guard(spark):
    from cardsentry.operators import skew
    df = spark.range(100).selectExpr("id % 10 AS card_id", "id AS epoch")
    spec = skew.SliceSpec("card_id", "epoch", ("epoch",), 1, 60)
    assert skew.hot_keys(df, spec, threshold=100) is None
    # however many keys are hot, all are returned
    assert skew.hot_keys(df, spec, threshold=5).count() == 10


def test_large_dimension_shares_the_window_shuffle(spark):
    """Beyond the broadcast bound the card join is a sort-merge join on
    card_id and the windows reuse its partitioning: transactions are
    shuffled once."""
    from cardsentry.plans.context import Pipeline
    p = Pipeline.get(spark, "/root/testdata/sf0.001")
    s = p.silver
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        f = feat.compute_features(s["transactions"], s["cards"], s["merchants"], max_broadcast_rows=10)
        plan = f._jdf.queryExecution().executedPlan().toString()
        txn_exchanges = [l for l in plan.splitlines() if "Exchange hashpartitioning(card_id" in l]
        assert "SortMergeJoin" in plan
        assert len(txn_exchanges) == 2          # transactions side + cards side, nothing for the windows
        a = sorted(f.select("transaction_id", *feat.FEATURES).collect())
        b = sorted(p.features.select("transaction_id", *feat.FEATURES).collect())
        assert a == b
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_sub_cent_amounts_are_kept(spark):
    rows = [(i, 1, 7, a, T0 + timedelta(seconds=10 * i), "D1", 0.0, 0.0) for i, a in enumerate([0.001, 0.002, 0.003, 0.005])]
    cards, merch = _dims(spark)
    w = {r["transaction_id"]: r for r in feat.card_windows(_txn(spark, rows)).collect()}
    assert abs(w[3]["card_amount_mean"] - 0.002) < 1e-15 and abs(w[3]["card_amount_std"] - 0.001) < 1e-15
    f = {r["transaction_id"]: r for r in feat.compute_features(_txn(spark, rows), cards, merch).collect()}
    assert abs(f[3]["amount_zscore"] - 3.0) < 1e-9


def test_money_sum_keeps_small_units(spark):
    from cardsentry.functions import money_sum
    df = spark.createDataFrame([(0.0004,), (0.0004,), (1e12,), (None,)], "a double")
    assert df.agg(money_sum(F.col("a"))).first()[0] == 1000000000000.0008


def test_a_burst_is_cut_into_equal_slices(spark):
    """95 % of a card's rows in ten minutes, a third of them in one second, and rows
    without card: slices of equal row counts, the same features."""
    import random

    from cardsentry.operators import skew
    rng = random.Random(7)
    n = 3000
    seconds = [100_000 + (30 if rng.random() < 0.33 else rng.randint(0, 600)) if rng.random() < 0.95 else rng.randint(0, 10**6) for _ in range(n)]
    rows = [(i, 1 if i % 3 else None, 7, rng.randint(1, 9000) / 100, T0 + timedelta(seconds=s), "D1", rng.random(), rng.random()) for i, s in enumerate(seconds)]
    rows += [(n + i, 2, 7, 5.0, T0 + timedelta(seconds=40 * i), "D1", 0.0, 0.0) for i in range(30)]
    t = feat.with_epoch(_txn(spark, rows))
    t = t.withColumn("card_id", F.col("card_id").cast("long"))
    hot = skew.hot_keys(t, feat.SPEC, 200)
    assert sorted((r[0] for r in hot.collect()), key=str) == [1, None]
    _, hot_rows = skew.split_hot(t, "card_id", hot)
    sliced = skew.equal_slices(hot_rows, feat.SPEC, 200)
    sizes = [r["count"] for r in sliced.groupBy("card_id", skew.SLICE).count().collect()]
    assert max(sizes) <= 200 + feat.AMOUNT_ROWS and sliced.where(~F.col(skew.CTX)).count() == n
    seconds_of = skew.trailing_counts(hot_rows, "card_id", "epoch", feat.VELOCITY)
    assert seconds_of.groupBy("card_id", "epoch").count().where("count > 1").count() == 0
    cards, merch = _dims(spark)
    for plain, cut in ((feat.card_windows(t, None), feat.card_windows(t, 200)), (feat.compute_features(t, cards, merch, hot_card_rows=None), feat.compute_features(t, cards, merch, hot_card_rows=200))):
        assert sorted(map(str, plain.select(*sorted(plain.columns)).collect())) == sorted(map(str, cut.select(*sorted(plain.columns)).collect()))


def test_trailing_counts_against_brute_force(spark):
    import random

    from cardsentry.operators import skew
    rng = random.Random(2)
    rows = [(rng.choice([1, 2, None]), rng.choice([None, rng.randint(-300, 300)])) for _ in range(400)]
    df = spark.createDataFrame(rows, "k long, epoch long")
    for width in (1, 50, 10_000):
        got = {(r.k, r.epoch): (r.a, r.b) for r in skew.trailing_counts(df, "k", "epoch", {"a": 0, "b": 37}, width).collect()}
        assert got == {(k, e): tuple(sum(x == k and (y is None) == (e is None) and (e is None or e - s <= y <= e) for x, y in rows) for s in (0, 37)) for k, e in set(rows)}


def test_ranges_follow_the_rows_not_the_slices(spark, monkeypatch):
    """Short slices of many rows don't make a task of each."""
    from cardsentry.operators import skew
    made, deal = [], skew.dealt_by_range
    monkeypatch.setattr(skew, "dealt_by_range", lambda rows, order, ranges: made.append(ranges) or deal(rows, order, ranges))
    rows = spark.range(900).selectExpr("id % 7 AS k", "id AS epoch")
    spec = skew.SliceSpec("k", "epoch", ("epoch",), 3, 0)
    got = skew.equal_slices(rows, spec, 2).collect()
    assert made == [8]                                          # the session's shuffle partitions
    own = sorted((r["k"], r["epoch"], r[skew.SLICE]) for r in got if not r[skew.CTX])
    assert [r[2] for r in own] == [i // 2 for i in range(900)]  # consecutive rows, whatever the ranges
    monkeypatch.setattr(skew, "RANGE_ROWS", 50)
    skew.equal_slices(rows, spec, 2)
    skew.equal_slices(rows, spec, 300)
    assert made == [8, 18, 3]
