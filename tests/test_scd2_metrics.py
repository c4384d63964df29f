"""SCD2 cases and metrics against brute force."""
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cardsentry.operators import metrics, scd2

SNAP_DDL = "card_id long, card_type string, home_country string, is_active boolean, device string"
CHECK = ["is_active", "card_type", "home_country"]


def test_scd2_cases(spark):
    s1 = spark.createDataFrame([
        (1, "credit", "A", True, "d1"),    # unchanged
        (2, "credit", "A", True, "d2"),    # changed
        (3, "credit", None, True, "d3"),   # null -> value
        (4, "debit", "B", True, "d4"),     # deleted
        (6, "debit", "B", False, "d6"),    # device-only change: no new version
    ], SNAP_DDL)
    s2 = spark.createDataFrame([
        (1, "credit", "A", True, "d1"), (2, "debit", "A", True, "d2"), (3, "credit", "C", True, "d3"),
        (5, "credit", "Z", True, "d5"),    # new
        (6, "debit", "B", False, "X6"),
    ], SNAP_DDL)
    t1, t2, t3 = "2024-01-01 00:00:00", "2024-01-15 00:00:00", "2024-01-22 00:00:00"
    h = scd2.scd2_apply(None, s1, "card_id", CHECK, t1)
    h = scd2.scd2_apply(h, s2, "card_id", CHECK, t2)
    rows = {(r.card_id, r.valid_from.isoformat()): r for r in h.collect()}
    assert len(rows) == 8
    assert rows[(1, "2024-01-01T00:00:00")].valid_to is None
    assert rows[(2, "2024-01-01T00:00:00")].valid_to == datetime(2024, 1, 15)
    assert rows[(2, "2024-01-15T00:00:00")].card_type == "debit"
    assert rows[(3, "2024-01-15T00:00:00")].home_country == "C"
    assert rows[(4, "2024-01-01T00:00:00")].valid_to == datetime(2024, 1, 15)
    assert rows[(5, "2024-01-15T00:00:00")].valid_to is None
    assert rows[(6, "2024-01-01T00:00:00")].device == "d6" and rows[(6, "2024-01-01T00:00:00")].valid_to is None
    # reappearing key 4
    h3 = scd2.scd2_apply(h, s2.unionByName(s1.filter("card_id = 4")), "card_id", CHECK, t3)
    r4 = sorted((r.valid_from, r.valid_to) for r in h3.filter("card_id = 4").collect())
    assert r4 == [(datetime(2024, 1, 1), datetime(2024, 1, 15)), (datetime(2024, 1, 22), None)]
    # as-of join at the interval bounds: [valid_from, valid_to)
    facts = spark.createDataFrame([(10, 2, datetime(2024, 1, 14, 23, 59, 59)), (11, 2, datetime(2024, 1, 15)),
                                   (12, 4, datetime(2024, 1, 16)), (13, 4, datetime(2024, 1, 22))],
                                  "transaction_id long, card_id long, event_ts timestamp")
    j = {r.transaction_id: r for r in scd2.as_of_join(facts, h3, "card_id", "event_ts", ["card_type", "is_active"]).collect()}
    assert j[10].card_type == "credit" and j[11].card_type == "debit"
    assert j[12].card_type is None and j[13].card_type == "debit"
    assert scd2.current_view(h3).count() == 6


def _brute(scores, labels):
    pos = sum(labels)
    neg = len(labels) - pos
    thr = sorted(set(scores), reverse=True)
    ap, auc, best = 0.0, 0.0, (-1.0, None)
    prev_r = 0.0
    for t in thr:
        tp = sum(1 for s, y in zip(scores, labels) if s >= t and y)
        fp = sum(1 for s, y in zip(scores, labels) if s >= t and not y)
        p = tp / (tp + fp)
        r = tp / pos if pos else None
        if pos:
            ap += (r - prev_r) * p
            prev_r = r
            f1 = 2 * p * r / (p + r) if p + r > 0 else 0.0
            if (f1, t) > best:
                best = (f1, t)
    for s1, y1 in zip(scores, labels):
        if not y1:
            continue
        for s0, y0 in zip(scores, labels):
            if y0:
                continue
            auc += 1.0 if s1 > s0 else 0.5 if s1 == s0 else 0.0
    auc = auc / (pos * neg) if pos and neg else None
    return ap, auc, best


@pytest.mark.parametrize("case", ["ties", "perfect", "all_pos", "random"])
@pytest.mark.parametrize("ranges", [None, 1, 5])
def test_pr_metrics_match_brute_force(spark, case, ranges):
    import random
    rnd = random.Random(7)
    if case == "ties":
        data = [(0.9, 1), (0.9, 0), (0.5, 1), (0.5, 0), (0.5, 0), (0.1, 1), (0.1, 0)]
    elif case == "perfect":
        data = [(0.9, 1), (0.8, 1), (0.3, 0), (0.2, 0)]
    elif case == "all_pos":
        data = [(0.9, 1), (0.4, 1), (0.4, 1)]
    else:
        data = [(round(rnd.random(), 2), int(rnd.random() < 0.3)) for _ in range(200)]
    df = spark.createDataFrame(data, "score double, label int")
    curve = metrics.pr_curve(df, ranges=ranges)
    ap = metrics.average_precision(curve).first()[0]
    auc = metrics.roc_auc(curve).first()[0]
    bt = metrics.best_threshold(curve).first()
    b_ap, b_auc, b_best = _brute([s for s, _ in data], [y for _, y in data])
    assert abs(ap - b_ap) < 1e-12
    if b_auc is None:
        assert auc is None or case == "all_pos"
    else:
        assert abs(auc - b_auc) < 1e-12
    assert bt["threshold"] == b_best[1]
    assert curve.count() == len(set(s for s, _ in data))


def test_classification_report(spark):
    df = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.2, 1), (0.1, 0), (0.05, 0)], "score double, label int")
    rep = {r["class"]: r for r in metrics.classification_report(df, 0.5).collect()}
    assert rep["1"]["precision"] == 0.5 and rep["1"]["recall"] == 0.5 and rep["1"]["support"] == 2
    assert abs(rep["0"]["precision"] - 2 / 3) < 1e-12 and rep["0"]["support"] == 3
    assert rep["accuracy"]["f1_score"] == 0.6


def test_time_and_quantile_split(spark):
    df = spark.createDataFrame([(f"2024-01-{d:02d}",) for d in range(1, 11)], "event_date string") \
        .select(F.col("event_date").cast("date").alias("event_date"))
    q = metrics.quantile_split(df).groupBy("split").count()
    assert {r["split"]: r["count"] for r in q.collect()} == {"train": 8, "test": 2}
    t = metrics.time_split(df, "2024-01-05").groupBy("split").count()
    assert {r["split"]: r["count"] for r in t.collect()} == {"train": 4, "test": 6}


def test_duplicate_chargebacks_do_not_fan_out_the_fact(spark):
    """Two chargebacks for one transaction: one fact row, earliest reason."""
    from cardsentry.operators import gold
    from cardsentry.operators.features import OUTPUT_COLS
    feats = spark.createDataFrame([(1,), (2,)], "transaction_id long")
    for c in OUTPUT_COLS:
        if c != "transaction_id":
            feats = feats.withColumn(c, F.lit(None).cast("string") if c in ("entry_mode", "merchant_category",
                                                                            "fraud_type_label") else F.lit(None))
    feats = feats.withColumn("event_ts", F.lit("2024-01-01 10:00:00").cast("timestamp"))
    auth = spark.createDataFrame([], "transaction_id long, is_approved boolean, decline_reason string")
    cb = spark.createDataFrame(
        [("CB2", 1, "dispute", datetime(2024, 1, 20)), ("CB1", 1, "fraud", datetime(2024, 1, 12))],
        "chargeback_id string, transaction_id long, reason_code string, settle_ts timestamp")
    fact = {r.transaction_id: r for r in gold.fct_transactions(feats, auth, cb).collect()}
    assert len(fact) == 2
    assert fact[1].is_confirmed_fraud and fact[1].chargeback_reason == "fraud"
    assert not fact[2].is_confirmed_fraud and fact[2].is_approved


def test_scd2_table_matches_in_memory_history_and_replays(spark, tmp):
    from cardsentry.sources import testdata
    sf = "/root/testdata/sf0.001"
    s1, s2 = testdata.card_snapshot(spark, sf, 1), testdata.card_snapshot(spark, sf, 2)
    t1, t2, t3 = testdata.SNAPSHOT_1, testdata.SNAPSHOT_2, testdata.SNAPSHOT_3
    table = scd2.SCD2Table(spark, f"{tmp}/cards_scd2")
    for snap, t in [(s1, t1), (s2, t2), (s1, t3)]:
        table.apply(snap, "card_id", testdata.CARD_CHECK_COLS, t)
    table.apply(s1, "card_id", testdata.CARD_CHECK_COLS, t3)          # replay of the last apply
    want = None
    for snap, t in [(s1, t1), (s2, t2), (s1, t3)]:
        want = scd2.scd2_apply(want, snap, "card_id", testdata.CARD_CHECK_COLS, t)
    cols = want.columns
    assert sorted(table.history().select(*cols).collect()) == sorted(want.collect())


def test_as_of_join_edges(spark):
    """Gaps, equal times, facts before the first version, nulls, inner joins, and slices."""
    import random
    from cardsentry.operators import scd2
    rng = random.Random(5)
    versions, t = [], {}
    for k in (1, 2):
        at = 100
        for v in range(60):
            end = at + rng.randint(1, 20)
            versions.append((k, f"{k}-{v}", at, end if v < 59 else None))
            at = end + rng.choice([0, 0, 5])
    versions.append((None, "none", 0, None))
    facts = [(i, rng.choice([1, 1, 1, 1, 2, 3, None]), rng.choice([None, *range(80, 1500, 1)])) for i in range(900)]
    stamp = lambda c: F.timestamp_seconds(c)
    h = spark.createDataFrame(versions, "k long, v string, a long, b long").select("k", "v", stamp(F.col("a")).alias("valid_from"), stamp(F.col("b")).alias("valid_to"))
    f = spark.createDataFrame(facts, "id long, k long, t long").withColumn("ts", stamp(F.col("t")))
    want = {i: next((v for kk, v, a, b in versions if kk == k and t is not None and a <= t and (b is None or t < b)), None) if k is not None else None for i, k, t in facts}
    for hot in (None, 100, 7):
        got = scd2.as_of_join(f, h, "k", "ts", ["v"], hot_rows=hot)
        assert got.columns == ["id", "k", "t", "ts", "v", "valid_from", "valid_to"]
        assert {r.id: r.v for r in got.collect()} == want and got.count() == len(facts)
        inner = scd2.as_of_join(f, h, "k", "ts", ["v"], "inner", hot_rows=hot)
        assert {r.id: r.v for r in inner.collect()} == {i: v for i, v in want.items() if v}


def test_as_of_join_in_short_slices_makes_few_tasks(spark, monkeypatch):
    """A key with a version at every third second, cut into slices of three rows: the plain
    join's rows, from a few ranges; rows without key, gaps, and a version that spans slices."""
    from cardsentry.operators import skew
    made, deal = [], skew.dealt_by_range
    monkeypatch.setattr(skew, "dealt_by_range", lambda rows, order, ranges: made.append(ranges) or deal(rows, order, ranges))
    at = "timestamp_seconds(1700000000 + {})"
    facts = spark.range(400).selectExpr("id", "CASE WHEN id % 5 = 0 THEN NULL WHEN id < 350 THEN 1 ELSE 2 END AS k", f"{at.format('id')} AS ts")
    open_ended = "CASE WHEN id <> 99 THEN " + at.format("id * 3 + 2") + " END"
    many = spark.range(100).where("id < 40 OR id > 90").selectExpr("1 AS k", f"{at.format('id * 3')} AS valid_from", f"{open_ended} AS valid_to", "id AS version")
    versions = many.unionByName(spark.sql(f"SELECT 2 AS k, {at.format('-9')} AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, 700L AS version"))
    plain, cut = (sorted(map(str, scd2.as_of_join(facts, versions, "k", "ts", ["version"], hot_rows=n).collect())) for n in (None, 3))
    assert cut == plain and sum("version=700," in r for r in plain) == 40
    assert made and max(made) <= 8
