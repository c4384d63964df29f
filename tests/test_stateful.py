"""State-store feature stream agrees with batch features."""
import math

from pyspark.sql import functions as F

from cardsentry.operators import features as feat
from cardsentry.plans.context import Pipeline
from cardsentry.streaming.stateful import stateful_features

SF = "/root/testdata/sf0.001"


def test_stateful_stream_matches_batch(spark, tmp):
    p = Pipeline.get(spark, SF)
    s = p.silver
    txn = s["transactions"].select(*feat.TXN_COLS).withColumn(   # card 999999 is unknown: NULL home
        "card_id", F.when(F.col("transaction_id") % 50 == 7, F.lit(999999).cast("bigint")).otherwise(F.col("card_id")))
    # land the transactions in event-time order, one file per 5-day slice
    sliced = txn.withColumn("_k", F.floor((F.dayofmonth("event_ts") - 1) / 5))
    for k in sorted(r[0] for r in sliced.select("_k").distinct().collect()):
        sliced.filter(F.col("_k") == k).drop("_k").coalesce(1).write.mode("append").parquet(f"{tmp}/in")
    stream = spark.readStream.schema(txn.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp}/in")
    out = stateful_features(stream, s["cards"], s["merchants"])
    q = (out.writeStream.format("parquet").option("checkpointLocation", f"{tmp}/ck")
         .trigger(availableNow=True).start(f"{tmp}/out"))
    q.awaitTermination()
    got = {r["transaction_id"]: r for r in spark.read.parquet(f"{tmp}/out").collect()}
    want = {r["transaction_id"]: r for r in feat.compute_features(txn, s["cards"], s["merchants"]).collect()}
    assert got.keys() == want.keys()
    bad = []
    for k, w in want.items():
        g = got[k]
        for c in feat.FEATURES:
            a, b = g[c], w[c]
            if a is None or b is None or (isinstance(a, float) and math.isnan(a)):
                ok = (a is None or (isinstance(a, float) and math.isnan(a))) and b is None
            elif isinstance(b, float):
                ok = abs(a - b) <= 1e-9 * max(1.0, abs(b))
            else:
                ok = a == b
            if not ok:
                bad.append((k, c, a, b))
    assert bad == []
    unknown = [r for r in got.values() if r["card_id"] == 999999]
    assert unknown and all(r["geo_distance_from_home_km"] is None for r in unknown)


def test_stateful_scoring_end_to_end(spark, tmp):
    from cardsentry.sources import testdata
    from cardsentry.streaming.scoring import alerts_table
    from cardsentry.streaming.stateful import start_stateful_scoring
    p = Pipeline.get(spark, SF)
    raw = testdata.transactions(spark, SF)
    for k in range(4):
        raw.filter(F.floor((F.dayofmonth("ts") - 1) / 8) == k).coalesce(1).write.mode("append").parquet(f"{tmp}/bronze")
    q = start_stateful_scoring(spark, f"{tmp}/bronze", raw.schema, p.silver["cards"], p.silver["merchants"],
                               f"{tmp}/alerts", f"{tmp}/ck", max_files_per_trigger=1)
    q.awaitTermination()
    out = alerts_table(spark, f"{tmp}/alerts").read()
    assert out.count() == 1000 and out.select("transaction_id").distinct().count() == 1000
    want = {str(r[0]): min(1.0, r[1] / 300.0) for r in raw.select("transaction_id", "amount").collect()}
    assert all(abs(r["fraud_score"] - want[r["transaction_id"]]) < 1e-12 for r in out.collect())


def test_redelivered_rows_change_nothing(spark, tmp):
    p = Pipeline.get(spark, SF)
    s = p.silver
    txn = s["transactions"].select(*feat.TXN_COLS)
    for k in range(2):  # the second batch holds the first one's last hour again, and its own rows twice
        own = txn.filter(F.dayofmonth("event_ts") > 15 if k else F.dayofmonth("event_ts") <= 15)
        late = txn.filter((F.dayofmonth("event_ts") == 15) & (F.hour("event_ts") == 23))
        (own.unionByName(late).unionByName(own) if k else own).write.mode("append").parquet(f"{tmp}/in")
        stream = spark.readStream.schema(txn.schema).parquet(f"{tmp}/in")
        (stateful_features(stream, s["cards"], s["merchants"]).writeStream.format("parquet")
         .option("checkpointLocation", f"{tmp}/ck").trigger(availableNow=True).start(f"{tmp}/out").awaitTermination())
    cols = ["transaction_id", "txn_count_60s", "txn_count_1h", "seconds_since_prev", F.round("amount_zscore", 6).alias("z")]
    got = sorted(spark.read.parquet(f"{tmp}/out").select(*cols).collect())
    assert got == sorted(feat.compute_features(txn, s["cards"], s["merchants"]).select(*cols).collect())


def test_card_step_amounts_and_missing_values():
    import numpy as np
    import pandas as pd
    from cardsentry.streaming.stateful import HISTORY, card_step
    new = pd.DataFrame({"epoch": [10, 20, 30, 30], "ts_us": [10, 20, 30, 31], "transaction_id": [1, 2, 3, 3],
                        "amount_usd": [0.001, np.nan, 0.001, 9.0], "lat": [0.0] * 4, "lon": [0.0] * 4})
    out, kept = card_step({c: np.asarray([], dtype=new[c].dtype) for c in HISTORY}, new)
    assert out["transaction_id"].tolist() == [1, 2, 3] and kept["epoch"].tolist() == [10, 20, 30]
    assert math.isnan(out["card_amount_mean"][0]) and out["card_amount_mean"][2] == 0.001 and math.isnan(out["card_amount_std"][2])
    again, same = card_step(kept, new)
    assert len(again) == 0 and same is kept
    nxt, _ = card_step(kept, new.assign(transaction_id=[5, 6, 7, 8], epoch=[40, 40, 40, 40], ts_us=[1, 2, 3, 4], amount_usd=0.001))
    assert nxt["card_amount_std"].tolist()[-1] == 0.0


class _Value:
    def __init__(self):
        self.v = None

    def exists(self):
        return self.v is not None

    def get(self):
        return self.v

    def update(self, v):
        self.v = v


class _Map(dict):
    def __init__(self):
        super().__init__()
        self.written, self.most = [], 0

    def getValue(self, k):
        return self.get(k)

    def updateValue(self, k, v):
        self[k] = v
        self.written.append(k)
        self.most = max(self.most, len(self))

    def removeKey(self, k):
        self.pop(k, None)


class _Handle:
    def getValueState(self, name, schema):
        return _Value()

    def getMapState(self, name, key, value):
        return _Map()


def _processor(step_rows, page_rows=64):
    from pyspark.sql.types import LongType
    from cardsentry.streaming.stateful import ADDED, COUNTS, HISTORY, CardProcessor
    p = CardProcessor(HISTORY + ADDED + COUNTS, LongType(), step_rows, page_rows)
    p.init(_Handle())
    return p


def _batch(rng, n, lo, hi, first_id):
    import numpy as np
    import pandas as pd
    ep = rng.integers(lo, hi, n)
    ep[: n // 3] = lo + (hi - lo) // 2  # a third in one second
    return pd.DataFrame({"epoch": ep, "ts_us": ep * 1_000_000 + rng.integers(0, 999_999, n), "transaction_id": np.arange(first_id, first_id + n),
                         "amount_usd": np.where(rng.random(n) < 0.1, np.nan, rng.random(n) * 100), "lat": rng.random(n), "lon": rng.random(n)})


def _chunks(pdf, n):
    return (pdf[i:i + n].reset_index(drop=True) for i in range(0, len(pdf), n))


def test_a_hot_card_in_runs_equals_one_step():
    import numpy as np
    import pandas as pd
    rng = np.random.default_rng(3)
    # the second batch holds late rows, and rows of the first again
    one = _batch(rng, 3000, 0, 20_000, 0)
    two = pd.concat([_batch(rng, 3000, 12_000, 40_000, 5000), one[one["epoch"] > 18_000]], ignore_index=True).sample(frac=1, random_state=1)
    whole, runs = _processor(10**9), _processor(200)
    for pdf in (one, two):
        a, b = (pd.concat(list(p.handleInputRows((1,), _chunks(pdf, 70), None))).sort_values("transaction_id", ignore_index=True) for p in (whole, runs))
        pd.testing.assert_frame_equal(a, b)
        assert len(runs.waiting) == 0 and whole.last.v[:len(a)] is not None
        np.testing.assert_equal(whole.last.v, runs.last.v)
        np.testing.assert_equal(dict(whole.hour), dict(runs.hour))
    assert sorted(a["transaction_id"]) == list(range(5000, 8000))


def test_a_step_holds_few_rows_of_a_large_batch():
    import numpy as np
    import pandas as pd
    rng = np.random.default_rng(4)
    ep = np.sort(rng.integers(0, 10**6, 100_000))
    rng.shuffle(ep)
    p = _processor(2000, 200)
    sizes, last = [], -1
    for rows, end in p.steps(_chunks(pd.DataFrame({"epoch": ep, "x": 1}), 500)):
        assert rows["epoch"].min() > last
        last = int(rows["epoch"].max())
        sizes.append(len(rows))
    # a step's rows, and a page of each run: 50 runs of pages of 200
    assert sum(sizes) == len(ep) and max(sizes) <= 2000 + 50 * 200 and len(p.waiting) == 0


def test_a_batch_writes_the_minutes_it_changed():
    import numpy as np
    import pandas as pd
    p = _processor(10**9)
    ep = np.repeat(np.arange(0, 7200), 2)  # two rows a second for two hours
    frame = lambda ep, at: pd.DataFrame({"epoch": ep, "ts_us": ep * 10**6, "transaction_id": np.arange(at, at + len(ep)), "amount_usd": 1.0, "lat": 0.0, "lon": 0.0})
    list(p.handleInputRows((1,), iter([frame(ep, 0)]), None))
    assert len(p.hour) <= 62
    p.hour.written.clear()
    out = pd.concat(p.handleInputRows((1,), iter([frame(np.array([7200, 7201]), 10**6)]), None))
    assert len(p.hour.written) <= 2 and out["_cnt_3600"].tolist() == [7201, 7200]  # 3600..7199 twice and 7200; 3601..7199 twice, 7200 and 7201
    list(p.handleInputRows((1,), iter([frame(np.array([99_999]), 10**7)]), None))
    assert not p.hour and len(p.last.v[0]) == 50


def test_a_hot_card_in_the_stream_equals_the_batch(spark, tmp):
    s = Pipeline.get(spark, SF).silver
    txn = s["transactions"].select(*feat.TXN_COLS).withColumn(
        "card_id", F.when(F.col("transaction_id") % 3 == 0, F.lit(None).cast("bigint")).otherwise(F.col("card_id") % 4))
    for k in range(2):
        txn.filter((F.dayofmonth("event_ts") > 15) == bool(k)).repartition(3).write.mode("append").parquet(f"{tmp}/in")
        stream = spark.readStream.schema(txn.schema).parquet(f"{tmp}/in")
        (stateful_features(stream, s["cards"], s["merchants"], step_rows=40).writeStream.format("parquet")
         .option("checkpointLocation", f"{tmp}/ck").trigger(availableNow=True).start(f"{tmp}/out").awaitTermination())
    cols = ["transaction_id", "card_id", "txn_count_60s", "txn_count_1h", "seconds_since_prev", F.round("amount_zscore", 6).alias("z")]
    got = spark.read.parquet(f"{tmp}/out").select(*cols).orderBy("transaction_id").collect()
    want = feat.compute_features(txn, s["cards"], s["merchants"]).select(*cols).orderBy("transaction_id").collect()
    assert got == want and any(r["card_id"] is None for r in got)


def test_many_cards_in_one_call_equal_card_by_card():
    """A share's cards at once, in steps or whole, against one processor for each card; with
    cards of few rows and many, late and redelivered rows, rows without id and large ids."""
    import numpy as np
    import pandas as pd
    from pyspark.sql.types import LongType
    from cardsentry.streaming.stateful import ADDED, COUNTS, HISTORY, CardsProcessor
    rng, big = np.random.default_rng(5), 2**60

    def share(n, lo, hi, at):
        pdf = _batch(rng, n, lo, hi, big + at).assign(no_id=False)
        return pdf.assign(card_key=[f"card {int(x)}" for x in rng.integers(0, 12, n) ** 2 // 12])

    one = share(2500, 0, 20_000, 0)
    two = pd.concat([share(2500, 12_000, 40_000, 5000), one[one["epoch"] > 18_000]], ignore_index=True).sample(frac=1, random_state=1)
    two.loc[two["transaction_id"] == big + 5003, ["transaction_id", "no_id"]] = [0, True]
    columns = ["card_key", "no_id", *HISTORY, *ADDED, *COUNTS]
    whole, runs, each = CardsProcessor(columns, LongType()), CardsProcessor(columns, LongType(), 200, 64), {}
    rows = []
    for p in (whole, runs):
        p.init(_Handle())
    for pdf in (one, two):
        a, b = (pd.concat(list(p.handleInputRows((1,), _chunks(pdf, 70), None))).sort_values(["transaction_id", "ts_us"], ignore_index=True) for p in (whole, runs))
        pd.testing.assert_frame_equal(a, b)
        assert len(runs.waiting) == 0 and dict(whole.last).keys() == dict(runs.last).keys()
        want = []
        for card, mine in pdf.groupby("card_key"):
            p = each.setdefault(card, _processor(10**9))
            p.columns = columns
            want += p.handleInputRows((card,), iter([mine.reset_index(drop=True)]), None)
            assert str(whole.last[(card,)]) == str(p.last.v) and {m: str(v) for (c, m), v in whole.hour.items() if c == card} == {m: str(v) for (m,), v in p.hour.items()} or pdf is two
        want = pd.concat(want).sort_values(["transaction_id", "ts_us"], ignore_index=True)
        pd.testing.assert_frame_equal(a, want)
        rows.append(len(a))
    assert rows == [2500, 2500] and a["no_id"].sum() == 1 and set(a["transaction_id"]) - {0} == {big + i for i in range(5000, 7500)} - {big + 5003}
