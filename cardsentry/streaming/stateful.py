"""Stateful streaming features with the Structured Streaming state store.

``Scorer`` (foreachBatch) reuses the batch feature plan and keeps histories in a
table.  This variant keeps each card's bounded history (last 50 rows and the rows
within 3600 s of its newest one) as per-key state of ``transformWithStateInPandas``
in the RocksDB state store, so the work per batch follows the batch:

* ``last``: the newest 50 rows, and which minutes ``hour`` holds with how many rows;
* ``hour``: the other rows of the last hour, an entry for each minute.  A batch writes
  the minutes that it changed and removes those that fell out of the hour;
* ``waiting``: a card's rows of a batch come in no order and may be any number.  Beyond
  ``STEP_ROWS`` they are written here as sorted runs of pages, and merged back in event
  order, so a worker holds a page of each run and the history, not the batch's rows.

The operator's key is a share of the cards, not a card: a call into Python, its frames
and their conversion cost the same for one card's few rows of a batch as for thousands
of rows of many cards.  State is still read and written card by card, for the cards of the
batch only.  Per share and step, arrays sorted by card and event order give what the
batch job gets from its windows (previous row, amount statistics, velocity counts); the
features themselves are ``operators.features.feature_columns``, as in the batch job.
A step ends with a whole second, so rows of one second of one card are in one step.
A transaction that is delivered again is dropped before the step if its id is in
the step or in the card's history; an older one reaches no frame of another
row, and the sink replaces rows by id.
"""
from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import ArrayType, DoubleType, IntegralType, LongType, StringType, StructField, StructType

from ..operators import features as feat
from ..session import ship_package, use_rocksdb

HISTORY = ["epoch", "ts_us", "transaction_id", "amount_usd", "lat", "lon"]
COUNTS = [f"_cnt_{s}" for s in feat.VELOCITY_SECONDS]
ADDED = ["prev_epoch", "prev_lat", "prev_lon", "card_amount_mean", "card_amount_std"]
BLOCK = 65_536  # rows whose amount frames are laid out at once
STEP_ROWS = 50_000  # rows of one card that are handled at once
PAGE_ROWS = 4_096
SHARES = 4_096  # of the cards: the operator's keys
MINUTE = 60


def amount_statistics(amounts: np.ndarray, at: np.ndarray, starts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Mean and sample deviation of the up to AMOUNT_ROWS amounts before each row of ``at`` (NaN: none).
    ``starts``: for each row of ``at`` the first row of its card (else all rows are one card's).

    Frames are shifted by their first amount, so equal amounts deviate by exactly 0.
    """
    padded = np.r_[np.full(feat.AMOUNT_ROWS, np.nan), amounts]
    frames = np.lib.stride_tricks.sliding_window_view(padded, feat.AMOUNT_ROWS)
    mean, std = np.full(len(at), np.nan), np.full(len(at), np.nan)
    for lo in range(0, len(at), BLOCK):
        x = frames[at[lo:lo + BLOCK]]
        known = ~np.isnan(x)
        if starts is not None:
            known &= at[lo:lo + BLOCK, None] + np.arange(-feat.AMOUNT_ROWS, 0) >= starts[lo:lo + BLOCK, None]
        n = known.sum(axis=1)
        first = x[np.arange(len(x)), known.argmax(axis=1)][:, None]
        d = np.where(known, x - first, 0.0)
        with np.errstate(invalid="ignore", divide="ignore"):
            m = d.sum(axis=1) / n
            v = np.where(known, d - m[:, None], 0.0)
            mean[lo:lo + BLOCK] = first[:, 0] + m
            std[lo:lo + BLOCK] = np.where(n > 1, np.sqrt((v * v).sum(axis=1) / (n - 1)), np.nan)
    return mean, std


def card_step(hist: dict, new: pd.DataFrame, end: int | None = None) -> tuple[pd.DataFrame, dict]:
    """(``new`` rows of one card in event order with the columns ADDED and COUNTS,
    the card's new history) given its stored history arrays ``hist`` (columns of HISTORY).

    ``end``: rows after this second may follow, so the history is what they can
    reach; without it the history is the one to keep for later batches."""
    ids = new["transaction_id"]
    again = ids.notna() & (ids.duplicated() | ids.isin(list(hist["transaction_id"])))
    new = new[~again]
    n_h, n_n = len(hist["epoch"]), len(new)
    if not n_n:
        return new.assign(**{c: pd.Series(dtype=float) for c in ADDED + COUNTS}), hist
    col = {c: np.concatenate([np.asarray(hist[c]), new[c].to_numpy()]) for c in HISTORY}
    tid = col["transaction_id"]
    order = np.lexsort((tid.astype(str) if tid.dtype == object else tid, col["ts_us"].astype(np.int64), col["epoch"].astype(np.int64)))
    row = {c: v[order] for c, v in col.items()}
    ep = row["epoch"].astype(np.int64)
    n, idx = len(ep), np.arange(len(ep))
    at = idx[order >= n_h]                              # places of the new rows
    out = new.iloc[order[at] - n_h].reset_index(drop=True)

    before = np.maximum(at - 1, 0)
    for c, name in (("epoch", "prev_epoch"), ("lat", "prev_lat"), ("lon", "prev_lon")):
        out[name] = np.where(at > 0, row[c].astype(float)[before], np.nan)
    out["card_amount_mean"], out["card_amount_std"] = amount_statistics(row["amount_usd"].astype(float), at)
    for c, s in zip(COUNTS, feat.VELOCITY_SECONDS):
        out[c] = np.searchsorted(ep, ep[at], side="right") - np.searchsorted(ep, ep[at] - s, side="left")

    return out, recent({c: row[c] for c in HISTORY}, end)


def recent(row: dict, end: int | None = None) -> dict:
    """Of a card's rows in event order: the last AMOUNT_ROWS up to the second ``end`` (the
    last one), those of the whole minutes that the hour before it touches, and all after it."""
    ep = row["epoch"].astype(np.int64)
    if not len(ep):
        return row
    end = int(ep[-1]) if end is None else end
    first = (end - max(feat.VELOCITY_SECONDS)) // MINUTE * MINUTE
    keep = (np.arange(len(ep)) >= np.searchsorted(ep, end, side="right") - feat.AMOUNT_ROWS) | (ep >= first)
    return {c: v[keep] for c, v in row.items()}


class CardProcessor(StatefulProcessor):
    """One card's rows of a micro-batch -> the same rows with ADDED and COUNTS."""

    def __init__(self, columns: list[str], id_type, step_rows: int = STEP_ROWS, page_rows: int = PAGE_ROWS):
        self.columns, self.step_rows, self.page_rows = columns, step_rows, page_rows
        self.types = {"epoch": LongType(), "ts_us": LongType(), "transaction_id": id_type}

    def init(self, handle) -> None:
        arrays = [StructField(c, ArrayType(self.types.get(c, DoubleType()))) for c in HISTORY]
        whole = [StructField(c, ArrayType(LongType())) for c in ("minutes", "rows")]
        self.last = handle.getValueState("last", StructType(arrays + whole))
        self.hour = handle.getMapState("hour", StructType([StructField("minute", LongType())]), StructType(arrays))
        self.waiting = handle.getMapState("waiting", "run int, page int", "rows binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        hist, held = self.load()
        for new, end in self.steps(rows):
            out, hist = card_step(hist, new, end)
            if len(out):
                yield out[self.columns]
        self.save(recent(hist), held)

    def array(self, c: str, values: list) -> np.ndarray:
        if isinstance(self.types.get(c), StringType):
            return np.asarray(values, dtype=object)
        if c in ("epoch", "ts_us") or (c in self.types and None not in values):
            return np.asarray(values, dtype=np.int64)
        return np.asarray(values, dtype=float)

    def plain(self, c: str, values: np.ndarray) -> list:
        if c in self.types and values.dtype.kind == "f":  # pandas' form of integers with nulls
            return [None if x != x else int(x) for x in values.tolist()]
        return values.tolist()

    def load(self) -> tuple[dict, dict[int, int]]:
        """The history in event order; the minutes that ``hour`` holds, with their rows."""
        if not self.last.exists():
            return {c: self.array(c, []) for c in HISTORY}, {}
        *newest, minutes, counts = self.last.get()
        parts = [self.hour.getValue((m,)) for m in minutes] + [newest]
        return {c: self.array(c, [x for p in parts for x in p[k]]) for k, c in enumerate(HISTORY)}, dict(zip(minutes, counts))

    def save(self, hist: dict, held: dict[int, int]) -> None:
        """Writes the newest rows and the minutes that changed: a minute only gains rows, so one with as many is the same."""
        older = max(0, len(hist["epoch"]) - feat.AMOUNT_ROWS)
        minutes, starts, counts = np.unique(hist["epoch"][:older].astype(np.int64) // MINUTE, return_index=True, return_counts=True)
        now = dict(zip(minutes.tolist(), counts.tolist()))
        for m, at in zip(minutes.tolist(), starts.tolist()):
            if held.get(m) != now[m]:
                self.hour.updateValue((m,), tuple(self.plain(c, hist[c][at:at + now[m]]) for c in HISTORY))
        for m in held.keys() - now.keys():
            self.hour.removeKey((m,))
        self.last.update((*(self.plain(c, hist[c][older:]) for c in HISTORY), list(now), list(now.values())))

    def steps(self, frames: Iterable[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, int | None]]:
        """The rows in parts of ascending seconds, each with the last second that it may hold (None: no rows follow)."""
        pages: list[tuple[int, int, int]] = []  # first second, run, page
        part, n, runs = [], 0, 0
        for f in frames:
            part.append(f)
            n += len(f)
            if n >= self.step_rows:
                pages += self.write_run(pd.concat(part, ignore_index=True), runs)
                part, n, runs = [], 0, runs + 1
        if not pages:
            if n:
                yield pd.concat(part, ignore_index=True), None
            return
        if n:
            pages += self.write_run(pd.concat(part, ignore_index=True), runs)
        pages.sort()
        part, n, low = [], 0, pages[0][0]
        for i, (_, run, page) in enumerate(pages, 1):
            part.append(pickle.loads(self.waiting.getValue((run, page))[0]))
            self.waiting.removeKey((run, page))
            n += len(part[-1])
            if i == len(pages):
                yield pd.concat(part, ignore_index=True), None
            elif n >= self.step_rows and (after := pages[i][0]) > low:
                rows = pd.concat(part, ignore_index=True)
                ready = rows["epoch"] < after  # later pages begin at this second or after it
                yield rows[ready].reset_index(drop=True), after - 1
                part = [rows[~ready]]
                n, low = len(part[0]), after

    def write_run(self, rows: pd.DataFrame, run: int) -> list[tuple[int, int, int]]:
        """Writes the rows by second, in pages; (first second, run, page) of each."""
        rows = rows.sort_values("epoch", kind="stable", ignore_index=True)
        out = []
        for page, at in enumerate(range(0, len(rows), self.page_rows)):
            self.waiting.updateValue((run, page), (pickle.dumps(rows[at:at + self.page_rows]),))
            out.append((int(rows["epoch"][at]), run, page))
        return out


def cards_step(hists: list[dict], new: pd.DataFrame, of: np.ndarray, end: int | None = None) -> tuple[pd.DataFrame, list[dict | None]]:
    """``card_step`` for many cards at once: ``of`` says which of ``hists`` each row of ``new``
    belongs to.  Ids come with a flag ``no_id`` (null), so that they stay what they are.
    Returns the new histories; None for a card that got no new row."""
    columns = [*HISTORY, "no_id"]
    lens = [len(h["epoch"]) for h in hists]
    n_h = sum(lens)
    who = np.r_[np.repeat(np.arange(len(hists)), lens), of]
    col = {c: np.concatenate([*(h[c] for h in hists), new[c].to_numpy()]) for c in columns}
    tid, no_id = col["transaction_id"], col["no_id"].astype(bool)
    keep = no_id | ~pd.DataFrame({"who": who, "tid": tid, "no_id": no_id}).duplicated().to_numpy()
    keep[:n_h] = True
    order = np.lexsort((tid.astype(str) if tid.dtype == object else tid, no_id, col["ts_us"], col["epoch"], who))
    order = order[keep[order]]
    row, who = {c: v[order] for c, v in col.items()}, who[order]
    ep, idx = row["epoch"], np.arange(len(order))
    at = idx[order >= n_h]                              # places of the new rows
    out = new.iloc[order[at] - n_h].reset_index(drop=True)
    if not len(at):
        return out.assign(**{c: pd.Series(dtype=float) for c in ADDED + COUNTS}), [None] * len(hists)

    bounds = np.searchsorted(who, np.arange(len(hists) + 1))
    starts, before = bounds[who[at]], np.maximum(at - 1, 0)
    for c, name in (("epoch", "prev_epoch"), ("lat", "prev_lat"), ("lon", "prev_lon")):
        out[name] = np.where(at > starts, row[c].astype(float)[before], np.nan)
    out["card_amount_mean"], out["card_amount_std"] = amount_statistics(row["amount_usd"], at, starts)
    place = (who << 40) + (ep - ep.min())               # card and second in one order
    for c, s in zip(COUNTS, feat.VELOCITY_SECONDS):
        out[c] = np.searchsorted(place, place[at], side="right") - np.maximum(np.searchsorted(place, place[at] - s, side="left"), starts)

    # the new histories, as ``recent`` has them: up to ``end`` or the card's last row
    last = ep[bounds[1:] - 1]
    if end is not None:
        last = np.minimum(last, end)
    upto = np.searchsorted(place, (np.arange(len(hists)) << 40) + (last - ep.min()), side="right")
    first = (last - max(feat.VELOCITY_SECONDS)) // MINUTE * MINUTE
    kept = (idx >= upto[who] - feat.AMOUNT_ROWS) | (ep >= first[who])
    now, edges = {c: v[kept] for c, v in row.items()}, np.r_[0, np.cumsum(kept)][bounds]
    got = np.bincount(who[at], minlength=len(hists)) > 0
    return out, [{c: v[lo:hi] for c, v in now.items()} if some else None for some, lo, hi in zip(got, edges, edges[1:])]


class CardsProcessor(CardProcessor):
    """A share of the cards: their rows of a micro-batch -> the same rows with ADDED and COUNTS.
    The state is each card's own, by the card's key."""

    def init(self, handle) -> None:
        arrays = [StructField(c, ArrayType(self.types.get(c, DoubleType()))) for c in HISTORY]
        whole = [StructField(c, ArrayType(LongType())) for c in ("minutes", "rows")]
        card = StructField("card", StringType())
        self.last = handle.getMapState("last", StructType([card]), StructType(arrays + whole))
        self.hour = handle.getMapState("hour", StructType([card, StructField("minute", LongType())]), StructType(arrays))
        self.waiting = handle.getMapState("waiting", "run int, page int", "rows binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for new, end in self.steps(rows):
            of, cards = pd.factorize(new["card_key"])
            loaded = [self.load_card(c) for c in cards]
            out, hists = cards_step([hist for hist, _ in loaded], new, of, end)
            for card, hist, (_, held) in zip(cards, hists, loaded):
                if hist is not None:
                    self.save_card(card, hist, held)
            if len(out):
                yield out[self.columns]

    def load_card(self, card: str) -> tuple[dict, dict[int, int]]:
        found = self.last.getValue((card,))
        *newest, minutes, counts = found or [[]] * (len(HISTORY) + 2)
        parts = [self.hour.getValue((card, m)) for m in minutes] + [newest]
        hist = {c: [x for p in parts for x in p[k]] for k, c in enumerate(HISTORY)}
        hist["no_id"] = np.asarray([x is None for x in hist["transaction_id"]], dtype=bool)
        text = isinstance(self.types["transaction_id"], StringType)
        hist["transaction_id"] = np.asarray([("" if text else 0) if x is None else x for x in hist["transaction_id"]], dtype=object if text else np.int64)
        for c in HISTORY:
            if c != "transaction_id":
                hist[c] = np.asarray(hist[c], dtype=np.int64 if c in self.types else float)
        return hist, dict(zip(minutes, counts))

    def save_card(self, card: str, hist: dict, held: dict[int, int]) -> None:
        """As ``save``: the newest rows, and the minutes that changed."""
        lists = {c: hist[c].tolist() for c in HISTORY}
        if hist["no_id"].any():
            lists["transaction_id"] = [None if no else x for x, no in zip(lists["transaction_id"], hist["no_id"])]
        older, now = max(0, len(hist["epoch"]) - feat.AMOUNT_ROWS), {}
        if older:
            minutes, starts, counts = np.unique(hist["epoch"][:older] // MINUTE, return_index=True, return_counts=True)
            now = dict(zip(minutes.tolist(), counts.tolist()))
            for m, at in zip(minutes.tolist(), starts.tolist()):
                if held.get(m) != now[m]:
                    self.hour.updateValue((card, m), tuple(lists[c][at:at + now[m]] for c in HISTORY))
        for m in held.keys() - now.keys():
            self.hour.removeKey((card, m))
        self.last.updateValue((card,), (*(lists[c][older:] for c in HISTORY), list(now), list(now.values())))


def stateful_features(stream: DataFrame, cards: DataFrame, merchants: DataFrame, step_rows: int = STEP_ROWS) -> DataFrame:
    """Feature rows for a stream of staged transactions (one row for each
    transaction), with per-card history in the state store.  The planner decides
    from the dimensions' sizes whether it broadcasts them.  Rows without card are
    one card; rows need an event time.  Sets the session's state store to RocksDB."""
    ship_package(stream.sparkSession)
    use_rocksdb(stream.sparkSession)
    s = feat.with_epoch(stream.select(*feat.TXN_COLS)).withColumn("ts_us", F.unix_micros("event_ts"))
    s = s.join(merchants.select(*feat.MERCHANT_COLS), "merchant_id", "left").join(cards.select(*feat.CARD_COLS), "card_id", "left")
    types = {f.name: f.dataType for f in s.schema.fields}
    no_id = F.lit("" if isinstance(types["transaction_id"], StringType) else 0).cast(types["transaction_id"])
    # the key isn't null: the Python side compares keys by value, and a missing number equals none
    card = F.when(F.col("card_id").isNull(), F.lit("-")).otherwise(F.concat(F.lit("card "), F.col("card_id").cast("string")))
    # whole numbers that may be missing cross as texts, as pandas would make floats of a frame's
    texts = [c for c, t in types.items() if isinstance(t, IntegralType) and c not in ("epoch", "ts_us", "transaction_id")]
    s = s.select(*[F.col(c).cast("string").alias(c) if c in texts else F.col(c) for c in types], card.alias("card_key"), F.col("transaction_id").isNull().alias("no_id"))
    s = s.withColumn("transaction_id", F.coalesce("transaction_id", no_id))
    out_schema = StructType([*s.schema.fields, *(StructField(c, DoubleType()) for c in ADDED), *(StructField(c, LongType()) for c in COUNTS)])
    processor = CardsProcessor(out_schema.names, types["transaction_id"], step_rows)
    share = F.pmod(F.xxhash64("card_key"), F.lit(SHARES)).cast("int")
    rows = s.withColumn("share", share).groupBy("share").transformWithStateInPandas(processor, out_schema, "Append", "None")
    rows = rows.withColumns({c: F.col(c).cast(types[c]) for c in texts} | {"transaction_id": F.when(~F.col("no_id"), F.col("transaction_id"))})
    return feat.feature_columns(rows.withColumn("prev_epoch", F.col("prev_epoch").cast("bigint")))


def start_stateful_scoring(spark, bronze_txn: str, schema, cards: DataFrame, merchants: DataFrame,
                           alerts_root: str, checkpoint: str, score_fn=None, threshold: float = 0.5,
                           once: bool = True, processing_time: str = "10 seconds",
                           max_files_per_trigger: int | None = None, view=lambda rows: rows):
    """bronze transactions -> staged -> state-store features -> score -> appended
    to the serving table as the batch's rows (replay safe).  ``view`` makes raw
    transactions of the files' rows."""
    from ..operators.staging import stg_transactions
    from . import scoring

    score_fn = score_fn or scoring.rule_score
    alerts = scoring.alerts_table(spark, alerts_root)
    alerts.create_if_absent(scoring.ALERT_SCHEMA)
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    staged = stg_transactions(view(r.parquet(bronze_txn))).filter(F.col("event_ts").isNotNull())
    feats = stateful_features(staged, cards, merchants)

    def sink(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        alerts.append(scoring.serving_rows(score_fn(batch), threshold), int(batch_id), order="event_ts")

    w = feats.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if once else w.trigger(processingTime=processing_time)
    return w.start()
