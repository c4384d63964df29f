"""Append-only keyed tables against a plain dict: replays, moved dates, compaction, null keys."""
import os
import random

import pytest
from pyspark.sql import functions as F

from cardsentry.sources.keyed import KeyedTable

KIND = "k long, event_date date, v string"


def frame(spark, rows):
    return spark.createDataFrame(rows, "k long, d string, v string").select("k", F.col("d").cast("date").alias("event_date"), "v")


def content(table):
    return sorted((r.k, str(r.event_date), r.v) for r in table.read().collect())


def size(root):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet"))


@pytest.mark.parametrize("seed", range(3))
def test_random_batches_equal_a_dict(spark, tmp, seed):
    rng = random.Random(seed)
    table, want = KeyedTable(spark, f"{tmp}/t", "k"), {}
    for batch in range(6):
        rows = [(k, f"2024-01-0{rng.randint(1, 5)}", f"{batch}-{k}") for k in rng.sample(range(30), 8)]
        table.append(frame(spark, rows), batch)
        if rng.random() < 0.5:
            table.append(frame(spark, rows), batch)          # replay
        want |= {k: (k, d, v) for k, d, v in rows}
        assert content(table) == sorted(want.values())
        if rng.random() < 0.6:
            table.compact()
            assert content(table) == sorted(want.values())
            if rng.random() < 0.5:
                table.append(frame(spark, rows), batch)      # replay of a batch that has been compacted
                assert content(table) == sorted(want.values())
    table.compact()
    assert content(table) == sorted(want.values())
    # compacted: no key twice in the live folders, one live folder for each date
    assert table.last_batch() == 5 and table.compact() == []


def test_bytes_written_follow_the_batch(spark, tmp):
    table = KeyedTable(spark, f"{tmp}/t", "k")
    big = spark.range(200_000).select(F.col("id").alias("k"), F.expr("date_add(date'2024-01-01', int(id % 20))").alias("event_date"), F.md5(F.col("id").cast("string")).alias("v"))
    table.append(big, 0)
    table.compact()
    before = size(f"{tmp}/t")
    table.append(big.where("k % 50000 = 7").withColumn("v", F.lit("new")), 1)
    assert size(f"{tmp}/t") - before < before / 500
    touched = table.compact()
    assert len(touched) == len({7 % 20, 50007 % 20, 100007 % 20, 150007 % 20}) and table.read().where("v = 'new'").count() == 4
    assert table.read().count() == 200_000


def test_moved_date_and_null_key(spark, tmp):
    table = KeyedTable(spark, f"{tmp}/t", "k")
    table.append(frame(spark, [(1, "2024-01-01", "a"), (None, "2024-01-01", "n"), (2, None, "b")]), 0)
    table.compact()
    table.append(frame(spark, [(1, "2024-01-05", "moved"), (None, "2024-01-02", "m")]), 1)
    table.append(frame(spark, [(1, "2024-01-05", "moved"), (None, "2024-01-02", "m")]), 1)
    want = [(1, "2024-01-05", "moved"), (2, "None", "b"), (None, "2024-01-01", "n"), (None, "2024-01-02", "m")]
    for _ in range(2):
        assert sorted(((r.k, str(r.event_date), r.v) for r in table.read().collect()), key=str) == sorted(want, key=str)
        table.compact()


def test_a_date_that_loses_all_rows_leaves_nothing_behind(spark, tmp):
    table = KeyedTable(spark, f"{tmp}/t", "k")
    table.append(frame(spark, [(1, "2024-01-01", "a"), (2, "2024-01-02", "b")]), 0)
    table.compact()
    table.append(frame(spark, [(1, "2024-01-02", "c")]), 1)
    table.compact()
    assert content(table) == [(1, "2024-01-02", "c"), (2, "2024-01-02", "b")]
    table.append(frame(spark, [(3, "2024-01-01", "d")]), 2)
    table.compact()
    assert content(table) == [(1, "2024-01-02", "c"), (2, "2024-01-02", "b"), (3, "2024-01-01", "d")]


def test_a_broken_off_compaction_changes_nothing(spark, tmp, monkeypatch):
    table = KeyedTable(spark, f"{tmp}/t", "k")
    table.append(frame(spark, [(1, "2024-01-01", "a"), (2, "2024-01-01", "b"), (3, "2024-01-02", "c")]), 0)
    table.compact()
    table.append(frame(spark, [(1, "2024-01-02", "x"), (4, "2024-01-03", "y")]), 1)
    want = content(table)
    monkeypatch.setattr(KeyedTable, "_remove", lambda self, folders: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        table.compact()
    monkeypatch.undo()
    assert content(table) == want
    table.append(frame(spark, [(2, "2024-01-03", "z")]), 2)
    table.compact()
    assert content(table) == [(1, "2024-01-02", "x"), (2, "2024-01-03", "z"), (3, "2024-01-02", "c"), (4, "2024-01-03", "y")]


def test_declared_table_many_rows_and_new_columns(spark, tmp):
    table = KeyedTable(spark, f"{tmp}/t", "k", many=True)
    with pytest.raises(FileNotFoundError):
        table.read()
    table.create_if_absent(KIND)
    assert table.read().columns == ["k", "event_date", "v"] and table.read().count() == 0 and table.last_batch() is None
    table.append(frame(spark, [(1, "2024-01-01", "a"), (1, "2024-01-01", "b"), (2, "2024-01-01", "c")]), 0)
    table.append(frame(spark, [(1, "2024-01-02", "d"), (1, "2024-01-02", "e")]), 1)
    assert [v for _, _, v in content(table)] == ["d", "e", "c"]
    table.compact()
    assert [v for _, _, v in content(table)] == ["d", "e", "c"]
    table.append(frame(spark, [(2, "2024-01-01", "f")]).withColumn("extra", F.lit(7)), 2)
    assert sorted((r.k, r.v, r.extra) for r in table.read().select("k", "v", F.coalesce("extra", F.lit(0)).alias("extra")).collect()) == [(1, "d", 0), (1, "e", 0), (2, "f", 7)]


def test_date_filter_reaches_the_partitions(spark, tmp):
    table = KeyedTable(spark, f"{tmp}/t", "k")
    for b in range(3):
        table.append(frame(spark, [(10 * b + k, f"2024-01-0{k + 1}", "v") for k in range(5)]), b)
    table.compact()
    table.append(frame(spark, [(1, "2024-01-03", "w")]), 3)
    part = table.read().where("event_date = date'2024-01-02'")
    plan = part._jdf.queryExecution().optimizedPlan().toString()
    # the filter on the compacted rows, above their scan
    assert any("Filter" in line and "<= 5)" in line and "= 2024-01-02)" in line for line in plan.splitlines())
    assert sorted(r.k for r in part.collect()) == [11, 21]


def test_read_as_of_a_batch_and_discard(spark, tmp):
    table = KeyedTable(spark, f"{tmp}/t", "k")
    table.append(frame(spark, [(1, "2024-01-01", "a"), (2, "2024-01-01", "b")]), 0)
    table.compact()
    table.append(frame(spark, [(1, "2024-01-02", "c")]), 1)
    assert sorted(r.v for r in table.read(upto=0).collect()) == ["a", "b"] and sorted(r.v for r in table.read(upto=1).collect()) == ["b", "c"]
    table.discard(1)
    assert sorted(r.v for r in table.read().collect()) == ["a", "b"]
    table.forget([r.event_date for r in table.read().select("event_date").distinct().collect()])
    assert table.read().count() == 0


@pytest.mark.parametrize("seed", range(2))
def test_random_batches_of_a_single_table_equal_a_dict(spark, tmp, seed):
    rng = random.Random(seed)
    table, want = KeyedTable(spark, f"{tmp}/t", "k", single=True), {}
    for batch in range(5):
        rows = [(k, f"2024-01-0{rng.randint(1, 5)}", f"{batch}-{k}") for k in rng.sample(range(30), 8)]
        known = frame(spark, [r for r in rows if r[0] in want]).select("k") if rng.random() < 0.6 else None
        table.append(frame(spark, [*rows, (None, "2024-01-01", f"{batch}")]), batch, replaces=known)
        if rng.random() < 0.4:
            table.append(frame(spark, [*rows, (None, "2024-01-01", f"{batch}")]), batch)      # replay, without the list
        before = dict(want)
        want |= {k: (k, d, v) for k, d, v in rows}
        of = lambda upto=None: sorted((r.k, str(r.event_date), r.v) for r in table.read(upto).where("k is not null").collect())
        assert of() == sorted(want.values()) and table.read().where("k is null").count() == batch + 1
        assert table._mark() > 2 * batch - 2 or not batch or of(batch - 1) == sorted(before.values())
        if rng.random() < 0.4:
            table.compact()
            assert of() == sorted(want.values())
    table.append(frame(spark, [(0, "2024-01-01", "gone")]), 5, replaces=frame(spark, [(0, "2024-01-01", "")]))
    table.discard(5)
    assert of() == sorted(want.values()) and 10 not in table._noted()


def test_a_single_table_is_read_without_a_shuffle_of_its_rows(spark, tmp):
    """Batches that replace little: narrow, pruned scans, no aggregate over whole rows."""
    table = KeyedTable(spark, f"{tmp}/t", "k", single=True)
    for b in range(3):
        table.append(frame(spark, [(10 * b + k, f"2024-01-0{k + 1}", "v") for k in range(5)] + ([(1, "2024-01-03", "w")] if b == 2 else [])), b, replaces=frame(spark, [(1, "2024-01-03", "")] if b == 2 else []))
    part = table.read().where("event_date = date'2024-01-02'").select("k")
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "SortAggregate" not in plan and "v#" not in plan
    assert sorted(r.k for r in part.collect()) == [11, 21]
