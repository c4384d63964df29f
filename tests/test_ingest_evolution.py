"""Ingest without loss: late fields, bad lines and wrong types in one running stream."""
import json
import os

from pyspark.sql import functions as F

from cardsentry.sources import files
from cardsentry.streaming import ingest as ing

BASE = "id string, amount double, event_date date"


def write(root, name, lines):
    path = f"{root}/{os.path.dirname(name)}"
    os.makedirs(path, exist_ok=True)
    with open(f"{root}/{name}", "w", encoding="utf-8") as f:
        f.write("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")


def test_nothing_is_lost_while_a_stream_runs(spark, tmp):
    land, path = f"{tmp}/land", f"{tmp}/bronze/raw"
    write(land, "event_date=2024-01-01/a.json", [{"id": "1", "amount": 2.5}, {"id": "2", "amount": 3}])
    q = ing.ingest(spark, land, path, f"{tmp}/ck", once=False, processing_time="0 seconds")
    try:
        q.processAllAvailable()
        assert sorted(tuple(r)[:3] for r in ing.read_bronze(spark, path, BASE).select("id", "amount", F.col("event_date").cast("string")).collect()) == [("1", 2.5, "2024-01-01"), ("2", 3.0, "2024-01-01")]
        # the same stream, still running on no schema: a late field, a bad line, a wrong type, a nested field, other shapes
        write(land, "event_date=2024-01-02/deep/b.json", [
            {"id": "3", "amount": 1.25, "channel": "app", "device": {"os": "x", "tags": [1, 2]}}, "{\"id\": \"4\", \"amount\":", {"id": "5", "amount": "much"}, "[1, 2]", "", "{\"id\":\"6\",\"id\":\"7\"}", {"id": 8, "amount": None, "event_date": "2024-02-02"}])
        write(land, "c.json", [{"id": "9", "risk": 0.25}, {"id": "10", "risk": 12345.5, "note": None}])
        q.processAllAvailable()
    finally:
        q.stop()
    raw = ing.read_raw(spark, path)
    assert raw.count() == 10 and raw.where("_bad_line is not null").count() == 3
    old = {r.id: r for r in ing.read_bronze(spark, path, BASE).collect()}
    assert json.loads(old["3"]["_rescued"]) == {"channel": "app", "device": '{"os":"x","tags":[1,2]}'} and json.loads(old["5"]["_rescued"]) == {"amount": "much"}
    assert old["1"]["_rescued"] is None and old["5"].amount is None and str(old["8"].event_date) == "2024-02-02" and str(old["3"].event_date) == "2024-01-02" and old["9"].event_date is None
    aside = {(r.reason, r.field, r.value) for r in ing.quarantine(raw, files.schema_of(spark, BASE)).collect()}
    assert aside == {("line", None, '{"id": "4", "amount":'), ("line", None, "[1, 2]"), ("line", None, '{"id":"6","id":"7"}'), ("type", "amount", "much")}
    # widened afterwards, the fields show for the rows that are already there
    schema, added = ing.evolve(spark, path, BASE)
    assert set(added) == {"channel", "device", "risk"} and schema["device"].dataType.simpleString().startswith("struct<os:string")
    new = {r.id: r for r in ing.read_bronze(spark, path).collect()}
    assert new["3"].channel == "app" and new["3"].device.tags == [1, 2] and new["10"].risk == 12345.5 and new["1"].channel is None
    assert all(r["_rescued"] is None for k, r in new.items() if k not in ("5", "10")) and json.loads(new["10"]["_rescued"]) == {"note": None}
    assert ing.evolve(spark, path)[1] == []


def test_inference_reads_new_rows_only(spark, tmp):
    land, path = f"{tmp}/land", f"{tmp}/bronze/raw"
    write(land, "a.json", [{"id": "1", "x": 1}])
    ing.ingest(spark, land, path, f"{tmp}/ck").awaitTermination()
    assert ing.evolve(spark, path, "id string")[1] == ["x"]
    mark = files.load_text(spark, f"{path}/_schema_mark")
    write(land, "b.json", [{"id": "2", "y": "z"}])
    ing.ingest(spark, land, path, f"{tmp}/ck").awaitTermination()
    rows = ing.read_raw(spark, path).where(F.col("_ingest_ts") > F.timestamp_micros(F.lit(int(mark))))
    assert rows.count() == 1 and "PushedFilters: [IsNotNull(_ingest_ts), GreaterThan(_ingest_ts" in rows._jdf.queryExecution().executedPlan().toString()
    assert ing.evolve(spark, path)[1] == ["y"] and ing.stored_schema(spark, path).names == ["id", "x", "y"]


def test_typed_view_parses_only_what_is_asked(spark, tmp):
    write(f"{tmp}/l", "a.json", [{"id": "1", "amount": 5}])
    ing.ingest(spark, f"{tmp}/l", f"{tmp}/b", f"{tmp}/ck").awaitTermination()
    plan = ing.read_bronze(spark, f"{tmp}/b", BASE).select("id")._jdf.queryExecution().optimizedPlan().toString()
    assert "amount" not in plan and "from_json" not in plan
    assert ing.read_bronze(spark, f"{tmp}/none", BASE).columns == ["id", "amount", "event_date", "_rescued", "_ingest_ts", "_source_file"]
