"""Incremental bronze ingest with the file stream source.

Each new file under a landing folder is read exactly once (the checkpoint records
processed files) and its lines are appended to a Parquet bronze folder as they came:
``data`` holds a line's JSON object as a VARIANT with all its fields, whatever their
types, ``_bad_line`` the text of a line that is no JSON object, ``_path`` the
``key=value`` folders of the file, and ``_ingest_ts`` / ``_source_file`` its lineage.
Nothing depends on a schema known in advance, so nothing is lost when files change
while a stream runs.

Readers see a typed view (:func:`read_bronze`, or :func:`typed` on a stream): the
columns of the table's stored schema, and in ``_rescued``, as a JSON object, the fields
that the schema doesn't have or whose value doesn't fit its type.  :func:`evolve` widens the stored
schema by the fields of rows ingested since it last did; they then show in the typed
view of all rows, old ones too.  :func:`quarantine` lists bad lines and misfit values.
"""
from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import ArrayType, MapType, NullType, StructField, StructType, VariantType

from ..sources import files
from ..sources.keyed import KeyedTable

LINEAGE = "_ingest_ts timestamp, _source_file string"
BRONZE = "data variant, _bad_line string, _path array<struct<k:string,v:string>>, " + LINEAGE


def bronze_rows(lines: DataFrame) -> DataFrame:
    """Bronze rows of the lines of text files (``value``); blank lines are none."""
    path = F.col("_metadata.file_path")
    found = F.try_parse_json("value")
    data = F.when(F.schema_of_variant(found).startswith("OBJECT"), found)
    return (lines.where(F.trim("value") != "")
            .select(data.alias("data"), F.when(data.isNull(), F.col("value")).alias("_bad_line"), files.path_folders(path).alias("_path"),
                    F.current_timestamp().alias("_ingest_ts"), path.alias("_source_file")))


def ingest(spark: SparkSession, src: str, dst: str, checkpoint: str, once: bool = True,
           processing_time: str = "10 seconds", max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the stream.  ``once``: process everything pending, then stop
    (availableNow); otherwise run continuously on a processing-time trigger.
    The trigger is set before ``start`` (setting it on a started query has no
    effect)."""
    reader = spark.readStream.option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    writer = (bronze_rows(reader.text(src)).writeStream.format("parquet")
              .option("checkpointLocation", checkpoint)
              .outputMode("append"))
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=processing_time)
    return writer.start(dst)


# ---------------------------------------------------------------- typed view
def _field(name: str, kind: str) -> Column:
    return F.try_variant_get("data", "$['" + name.replace("'", "\\'") + "']", kind)


def _value(f: StructField) -> Column:
    """A field of the object, else of the file's folders."""
    value = _field(f.name, f.dataType.simpleString())
    if isinstance(f.dataType, (ArrayType, MapType, StructType, VariantType)):
        return value
    return F.coalesce(value, files.folder_value("_path", f.name).try_cast(f.dataType))


def _misfits(schema: StructType) -> Column:
    """Names of fields that are there, but not of their type."""
    def wrong(f: StructField) -> Column:
        there = _field(f.name, "variant")
        return F.when(_field(f.name, f.dataType.simpleString()).isNull() & there.isNotNull() & ~F.is_variant_null(there), F.lit(f.name))

    return F.array_compact(F.array(*map(wrong, schema.fields)))


def typed(raw: DataFrame, schema: StructType) -> DataFrame:
    """The bronze objects in the columns of ``schema``, with _rescued (null if all
    fields have found their column) and the lineage.  A projection: a column that
    isn't asked for isn't parsed.  Bad lines are not in it."""
    names = F.array(*[F.lit(n) for n in schema.names])
    wrong = _misfits(schema)
    fields = F.from_json(F.to_json("data"), "map<string,string>")
    rescued = F.map_filter(fields, lambda k, _: ~F.array_contains(names, k) | F.array_contains(wrong, k))
    return raw.where(F.col("data").isNotNull()).select(
        *[_value(f).alias(f.name) for f in schema.fields], F.when(F.size(rescued) > 0, F.to_json(rescued)).alias("_rescued"), "_ingest_ts", "_source_file")


def physical(spark: SparkSession) -> StructType:
    return files.schema_of(spark, BRONZE)


def stored_schema(spark: SparkSession, path: str, base: StructType | str | None = None) -> StructType:
    """The table's stored schema; ``base`` before the first is stored."""
    found = files.load_schema(spark, f"{path}/_schema")
    if found is not None:
        return found
    return files.schema_of(spark, base) if base is not None else StructType([])


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """The bronze rows as they came; none if nothing has been ingested."""
    if not files.exists(spark, path):
        return spark.createDataFrame([], physical(spark))
    return spark.read.schema(physical(spark)).parquet(path)


def read_bronze(spark: SparkSession, path: str, base: StructType | str | None = None) -> DataFrame:
    return typed(read_raw(spark, path), stored_schema(spark, path, base))


def quarantine(raw: DataFrame, schema: StructType) -> DataFrame:
    """(reason, field, value, lineage) of bad lines (the line) and of values that
    don't fit their field's type."""
    bad = raw.where(F.col("_bad_line").isNotNull()).select(F.lit("line").alias("reason"), F.lit(None).cast("string").alias("field"), F.col("_bad_line").alias("value"), "_ingest_ts", "_source_file")
    objects = F.from_json(F.to_json("data"), "map<string,string>")
    misfit = (raw.where(F.col("data").isNotNull()).select(objects.alias("all"), F.explode(_misfits(schema)).alias("field"), "_ingest_ts", "_source_file")
              .select(F.lit("type").alias("reason"), "field", F.try_element_at("all", F.col("field")).alias("value"), "_ingest_ts", "_source_file"))
    return bad.unionByName(misfit)


# ---------------------------------------------------------------- schema
def object_schema(spark: SparkSession, found: str) -> StructType:
    """The fields of a variant schema.  Fields that have only been null have no type
    yet; decimal numbers are doubles, as a narrow decimal won't hold the next value."""
    ddl = re.sub(r"DECIMAL\(\d+,\s*\d+\)", "DOUBLE", found).replace("OBJECT<", "STRUCT<")
    if not ddl.startswith("STRUCT<"):
        return StructType([])
    inner = files.schema_of(spark, f"x {ddl}")["x"].dataType
    return StructType([f for f in inner.fields if not isinstance(f.dataType, NullType)])


def evolve(spark: SparkSession, path: str, base: StructType | str | None = None) -> tuple[StructType, list[str]]:
    """The stored schema widened by the fields of rows that came since the last call
    (only their files are read), and the names of the fields added."""
    stored = stored_schema(spark, path, base)
    mark = files.load_text(spark, f"{path}/_schema_mark")
    rows = read_raw(spark, path)
    if mark is not None:
        rows = rows.where(F.col("_ingest_ts") > F.timestamp_micros(F.lit(int(mark))))
    found, newest = rows.agg(F.schema_of_variant_agg("data"), F.unix_micros(F.max("_ingest_ts"))).first()
    if newest is None:
        return stored, []
    merged, added = files.merge_schemas(stored, object_schema(spark, found))
    files.save_schema(spark, merged, f"{path}/_schema")
    files.save_text(spark, str(newest), f"{path}/_schema_mark")
    return merged, added


# ---------------------------------------------------------------- all tables
def reference_table(spark: SparkSession, bronze: str, name: str) -> KeyedTable:
    """A reference snapshot: each load is a batch, the newest batch is the table."""
    return KeyedTable(spark, f"{bronze}/raw_{name}", "part", "part", many=True)


def load_reference(spark: SparkSession, landing: str, bronze: str) -> None:
    """Load accounts, cards and merchants from the landing arrays beside the earlier
    snapshots, which running readers may still read; the one before the last goes."""
    for name in files.REFERENCE:
        table = reference_table(spark, bronze, name)
        last = table.last_batch()
        df = files.with_lineage(files.read_reference_array(spark, f"{landing}/reference/{name}.json"))
        table.append(df.withColumn("part", F.lit(0)), 0 if last is None else last + 1)
        if last:
            table.drop_before(last)


def ingest_all(spark: SparkSession, landing: str, bronze: str, checkpoints: str,
               once: bool = True) -> dict[str, int]:
    """The three bronze streams, their schemas, and the reference snapshots.  Returns
    the rows that each stream has ingested, from its progress."""
    started = {topic: ingest(spark, f"{landing}/{topic}", f"{bronze}/raw_{topic}", f"{checkpoints}/{topic}/commit", once=once) for topic in files.TOPICS}
    if not once:
        return {}
    rows = {}
    for topic, q in started.items():          # the three streams run concurrently
        q.awaitTermination()
        rows[topic] = sum(p["numInputRows"] for p in q.recentProgress)
        evolve(spark, f"{bronze}/raw_{topic}", files.TOPICS[topic])
    load_reference(spark, landing, bronze)
    return rows


def read_topic(spark: SparkSession, bronze: str, name: str) -> DataFrame:
    """The typed bronze table of a stream or the newest snapshot of a reference table."""
    if name in files.REFERENCE:
        return reference_table(spark, bronze, name).read().drop("part")
    return read_bronze(spark, f"{bronze}/raw_{name}", files.TOPICS[name])
