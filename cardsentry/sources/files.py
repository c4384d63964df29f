"""File sources and sinks: JSON landing zones, reference snapshots, exports."""
from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

# Raw entity schemas of the landing zone (all ids are strings,
# timestamps ISO-8601 text, as they arrive).
TRANSACTIONS_SCHEMA = (
    "transaction_id string, card_id string, merchant_id string, amount double, currency string, ts string,"
    " event_date date, lat double, lon double, device_id string, entry_mode string, is_fraud boolean,"
    " fraud_type string")
AUTH_SCHEMA = (
    "transaction_id string, approved boolean, reason string, auth_ts string, event_date date")
CHARGEBACKS_SCHEMA = (
    "chargeback_id string, transaction_id string, amount double, reason_code string, settle_ts string,"
    " settle_date date")
TOPICS = {"transactions": TRANSACTIONS_SCHEMA, "auth_events": AUTH_SCHEMA, "chargebacks": CHARGEBACKS_SCHEMA}
# Fixed value: the folder name of a NULL partition value.
HIVE_NULL = "__HIVE_DEFAULT_PARTITION__"
REFERENCE = ("accounts", "cards", "merchants")


def schema_of(spark: SparkSession, ddl: str | StructType) -> StructType:
    """A DDL string (as the schemas above are kept) as a StructType."""
    return ddl if isinstance(ddl, StructType) else spark.createDataFrame([], ddl).schema


def with_lineage(df: DataFrame) -> DataFrame:
    """Bronze lineage columns: ingestion time and source file."""
    return df.withColumn("_ingest_ts", F.current_timestamp()) \
             .withColumn("_source_file", F.col("_metadata.file_path"))


def path_folders(path: Column) -> Column:
    """The ``key=value`` folders of a file's path, as an array of (k, v)."""
    decoded = lambda c: F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))
    return F.transform(F.regexp_extract_all(path, F.lit(r"/([^/=]+=[^/]+)(?=/)"), F.lit(1)),
                       lambda x: F.struct(decoded(F.substring_index(x, "=", 1)).alias("k"), decoded(F.substring(x, F.instr(x, "=") + 1, F.length(x))).alias("v")))


def folder_value(folders: str, key: str) -> Column:
    """The value of the innermost folder with this key; null for a NULL partition."""
    return F.try_element_at(F.filter(folders, lambda x: (x["k"] == key) & (x["v"] != HIVE_NULL)), F.lit(-1))["v"]


def read_jsonl_dataset(spark: SparkSession, topic_dir: str, schema: StructType | None = None) -> DataFrame:
    """All JSON-lines files below a topic folder, in folders of any depth;
    ``key=value`` folders become columns (dates, whole numbers or text, or the
    type that ``schema`` gives the column)."""
    options = {"recursiveFileLookup": "true", "pathGlobFilter": "*.json*"}
    r = spark.read.options(**options)
    if schema is not None:
        r = r.schema(schema)
    df = r.json(topic_dir)
    # types of the folders' values: one aggregate over the files' paths (no file is opened), one row a key
    values = spark.read.format("binaryFile").options(**options).load(topic_dir).select(F.explode(path_folders(F.col("path"))).alias("x")).select("x.k", "x.v")
    like = lambda pattern: F.bool_and((F.col("v") == HIVE_NULL) | F.col("v").rlike(f"^{pattern}$"))
    found = values.groupBy("k").agg(like(r"\d{4}-\d\d-\d\d").alias("dates"), like(r"-?\d{1,18}").alias("whole")).collect()
    types = {f.name: f.dataType for f in df.schema} if schema is not None else {}
    columns = {k: folder_value("_folders", k).try_cast(types.get(k) or ("date" if dates else "bigint" if whole else "string")) for k, dates, whole in found}
    return df.withColumn("_folders", path_folders(F.col("_metadata.file_path"))).withColumns(columns).drop("_folders") if columns else df


def read_reference_array(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A reference file holding one (indented) JSON array of objects."""
    r = spark.read.option("multiLine", True)
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def write_partitioned_jsonl(df: DataFrame, path: str, key: str = "event_date",
                            drop: list[str] | None = None) -> int:
    """Write rows as JSON lines grouped into ``key=value`` folders, replacing the
    folders that get rows; returns the number of rows written.  Rows are clustered
    by the key first, so each folder gets few files."""
    seen = Observation()
    out = df.drop(*(drop or [])).observe(seen, F.count(F.lit(1)).alias("n"))
    out.repartition(key).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).json(path)
    return seen.get["n"]


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Parquet, CSV or a table name; projected to ``columns`` at the scan."""
    if path.endswith(".csv"):
        df = spark.read.option("header", True).option("inferSchema", True).csv(path)
    elif "/" in path or path.endswith(".parquet"):
        df = spark.read.parquet(path)
    else:
        df = spark.read.table(path)
    return df.select(*columns) if columns else df


def merge_schemas(stored: StructType, inferred: StructType) -> tuple[StructType, list[str]]:
    """Widen ``stored`` with fields that only ``inferred`` has (nullable)."""
    names = {f.name for f in stored.fields}
    added = [f for f in inferred.fields if f.name not in names]
    merged = StructType(list(stored.fields) + [f.__class__(f.name, f.dataType, True) for f in added])
    return merged, [f.name for f in added]


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    store, where = _at(spark, path)
    return store.exists(where)


def remove(spark: SparkSession, path: str) -> None:
    store, where = _at(spark, path)
    store.delete(where, True)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file."""
    store, where = _at(spark, path)
    store.create(where, True).close()


def names(spark: SparkSession, path: str) -> list[str]:
    """The names in a small folder; none if it isn't there."""
    store, where = _at(spark, path)
    return [f.getPath().getName() for f in store.listStatus(where)] if store.exists(where) else []


def save_text(spark: SparkSession, value: str, path: str) -> None:
    """Persist a short text beside a table (through Spark, so any shared file
    system the cluster uses works)."""
    spark.createDataFrame([(value,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_text(spark: SparkSession, path: str) -> str | None:
    row = spark.read.text(path).first() if exists(spark, path) else None
    return None if row is None else row[0]


def save_schema(spark: SparkSession, schema: StructType, path: str) -> None:
    save_text(spark, schema.json(), path)


def load_schema(spark: SparkSession, path: str) -> StructType | None:
    text = load_text(spark, path)
    return None if text is None else StructType.fromJson(json.loads(text))
