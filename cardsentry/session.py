"""Session construction and cluster-safe scratch locations."""
from __future__ import annotations

import logging
import os
import tempfile

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

log = logging.getLogger(__name__)

# Settings every job relies on.  The session time zone is part of the
# semantics (hour-of-day, epoch seconds, dates are UTC), the rest is tuning.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


# Suggested settings for a large cluster (100 TB inputs).  Partition counts
# are an upper bound that AQE coalesces to ~256 MB per task; skew handling is
# on for joins (windows on hot keys are sliced by the library itself).
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def get_session(app: str = "cardsentry", master: str | None = None,
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_utc(spark)
    return spark


# Runtime SQL settings the operators need on any session they are handed:
# UTC semantics, and no partitioning-aware union (on Spark 4.1 it can zip
# children that AQE coalesced to different partition counts and fail).
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.unionOutputPartitioning": "false",
    # PySpark 4 records a Python stack trace for every Column call by default;
    # plan construction is dominated by it, so it is switched off.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def ensure_utc(spark: SparkSession) -> None:
    """All timestamps in the pipeline are interpreted in UTC."""
    for k, v in RUNTIME_CONF.items():
        try:
            if spark.conf.get(k, None) != v:
                spark.conf.set(k, v)
                log.info("session setting %s = %s", k, v)
        except AnalysisException as e:  # a setting that this Spark version fixes at start
            if k == "spark.sql.session.timeZone":
                raise
            log.warning("session setting %s can't be changed: %s", k, e)


STATE_STORE = {"spark.sql.streaming.stateStore.providerClass":
               "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


def use_rocksdb(spark: SparkSession) -> None:
    """Streaming queries started from here on keep state in RocksDB, which ``transformWithState``
    needs; a query that is restarted keeps the store that its checkpoint names."""
    for k, v in STATE_STORE.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
            log.info("session setting %s = %s", k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and job state.

    On a cluster ``spark.checkpoint.dir`` names a shared file system folder;
    it is read from the session and used as is.  Only when it is unset (tests,
    local runs) a scratch folder is created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        conf_dir = tempfile.mkdtemp(prefix="cardsentry-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared checkpoint folder for written intermediate tables."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "tables", name)


def ship_package(spark: SparkSession) -> None:
    """Make ``cardsentry`` importable in Python workers (needed where a
    Python function runs on executors, e.g. ``applyInPandasWithState``).

    The package is zipped once per SparkContext and added with ``addPyFile``,
    which distributes it to every executor, as ``--py-files`` would.
    """
    import zipfile

    sc = spark.sparkContext
    if getattr(sc, "_cardsentry_shipped", False):
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    fd, path = tempfile.mkstemp(prefix="cardsentry-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, names in os.walk(pkg):
            if "__pycache__" in root:
                continue
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(root, n)
                    z.write(full, os.path.join("cardsentry", os.path.relpath(full, pkg)))
    sc.addPyFile(path)
    sc._cardsentry_shipped = True
