"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job here relies on: UTC session zone (event times are UTC
# instants), AQE with skew-join splitting, Arrow for the few pandas steps.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app_name: str = "fleetlens", extra=None) -> SparkSession:
    """Session for tests, the bench and local runs. On a cluster, pass the
    cluster's own settings through ``extra``; nothing here is cluster-specific."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("FLEETLENS_DRIVER_MEMORY", "8g"))
    )
    for key, value in {**SESSION_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_session_conf(spark: SparkSession) -> None:
    """Set the runtime SQL options the library relies on (idempotent)."""
    for key, value in SESSION_CONF.items():
        if key != "spark.sql.execution.arrow.pyspark.enabled":
            spark.conf.set(key, value)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder named by the cluster in
    ``spark.checkpoint.dir``. Where it is unset, a session on one machine
    (``local[...]``, as in tests) gets a fresh scratch folder; a cluster
    session is an error, because its executors share no local folder."""
    sc = spark.sparkContext
    current = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="fleetlens-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint root for written intermediate
    tables (carry versions, lineage cuts)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/{name}"


#: Folders of intermediate tables that this process has written, by session.
_written: dict[str, list[str]] = {}


def intermediate(spark: SparkSession, path: str) -> str:
    """Note a folder as one that ``drop_intermediate`` may delete."""
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to a fresh shared folder and read it back: readers
    share the result, nothing stays in executor memory, and a lost executor
    costs no recomputation."""
    spark = df.sparkSession
    path = intermediate(spark, scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}"))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_intermediate(spark: SparkSession) -> int:
    """Delete the intermediate tables that this application has written so
    far; returns how many there were. Call it when the results are written:
    what is still lazy can't be computed any more."""
    folders = _written.pop(spark.sparkContext.applicationId, [])
    for path in folders:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return len(folders)
