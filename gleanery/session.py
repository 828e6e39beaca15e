"""Session helpers: settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that decide results (UTC dates) or keep wide text rows inside task memory.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Per-key limits up to this many rows are cut inside the map tasks, before the shuffle.
    "spark.sql.optimizer.windowGroupLimitThreshold": "100000",
    # HTML and article bodies are wide: keep Arrow batches small, in rows and in bytes.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
    "spark.sql.execution.pythonUDF.arrow.enabled": "true",
}


def apply_conf(spark: SparkSession) -> SparkSession:
    """Set the recommended SQL settings on a running session."""
    for key, value in RECOMMENDED_CONF.items():
        spark.conf.set(key, value)
    return spark


def small_batches(spark: SparkSession) -> SparkSession:
    """Send few rows and bytes at once to Python: what a worker holds does not grow with its partition."""
    for key in ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"):
        spark.conf.set(key, RECOMMENDED_CONF[key])
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only in local mode, where driver and tasks are one process, is a new temporary folder made
    if the session names none. On a cluster that would be a folder of one machine: an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current is None:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="gleanery-"))
        current = context.getCheckpointDir()
    return current


# Shuffle files of a query are deleted when it ends, not only when the driver collects garbage.
_DELETE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame) -> DataFrame:
    """Write a frame to the shared scratch folder and read it back.

    For results of costly work (HTML parsing) that several branches of a plan need: the work
    runs once, survives lost executors, and later reads take only the columns they need.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    before = spark.conf.get(_DELETE_SHUFFLES, "false")
    spark.conf.set(_DELETE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_DELETE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialize`` wrote. Only for tables that nothing reads any more: what was made of
    them has to be stored itself."""
    for table in tables:
        spark = table.sparkSession
        for folder in {name.rsplit("/", 1)[0] for name in table.inputFiles()}:
            if folder.rsplit("/", 1)[1].startswith("table-"):
                path = spark._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
