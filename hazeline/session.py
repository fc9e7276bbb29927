"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "hazeline", cores: str = "*", **conf: str) -> SparkSession:
    """A local session for tests and bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", conf.pop("shuffle_partitions", "8"))
        .config("spark.sql.adaptive.enabled", "true")
        # Test tables are small: let even little partitions keep all cores busy.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", conf.pop("driver_memory", "12g"))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return ready(builder.getOrCreate())


def ready(spark: SparkSession) -> SparkSession:
    """All times are UTC; everything else is left as the session has it."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def work_root(spark: SparkSession) -> str:
    """The shared folder the session names in ``spark.checkpoint.dir``.

    A folder of our own is used only where the setting is absent, and only in
    local mode: on a cluster a machine-local folder would be lost with its node.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="hazeline-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def work_dir(spark: SparkSession, name: str) -> str:
    """A new, unique path below this application's part of the shared work folder."""
    return f"{_application_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _application_dir(spark: SparkSession) -> str:
    return f"{work_root(spark)}/hazeline/{spark.sparkContext.applicationId}"


def clear_work(spark: SparkSession) -> None:
    """Delete what this application kept in the shared folder; frames read from it end here."""
    delete_path(spark, _application_dir(spark))


def delete_path(spark: SparkSession, name: str) -> None:
    """Delete a folder of our own in whatever file system it lies."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stored(df, name: str):
    """Cut lineage through the shared folder: write once, read back.

    Used where a frame feeds several branches and recomputing it would repeat
    shuffles. The copy survives the loss of executors.
    """
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
