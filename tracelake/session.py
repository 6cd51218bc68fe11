"""Session factory and the shared working folder of a session."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, memory: str = "12g", shuffle_partitions: int = 8) -> SparkSession:
    """A local session with the settings every query assumes: UTC, AQE, Arrow transfer."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tracelake")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, named by ``spark.checkpoint.dir``.

    Only where neither the setting nor a checkpoint directory exists and the master is local,
    as in tests, a temporary folder is made; a cluster without the setting is an error.
    """
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at.rstrip("/")
    jsc = spark.sparkContext._jsc.sc()
    if jsc.getCheckpointDir().isDefined():
        return jsc.getCheckpointDir().get().rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    made = "file://" + tempfile.mkdtemp(prefix="tracelake-")
    spark.sparkContext.setCheckpointDir(made)
    return jsc.getCheckpointDir().get().rstrip("/")


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/tracelake/{spark.sparkContext.applicationId}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder as a table and read it back.

    Unlike a local checkpoint the files outlive the executors that wrote them; unlike an RDD checkpoint
    they are compressed and columnar, so a later pass reads only the columns it needs.
    """
    spark = df.sparkSession
    at = f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(at)
    return spark.read.schema(df.schema).parquet(at)


def clear_written(spark: SparkSession) -> None:
    """Delete the tables that :func:`written` made for this application, once no result that reads them is needed."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def scratch_of(spark: SparkSession) -> str:
    """A fresh path below the shared folder."""
    return f"{_own_folder(spark)}/{uuid.uuid4().hex}"
