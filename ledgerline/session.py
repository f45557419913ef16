"""Session defaults and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: str | int = "*", partitions: int = 8) -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ledgerline")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder. Where none is set, a local session gets a temporary one; a cluster must set it."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="ledgerline-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def run_folder(spark: SparkSession) -> str:
    """Folder of everything that this application writes for itself."""
    return f"{shared_dir(spark)}/ledgerline/{spark.sparkContext.applicationId}"


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under that of the run, never reused."""
    return f"{run_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def drop_intermediates(spark: SparkSession) -> bool:
    """Delete what this application wrote for itself, once its results are stored elsewhere or read; other runs keep theirs.

    Results that are not read yet depend on these files. Returns whether there was anything.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once to the shared folder and read back, for results that are used several times."""
    path = new_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
