"""Sessions and the shared folder for checkpoints and written tables."""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, partitions: int = 8) -> SparkSession:
    """A local session for tests and the benchmark."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tarazi")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TARAZI_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a local one only where that is unset and the session is local, as in tests.

    Also makes the folder the checkpoint directory of the session's context.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    context = spark.sparkContext
    if not folder:
        have = context._jsc.sc().getCheckpointDir()
        if not have.isDefined() and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = have.get() if have.isDefined() else tempfile.mkdtemp(prefix="tarazi-checkpoint-")
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """The rows of ``df``, computed once and read back from a table in the shared folder.

    Like a reliable checkpoint, but the plan runs once instead of twice and the rows are
    columns on disk.  The table lasts as long as the shared folder.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "cut")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _scratch_root(spark: SparkSession) -> str:
    return f"{checkpoint_folder(spark).rstrip('/')}/tarazi-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the application's part of the shared folder, for a table that one query writes and reads."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def published(spark: SparkSession, folder: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A model of the tables in ``folder``, written once an application and state of those tables, and read from then on.

    The state is the names, sizes and times of the folder's files, so a changed input is built
    anew.  A table counts once its writer has marked it as whole.
    """
    hadoop, conf = spark.sparkContext._jvm.org.apache.hadoop.fs.Path, spark.sparkContext._jsc.hadoopConfiguration()
    source = hadoop(folder)
    files = source.getFileSystem(conf).listStatus(source)
    state = hashlib.sha1("|".join(sorted(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}" for f in files)).encode()).hexdigest()
    path = f"{_scratch_root(spark)}-models/{state}/{name}"
    if not hadoop(path).getFileSystem(conf).exists(hadoop(path, "_SUCCESS")):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete the tables that this application's queries wrote to the shared folder; results not yet read are lost."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(root, True)
