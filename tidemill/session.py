"""Session settings and the shared folder used for tables that are computed once and read many times."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidemill")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can read, named by ``spark.checkpoint.dir``.

    Where that is unset, the checkpoint folder of the context serves. Only a local session may make one of its
    own: on a cluster a temporary folder would exist on one machine alone, so a missing setting is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
    own = tempfile.mkdtemp(prefix="tidemill-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    context.setCheckpointDir(own)
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/tidemill/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors, and gives the optimizer the true size of the
    result, so that it broadcasts the table only when it really is small.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20  # of an Arrow batch; it ends with the row that passes the bytes


def small_batches(spark: SparkSession) -> None:
    """Bounds the session's Arrow batches for work on whole texts, unless fewer rows are set."""
    rows, size = (f"spark.sql.execution.arrow.{name}" for name in ("maxRecordsPerBatch", "maxBytesPerBatch"))
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, BATCH_ROWS)
    spark.conf.set(size, BATCH_BYTES)


SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the Python workers of the session, so that it need not be installed on every machine.

    Done once per application, also for workers that start later.
    """
    context = spark.sparkContext
    if context.applicationId not in SHIPPED:
        package = os.path.dirname(os.path.abspath(__file__))
        target = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="tidemill-")), "tidemill")
        context.addPyFile(shutil.make_archive(target, "zip", os.path.dirname(package), os.path.basename(package)))
        SHIPPED.add(context.applicationId)
