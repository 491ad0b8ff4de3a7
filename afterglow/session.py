"""Session building and the few session-level services the operators share."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

PACKAGE_DIR = os.path.dirname(os.path.abspath(__file__))

ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Settings of a local session; on a cluster the submitter's own settings win.
LOCAL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    # joins on (page, day) may use sides dealt by page alone: a page's days are few, and the next step groups by page
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.csv.parser.columnPruning.enabled": "false",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and benches on this machine."""
    builder = SparkSession.builder.master(f"local[{cores}]").config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**LOCAL_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once a session, so that Python workers can import it.

    Functions are then pickled by reference and what a module caches lives as long as its worker. Where the session
    leaves Arrow batches at their default of 10,000 rows, they are made smaller, as whole texts can be long.
    """
    if spark.conf.get(ARROW_ROWS) == "10000":
        spark.conf.set(ARROW_ROWS, "1000")
    context = spark.sparkContext
    if getattr(context, "_afterglow_shipped", False):
        return
    target = os.path.join(tempfile.mkdtemp(prefix="afterglow-"), "afterglow.zip")
    with zipfile.ZipFile(target, "w") as bundle:
        for folder, _, names in os.walk(PACKAGE_DIR):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                bundle.write(path, os.path.join("afterglow", os.path.relpath(path, PACKAGE_DIR)))
    context.addPyFile(target)
    context._afterglow_shipped = True


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage of `df` with a checkpoint in the folder that the cluster shares.

    `spark.checkpoint.dir` is read from the session; only where it is unset (tests on one machine)
    a folder of our own is set. Shuffle files that led to the checkpoint go as soon as it is written.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(spark.sparkContext.getConf().get("spark.checkpoint.dir") or tempfile.mkdtemp(prefix="afterglow-checkpoint-"))
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        return df.select("*").checkpoint(eager=True)  # a plan of its own, made under that setting
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the Parquet tables of `folder`."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
