"""Session settings that suit the jobs here, and lineage cutting."""

from __future__ import annotations

import gc
import os
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def configure(builder):
    """Settings every job relies on; anything the cluster sets itself is left alone."""
    return (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # A skewed fact-to-dimension join is split even when that costs one more exchange.
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        # Beyond this size the JVM does not compile a method; many small ones are faster then.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
    )


def local_session(cores: int | str = 8, app: str = "orderflow") -> SparkSession:
    """A session for tests and the bench; on a cluster use the one spark-submit gives."""
    spark = (
        configure(SparkSession.builder.master(f"local[{cores}]").appName(app))
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
        .config("spark.driver.memory", os.environ.get("ORDERFLOW_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; in local mode, where none is set, one in the warehouse."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        named = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    spark.sparkContext.setCheckpointDir(named)
    return spark.sparkContext.getCheckpointDir()


_CUTS: list[str] = []


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` once as a table in the shared folder and go on from there.

    For intermediates that several outputs start from: they are neither computed again nor lost
    with an executor, and later steps read only the columns they use.
    """
    path = f"{checkpoint_root(df.sparkSession)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _CUTS.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def drop_cuts(spark: SparkSession) -> None:
    """Delete what `cut_lineage` has written in this process, once its readers are done."""
    while _CUTS:
        _delete(spark, _CUTS.pop())


@contextmanager
def batch_cuts(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end what has been cut inside: the intermediates of a micro-batch."""
    before = len(_CUTS)
    try:
        yield
    finally:
        while len(_CUTS) > before:
            _delete(spark, _CUTS.pop())


def release(spark: SparkSession) -> None:
    """Let the driver collect its garbage, upon which Spark deletes the shuffle files of finished steps.

    Without it they stay until the driver's heap happens to fill, beside those of later steps. What
    the first round lets go holds references that only the second one clears.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)
