"""Throughput and latency of a result log while it grows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.analytics import BACKGROUND, RECENT_SECONDS, per_second, rates
from ..session import batch_cuts, cut_lineage
from ..sources.schemas import log_schema


def read_result_stream(spark: SparkSession, folder: str, **options: str) -> DataFrame:
    """A folder of headed CSV result logs as a stream."""
    reader = spark.readStream.schema(log_schema("result")).option("header", "true")
    return reader.options(**options).csv(folder)


def with_time(result: DataFrame, session_start: str) -> DataFrame:
    """Add the time a transaction ended, from its elapsed milliseconds."""
    start = F.unix_millis(F.lit(session_start).cast("timestamp"))
    return result.withColumn("ended", F.timestamp_millis(start + F.col("elapsed")))


def stream_tpm(timed: DataFrame, bucket: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """Per run and window of `bucket`: counts and mean latency of foreground transactions.

    `timed` is a stream (or a table) with an `ended` time. In append mode a window comes out when
    the watermark has passed it, and rows later than `late` are left out.
    """
    front = timed.filter(F.col("ttype") != BACKGROUND)
    return (
        front.withWatermark("ended", late)
        .groupBy("run", F.window("ended", bucket).alias("w"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("ttype") == "NEW_ORDER").alias("new_orders"),
            F.sum("latency").alias("latency_sum"),
        )
        .select(
            "run",
            F.col("w.start").alias("start"),
            F.col("w.end").alias("end"),
            "n",
            "new_orders",
            (F.col("latency_sum") / F.col("n")).alias("latency"),
        )
    )


def stream_rates(
    result: DataFrame,
    path: str,
    checkpoint: str,
    *,
    recent: int = RECENT_SECONDS,
    interval: str | None = "5 seconds",
) -> StreamingQuery:
    """Throughput so far and over the last `recent` seconds, per run and second, while logs grow.

    The stream's state are the counts per run and second. After each micro-batch the rates are worked
    out from them and replace those of the batch before, in `path/batch=<n>`; so a row that comes
    late still corrects every second after it. Without `interval`, what is there is processed.
    """

    def publish(seconds: DataFrame, batch: int) -> None:
        with batch_cuts(seconds.sparkSession):
            rates(cut_lineage(seconds), recent).write.mode("overwrite").parquet(f"{path}/batch={batch}")

    writer = per_second(result).writeStream.outputMode("complete").foreachBatch(publish)
    writer = writer.option("checkpointLocation", checkpoint)
    writer = (
        writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    )
    return writer.start()


def run_available(
    stream: DataFrame, path: str, checkpoint: str, mode: str = "append"
) -> StreamingQuery:
    """Process what has arrived, into parquet (append) or a fresh table per batch (complete)."""
    if mode == "append":
        writer = stream.writeStream.outputMode("append").format("parquet").option("path", path)
    else:

        def replace(df: DataFrame, batch: int) -> None:
            df.write.mode("overwrite").parquet(f"{path}/batch={batch}")

        writer = stream.writeStream.outputMode(mode).foreachBatch(replace)
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def last_batch(spark: SparkSession, path: str, query: StreamingQuery) -> DataFrame:
    """What the last batch of a complete-mode run has written."""
    return spark.read.parquet(f"{path}/batch={query.lastProgress['batchId']}")
