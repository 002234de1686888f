"""The machine feed as it grows: lines of three kinds in one folder, split by kind and device."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..sources.logs import split_os_metrics, tagged, unfit_lines, write_os_metrics

#: Folder of the lines that fit no kind.
REJECTED = "rejected"


def stream_os_feed(
    spark: SparkSession, folder: str, path: str, checkpoint: str, *, interval: str | None = "5 seconds"
) -> StreamingQuery:
    """Read the feed's text files once and write each line to the log of its kind, under `path`.

    Each kind has a folder, in it one per micro-batch and device, which `read_os_metrics` reads as one
    table; lines of another kind or with other columns go to `rejected` as they came. A repeated
    micro-batch replaces its own folders, so no line is there twice. Without `interval`, what is
    there is processed.
    """

    def publish(lines: DataFrame, batch: int) -> None:
        lines.persist()
        feed = tagged(lines)
        for kind, rows in split_os_metrics(feed).items():
            write_os_metrics(rows, f"{path}/{kind}/batch={batch}", "overwrite")
        unfit_lines(feed).write.mode("overwrite").text(f"{path}/{REJECTED}/batch={batch}")
        lines.unpersist()

    writer = spark.readStream.text(folder).writeStream.foreachBatch(publish)
    writer = writer.option("checkpointLocation", checkpoint)
    writer = (
        writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    )
    return writer.start()
