"""The consistency checks repeated at an interval."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.audit import FACTS, judge_facts
from ..sources.versions import TableVersions

NEEDED = ["warehouse", "district", "new_order", "customer", "oorder", "stock", "order_line"]


def facts_of(versions: TableVersions, version: int, folder: str) -> dict[str, DataFrame]:
    """The facts of all tables as of a version; only what no earlier look has gathered is read."""
    spark, kept = versions.spark, TableVersions(versions.spark, folder)
    facts = {}
    for name in NEEDED:
        at = versions.newest(name, before=version + 1)
        if not kept.holds(f"v={at}", name, "_SUCCESS"):
            table = spark.read.parquet(f"{versions.root}/v={at}/{name}")
            FACTS[name](table).write.mode("overwrite").parquet(f"{kept.root}/v={at}/{name}")
        facts[name] = spark.read.parquet(f"{kept.root}/v={at}/{name}")
    return facts


def watch_checks(
    spark: SparkSession,
    root: str,
    out: str,
    checkpoint: str,
    interval: str | None = "60 seconds",
    optional: bool = False,
) -> StreamingQuery:
    """Check every complete version under `root` once, as they are completed.

    A version's facts are gathered from the tables that it has written and kept in
    `<out>-facts`; those of the other tables are the ones of earlier versions.
    The violations of version n go to `out/version=n`, a folder that is written even if there are
    none; versions that have one are not checked again, whichever run or checkpoint wrote it.
    Without `interval`, what is there is checked once.
    """
    versions = TableVersions(spark, root)

    def check(batch: DataFrame, batch_id: int) -> None:
        done = TableVersions(spark, out)
        for version in sorted(versions.complete()):
            if not done.holds(f"version={version}", "_SUCCESS"):
                found = judge_facts(facts_of(versions, version, f"{out}-facts"), optional)
                found.write.mode("overwrite").parquet(f"{out}/version={version}")

    # The marks of complete versions are empty files, so only their names are read.
    marks = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .load(f"{root}/current")
        .select("path")
    )
    writer = marks.writeStream.foreachBatch(check).option("checkpointLocation", checkpoint)
    writer = (
        writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    )
    return writer.start()
