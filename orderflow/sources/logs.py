"""Run logs, machine logs and summaries as headed CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import log_schema

# Columns of the session summary and of the transaction summary, and null in the latter.
SUMMARY = [
    "run",
    "db",
    "sessionStart",
    "runMins",
    "loadWarehouses",
    "runWarehouses",
    "numSUTThreads",
    "limitTxnsPerMin",
    "TpmTOTAL",
    "TpmC",
    "TpmE",
]
TX_SUMMARY = [
    "tx_name",
    "tx_count",
    "tx_percent",
    "tx_90th",
    "tx_max",
    "tx_limit",
    "tx_rbk",
    "tx_error",
    "tx_dskipped",
]
NOT_AVAILABLE = "N/A"
MACHINE = ("sys_info", "blk", "net")
TIME = "yyyy-MM-dd HH:mm:ss[.SSS]"

#: Column that holds a line which does not fit.
BAD = "__bad"


def _read(spark: SparkSession, kind: str, path: str) -> DataFrame:
    return (
        spark.read.schema(log_schema(kind))
        .options(header="true", timestampFormat=TIME, mode="FAILFAST")
        .csv(path)
    )


def read_result(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, "result", path)


def read_run_info(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, "run_info", path)


def write_log(df: DataFrame, kind: str, path: str, mode: str = "append") -> None:
    """Write a log in its column order with a header."""
    schema = log_schema(kind)
    rows = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
    rows.write.mode(mode).options(header="true", timestampFormat="yyyy-MM-dd HH:mm:ss.SSS").csv(path)


def read_os_metrics(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """A machine log: `sys_info`, `blk` or `net`. Devices and batches written apart come back as one table."""
    return _read(spark, kind, path).select(*log_schema(kind).names)


def feed_lines(rows: DataFrame, kind: str) -> DataFrame:
    """Rows of a machine log as lines of the feed: the kind, then the columns as CSV."""
    cols = F.to_csv(F.struct(*[f.name for f in log_schema(kind)]))
    return rows.select(F.concat(F.lit(f"{kind},"), cols).alias("value"))


def tagged(lines: DataFrame) -> DataFrame:
    """Lines of the feed as (kind, value, line), where the value is what follows the first comma."""
    kind = F.substring_index("value", ",", 1)
    rest = F.substr("value", F.length(kind) + 2)
    return lines.select(kind.alias("kind"), rest.alias("value"), F.col("value").alias("line"))


def _parsed(feed: DataFrame, kind: str) -> DataFrame:
    """The lines of one kind with their columns; `__bad` holds a line that does not fit them."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in log_schema(kind))
    row = F.from_csv("value", f"{columns}, {BAD} string", {"columnNameOfCorruptRecord": BAD})
    return feed.filter(F.col("kind") == kind).withColumn("__row", row).select(*feed.columns, "__row.*")


def split_os_metrics(feed: DataFrame) -> dict[str, DataFrame]:
    """The machine logs in one feed of tagged lines (`kind`, `value` as CSV text), each parsed.

    Lines that do not fit the columns of their kind are left to `unfit_lines`.
    """
    out = {}
    for kind in MACHINE:
        good = _parsed(feed, kind).filter(F.col(BAD).isNull())
        out[kind] = good.select(*log_schema(kind).names)
    return out


def unfit_lines(feed: DataFrame) -> DataFrame:
    """The lines of a `tagged` feed that are of no known kind or do not fit the columns of theirs."""
    out = feed.filter(~F.col("kind").isin(*MACHINE)).select("line")
    for kind in MACHINE:
        out = out.union(_parsed(feed, kind).filter(F.col(BAD).isNotNull()).select("line"))
    return out.withColumnRenamed("line", "value")


def write_os_metrics(df: DataFrame, path: str, mode: str = "append") -> None:
    """Write a machine log, a folder per device where there are devices."""
    writer = df.write.mode(mode).option("header", "true")
    if "device" in df.columns:
        writer = writer.partitionBy("device")
    writer.csv(path)


def write_tx_summary(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The transaction summary of each run, in its row order, with N/A for what does not apply.

    A file per run, in a folder `run=<n>`: runs are dealt to tasks, and each is sorted where it lies.
    """
    rows = df.repartition("run").sortWithinPartitions("run", "pos").select("run", *TX_SUMMARY)
    writer = rows.write.mode(mode).partitionBy("run")
    writer.options(header="true", nullValue=NOT_AVAILABLE).csv(path)


def read_tx_summary(spark: SparkSession, path: str) -> DataFrame:
    """The summaries of all runs under `path`, with the run."""
    schema = ", ".join(f"{c} string" for c in TX_SUMMARY)
    reader = spark.read.schema(f"run int, {schema}").options(header="true", nullValue=NOT_AVAILABLE)
    return reader.csv(path).select("run", *TX_SUMMARY)


def session_rows(run_info: DataFrame, summary: DataFrame) -> DataFrame:
    """A summary row per run from its settings and its session summary."""
    rates = summary.select(
        "run",
        F.col("tpm_total").alias("TpmTOTAL"),
        F.col("tpm_c").alias("TpmC"),
        F.col("tpm_e").alias("TpmE"),
    )
    return run_info.join(rates, "run").select(*SUMMARY)


def write_session(df: DataFrame, path: str) -> None:
    """Append summary rows."""
    df.select(*SUMMARY).write.mode("append").options(
        header="true", timestampFormat="yyyy-MM-dd HH:mm:ss.SSS"
    ).csv(path)


def read_session(spark: SparkSession, path: str) -> DataFrame:
    schema = (
        "run int, db string, sessionStart timestamp, runMins int, loadWarehouses int, "
        "runWarehouses int, numSUTThreads int, limitTxnsPerMin int, TpmTOTAL double, TpmC double, "
        "TpmE double"
    )
    return spark.read.schema(schema).options(header="true", timestampFormat=TIME).csv(path)
