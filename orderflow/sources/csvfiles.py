"""The ten tables as CSV: fixed column order, comma, no header.

Texts that hold a comma or a quote are quoted, an empty text is a pair of quotes and a null is nothing
between commas. Files without any quotes are read as they are. A line is a row: texts hold no line breaks, so
that large files can be split.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .schemas import TABLE_COLUMNS, conform, table_schema

# File name of each table, and how times are written.
FILES = {
    "config": "config",
    "item": "item",
    "warehouse": "warehouse",
    "district": "district",
    "stock": "stock",
    "customer": "customer",
    "history": "cust-hist",
    "oorder": "order",
    "order_line": "order-line",
    "new_order": "new-order",
}
TIME = "yyyy-MM-dd HH:mm:ss[.SSS]"

#: Column that holds a line which does not fit.
BAD = "__bad"

#: What the reader gives for a pair of quotes, which it could not tell from a null otherwise.
EMPTY = "\u0001"


def _options(null_value: str) -> dict[str, str]:
    return {
        "header": "false",
        "sep": ",",
        "nullValue": null_value,
        "quote": '"',
        "escape": '"',
        "timestampFormat": TIME,
    }


def write_csv(
    tables: dict[str, DataFrame], folder: str, null_value: str = "", mode: str = "errorifexists"
) -> None:
    """Write each table under `folder` in its fixed column order, as one directory per file name."""
    for name, df in tables.items():
        options = {**_options(null_value), "emptyValue": '""', "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSS"}
        conform(df, name).write.mode(mode).options(**options).csv(f"{folder}/{FILES[name]}.csv")


def load_csv(
    spark: SparkSession,
    folder: str,
    names: Iterable[str] | None = None,
    null_value: str = "",
) -> dict[str, DataFrame]:
    """Read the tables under `folder` with their declared types; a line that does not fit is an error."""
    return {
        name: _with_empty_texts(
            _reader(spark, null_value).schema(table_schema(name)).options(mode="FAILFAST").csv(_place(folder, name))
        )
        for name in (TABLE_COLUMNS if names is None else names)
    }


def load_csv_apart(
    spark: SparkSession, folder: str, name: str, null_value: str = ""
) -> tuple[DataFrame, DataFrame]:
    """The rows of one table that fit its columns, and the others as (file, line).

    A line is rejected as a whole if it has too few or too many fields or a value that is not of its
    column's type. Both sides read the files on their own, so that neither is kept in memory.
    """
    reader = _reader(spark, null_value).options(mode="PERMISSIVE", columnNameOfCorruptRecord=BAD, columnPruning="false")
    rows = reader.schema(table_schema(name).add(BAD, StringType())).csv(_place(folder, name))
    # Only fields that are asked for are looked at, so nothing of each column is put after the line.
    line = F.concat_ws("", BAD, *[F.substring(F.col(c).cast("string"), 1, 0) for c in table_schema(name).names])
    good = _with_empty_texts(rows.filter(line == "").drop(BAD))
    bad = rows.filter(line != "").select(F.col("_metadata.file_path").alias("file"), line.alias("line"))
    return good, bad


def _reader(spark: SparkSession, null_value: str):
    return spark.read.options(**_options(null_value), emptyValue=EMPTY)


def _with_empty_texts(df: DataFrame) -> DataFrame:
    """Put empty texts in place of what the reader gives for a pair of quotes."""
    return df.replace(EMPTY, "")


def _place(folder: str, name: str) -> str:
    return f"{folder}/{FILES[name]}.csv"


def insert_tables(tables: dict[str, DataFrame], db: str) -> None:
    """Append the rows to the typed tables of `db`; text too long for its column is an error."""
    for name, df in tables.items():
        spark = df.sparkSession
        order = spark.table(f"{db}.{name}").columns
        conform(df, name).select(*order).write.insertInto(f"{db}.{name}")
