"""The tables in a JDBC database."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from .schemas import TABLE_COLUMNS, TABLE_KEYS, conform

#: Rows per insert batch.
BATCH = 10_000


def column_types(name: str) -> str:
    """Column types of a table created through JDBC."""
    return TABLE_COLUMNS[name].replace(" int", " INTEGER").upper()


def write_jdbc(
    tables: dict[str, DataFrame],
    url: str,
    props: Mapping[str, str] | None = None,
    *,
    prefix: str = "",
    batch: int = BATCH,
    partitions: int | None = None,
    mode: str = "append",
) -> None:
    """Insert the tables in batches; `partitions` bounds the number of connections at a time."""
    for name, df in tables.items():
        out = conform(df, name)
        if partitions:
            out = out.coalesce(partitions)
        out.write.mode(mode).options(**dict(props or {}), batchsize=str(batch)).option(
            "createTableColumnTypes", column_types(name)
        ).jdbc(url, f"{prefix}{name}")


def read_jdbc(
    spark: SparkSession,
    url: str,
    name: str,
    props: Mapping[str, str] | None = None,
    *,
    prefix: str = "",
    warehouses: int | None = None,
    partitions: int = 1,
    fetch: int = 10_000,
) -> DataFrame:
    """Read a table; with `warehouses`, in ranges of warehouse ids side by side."""
    reader = spark.read.format("jdbc").options(
        **dict(props or {}), url=url, dbtable=f"{prefix}{name}", fetchsize=str(fetch)
    )
    key = TABLE_KEYS[name][0]
    if warehouses and partitions > 1 and key.endswith("w_id"):
        reader = reader.options(
            partitionColumn=key,
            lowerBound="1",
            upperBound=str(warehouses + 1),
            numPartitions=str(min(partitions, warehouses)),
        )
    return reader.load()
