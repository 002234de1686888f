"""Layouts that let scans skip files, in place of primary and secondary indexes."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..session import cut_lineage
from .schemas import TABLE_KEYS

# The secondary orders looked up by.
BY_NAME = ["c_w_id", "c_d_id", "c_last", "c_first"]
BY_CARRIER = ["o_w_id", "o_d_id", "o_carrier_id", "o_id"]
#: Recent lines of all districts lie together: most reads look back a few orders only.
BY_AGE = ["ol_o_id", "ol_w_id", "ol_d_id", "ol_number"]

CLUSTERED = {**TABLE_KEYS, "customer": BY_NAME, "oorder": BY_CARRIER, "order_line": BY_AGE}


#: Tables that every batch of requests is joined with on the whole key.
BUCKETED = frozenset({"stock"})


def ranged(df: DataFrame, keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    """`df` in sorted ranges of `keys`."""
    parts = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    return parts.sortWithinPartitions(*keys)


def write_clustered(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    *,
    partitions: int | None = None,
    mode: str = "errorifexists",
) -> None:
    """Write parquet ranged and sorted by `keys`, so that footers' bounds skip files and row groups.

    Ranges come from a sample over all keys, so that one large warehouse is spread over files.
    """
    ranged(df, keys, partitions).write.mode(mode).parquet(path)


def save_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int | None = None) -> None:
    """Save a table bucketed and sorted by `keys`, for joins on them without a shuffle of it.

    Rows are dealt by the buckets' own hash first, so that there is one file per bucket. `buckets`
    is the number of tasks of a join; by default that of shuffle partitions.
    """
    buckets = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartition(buckets, *keys)
    dealt.write.bucketBy(buckets, *keys).sortBy(*keys).format("parquet").saveAsTable(table)


def save_layout(
    tables: Mapping[str, DataFrame], db: str, folder: str, *, buckets: int | None = None, files: int | None = None
) -> None:
    """Save tables in a new database in `folder`, each in the layout that the operators use.

    Those of `BUCKETED` are joined on their whole key and bucketed by it, the others are ranged by
    what they are looked up by.
    """
    for name, df in tables.items():
        df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{folder}'")
        if name in BUCKETED:
            save_bucketed(df, f"{db}.{name}", TABLE_KEYS[name], buckets)
        else:
            # Ranges are cut from a sample taken beforehand, which would compute the table once more.
            ranged(cut_lineage(df), CLUSTERED[name], files).write.format("parquet").saveAsTable(f"{db}.{name}")


def open_layout(spark: SparkSession, db: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """Tables saved by `save_layout`, as operators take them."""
    return {name: spark.table(f"{db}.{name}") for name in names}
