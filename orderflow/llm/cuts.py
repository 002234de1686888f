"""Written intermediates in the shared folder, and joins that broadcast only what is small."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_root, release

__all__ = ["BROADCAST_ROWS", "Cuts", "by_size", "marked", "release", "unused"]

#: Rows of ids up to which a side is sent to every executor (about 16 MB as a hash table).
BROADCAST_ROWS = 250_000


class Cuts:
    """Tables written once to the folder in `spark.checkpoint.dir` and read back.

    A written table is neither computed again nor lost with an executor. `drop` deletes one that
    nothing reads any more; what the final result still reads stays until the folder is cleaned.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{checkpoint_root(spark)}/llm-{uuid.uuid4().hex}"
        self.paths: dict[int, str] = {}
        self.kept: list[DataFrame] = []

    def cut(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{len(self.kept)}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.kept.append(out)
        self.paths[id(out)] = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for table in tables:
            path = self.paths.pop(id(table), None)
            if path:
                place = jvm.org.apache.hadoop.fs.Path(path)
                place.getFileSystem(conf).delete(place, True)

    def empty(self, df: DataFrame) -> bool:
        return not df.head(1)


def by_size(small: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """`small` with a broadcast hint if it was counted and is small, else as it is.

    `small` must be a written table, so that counting it costs little. The elements of lists count as
    rows, and so do each 64 bytes of texts and binaries.
    """
    weight = F.lit(1)
    for name, kind in small.dtypes:
        if kind.startswith("array"):
            weight = weight + F.coalesce(F.size(name), F.lit(0))
        elif kind in ("string", "binary"):
            weight = weight + F.expr(f"coalesce(octet_length(`{name}`) div 64, 0)")
    return F.broadcast(small) if (small.agg(F.sum(weight)).head()[0] or 0) <= rows else small


def marked(df: DataFrame, key: Column, few: DataFrame, name: str, bits: int) -> DataFrame:
    """`df` with a boolean `name`: false only where `key` is not the key in the only column of `few`.

    What is true may still be none of them, one in `bits` or less. The keys travel as bits of their
    hashes, so a join can leave the other rows of `df` where they are. Null is a key like others.
    """
    size = F.lit(max(1, few.count()) * bits)

    def place(column) -> Column:
        return F.pmod(F.xxhash64(column), size)

    at, bucket, held = (unused(df, c) for c in ("bit_at", "bit_bucket", "bits_held"))
    table = few.select(place(F.col(few.columns[0])).alias("h"))
    table = table.groupBy(F.bitmap_bucket_number("h").alias(bucket)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("h")).alias(held)
    )
    placed = df.withColumn(at, place(key)).withColumn(bucket, F.bitmap_bucket_number(at))
    position = F.bitmap_bit_position(at)
    byte = F.conv(F.hex(F.substring(held, (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.getbit(byte, (position % 8).cast("int")) == 1
    joined = placed.join(F.broadcast(table), bucket, "left")
    return joined.select(*df.columns, F.coalesce(is_set, F.lit(False)).alias(name))


def unused(df: DataFrame, name: str) -> str:
    """`name`, or what is free of it among the columns of `df`."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
