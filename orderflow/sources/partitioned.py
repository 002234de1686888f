"""Tables that change in place: a batch replaces the folders it touches and leaves all others.

Each table lies in folders by part of the warehouses and by batch. Updated tables have one
folder per part, which a batch that names one of its warehouses replaces. New orders, their lines and
payments' history rows are appended as a folder of their own per part and batch; a delivery replaces
the order folders of its warehouses by one.

A batch is staged beside the tables first (`TableVersions`), in the same folders, and then installed.
Installing moves whole folders in place of those they replace and writes no row again, so it can be
repeated after a lost driver. One writer at a time; readers read between batches.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from ..session import release
from .schemas import LAYOUT, TABLE_KEYS
from .versions import TableVersions

PART, BATCH = LAYOUT

#: Tables to which batches append; the others are updated in their one folder per part.
GROWING = {"history", "new_order", "oorder", "order_line"}


#: Batch of the rows that a growing table starts with; batches are numbered from 0.
FIRST = -1


def warehouse_column(table: str) -> str | None:
    """The column with the warehouse that a row belongs to; items belong to none."""
    return {"item": None, "history": "h_w_id"}.get(table, TABLE_KEYS[table][0])


class PartitionedTables:
    """Tables under `root` in `parts` parts by warehouse."""

    def __init__(self, spark: SparkSession, root: str, parts: int = 64):
        self.spark, self.root, self.parts = spark, root.rstrip("/"), parts

    def part_of(self, warehouse: Column) -> Column:
        return F.pmod(F.coalesce(warehouse, F.lit(0)), F.lit(self.parts)).cast("int")

    def placed(self, name: str, df: DataFrame, batch: int | Column) -> DataFrame:
        """`df` with the part and batch of each row."""
        column = warehouse_column(name)
        part = F.lit(0) if column is None else self.part_of(F.col(column))
        batch = F.lit(batch) if isinstance(batch, int) else batch
        return df.withColumns({PART: part, BATCH: batch.cast("int")})

    def create(self, tables: dict[str, DataFrame]) -> None:
        """Write the tables to start from."""
        for name, df in tables.items():
            df.limit(0).write.parquet(f"{self.root}/schema/{name}")
            self.replace(name, self.placed(name, df, FIRST if name in GROWING else 0))
            # The files of its shuffle would stay beside those of later tables and batches.
            release(self.spark)

    def replace(self, name: str, rows: DataFrame) -> None:
        """Replace the folders that `rows` fall into."""
        writer = rows.hint("rebalance", PART).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(PART, BATCH).parquet(f"{self.root}/data/{name}")

    def open(self, names: Iterable[str], parts: list[int] | None = None) -> dict[str, DataFrame]:
        """The tables with part and batch of each row; of some parts only, with `parts`."""
        out = {}
        for name in names:
            schema = self.spark.read.parquet(f"{self.root}/schema/{name}").schema
            df = self.spark.read.schema(schema.add(PART, IntegerType()).add(BATCH, IntegerType())).parquet(f"{self.root}/data/{name}")
            out[name] = df if parts is None or warehouse_column(name) is None else df.filter(F.col(PART).isin(parts))
        return out

    def read(self, names: Iterable[str]) -> dict[str, DataFrame]:
        return {n: df.drop(PART, BATCH) for n, df in self.open(names).items()}

    # --- installing a staged batch ----------------------------------------------------------

    def stage(
        self, versions: TableVersions, version: int, changed: dict[str, DataFrame], before: dict[str, DataFrame],
        rewritten: set[str],
    ) -> dict[str, DataFrame]:
        """Write what a batch changes beside the tables; gives the changed tables as they will be.

        Of a growing table that is not rewritten, only the new rows are written.
        """
        new = {}
        for name, df in changed.items():
            if name not in GROWING:
                new[name] = self.placed(name, df, 0)
            elif name in rewritten:
                new[name] = self.placed(name, df, version)
            else:
                rows = self.placed(name, df, F.coalesce(BATCH, F.lit(version)))
                new[name] = rows.filter(F.col(BATCH) == version)
        staged = {}
        for name, df in new.items():
            staged |= versions.stage(version, {f"table_{name}": df.hint("rebalance", PART)}, by=LAYOUT)
            release(self.spark)
        out = {}
        for name in changed:
            rows = staged[f"table_{name}"]
            kept = name in GROWING and name not in rewritten
            out[name] = before[name].unionByName(rows) if kept else rows
        return out

    def install(self, versions: TableVersions, version: int) -> None:
        """Put a staged batch in place of the folders it replaces; may be repeated."""
        fs = versions.files()
        record = self.spark.read.parquet(f"{versions.root}/v={version}/replaced").collect()
        for row in record:
            staged = versions.path(f"v={version}", f"table_{row['name']}")
            if not fs.exists(staged):
                continue
            self._move(fs, versions, staged, f"{self.root}/data/{row['name']}")
            if row["rewritten"]:
                for part in row["parts"]:
                    folder = versions.path_of(f"{self.root}/data/{row['name']}/{PART}={part}")
                    for status in fs.listStatus(folder) if fs.exists(folder) else ():
                        if status.getPath().getName() != f"{BATCH}={version}":
                            fs.delete(status.getPath(), True)
        fs.create(versions.path("installed", f"v={version}"), True).close()
        for row in record:
            fs.delete(versions.path(f"v={version}", f"table_{row['name']}"), True)

    @staticmethod
    def _move(fs, versions: TableVersions, staged, data: str) -> None:
        """Put the folders of a staged table in place of those of a table; those moved before are left."""
        for part in fs.globStatus(versions.path_of(f"{staged}/{PART}=*/{BATCH}=*")):
            folder = part.getPath()
            target = versions.path_of(f"{data}/{folder.getParent().getName()}/{folder.getName()}")
            fs.delete(target, True)
            fs.mkdirs(target.getParent())
            if not fs.rename(folder, target):
                raise OSError(f"could not move {folder} to {target}")

    def finish(
        self, versions: TableVersions, version: int, changed: Iterable[str], rewritten: set[str], parts: list[int]
    ) -> None:
        """Mark a staged batch as whole, and install it."""
        rows = [(n, n in rewritten, parts) for n in changed]
        record = self.spark.createDataFrame(rows, "name string, rewritten boolean, parts array<int>")
        versions.stage(version, {"replaced": record.coalesce(1)})
        versions.finish(version)
        self.install(versions, version)

    def recover(self, versions: TableVersions) -> None:
        """Install the batches that were staged whole but not put in place."""
        for version in sorted(set(versions.marked("current")) - set(versions.marked("installed"))):
            self.install(versions, version)
