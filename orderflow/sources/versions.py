"""Table versions: every change is written beside what it was read from, then made current.

`root/v=<n>/<table>` holds a version's changed tables and `root/current/v=<n>` marks it complete.
A reader takes, for each table, the newest complete version that holds it.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


class TableVersions:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path_of(self, place: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place)

    def path(self, *parts: str):
        return self.path_of("/".join([self.root, *parts]))

    def files(self):
        return self.path().getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def complete(self) -> list[int]:
        """Numbers of the complete versions, newest first."""
        return self.marked("current")

    def marked(self, folder: str) -> list[int]:
        """Numbers of the versions with a mark in a folder, newest first."""
        fs, marks = self.files(), self.path(folder)
        if not fs.exists(marks):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(marks)]
        return sorted((int(n[2:]) for n in names if n.startswith("v=")), reverse=True)

    def has(self, version: int) -> bool:
        return self.holds("current", f"v={version}")

    def holds(self, *parts: str) -> bool:
        """Whether a path under the root exists."""
        return self.files().exists(self.path(*parts))

    def next(self) -> int:
        """The number after the newest complete version."""
        return max(self.complete(), default=-1) + 1

    def stage(self, version: int, tables: dict[str, DataFrame], by: Iterable[str] = ()) -> dict[str, DataFrame]:
        """Write tables of a version that is not yet complete, in folders by some columns, and read them back."""
        out = {}
        for name, df in tables.items():
            path = f"{self.root}/v={version}/{name}"
            df.write.mode("overwrite").partitionBy(*by).parquet(path)
            out[name] = self.spark.read.schema(df.schema).parquet(path)
        return out

    def finish(self, version: int) -> None:
        """Mark a version complete."""
        self.files().create(self.path("current", f"v={version}"), True).close()

    def write(self, version: int, tables: dict[str, DataFrame]) -> None:
        """Write a version once; a version left half-written is written over, a complete one kept."""
        if self.has(version):
            return
        self.stage(version, tables)
        self.finish(version)

    def read(self, names: Iterable[str], before: int | None = None) -> dict[str, DataFrame]:
        """The tables as of the newest complete version, or the newest one before a number."""
        return {n: self.spark.read.parquet(f"{self.root}/v={self.newest(n, before)}/{n}") for n in names}

    def newest(self, name: str, before: int | None = None) -> int:
        """The newest complete version that holds a table, or the newest one before a number."""
        fs = self.files()
        for v in self.complete():
            if (before is None or v < before) and fs.exists(self.path(f"v={v}", name)):
                return v
        raise FileNotFoundError(f"no complete version of {name} under {self.root}")

    def results(self, name: str) -> DataFrame | None:
        """A result written with each version, over all complete versions."""
        fs = self.files()
        paths = [
            f"{self.root}/v={v}/{name}"
            for v in self.complete()
            if fs.exists(self.path(f"v={v}", name))
        ]
        return self.spark.read.parquet(*paths) if paths else None
