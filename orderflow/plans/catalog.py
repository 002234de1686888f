"""What a registered query is, and how both sides are brought to the same output types."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.bridge import Bridge
from .base_sql import with_ctes

# Output kinds: whole number, floating number, the same rounded to six places, text, time as text.
_SPARK = {
    "i": lambda c: F.col(c).cast("bigint"),
    "f": lambda c: F.col(c).cast("double"),
    "r": lambda c: F.round(F.col(c).cast("double"), 6),
    "s": lambda c: F.col(c).cast("string"),
    "t": lambda c: F.date_format(F.col(c), "yyyy-MM-dd HH:mm:ss"),
}
_DUCK = {
    "i": "cast({c} as bigint)",
    "f": "cast({c} as double)",
    "r": "round(cast({c} as double), 6)",
    "s": "cast({c} as varchar)",
    "t": "strftime({c}, '%Y-%m-%d %H:%M:%S')",
}


@dataclass(frozen=True)
class Query:
    """A query with its output columns (`name:kind …`), its DataFrame and its SQL, if it has one."""

    columns: str
    build: Callable[[Bridge], DataFrame]
    sql: str | None = None

    def parts(self) -> list[tuple[str, str]]:
        return [tuple(c.split(":")) for c in self.columns.split()]

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        df = self.build(Bridge.of(spark, folder))
        return df.select(*[_SPARK[k](c).alias(c) for c, k in self.parts()])

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        out = ", ".join(f"{_DUCK[k].format(c=c)} as {c}" for c, k in self.parts())
        return with_ctes(f"SELECT {out} FROM ({self.sql}) q")


REGISTRY: dict[str, Query] = {}


def register(name: str, columns: str, sql: str | None = None):
    """Register the decorated Bridge -> DataFrame function under `name`."""

    def wrap(build: Callable[[Bridge], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(columns, build, sql)
        return build

    return wrap
