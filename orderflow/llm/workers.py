"""Python on the executors: Arrow batches in, Arrow batches out, with this package at hand."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the executors, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    folder = tempfile.mkdtemp(prefix="modules-")
    bundle = os.path.join(folder, f"{package.name}-modules.zip")
    with zipfile.ZipFile(bundle, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    context.addPyFile(bundle)
    _shipped.add(context.applicationId)


def give_back() -> None:
    """Return what a task has freed to the system, since its worker waits for the next task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def map_batches(df: DataFrame, function: Callable, schema) -> DataFrame:
    """`df.mapInArrow` with the package shipped; `schema` as a text or a StructType."""
    ship(df.sparkSession)

    def run(batches):
        yield from function(batches)
        give_back()

    return df.mapInArrow(run, schema)
