"""Token counts kept up to date by deltas: signed changes, additive totals, idempotent commits.

A batch of changes is reduced to one signed delta per source, language and tokenizer version and
written to a folder named after the batch. A folder counts once Spark has marked it complete; a
batch that is complete already is not applied again, and one that broke off is written anew.
Totals are the sum of the latest snapshot and of the deltas it does not contain, and `compact`
writes a new snapshot with the list of the batches in it. One writer at a time.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("source", "lang", "tokenizer")
SUMS = ("n_docs", "n_tokens")
_SCHEMA = "source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint"


def deltas(changes: DataFrame) -> DataFrame:
    """source, lang, tokenizer, n_docs, n_tokens from rows (op, source, lang, tokenizer, tokens, old_tokens).

    `insert` adds a document, `delete` takes one away, `revise` replaces old_tokens by tokens. A
    document that moves to another key is a delete and an insert. Cases: null keys are keys of
    their own, null counts are 0, repeated rows count as often as they occur, an unknown op fails
    the job, no changes give no rows. Other columns are not looked at.
    """
    tokens = F.coalesce(F.col("tokens").cast("bigint"), F.lit(0))
    old = F.coalesce(F.col("old_tokens").cast("bigint"), F.lit(0))
    docs = (
        F.when(F.col("op") == "insert", 1)
        .when(F.col("op") == "delete", -1)
        .when(F.col("op") == "revise", 0)
        .otherwise(F.raise_error(F.concat(F.lit("unknown change: "), F.coalesce("op", F.lit("null")))).cast("int"))
    )
    signed = F.when(F.col("op") == "revise", tokens - old).when(F.col("op") == "delete", -tokens).otherwise(tokens)
    return changes.groupBy(*KEYS).agg(F.sum(docs).alias("n_docs"), F.sum(signed).alias("n_tokens"))


class Rollup:
    """Totals in a shared folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, path: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def _complete(self, kind: str) -> list[str]:
        """Names of the complete folders of a kind, in order."""
        top = self._path(f"{self.folder}/{kind}")
        fs = top.getFileSystem(self._conf)
        if not fs.exists(top):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(top)]
        names = [n for n in names if not n.endswith("-batches")]
        return sorted(n for n in names if fs.exists(self._path(f"{self.folder}/{kind}/{n}/_SUCCESS")))

    @staticmethod
    def _name(batch_id: str) -> str:
        return hashlib.sha256(batch_id.encode()).hexdigest()

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Apply a batch; False if it had been applied before."""
        name = self._name(batch_id)
        if name in self._complete("deltas") or name in self._snapshot()[1]:
            return False
        deltas(changes).write.mode("overwrite").parquet(f"{self.folder}/deltas/{name}")
        return True

    def _snapshot(self) -> tuple[DataFrame, set[str]]:
        names = self._complete("snapshots")
        if not names:
            return self.spark.createDataFrame([], _SCHEMA), set()
        place = f"{self.folder}/snapshots/{names[-1]}"
        within = {r["batch"] for r in self.spark.read.parquet(f"{place}-batches").collect()}
        return self.spark.read.schema(_SCHEMA).parquet(place), within

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, n_docs, n_tokens over all batches applied; empty keys stay out."""
        base, within = self._snapshot()
        paths = [f"{self.folder}/deltas/{n}" for n in self._complete("deltas") if n not in within]
        parts = self.spark.read.schema(_SCHEMA).parquet(*paths) if paths else None
        rows = base if parts is None else base.unionByName(parts)
        summed = rows.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS])
        return summed.filter("n_docs != 0 or n_tokens != 0")

    def compact(self) -> None:
        """Write a snapshot of all batches applied, and drop the deltas in it."""
        within = sorted(self._snapshot()[1] | set(self._complete("deltas")))
        number = len(self._complete("snapshots"))
        place = f"{self.folder}/snapshots/{number:012d}"
        listed = self.spark.createDataFrame([(n,) for n in within], "batch string").coalesce(1)
        # The list is written first: a snapshot without its mark is never read.
        listed.write.mode("overwrite").parquet(f"{self.folder}/snapshots/{number:012d}-batches")
        self.totals().write.mode("overwrite").parquet(place)
        for name in within:
            old = self._path(f"{self.folder}/deltas/{name}")
            old.getFileSystem(self._conf).delete(old, True)
