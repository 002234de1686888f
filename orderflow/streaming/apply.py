"""Request files applied to tables as they arrive, and the delivery queue."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.delivery import QUEUED, delivery
from ..operators.new_order import new_order
from ..operators.order_status import order_status
from ..operators.payment import payment
from ..operators.stock_level import stock_level
from ..session import batch_cuts, cut_lineage
from ..sources.partitioned import PartitionedTables
from ..sources.schemas import REQUEST_COLUMNS
from ..sources.versions import TableVersions

TABLES = [
    "warehouse",
    "district",
    "customer",
    "history",
    "new_order",
    "oorder",
    "order_line",
    "item",
    "stock",
]

#: Growing tables of which a delivery changes rows that are there.
REWRITTEN = {"new_order", "oorder", "order_line"}

#: A request row of any type: the columns of all request tables side by side.
ENVELOPE = (
    "req_seq bigint, ttype string, w_id bigint, d_id bigint, c_w_id bigint, c_d_id bigint, "
    "c_id bigint, c_last string, h_amount decimal(6,2), threshold int, o_carrier_id int, "
    "lines array<struct<slot:int,ol_i_id:bigint,ol_supply_w_id:bigint,ol_quantity:int>>"
)


def envelope(req: DataFrame, ttype: str) -> DataFrame:
    """Requests of one type as envelope rows."""
    have = set(req.columns)
    cols = []
    for f in StructType.fromDDL(ENVELOPE):
        if f.name == "ttype":
            cols.append(F.lit(ttype).alias("ttype"))
        else:
            value = F.col(f.name) if f.name in have else F.lit(None)
            cols.append(value.cast(f.dataType).alias(f.name))
    return req.select(*cols)


def open_envelope(batch: DataFrame, ttype: str) -> DataFrame:
    """The requests of one type in a batch."""
    names = [f.name for f in StructType.fromDDL(REQUEST_COLUMNS[ttype.lower()])]
    return batch.filter(F.col("ttype") == ttype).select(*names)


def apply_batch(
    tables: dict[str, DataFrame], batch: DataFrame, as_of: str, types: Iterable[str], settle, keep
) -> list[str]:
    """Apply a batch in the order new orders, payments, deliveries, reads; names the tables changed.

    `settle` writes changed tables and gives them back as written, `keep` writes results. Only the
    types present are applied, so that untouched tables are not rewritten; reads look at the tables
    as written.
    """
    types = set(types)
    before = dict(tables)
    results: dict[str, DataFrame] = {}
    for ttype, step in (("NEW_ORDER", new_order), ("PAYMENT", payment), ("DELIVERY", delivery)):
        if ttype in types:
            done = step(tables, open_envelope(batch, ttype), as_of)
            tables = done.tables
            results[f"result_{ttype.lower()}"] = done.result
            results[f"errors_{ttype.lower()}"] = done.errors
    changed = {n: df for n, df in tables.items() if df is not before[n]}
    tables = {**tables, **settle(changed)}
    keep(results)
    if "ORDER_STATUS" in types:
        asked = open_envelope(batch, "ORDER_STATUS")
        keep({"result_order_status": order_status(tables, asked)})
    if "STOCK_LEVEL" in types:
        asked = open_envelope(batch, "STOCK_LEVEL")
        keep({"result_stock_level": stock_level(tables, asked)})
    return list(changed)


def _fresh(versions: TableVersions, batch: DataFrame, queue: str) -> DataFrame:
    """The batch's rows from files of this queue that no complete batch has applied, written once."""
    applied = versions.results("applied")
    if applied is not None:
        seen = applied.filter(F.col("queue") == queue).select("file").distinct()
        batch = batch.join(seen, "file", "left_anti")
    return cut_lineage(batch)


def touched_parts(tables: PartitionedTables, batch: DataFrame) -> list[int]:
    """The parts of all warehouses that a batch names; no more than there are parts."""
    named = [F.col(c) for c in ("w_id", "c_w_id") if c in batch.columns]
    every = F.array(*named)
    if "lines" in batch.columns:
        supplying = F.transform("lines", lambda x: x["ol_supply_w_id"])
        every = F.concat(every, F.coalesce(supplying, F.array().cast("array<bigint>")))
    found = batch.select(F.explode(every).alias("w")).filter("w is not null")
    return sorted(r[0] for r in found.select(tables.part_of(F.col("w"))).distinct().collect())


def _files(batch: DataFrame, queue: str) -> DataFrame:
    return batch.select(F.lit(queue).alias("queue"), "file").distinct()


def unknown_types(batch: DataFrame) -> DataFrame:
    """An error row for every request of a type that is not known."""
    known = F.coalesce(F.lower("ttype").isin(*REQUEST_COLUMNS), F.lit(False))
    text = F.concat(F.lit("unknown request type "), F.coalesce("ttype", F.lit("null")))
    return batch.filter(~known).select(
        "req_seq", F.lit(None).cast("int").alias("code"), text.alias("message")
    )


def start_tables(spark: SparkSession, root: str, tables: dict[str, DataFrame], parts: int = 64) -> PartitionedTables:
    """Lay out the tables that `stream_apply` and `drain_deliveries` change under `root`."""
    laid = PartitionedTables(spark, f"{root}/tables", parts)
    laid.create(tables)
    return laid


def stream_apply(
    spark: SparkSession,
    requests: str,
    root: str,
    checkpoint: str,
    as_of: str,
    *,
    parts: int = 64,
    files_per_batch: int = 1000,
    once: bool = True,
) -> StreamingQuery:
    """Apply request files (parquet envelopes) to the tables that `start_tables` laid out in `root`.

    Each micro-batch takes the next free number, reads the parts of the warehouses it names and
    replaces only their folders, or adds to them. Its results, and which files it applied, are kept
    under its number. Files that a complete batch has recorded are left out, whatever stream or
    checkpoint brings them again, so each request is applied once. One writer per `root` at a time.
    """
    versions = TableVersions(spark, f"{root}/batches")
    laid = PartitionedTables(spark, f"{root}/tables", parts)

    def apply(batch: DataFrame, batch_id: int) -> None:
        with batch_cuts(spark):
            apply_whole(batch)

    def apply_whole(batch: DataFrame) -> None:
        laid.recover(versions)
        batch = _fresh(versions, batch, requests)
        version = versions.next()
        known = [t.upper() for t in REQUEST_COLUMNS]
        counts = batch.agg(
            F.count("*").alias("all"), *[F.count_if(F.col("ttype") == t).alias(t) for t in known]
        ).first()
        if not counts["all"]:
            return
        types = [t for t in known if counts[t]]
        touched = touched_parts(laid, batch)
        # History rows are numbered on from the last one of all warehouses.
        tables = {**laid.open(TABLES, touched), **laid.open(["history"])}
        rewritten = REWRITTEN if "DELIVERY" in types else set()
        changed = apply_batch(
            tables,
            batch,
            as_of,
            types,
            lambda t: laid.stage(versions, version, t, tables, rewritten),
            lambda r: versions.stage(version, r),
        )
        versions.stage(
            version, {"applied": _files(batch, requests), "errors_unknown": unknown_types(batch)}
        )
        laid.finish(versions, version, changed, rewritten, touched)

    stream = (
        spark.readStream.schema(ENVELOPE)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(requests)
        .select("*", F.col("_metadata.file_path").alias("file"))
    )
    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer
    return writer.start()


# --- delivery queue ----------------------------------------------------------------------------


def enqueue_deliveries(req: DataFrame, queue: str, due: str) -> DataFrame:
    """Put delivery requests into the queue folder; the answer says they are queued."""
    queued = req.select("req_seq", "w_id", "o_carrier_id", F.lit(due).cast("timestamp").alias("due"))
    queued.write.mode("append").parquet(queue)
    return queued.withColumn("execution_status", F.lit(QUEUED))


def drain_deliveries(
    spark: SparkSession, queue: str, root: str, checkpoint: str, as_of: str, *, parts: int = 64, once: bool = True
) -> StreamingQuery:
    """Apply queued deliveries to the tables laid out in `root`; results keep when each was due.

    As in `stream_apply`, each queue file is applied once, whatever checkpoint brings it, and only
    the folders of the warehouses that deliver are replaced.
    """
    versions = TableVersions(spark, f"{root}/batches")
    laid = PartitionedTables(spark, f"{root}/tables", parts)
    needed = ["new_order", "oorder", "order_line", "customer"]

    def drain(batch: DataFrame, batch_id: int) -> None:
        with batch_cuts(spark):
            drain_whole(batch)

    def drain_whole(batch: DataFrame) -> None:
        laid.recover(versions)
        batch = _fresh(versions, batch, queue)
        if batch.isEmpty():
            return
        version = versions.next()
        touched = touched_parts(laid, batch)
        tables = laid.open(needed, touched)
        done = delivery(tables, batch.drop("file"), as_of)
        laid.stage(versions, version, done.tables, tables, REWRITTEN)
        results = {"result_delivery": done.result, "errors_delivery": done.errors}
        versions.stage(version, {**results, "applied": _files(batch, queue)})
        laid.finish(versions, version, needed, REWRITTEN, touched)

    schema = "req_seq bigint, w_id bigint, o_carrier_id int, due timestamp"
    writer = (
        spark.readStream.schema(schema)
        .parquet(queue)
        .select("*", F.col("_metadata.file_path").alias("file"))
        .writeStream.foreachBatch(drain)
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(availableNow=True) if once else writer
    return writer.start()
