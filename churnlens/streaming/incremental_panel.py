"""ST1: an incrementally built client-month panel with Structured Streaming.

The reference reads its fact table in bounded chunks, aggregates each chunk
to client-month partials and sums the partials at the end.  Here the chunks
are micro-batches of a file stream: ``foreachBatch`` folds each batch to
client-month partials and appends them to a table in the shared checkpoint
folder; the final panel sums the partials (the same merge as A2).  State never
holds raw events, only per-batch partials, and a restarted query resumes from
its checkpoint without double counting (each batch is written under its
epoch id and the write is idempotent per epoch).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from ..functions.expr import month_key
from ..session import ensure_checkpoint_dir
from ..sources.schemas import EVENTS

EVENT_KINDS = ["view", "click", "purchase", "error", "signup"]
MEASURES = ["event_count", "value_sum", "purchase_value", *[f"{k}_count" for k in EVENT_KINDS]]
PARTIAL_SCHEMA = StructType(
    [StructField("client_id", LongType()), StructField("year_month", StringType())]
    + [StructField(m, DoubleType() if m in ("value_sum", "purchase_value") else LongType())
       for m in MEASURES])


def event_partials(batch: DataFrame) -> DataFrame:
    """Fold events to (client, month) partial sums (map-side combined)."""
    kind = F.col("event_type")
    return (batch.where(F.col("user_id").isNotNull() & F.col("ts").isNotNull())
            .groupBy(F.col("user_id").alias("client_id"), month_key("ts").alias("year_month"))
            .agg(F.count(F.lit(1)).alias("event_count"),
                 F.coalesce(F.sum("value"), F.lit(0.0)).alias("value_sum"),
                 F.coalesce(F.sum(F.when(kind == "purchase", F.col("value"))), F.lit(0.0))
                 .alias("purchase_value"),
                 *[F.count_if(kind == k).alias(f"{k}_count") for k in EVENT_KINDS]))


def merge(partials: DataFrame) -> DataFrame:
    return (partials.groupBy("client_id", "year_month")
            .agg(*[F.sum(m).alias(m) for m in MEASURES]))


def table_stream(spark: SparkSession, source_dir: str, name: str, schema: StructType,
                 files_per_batch: int) -> DataFrame:
    """The files of a table as a stream, whether the table is one Parquet file or a folder
    of part files (as Spark writes it).  A missing table is an error, not an empty stream."""
    path = f"{source_dir.rstrip('/')}/{name}.parquet"
    jvm, sc = spark.sparkContext._jvm, spark.sparkContext
    where = jvm.org.apache.hadoop.fs.Path(path)
    status = where.getFileSystem(sc._jsc.hadoopConfiguration()).getFileStatus(where)
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if status.isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(source_dir)


FILES_PER_BATCH = 64   # a batch costs a job, and for lines a pass over the orders: few, large batches


def run(spark: SparkSession, source_dir: str, name: str = "events",
        files_per_batch: int = FILES_PER_BATCH, work_dir: str | None = None) -> DataFrame:
    """Stream every file of the event table to the end (``availableNow``) and return the merged
    panel.  A stream that wrote no partials raises: its output is never taken to be empty."""
    base = work_dir or f"{ensure_checkpoint_dir(spark).rstrip('/')}/incremental-{uuid.uuid4().hex}"
    out_path, ckpt = f"{base}/partials", f"{base}/checkpoint"
    stream = table_stream(spark, source_dir, name, EVENTS, files_per_batch)

    def write_batch(batch: DataFrame, epoch: int) -> None:
        event_partials(batch).write.mode("overwrite").parquet(f"{out_path}/epoch={epoch}")

    q = (stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return merge(spark.read.schema(PARTIAL_SCHEMA).parquet(out_path))


# ---------------------------------------------------------------------------
# The client-month panel itself, built incrementally from the fact tables
# ---------------------------------------------------------------------------
def run_client_panel(spark: SparkSession, source_dir: str, clients: DataFrame,
                     files_per_batch: int = FILES_PER_BATCH,
                     work_dir: str | None = None) -> DataFrame:
    """ST1 on the transactions: orders and line files arrive as two file
    streams; every micro-batch is turned into transactions, folded to
    client-month partials (``partial_panel``) and appended under its epoch.
    The final panel merges the partials and applies the MRR fill once, so it
    equals the batch ``client_month_panel``.  Lines find their client through
    the (static) orders table: the orders are first cut to the batch's keys, so
    only those reach the join."""
    from ..operators import panel as PA
    from ..sources import adapters as A
    from ..sources.io import read_table

    base = work_dir or f"{ensure_checkpoint_dir(spark).rstrip('/')}/panel-{uuid.uuid4().hex}"
    orders_static = read_table(spark, source_dir, "orders")

    def lines(batch: DataFrame) -> DataFrame:
        keys = batch.select(F.col("l_orderkey").alias("o_orderkey")).distinct()
        return A.line_transactions(orders_static.join(keys, "o_orderkey", "left_semi"), batch)

    sources = {"orders": A.order_transactions, "lineitem": lines}
    for name, to_tx in sources.items():
        schema = read_table(spark, source_dir, name).schema

        def write_batch(batch: DataFrame, epoch: int, name=name, to_tx=to_tx) -> None:
            batch.persist()   # read for its keys, its hot keys and its rows
            try:
                (PA.partial_panel(to_tx(batch)).write.mode("overwrite")
                 .parquet(f"{base}/partials/source={name}/epoch={epoch}"))
            finally:
                batch.unpersist()

        q = (table_stream(spark, source_dir, name, schema, files_per_batch)
             .writeStream.foreachBatch(write_batch)
             .option("checkpointLocation", f"{base}/checkpoint-{name}")
             .trigger(availableNow=True).start())
        q.awaitTermination()
    partials = spark.read.parquet(f"{base}/partials").drop("source", "epoch")
    return PA.finish_panel(PA.merge_partials(partials), clients)
