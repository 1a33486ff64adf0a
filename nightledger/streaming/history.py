"""Streams: batches into a history table, and windowed counts of events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightledger.operators.relational import upsert
from nightledger.session import new_table_path
from nightledger.sources.files import BucketedTable


def upsert_stream(stream: DataFrame, table: BucketedTable, order: Sequence[str], checkpoint: str):
    """Start a query that folds each micro-batch into the table, the later row of a key winning.

    Only the buckets that a batch has keys in are read and written anew. A batch that is delivered again after a
    failure writes the same rows, so the table is as if it came once.
    """

    def fold(batch: DataFrame, _: int) -> None:
        table.rewrite(batch, lambda old, new: upsert(old, new, table.key, order))

    return stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, time: str, kind: str, value: str, width: str, late: str) -> DataFrame:
    """Rows and summed value per kind and tumbling window, with a watermark; the same plan for streams and tables."""
    at = F.window(F.col(time), width)
    d = events.withWatermark(time, late) if events.isStreaming else events
    out = d.groupBy(at.alias("w"), F.col(kind)).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return out.select(F.col("w.start").alias("window_start"), kind, "n", "total")


def run_once(stream: DataFrame, mode: str = "complete") -> DataFrame:
    """Run a streaming aggregate over all that is there and read its result."""
    spark = stream.sparkSession
    path = new_table_path(spark, "stream")
    checkpoint = new_table_path(spark, "stream-checkpoint")

    def keep(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite" if mode == "complete" else "append").parquet(path)

    q = stream.writeStream.outputMode(mode).foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)
