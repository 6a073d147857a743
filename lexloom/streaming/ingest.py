"""Incremental variants: counts over event time, sessions, and the newest version of each case."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.index import upsert


def event_counts(events: DataFrame, time: str = "ts", by: list[str] = ("event_type",), every: str = "1 day", late: str = "2 days") -> DataFrame:
    """Events by window and kind; the same expression serves a batch and a stream."""
    marked = events.withWatermark(time, late) if events.isStreaming else events
    return marked.groupBy(F.window(time, every).alias("w"), *by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), *by, "n")


def sessions(events: DataFrame, time: str = "ts", key: str = "user_id", gap: str = "30 minutes", late: str = "2 days") -> DataFrame:
    marked = events.withWatermark(time, late) if events.isStreaming else events
    return marked.groupBy(F.session_window(time, gap).alias("w"), key).agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")


def upsert_stream(cases: DataFrame, table: str, checkpoint: str, key: str = "ucid", version: str = "version"):
    """A query that keeps the newest version of each case in a Parquet table: each batch replaces the table by a new one under
    its batch number, so a batch that is run again gives the same table."""

    def apply(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        try:
            old = spark.read.schema(batch.schema).parquet(f"{table}/v{number - 1}")
        except Exception as e:  # the first batch has no table before it
            if "PATH_NOT_FOUND" not in str(e):
                raise
            old = batch.limit(0)
        upsert(old, batch, key, version).write.mode("overwrite").parquet(f"{table}/v{number}")

    return cases.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).start()
