"""Structured streams: an append-only landing folder into a table, once for each key, and windows over event time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from filigree.sources.sinks import Store


def ingest(spark: SparkSession, landing: str, schema, table: str, checkpoint: str, key: str | None = None, kind: str = "parquet", ts: str | None = None, late: str = "7 days") -> None:
    """Takes what has landed since the last run into a parquet table and ends; a key that has come before is left out.

    With an event time ts, keys are remembered for `late` only, so that the state stays bounded; without one, each batch is
    compared with the table itself, and no state is kept at all.
    """
    stream = spark.readStream.schema(schema).format(kind).load(landing)
    if key and ts:
        stream = stream.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])
    if not key or ts:
        sink = stream.writeStream.format("parquet").option("path", table)
    else:
        def take(batch: DataFrame, _: int) -> None:
            fresh = batch.dropDuplicates([key])
            if Store(spark, table).names():
                fresh = fresh.join(spark.read.schema(batch.schema).parquet(table).select(key), key, "left_anti").select(*batch.columns)
            fresh.write.mode("append").parquet(table)

        sink = stream.writeStream.foreachBatch(take)
    sink.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def ingest_periods(spark: SparkSession, landing: str, schema, table: str, checkpoint: str, period: str, current: str, kind: str = "parquet") -> None:
    """Takes files that have landed since the last run into a table partitioned by period (quarters, say), and ends.

    A file is a whole snapshot of the periods in it. Of periods before the current one the first snapshot stays for good;
    the current one's is replaced by each newer file, its partition alone. Of several snapshots in a batch the latest file counts.
    """
    stream = spark.readStream.schema(schema).format(kind).load(landing).withColumn("_landed", F.struct(F.col("_metadata.file_modification_time").alias("at"), F.col("_metadata.file_path").alias("path")))

    def take(batch: DataFrame, _: int) -> None:
        batch = batch.persist()  # read twice below
        names = [c for c in batch.columns if c != "_landed"]
        closed = F.col(period) < current
        snapshots = batch.groupBy(period).agg(F.min("_landed").alias("first"), F.max("_landed").alias("last"))
        wanted = snapshots.select(period, F.when(closed, F.col("first")).otherwise(F.col("last")).alias("_landed"))
        if Store(spark, table).names():
            there = spark.read.schema(batch.select(names).schema).parquet(table).select(period).distinct().where(closed)
            wanted = wanted.join(there, period, "left_anti")
        rows = batch.join(wanted, [period, "_landed"], "left_semi").select(*names)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(period).parquet(table)
        batch.unpersist()

    stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


class Progress(StreamingQueryListener):
    """Tells a callback how streams go: start, update (rows and sources of each batch) and complete, with an error if there was one."""

    def __init__(self, on_event: Callable[[dict], None]):
        self.on_event = on_event

    def onQueryStarted(self, event) -> None:
        self.on_event({"event": "start", "id": str(event.runId), "name": event.name})

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.on_event({"event": "update", "id": str(p.runId), "name": p.name, "batch": p.batchId, "rows": p.numInputRows})

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.on_event({"event": "complete", "id": str(event.runId), "error": event.exception})


def windowed(events: DataFrame, ts: str, width: str, late: str, *by: str, slide: str | None = None) -> DataFrame:
    """Counts and sums of value over tumbling or sliding windows of event time; rows later than late are left out of a stream."""
    w = F.window(ts, width, slide) if slide else F.window(ts, width)
    return events.withWatermark(ts, late).groupBy(w.alias("w"), *by).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), *by, "n", "total")


def sessions(events: DataFrame, ts: str, gap: str, late: str, *by: str) -> DataFrame:
    w = F.session_window(ts, gap)
    return events.withWatermark(ts, late).groupBy(w.alias("w"), *by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, "n")
