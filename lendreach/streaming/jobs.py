"""Abandonment, funnel counts, duplicate suppression and idempotent list output as streams."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendreach.sources.writers import replace_run


def read_events(spark: SparkSession, path: str, schema: T.StructType,
                glob: str | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def _watermarked(df: DataFrame, ts: str, late: str) -> DataFrame:
    """Watermarks take zoned timestamps only; zone-free times are read in the session's UTC."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)


def abandoned_stream(events: DataFrame, user: str = "user_id", ts: str = "ts",
                     page: str = "event_type", gap: str = "45 minutes", late: str = "10 minutes",
                     rejected: str = "error", submitted: str = "purchase") -> DataFrame:
    """One row per closed session without a rejection or submission.

    A session closes once the watermark passes its last event by ``gap``; a late event that
    still arrives before that re-opens it. A user with no later traffic on the whole stream
    stays open: the watermark moves only with events.
    """
    return (_watermarked(events, ts, late)
            .groupBy(F.session_window(ts, gap).alias("w"), user)
            .agg(F.max(ts).alias("dropoff_time"), F.count("*").alias("record_cnt"),
                 F.max(F.when(F.col(page).isin(rejected, submitted), 1).otherwise(0))
                 .alias("closed"))
            .filter("closed = 0")
            .select(user, F.col("dropoff_time").cast("timestamp_ntz").alias("dropoff_time"),
                    "record_cnt"))


def funnel_stream(events: DataFrame, width: str = "60 minutes", slide: str | None = None,
                  ts: str = "ts", page: str = "event_type", late: str = "10 minutes",
                  pages: Sequence[str] = ("signup", "view", "click", "purchase", "error"),
                  ) -> DataFrame:
    """Event counts per page and time window, tumbling or sliding."""
    w = F.window(ts, width, slide) if slide else F.window(ts, width)
    return (_watermarked(events, ts, late).groupBy(w.alias("w"))
            .agg(*[F.count(F.when(F.col(page) == p, 1)).alias(f"n_{p}") for p in pages])
            .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("w.end").cast("timestamp_ntz").alias("window_end"),
                    *[f"n_{p}" for p in pages]))


def dedupe_stream(lists: DataFrame, keys: Sequence[str], ts: str, period: str) -> DataFrame:
    """First row per key; repeats within the period are dropped."""
    return _watermarked(lists, ts, period).dropDuplicatesWithinWatermark(list(keys))


def foreach_batch_writer(path: str, parts: Sequence[str], job: str) -> Callable[[DataFrame, int], None]:
    """Write each micro-batch to its own partition (job, batch); a batch that runs again replaces itself.

    Batch numbers go on after a restart only with the job's own state folder, so a new state folder
    must come with a new ``job`` name.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        replace_run(batch.withColumns({"job": F.lit(job), "batch_id": F.lit(batch_id)}), path,
                    ["job", "batch_id", *parts])
    return write


def run_available(df: DataFrame, state: str, out: str, mode: str = "append",
                  writer: Callable[[DataFrame, int], None] | None = None) -> str:
    """Process what is there, wait for the end, and return the output path.

    ``state`` is the job's own folder of offsets and open sessions: the next call with the same folder
    goes on where this one ended. Without a ``writer`` rows go to a parquet sink at ``out``; update mode
    needs a writer.
    """
    w = df.writeStream.outputMode(mode).trigger(availableNow=True).option("checkpointLocation", state)
    w = w.foreachBatch(writer) if writer else w.format("parquet").option("path", out)
    q = w.start()
    q.awaitTermination()
    return out
