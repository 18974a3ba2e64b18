"""Streams of report files and of events (survey section 2.12; an extension of the batch operators)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vicinage.operators.enrich import first_by


def report_stream(spark: SparkSession, folder: str, schema: str, files_per_trigger: int = 100) -> DataFrame:
    """Newline-JSON reports as they arrive in a folder; malformed lines are dropped."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).option("mode", "DROPMALFORMED").json(folder)


def append_parts(stream: DataFrame, out: str, checkpoint: str, rows_per_file: int = 80_000) -> StreamingQuery:
    """Appends to a Parquet folder; the checkpoint is the place to go on from."""
    return stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).option("compression", "zstd").option("maxRecordsPerFile", rows_per_file).trigger(availableNow=True).start()


#: Buckets of an upserted table.
BUCKETS = 64


def upsert_stream(stream: DataFrame, keys: list[str], order: str, table: str, checkpoint: str, buckets: int = BUCKETS) -> StreamingQuery:
    """Each batch adds the last row of its keys to a table of numbered batches; nothing that was written is written again.
    A batch that runs again after a failure replaces its own rows. upserted() reads the last row of each key."""

    def add(batch: DataFrame, epoch: int) -> None:
        new = first_by(batch, keys, [F.col(order).desc_nulls_last(), *[F.col(c) for c in keys]])
        new.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets))).write.mode("overwrite").partitionBy("bucket").parquet(f"{table}/batch={epoch}")

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def upserted(spark: SparkSession, table: str, keys: tuple[str, ...] = ("uid",)) -> DataFrame:
    """The rows of an upserted table: the latest batch of a key wins."""
    rows = spark.read.parquet(table)
    return first_by(rows, list(keys), [F.col("batch").desc()]).drop("batch", "bucket")


def compact(spark: SparkSession, table: str, target: str, keys: tuple[str, ...] = ("uid",)) -> None:
    """Writes the rows of an upserted table as one batch of a new table, between runs of the stream."""
    upserted(spark, table, keys).write.mode("overwrite").parquet(f"{target}/batch=0")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """(user_id, start, end, n_events, total): activity of a user without a pause longer than gap; works on streams, with
    a watermark for late rows, and on tables."""
    df = events.withWatermark("ts", late) if events.isStreaming else events
    s = df.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count(F.lit(1)).alias("n_events"), F.sum("value").alias("total"))
    return s.select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n_events", "total")


def hourly(events: DataFrame, late: str = "1 hour") -> DataFrame:
    """(hour, event_type, n, total) of tumbling hours."""
    df = events.withWatermark("ts", late) if events.isStreaming else events
    return df.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("hour"), "event_type", "n", "total")
