"""Streaming over landing folders: files become bronze rows once each; event streams become windowed counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from meridian.operators import privacy
from meridian.operators.validation import validate


def land(spark: SparkSession, folder: str, schema: StructType | str, source_type: str, table: str, checkpoint: str, salt: str, file_format: str = "csv") -> StreamingQuery:
    """Takes what has come into ``folder`` since the last run, hashed and validated, and stops."""
    rows = spark.readStream.format(file_format).schema(schema).option("header", True).load(folder)
    hashed, _ = privacy.anonymize(rows, privacy.personal_columns(source_type, rows.columns), salt)
    valid = validate(hashed, source_type).valid
    now = F.current_timestamp()
    out = valid.withColumns({"_ingested_at": now, "_source_type": F.lit(source_type), "_source_file": F.col("_metadata.file_name"), "year": F.year(now), "month": F.month(now)})
    return out.writeStream.format("parquet").option("checkpointLocation", checkpoint).partitionBy("year", "month").trigger(availableNow=True).start(table)


def _late(events: DataFrame, late: str) -> DataFrame:
    return events.withWatermark("ts", late) if events.isStreaming else events


def windowed_counts(events: DataFrame, width: str = "1 day", late: str = "2 days", slide: str | None = None) -> DataFrame:
    """Events for each window and type, tumbling or sliding; a stream closes a window once the watermark has passed it."""
    return _late(events, late).groupBy(F.window("ts", width, slide).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("window_start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 days", key: str = "user_id") -> DataFrame:
    """Each key's runs of events with less than the gap between them: begin, end (the last event and the gap), events."""
    out = _late(events, late).groupBy(F.session_window("ts", gap).alias("w"), key).agg(F.count("*").alias("n"))
    return out.select(key, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")
