"""The accept path over a stream: row by row until exact copies, which are dropped by their hash within a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusloom.config import Normalization, Rules
from corpusloom.operators.dedup import hashed_stream
from corpusloom.plans.accept import prepared


def accepted_stream(records: DataFrame, normalization: Normalization | None = None, rules: Rules | None = None, event_time: str = "loaded_at", late: str = "7 days") -> DataFrame:
    """Accepted records of a stream, each text once.

    The first to arrive wins, not the first in scan order. State holds the hashes of the texts
    that arrived within ``late`` of the latest event time.
    """
    rows = prepared(records, normalization, rules).filter("stage IS NULL")
    hashed = hashed_stream(rows).withWatermark(event_time, late)
    return hashed.dropDuplicatesWithinWatermark(["text_hash"])


def windowed_counts(records: DataFrame, keys: list[str], event_time: str = "loaded_at", window: str = "1 day", late: str = "7 days") -> DataFrame:
    """Records and estimated tokens by event-time window and keys; a window closes when the watermark passes it."""
    return records.withWatermark(event_time, late).groupBy(F.window(event_time, window), *keys).agg(F.count(F.lit(1)).alias("records"), F.sum("estimated_tokens").alias("tokens"))


def run_available(df: DataFrame, sink: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Process what is there into Parquet and stop; a later call goes on from the checkpoint."""
    return df.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
