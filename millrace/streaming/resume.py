"""Incremental operators as Structured Streaming: upserts into a versioned cache, and windowed counts with late data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.setops import Cache, keep_one


def upsert_stream(stream: DataFrame, cache: Cache, order: list[str], checkpoint: str, compute=None) -> StreamingQuery:
    """Each micro-batch: the last row of each id, only ids that the cache lacks if `compute` is given (resumption), is upserted.
    The checkpoint makes a restarted query go on; repeating a batch gives the same cache."""

    def write(batch: DataFrame, _: int) -> None:
        rows = keep_one(batch, [cache.id_column], order, last=True)
        if compute is not None:
            rows = compute(cache.filter_uncached(rows))
        if not rows.isEmpty():
            cache.save(rows)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, ts: str, keys: list[str], width: str = "1 hour", late: str = "30 minutes") -> DataFrame:
    """Counts per window and keys; rows later than the watermark are dropped. Works on batch and streaming frames."""
    return stream.withWatermark(ts, late).groupBy(F.window(ts, width).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "n")
