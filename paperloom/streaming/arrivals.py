"""Papers as they arrive: an addition of Structured Streaming around the batch transitions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.functions import identity


def fresh_texts(stream: DataFrame, delay: str = "1 hour", at: str = "arrived") -> DataFrame:
    """A stream of (source_key, text, <time>) without texts that came before, within the watermark; state is dropped with it."""
    fp = stream.withColumn("converted_text_sha256_96", identity.fingerprint("text"))
    return fp.withWatermark(at, delay).dropDuplicatesWithinWatermark(["converted_text_sha256_96"])


def arrivals(stream: DataFrame, width: str = "10 minutes", delay: str = "30 minutes", at: str = "arrived", kind: str = "source") -> DataFrame:
    """Counts of arrivals by tumbling window and kind."""
    return stream.withWatermark(at, delay).groupBy(F.window(at, width).alias("w"), kind).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), kind, "n")


def apply_batches(stream: DataFrame, path: str, transition, checkpoint: str):
    """A query that applies ``transition(state, batch)`` to the state snapshot at ``path``, batch by batch, by ``foreachBatch``. A batch
    that comes again after a failure finds its keys registered, so transitions have to be idempotent on them."""
    from paperloom.sources import snapshots

    def step(batch: DataFrame, _epoch: int) -> None:
        old = snapshots.read_or_none(batch.sparkSession, path)
        snapshots.replace(transition(old, batch), path)

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
