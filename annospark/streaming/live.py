"""Streaming forms: incremental upserts, sessions by windows, filtered samples. Turns and conversations as the batch forms define them are in sessions.py."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annospark.operators.sessions import CONVERSATION_GAP_MS
from annospark.sources.tables import ParquetStore


def ingest(shards: DataFrame, store: ParquetStore, checkpoint: str):
    """Merges newly arrived shards into a store, each batch once: rows of ids that come again are replaced.

    A batch is saved under its number, which lies beside the rows: after a restart, a batch that was cut off, or saved but not yet noted in
    `checkpoint`, is saved again from the state before it. Only the slots that a batch touches are written.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        store.save(batch.distinct(), version=batch_id)

    query = shards.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def live_conversations(segments: DataFrame, delay: str = "1 minute", gap_ms: int = CONVERSATION_GAP_MS) -> DataFrame:
    """Sessions (uid, start, end_us, n_segments, speech_ms) of segments (uid, ts, len_ms) less than `gap_ms` apart, emitted once the watermark has passed.

    A session window joins an event at its very end, so the gap is a microsecond shorter: exactly `gap_ms` apart is apart. A session reaches
    to the largest end it has seen, where the batch form looks at the last turn's end only.
    """
    gap = F.concat((F.col("len_ms") * 1000 + gap_ms * 1000 - 1).cast("string"), F.lit(" microseconds"))
    return segments.withWatermark("ts", delay).groupBy("uid", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n_segments"), F.sum("len_ms").alias("speech_ms")).select("uid", F.col("w.start").alias("start"), (F.expr("unix_micros(w.end)") + 1 - gap_ms * 1000).alias("end_us"), "n_segments", "speech_ms")


def allowed_samples(samples: DataFrame, allowed: DataFrame, key: str = "wav_id") -> DataFrame:
    """Samples of a stream whose id is in a table of allowed ids."""
    return samples.join(allowed.select(key).distinct(), key, "left_semi")
