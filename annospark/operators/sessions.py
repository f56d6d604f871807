"""Turns, conversations, transitions and bouts over labelled segments (sessionization by window functions)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TURN_GAP_MS = 300
CONVERSATION_GAP_MS = 10_000


def tag_turns(segments: DataFrame, keys: Sequence[str] = ("uid",), gap_ms: int = TURN_GAP_MS) -> DataFrame:
    """segments with turn_idx, from 0: a new turn begins where the label changes or more than `gap_ms` passed since the label run's last end."""
    w = Window.partitionBy(*keys).orderBy("onset_ms", "label", "offset_ms")
    rows = segments.withColumn("swap", F.coalesce(F.col("label") != F.lag("label").over(w), F.lit(True)).cast("int"))
    rows = rows.withColumn("label_run", F.sum("swap").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    # Runs are numbered upwards, so the greatest (run, end) so far holds the last run's furthest end: no window by run, and all share one sort.
    so_far = F.max(F.struct("label_run", "offset_ms")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("so_far", so_far).withColumn("fresh", F.coalesce((F.col("so_far.label_run") < F.col("label_run")) | (F.col("onset_ms") - F.col("so_far.offset_ms") > gap_ms), F.lit(True)).cast("int"))
    return rows.withColumn("turn_idx", F.sum("fresh").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - 1).drop("swap", "label_run", "so_far", "fresh")


def turns(segments: DataFrame, keys: Sequence[str] = ("uid",), gap_ms: int = TURN_GAP_MS) -> DataFrame:
    """keys, turn_idx, label, onset_ms, offset_ms, n_segments."""
    return tag_turns(segments, keys, gap_ms).groupBy(*keys, "turn_idx").agg(F.first("label").alias("label"), F.min("onset_ms").alias("onset_ms"), F.max("offset_ms").alias("offset_ms"), F.count("*").alias("n_segments"))


def tag_conversations(turn_rows: DataFrame, keys: Sequence[str] = ("uid",), gap_ms: int = CONVERSATION_GAP_MS) -> DataFrame:
    """turns with conv_idx, from 0: a new conversation begins `gap_ms` or more after the last turn's end."""
    w = Window.partitionBy(*keys).orderBy("turn_idx")
    rows = turn_rows.withColumn("fresh", F.coalesce(F.col("onset_ms") - F.lag("offset_ms").over(w) >= gap_ms, F.lit(True)).cast("int"))
    return rows.withColumn("conv_idx", F.sum("fresh").over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1).drop("fresh")


def conversations(tagged: DataFrame, keys: Sequence[str] = ("uid",)) -> DataFrame:
    """keys, conv_idx, onset_ms, offset_ms (the last turn's end), n_turns, is_multi_speaker, labels (sorted, `;`), n_transitions, gap_after_ms."""
    w = Window.partitionBy(*keys).orderBy("turn_idx")  # as in tag_conversations, so that both share one sort
    swap = (F.col("label") != F.lag("label").over(w)) & (F.col("conv_idx") == F.lag("conv_idx").over(w))
    rows = tagged.withColumn("swap", F.coalesce(swap, F.lit(False)).cast("long"))
    out = rows.groupBy(*keys, "conv_idx").agg(
        F.min("onset_ms").alias("onset_ms"), F.max_by("offset_ms", "turn_idx").alias("offset_ms"), F.count("*").alias("n_turns"),
        (F.size(F.collect_set("label")) > 1).alias("is_multi_speaker"), F.array_join(F.array_sort(F.collect_set("label")), ";").alias("labels"), F.sum("swap").alias("n_transitions"),
    )
    after = F.lead("onset_ms").over(Window.partitionBy(*keys).orderBy("conv_idx")) - F.col("offset_ms")
    return out.withColumn("gap_after_ms", after)


def transitions(tagged: DataFrame, keys: Sequence[str] = ("uid",)) -> DataFrame:
    """Successive turns of a conversation with different labels: from_label, to_label, gap_ms (may be negative) and both lengths."""
    w = Window.partitionBy(*keys, "conv_idx").orderBy("turn_idx")
    length = F.col("offset_ms") - F.col("onset_ms")
    rows = tagged.withColumns({"from_label": F.lag("label").over(w), "gap_ms": F.col("onset_ms") - F.lag("offset_ms").over(w), "from_ms": F.lag(length).over(w), "to_ms": length})
    return rows.where("from_label <> label").select(*keys, "conv_idx", "turn_idx", "from_label", F.col("label").alias("to_label"), "gap_ms", "from_ms", "to_ms")


def turn_gaps(tagged: DataFrame, keys: Sequence[str] = ("uid",)) -> DataFrame:
    """Gaps between successive turns of a conversation."""
    w = Window.partitionBy(*keys, "conv_idx").orderBy("turn_idx")
    return tagged.withColumn("gap_ms", F.col("onset_ms") - F.lag("offset_ms").over(w)).where("gap_ms is not null").select(*keys, "conv_idx", "turn_idx", "gap_ms")


def bouts(tagged: DataFrame, keys: Sequence[str] = ("uid",)) -> DataFrame:
    """Maximal runs of two or more turns of a conversation whose labels alternate: bout_idx (over all runs), onset_ms, offset_ms, n_turns."""
    w = Window.partitionBy(*keys, "conv_idx").orderBy("turn_idx")
    rows = tagged.withColumn("fresh", F.coalesce(F.col("label") == F.lag("label").over(w), F.lit(True)).cast("int"))
    rows = rows.withColumn("bout_idx", F.sum("fresh").over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1)
    return rows.groupBy(*keys, "conv_idx", "bout_idx").agg(F.min("onset_ms").alias("onset_ms"), F.max("offset_ms").alias("offset_ms"), F.count("*").alias("n_turns")).where("n_turns >= 2")
