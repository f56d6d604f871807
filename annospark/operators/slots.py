"""Segmented scans: merging, runs, turns and conversations of recordings too long for one window.

A recording is cut into slots. Each slot is scanned on its own, a table with one row for each slot says what is open at its end (a label, how far it reaches), a scan of
that small table says what each slot begins with, and slots are stitched by it. Results equal those of `intervals` and `sessions`, whose windows hold a whole recording.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import intervals, sessions

SLOT_MS = 600_000
SLOT_FRAMES = 100_000
_START = Window.unboundedPreceding


def _by_key(keys: Sequence[str]):
    return Window.partitionBy(*keys).orderBy("_slot")


def _slotted(rows: DataFrame, column: str, size: int) -> DataFrame:
    return rows.withColumn("_slot", F.floor(F.col(column) / size))


def merge(df: DataFrame, keys: Sequence[str] = ("uid",), collar_ms: int = 0, min_ms: int = 0, slot_ms: int = SLOT_MS) -> DataFrame:
    """`intervals.merge` by slots of onsets: an island of a slot is its own, or goes on with what reaches into the slot."""
    slot, w = [*keys, "_slot"], _by_key(keys)
    own = intervals.merge(_slotted(df.select(*keys, "onset_ms", "offset_ms"), "onset_ms", slot_ms), slot, collar_ms)
    reach = own.groupBy(*slot).agg(F.max("offset_ms").alias("_top")).withColumn("_reach", F.max("_top").over(w.rowsBetween(_START, -1))).drop("_top")
    own = own.join(reach, slot).withColumn("_free", F.coalesce(F.col("onset_ms") > F.col("_reach") + collar_ms, F.lit(True)))
    # Islands of a slot that aren't free come first and go on with the last free one of an earlier slot.
    last = own.groupBy(*slot).agg(F.max(F.when(F.col("_free"), F.col("onset_ms"))).alias("_last"))
    last = last.withColumn("_before", F.last("_last", ignorenulls=True).over(w.rowsBetween(_START, -1))).drop("_last")
    own = own.join(last, slot).withColumn("_start", F.when(F.col("_free"), F.col("onset_ms")).otherwise(F.col("_before")))
    out = own.groupBy(*keys, "_start").agg(F.max("offset_ms").alias("offset_ms")).withColumnRenamed("_start", "onset_ms")
    return out.where(F.col("offset_ms") - F.col("onset_ms") >= min_ms) if min_ms else out


def runs(frames: DataFrame, flag: Column, keys: Sequence[str] = ("uid",), index: str = "i", slot_frames: int = SLOT_FRAMES) -> DataFrame:
    """`intervals.runs` by slots of frames: the first run of a slot goes on with the last one before it if their flags are equal."""
    slot, w = [*keys, "_slot"], _by_key(keys)
    rows = _slotted(frames.select(*keys, F.col(index).alias("i"), flag.alias("flag")), "i", slot_frames)
    own = intervals.runs(rows, F.col("flag"), slot)
    ends = own.groupBy(*slot).agg(F.min_by("flag", "first").alias("_f0"), F.max_by("flag", "first").alias("_f1"), F.min("first").alias("_i0"), F.max("first").alias("_i1"))
    ends = ends.withColumn("_on", F.coalesce(F.col("_f0") == F.lag("_f1").over(w), F.lit(False)))
    begun = F.when(~F.col("_on") | (F.col("_i1") > F.col("_i0")), F.col("_i1"))
    ends = ends.withColumn("_before", F.last(begun, ignorenulls=True).over(w.rowsBetween(_START, -1))).select(*slot, "_on", "_i0", "_before")
    start = F.when(F.col("_on") & (F.col("first") == F.col("_i0")), F.col("_before")).otherwise(F.col("first"))
    return own.join(ends, slot).groupBy(*keys, start.alias("first")).agg(F.first("flag").alias("flag"), F.max("end").alias("end")).select(*keys, "flag", "first", "end")


def _numbered(rows: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """rows with a count from 0 of what is `fresh` up to them, in their order within slots and of slots."""
    slot, w = [*keys, "_slot"], _by_key(keys)
    counts = rows.groupBy(*slot).agg(F.sum("fresh").alias("_m"))
    counts = counts.select(*slot, F.coalesce(F.sum("_m").over(w.rowsBetween(_START, -1)), F.lit(0)).alias("_base"))
    own = F.sum("fresh").over(Window.partitionBy(*slot).orderBy(*order).rangeBetween(_START, Window.currentRow))
    return rows.withColumn("_own", own).join(counts, slot).withColumn(name, F.col("_base") + F.col("_own") - 1).drop("fresh", "_own", "_base", "_slot")


def tag_turns(segments: DataFrame, keys: Sequence[str] = ("uid",), gap_ms: int = sessions.TURN_GAP_MS, slot_ms: int = SLOT_MS) -> DataFrame:
    """`sessions.tag_turns` by slots of onsets: a slot begins with the label that is open and how far that label's run reaches."""
    slot, w, order = [*keys, "_slot"], _by_key(keys), ("onset_ms", "label", "offset_ms")
    here = Window.partitionBy(*slot).orderBy(*order)
    rows = _slotted(segments, "onset_ms", slot_ms)
    rows = rows.withColumn("_swap", F.coalesce(F.col("label") != F.lag("label").over(here), F.lit(True)).cast("int"))
    rows = rows.withColumn("_run", F.sum("_swap").over(here.rangeBetween(_START, Window.currentRow)))
    label_runs = rows.groupBy(*slot, "_run").agg(F.first("label").alias("_label"), F.max("offset_ms").alias("_top"))
    ends = label_runs.groupBy(*slot).agg(F.min_by("_label", "_run").alias("_l0"), F.max_by("_label", "_run").alias("_l1"), F.max_by("_top", "_run").alias("_tail"), F.count("*").alias("_n"))
    ends = ends.withColumn("_on", F.coalesce(F.col("_l0") == F.lag("_l1").over(w), F.lit(False)))
    # A slot of one label run that goes on passes on what reached into it; chains of such slots take the greatest reach.
    ends = ends.withColumn("_chain", F.sum(F.when(F.col("_on") & (F.col("_n") == 1), 0).otherwise(1)).over(w.rowsBetween(_START, 0)))
    ends = ends.withColumn("_out", F.max("_tail").over(Window.partitionBy(*keys, "_chain").orderBy("_slot").rowsBetween(_START, 0)))
    ends = ends.withColumn("_in", F.when(F.col("_on"), F.lag("_out").over(w))).select(*slot, "_in")
    reach = F.max("offset_ms").over(Window.partitionBy(*slot, "_run").orderBy(*order).rowsBetween(_START, -1))
    rows = rows.withColumn("_reach", reach).join(ends, slot)
    rows = rows.withColumn("_reach", F.when(F.col("_run") == 1, F.greatest("_reach", "_in")).otherwise(F.col("_reach")))
    rows = rows.withColumn("fresh", F.coalesce(F.col("onset_ms") - F.col("_reach") > gap_ms, F.lit(True)).cast("int")).drop("_swap", "_run", "_reach", "_in")
    return _numbered(rows, keys, order, "turn_idx").select(*segments.columns, "turn_idx")


def turns(segments: DataFrame, keys: Sequence[str] = ("uid",), gap_ms: int = sessions.TURN_GAP_MS, slot_ms: int = SLOT_MS) -> DataFrame:
    """`sessions.turns` by slots; a turn's segments meet by aggregation, so that a long turn is no large group."""
    tagged = tag_turns(segments, keys, gap_ms, slot_ms)
    return tagged.groupBy(*keys, "turn_idx").agg(F.first("label").alias("label"), F.min("onset_ms").alias("onset_ms"), F.max("offset_ms").alias("offset_ms"), F.count("*").alias("n_segments"))


def tag_conversations(turn_rows: DataFrame, keys: Sequence[str] = ("uid",), gap_ms: int = sessions.CONVERSATION_GAP_MS, slot_ms: int = SLOT_MS) -> DataFrame:
    """`sessions.tag_conversations` by slots of onsets: a slot begins with the end of the last turn before it."""
    slot = [*keys, "_slot"]
    rows = _slotted(turn_rows, "onset_ms", slot_ms)
    last = rows.groupBy(*slot).agg(F.max_by("offset_ms", "turn_idx").alias("_end"))
    last = last.select(*slot, F.lag("_end").over(_by_key(keys)).alias("_end"))
    before = F.coalesce(F.lag("offset_ms").over(Window.partitionBy(*slot).orderBy("turn_idx")), F.col("_end"))
    rows = rows.join(last, slot).withColumn("fresh", F.coalesce(F.col("onset_ms") - before >= gap_ms, F.lit(True)).cast("int")).drop("_end")
    return _numbered(rows, keys, ("turn_idx",), "conv_idx").select(*turn_rows.columns, "conv_idx")
