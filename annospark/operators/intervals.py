"""Interval algebra on DataFrames with onset_ms and offset_ms (half-open, whole milliseconds).

Windows are partitioned by the recording (and what else is named), so their size is that of one recording.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Width of the time ranges that long recordings are dealt by in overlap joins.
SLOT_MS = 600_000


def merge(df: DataFrame, keys: Sequence[str] = ("uid",), collar_ms: int = 0, min_ms: int = 0) -> DataFrame:
    """Merges overlapping or touching intervals of a group, and those no more than `collar_ms` apart; drops results under `min_ms`."""
    w = Window.partitionBy(*keys).orderBy("onset_ms", "offset_ms")
    reach = F.max("offset_ms").over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = df.select(*keys, "onset_ms", "offset_ms").withColumn("fresh", F.coalesce(F.col("onset_ms") > reach + collar_ms, F.lit(True)).cast("int"))
    # Equal intervals count as one step, in whichever order they come.
    rows = rows.withColumn("island", F.sum("fresh").over(w.rangeBetween(Window.unboundedPreceding, Window.currentRow)))
    out = rows.groupBy(*keys, "island").agg(F.min("onset_ms").alias("onset_ms"), F.max("offset_ms").alias("offset_ms")).drop("island")
    return out.where(F.col("offset_ms") - F.col("onset_ms") >= min_ms) if min_ms else out


def total(df: DataFrame, keys: Sequence[str] = ("uid",)) -> DataFrame:
    """Summed length of a group's intervals."""
    return df.groupBy(*keys).agg(F.sum(F.col("offset_ms") - F.col("onset_ms")).alias("total_ms"))


def activity_union(a: DataFrame, b: DataFrame, keys: Sequence[str] = ("uid",)) -> DataFrame:
    """Merged activity of two sources."""
    cols = [*keys, "onset_ms", "offset_ms"]
    return merge(a.select(*cols).unionByName(b.select(*cols)), keys)


def count_overlaps(df: DataFrame, keys: Sequence[str] = ("uid",)) -> DataFrame:
    """How many intervals begin before the one that precedes them has ended."""
    w = Window.partitionBy(*keys).orderBy("onset_ms", "offset_ms")
    early = F.coalesce(F.col("onset_ms") < F.lag("offset_ms").over(w), F.lit(False))
    return df.select(*keys, early.cast("long").alias("early")).groupBy(*keys).agg(F.sum("early").alias("n_overlaps"))


def overlap_join(a: DataFrame, b: DataFrame, keys: Sequence[str] = ("uid",), slot_ms: int | None = SLOT_MS) -> DataFrame:
    """Pairs of overlapping intervals, with a's columns as they are and b's as `b_*`, and on_ms, off_ms of the common part.

    Both sides are dealt by time as well as by key, so that one long recording doesn't sit in one task; a pair counts in the
    range where its common part begins, and so once. Without `slot_ms` they are dealt by key only, for keys that name a short stretch, as a clip.
    Spark expects a compressed file's bytes of what is derived from it, a tenth of what a broadcast held in the driver; so both sides are shuffled.
    """
    on, off = F.greatest("onset_ms", "b_onset_ms"), F.least("offset_ms", "b_offset_ms")
    meets = (F.col("onset_ms") < F.col("b_offset_ms")) & (F.col("b_onset_ms") < F.col("offset_ms"))
    right = b.select(*[F.col(c).alias(c if c in keys else f"b_{c}") for c in b.columns])
    if slot_ms is None:
        return a.join(right, list(keys)).where(meets).withColumns({"on_ms": on, "off_ms": off})
    slots = lambda on, off: F.explode(F.sequence(F.floor(F.col(on) / slot_ms), F.floor((F.greatest(F.col(off) - 1, F.col(on))) / slot_ms)))
    left = a.withColumn("_slot", slots("onset_ms", "offset_ms"))
    right = right.withColumn("_slot", slots("b_onset_ms", "b_offset_ms"))
    pairs = left.join(right.hint("merge"), [*keys, "_slot"]).where(meets & (F.floor(on / slot_ms) == F.col("_slot")))
    return pairs.withColumns({"on_ms": on, "off_ms": off}).drop("_slot")


def overlap_ms(a: DataFrame, b: DataFrame, keys: Sequence[str] = ("uid",), slot_ms: int | None = SLOT_MS) -> DataFrame:
    """Summed length of what two sets of disjoint intervals share."""
    return overlap_join(a, b, keys, slot_ms).groupBy(*keys).agg(F.sum(F.col("off_ms") - F.col("on_ms")).alias("both_ms"))


def added(part: Sequence[str], on: Column, off: Column) -> list[Column]:
    """What an interval [on, off) adds to its own set if that is a (column _a), to its own if that is b, and to both: what lies beyond the furthest end so far in order of onset_ms."""
    before = Window.partitionBy(*part).orderBy("onset_ms").rowsBetween(Window.unboundedPreceding, -1)
    return [F.greatest(F.lit(0), end - F.greatest(on, F.max(end).over(before))) for end in (F.when(F.col("_a"), off), F.when(~F.col("_a"), off), off)]


def both_sets(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of two sets with _a, whether they are a's."""
    return a.select(*keys, "onset_ms", "offset_ms", F.lit(True).alias("_a")).unionByName(b.select(*keys, "onset_ms", "offset_ms", F.lit(False).alias("_a")))


def common_time(a: DataFrame, b: DataFrame, keys: Sequence[str] = ("uid",), slot_ms: int | None = SLOT_MS) -> DataFrame:
    """keys, a_ms, b_ms, both_ms: what two sets of intervals cover, each and together. Intervals of a set may overlap; a set that a group lacks counts 0.

    One pass in order of onset: an interval adds what lies beyond the furthest end so far, of its own set and of both, and what both cover is what
    the two cover singly less what they cover together. So nothing is merged and nothing joined. Intervals are cut at ranges of time that groups are dealt by;
    without `slot_ms` they are dealt by key only, for keys that name a short stretch, as a clip.
    """
    k = list(keys)
    rows, part = both_sets(a, b, k), k
    if slot_ms is not None:
        rows = rows.withColumn("_slot", F.explode(F.sequence(F.floor(F.col("onset_ms") / slot_ms), F.floor(F.greatest(F.col("offset_ms") - 1, F.col("onset_ms")) / slot_ms))))
        rows = rows.withColumns({"onset_ms": F.greatest("onset_ms", F.col("_slot") * slot_ms), "offset_ms": F.least("offset_ms", (F.col("_slot") + 1) * slot_ms)})
        part = [*k, "_slot"]
    names = ("a_ms", "b_ms", "any_ms")
    rows = rows.select(*k, *[x.alias(n) for x, n in zip(added(part, F.col("onset_ms"), F.col("offset_ms")), names)])
    out = rows.groupBy(*k).agg(*[F.sum(c).alias(c) for c in names])
    return out.select(*k, "a_ms", "b_ms", (F.col("a_ms") + F.col("b_ms") - F.col("any_ms")).alias("both_ms"))


def iou(a: DataFrame, b: DataFrame, keys: Sequence[str] = ("uid",), slot_ms: int | None = SLOT_MS) -> DataFrame:
    """`common_time` with the intersection over union by group: 1 where both cover nothing, 0 where one does. Null-free."""
    ratio = F.try_divide(F.col("both_ms").cast("double"), F.col("a_ms") + F.col("b_ms") - F.col("both_ms"))
    return common_time(a, b, keys, slot_ms).withColumn("iou", F.coalesce(ratio, F.lit(1.0)))


def pair_iou(a_on: Column, a_off: Column, b_on: Column, b_off: Column) -> Column:
    """Overlap of two intervals over the hull of both; 0 if the hull is empty."""
    shared = F.greatest(F.lit(0), F.least(a_off, b_off) - F.greatest(a_on, b_on)).cast("double")
    return F.coalesce(F.try_divide(shared, F.greatest(a_off, b_off) - F.least(a_on, b_on)), F.lit(0.0))


def runs(frames: DataFrame, flag: Column, keys: Sequence[str] = ("uid",), index: str = "i") -> DataFrame:
    """Run-length encoding of a flag over consecutive frames: keys, flag, first and end index (exclusive)."""
    w = Window.partitionBy(*keys).orderBy(index)
    rows = frames.select(*keys, F.col(index).alias("i"), flag.alias("flag"))
    rows = rows.withColumn("turn", F.coalesce(F.col("flag") != F.lag("flag").over(w.orderBy("i")), F.lit(True)).cast("int"))
    rows = rows.withColumn("run", F.sum("turn").over(w.orderBy("i").rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(*keys, "run").agg(F.first("flag").alias("flag"), F.min("i").alias("first"), (F.max("i") + 1).alias("end")).drop("run")


def run_segments(run_rows: DataFrame, step_ms: int) -> DataFrame:
    """Runs of set flags as intervals; empty ones are left out."""
    return run_rows.where("flag").withColumns({"onset_ms": F.col("first") * step_ms, "offset_ms": F.col("end") * step_ms}).where("offset_ms > onset_ms").drop("flag", "first", "end")


def threshold_segments(scores: DataFrame, threshold: float, step_ms: int, keys: Sequence[str] = ("uid", "label"), index: str = "i") -> DataFrame:
    """Intervals where a label's score reaches the threshold, labels independent of each other."""
    return run_segments(runs(scores, F.col("score") >= threshold, keys, index), step_ms)


def silence_gaps(active: DataFrame, spans: DataFrame, keys: Sequence[str] = ("uid",)) -> DataFrame:
    """What merged activity leaves free of each span (win_on, win_off), longest first by gap_rank (ties: earliest); the whole span where nothing is active.

    Activity and spans are dealt by time as well as by key.
    """
    k = list(keys)
    bounds = spans.select(*k, F.col("win_on").alias("onset_ms"), F.col("win_off").alias("offset_ms")).distinct()
    inside = overlap_join(bounds, active.select(*k, "onset_ms", "offset_ms"), k).select(*k, F.col("onset_ms").alias("win_on"), F.col("offset_ms").alias("win_off"), F.col("on_ms").alias("on"), F.col("off_ms").alias("off"))
    edges = spans.select(*k, "win_on", "win_off", F.col("win_on").alias("off")).unionByName(inside, allowMissingColumns=True)
    w = Window.partitionBy(*k, "win_on", "win_off").orderBy(F.col("on").asc_nulls_first(), "off")
    gaps = edges.withColumn("gap_off", F.coalesce(F.lead("on").over(w), F.col("win_off"))).where("gap_off > off")
    gaps = gaps.select(*k, "win_on", "win_off", F.col("off").alias("gap_on"), "gap_off")
    rank = Window.partitionBy(*k, "win_on", "win_off").orderBy((F.col("gap_off") - F.col("gap_on")).desc(), "gap_on")
    return gaps.withColumn("gap_rank", F.row_number().over(rank))


def boundaries_near(segments: DataFrame, points: DataFrame, keys: Sequence[str] = ("uid",), slot_ms: int = SLOT_MS) -> DataFrame:
    """Segment ends strictly inside (win_on, win_off), ranked by distance to `point`, then to the middle of the span, then by time.

    Ends and spans are dealt by time as well as by key; an end lies in one range, so it meets a span once.
    """
    k = list(keys)
    ends = segments.select(*k, F.explode(F.array("onset_ms", "offset_ms")).alias("at")).distinct().withColumn("_slot", F.floor(F.col("at") / slot_ms))
    ranges = F.sequence(F.floor(F.col("win_on") / slot_ms), F.floor(F.greatest("win_on", "win_off") / slot_ms))
    near = points.withColumn("_slot", F.explode(ranges)).join(ends, [*k, "_slot"]).where("at > win_on and at < win_off").drop("_slot")
    w = Window.partitionBy(*k, "win_on", "win_off").orderBy(F.abs(F.col("at") - F.col("point")), F.abs(2 * F.col("at") - F.col("win_on") - F.col("win_off")), "at")
    return near.withColumn("near_rank", F.row_number().over(w))


def uncovered(segments: DataFrame, cover: DataFrame, keys: Sequence[str] = ("uid",)) -> DataFrame:
    """For each segment the number of parts that `cover` (disjoint intervals) leaves out, and their summed length.

    Without any cover a segment has one cut and is missed as a whole.
    """
    pairs = overlap_join(segments, cover, keys).select(*segments.columns, "on_ms", "off_ms")
    all_rows = segments.unionByName(pairs, allowMissingColumns=True)
    w = Window.partitionBy(*segments.columns).orderBy(F.col("on_ms").asc_nulls_first())
    all_rows = all_rows.withColumn("reach", F.coalesce(F.max("off_ms").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.col("onset_ms")))
    gap = F.when(F.col("on_ms") > F.col("reach"), F.col("on_ms") - F.col("reach")).otherwise(0)
    per = all_rows.withColumn("gap", gap).groupBy(*segments.columns).agg(F.sum((F.col("gap") > 0).cast("long")).alias("inner"), F.sum("gap").alias("gaps"), F.coalesce(F.max("off_ms"), F.first("onset_ms")).alias("reach"))
    tail = F.greatest(F.lit(0), F.col("offset_ms") - F.col("reach"))
    return per.select(*segments.columns, (F.col("inner") + (tail > 0).cast("long")).alias("n_cuts"), (F.col("gaps") + tail).alias("missed_ms"))
