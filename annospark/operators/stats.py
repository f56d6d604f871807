"""Statistics at the grains segment, turn, conversation, clip and file."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annospark.functions.columns import rounded
from annospark.sources.derive import LABELS

from . import intervals, sessions

CLIP = ["uid", "clip_idx"]
FRAME_MS = 100


def _length() -> Column:
    return F.col("offset_ms") - F.col("onset_ms")


def duration_summary(df: DataFrame, keys: list[str], length: Column | None = None) -> DataFrame:
    """max, min, sum, num and avg of interval lengths in ms."""
    length = _length() if length is None else length
    return df.groupBy(*keys).agg(F.max(length).alias("max_ms"), F.min(length).alias("min_ms"), F.sum(length).alias("sum_ms"), F.count("*").alias("num"), F.avg(length).alias("avg_ms"))


def file_metadata(vtc: DataFrame, durations: DataFrame) -> DataFrame:
    """Labelled speech of each recording: n_segments, speech_ms and label_counts as a map; zero rows for silent recordings."""
    per = vtc.groupBy("uid", "label").agg(F.count("*").alias("n"), F.sum(_length()).alias("ms"))
    per = per.groupBy("uid").agg(F.sum("n").alias("n_segments"), F.sum("ms").alias("speech_ms"), F.map_from_entries(F.sort_array(F.collect_list(F.struct("label", "n")))).alias("label_counts"))
    out = durations.select("uid").join(per, "uid", "left").na.fill(0, ["n_segments", "speech_ms"])
    return out.withColumn("label_counts", F.coalesce("label_counts", F.create_map().cast("map<string,bigint>")))


def clip_speech(segments: DataFrame) -> DataFrame:
    """Per clip: speech_ms, n_segments, mean segment length, mean positive gap to the segment before."""
    gap = F.col("onset_ms") - F.lag("offset_ms").over(Window.partitionBy(*CLIP).orderBy("onset_ms", "label", "offset_ms"))
    return segments.withColumn("gap_ms", gap).groupBy(*CLIP).agg(F.sum(_length()).alias("speech_ms"), F.count("*").alias("n_segments"), F.avg(_length()).alias("mean_segment_ms"), F.avg(F.when(F.col("gap_ms") > 0, F.col("gap_ms"))).alias("mean_gap_ms"))


def clip_labels(segments: DataFrame) -> DataFrame:
    """Per clip: labels (`;`), n_labels, has_adult, dur_{label}_ms, child and adult lengths, child_fraction."""
    part = lambda *ls: F.sum(F.when(F.col("label").isin(*ls), _length()).otherwise(0))
    out = segments.groupBy(*CLIP).agg(
        F.array_join(F.array_sort(F.collect_set("label")), ";").alias("labels"), F.countDistinct("label").alias("n_labels"), F.bool_or(F.col("label").isin("FEM", "MAL")).alias("has_adult"),
        *[part(x).alias(f"dur_{x.lower()}_ms") for x in LABELS], part("KCHI", "OCH").alias("child_ms"), part("FEM", "MAL").alias("adult_ms"),
    )
    return out.withColumn("child_fraction", F.coalesce(F.try_divide(F.col("child_ms").cast("double"), F.col("child_ms") + F.col("adult_ms")), F.lit(0.0)))


def dominant_label(segments: DataFrame) -> DataFrame:
    """Per clip the label with the most speech; of equal ones the first to speak."""
    per = segments.groupBy(*CLIP, "label").agg(F.sum(_length()).alias("ms"), F.min("onset_ms").alias("first"))
    rank = F.row_number().over(Window.partitionBy(*CLIP).orderBy(F.desc("ms"), "first", "label"))
    return per.withColumn("rn", rank).where("rn = 1").select(*CLIP, F.col("label").alias("dominant_label"))


def label_changes(segments: DataFrame) -> DataFrame:
    """Per clip the number of label runs, whatever the gaps."""
    swap = F.coalesce(F.col("label") != F.lag("label").over(Window.partitionBy(*CLIP).orderBy("onset_ms", "label", "offset_ms")), F.lit(False))
    return segments.withColumn("swap", swap.cast("long")).groupBy(*CLIP).agg((F.sum("swap") + 1).alias("n_turns"))


def frame_iou(a: DataFrame, b: DataFrame, keys: list[str] = CLIP, frame_ms: int = FRAME_MS) -> DataFrame:
    """IoU of two segment sets on frames of `frame_ms`, indices cut off downwards; 0 without any active frame."""
    grid = lambda df: df.select(*keys, F.floor(F.col("onset_ms") / frame_ms).alias("onset_ms"), F.floor(F.col("offset_ms") / frame_ms).alias("offset_ms")).where("offset_ms > onset_ms")
    out = intervals.iou(grid(a), grid(b), keys, slot_ms=None if keys == CLIP else intervals.SLOT_MS)
    return out.select(*keys, F.when(F.col("a_ms") + F.col("b_ms") == 0, 0.0).otherwise(F.col("iou")).alias("frame_iou"))


def clip_cover(vad: DataFrame, segments: DataFrame, frame_ms: int = FRAME_MS) -> DataFrame:
    """Per clip vad_ms, the time that VAD covers, and frame_iou as `frame_iou` gives it, from one sort: frames keep the order of onsets, and one shorter than a frame adds none."""
    frame = lambda c: F.floor(F.col(c) / frame_ms)
    ms, grid = intervals.added(CLIP, F.col("onset_ms"), F.col("offset_ms")), intervals.added(CLIP, frame("onset_ms"), frame("offset_ms"))
    rows = intervals.both_sets(vad, segments, CLIP).select(*CLIP, ms[0].alias("vad_ms"), *[x.alias(n) for x, n in zip(grid, ("a", "b", "any"))])
    out = rows.groupBy(*CLIP).agg(*[F.sum(c).alias(c) for c in ("vad_ms", "a", "b", "any")])
    return out.select(*CLIP, "vad_ms", F.coalesce(F.try_divide((F.col("a") + F.col("b") - F.col("any")).cast("double"), F.col("any")), F.lit(0.0)).alias("frame_iou"))


def coverage_by_label(segments: DataFrame, vad: DataFrame) -> DataFrame:
    """Per clip and label the share of labelled time that VAD covers, at most 1."""
    pairs = intervals.overlap_join(segments, intervals.merge(vad, CLIP), CLIP, slot_ms=None).groupBy(*CLIP, "label").agg(F.sum(F.col("off_ms") - F.col("on_ms")).alias("both_ms"))
    per = segments.groupBy(*CLIP, "label").agg(F.sum(_length()).alias("ms")).join(pairs, [*CLIP, "label"], "left")
    return per.select(*CLIP, "label", F.least(F.lit(1.0), F.coalesce("both_ms", F.lit(0)).cast("double") / F.col("ms")).alias("coverage"))


def segment_snr(segments: DataFrame, frames: DataFrame, step_ms: int = 1000, block: int = 64) -> DataFrame:
    """segments with the mean snr and c50 of the frames they cover, [onset div step, ceil(offset / step)); null without frames.

    Frames are gathered in blocks of `block` successive ones, so that a segment meets a block or two instead of a row for each frame.
    """
    blocks = frames.groupBy("uid", F.floor(F.col("i") / block).alias("_b")).agg(F.collect_list(F.struct("i", "snr", "c50")).alias("_fr"))
    w = segments.withColumns({"_f0": F.floor(F.col("onset_ms") / step_ms), "_f1": F.ceil(F.col("offset_ms") / step_ms)})
    w = w.withColumn("_b", F.explode(F.sequence(F.floor(F.col("_f0") / block), F.floor(F.greatest(F.col("_f0"), F.col("_f1") - 1) / block))))
    own = lambda c: F.filter(F.transform(F.filter("_fr", lambda x: (x["i"] >= F.col("_f0")) & (x["i"] < F.col("_f1"))), lambda x: x[c]), lambda x: x.isNotNull())
    hit = w.join(blocks, ["uid", "_b"], "left").select(*segments.columns, own("snr").alias("_snr"), own("c50").alias("_c50"))
    mean = lambda c: F.try_divide(F.sum(F.aggregate(c, F.lit(0.0), lambda a, x: a + x)), F.sum(F.size(c)))
    return hit.groupBy(*segments.columns).agg(mean("_snr").alias("snr"), mean("_c50").alias("c50"))


def join_segment_snr(segments: DataFrame, values: DataFrame, digits: int = 1) -> DataFrame:
    """segments with the values of equal bounds and label, rounded; null where there are none."""
    k = ["uid", "onset_ms", "offset_ms", "label"]
    return segments.join(values.select(*k, rounded(F.col("snr"), digits).alias("snr"), rounded(F.col("c50"), digits).alias("c50")), k, "left")


def contained_means(spans: DataFrame, valued: DataFrame, keys: list[str]) -> DataFrame:
    """spans with the mean snr and c50 of the segments that lie wholly inside them.

    The join is dealt by `keys`, which should name a short stretch, as a clip; the means are grouped where the pairs are.
    """
    own = valued.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("onset_ms").alias("_on"), F.col("offset_ms").alias("_off"), F.col("snr").alias("_snr"), F.col("c50").alias("_c50"))
    inside = (F.col("_on") >= F.col("onset_ms")) & (F.col("_off") <= F.col("offset_ms"))
    for k in keys:
        inside &= F.col(k) == F.col(f"_{k}")
    return spans.join(own, inside, "left").groupBy(*spans.columns).agg(F.avg("_snr").alias("snr_mean"), F.avg("_c50").alias("c50_mean"))


def turn_stats(segments: DataFrame, valued: DataFrame, keys: list[str] = CLIP) -> DataFrame:
    return contained_means(sessions.turns(segments, keys), valued, keys)


def conversation_stats(segments: DataFrame, valued: DataFrame, keys: list[str] = CLIP, turn_gap_ms: int = sessions.TURN_GAP_MS, gap_ms: int = sessions.CONVERSATION_GAP_MS) -> DataFrame:
    tagged = sessions.tag_conversations(sessions.turns(segments, keys, turn_gap_ms), keys, gap_ms)
    return contained_means(sessions.conversations(tagged, keys), valued, keys)


def snr_by_clip(valued: DataFrame, digits: int = 1) -> DataFrame:
    """Per clip mean, sample deviation, least and greatest of the segments' snr and c50."""
    stats = [(f, n) for f, n in ((F.avg, "mean"), (F.stddev_samp, "std"), (F.min, "min"), (F.max, "max"))]
    return valued.groupBy(*CLIP).agg(*[rounded(f(c), digits).alias(f"{c}_{n}") for c in ("snr", "c50") for f, n in stats])


def clip_summary(valued: DataFrame) -> DataFrame:
    """What clip_speech, clip_labels, dominant_label, label_changes and snr_by_clip give, in one pass over segments that carry snr and c50."""
    w = Window.partitionBy(*CLIP).orderBy("onset_ms", "label", "offset_ms")
    gap = F.col("onset_ms") - F.lag("offset_ms").over(w)
    swap = F.coalesce(F.col("label") != F.lag("label").over(w), F.lit(False)).cast("long")
    rows = valued.withColumns({"gap_ms": gap, "swap": swap})
    own = lambda x: F.col("label") == x
    dur = {x: F.sum(F.when(own(x), _length()).otherwise(0)) for x in LABELS}
    first = {x: F.min(F.when(own(x), F.col("onset_ms"))) for x in LABELS}
    stats = [(F.avg, "mean"), (F.stddev_samp, "std"), (F.min, "min"), (F.max, "max")]
    out = rows.groupBy(*CLIP).agg(
        F.sum(_length()).alias("speech_ms"), F.count("*").alias("n_segments"), F.avg(_length()).alias("mean_segment_ms"), F.avg(F.when(F.col("gap_ms") > 0, F.col("gap_ms"))).alias("mean_gap_ms"),
        F.array_join(F.array_sort(F.collect_set("label")), ";").alias("labels"), F.size(F.collect_set("label")).cast("long").alias("n_labels"), F.bool_or(F.col("label").isin("FEM", "MAL")).alias("has_adult"),
        *[dur[x].alias(f"dur_{x.lower()}_ms") for x in LABELS], (dur["KCHI"] + dur["OCH"]).alias("child_ms"), (dur["FEM"] + dur["MAL"]).alias("adult_ms"), (F.sum("swap") + 1).alias("n_turns"),
        F.array_max(F.array(*[F.struct(dur[x].alias("ms"), (-F.coalesce(first[x], F.lit(2**62))).alias("early"), F.lit(-i).alias("order"), F.lit(x).alias("label")) for i, x in enumerate(sorted(LABELS))])).alias("top"),
        *[rounded(f(c), 1).alias(f"{c}_{n}") for c in ("snr", "c50") for f, n in stats],
    )
    share = F.coalesce(F.try_divide(F.col("child_ms").cast("double"), F.col("child_ms") + F.col("adult_ms")), F.lit(0.0))
    return out.withColumns({"dominant_label": F.col("top.label"), "child_fraction": share}).drop("top")


def clip_stats(clips: DataFrame, segments: DataFrame, vad: DataFrame, valued: DataFrame) -> DataFrame:
    """One row a clip with all of its statistics; clips without speech have zeros and nulls."""
    tagged = sessions.tag_conversations(sessions.turns(segments, CLIP), CLIP)
    conv = sessions.conversations(tagged, CLIP).groupBy(*CLIP).agg(F.count("*").alias("n_conversations"), F.sum("n_turns").alias("n_conv_turns"), F.sum(F.col("is_multi_speaker").cast("long")).alias("n_multi_speaker"))
    out = clips.select(*CLIP, "onset_ms", "offset_ms")
    for side in (clip_summary(valued), clip_cover(vad, segments), conv):
        out = out.join(side, CLIP, "left")
    zeros = ["speech_ms", "n_segments", "n_labels", "child_ms", "adult_ms", "n_turns", "vad_ms", "n_conversations", "n_conv_turns", "n_multi_speaker", *[f"dur_{x.lower()}_ms" for x in LABELS]]
    out = out.na.fill(0, zeros).na.fill(0.0, ["frame_iou", "child_fraction"])
    return out.withColumns({"speech_density": F.col("speech_ms") / _length(), "turns_per_min": F.col("n_conv_turns") * 60_000.0 / _length()})


def file_stats(clips: DataFrame, conversations: DataFrame, turns: DataFrame) -> DataFrame:
    """One row a recording: totals over its clips, mean turn and conversation figures."""
    base = clips.groupBy("uid").agg(
        F.count("*").alias("n_clips"), F.sum(_length()).alias("total_ms"), F.sum("speech_ms").alias("speech_ms"), F.sum("vad_ms").alias("vad_ms"), *[F.sum(f"dur_{x.lower()}_ms").alias(f"dur_{x.lower()}_ms") for x in LABELS], F.avg("snr_mean").alias("snr_mean"), F.avg("c50_mean").alias("c50_mean"),
    ).withColumn("density", F.col("speech_ms") / F.col("total_ms"))
    t = turns.groupBy("uid").agg(F.count("*").alias("n_turns"), F.avg(_length()).alias("mean_turn_ms"))
    c = conversations.groupBy("uid").agg(F.count("*").alias("n_conversations"), F.avg(_length()).alias("mean_conv_ms"), F.avg("n_turns").alias("mean_turns_per_conv"))
    return base.join(t, "uid", "left").join(c, "uid", "left").na.fill(0, ["n_turns", "n_conversations"])


def correlations(rows: DataFrame, metrics: list[str]) -> DataFrame:
    """Pearson correlation of all pairs of metrics over rows where both are set: a, b, r (long form, both orders and the diagonal)."""
    both = lambda a, b: F.corr(F.when(F.col(b).isNotNull(), F.col(a)), F.when(F.col(a).isNotNull(), F.col(b)))
    pairs = [*combinations(metrics, 2), *[(m, m) for m in metrics]]
    one = rows.agg(*[both(a, b).alias(f"{a}|{b}") for a, b in pairs])
    rows_of = [F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), F.col(f"`{a}|{b}`").alias("r")) for a, b in pairs for x, y in {(a, b), (b, a)}]
    return one.select(F.explode(F.array(*rows_of)).alias("x")).select("x.*")


def strong_pairs(corr: DataFrame, least: float = 0.3, n: int = 15) -> DataFrame:
    """The strongest correlations off the diagonal, each pair once."""
    return corr.where((F.col("a") < F.col("b")) & (F.abs("r") > least)).orderBy(F.abs(F.col("r")).desc(), "a", "b").limit(n)
