"""Agreement and coverage between annotators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from annospark.functions.columns import rounded

from . import intervals, selection

HOUR_MS = 3_600_000.0


def _ratio(a: str, *parts: str):
    return F.try_divide(F.col(a).cast("double"), sum((F.col(p) for p in parts[1:]), F.col(parts[0])))


def agreement(vad: DataFrame, vtc: DataFrame, durations: DataFrame) -> DataFrame:
    """One row for each recording of either annotator: vad_ms, vtc_ms, tp/fp/fn_ms, iou, precision, recall and the recording's dur_ms.

    Ratios of nothing are null; a recording that one annotator lacks counts 0 there.
    """
    both = intervals.iou(vad, vtc).drop("iou").toDF("uid", "vad_ms", "vtc_ms", "tp_ms")
    out = both.join(durations, "uid", "left").withColumns({"fp_ms": F.col("vtc_ms") - F.col("tp_ms"), "fn_ms": F.col("vad_ms") - F.col("tp_ms")})
    return out.withColumns({"iou": _ratio("tp_ms", "tp_ms", "fp_ms", "fn_ms"), "precision": _ratio("tp_ms", "tp_ms", "fp_ms"), "recall": _ratio("tp_ms", "tp_ms", "fn_ms")})


def global_agreement(rows: DataFrame, high: float = 0.9, low: float = 0.5) -> DataFrame:
    """Summed tp, fp, fn with their ratios and how many recordings agree well or badly."""
    out = rows.agg(*[F.sum(c).alias(c) for c in ("tp_ms", "fp_ms", "fn_ms")], F.sum(F.when(F.col("iou") >= high, 1).otherwise(0)).alias("n_high"), F.sum(F.when(F.col("iou") < low, 1).otherwise(0)).alias("n_low"))
    return out.withColumns({"iou": _ratio("tp_ms", "tp_ms", "fp_ms", "fn_ms"), "precision": _ratio("tp_ms", "tp_ms", "fp_ms"), "recall": _ratio("tp_ms", "tp_ms", "fn_ms")})


def diagnose(rows: DataFrame, vtc: DataFrame, low: float = 0.5) -> DataFrame:
    """Why recordings agree badly: silent, under (less than half), over (more than twice) or moderate, in this order."""
    counts = vtc.groupBy("uid").agg(F.count("*").alias("n_segments"))
    category = F.when(F.col("vtc_ms") == 0, "silent").when(F.col("vtc_ms") < 0.5 * F.col("vad_ms"), "under").when(F.col("vtc_ms") > 2 * F.col("vad_ms"), "over").otherwise("moderate")
    return rows.where(F.coalesce("iou", F.lit(0.0)) < low).join(counts, "uid", "left").select("uid", "iou", F.coalesce("n_segments", F.lit(0)).cast("long").alias("n_segments"), category.alias("category"))


def enrich(rows: DataFrame, vtc: DataFrame, threshold: float) -> DataFrame:
    """Agreement with segment counts, the longest segment and the threshold that made the segments."""
    per = vtc.groupBy("uid").agg(F.count("*").alias("n_segments"), F.max(F.col("offset_ms") - F.col("onset_ms")).alias("longest_ms"))
    return rows.join(per, "uid", "left").select("uid", "iou", "dur_ms", F.coalesce("n_segments", F.lit(0)).cast("long").alias("n_segments"), "longest_ms", F.lit(threshold).alias("vtc_threshold"))


def to_absolute(segments: DataFrame, clips: DataFrame, keys: Sequence[str] = ("uid", "clip_idx")) -> DataFrame:
    """Clip-relative segments in time of the recording."""
    out = segments.join(clips.select(*keys, "abs_onset_ms"), list(keys))
    return out.withColumns({"onset_ms": F.col("onset_ms") + F.col("abs_onset_ms"), "offset_ms": F.col("offset_ms") + F.col("abs_onset_ms")}).drop("abs_onset_ms")


def best_matches(segments: DataFrame, others: DataFrame, collar_ms: int = 500) -> DataFrame:
    """For each segment the overlapping one of the same label with the greatest IoU (ties: earliest), the errors of both edges, and whether both are within the collar."""
    k = ["uid", "label"]
    seg = [*k, "onset_ms", "offset_ms"]
    pairs = intervals.overlap_join(segments.select(*seg), others.select(*seg), k)
    pairs = pairs.withColumn("iou", intervals.pair_iou(F.col("onset_ms"), F.col("offset_ms"), F.col("b_onset_ms"), F.col("b_offset_ms")))
    w = Window.partitionBy(*seg).orderBy(F.desc("iou"), "b_onset_ms", "b_offset_ms")
    best = pairs.withColumn("rn", F.row_number().over(w)).where("rn = 1").select(*seg, "iou", F.abs(F.col("onset_ms") - F.col("b_onset_ms")).alias("onset_err_ms"), F.abs(F.col("offset_ms") - F.col("b_offset_ms")).alias("offset_err_ms"))
    out = segments.select(*seg).join(best, seg, "left")
    well = (F.col("onset_err_ms") <= collar_ms) & (F.col("offset_err_ms") <= collar_ms)
    return out.withColumns({"matched": F.col("iou").isNotNull(), "well_matched": F.coalesce(well, F.lit(False))})


def match_table(matches: DataFrame, collars: Sequence[int] = (500, 1000, 2000, 3000, 5000)) -> DataFrame:
    """Counts and shares of matched segments by label, also within each collar, and the median errors."""
    worst = F.greatest("onset_err_ms", "offset_err_ms")
    share = lambda c: F.lit(100.0) * F.sum(F.when(c, 1).otherwise(0)) / F.count("*")
    medians = [selection.quantiles(matches, ["label"], f"{e}_err_ms", {f"{e}_median": 0.5}) for e in ("onset", "offset")]
    out = matches.groupBy("label").agg(
        F.count("*").alias("n"), F.sum(F.col("matched").cast("long")).alias("n_matched"), share(F.col("matched")).alias("match_pct"), *[share(worst <= c).alias(f"within_{c}") for c in collars],
    )
    return out.join(medians[0], "label", "left").join(medians[1], "label", "left")


def error_quartiles(matches: DataFrame) -> DataFrame:
    """Quartiles of the edges' errors over matched segments."""
    rows = matches.where("matched").select(F.expr("stack(2, 'onset', onset_err_ms, 'offset', offset_err_ms) as (edge, err)"))
    return selection.quantiles(rows, ["edge"], "err", {"q1": 0.25, "median": 0.5, "q3": 0.75})


def error_cdf(matches: DataFrame) -> DataFrame:
    """Cumulative share of all segments by the greater error of the matched ones.

    Ranks are counted within errors of equal value and errors in turn, so no task orders all rows: errors are whole milliseconds.
    """
    rows = matches.where("matched").select("uid", "label", "onset_ms", F.greatest("onset_err_ms", "offset_err_ms").alias("err_ms"))
    counts = rows.groupBy("err_ms").agg(F.count("*").alias("n"))
    before = counts.withColumn("before", F.sum("n").over(Window.orderBy("err_ms").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).drop("n")
    n_all = matches.agg(F.count("*").alias("n_all"))
    rank = F.row_number().over(Window.partitionBy("err_ms").orderBy("uid", "onset_ms", "label"))
    out = rows.join(before, "err_ms").crossJoin(F.broadcast(n_all))  # one row
    return out.select("uid", "label", "onset_ms", "err_ms", ((F.col("before") + rank).cast("double") / F.col("n_all")).alias("cdf"))


def coverage_hours(a: DataFrame, b: DataFrame) -> DataFrame:
    """Hours that both, only a and only b mark, by label and for the union of labels (`all_speech`)."""
    wide = lambda df: df.select("uid", F.explode(F.array("label", F.lit("all_speech"))).alias("label"), "onset_ms", "offset_ms")
    out = intervals.common_time(wide(a), wide(b), ["uid", "label"]).groupBy("label").agg(*[F.sum(c).alias(c) for c in ("a_ms", "b_ms", "both_ms")])
    return out.select("label", (F.col("both_ms") / HOUR_MS).alias("both_h"), ((F.col("a_ms") - F.col("both_ms")) / HOUR_MS).alias("only_a_h"), ((F.col("b_ms") - F.col("both_ms")) / HOUR_MS).alias("only_b_h"))


def speech_hours(a: DataFrame, b: DataFrame) -> DataFrame:
    """Summed hours by label of two sources and the difference in percent of the first (null if that has none)."""
    hours = lambda df, n: intervals.total(df, ["label"]).select("label", (F.col("total_ms") / HOUR_MS).alias(n))
    out = hours(a, "a_h").join(hours(b, "b_h"), "label", "full").na.fill(0.0, ["a_h", "b_h"])
    return out.withColumn("diff_pct", F.try_divide(F.lit(100) * (F.col("b_h") - F.col("a_h")), F.col("a_h")))


def coverage_table(parts: DataFrame) -> DataFrame:
    """What a cover leaves out, by label and for `all`: segments, length, cuts, cut segments, missed length."""
    out = parts.rollup("label").agg(
        F.count("*").alias("n_segments"), F.sum(F.col("offset_ms") - F.col("onset_ms")).alias("total_ms"), F.sum("n_cuts").alias("n_cuts"),
        F.sum((F.col("n_cuts") > 0).cast("long")).alias("n_cut_segments"), F.sum("missed_ms").alias("missed_ms"),
    )
    return out.withColumn("label", F.coalesce("label", F.lit("all")))


def coverage_report(rows: DataFrame, labels: Sequence[str] = ("FEM", "MAL", "KCHI", "OCH", "all")) -> DataFrame:
    """The coverage table as metric by label, values as texts."""
    metrics = ["n_segments", "total_ms", "n_cuts", "n_cut_segments", "missed_ms"]
    long = rows.unpivot("label", metrics, "metric", "value")
    return long.groupBy("metric").pivot("label", list(labels)).agg(F.first(F.col("value").cast("string")))


def coverage_figures(rows: DataFrame, labels: Sequence[str] = ("KCHI", "OCH", "MAL", "FEM")) -> DataFrame:
    """The coverage table as formatted figures, a row for each metric: metric, all_types and a column for each label; a label without segments has zeros."""
    share = lambda a, b: F.format_string("%.2f%%", rounded(F.coalesce(F.try_divide(F.lit(100.0) * F.col(a), F.col(b)), F.lit(0.0)), 2))
    seconds = lambda c: F.format_string("%.3f", F.col(c) / 1000.0)
    names = {
        "Total VTC segments": F.col("n_segments").cast("string"), "Total VTC duration (seconds)": seconds("total_ms"), "VTC segments with >=1 cut": F.col("n_cut_segments").cast("string"),
        "% VTC segments with >=1 cut": share("n_cut_segments", "n_segments"), "Total number of cuts": F.col("n_cuts").cast("string"), "Total missed speech (seconds)": seconds("missed_ms"), "% VTC speech missed": share("missed_ms", "total_ms"),
    }
    every = rows.sparkSession.createDataFrame([(x,) for x in ("all", *labels)], "label string")
    full = every.join(rows, "label", "left").na.fill(0, ["n_segments", "total_ms", "n_cuts", "n_cut_segments", "missed_ms"])
    long = full.select("label", F.explode(F.array(*[F.struct(F.lit(i).alias("place"), F.lit(m).alias("metric"), v.alias("text")) for i, (m, v) in enumerate(names.items())])).alias("x")).select("label", "x.*")
    wide = long.groupBy("place", "metric").pivot("label", ["all", *labels]).agg(F.first("text"))
    return wide.orderBy("place").select("metric", F.col("all").alias("all_types"), *labels)
