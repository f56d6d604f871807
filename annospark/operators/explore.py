"""Summaries, histograms, samples and rankings for exploration."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annospark.functions.columns import seeded

from . import selection


def shares(rows: DataFrame, value: str) -> DataFrame:
    """rows with share_pct of the total; the total is one row."""
    all_rows = rows.agg(F.sum(value).alias("_total"))
    return rows.crossJoin(F.broadcast(all_rows)).withColumn("share_pct", F.try_divide(100 * F.col(value), F.col("_total"))).drop("_total")


def dataset_summary(windows: DataFrame, cats: DataFrame, window_s: float) -> DataFrame:
    """One row: recordings, windows, the five categories with the most hours (`;`) and the hours of `other`."""
    hours = cats.groupBy("category").agg((F.sum("prob") * window_s / 3600.0).alias("hours"))
    top = hours.orderBy(F.desc("hours"), "category").limit(5).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("hours")).alias("k"), "category"))), lambda x: x["category"]), ";").alias("top5"))
    other = hours.agg(F.max(F.when(F.col("category") == "other", F.col("hours"))).alias("other_hours"))
    counts = windows.select("uid", "bin").distinct().agg(F.countDistinct("uid").alias("n_files"), F.count("*").alias("n_windows"))
    return counts.crossJoin(F.broadcast(top)).crossJoin(F.broadcast(other))  # each one row


def histogram(rows: DataFrame, value: Column, lo: float, hi: float, n: int, keys: Sequence[str] = ()) -> DataFrame:
    """Counts of n bins of equal width over [lo, hi], the last closed; values outside count as the nearest bound, nulls and NaN don't. Bins without values aren't listed."""
    x = rows.select(*keys, value.cast("double").alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    capped = F.greatest(F.lit(float(lo)), F.least(F.col("x"), F.lit(float(hi))))
    bin_idx = F.least(F.floor((capped - lo) / ((hi - lo) / n)), F.lit(n - 1)).cast("long")
    return x.groupBy(*keys, bin_idx.alias("bin")).agg(F.count("*").alias("n"))


def log2_bins(n: int) -> int:
    """Number of bins for n values: by Sturges' rule, 8 at least."""
    return max(8, math.ceil(math.log2(n) + 1)) if n > 0 else 8


def sample(rows: DataFrame, size: int | float, seed: int = 42, key: str = "uid") -> DataFrame:
    """`size` rows, the first in the order of a seeded hash of the key, or that fraction of them (1 at least), in no order; all if there are fewer.

    A number of rows is kept by each task and by the one that merges them; a fraction is as large as the table, so it is cut by counts.
    """
    if isinstance(size, float):
        return selection.k_of_n(rows, max(1, round(rows.count() * size)), key, seed)
    return rows.orderBy(seeded(F.col(key), seed), key).limit(size)


def global_rank(rows: DataFrame, order: Sequence[str], name: str = "rank") -> DataFrame:
    """rows with their place in the whole order, from 0: ranges of the order are ranked on their own, and a row for each range gives where it starts.

    Ranges are written once, since Spark would draw their bounds anew each time.
    """
    ranged = rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()).checkpoint()
    starts = ranged.groupBy("_range").agg(F.count("*").alias("_n"))
    starts = starts.select("_range", (F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    return ranged.withColumn("_place", place).join(F.broadcast(starts), "_range").withColumn(name, F.col("_start") + F.col("_place")).drop("_range", "_place", "_start")


def even_shards(rows: DataFrame, count: int, order: Sequence[str]) -> DataFrame:
    """Contiguous shards by rank, the remainder going to the first: adds shard, from 0. Needs a checkpoint folder."""
    ranked = global_rank(rows, order, "_rank").crossJoin(F.broadcast(rows.agg(F.count("*").alias("_all"))))  # one row
    size, more = F.floor(F.col("_all") / count), F.col("_all") % count
    late = F.col("_rank") - more * (size + 1)
    shard = F.when(late < 0, F.floor(F.col("_rank") / (size + 1))).otherwise(more + F.floor(late / F.greatest(size, F.lit(1))))
    return ranked.withColumn("shard", shard.cast("int")).drop("_rank", "_all")


def duration_buckets(length_s: Column, threshold: float) -> Column:
    """Bucket name of a long turn."""
    names = [(30, f"{threshold:g}-30"), (60, "30-60"), (120, "60-120"), (300, "120-300")]
    out = F.when(length_s < threshold, F.lit(None).cast("string"))
    for top, name in names:
        out = out.when(length_s < top, name)
    return out.otherwise("300+")


#: Name, column of the clip statistics, comparison, bound and quota of each bucket, in their order; a missing number counts as 0.
BUCKETS = (
    ("density_hi", "speech_density", ">=", 0.75, 4),
    ("density_lo", "speech_density", "<=", 0.25, 4),
    ("child_hi", "child_fraction", ">=", 0.75, 4),
    ("child_lo", "child_fraction", "<=", 0.15, 4),
    ("iou_hi", "frame_iou", ">=", 0.6, 4),
    ("iou_lo", "frame_iou", "<=", 0.15, 4),
    ("turns_hi", "n_turns", ">=", 80, 3),
    ("turns_lo", "n_turns", "<=", 5, 3),
    ("dom_KCHI", "dominant_label", "=", "KCHI", 3),
    ("dom_FEM", "dominant_label", "=", "FEM", 3),
    ("dom_MAL", "dominant_label", "=", "MAL", 2),
    ("dom_OCH", "dominant_label", "=", "OCH", 2),
)


def clip_buckets() -> list[tuple[str, Column, int]]:
    """BUCKETS as conditions on clip statistics, for diverse_sample."""
    out = []
    for name, column, how, bound, quota in BUCKETS:
        if how == "=":
            out.append((name, F.coalesce(F.col(column) == bound, F.lit(False)), quota))
        else:
            number = F.coalesce(F.col(column).cast("double"), F.lit(0.0))
            out.append((name, number >= bound if how == ">=" else number <= bound, quota))
    return out


def diverse_sample(rows: DataFrame, buckets: Sequence[tuple[str, Column, int]], n: int, seed: int = 42, key: str = "clip_id") -> DataFrame:
    """Takes from each bucket (name, condition, quota) in turn, in hash order and leaving out what earlier ones took, then fills up to n: adds bucket.

    A bucket can lose no more rows to earlier ones than these may take, so its first rows by hash, as many as all quotas so far, hold what it takes.
    Only these, bounded by the quotas and n, meet in one task that chooses; keys should be unique.
    """
    quotas, last = [*[q for _, _, q in buckets], n], len(buckets)
    names, reach = [*[name for name, _, _ in buckets], "fill"], list(accumulate(quotas))
    met = F.array(*[F.when(condition, F.lit(i)) for i, (_, condition, _) in enumerate(buckets)], F.lit(len(buckets)))
    may = rows.withColumn("_h", seeded(F.col(key), seed)).select(F.col(key), "_h", F.explode(F.filter(met, lambda x: x.isNotNull())).alias("_k"))
    may = may.withColumn("_rn", F.row_number().over(Window.partitionBy("_k").orderBy("_h", key))).where(F.col("_rn") <= max(reach))
    may = may.where(F.col("_rn") <= F.element_at(F.lit(reach), F.col("_k") + 1))

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        taken: dict = {}
        for k, own in pdf.sort_values(["_k", "_h", key]).groupby("_k"):
            free = [(v, h) for v, h in zip(own[key], own["_h"]) if v not in taken][: quotas[k] if k < last else max(0, n - len(taken))]
            taken |= {v: (h, k) for v, h in free}
        return pd.DataFrame([(v, h, k) for v, (h, k) in list(taken.items())[:n]], columns=[key, "_h", "_k"])

    chosen = may.groupBy(F.lit(1).alias("_one")).applyInPandas(choose, T.StructType([*may.select(key).schema.fields, T.StructField("_h", T.StringType()), T.StructField("_k", T.IntegerType())]))
    out = rows.join(F.broadcast(chosen), key)  # n rows at most
    return out.orderBy("_k", "_h", key).withColumn("bucket", F.element_at(F.lit(names), F.col("_k") + 1)).drop("_h", "_k")


def transition_counts(rows: DataFrame, n: int = 12) -> DataFrame:
    """The most frequent speaker changes with the median and mean of their gaps."""
    pair = ["from_label", "to_label"]
    top = rows.groupBy(*pair).agg(F.count("*").alias("n"), F.avg("gap_ms").alias("gap_mean")).orderBy(F.desc("n"), *pair).limit(n)
    medians = selection.quantiles(rows.join(F.broadcast(top.select(*pair)), pair), pair, "gap_ms", {"gap_median": 0.5})  # n rows
    return top.join(medians, pair).select(*pair, "n", "gap_median", "gap_mean")


def chunk_peaks(lengths: DataFrame, chunk_ms: int, peaks: int = 10, within_ms: int = 10) -> DataFrame:
    """For each multiple of the chunk: rows within `within_ms` of it, their share, and how that compares with an even spread over [0, (peaks + 1) chunks)."""
    x = F.col("len_ms")
    near = F.bround(x / F.lit(float(chunk_ms))).cast("long")
    hit = (F.abs(x - near * chunk_ms) <= within_ms) & near.between(1, peaks)
    span = chunk_ms * (peaks + 1)
    out = lengths.groupBy(F.when(hit, near).alias("peak")).agg(F.count("*").alias("n"))
    total = lengths.agg(F.count("*").alias("total"), F.sum(F.when(x < span, 1).otherwise(0)).alias("inside"))
    out = out.where("peak is not null").crossJoin(F.broadcast(total))  # one row
    return out.select("peak", "n", (100.0 * F.col("n") / F.col("total")).alias("pct"), (F.col("n") / (F.col("inside") * (2.0 * within_ms + 1) / span)).alias("enrichment"))


def onset_phase(segments: DataFrame, grid_ms: int, bin_ms: int = 50) -> DataFrame:
    """Histogram of onsets modulo the grid."""
    return segments.groupBy(F.floor(F.pmod(F.col("onset_ms"), F.lit(grid_ms)) / bin_ms).alias("bin")).agg(F.count("*").alias("n"))


def spectrum(lengths: DataFrame, bin_ms: int = 50, keys: Sequence[str] = ()) -> DataFrame:
    """Counts of length bins, the median count of non-empty bins as a baseline, and each bin's ratio to it."""
    bins = lengths.groupBy(*keys, F.floor(F.col("len_ms") / bin_ms).alias("bin")).agg(F.count("*").alias("n"))
    base = selection.quantiles(bins, list(keys), "n", {"baseline": 0.5})
    both = bins.join(base, list(keys)) if keys else bins.crossJoin(F.broadcast(base))  # one row
    return both.withColumn("ratio", F.col("n") / F.col("baseline"))


def tidy(rows: DataFrame, section: str, metrics: dict[str, Column]) -> DataFrame:
    """Aggregates as rows (section, metric, value)."""
    one = rows.agg(*[c.cast("double").alias(k) for k, c in metrics.items()])
    return one.unpivot([], list(metrics), "metric", "value").select(F.lit(section).alias("section"), "metric", "value")


def length_summary(rows: DataFrame, length: Column, key: str = "label") -> DataFrame:
    """Count, sum, mean and greatest length by key."""
    return rows.groupBy(key).agg(F.count("*").alias("n"), F.sum(length).alias("total"), F.avg(length).alias("mean"), F.max(length).alias("longest"))


def first_failures(results: DataFrame, key: str, error: str = "error", n: int = 5) -> DataFrame:
    """The first n keys whose results carry an error."""
    return results.where(F.col(error).isNotNull()).orderBy(key).limit(n).select(key, error)


def file_sizes(manifest: DataFrame, files: DataFrame, key: str = "uid") -> DataFrame:
    """One row about the files of a manifest's keys, from what `tables.scan_files` has found: total, n_found, n_missing, total_bytes, least, greatest, mean and median bytes, and the first 10 missing keys.

    A key's files count as one; files of other keys are left out.
    """
    per = files.groupBy(key).agg(F.sum("bytes").alias("bytes"))
    both = manifest.select(key).distinct().join(per, key, "left")
    out = both.agg(F.count("*").alias("total"), F.count("bytes").alias("n_found"), (F.count("*") - F.count("bytes")).alias("n_missing"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("total_bytes"), F.min("bytes").alias("least"), F.max("bytes").alias("greatest"), F.avg("bytes").alias("mean"))
    missing = both.where("bytes is null").select(F.col(key).cast("string").alias("k")).orderBy("k").limit(10).agg(F.array_join(F.array_sort(F.collect_list("k")), ";").alias("missing"))
    return out.crossJoin(selection.quantiles(both, [], "bytes", {"median": 0.5})).crossJoin(missing)  # one row each


def eta(rates: DataFrame, todo: DataFrame, key: str = "step") -> DataFrame:
    """Expected seconds of each step: bytes to do over its rate for all workers (null without a rate)."""
    return todo.join(rates, key, "left").withColumn("eta_s", F.try_divide(F.col("bytes").cast("double"), F.col("rate") * F.col("workers")))
