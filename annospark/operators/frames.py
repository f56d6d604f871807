"""Per-frame values and per-window class probabilities."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import intervals


def vad_metadata(frames: DataFrame, threshold: float = 0.5, step_ms: int = 1000, long_ms: int = 10_000) -> DataFrame:
    """Speech and silence runs of each recording: max, min, sum, num, avg of both (zeros without runs), speech_ratio, has_long_segment."""
    return run_metadata(intervals.runs(frames, F.col("vad") > threshold), step_ms, long_ms)


def run_metadata(runs: DataFrame, step_ms: int = 1000, long_ms: int = 10_000) -> DataFrame:
    """The same from runs (uid, flag, first, end)."""
    rows = runs.withColumn("ms", (F.col("end") - F.col("first")) * step_ms)
    part = lambda on, name: [
        F.coalesce(f(F.when(F.col("flag") == on, F.col("ms"))), F.lit(0)).alias(f"{name}_{n}") for f, n in ((F.max, "max"), (F.min, "min"), (F.sum, "sum"), (F.count, "num"))
    ] + [F.coalesce(F.avg(F.when(F.col("flag") == on, F.col("ms"))), F.lit(0.0)).alias(f"{name}_avg")]
    out = rows.groupBy("uid").agg(*part(True, "speech"), *part(False, "silence"), F.sum("ms").alias("all_ms"))
    return out.select("*", (F.col("speech_sum") / F.col("all_ms")).alias("speech_ratio"), (F.col("speech_max") >= long_ms).alias("has_long_segment")).drop("all_ms")


def snr_metadata(frames: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Mean, population deviation, least and greatest snr and c50 over speech frames of each recording; over all frames where none is speech."""
    speech = F.col("vad") > threshold
    names = [(f, n) for f, n in ((F.avg, "mean"), (F.stddev_pop, "std"), (F.min, "min"), (F.max, "max"))]
    values = [F.coalesce(f(F.when(speech, F.col(c))), f(c)).alias(f"{c}_{n}") for c in ("snr", "c50") for f, n in names]
    return frames.groupBy("uid").agg(F.count("*").alias("n_frames"), F.sum(speech.cast("long")).alias("n_speech"), F.avg(speech.cast("double")).alias("speech_fraction"), *values)


def threshold_sweep(frames: DataFrame, thresholds: Sequence[float] = (0.5, 0.6, 0.7, 0.8, 0.9)) -> DataFrame:
    """Speech fraction and the means of snr and c50 over speech frames, for each threshold: one pass over the frames."""
    cols = []
    for t in thresholds:
        on = F.col("vad") > t
        cols += [F.struct(F.lit(t).alias("threshold"), F.avg(on.cast("double")).alias("speech_fraction"), F.avg(F.when(on, F.col("snr"))).alias("snr_mean"), F.avg(F.when(on, F.col("c50"))).alias("c50_mean"))]
    per = frames.groupBy("uid").agg(F.array(*cols).alias("x"))
    return per.select("uid", F.explode("x").alias("x")).select("uid", "x.*")


def pool_frames(frames: DataFrame, per_bin: int, threshold: float | None = None) -> DataFrame:
    """Mean snr and c50 of bins of `per_bin` frames, the last bin shorter; with a threshold over speech frames only (null without any)."""
    value = (lambda c: F.col(c)) if threshold is None else (lambda c: F.when(F.col("vad") > threshold, F.col(c)))
    return frames.groupBy("uid", F.floor(F.col("i") / per_bin).alias("bin")).agg(F.avg(value("snr")).alias("snr"), F.avg(value("c50")).alias("c50"))


def sigmoid_summary(scores: DataFrame) -> DataFrame:
    """Greatest and mean logistic of all scores of a recording, rounded to 4 digits."""
    p = 1 / (1 + F.exp(-F.col("score")))
    return scores.groupBy("uid").agg(F.round(F.max(p), 4).alias("max_sigmoid"), F.round(F.avg(p), 4).alias("mean_sigmoid"))


def class_map(spark, categories: Mapping[str, Sequence[int]], n_classes: int, skip: Sequence[int] = (), name: str = "main") -> DataFrame:
    """Dimension table (map, class_idx, category): classes of no category are `other`, those in `skip` are left out."""
    of = {i: c for c, members in categories.items() for i in members}
    rows = [(name, i, of.get(i, "other")) for i in range(n_classes) if i not in set(skip)]
    return spark.createDataFrame(rows, "map string, class_idx int, category string")


def categories(windows: DataFrame, mapping: DataFrame) -> DataFrame:
    """Category probability of each window: the greatest of its classes. The map has a row for each class and category map."""
    return windows.join(F.broadcast(mapping), "class_idx").groupBy("map", "uid", "bin", "category").agg(F.max("prob").alias("prob"))


def category_vector(probs: Column, categories_of: Mapping[str, Sequence[int]]) -> list[Column]:
    """The same on an array column: one column for each category."""
    return [F.array_max(F.array(*[F.get(probs, F.lit(i)) for i in members])).alias(f"prob_{c}") for c, members in categories_of.items()]


def upsample(bins: DataFrame, times: int) -> DataFrame:
    """Repeats each bin `times` times (unchanged for 1 and less)."""
    if times <= 1:
        return bins
    return bins.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(times - 1)))).withColumn("bin", F.col("bin") * times + F.col("k")).drop("k")


def fixed_windows(rows: DataFrame, size: int, samples: str = "samples") -> DataFrame:
    """Windows of `size` samples of an array column, the last filled up with zeros: adds win_idx, replaces the samples."""
    n = F.ceil(F.size(samples) / size)
    out = rows.where(F.size(samples) > 0).withColumn("win_idx", F.explode(F.sequence(F.lit(0), n - 1)))
    part = F.slice(F.col(samples), (F.col("win_idx") * size + 1).cast("int"), F.lit(size))
    return out.withColumn(samples, F.concat(part, F.array_repeat(F.lit(0.0).cast(dict(rows.dtypes)[samples][6:-1]), F.lit(size) - F.size(part))))


def file_categories(cats: DataFrame) -> DataFrame:
    """Per map and recording the mean probability of each category."""
    return cats.groupBy("map", "uid", "category").agg(F.avg("prob").alias("mean_prob"))


def dominant(means: DataFrame, keys: Sequence[str] = ("map", "uid")) -> DataFrame:
    """The category with the greatest mean; ties to the first by name."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("mean_prob"), "category"))
    return means.withColumn("rn", rank).where("rn = 1").select(*keys, F.col("category").alias("dominant_category"), F.col("mean_prob").alias("dominant_prob"))


def esc_metadata(means: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row a recording: prob_{category}, dominant_category, dominant_prob."""
    wide = means.groupBy("uid").pivot("category", list(names)).agg(F.first("mean_prob"))
    return wide.select("uid", *[F.col(n).alias(f"prob_{n}") for n in names]).join(dominant(means, ["uid"]), "uid")


def class_stats(windows: DataFrame, window_s: float, skip: Sequence[int] = (), top: int = 10) -> DataFrame:
    """Per class: probability-weighted seconds, mean probability and how often it is among the `top` of a window (skipped classes count as 0)."""
    prob = F.when(F.col("class_idx").isin(*skip), F.lit(0.0)).otherwise(F.col("prob")) if skip else F.col("prob")
    rank = F.row_number().over(Window.partitionBy("uid", "bin").orderBy(F.desc("p"), "class_idx"))
    rows = windows.withColumn("p", prob).withColumn("top", rank <= top)
    return rows.groupBy("class_idx").agg((F.sum("p") * window_s).alias("pw_seconds"), F.avg("p").alias("mean_prob"), F.avg(F.col("top").cast("double")).alias("top_rate"))


def category_stats(cats: DataFrame, window_s: float, active: float = 0.1) -> DataFrame:
    """Per map and category: probability-weighted hours, mean probability, share of windows above `active`."""
    return cats.groupBy("map", "category").agg((F.sum("prob") * window_s / 3600.0).alias("pw_hours"), F.avg("prob").alias("mean_prob"), F.avg((F.col("prob") > active).cast("double")).alias("active_rate"))


def top_classes(windows: DataFrame, n: int = 10) -> DataFrame:
    """Per recording the n classes with the greatest mean probability, as JSON."""
    means = windows.groupBy("uid", "class_idx").agg(F.avg("prob").alias("m"))
    rank = F.row_number().over(Window.partitionBy("uid").orderBy(F.desc("m"), "class_idx"))
    top = means.withColumn("rn", rank).where(F.col("rn") <= n)
    return top.groupBy("uid").agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("rn", "class_idx"))), lambda x: x["class_idx"])).alias("top_classes"))


def slice_of_clip(bins: DataFrame, clips: DataFrame, step_ms: int) -> DataFrame:
    """Bins that a clip covers, [onset div step, ceil(offset / step)), with its clip_idx."""
    wide = clips.select("uid", "clip_idx", F.explode(F.sequence(F.floor(F.col("onset_ms") / step_ms), F.ceil(F.col("offset_ms") / step_ms) - 1)).alias("bin"))
    return wide.join(bins, ["uid", "bin"])
