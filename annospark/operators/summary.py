"""The figures of a whole data set, from one long table of its clips, segments, turns, conversations and transitions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annospark.functions.columns import rounded
from annospark.sources.derive import LABELS

from . import selection

#: dB below which a clip's mean SNR is counted.
SNR_BOUNDS = (0, 5, 10, 15, 20)


def _long(rows: DataFrame, section: str, labels: Column, metrics: dict[str, Column]) -> DataFrame:
    """Rows (section, label, metric, value): each metric once for each of a row's labels; nulls and NaN are left out."""
    values = F.array(*[F.struct(F.lit(m).alias("metric"), v.cast("double").alias("value")) for m, v in metrics.items()])
    out = rows.select(F.lit(section).alias("section"), labels.alias("_labels"), F.explode(values).alias("x")).select("section", F.explode("_labels").alias("label"), "x.*")
    return out.where(F.col("value").isNotNull() & ~F.isnan("value"))


def long_table(clips: DataFrame, segments: DataFrame, turns: DataFrame, conversations: DataFrame, transitions: DataFrame) -> DataFrame:
    """What the summary counts, as (section, label, metric, value). Inputs are the tables of clip, segment, turn and conversation statistics and of transitions.

    Shares are means of 0 and 1: the metric `snr_below_5` of clips, `multi_speaker` of conversations. Hours are totals of seconds.
    """
    every, both = F.array(F.lit("all")), F.array(F.lit("all"), F.col("label"))
    length = (F.col("offset_ms") - F.col("onset_ms")) / 1000.0
    seconds = lambda c: F.col(c) / 1000.0
    below = {f"snr_below_{t}": F.when(F.col("snr_mean").isNotNull(), (F.col("snr_mean") < t).cast("double")) for t in SNR_BOUNDS}
    speech = F.explode(F.array(*[F.struct(F.lit(x).alias("label"), seconds(f"dur_{x.lower()}_ms").alias("s")) for x in LABELS])).alias("x")
    parts = [
        _long(clips, "clips", every, {"duration_s": length, "labelled_s": seconds("speech_ms"), "vad_s": seconds("vad_ms"), "iou": F.col("frame_iou"), "child_fraction": F.col("child_fraction"), "snr": F.col("snr_mean"), "c50": F.col("c50_mean"), "turns_per_min": F.col("turns_per_min"), **below}),
        _long(clips.select(speech).select("x.*"), "speech", F.array("label"), {"speech_s": F.col("s")}),
        _long(segments, "segments", F.array("label"), {"length_s": length, "snr": F.col("snr")}),
        _long(turns, "turns", both, {"duration_s": length}),
        _long(conversations, "conversations", every, {"duration_s": length, "n_turns": F.col("n_turns"), "multi_speaker": F.col("is_multi_speaker").cast("double"), "gap_after_s": seconds("gap_after_ms"), "snr": F.col("snr_mean"), "c50": F.col("c50_mean")}),
        _long(transitions, "transitions", F.array(F.lit("all"), F.concat_ws(">", "from_label", "to_label")), {"gap_s": seconds("gap_ms")}),
    ]
    return reduce(DataFrame.unionByName, parts)


def figures(long: DataFrame, digits: int = 4) -> DataFrame:
    """n, total, mean, std (of all), least, greatest and median by section, label and metric, rounded. Medians are exact; none is taken in one task."""
    keys = ["section", "label", "metric"]
    out = long.groupBy(*keys).agg(F.count("*").alias("n"), F.sum("value").alias("total"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.min("value").alias("least"), F.max("value").alias("greatest"))
    out = out.join(selection.quantiles(long, keys, "value", {"median": 0.5}), keys)
    return out.select(*keys, "n", *[rounded(F.col(c), digits).alias(c) for c in ("total", "mean", "std", "least", "greatest", "median")])


#: Rows of the card: name, section, metric, figure, divisor, digits, unit.
CARD = (
    ("Total clips", "clips", "duration_s", "n", 1, 0, ""),
    ("Total duration", "clips", "duration_s", "total", 3600, 1, " h"),
    ("VTC speech", "clips", "labelled_s", "total", 3600, 1, " h"),
    ("VAD speech", "clips", "vad_s", "total", 3600, 1, " h"),
    ("Median duration", "clips", "duration_s", "median", 1, 0, " s"),
    ("Median IoU", "clips", "iou", "median", 1, 2, ""),
    ("Total turns", "conversations", "n_turns", "total", 1, 0, ""),
    ("Total conversations", "conversations", "n_turns", "n", 1, 0, ""),
    ("Median SNR", "clips", "snr", "median", 1, 1, " dB"),
    ("Median C50", "clips", "c50", "median", 1, 1, " dB"),
)


def card(figure_rows: DataFrame, rows: Sequence[tuple] = CARD) -> DataFrame:
    """The few figures of a card as texts: name, text. Those without values are left out."""
    parts = [
        figure_rows.where((F.col("section") == section) & (F.col("label") == "all") & (F.col("metric") == metric)).select(F.lit(name).alias("name"), F.format_string(f"%.{digits}f{unit}", rounded(F.col(which) / float(by), digits)).alias("text"))
        for name, section, metric, which, by, digits, unit in rows
    ]
    return reduce(DataFrame.unionByName, parts)
