"""Sample arrays: resampling, channels, speech cuts, levels, masks, batches, export order."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annospark.functions.columns import seeded

from . import explore


def resample(x: Column, rate_from: int, rate_to: int) -> Column:
    """Linear interpolation to int(n * to / from) samples, spread evenly from the first to the last."""
    n = F.size(x)
    m = F.floor(n * F.lit(rate_to) / F.lit(rate_from)).cast("int")

    def at(i: Column) -> Column:
        pos = F.when(m > 1, i * (n - 1) / (m - 1)).otherwise(F.lit(0.0))
        low = F.floor(pos).cast("int")
        part = pos - low
        return F.get(x, low) * (1 - part) + F.coalesce(F.get(x, low + 1), F.lit(0.0)) * part

    return F.when(m > 0, F.transform(F.sequence(F.lit(0), m - 1), at)).otherwise(F.array().cast("array<double>"))


def mono(channels: Column, mean: bool = True) -> Column:
    """One channel of an array of channels: their mean, or the first."""
    first = F.get(channels, F.lit(0))
    if not mean:
        return first
    return F.transform(first, lambda _, i: F.aggregate(channels, F.lit(0.0), lambda a, c: a + F.get(c, i)) / F.size(channels))


def speech_only(x: Column, spans: Column, pad: int = 0) -> Column:
    """Samples within the (first, end) spans, each widened by `pad` and clamped."""
    n = F.size(x)
    first = lambda s: F.greatest(F.lit(0), s["first"] - pad)
    return F.flatten(F.transform(spans, lambda s: F.slice(x, first(s) + 1, F.greatest(F.lit(0), F.least(n, s["end"] + pad) - first(s)))))


def rebase(segments: DataFrame, keys: Sequence[str] = ("uid",)) -> DataFrame:
    """Segment times after everything between disjoint segments was cut out: adds new_on_ms, new_off_ms."""
    w = Window.partitionBy(*keys).orderBy("onset_ms", "offset_ms").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("offset_ms") - F.col("onset_ms")).over(w)
    return segments.withColumns({"new_on_ms": end - (F.col("offset_ms") - F.col("onset_ms")), "new_off_ms": end})


def normalize_rms(x: Column, target_db: float = -20.0) -> Column:
    """Scales to the target level; silence stays."""
    rms = F.sqrt(F.aggregate(x, F.lit(0.0), lambda a, v: a + v * v) / F.greatest(F.size(x), F.lit(1)))
    gain = F.try_divide(F.lit(10 ** (target_db / 20)), rms)
    return F.when(rms > 0, F.transform(x, lambda v: v * gain)).otherwise(x)


def normalize_peak(x: Column, peak: float = 1.0) -> Column:
    """Scales so that the greatest absolute sample is `peak`; silence stays."""
    top = F.array_max(F.transform(x, lambda v: F.abs(v)))
    return F.when(top > 0, F.transform(x, lambda v: v * (F.lit(peak) / top))).otherwise(x)


def sample_range(onset_ms: Column, offset_ms: Column, rate: int, n: Column) -> tuple[Column, Column]:
    """First and end sample of a time span, within the n samples; empty where first >= end."""
    return F.floor(onset_ms * rate / 1000), F.least(F.floor(offset_ms * rate / 1000), n)


def frame_masks(clips: DataFrame, segments: DataFrame, labels: Sequence[str], frame_ms: int = 20, keys: Sequence[str] = ("uid", "clip_idx")) -> DataFrame:
    """Per clip its number of frames of `frame_ms`, cut off downwards, an attention mask and a mask for each label, and how many frames each label has: n_frames, attention, mask_*, n_*.

    A segment covers frames [on div frame, off div frame) of clip-relative time. Masks are packed bits, frame i in bit i % 8 of byte i // 8 (`unpack_mask`
    gives booleans). A clip's segments meet in one row; its bits are set in the task that holds it, so no row is made for a frame.
    """
    k = list(keys)
    n = F.floor((F.col("offset_ms") - F.col("onset_ms")) / frame_ms).cast("int")
    on, off = (F.floor(F.col(c) / frame_ms).cast("int") for c in ("rel_on_ms", "rel_off_ms"))
    spans = segments.where(F.col("label").isin(*labels) & (off > on)).groupBy(*k).agg(F.collect_list(F.array(F.array_position(F.lit(list(labels)), F.col("label")).cast("int") - 1, on, off)).alias("spans"))
    rows = clips.select(*k, n.alias("n_frames")).join(spans, k, "left")

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            masks, counts = [], []
            for size, held in zip(b.column("n_frames").to_pylist(), b.column("spans").to_pylist()):
                bits = np.zeros((len(labels) + 1, max(size or 0, 0)), bool)
                bits[-1] = True
                for label, first, end in held or ():
                    bits[label, first:end] = True
                masks.append([row.tobytes() for row in np.packbits(bits, axis=1, bitorder="little")])
                counts.append(bits[:-1].sum(1).tolist())
            columns = [pa.array([m[i] for m in masks], pa.binary()) for i in (-1, *range(len(labels)))] + [pa.array([c[i] for c in counts], pa.int32()) for i in range(len(labels))]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in (*k, "n_frames")], *columns], names=names)

    names = [*k, "n_frames", "attention", *[f"mask_{x}" for x in labels], *[f"n_{x}" for x in labels]]
    kinds = T.StructType([*rows.select(*k, "n_frames").schema.fields, *[T.StructField(c, T.BinaryType() if not c.startswith("n_") else T.IntegerType()) for c in names[len(k) + 1 :]]])
    return rows.mapInArrow(fill, kinds)


def unpack_mask(mask: bytes, n: int) -> np.ndarray:
    """The n booleans of a packed mask."""
    return np.unpackbits(np.frombuffer(mask, np.uint8), count=n, bitorder="little").astype(bool)


def batches(rows: DataFrame, size: int, order: Sequence[str], shard: str, samples: str = "samples", multiple: int = 1, drop_last: bool = False) -> DataFrame:
    """Batches of `size` rows within a shard, padded with zeros to the batch's longest (rounded up to a multiple): one row a batch with the padded
    samples, attention masks and lengths. Rows are ranked by ranges of (shard, order), so no task orders a shard; needs a checkpoint folder."""
    ranked = explore.global_rank(rows.select(shard, *[c for c in order if c != shard]), [shard, *order], "_rank")
    first = ranked.groupBy(shard).agg(F.min("_rank").alias("_first"))
    place = ranked.join(first, shard).select(shard, *[c for c in order if c != shard], F.floor((F.col("_rank") - F.col("_first")) / size).alias("batch"))
    x = rows.join(place, list(dict.fromkeys([shard, *order]))).withColumn("len", F.size(samples))
    width = (F.ceil(F.max("len").over(Window.partitionBy(shard, "batch")) / multiple) * multiple).cast("int")
    x = x.withColumn("width", width).withColumn("pad", F.col("width") - F.col("len"))
    kind = dict(rows.dtypes)[samples][6:-1]
    x = x.withColumn("_s", F.struct(*order, F.concat(F.col(samples), F.array_repeat(F.lit(0).cast(kind), F.col("pad"))).alias("x"), F.concat(F.array_repeat(F.lit(True), F.col("len")), F.array_repeat(F.lit(False), F.col("pad"))).alias("m"), F.col("len").alias("l")))
    out = x.groupBy(shard, "batch").agg(F.count("*").alias("n"), F.first("width").alias("width"), F.array_sort(F.collect_list("_s")).alias("s"))
    part = lambda f: F.transform("s", lambda r: r[f])
    out = out.select(shard, "batch", "n", "width", part("x").alias("samples"), part("m").alias("attention"), part("l").alias("lengths"))
    return out.where(F.col("n") == size) if drop_last else out


def stack_masks(rows: DataFrame, batch: Sequence[str], order: Sequence[str], masks: Sequence[str], n_frames: str = "n_frames") -> DataFrame:
    """Packed masks of a batch's rows as one block of bits: batch, n, width (the most frames of a row with masks), n_labels (the most masks of a row), masks.

    `masks` are columns of packed bits; a null one is absent, and those that are left stand first, as a row with fewer labels would have them. Each row takes n_labels masks of
    ceil(width / 8) bytes, zeros where it has none, rows in order: `unpack_stack` gives booleans [row, label, frame]. Masks and width are null where no row of the batch has a mask.
    Padding is of whole bytes, since the bits of a packed mask after its last frame are zero.
    """
    held = F.filter(F.array(*masks), lambda m: m.isNotNull())
    x = rows.select(*batch, F.struct(*order).alias("_order"), held.alias("_m"), F.when(F.size(held) > 0, F.col(n_frames)).alias("_n"))
    out = x.groupBy(*batch).agg(F.count("*").alias("n"), F.max("_n").alias("width"), F.max(F.size("_m")).alias("n_labels"), F.array_sort(F.collect_list(F.struct("_order", "_m"))).alias("_rows"))
    size = F.ceil(F.col("width") / 8).cast("int")
    absent = F.rpad(F.unhex(F.lit("")), size, F.unhex(F.lit("00")))
    row = lambda r: F.concat(*[F.coalesce(F.rpad(F.get(r["_m"], F.lit(i)), size, F.unhex(F.lit("00"))), F.when(F.col("n_labels") > i, absent).otherwise(F.unhex(F.lit("")))) for i in range(len(masks))])
    whole = F.aggregate(F.transform("_rows", row), F.unhex(F.lit("")), lambda a, b: F.concat(a, b))
    return out.select(*batch, "n", "width", "n_labels", F.when(F.col("width").isNotNull(), whole).alias("masks"))


def unpack_stack(masks: bytes, n: int, width: int, n_labels: int) -> np.ndarray:
    """Booleans [row, label, frame] of stacked masks."""
    bits = np.unpackbits(np.frombuffer(masks, np.uint8).reshape(n, n_labels, -(-width // 8)), axis=2, bitorder="little")
    return bits[:, :, :width].astype(bool)


def collate_scalar(x: Column, batch: Column) -> Column:
    """A scalar in a batch: null where the whole batch has none, 0 for single gaps."""
    return F.when(F.count(x).over(Window.partitionBy(batch)) > 0, F.coalesce(x, F.lit(0)))


def epoch_order(rows: DataFrame, key: str, seed: int, epoch: int, workers: int) -> DataFrame:
    """Deals rows to workers by a seeded hash and gives each its place in the worker's order of this epoch.

    The order's hashes fall into 4,096 ranges that are ranked on their own; a row for each worker and range gives where it starts.
    """
    deal = F.conv(F.substring(seeded(F.col(key), seed), 1, 8), 16, 10).cast("long")
    x = rows.withColumns({"worker": F.pmod(deal, F.lit(workers)), "_h": seeded(F.col(key), seed, epoch)}).withColumn("_slot", F.conv(F.substring("_h", 1, 3), 16, 10).cast("int"))
    counts = x.groupBy("worker", "_slot").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("worker").orderBy("_slot").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")
    starts = counts.select("worker", "_slot", before.alias("_start"))
    place = F.row_number().over(Window.partitionBy("worker", "_slot").orderBy("_h", key))
    return x.withColumn("_place", place).join(starts, ["worker", "_slot"]).withColumn("place", (F.col("_start") + F.col("_place")).cast("int")).select(*rows.columns, "worker", "place")
