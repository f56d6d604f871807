"""Operators on arrays of frames as they are stored, one row a recording, without a row for each frame."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def blocks(recordings: DataFrame, arrays: Sequence[str], size: int, key: str = "uid") -> DataFrame:
    """Arrays in blocks of `size` frames: key, block (from 0) and the block's part of each array; null and empty arrays have none."""
    n = F.greatest(*[F.coalesce(F.size(a), F.lit(0)) for a in arrays], F.lit(0))
    part = lambda b: F.struct(b.cast("long").alias("block"), *[F.slice(a, b * size + 1, F.lit(size)).alias(a) for a in arrays])
    # Parts are made in one array first: exploding the numbers of blocks would copy whole arrays to each.
    parts = F.transform(F.sequence(F.lit(0), F.ceil(n / size).cast("int") - 1), part)
    return recordings.select(key, F.inline(F.when(n > 0, parts)))


def segment_means(segments: DataFrame, recordings: DataFrame, arrays: Sequence[str] = ("snr", "c50"), step_ms: int = 1000, size: int = 1024) -> DataFrame:
    """segments with the mean of each array over the frames they cover, [onset div step, ceil(offset / step)); null without frames. Nulls and NaN don't count.

    A segment meets the blocks it lies in, mostly one, and takes its own slice of each; sums and counts of the slices are added up. Segments are dealt by uid to a recording's arrays,
    which pass by: they are far more bytes than Spark expects of them, so they must neither be broadcast nor sorted, and aren't shuffled where recordings are grouped by uid.
    """
    w = segments.withColumns({"_f0": F.floor(F.col("onset_ms") / step_ms), "_f1": F.ceil(F.col("offset_ms") / step_ms)})
    w = w.withColumns({"_b0": F.floor(F.col("_f0") / size), "_b1": F.floor(F.greatest(F.col("_f0"), F.col("_f1") - 1) / size)})
    # By a stated number, since Spark would put segments of few bytes, and all of their recordings' frames, into one task.
    w = w.repartition(int(segments.sparkSession.conf.get("spark.sql.shuffle.partitions")), "uid")
    held = blocks(recordings.select("uid", *arrays), arrays, size).select(F.col("uid").alias("_uid"), "block", *[F.col(a).alias(f"_{a}") for a in arrays])
    first = F.greatest(F.col("_f0") - F.col("block") * size, F.lit(0))
    count = F.greatest(F.least(F.col("_f1") - F.col("block") * size, F.lit(size)) - first, F.lit(0))
    own = lambda a: F.filter(F.slice(f"_{a}", (first + 1).cast("int"), count.cast("int")), lambda x: x.isNotNull() & ~F.isnan(x))
    meets = (F.col("uid") == F.col("_uid")) & F.col("block").between(F.col("_b0"), F.col("_b1"))
    hit = w.hint("shuffle_hash").join(held, meets, "left").select(*segments.columns, *[own(a).alias(f"_{a}") for a in arrays])
    hit = hit.select(*segments.columns, *[F.aggregate(f"_{a}", F.lit(0.0), lambda t, x: t + x).alias(f"_{a}_sum") for a in arrays], *[F.size(f"_{a}").alias(f"_{a}_n") for a in arrays])
    return hit.groupBy(*segments.columns).agg(*[F.try_divide(F.sum(f"_{a}_sum"), F.sum(F.when(F.col(f"_{a}_n") > 0, F.col(f"_{a}_n")))).alias(a) for a in arrays])


def runs(recordings: DataFrame, array: str, threshold: float, key: str = "uid") -> DataFrame:
    """Runs of frames above the threshold or not: key, flag, first, end (exclusive). A frame without a value isn't above."""
    kind = dict(recordings.dtypes)[key]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                values = b.column(array)[i].values
                if values is None or not len(values):
                    continue
                flags = values.to_numpy(zero_copy_only=False).astype(float) > threshold
                first = np.concatenate([[0], np.flatnonzero(flags[1:] != flags[:-1]) + 1])
                owner = pa.array([b.column(key)[i].as_py()] * len(first), b.schema.field(key).type)
                yield pa.RecordBatch.from_arrays([owner, pa.array(flags[first]), pa.array(first), pa.array(np.append(first[1:], len(flags)))], names=[key, "flag", "first", "end"])

    return recordings.select(key, array).mapInArrow(find, f"{key} {kind}, flag boolean, first long, end long")
