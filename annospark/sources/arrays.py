"""Per-recording array files (npz) as rows."""

from __future__ import annotations

import io
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annospark.functions.columns import stem

from .shards import store_of


def read_npz(spark: SparkSession, folder: str, arrays: Sequence[str] = ("snr", "c50", "vad"), scalars: Sequence[str] = ("step_s",)) -> DataFrame:
    """One row a file: uid, each array as ARRAY<FLOAT>, each scalar as double. Missing members are null. A task reads the files it is dealt, one at a time."""
    schema = "uid string, " + ", ".join([*[f"{a} array<float>" for a in arrays], *[f"{s} double" for s in scalars]])

    def load(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for uid, content in zip(pdf.uid, pdf.content):
                with np.load(io.BytesIO(content), allow_pickle=False) as z:
                    rows.append([uid, *[z[a].astype(np.float32).ravel() if a in z else None for a in arrays], *[float(z[s]) if s in z else None for s in scalars]])
            yield pd.DataFrame(rows, columns=["uid", *arrays, *scalars])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.npz").option("recursiveFileLookup", True).load(folder)
    return files.select(stem(F.col("path")).alias("uid"), "content").mapInPandas(load, schema)


def frames_of(rows: DataFrame, arrays: Sequence[str] = ("snr", "c50", "vad")) -> DataFrame:
    """Arrays as frame rows: uid, i and one value of each array; NaN becomes null."""
    zipped = rows.select("uid", F.posexplode(F.arrays_zip(*arrays)).alias("i", "x"))
    return zipped.select("uid", F.col("i").cast("long").alias("i"), *[F.when(~F.isnan(F.col(f"x.{a}")), F.col(f"x.{a}").cast("double")).alias(a) for a in arrays])


def pack_npz(rows: DataFrame, arrays: Sequence[str]) -> DataFrame:
    """uid and the bytes of an npz file with the row's arrays as float16."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                buffer = io.BytesIO()
                np.savez(buffer, **{a: np.asarray(getattr(r, a), np.float16) for a in arrays})
                out.append((r.uid, buffer.getvalue()))
            yield pd.DataFrame(out, columns=["uid", "content"])

    return rows.select("uid", *arrays).mapInPandas(pack, "uid string, content binary")


def write_npz(packed: DataFrame, folder: str) -> int:
    """Writes rows (uid, content) as files {uid}.npz of a shared folder, in any store that Arrow knows; returns their number.

    A file is written under another name and moved, so that a task that is tried again leaves a whole file.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        store, base = store_of(folder)
        store.create_dir(base, recursive=True)
        for pdf in batches:
            for uid, content in zip(pdf.uid, pdf.content):
                with store.open_output_stream(tmp := f"{base}/.{uid}.{TaskContext.get().taskAttemptId()}.tmp") as out:
                    out.write(content)
                store.move(tmp, f"{base}/{uid}.npz")
            yield pd.DataFrame({"n": [len(pdf)]})

    return packed.select("uid", "content").mapInPandas(write, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
