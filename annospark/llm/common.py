"""Helpers that the operators of this subpackage share.

The helpers work on Arrow batches inside tasks: Spark has already partitioned the rows, and each
helper keeps its working set to a slice of a few MB of text, whatever the batch holds.
"""

from __future__ import annotations

import ctypes
import math
import time
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a helper handles at a time; a longer document forms a slice of its own.
SLICE_BYTES = 1 << 20


def ship_package(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it (no-op once set)."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "")
    if root not in have.split(":"):
        env["PYTHONPATH"] = f"{root}:{have}" if have else root


def checkpoint_ready(spark: SparkSession) -> None:
    """Makes sure that the session has a checkpoint folder, that of spark.checkpoint.dir.

    Where neither names one, a folder of this machine will do for a local master, as in tests; on a cluster it is an error, since
    executors wouldn't see each other's files.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not (sc.master.startswith("local[") or sc.master == "local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(folder or "/tmp/annospark-checkpoints")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the checkpoint folder that all executors share."""
    import uuid

    checkpoint_ready(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def cut_lineage(rows: DataFrame) -> DataFrame:
    """rows, written to the checkpoint folder. For tables of ids, far smaller than the texts they stem from: an eighth of the
    shuffle partitions holds them, so that a loop doesn't leave thousands of tiny files."""
    checkpoint_ready(rows.sparkSession)
    return rows.coalesce(max(8, shuffle_parts(rows.sparkSession) // 8)).checkpoint()


#: What a Python worker keeps from task to task: name -> (made value, when it was last asked for).
_KEPT: dict[str, tuple[object, float]] = {}


def kept(name: str, make: Callable[[], object]) -> object:
    """A value that the tasks of one worker process share, made at the first call."""
    value = _KEPT[name][0] if name in _KEPT else make()
    _KEPT[name] = (value, time.monotonic())
    return value


def tidy(run: Callable) -> Callable:
    """The task function `run`; after its last batch the worker, which Spark keeps for further tasks, gives freed memory back to
    the system and drops what no task has asked for lately."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        for name in [n for n, (_, at) in _KEPT.items() if time.monotonic() - at > 10]:
            del _KEPT[name]
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):  # another C library: it keeps what it has
            pass

    return each


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_remainder(doc_id: str = "doc_id", modulus: int = 4) -> Column:
    """crc32 of the id's text, modulo `modulus`: what splits learned rows from held-out rows."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(modulus))


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The column's texts; null becomes the empty text."""
    return [t or "" for t in batch.column(name).to_pylist()]


def byte_slices(batch: pa.RecordBatch, name: str = "text", most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yields (first row, end row, bytes, offsets): the UTF-8 bytes of successive rows without a copy
    and each row's start in them. A slice ends at `most` bytes but holds one row at least."""
    col = batch.column(name)
    if pa.types.is_null(col.type):
        col = col.cast(pa.string())
    n = len(col)
    if n == 0:
        return
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, dtype=kind)[col.offset : col.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1)
        j = min(j, n)
        yield i, j, raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


_MIX = np.uint64(0xFF51AFD7ED558CCD)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads all bits of 64-bit values over all bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * _MIX
    return h ^ (h >> np.uint64(29))


def spread(chunk: int) -> int:
    """A number of a chunk that deals chunks evenly, though their own numbers are a partition's and a count within it."""
    return (chunk * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) >> 33


class Rolling:
    """Fingerprints of all windows of a byte array: prefix sums of a polynomial modulo 2**64, so that a
    window of any length costs two look-ups."""

    BASE = 0x9E3779B97F4A7C15
    _table = np.random.Generator(np.random.PCG64(20240601)).integers(1, 2**63 - 1, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    _pow = np.ones(1, np.uint64)
    _inv = np.ones(1, np.uint64)

    @classmethod
    def _powers(cls, n: int) -> None:
        if len(cls._pow) < n:
            size = 1 << math.ceil(math.log2(max(n, 2)))
            for name, base in (("_pow", cls.BASE), ("_inv", pow(cls.BASE, -1, 1 << 64))):
                x = np.full(size, base, dtype=np.uint64)
                x[0] = 1
                setattr(cls, name, np.multiply.accumulate(x))

    def __init__(self, data: np.ndarray):
        self._powers(len(data) + 1)
        terms = self._table[data]
        terms *= self._pow[: len(data)]
        self.prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(terms, out=self.prefix[1:])

    def at(self, starts: np.ndarray, length: int) -> np.ndarray:
        return mixed((self.prefix[starts + length] - self.prefix[starts]) * self._inv[starts])

    def all(self, length: int) -> np.ndarray:
        n = len(self.prefix) - length
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mixed((self.prefix[length:] - self.prefix[:n]) * self._inv[:n])

    def between(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.prefix[ends] - self.prefix[starts]) * self._inv[starts])


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 40) -> DataFrame:
    """Connected components of an edge list of longs: rows (node, component), component = smallest node
    reachable. Alternates large-star and small-star steps, each a shuffle of the edges, and cuts the
    lineage with checkpoint() each round. The edge list shrinks to stars; nothing is gathered anywhere.

    Nulls and loops are ignored; an empty list gives an empty result.
    """
    e = cut_lineage(edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).where("hi > lo").distinct())
    seen = None
    for _ in range(rounds):
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(e.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        # Written, so that the join shuffles both sides for itself and Spark can split the rows of a hub.
        least = cut_lineage(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).where("hi > lo").distinct()
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        e = (
            large.join(low, "hi").where("lo > m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
            .unionByName(low.select("hi", F.col("m").alias("lo"))).distinct()
        )
        e = cut_lineage(e)
        now = e.agg(F.count("*").alias("n"), F.sum("lo").alias("s"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("x")).first()
        if seen == now:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(e.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())
