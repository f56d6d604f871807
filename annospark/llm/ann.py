"""Approximate nearest neighbours with a permutation index.

A bounded sample of vectors serves as pivots. A vector is stood for by its nearest pivots in order (its places), and is posted in
the inverted files of the first few of them. A query reads only the files of its own nearest pivots. There it ranks
the posted vectors by footrule distance (Spearman's, missing pivots at the end) and measures exactly those
within the query's bound: the footrule that the wanted share of a bounded sample of vectors stays below. So all files stop at one
and the same distance, though none knows of the others. The best of all files are the answer.

A file is a group of its own and is split by counts into parts of `list_rows` vectors and blocks of `list_rows` queries, so a pivot
that is near to very many vectors doesn't make a large task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SLICE_BYTES

_RESULT = "query_id long, vec_id long, score double"


def usable(vec: str = "embedding") -> Column:
    """Not null or empty, every component finite, not all zero."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return F.coalesce(F.col(vec).isNotNull() & (F.size(vec) > 0) & ~bad & F.exists(vec, lambda x: x != 0), F.lit(False))


def places(vectors: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    """For each vector the place of each pivot in its order, nearest first, ties to the smaller pivot; `length` for those behind."""
    d = (vectors**2).sum(1)[:, None] - 2 * vectors @ pivots.T + (pivots**2).sum(1)[None]
    order = np.argsort(d, axis=1, kind="stable")[:, :length]
    out = np.full(d.shape, length, np.int16)
    np.put_along_axis(out, order, np.arange(length, dtype=np.int16)[None], 1)
    return out


def footrule(own: np.ndarray, by_pivot: np.ndarray, length: int) -> np.ndarray:
    """Footrule distance of one query's places to many vectors'; `by_pivot` has a row for each pivot. A pivot that one lacks counts as in place `length`.

    Only the rows of the query's own pivots are read: beyond them, a vector's distance is what its remaining places have left to `length`.
    """
    order = np.flatnonzero(own < length)
    held = by_pivot[order]
    far = np.abs(held - own[order, None]) + held
    return far.sum(0, dtype=np.int32) + length * (length + 1) // 2 - length * len(order)


def _vectors(column: pa.Array) -> np.ndarray:
    """A list column without nulls, whose lists have one length, as a matrix."""
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 0))


def search(
    vectors: DataFrame, queries: DataFrame, *, k: int = 10, n_pivots: int = 256, order_length: int = 128, post: int = 2, visit: int = 96,
    share: float = 0.035, least: int = 512, bound_sample: int = 2048, list_rows: int = 4096, seed: int = 11,
) -> DataFrame:
    """The k nearest of `vectors` by Euclidean distance for each row of `queries`: (query_id, rank, vec_id, score).

    Both tables have vec_id and embedding; other columns are ignored. A query never finds its own id. score is the distance of the original vectors in
    double precision; rank counts from 1, ties go to the smaller vec_id. Rows that are null, zero or not finite, that lack an id, or whose length isn't the
    most frequent one (of equally frequent the shortest) take no part. Of repeated ids the nearest row counts, of repeated queries the row with the smallest hash.

    The index is fitted on `n_pivots` vectors (those with the smallest hash of their ids and `seed`) but posts all of them, each in the files of its
    `post` nearest pivots; a query reads the files of its `visit` nearest. The bound on footrule is taken from `bound_sample` vectors: it lets through about
    `share` of all vectors, `least` of them at least; where that is all of them, every file is read. With fewer than k candidates all are
    returned. Empty tables give no rows.
    """
    spark = vectors.sparkSession
    good = lambda df: df.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(usable() & F.col("vec_id").isNotNull())
    lengths = good(vectors).groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if lengths is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, n = lengths["dim"], lengths["count"]
    base = good(vectors).where(F.size("embedding") == dim)
    asked = good(queries).where(F.size("embedding") == dim)
    kind = np.float32 if dict(vectors.dtypes)["embedding"] == "array<float>" else np.float64
    of = lambda rows: np.array([r.embedding for r in rows], np.float64)
    hashed = F.xxhash64("vec_id", F.lit(seed))
    sample = of(base.orderBy(hashed, "vec_id", F.xxhash64("embedding")).limit(max(n_pivots, bound_sample)).collect())
    pivots, length = sample[:n_pivots], min(order_length, len(sample), n_pivots)
    let_through = min(1.0, max(share, least / n))
    visit = len(pivots) if let_through >= 1 else min(visit, len(pivots))
    post = min(post, len(pivots))
    sample_places = places(sample, pivots, length).T.copy()

    def posted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each of the first pivots: the vector, its places, and which of its pivots come before this one."""
        for b in batches:
            step = max(1, SLICE_BYTES // (8 * (dim + len(pivots))))
            for i in range(0, len(b), step):
                part = b.slice(i, step)
                x = _vectors(part.column("embedding"))
                at = places(x.astype(np.float64), pivots, length)
                first = np.argsort(at, axis=1, kind="stable")[:, :post]
                raw = [v.tobytes() for v in x.astype(kind)]
                code = [p.tobytes() for p in at.astype("<u2" if length > 255 else "u1")]
                for j in range(post):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(first[:, j], pa.int32()), part.column("vec_id"), pa.array([f[:j].astype("<i4").tobytes() for f in first], pa.binary()), pa.array(raw, pa.binary()), pa.array(code, pa.binary())],
                        names=["pivot", "vec_id", "before", "vector", "places"],
                    )

    def asking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each file that a query reads: the query, its places, and its bound."""
        for b in batches:
            x = _vectors(b.column("embedding")).astype(np.float64)
            at = places(x, pivots, length) if len(x) else np.zeros((0, len(pivots)), np.int16)
            nearest = (x**2).sum(1)[:, None] - 2 * x @ pivots.T + (pivots**2).sum(1)[None] if len(x) else np.zeros((0, len(pivots)))
            nearest = np.argsort(nearest, axis=1, kind="stable")[:, :visit]
            for q, v, own, files in zip(b.column("vec_id").to_pylist(), x, at, nearest):
                far = np.sort(footrule(own, sample_places, length))
                most = int(far[min(len(far), int(np.ceil(let_through * len(far)))) - 1]) if let_through < 1 else 1 << 30
                m = len(files)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(files, pa.int32()), pa.array([q] * m, pa.int64()), pa.array([most] * m, pa.int64()), pa.array([v.tobytes()] * m, pa.binary()), pa.array([own.astype("<i2").tobytes()] * m, pa.binary()), pa.array([files.astype("<i4").tobytes()] * m, pa.binary())],
                    names=["pivot", "query_id", "most", "vector", "places", "files"],
                )

    files = base.mapInArrow(posted, "pivot int, vec_id long, before binary, vector binary, places binary")
    one = asked.groupBy("vec_id").agg(F.min(F.struct(F.xxhash64("embedding").alias("h"), "embedding")).alias("r")).select("vec_id", "r.embedding")
    reads = one.mapInArrow(asking, "pivot int, query_id long, most long, vector binary, places binary, files binary")

    # How many parts and blocks a file needs: a row for each pivot.
    parts_of = lambda df, name: df.groupBy("pivot").agg(F.ceil(F.count("*") / list_rows).cast("int").alias(name))
    sizes = F.broadcast(parts_of(files, "parts").join(parts_of(reads, "blocks"), "pivot"))
    deal = lambda of, own: F.pmod(F.xxhash64(of), F.col(own)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    files = files.join(sizes, "pivot").withColumn("part", deal("vec_id", "parts")).withColumn("block", every("blocks")).drop("parts", "blocks")
    reads = reads.join(sizes, "pivot").withColumn("block", deal("query_id", "blocks")).withColumn("part", every("parts")).drop("parts", "blocks")

    def answer(key: tuple, own: pa.Table, asked: pa.Table) -> pa.Table:
        out = {"query_id": [np.zeros(0, np.int64)], "vec_id": [np.zeros(0, np.int64)], "score": [np.zeros(0)]}
        if len(own) and len(asked):
            ids = own.column("vec_id").to_numpy()
            x = np.frombuffer(b"".join(own.column("vector").to_pylist()), kind).reshape(-1, dim).astype(np.float64)
            code = np.frombuffer(b"".join(own.column("places").to_pylist()), "<u2" if length > 255 else "u1").reshape(len(ids), -1)
            by_pivot = np.ascontiguousarray(code.T).astype(np.int16)
            before = [np.frombuffer(s, "<i4") for s in own.column("before").to_pylist()]
            wide = max(map(len, before))
            before = np.array([np.concatenate((s, np.full(wide - len(s), len(pivots)))) for s in before], np.int64).reshape(len(ids), wide)
            for q, most, raw, own_places, read in zip(*(asked.column(c).to_pylist() for c in ("query_id", "most", "vector", "places", "files"))):
                seen = np.zeros(len(pivots) + 1, bool)
                seen[np.frombuffer(read, "<i4")] = True
                near = np.flatnonzero((footrule(np.frombuffer(own_places, "<i2"), by_pivot, length) <= most) & ~seen[before].any(1) & (ids != q))  # a vector counts in the first of its files that the query reads
                if len(near):
                    d = np.sqrt(((x[near] - np.frombuffer(raw, np.float64)) ** 2).sum(1))
                    best = np.lexsort((ids[near], d))
                    best = best[np.sort(np.unique(ids[near][best], return_index=True)[1])[:k]]
                    for name, values in (("query_id", np.full(len(best), q)), ("vec_id", ids[near][best]), ("score", d[best])):
                        out[name].append(values)
        return pa.table({name: np.concatenate(v) for name, v in out.items()})

    cell = ["pivot", "part", "block"]
    found = files.groupBy(*cell).cogroup(reads.groupBy(*cell)).applyInArrow(answer, _RESULT)
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
