"""Token ids as fixed-width packed bits.

Format: a folder of Parquet files whose rows are blocks. A block holds whole documents, in order, until it has about
BLOCK_IDS ids: `payload` has each id in the `bits` bits that the vocabulary needs, least significant bit first, one after
the other, so id k of a block begins at bit k * bits and numpy unpacks any range at once. `doc_ids` and `lengths` tell whose ids
these are, `part` and `part_start` where the block stands: parts are ranges of doc_id in ascending order, part_start counts the ids of
the part before the block. The folder `parts` beside the blocks gives the ids in all earlier parts.
Spark writes both, so an attempt that is lost leaves nothing behind, and any store that Spark reaches will do.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import shuffle_parts, tidy
from .pieces import shared_encoder

BLOCK_IDS = 1 << 16
_BLOCKS = "part int, block int, part_start long, n_ids long, bits int, doc_ids array<long>, lengths array<long>, payload binary"


def bits_needed(vocabulary: int) -> int:
    """Least number of bits that hold the ids 0 to vocabulary - 1."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """ids in `bits` bits each, least significant first, padded to whole bytes at the end."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    out = []
    for i in range(0, len(ids), 1 << 15):  # a multiple of 8 ids fills whole bytes
        out.append(np.packbits((ids[i : i + (1 << 15), None].astype(np.uint32) >> np.arange(bits, dtype=np.uint32)).astype(np.uint8) & 1, bitorder="little").tobytes())
    return b"".join(out)


def unpack(payload: bytes, bits: int, start: int, n: int) -> np.ndarray:
    """ids start to start + n of a packed block, whatever comes before them."""
    if bits in (8, 16, 32):
        return np.frombuffer(payload, f"<u{bits // 8}", count=n, offset=start * bits // 8).astype(np.uint32)
    out = np.empty(n, np.uint32)
    weights = np.left_shift(np.uint32(1), np.arange(bits, dtype=np.uint32))
    for i in range(0, n, 1 << 15):
        k = min(1 << 15, n - i)
        first = (start + i) * bits
        raw = np.frombuffer(payload, np.uint8, count=((first + k * bits + 7) // 8) - first // 8, offset=first // 8)
        out[i : i + k] = (np.unpackbits(raw, bitorder="little")[first % 8 : first % 8 + k * bits].reshape(k, bits) * weights).sum(1, dtype=np.uint32)
    return out


def _write(tokenizer_path: str, end_id: int | None, block_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(tokenizer_path)
        bits = bits_needed(encoder.vocabulary)
        part, block, before = TaskContext.get().partitionId(), 0, 0
        tail = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
        docs, lengths, parts, n = [], [], [], 0

        def row():
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary())
            values = (part, block, before, n, bits, docs, lengths, pack(np.frombuffer(b"".join(parts), "<u4"), bits))
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=["part", "block", "part_start", "n_ids", "bits", "doc_ids", "lengths", "payload"])

        for b in batches:
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
                ids = encoder.encode(text.as_py() or "") + tail
                docs.append(doc)
                lengths.append(len(ids) // 4)
                parts.append(ids)
                n += len(ids) // 4
                if n >= block_ids:
                    yield row()
                    block, before = block + 1, before + n
                    docs, lengths, parts, n = [], [], [], 0
                    encoder.trim()
        if docs:
            yield row()

    return tidy(run)


def write_ids(docs: DataFrame, path: str, tokenizer_path: str, *, end_id: int | None = 0, parts: int | None = None, block_ids: int = BLOCK_IDS) -> None:
    """Encodes every whole text and writes the ids under `path` in ascending doc_id order.

    Null and empty texts have the end id only (nothing if `end_id` is None). Null ids come first. Repeated rows are written
    each; rows of one id are in the order of their texts' hashes. Other columns are ignored. An empty table writes files without blocks.
    `parts` ranges of doc_id and hash (default: the number of shuffle partitions) are sorted and encoded on their own, so that an id that very many rows share isn't one range.
    """
    spark = docs.sparkSession
    parts = parts or shuffle_parts(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(parts, F.col("doc_id"), F.xxhash64("text")).sortWithinPartitions(F.col("doc_id"), F.xxhash64("text"))
    rows.mapInArrow(_write(tokenizer_path, end_id, block_ids), _BLOCKS).write.option("compression", "zstd").parquet(f"{path}/blocks")
    totals = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks").groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
    start = F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_ids")  # one row for each part
    totals.select("part", start.alias("start")).coalesce(1).write.parquet(f"{path}/parts")


def _unpack_docs(with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                at, rows = 0, []
                for doc, n in zip(r["doc_ids"], r["lengths"]):
                    ids = unpack(r["payload"], r["bits"], at, n)
                    rows.append((doc, r["start"] + at, n, zlib.crc32(ids.astype("<u4").tobytes()), *([ids] if with_ids else [])))
                    at += n
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), *([pa.list_(pa.int64())] if with_ids else []))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] if with_ids else [])])

    return run


def _blocks(spark: SparkSession, path: str) -> DataFrame:
    blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
    parts = spark.read.schema("part int, start long").parquet(f"{path}/parts")
    # `parts` has a row for each task that wrote, so a few MB even for 100,000 tasks.
    return blocks.join(F.broadcast(parts), "part").withColumn("start", F.col("start") + F.col("part_start"))


def read_ids(spark: SparkSession, path: str, *, with_ids: bool = False) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids_crc32[, ids]) of a written folder: start counts the ids of all documents before, the crc32 is
    that of the document's unpacked ids as little-endian unsigned 32-bit integers."""
    kinds = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    return _blocks(spark, path).select("start", "bits", "doc_ids", "lengths", "payload").mapInArrow(_unpack_docs(with_ids), kinds)


def read_range(spark: SparkSession, path: str, start: int, n: int) -> list[int]:
    """ids start to start + n of the whole stream, reading only the blocks that hold them."""
    hit = _blocks(spark, path).where((F.col("start") < start + n) & (F.col("start") + F.col("n_ids") > start)).orderBy("start")
    out: list[int] = []
    for r in hit.select("start", "n_ids", "bits", "payload").toLocalIterator():
        first = max(start, r.start)
        out += unpack(bytes(r.payload), r.bits, first - r.start, min(start + n, r.start + r.n_ids) - first).tolist()
    return out
