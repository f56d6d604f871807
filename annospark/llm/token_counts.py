"""Token counts without ids: pieces are counted once for each distinct pre-token.

A task turns its documents into an inverted list: each distinct pre-token with the documents that hold it
and how often. The lists are dealt by the pre-token's hash, so that each distinct pre-token meets the tokenizer
in one place only and its count is joined to all its lists there. A pre-token that is frequent in a chunk, of which there are few, is dealt by
the chunk as well, so that the lists of a very frequent one don't meet in one task; each place then counts it once. What comes back
is, for each chunk of documents, a vector of sums, and the vectors of a chunk are added. Lists travel as packed arrays, not as a row for each pair.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_slices, shuffle_parts, spread, tidy
from .pieces import piece_keys, shared_encoder

CHUNK_BYTES = 2 << 20
#: A pre-token is frequent in a chunk if one of so many of its documents holds it, and 32 at least.
FREQUENT = 8
_LISTS = "bucket int, chunk long, own boolean, n int, sizes binary, keys binary, counts binary, docs binary, freqs binary"
_SUMS = "chunk long, own boolean, ids binary, sums binary"


def _packed(x: np.ndarray) -> tuple[bytes, int]:
    """Bytes of unsigned integers in 1, 2 or 4 bytes each, the width first."""
    top = int(x.max()) if len(x) else 0
    width = 1 if top < 256 else 2 if top < 65536 else 4
    return bytes([width]) + x.astype(f"<u{width}").tobytes()


def _unpacked(b: bytes) -> np.ndarray:
    return np.frombuffer(b, f"<u{b[0]}", offset=1)


def _lists(buckets: int):
    def chunk_rows(chunk: int, ids: list, texts: list[str], n_bytes: np.ndarray) -> pa.RecordBatch:
        cut = [piece_keys(t) for t in texts]
        lens = np.fromiter(map(len, cut), np.int64, len(cut))
        codes, keys = pd.factorize(np.array([k for c in cut for k in c], dtype=object)) if lens.sum() else (np.zeros(0, np.int64), np.zeros(0, object))
        del cut
        pairs, freqs = np.unique(codes.astype(np.int64) * len(texts) + np.repeat(np.arange(len(texts)), lens), return_counts=True)
        code, doc = pairs // max(1, len(texts)), pairs % max(1, len(texts))
        raw = [k.encode() for k in keys]
        held = np.bincount(code, minlength=len(raw))
        hashed = np.fromiter((zlib.crc32(k) for k in raw), np.int64, len(raw))
        bucket = np.where(held >= np.maximum(32, len(texts) / FREQUENT), hashed + spread(chunk), hashed) % buckets
        rows = {n: [] for n in ("bucket", "chunk", "own", "n", "sizes", "keys", "counts", "docs", "freqs")}

        def add(*values):
            for col, v in zip(rows.values(), values):
                col.append(v)

        of = bucket[code]
        order = np.argsort(of, kind="stable")
        edges = np.searchsorted(of[order], np.arange(buckets + 1))
        by_key = np.argsort(bucket, kind="stable")
        key_edges = np.searchsorted(bucket[by_key], np.arange(buckets + 1))
        for b in range(buckets):
            at = order[edges[b] : edges[b + 1]]
            if len(at):
                own = by_key[key_edges[b] : key_edges[b + 1]]
                some = [raw[i] for i in own]
                add(b, chunk, False, len(texts), _packed(np.fromiter(map(len, some), np.int64, len(some))), b"".join(some), _packed(held[own]), _packed(doc[at]), _packed(freqs[at]))
        has = np.array([i is not None for i in ids])
        add(spread(chunk) % buckets, chunk, True, len(texts), np.array([i or 0 for i in ids], "<i8").tobytes(), has.tobytes(), n_bytes.astype("<i8").tobytes(), b"", b"")
        kinds = (pa.int32(), pa.int64(), pa.bool_(), pa.int32(), *[pa.binary()] * 5)
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(rows.values(), kinds)], names=list(rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            for i, j, _, offsets in byte_slices(batch, most=CHUNK_BYTES):
                part = batch.slice(i, j - i)
                yield chunk_rows(chunk, part.column("doc_id").to_pylist(), [t or "" for t in part.column("text").to_pylist()], np.diff(offsets))
                chunk += 1

    return tidy(run)


def _counted(tokenizer_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All lists of a bucket: counts each of its pre-tokens once and sums by chunk."""
        encoder = shared_encoder(tokenizer_path)
        lists, keys, own = [], [], []
        for batch in batches:
            for r in batch.to_pylist():
                if r["own"]:
                    own.append(r)
                    continue
                ends = np.cumsum(_unpacked(r.pop("sizes")), dtype=np.int64)
                raw = r.pop("keys")
                keys += [raw[s:e].decode() for s, e in zip([0, *ends[:-1].tolist()], ends.tolist())]
                lists.append(r | {"k": len(ends)})
        out = [(r["chunk"], True, r["sizes"] + r["keys"], r["counts"]) for r in own]
        if lists:
            codes, distinct = pd.factorize(np.array(keys, dtype=object))
            del keys
            n = np.empty(len(distinct), np.int64)
            for i, key in enumerate(distinct):
                n[i] = len(encoder.piece_ids(key)) // 4
                if i % 50_000 == 49_999:
                    encoder.trim()
            encoder.trim()
            at = 0
            for r in lists:
                pieces = np.repeat(n[codes[at : at + r["k"]]], _unpacked(r["counts"]))
                at += r["k"]
                sums = np.bincount(_unpacked(r["docs"]), weights=pieces * _unpacked(r["freqs"]).astype(np.int64), minlength=r["n"])
                out.append((r["chunk"], False, b"", _packed(sums.astype(np.int64)) if sums.max() < 2**32 else b"\x08" + sums.astype("<u8").tobytes()))
        kinds = (pa.int64(), pa.bool_(), pa.binary(), pa.binary())
        for i in range(0, len(out), 4096):
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out[i : i + 4096]), kinds)], names=["chunk", "own", "ids", "sums"])

    return run


def _added(table: pa.Table) -> pa.Table:
    """All vectors of a chunk: a row for each of its documents."""
    total, ids, has, n_bytes = 0, None, None, None
    for own, i, s in zip(*(table.column(c).to_pylist() for c in ("own", "ids", "sums"))):
        if own:
            n = len(s) // 8
            ids, has, n_bytes = np.frombuffer(i[: 8 * n], "<i8"), np.frombuffer(i[8 * n :], bool), np.frombuffer(s, "<i8")
        else:
            total = total + _unpacked(s).astype(np.int64)
    total = np.broadcast_to(np.asarray(total, np.int64), ids.shape)
    return pa.table({"doc_id": pa.array(ids, mask=~has), "n_bytes": pa.array(n_bytes), "n_tokens": pa.array(total)})


def count_tokens(docs: DataFrame, tokenizer_path: str, *, buckets: int | None = None) -> DataFrame:
    """Rows (doc_id, n_bytes, n_tokens): what the tokenizers library gives for each whole text, counted by pre-token.

    `tokenizer_path` names a byte-level BPE file of the tokenizers library that every executor can read; begin, end and added
    special tokens are left out, special strings in texts are one token each. Null and empty texts have 0 bytes and
    0 tokens. Repeated rows give repeated rows; other columns are ignored; an empty table gives an empty table.
    `buckets` (default: 4 for each shuffle partition) parts the pre-tokens: a task holds one bucket's lists, so
    give more buckets for more text.
    """
    spark = docs.sparkSession
    buckets = buckets or 4 * shuffle_parts(spark)
    lists = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_lists(buckets), _LISTS)
    sums = lists.groupBy("bucket").applyInArrow(_bucket(tokenizer_path), _SUMS)
    return sums.groupBy("chunk").applyInArrow(_added, "doc_id long, n_bytes long, n_tokens long")


def _bucket(tokenizer_path: str):
    run = _counted(tokenizer_path)

    def each(table: pa.Table) -> pa.Table:
        out = list(run(table.to_batches()))
        return pa.Table.from_batches(out)

    return each
