"""Exact removal of long repeats by blockwise suffix sorting with a difference cover.

A difference cover D modulo v holds, for any two positions, a shift d < v that takes both to positions whose remainders lie in D.
So if two strings of `length` bytes are equal, equal strings of length - v + 1 bytes begin at two cover samples within them.

1. Cover samples: every position whose remainder modulo v lies in D is named by the string that begins there. Names are ranked in
   blocks dealt by the name; what comes back to a document are its samples whose rank is shared.
2. Suffixes: only a position with a shared sample less than v bytes on can begin a repeat. Runs of such suffixes that agree in an
   anchor (the least-hashed short string within the `length` bytes) are dealt to the anchor's block with the text they need.
3. Blocks: one block at a time sorts its suffixes by the fingerprint of their `length` bytes; neighbours with one fingerprint are
   compared byte by byte, in full at the head of a run and by the one new byte along it.
4. Documents get back runs of repeated suffixes, and lose the bytes that these cover.

A block's memory follows its own suffixes: the number of blocks grows with the shuffle partitions. Samples and suffixes travel as
packed arrays, and equal runs of one slice of text travel once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Rolling, byte_slices, mixed, shared_folder, shuffle_parts, spread, tidy
from .token_counts import _packed, _unpacked

#: Bits of an anchor's position; a longer document is cut into overlapping pieces.
_PLACE_BITS = 24
_PLACE = np.uint64((1 << _PLACE_BITS) - 1)
PIECE = 4 << 20
_ROWS = "bucket int, chunk long, own boolean, a binary, b binary, c binary, d binary, e binary"
_NAMES = [f.split()[0] for f in _ROWS.split(", ")]
_KINDS = (pa.int32(), pa.int64(), pa.bool_(), *[pa.binary()] * 5)
_BACK = "chunk long, own boolean, a binary, b binary, c binary"


def difference_cover(most: int) -> tuple[int, np.ndarray]:
    """The largest Colbourn-Ling cover with a period of `most` at most: (v, D), |D| about 1.5 * sqrt(v). 1 is covered by {0}."""
    v, steps, r = 1, [], 0
    while 24 * r * r + 36 * r + 13 <= most:
        v = 24 * r * r + 36 * r + 13
        steps = [1] * r + [r + 1] + [2 * r + 1] * r + [4 * r + 3] * (2 * r + 1) + [2 * r + 2] * (r + 1) + [1] * r
        r += 1
    return v, np.concatenate(([0], np.cumsum(steps, dtype=np.int64))).astype(np.int64)


def _batch(rows: list[tuple], kinds=_KINDS, names=None) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names or _NAMES)


def _own(chunk: int, buckets: int, rows: pa.RecordBatch, lens: np.ndarray) -> tuple:
    """Which documents a chunk holds: ids (with the null ones), hashes and lengths in bytes."""
    ids = rows.column("doc_id").to_pylist()
    return (spread(chunk) % buckets, chunk, True, np.array([i or 0 for i in ids], "<i8").tobytes(), np.array([i is not None for i in ids]).tobytes(), np.array(rows.column("hash").to_pylist(), "<i8").tobytes(), lens.astype("<i8").tobytes(), b"")


def _dealt(bucket: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(edges)).tolist():
        yield b, order[edges[b] : edges[b + 1]]


def _samples(length: int, v: int, cover: np.ndarray, buckets: int):
    width = length - v + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            for i, j, data, offsets in byte_slices(batch, most=2 << 20):
                lens = np.diff(offsets)
                docs = np.flatnonzero(lens >= length)
                if not len(docs):
                    continue
                place = [((np.arange(-(-n // v))[:, None] * v + cover).ravel()) for n in lens[docs].tolist()]
                place = [p[p <= n - width] for p, n in zip(place, lens[docs].tolist())]
                doc = np.repeat(docs, [len(p) for p in place])
                place = np.concatenate(place)
                name = Rolling(data).at(place + offsets[doc], width)
                rows = [(b, chunk, False, (name[at] >> np.uint64(32)).astype("<u4").tobytes(), _packed(doc[at]), _packed(place[at]), b"", b"") for b, at in _dealt((name % np.uint64(buckets)).astype(np.int64), buckets)]
                rows.append(_own(chunk, buckets, batch.slice(i, j - i), lens))
                yield _batch(rows)
                chunk += 1

    return tidy(run)


def _ranked(table: pa.Table) -> pa.Table:
    """One block of sample names: hands back to each chunk those that occur more than once."""
    rows = [table.column(c).to_pylist() for c in _NAMES[1:6]]
    out, lists = [], []
    for chunk, own, a, b, c in zip(*rows):
        if own:
            continue
        lists.append((chunk, np.frombuffer(a, "<u4"), b, c))
    out = [(r["chunk"], True, r["a"] + r["b"], r["c"], r["d"]) for r in table.to_pylist() if r["own"]]
    if lists:
        names = np.concatenate([x[1] for x in lists])
        order = np.argsort(names, kind="stable")
        ranked = names[order]
        same = ranked[1:] == ranked[:-1]
        shared = np.zeros(len(names), bool)
        shared[order] = np.concatenate((same, [False])) | np.concatenate(([False], same))
        at = 0
        for chunk, own_names, b, c in lists:
            mine = shared[at : at + len(own_names)]
            at += len(own_names)
            if mine.any():
                out.append((chunk, False, _packed(_unpacked(b)[mine]), _packed(_unpacked(c)[mine]), b""))
    return pa.Table.from_batches([_batch(out, (pa.int64(), pa.bool_(), *[pa.binary()] * 3), ["chunk", "own", "a", "b", "c"])])


def _by_doc(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list]:
    """Ids, whether they are set, hashes and lengths of a chunk's documents, and the packed rows that came back."""
    ids = has = hashes = lens = None
    back = []
    for own, a, b, c in zip(*(table.column(n).to_pylist() for n in ("own", "a", "b", "c"))):
        if own:
            n = len(b) // 8
            ids, has, hashes, lens = np.frombuffer(a[: 8 * n], "<i8"), np.frombuffer(a[8 * n :], bool), np.frombuffer(b, "<i8"), np.frombuffer(c, "<i8")
        else:
            back.append((a, b, c))
    return ids, has, hashes, lens, back


def _span_rows(ids, has, hashes, doc, first, last) -> pa.Table:
    """Rows (doc_id, hash, first, last) with sorted, disjoint inclusive spans as packed arrays, from any spans of documents."""
    order = np.lexsort((first, doc))
    doc, first, last = doc[order], first[order], last[order]
    far = int(last.max()) + 2 if len(last) else 1
    reach = np.maximum.accumulate(last + doc * far) - doc * far  # the running maximum within a document
    fresh = np.concatenate(([True], (doc[1:] != doc[:-1]) | (first[1:] > reach[:-1] + 1)))[: len(doc)]
    head = np.flatnonzero(fresh)
    tail = np.concatenate((head[1:], [len(doc)])) - 1
    d, s, e = doc[head], first[head], reach[tail] if len(head) else first[head]
    cut = np.flatnonzero(np.concatenate(([True], d[1:] != d[:-1])))[: len(d)] if len(d) else np.zeros(0, np.int64)
    ends = np.concatenate((cut[1:], [len(d)])) if len(cut) else cut
    return pa.table({
        "doc_id": pa.array(ids[d[cut]], pa.int64(), mask=~has[d[cut]]), "hash": pa.array(hashes[d[cut]], pa.int64()),
        "first": pa.array([s[x:y].astype("<i8").tobytes() for x, y in zip(cut, ends)], pa.binary()), "last": pa.array([e[x:y].astype("<i8").tobytes() for x, y in zip(cut, ends)], pa.binary()),
    })


def _candidates(length: int, v: int):
    def each(table: pa.Table) -> pa.Table:
        ids, has, hashes, lens, back = _by_doc(table)
        doc = np.concatenate([_unpacked(a) for a, _, _ in back] or [np.zeros(0)]).astype(np.int64)
        place = np.concatenate([_unpacked(b) for _, b, _ in back] or [np.zeros(0)]).astype(np.int64)
        return _span_rows(ids, has, hashes, doc, np.maximum(place - v + 1, 0), np.minimum(place, lens[doc] - length))

    return each


def _window_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of x[i : i + width] for all i, by doubling."""
    n = len(x) - width + 1
    if n <= 0:
        return x[:0]
    have = 1
    while 2 * have <= width:
        x = np.minimum(x[: len(x) - have], x[have:])
        have *= 2
    return np.minimum(x[:n], x[width - have : width - have + n])


def _segments(length: int, gram: int, buckets: int):
    def pieces(batch: pa.RecordBatch):
        """(rows, bytes, start of each row in them, first byte of the row that is there): slices, a very long row in pieces."""
        for i, j, data, offsets in byte_slices(batch):
            if j - i > 1 or len(data) <= PIECE:
                yield i, j, data, offsets, 0
            else:
                for at in range(0, max(1, len(data) - length + 1), PIECE):
                    part = data[at : at + PIECE + length - 1]
                    yield i, j, part, np.array([0, len(part)]), at

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        squeeze = zstd.ZstdCompressor(level=1).compress
        for batch in batches:
            for i, j, data, offsets, shift in pieces(batch):
                rows = batch.slice(i, j - i)
                starts = []
                for d, (f, e) in enumerate(zip(rows.column("first").to_pylist(), rows.column("last").to_pylist())):
                    most = int(offsets[d + 1] - offsets[d]) - length
                    for x, y in zip(np.frombuffer(f, "<i8").tolist(), np.frombuffer(e, "<i8").tolist()):
                        x, y = max(0, x - shift), min(y - shift, most, PIECE - 1 if shift or len(rows) == 1 else most)
                        if y >= x:
                            starts.append(np.arange(x, y + 1) + offsets[d])
                if not starts:
                    continue
                at = np.concatenate(starts)
                rolling = Rolling(data)
                grams = rolling.all(gram)
                grams = ((grams >> np.uint64(_PLACE_BITS)) << np.uint64(_PLACE_BITS)) | np.arange(len(grams), dtype=np.uint64)
                least = _window_min(grams, length - gram + 1)[at]
                head = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1] + 1) | (least[1:] != least[:-1]))))
                count = np.diff(np.concatenate((head, [len(at)])))
                begin, anchor = at[head], least[head] >> np.uint64(_PLACE_BITS)
                whole = rolling.between(begin, begin + count + length - 1)
                _, rep, which = np.unique(whole ^ mixed(count.astype(np.uint64)), return_index=True, return_inverse=True)
                doc = np.searchsorted(offsets, begin, side="right") - 1
                bucket = (mixed(anchor) % np.uint64(buckets)).astype(np.int64)
                out = []
                for b, own in _dealt(bucket, buckets):
                    reps, member = np.unique(which[own], return_inverse=True)
                    r = rep[reps]
                    text = b"".join([data[s : s + n + length - 1].tobytes() for s, n in zip(begin[r].tolist(), count[r].tolist())])
                    out.append((b, chunk, False, _packed(count[r]), squeeze(text), _packed(member), _packed(doc[own]), _packed(begin[own] - offsets[doc[own]] + shift)))
                out.append(_own(chunk, buckets, rows, np.diff(offsets)))
                yield _batch(out)
                chunk += 1

    return tidy(run)


def repeated(text: np.ndarray, starts: np.ndarray, times: np.ndarray, length: int) -> np.ndarray:
    """Which of the suffixes at ascending `starts`, occurring `times` often each, share their first `length` bytes with another occurrence."""
    name = Rolling(text).at(starts, length)
    order = np.argsort(name, kind="stable")
    ranked, at = name[order], starts[order]
    tie = np.flatnonzero(ranked[1:] == ranked[:-1])
    out = times > 1
    if not len(tie):
        return out
    here, there = at[tie], at[tie + 1]
    partner = np.full(len(text) + 1, -1, np.int64)
    partner[here] = there
    along = (here > 0) & (partner[here - 1] == there - 1)
    equal = np.zeros(len(tie), bool)
    equal[along] = text[here[along] + length - 1] == text[there[along] + length - 1]
    full = np.flatnonzero(~along)
    windows = np.lib.stride_tricks.sliding_window_view(text, length)
    for i in range(0, len(full), 4096):
        some = full[i : i + 4096]
        equal[some] = (windows[here[some]] == windows[there[some]]).all(1)
    if equal.all():
        out[order[tie]] = True
        out[order[tie + 1]] = True
        return out
    for n in np.unique(ranked[tie]):  # two strings share a fingerprint somewhere: compare all of this block as they are
        group = order[np.searchsorted(ranked, n) : np.searchsorted(ranked, n, side="right")]
        held: dict[bytes, list] = {}
        for g in group.tolist():
            held.setdefault(windows[starts[g]].tobytes(), []).append(g)
        for same in held.values():
            if len(same) > 1:
                out[same] = True
    return out


def _sorted_block(length: int):
    def each(table: pa.Table) -> pa.Table:
        out, lists, texts, counts = [], [], [], []
        unsqueeze = zstd.ZstdDecompressor().decompress
        for r in table.to_pylist():
            if r["own"]:
                out.append((r["chunk"], True, r["a"] + r["b"], r["c"], r["d"]))
                continue
            n, member = _unpacked(r["a"]).astype(np.int64), _unpacked(r["c"]).astype(np.int64)
            texts.append(unsqueeze(r["b"]))
            counts.append(n)
            lists.append((r["chunk"], n, member, r["d"], _unpacked(r["e"]).astype(np.int64)))
        if lists:
            text, count = np.frombuffer(b"".join(texts), np.uint8), np.concatenate(counts)
            del texts
            times = np.concatenate([np.bincount(m, minlength=len(n)) for _, n, m, _, _ in lists])
            base = np.cumsum(count + length - 1) - (count + length - 1)
            edge = np.concatenate(([0], np.cumsum(count)))
            within = np.arange(edge[-1]) - np.repeat(edge[:-1], count)
            hit = repeated(text, np.repeat(base, count) + within, np.repeat(times, count), length)
            rise = hit & ((within == 0) | ~np.concatenate(([False], hit[:-1])))
            fall = hit & np.concatenate(((within[1:] == 0) | ~hit[1:], [True]))
            first, last = np.flatnonzero(rise), np.flatnonzero(fall)
            seg = np.searchsorted(edge, first, side="right") - 1
            from_run = np.searchsorted(seg, np.arange(len(count) + 1))
            at = 0
            for chunk, n, member, docs, begin in lists:
                runs = from_run[member + at + 1] - from_run[member + at]
                if runs.sum():
                    which = np.repeat(from_run[member + at] - np.concatenate(([0], np.cumsum(runs)[:-1])), runs) + np.arange(runs.sum())
                    start = np.repeat(begin, runs) + within[first[which]]
                    out.append((chunk, False, _packed(np.repeat(_unpacked(docs), runs)), _packed(start), _packed(last[which] - first[which])))
                at += len(n)
        return pa.Table.from_batches([_batch(out, (pa.int64(), pa.bool_(), *[pa.binary()] * 3), ["chunk", "own", "a", "b", "c"])])

    return each


def _repeats(length: int):
    def each(table: pa.Table) -> pa.Table:
        ids, has, hashes, _, back = _by_doc(table)
        doc, first, more = (np.concatenate([_unpacked(r[i]) for r in back] or [np.zeros(0)]).astype(np.int64) for i in range(3))
        return _span_rows(ids, has, hashes, doc, first, first + more + length - 1)

    return each


def _candidate_texts(rows: DataFrame, length: int, buckets: int) -> DataFrame:
    """rows with the runs of positions that might begin a repeat, of the documents that have any: rows (doc_id, hash, text, first, last).

    They are written, compressed, to the shared folder: what was shuffled to find them isn't needed any more when the blocks are dealt.
    """
    v, cover = difference_cover(max(1, length * 17 // 20))
    spans = "doc_id long, hash long, first binary, last binary"
    named = rows.mapInArrow(_samples(length, v, cover, buckets), _ROWS).groupBy("bucket").applyInArrow(_ranked, _BACK)
    near = named.groupBy("chunk").applyInArrow(_candidates(length, v), spans).dropDuplicates(["doc_id", "hash"])
    held = rows.join(near, rows["doc_id"].eqNullSafe(near["doc_id"]) & (rows["hash"] == near["hash"])).select(rows["doc_id"], rows["hash"], "text", "first", "last")
    held.write.option("compression", "zstd").parquet(path := shared_folder(rows.sparkSession, "candidates"))
    return rows.sparkSession.read.schema(held.schema).parquet(path)


def repeat_spans(docs: DataFrame, *, length: int = 400, buckets: int | None = None) -> DataFrame:
    """Rows (doc_id, hash, text, first, last) of the documents that hold repeats: bytes first to last, both included, packed as little-endian
    64-bit integers, are covered by strings of `length` bytes that also start elsewhere in the table.

    hash is xxhash64 of the text; rows that share id and text give one row and count as occurrences of each other. Strings never cross
    documents. Null and empty texts and those shorter than `length` have no repeats; other columns are ignored.
    """
    spark = docs.sparkSession
    buckets = buckets or 4 * shuffle_parts(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("hash"), "text").where(F.octet_length("text") >= length)
    spans = "doc_id long, hash long, first binary, last binary"
    held = _candidate_texts(rows, length, buckets)
    back = held.mapInArrow(_segments(length, min(12, max(1, length // 3)), buckets), _ROWS).groupBy("bucket").applyInArrow(_sorted_block(length), _BACK)
    found = back.groupBy("chunk").applyInArrow(_repeats(length), spans).groupBy("doc_id", "hash").agg(F.collect_list("first").alias("first"), F.collect_list("last").alias("last"))
    held = held.select("doc_id", "hash", "text").dropDuplicates(["doc_id", "hash"])
    same = held["doc_id"].eqNullSafe(found["doc_id"]) & (held["hash"] == found["hash"])
    return held.join(found, same).select(held["doc_id"], held["hash"], "text", "first", "last")


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for text, firsts, lasts in zip(b.column("text"), b.column("first").to_pylist(), b.column("last").to_pylist()):
            data = np.frombuffer(text.as_py().encode(), np.uint8)
            step = np.zeros(len(data) + 1, np.int32)
            for f, e in zip(firsts, lasts):
                np.add.at(step, np.frombuffer(f, "<i8"), 1)
                np.add.at(step, np.frombuffer(e, "<i8") + 1, -1)
            gone = np.cumsum(step[:-1]) > 0
            spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
            kept = data[~gone].tobytes()
            rows.append((int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
        cols = [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.int64(), pa.string(), pa.binary()))] if rows else [pa.array([], k) for k in (pa.int64(), pa.int64(), pa.string(), pa.binary())]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("hash"), *cols], names=["doc_id", "hash", "removed", "spans", "sha", "kept"])


def remove_repeats(docs: DataFrame, *, length: int = 400, buckets: int | None = None) -> DataFrame:
    """Rows (doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept), one for each row of `docs`.

    kept has the bytes that are left (cutting may fall within a character), n_spans counts the maximal removed runs. Every byte that a repeated string
    of `length` bytes covers goes, in all of its places; strings are judged on the input. Null and empty texts have 0 bytes.
    """
    found = repeat_spans(docs, length=length, buckets=buckets).mapInArrow(_without, "doc_id long, hash long, removed long, spans long, sha string, kept binary")
    text = F.coalesce("text", F.lit(""))
    base = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("h"), F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("all_sha"), text.cast("binary").alias("raw"))
    out = base.join(found, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("h") == F.col("hash")), "left")
    return out.select(F.col("id").alias("doc_id"), "n_bytes", F.coalesce("removed", F.lit(0)).cast("long").alias("n_removed"), F.coalesce("spans", F.lit(0)).cast("long").alias("n_spans"), F.coalesce("sha", "all_sha").alias("kept_sha256"), F.coalesce("kept", "raw").alias("kept"))
