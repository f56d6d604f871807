"""WARC archives of pages: a sharded writer whose files depend on the rows alone, and a reader that checks them.

Records are sorted by page id, then by payload digest. Ranges are cut at keys of a sample that a hash of the key chooses, so neither the number of tasks nor how Spark
dealt the rows shows in the files. A task writes its range as gzip members, one for each record, and begins another file where the compressed size has reached its bound.

Commit: files are written under names of the attempt; what the successful attempts wrote is a table of files, itself written by Spark; only then files get their final names and
the manifest is written. A reader trusts the manifest alone. A lost attempt leaves temporary files that no table names, and renaming may be repeated.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut_lineage, tidy

#: Compressed bytes after which a file is closed.
FILE_BYTES = 256 << 20
#: Bytes of payload in a range, for tables of many such; smaller ones have up to 64 ranges of 1 MiB and more.
RANGE_BYTES = 1 << 30
#: Keys sampled for each range.
OVERSAMPLE = 20
_DEALS = 16

_KEY = ["known", "page_id", "digest"]


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record_id(page_id: int | None, digest: bytes, copy: int) -> str:
    """The same for the same page, payload and number of the copy."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest.hex()}:{copy}')}>"


def _uri(url: str) -> str:
    """url without what would end a header: blanks and control characters in percent form."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def _member(headers: list[tuple[str, str]], block: bytes, level: int) -> bytes:
    """One record as a gzip member without a time stamp."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers), f"WARC-Block-Digest: sha1:{base32(hashlib.sha1(block).digest())}", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + b"\r\n\r\n") + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()


def page_member(page_id: int | None, url: str | None, payload: bytes, digest: bytes, copy: int, original: tuple[int | None, int] | None, date: str, level: int) -> bytes:
    """The record of a page. `original` is (page id, number of the copy) of the record that a revisit refers to, None for a response."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = [
        ("WARC-Type", "revisit" if original else "response"),
        ("WARC-Record-ID", record_id(page_id, digest, copy)),
        ("WARC-Date", date),
        ("WARC-Target-URI", _uri(url) if url else f"urn:page:{page_id}"),
        ("WARC-Payload-Digest", f"sha1:{base32(digest)}"),
    ]
    if page_id is not None:
        headers.append(("X-Page-ID", str(page_id)))
    if original:
        headers += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", record_id(original[0], digest, original[1]))]
        if original[0] is not None:
            headers.append(("X-Refers-To-Page-ID", str(original[0])))
    headers.append(("Content-Type", "application/http;msgtype=response"))
    return _member(headers, http if original else http + payload, level)


def _qualified(spark: SparkSession, path: str) -> str:
    """path as a URI of the store that Spark takes it from, so that tasks find the same one."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri("file://" + uri.removeprefix("file:") if uri.startswith("file:/") and not uri.startswith("file://") else uri)


class _File:
    """A file of records that is being written, under a name of this attempt."""

    def __init__(self, store: fs.FileSystem, folder: str, part: int, seq: int, date: str, level: int):
        self.part, self.seq, self.name = part, seq, f"part-{part:06d}-{seq:05d}.warc.gz"
        self.tmp = f".{self.name}.{TaskContext.get().taskAttemptId()}-{uuid.uuid4().hex[:8]}.tmp"
        self.stream, self.sha, self.bytes, self.records = store.open_output_stream(f"{folder}/{self.tmp}", compression=None), hashlib.sha1(), 0, 0
        info = f"format: WARC File Format 1.1\r\nconformsTo: http://iipc.github.io/warc-specifications/specifications/warc-format/warc-1.1/\r\n".encode()
        name = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, self.name)}>"), ("WARC-Date", date), ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")]
        self.put(_member(name, info, level), 0)

    def put(self, member: bytes, records: int = 1) -> None:
        self.stream.write(member)
        self.sha.update(member)
        self.bytes += len(member)
        self.records += records

    def close(self) -> tuple:
        self.stream.close()
        return self.part, self.seq, self.name, self.tmp, self.records, self.bytes, base32(self.sha.digest())


_FILES = "part int, seq int, file string, tmp string, records long, bytes long, sha1 string"


def _write(uri: str, file_bytes: int, revisit_bytes: int, date: str, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = _store(uri)
        store.create_dir(folder, recursive=True)
        done: list[tuple] = []
        file, key, copy, note = None, None, 0, None
        for b in batches:
            known, ids, digests, kinds, heads, urls, parts = (b.column(c).to_pylist() for c in ("known", "page_id", "digest", "kind", "head", "url", "part"))
            for i, payload in enumerate(b.column("payload")):
                page_id = ids[i] if known[i] else None
                if key != (page_id, digests[i]):
                    key, copy, note = (page_id, digests[i]), 0, None
                if kinds[i] == 0:  # says which page's record those of this key refer to
                    note = (heads[i], 0)
                    continue
                if file and (file.part != parts[i] or file.bytes >= file_bytes):
                    done.append(file.close())
                    file = _File(store, folder, parts[i], file.seq + 1 if file.part == parts[i] else 0, date, level)
                file = file or _File(store, folder, parts[i], 0, date, level)
                body = payload.as_py()
                # Without a note the key holds the response itself: its first copy.
                original = None if len(body) < revisit_bytes else note or ((page_id, 0) if copy else None)
                file.put(page_member(page_id, urls[i], body, digests[i], copy, original, date, level))
                copy += 1
        if file:
            done.append(file.close())
        kinds = (pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*done)) or [()] * 7, kinds)], names=["part", "seq", "file", "tmp", "records", "bytes", "sha1"])

    return tidy(run)


def _commit(uri: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = _store(uri)
        for b in batches:
            for name, tmp, size in zip(b.column("file").to_pylist(), b.column("tmp").to_pylist(), b.column("bytes").to_pylist()):
                if store.get_file_info(f"{folder}/{tmp}").type == fs.FileType.File:
                    store.move(f"{folder}/{tmp}", f"{folder}/{name}")
                elif store.get_file_info(f"{folder}/{name}").size != size:  # else an earlier attempt has renamed it
                    raise FileNotFoundError(f"{folder}/{tmp}")
            yield b

    return run


def _dealt(splits: list[tuple]):
    """Adds the range of each row: how many cuts its key has reached."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = zip(*(b.column(c).to_pylist() for c in _KEY))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([bisect_right(splits, k) for k in keys], pa.int32())], names=[*b.schema.names, "part"])

    return run


def _revisits(ids: DataFrame) -> DataFrame:
    """known, page_id, digest, head for the keys whose payload a page with a larger id has too: head is the largest of these ids.

    Copies of a payload are dealt in _DEALS parts; a part has its largest id, and only the parts of a digest that occur get it back.
    """
    ids = ids.withColumn("deal", F.pmod(F.xxhash64("page_id"), F.lit(_DEALS)))
    by_deal = ids.groupBy("digest", "deal").agg(F.max(F.when(F.col("known"), F.col("page_id"))).alias("head"), F.count("*").alias("n"))
    by_digest = by_deal.groupBy("digest").agg(F.max("head").alias("head"), F.sum("n").alias("n"), F.collect_list("deal").alias("deals")).where("n > 1 and head is not null")
    heads = by_digest.select("digest", "head", F.explode("deals").alias("deal"))
    return ids.join(heads, ["digest", "deal"]).where("not known or page_id <> head").select(*_KEY, "head").distinct()


def _splits(ids: DataFrame, range_bytes: int) -> list[tuple]:
    """Keys at which ranges begin: a row for each range of `range_bytes` reaches the driver."""
    n, size = ids.agg(F.count("*"), F.sum("bytes")).first()
    ranges = max(-(-(size or 0) // range_bytes), min(64, -(-(size or 0) // (1 << 20))), 1)
    keep = max(1, n // (ranges * OVERSAMPLE))
    # OVERSAMPLE rows for each range, of 1 GiB where there are many: one task orders them.
    sample = ids.where(F.pmod(F.xxhash64(*_KEY), F.lit(keep)) == 0).select(*_KEY).withColumn("place", F.row_number().over(Window.orderBy(*_KEY)))
    total = sample.count()
    step = -(-total // ranges)
    rows = sample.where((F.col("place") % max(step, 1) == 1) & (F.col("place") > 1)).orderBy("place").collect() if step > 1 else sample.where("place > 1").orderBy("place").collect()
    return sorted({(r.known, r.page_id, bytes(r.digest)) for r in rows})


def write_pages(pages: DataFrame, folder: str, *, revisit_bytes: int = 0, file_bytes: int = FILE_BYTES, range_bytes: int = RANGE_BYTES, date: str = "1970-01-01T00:00:00Z", level: int = 6) -> None:
    """Writes one record for each row of pages (page_id, url, html) below `folder`, a fresh one that driver and executors share.

    The payload is the html in UTF-8, null as empty. Of records with equal payloads of at least `revisit_bytes`, that with the largest page_id is a response and the others are
    revisits of it; null ids count as smallest and come first. Rows that share id and payload lie side by side: the first is the response, if none has a larger id. A null url becomes
    `urn:page:` and the id. Other columns are ignored; an empty table gives a manifest without files. The same rows give the same files, bit by bit, for the same parameters.
    A task holds one record at a time beside its batch; rows of one id and payload form one range.
    """
    spark, uri = pages.sparkSession, _qualified(pages.sparkSession, folder)
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").isNotNull().alias("known"), F.coalesce(F.col("page_id").cast("long"), F.lit(0)).alias("page_id"), F.unhex(F.sha1(payload)).alias("digest"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    ids = cut_lineage(rows.select(*_KEY, F.octet_length("payload").cast("long").alias("bytes")))
    splits = _splits(ids, range_bytes)
    notes = _revisits(ids.where(F.col("bytes") >= revisit_bytes)).select(*_KEY, F.lit(0).alias("kind"), "head", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"))
    both = rows.select(*_KEY, F.lit(1).alias("kind"), F.lit(None).cast("long").alias("head"), "url", "payload").unionByName(notes)
    kinds = "known boolean, page_id long, digest binary, kind int, head long, url string, payload binary, part int"
    ordered = both.mapInArrow(_dealt(splits), kinds).repartitionById(len(splits) + 1, "part").sortWithinPartitions("part", *_KEY, "kind", "url")
    ordered.mapInArrow(_write(f"{uri}/data", file_bytes, revisit_bytes, date, level), _FILES).write.parquet(f"{folder}/staged")
    staged = spark.read.schema(_FILES).parquet(f"{folder}/staged")
    staged.mapInArrow(_commit(f"{uri}/data"), _FILES).drop("tmp").write.parquet(f"{folder}/manifest")
    store, place = _store(f"{uri}/data")  # what lost attempts have left
    for left in store.get_file_info(fs.FileSelector(place, allow_not_found=True)):
        if os.path.basename(left.path).startswith("."):
            store.delete_file(left.path)


def members(stream) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, content) of the gzip members of an open file."""
    held, offset = b"", 0
    while held or (held := stream.read(1 << 20)):
        unpacker, out, length = zlib.decompressobj(31), [], 0
        while not unpacker.eof:
            if not held and not (held := stream.read(1 << 20)):
                raise ValueError(f"the member at {offset} is cut off")
            out.append(unpacker.decompress(held))
            length += len(held) - len(unpacker.unused_data)
            held = unpacker.unused_data
        yield offset, length, b"".join(out)
        offset += length


def parse(content: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of a record; a length or block digest that doesn't hold is an error."""
    head, _, rest = content.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(headers["Content-Length"])]
    if version != "WARC/1.1" or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError(f"{headers.get('WARC-Record-ID')}: no record of WARC/1.1, or its length is wrong")
    if headers["WARC-Block-Digest"] != f"sha1:{base32(hashlib.sha1(block).digest())}":
        raise ValueError(f"{headers['WARC-Record-ID']}: wrong block digest")
    return headers, block


_RECORDS = {
    "page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(), "record_id": pa.string(), "refers_to_record": pa.string(),
    "url": pa.string(), "file": pa.string(), "offset": pa.int64(), "length": pa.int64(), "payload": pa.binary(),
}


def _record(content: bytes, payloads: bool) -> tuple | None:
    headers, block = parse(content)
    if headers["WARC-Type"] == "warcinfo":
        return None
    http, _, payload = block.partition(b"\r\n\r\n")
    n = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
    digest, response = headers["WARC-Payload-Digest"].removeprefix("sha1:"), headers["WARC-Type"] == "response"
    if response and (len(payload) != n or base32(hashlib.sha1(payload).digest()) != digest):
        raise ValueError(f"{headers['WARC-Record-ID']}: wrong payload digest")
    number = lambda name: int(headers[name]) if name in headers else None
    return (number("X-Page-ID"), n, digest, headers["WARC-Type"], number("X-Refers-To-Page-ID"), headers["WARC-Record-ID"], headers.get("WARC-Refers-To"), headers["WARC-Target-URI"], payload if response and payloads else None)


def _read(uri: str, payloads: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = _store(uri)
        for b in batches:
            for name, records, size, sha1 in zip(*(b.column(c).to_pylist() for c in ("file", "records", "bytes", "sha1"))):
                rows, held, seen, whole, end = [], 0, 0, hashlib.sha1(), 0
                with store.open_input_stream(f"{folder}/{name}", compression=None) as stream:
                    for offset, length, content in members(_Hashed(stream, whole)):
                        end = offset + length
                        if row := _record(content, payloads):
                            rows.append((*row[:8], name, offset, length, row[8]))
                            seen, held = seen + 1, held + len(content)
                        if held > 1 << 24 or len(rows) >= 10_000:
                            yield _batch(rows)
                            rows, held = [], 0
                if (seen, end, base32(whole.digest())) != (records, size, sha1):
                    raise ValueError(f"{name}: not the file that the manifest names")
                yield _batch(rows)

    return tidy(run)


class _Hashed:
    """A stream whose bytes are hashed as they are read."""

    def __init__(self, stream, sha):
        self.stream, self.sha = stream, sha

    def read(self, n: int) -> bytes:
        out = self.stream.read(n)
        self.sha.update(out)
        return out


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * len(_RECORDS), _RECORDS.values())], names=list(_RECORDS))


def read_pages(spark: SparkSession, folder: str, *, payloads: bool = False) -> DataFrame:
    """One row for each record of an archive, checked against its digests and the manifest: page_id, payload_bytes, payload_digest (both of the full payload, also for revisits), record_type, refers_to,
    record_id, refers_to_record, url, file, offset and length of its gzip member, payload (null for revisits, or unless `payloads`)."""
    manifest = spark.read.parquet(f"{folder}/manifest")
    files = manifest.select("file", "records", "bytes", "sha1").repartition(max(1, min(manifest.count(), 100_000)))
    names = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}
    return files.mapInArrow(_read(f"{_qualified(spark, folder)}/data", payloads), ", ".join(f"{c} {names[k]}" for c, k in _RECORDS.items()))


def payload_at(spark: SparkSession, folder: str, file: str, offset: int, length: int) -> bytes:
    """The payload of one response, by random access to its gzip member."""
    store, place = _store(f"{_qualified(spark, folder)}/data")
    with store.open_input_file(f"{place}/{file}") as f:
        return parse(zlib.decompress(f.read_at(length, offset), 31))[1].partition(b"\r\n\r\n")[2]


_LETTERS = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (({'abcd'[i // 8]} >> {35 - 5 * (i % 8)}) & 31)::int, 1)" for i in range(32))

#: The same rows in DuckDB's SQL; base32 is spelled out of four numbers of 40 bits.
WARC_SQL = f"""
with p as (select page_id, coalesce(html, '') as t, sha1(coalesce(html, '')) as hex from pages),
h as (select page_id, strlen(t) as n, {", ".join(f"('0x' || substr(hex, {1 + 10 * i}, 10))::bigint as {c}" for i, c in enumerate("abcd"))}, max(page_id) over (partition by t) as head from p)
select page_id, n::bigint as payload_bytes, {_LETTERS} as payload_digest,
  case when page_id = head then 'response' else 'revisit' end as record_type, case when page_id <> head then head end as refers_to from h
"""
