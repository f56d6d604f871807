"""Tar shards of samples, as a Python data source.

Tars lie in a folder of any store that Arrow knows. `index_shards` walks their headers once and puts, beside the tars, one small Parquet file for each with the place of every
member (folder `index`) and a row for each tar (folder `shards`). Readers plan byte ranges from the latter, take the members of a range from the former, and fetch only the
bytes of those that the pushed filters leave; the endless reader in streaming/endless.py finds samples by the same index.
"""

from __future__ import annotations

import io
import os
import tarfile
import uuid
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceWriter, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan,
    LessThanOrEqual, StringStartsWith, WriterCommitMessage,
)

MEMBERS = "key string, ext string, payload binary"
#: Columns of the index: `sample` counts the keys of a tar, `start` and `size` are a payload's bytes in it.
INDEX = "shard string, sample long, key string, ext string, start long, size long"
#: Columns of the table of tars.
SHARDS = "shard string, bytes long, samples long, members long, first_key string, last_key string"


def assign_shards(clips: DataFrame, per_shard: int = 100, group: str = "uid", order: tuple[str, ...] = ("uid", "clip_idx")) -> DataFrame:
    """Adds shard (text) and key `{uid}_{idx:04d}`: at most `per_shard` clips each, in order within a range of the group's ids.

    Ranges are numbered by Spark's partitions, so no task ranks all clips. Clips without payload should be dropped before.
    """
    ranged = clips.repartitionByRange(group).withColumn("_part", F.spark_partition_id())
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    shard = F.format_string("%05d-%05d", F.col("_part"), F.floor(place / per_shard).cast("int"))
    return ranged.withColumns({"shard": shard, "key": F.concat(F.col("uid").cast("string"), F.lit("_"), F.format_string("%04d", F.col("clip_idx")))}).drop("_part")


def qualified(spark: SparkSession, path: str) -> str:
    """path as a URI, in the store that Spark would take it from: the default one where it names none."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()


def store_of(path: str) -> tuple[fs.FileSystem, str]:
    """The file system that a URI names, and the path within it: any that Arrow knows (file, s3, gs, hdfs, abfs). A path without a scheme is one of this machine."""
    if "://" not in path:
        path = "file://" + os.path.abspath(path.removeprefix("file:"))
    return fs.FileSystem.from_uri(path)


@dataclass
class _Written(WriterCommitMessage):
    files: list


class _TarWriter(DataSourceWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path, overwrite

    def write(self, rows: Iterator) -> _Written:
        """Rows (shard, key, ext, payload) in order of shard; a shard is written under a name of this attempt and renamed on commit."""
        from pyspark import TaskContext

        store, folder = store_of(self.path)
        store.create_dir(folder, recursive=True)
        attempt = TaskContext.get().taskAttemptId()
        tar, stream, shard, done = None, None, None, []
        for r in rows:
            if r.shard != shard:
                if tar:
                    tar.close()
                    stream.close()
                shard = r.shard
                name = f"{folder}/.{shard}.{attempt}.tmp"
                stream = store.open_output_stream(name)
                tar = tarfile.open(fileobj=stream, mode="w|")
                done.append((name, f"{folder}/{shard}.tar"))
            info = tarfile.TarInfo(f"{r.key}.{r.ext}")
            info.size = len(r.payload)
            tar.addfile(info, io.BytesIO(bytes(r.payload)))
        if tar:
            tar.close()
            stream.close()
        return _Written(done)

    def commit(self, messages: list) -> None:
        store, _ = store_of(self.path)
        for m in messages:
            for tmp, name in m.files if m else []:
                store.move(tmp, name)

    def abort(self, messages: list) -> None:
        store, _ = store_of(self.path)
        for m in messages:
            for tmp, _ in m.files if m else []:
                if store.get_file_info(tmp).type == fs.FileType.File:
                    store.delete_file(tmp)


@dataclass
class TarRange(InputPartition):
    """Members of one tar whose payloads start within [first, end), and small tars that the same task reads after it."""

    shard: str
    first: int
    end: int
    after: list[TarRange] = field(default_factory=list)


_COMPARE = {GreaterThan: pc.greater, GreaterThanOrEqual: pc.greater_equal, LessThan: pc.less, LessThanOrEqual: pc.less_equal, EqualTo: pc.equal, EqualNullSafe: pc.equal}
#: What opening a tar and its index counts as, in bytes, where small tars are put together for a task.
OPEN_BYTES = 4 << 20
#: Bytes between two wanted members that are read along rather than skipped by a request of their own, and the most that one request takes.
GAP, RUN = 1 << 16, 8 << 20


def condition(f: Filter) -> ds.Expression | None:
    """A pushed filter on shard, key or ext as an expression of Arrow; None for any other."""
    if getattr(f, "attribute", None) not in (("shard",), ("key",), ("ext",)):
        return None
    column = ds.field(f.attribute[0])
    if type(f) in _COMPARE:
        return _COMPARE[type(f)](column, ds.scalar(f.value))
    if isinstance(f, In):
        return column.isin(list(f.value))
    if isinstance(f, StringStartsWith):
        return pc.starts_with(column, f.value)
    return column.is_valid() if isinstance(f, IsNotNull) else None


def may_hold(f: Filter, shard: dict) -> bool:
    """Whether a tar can have members that a filter on shard or key leaves, by its name and its first and last key."""
    if f.attribute == ("ext",) or isinstance(f, IsNotNull):
        return True
    low, high = (shard["shard"],) * 2 if f.attribute == ("shard",) else (shard["first_key"], shard["last_key"])
    if isinstance(f, In):
        return any(low <= v <= high for v in f.value if v is not None)
    if isinstance(f, StringStartsWith):
        return low[: len(f.value)] <= f.value <= high[: len(f.value)]
    above, below = isinstance(f, (GreaterThan, GreaterThanOrEqual)), isinstance(f, (LessThan, LessThanOrEqual))
    return f.value is not None and (below or f.value <= high) and (above or f.value >= low)


def indexed(store: fs.FileSystem, folder: str, shard: str, keep: ds.Expression | None = None) -> list[dict]:
    """Members of one tar by their place, those that `keep` leaves."""
    return pq.read_table(f"{folder}/index/{shard}.parquet", filesystem=store, filters=keep).sort_by("start").to_pylist()


def fetch(file, members: list[dict]) -> Iterator[tuple[dict, bytes]]:
    """Members in order of their place with their payloads; near ones come by one request."""
    at = 0
    while at < len(members):
        first, end = members[at]["start"], members[at]["start"] + members[at]["size"]
        to = at + 1
        while to < len(members) and members[to]["start"] - end <= GAP and members[to]["start"] + members[to]["size"] - first <= RUN:
            end, to = members[to]["start"] + members[to]["size"], to + 1
        held = file.read_at(end - first, first) if end > first else b""
        for m in members[at:to]:
            yield m, held[m["start"] - first : m["start"] - first + m["size"]]
        at = to


class _TarReader(DataSourceReader):
    """Plans byte ranges of the tars that may hold what the filters leave; a task reads its range's part of the index, then the members' bytes."""

    def __init__(self, path: str, split_bytes: int):
        self.path, self.split_bytes, self.filters = path, split_bytes, []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if condition(f) is None:
                yield f
            else:
                self.filters.append(f)

    def partitions(self) -> Sequence[TarRange]:
        out, held = [], self.split_bytes
        for x in shard_table(self.path):
            if all(may_hold(f, x) for f in self.filters):
                for first in range(0, x["bytes"], self.split_bytes):
                    cost = min(self.split_bytes, x["bytes"] - first) + OPEN_BYTES
                    part = TarRange(x["shard"], first, first + self.split_bytes)
                    if held + cost > self.split_bytes:
                        out.append(part)
                        held = 0
                    else:
                        out[-1].after.append(part)
                    held += cost
        return out

    def read(self, partition: TarRange | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # Spark's stand-in where no tar may hold anything
            return
        store, folder = store_of(self.path)
        for part in (partition, *partition.after):
            keep = (ds.field("start") >= part.first) & (ds.field("start") < part.end)
            for f in self.filters:
                keep = keep & condition(f)
            found = indexed(store, folder, part.shard, keep)
            if found:
                with store.open_input_file(f"{folder}/{part.shard}.tar") as file:
                    rows, held = [], 0
                    for m, payload in fetch(file, found):
                        rows.append((m["shard"], m["key"], m["ext"], payload))
                        held += len(payload)
                        if held >= RUN:
                            yield _members(rows)
                            rows, held = [], 0
                    if rows:
                        yield _members(rows)


def _members(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.string(), pa.string(), pa.string(), pa.binary()))], names=["shard", "key", "ext", "payload"])


class TarShards(DataSource):
    """df.write.format("tar_shards").save(folder), spark.read.format("tar_shards").load(folder): the folder is one that driver and executors share, in any store that Arrow knows."""

    @classmethod
    def name(cls) -> str:
        return "tar_shards"

    def schema(self) -> str:
        return "shard string, " + MEMBERS

    def writer(self, schema, overwrite: bool) -> _TarWriter:
        return _TarWriter(self.options["path"], overwrite)

    def reader(self, schema) -> _TarReader:
        return _TarReader(self.options["path"], int(self.options.get("split_bytes", 64 << 20)))


def write_shards(members: DataFrame, folder: str) -> None:
    """Writes rows (shard, key, ext, payload), one tar for each shard, and their index."""
    spark = members.sparkSession
    spark.dataSource.register(TarShards)
    rows = members.select("shard", "key", "ext", "payload").repartition("shard").sortWithinPartitions("shard", "key", "ext")
    rows.write.format("tar_shards").mode("append").save(qualified(spark, folder))
    index_shards(spark, folder)


def _headers(uri: str):
    names = [x.split()[0] for x in SHARDS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = store_of(uri)
        store.create_dir(f"{folder}/index", recursive=True)
        for b in batches:
            out = []
            for shard, size in zip(b.column("shard").to_pylist(), b.column("bytes").to_pylist()):
                rows, sample, last = [], -1, None
                with store.open_input_file(f"{folder}/{shard}.tar") as f, tarfile.open(fileobj=f, mode="r:") as tar:
                    for m in tar:
                        tar.members = []  # else all headers stay in memory
                        if m.isfile():
                            at = m.name.find(".", m.name.rfind("/") + 1)  # folders are part of the key, and may hold dots
                            key, ext = (m.name[:at], m.name[at + 1 :]) if at >= 0 else (m.name, "")
                            sample, last = sample + (key != last), key
                            rows.append((shard, sample, key, ext, m.offset_data, m.size))
                kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
                table = pa.table([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * 6, kinds)], names=[x.split()[0] for x in INDEX.split(", ")])
                tmp = f"{folder}/index/.{shard}.{uuid.uuid4().hex}"
                pq.write_table(table, tmp, filesystem=store, row_group_size=1 << 14)
                store.move(tmp, f"{folder}/index/{shard}.parquet")
                keys = [r[2] for r in rows]
                out.append((shard, size, sample + 1, len(rows), min(keys, default=""), max(keys, default="")))
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*out)) or [()] * 6, kinds)], names=names)

    return run


def index_shards(spark: SparkSession, folder: str) -> None:
    """Indexes the tars of a folder that the table of tars doesn't list yet with their present size. Only headers are read, a tar by a task; indexing again writes the same."""
    tars = spark.read.format("binaryFile").option("pathGlobFilter", "*.tar").load(folder).select(F.regexp_extract("path", r"([^/]+)\.tar$", 1).alias("shard"), F.col("length").alias("bytes"))
    try:
        tars = tars.join(spark.read.schema(SHARDS).parquet(f"{folder}/shards"), ["shard", "bytes"], "left_anti")
    except AnalysisException as e:  # nothing indexed yet
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    # A task has some tars or one large one, and no more than a small share of all. Each task writes a file of rows, and all readers open all of these.
    n, size = tars.agg(F.count("*"), F.coalesce(F.sum(F.col("bytes") + OPEN_BYTES), F.lit(0))).first()
    tars = tars.repartition(max(1, min(n, max(4 * spark.sparkContext.defaultParallelism, size >> 28))), "shard")
    tars.mapInArrow(_headers(qualified(spark, folder)), SHARDS).write.mode("append").parquet(f"{folder}/shards")


def shard_table(uri: str) -> list[dict]:
    """The row of each indexed tar, in order of names; of a tar that was indexed again, that of its present size."""
    store, folder = store_of(uri)
    if store.get_file_info(f"{folder}/shards").type == fs.FileType.NotFound:
        raise FileNotFoundError(f"{uri} isn't indexed: call index_shards")
    rows: dict[str, dict] = {}
    for r in ds.dataset(f"{folder}/shards", filesystem=store, format="parquet").to_table().to_pylist():
        if r["shard"] not in rows or store.get_file_info(f"{folder}/{r['shard']}.tar").size == r["bytes"]:
            rows[r["shard"]] = r
    return [rows[k] for k in sorted(rows)]


def read_shards(spark: SparkSession, folder: str, split_bytes: int = 64 << 20) -> DataFrame:
    """Members (shard, key, ext, payload) of the indexed tars of a folder of any store. Filters on shard, key and ext reach the source: tars whose keys lie elsewhere aren't
    opened, and other members' bytes aren't read. A task has a byte range of a tar and holds some MB of it, or one larger member."""
    spark.dataSource.register(TarShards)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", True)
    return spark.read.format("tar_shards").option("split_bytes", split_bytes).load(qualified(spark, folder))


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """Every member of the indexed tars without its payload: shard, sample, key, ext, start, size."""
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


def fetch_members(wanted: DataFrame, folder: str) -> DataFrame:
    """Payloads of rows of the index (chosen by a join, or as a sample): shard, sample, key, ext, payload. Rows meet by tar and place, so that each tar is opened once for each
    64 MB of it that holds any, and only these members' bytes are read. Repeated rows are fetched again."""
    spark = wanted.sparkSession
    uri = qualified(spark, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = store_of(uri)
        opened, name = None, None
        for b in batches:
            rows, held = [], 0
            found = b.to_pylist()
            for shard in dict.fromkeys(m["shard"] for m in found):
                if shard != name:
                    if opened:
                        opened.close()
                    opened, name = store.open_input_file(f"{place}/{shard}.tar"), shard
                for m, payload in fetch(opened, [m for m in found if m["shard"] == shard]):
                    rows.append((m["shard"], m["sample"], m["key"], m["ext"], payload))
                    held += len(payload)
                    if held >= RUN:
                        yield batch(rows)
                        rows, held = [], 0
            if rows:
                yield batch(rows)
        if opened:
            opened.close()

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["shard", "sample", "key", "ext", "payload"])

    rows = wanted.select("shard", "sample", "key", "ext", "start", "size").repartition("shard", F.col("start").bitwiseAND(F.lit(-(64 << 20)))).sortWithinPartitions("shard", "start")
    return rows.mapInArrow(run, "shard string, sample long, " + MEMBERS)


def samples_of(members: DataFrame, payloads: tuple[str, ...] = ("flac", "wav", "bin"), metadata: str = "map<string,string>") -> DataFrame:
    """One row a key: the payload of the first extension that is there, and the JSON member parsed (null where it isn't JSON)."""
    wide = members.groupBy("shard", "key").pivot("ext", [*payloads, "json"]).agg(F.first("payload"))
    ext = F.coalesce(*[F.when(F.col(p).isNotNull(), F.lit(p)) for p in payloads])
    return wide.select("shard", "key", ext.alias("ext"), F.coalesce(*payloads).alias("payload"), F.from_json(F.col("json").cast("string"), metadata, {"mode": "PERMISSIVE"}).alias("metadata"))
