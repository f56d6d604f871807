"""Readers and writers of tables, and key-value stores on them."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annospark.functions.columns import stem

from .shards import qualified, store_of

#: How a manifest is read, by the extension of its name.
READERS = {
    ".parquet": lambda r, p: r.option("mergeSchema", True).parquet(p),
    ".csv": lambda r, p: r.option("header", True).option("inferSchema", True).csv(p),
    ".tsv": lambda r, p: r.option("header", True).option("inferSchema", True).option("sep", "\t").csv(p),
    ".jsonl": lambda r, p: r.json(p),
    ".json": lambda r, p: r.option("multiLine", True).json(p),
}


def read_manifest(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Reads parquet, csv, tsv, json (one document) or jsonl by extension; give a schema to spare inference on large files."""
    for ext, read in READERS.items():
        if path.rstrip("/").lower().endswith(ext):
            return read(spark.read.schema(schema) if schema else spark.read, path)
    raise ValueError(f"{path}: expected one of {', '.join(READERS)}")


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    """A folder of Parquet shards as one table; columns that only some have are null elsewhere."""
    return spark.read.option("mergeSchema", True).option("recursiveFileLookup", True).parquet(folder)


def scan_files(spark: SparkSession, root: str, extensions: tuple[str, ...] = (".wav", ".flac", ".mp3", ".ogg", ".m4a"), uid: Column | None = None) -> DataFrame:
    """path, uid, ext and bytes of the files below a folder; hidden files and other extensions are left out. Contents aren't read.

    The uid is the name without its extension, or what `uid` makes of the column path, where folders carry the id.
    """
    many, tasks = "spark.sql.sources.parallelPartitionDiscovery.parallelism", 4 * spark.sparkContext.defaultParallelism
    before = spark.conf.get(many, None)
    spark.conf.set(many, tasks)  # else each folder is listed by a task of its own
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", F.col("length").alias("bytes"))
    finally:
        spark.conf.unset(many) if before is None else spark.conf.set(many, before)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    ext = F.lower(F.regexp_extract(name, r"(\.[^.]+)$", 1))
    return files.withColumns({"uid": stem(F.col("path")) if uid is None else uid, "ext": ext}).where(ext.isin(*extensions) & ~name.startswith(".")).select("path", "uid", "ext", "bytes")


def write_folders(lines: DataFrame, key: str, path: str, ext: str) -> None:
    """A folder key=value with one file of lines for each value of a string column, to a new path: `lines` has the key and one string column more; a null is an empty line.

    Tasks write the files themselves: for each of them, Spark's writer starts three processes on a local file system, and its commit moves folders one by one in the driver.
    A file gets its name when it is whole, so an attempt at a task that is made again replaces it. Keys are dealt to a stated number of tasks, since Spark would join tasks
    of few bytes, however many files these make.
    """
    line = next(c for c in lines.columns if c != key)
    target = qualified(lines.sparkSession, path)
    made, root = store_of(target)
    made.create_dir(root)  # without lines, it is an empty folder

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = store_of(target)
        at, out, n, written = None, None, 0, ""

        def close() -> None:
            if out is not None:
                out.close()
                store.move(written, f"{os.path.dirname(written)}/lines{ext}")

        for pdf in batches:
            for k, own in pdf.groupby(key, sort=False, dropna=False)[line]:
                folder = f"{root}/{key}=" + ("__HIVE_DEFAULT_PARTITION__" if pd.isna(k) else quote(k, safe=""))
                if folder != at:
                    close()
                    at, n = folder, n + 1
                    store.create_dir(at)
                    written = f"{at}/.{uuid.uuid4().hex}"
                    out = store.open_output_stream(written)
                out.write("".join(("" if x is None else x) + "\n" for x in own).encode())
        close()
        yield pd.DataFrame({"n": [n]})

    dealt = lines.repartition(int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")), key).sortWithinPartitions(key)
    dealt.mapInPandas(put, "n long").agg(F.sum("n")).collect()  # one row


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """zstd Parquet; Spark's commit makes a write visible as a whole."""
    df.write.mode(mode).option("compression", "zstd").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; arrays are joined by `;`, maps and structs written as JSON."""
    flat = {f.name: F.array_join(f.name, ";") if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StringType) else F.to_json(f.name) for f in df.schema if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))}
    df.withColumns(flat).write.mode("overwrite").option("header", True).csv(path)


def append_log(df: DataFrame, path: str) -> None:
    """Appends records as JSON lines."""
    df.write.mode("append").json(path)


def read_log(spark: SparkSession, path: str, schema: str, step: str | None = None) -> DataFrame:
    """Records of a JSON log; lines that aren't JSON are dropped."""
    out = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    return out.where(F.col("step") == step) if step else out


def checkpoint_ready(spark: SparkSession) -> None:
    """Makes sure that the session has a checkpoint folder, that of spark.checkpoint.dir; a folder of this machine only for a local master, as in tests."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not (sc.master.startswith("local[") or sc.master == "local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(folder or "/tmp/annospark-checkpoints")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh name below the checkpoint folder, which driver and executors share."""
    checkpoint_ready(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


class ParquetStore:
    """Rows by key in Parquet: load, save, exists, list_ids. Saving an id replaces its rows.

    Keys are dealt to slots. A save writes the slots that it touches to rows/version=V, then which slots these are to versions/save=V; only the second
    makes it visible, all at once. What was cut off before that is never read, and a save that is repeated under its version writes the same again.
    """

    def __init__(self, spark: SparkSession, path: str, key: str = "wav_id", buckets: int = 64):
        self.spark, self.path, self.key, self.buckets = spark, path, key, buckets

    def _slot(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key.cast("string")), F.lit(self.buckets)).cast("int")

    def _versions(self, before: int | None = None) -> dict[int, int]:
        """The version that stands for each slot, of saves before a version; at most a row for each slot reaches the driver."""
        try:
            saves = self.spark.read.parquet(f"{self.path}/versions")
        except AnalysisException as e:  # nothing saved yet
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return {}
        saves = saves if before is None else saves.where(F.col("version") < before)
        return {r.slot: r.version for r in saves.groupBy("slot").agg(F.max("version").alias("version")).collect()}

    def _rows(self, versions: dict[int, int]) -> DataFrame:
        """Rows with their slot; the filter is on folders only."""
        rows = self.spark.read.option("mergeSchema", True).parquet(f"{self.path}/rows")
        standing = F.create_map(*[F.lit(x) for pair in versions.items() for x in pair])
        return rows.where(F.col("version") == F.try_element_at(standing, F.col("slot"))).drop("version")

    def table(self) -> DataFrame:
        return self._rows(self._versions()).drop("slot")

    def table_or_none(self) -> DataFrame | None:
        """The table, or None where nothing was saved."""
        versions = self._versions()
        return self._rows(versions).drop("slot") if versions else None

    def vacuum(self, older_than: int | None = None) -> int:
        """Deletes the files of slots that later saves have replaced, and what cut-off saves have left, of versions before `older_than` (default: the last one that stands).

        Returns how many folders went. Readers that began before a replacing save may still need them; keep as many versions as such readers may lag.
        """
        standing = self._versions()
        if not standing:
            return 0
        limit = max(standing.values()) if older_than is None else older_than
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        root = jvm.org.apache.hadoop.fs.Path(f"{self.path}/rows")
        store, gone = root.getFileSystem(conf), 0
        for folder in store.listStatus(root):
            version = int(folder.getPath().getName().removeprefix("version="))
            for slot in store.listStatus(folder.getPath()) if version < limit else []:
                name = slot.getPath().getName()
                if name.startswith("slot=") and standing.get(int(name.removeprefix("slot="))) != version:
                    gone += store.delete(slot.getPath(), True)
        return gone

    def load(self, value) -> DataFrame:
        """Rows of one id; only its slot is read."""
        return self._rows(self._versions()).where((F.col("slot") == self._slot(F.lit(value))) & (F.col(self.key) == value)).drop("slot")

    def save(self, rows: DataFrame, version: int | None = None) -> None:
        """Adds rows and replaces those of the same ids. Give a version, greater than all before, where a save may be repeated."""
        standing = self._versions(version)
        if version is None:
            version = max(standing.values(), default=-1) + 1
        new = rows.withColumn("slot", self._slot(F.col(self.key)))
        touched = [r.slot for r in new.select("slot").distinct().collect()]  # `buckets` at most
        if old := {k: v for k, v in standing.items() if k in touched}:
            new = self._rows(old).join(new.select(self.key).distinct(), self.key, "left_anti").unionByName(new, allowMissingColumns=True)
        new.repartition("slot").write.mode("overwrite").partitionBy("slot").parquet(f"{self.path}/rows/version={version}")
        saved = self.spark.range(1).select(F.explode(F.lit(touched) if touched else F.array().cast("array<int>")).alias("slot"), F.lit(version).cast("long").alias("version"))
        saved.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/versions/save={version}")

    def exists(self, value) -> bool:
        return not self.load(value).isEmpty()

    def list_ids(self) -> DataFrame:
        return self.table().select(self.key).distinct().orderBy(self.key)


class JsonStore:
    """JSON documents by key in a folder of JSON lines. Saving a key replaces its documents.

    Each save writes a folder of its own, save=N, whose lines carry when they were saved; the last save of a key stands. `compact` rewrites what stands as one save.
    """

    def __init__(self, spark: SparkSession, path: str, key: str = "wav_id"):
        self.spark, self.path, self.key = spark, path, key

    def _saves(self) -> list[int]:
        """Numbers of the saves that were finished."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        store = root.getFileSystem(conf)
        found = [f.getPath() for f in store.listStatus(root)] if store.exists(root) else []
        return sorted(int(p.getName().removeprefix("save=")) for p in found if p.getName().startswith("save=") and store.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))

    def save(self, rows: DataFrame) -> None:
        """Adds documents and replaces those of the same keys. One writer at a time."""
        rows.write.mode("overwrite").json(f"{self.path}/save={max(self._saves(), default=-1) + 1}")

    def table(self, schema: str | None = None) -> DataFrame:
        saves = self._saves()
        if not saves:
            raise FileNotFoundError(f"{self.path}: nothing was saved")
        read = self.spark.read.option("basePath", self.path)
        rows = (read.schema(f"{schema}, save int") if schema else read).json([f"{self.path}/save={n}" for n in saves])
        if len(saves) == 1:
            return rows.drop("save")
        # Which save stands for a key is told by aggregation: a key with very many documents is no large group.
        last = rows.groupBy(self.key).agg(F.max("save").alias("save"))
        same = rows.alias("r").join(last.alias("l"), F.col(f"r.{self.key}").eqNullSafe(F.col(f"l.{self.key}")) & (F.col("r.save") == F.col("l.save")), "left_semi")
        return same.drop("save")

    def compact(self, schema: str | None = None) -> None:
        """Rewrites what stands as one save and deletes the earlier ones."""
        old = self._saves()
        rows = self.table(schema)
        rows.write.mode("overwrite").json(f"{self.path}/save={old[-1] + 1}")
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        store = jvm.org.apache.hadoop.fs.Path(self.path).getFileSystem(conf)
        for n in old:
            store.delete(jvm.org.apache.hadoop.fs.Path(f"{self.path}/save={n}"), True)

    def load(self, value) -> DataFrame:
        return self.table().where(F.col(self.key) == value)

    def exists(self, value) -> bool:
        return bool(self._saves()) and not self.load(value).isEmpty()

    def list_ids(self) -> DataFrame:
        return self.table().select(self.key).distinct().orderBy(self.key)
