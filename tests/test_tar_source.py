"""The tar data source: round trips, pushed filters and bytes read; the endless reader: epochs, workers, restarts."""

import io
import os
import tarfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from annospark.sources import shards
from annospark.streaming import endless


def tars(folder, sizes, payload=2000):
    """Tars of samples with two members each: `sizes` gives how many samples each has."""
    os.makedirs(folder)
    n = 0
    for i, size in enumerate(sizes):
        with tarfile.open(f"{folder}/{i:05d}.tar", "w") as tar:
            for _ in range(size):
                for ext, content in (("bin", f"{n}:".encode() + b"x" * payload), ("json", b'{"n": "%d"}' % n)):
                    info = tarfile.TarInfo(f"rec_{n:05d}.{ext}")
                    info.size = len(content)
                    tar.addfile(info, io.BytesIO(content))
                n += 1
    return str(folder)


@pytest.fixture
def folder(spark, tmp_path):
    path = tars(tmp_path / "tars", (40, 0, 60, 100, 1))
    shards.index_shards(spark, path)
    return path


def members(rows):
    return sorted((r.shard, r.key, r.ext, bytes(r.payload)) for r in rows.collect())


def plainly(path):
    out = []
    for name in os.listdir(path):
        if name.endswith(".tar"):
            with tarfile.open(f"{path}/{name}") as tar:
                out += [(name[:-4], *m.name.split(".", 1), tar.extractfile(m).read()) for m in tar]
    return sorted(out)


@pytest.mark.parametrize("split", [1000, 70_000, 1 << 30])
def test_all_members_whatever_the_ranges(spark, folder, split):
    assert members(shards.read_shards(spark, folder, split)) == plainly(folder)


CONDITIONS = {
    "one": "key = 'rec_00150'", "list": "key in ('rec_00001', 'rec_00199', 'nope')", "range": "key > 'rec_00039' and key <= 'rec_00042'", "from": "key >= 'rec_00198'", "before": "key < 'rec_00002'",
    "start": "key like 'rec_0019%'", "ext": "ext = 'json' and key < 'rec_00010'", "shard": "shard = '00002'", "safe": "key <=> 'rec_00005'", "other": "key like '%7' and length(payload) > 100", "none": "key = 'rec' and key is not null",
}


@pytest.mark.parametrize("name", CONDITIONS)
def test_filters_equal_those_after_the_scan(spark, folder, name):
    plain = spark.createDataFrame(plainly(folder), "shard string, key string, ext string, payload binary")
    assert members(shards.read_shards(spark, folder, 50_000).where(CONDITIONS[name])) == members(plain.where(CONDITIONS[name]))


class Counting:
    """A store that counts the bytes that are read of tars."""

    def __init__(self, store):
        self.store, self.bytes, self.opened = store, 0, []

    def __getattr__(self, name):
        return getattr(self.store, name)

    def open_input_file(self, path):
        self.opened.append(path)
        file, own = self.store.open_input_file(path), self

        class File:
            def read_at(self, n, at):
                own.bytes += n
                return file.read_at(n, at)

            def __enter__(self):
                return self

            def __exit__(self, *_):
                file.close()

        return File()


def test_one_percent_of_keys_reads_about_one_percent_of_bytes(tmp_path, monkeypatch, spark):
    path = tars(tmp_path / "big", (100,) * 10, payload=90_000)
    shards.index_shards(spark, path)
    whole = sum(os.path.getsize(f"{path}/{f}") for f in os.listdir(path) if f.endswith(".tar"))
    keys = tuple(f"rec_{i:05d}" for i in range(5, 1000, 100))
    store, place = shards.store_of(path)
    counting, rows, found = Counting(store), shards.shard_table(path), shards.indexed
    monkeypatch.setattr(shards, "store_of", lambda _: (counting, place))
    monkeypatch.setattr(shards, "indexed", lambda _, *more: found(store, *more))
    monkeypatch.setattr(shards, "shard_table", lambda _: rows)
    reader = shards._TarReader(path, 1 << 20)
    assert list(reader.pushFilters([shards.In(("key",), keys), shards.IsNotNull(("key",))])) == []
    got = [row for p in reader.partitions() for batch in reader.read(p) for row in batch.to_pylist()]
    assert sorted({r["key"] for r in got}) == sorted(keys) and len(got) == 20
    assert counting.bytes < 0.012 * whole
    one = shards._TarReader(path, 1 << 30)
    list(one.pushFilters([shards.EqualTo(("key",), "rec_00350")]))
    assert [p.shard for p in one.partitions()] == ["00003"]


def test_unindexed_folders_and_later_tars(spark, tmp_path):
    path = tars(tmp_path / "tars", (3,))
    with pytest.raises(Exception, match="index_shards"):
        shards.read_shards(spark, path).count()
    shards.index_shards(spark, path)
    more = tars(tmp_path / "more", (1, 2))
    os.rename(f"{more}/00001.tar", f"{path}/00001.tar")
    shards.index_shards(spark, path)
    shards.index_shards(spark, path)
    assert shards.read_shards(spark, path).count() == 10 and len(shards.shard_table(path)) == 2
    # A tar that another has replaced is indexed anew.
    os.replace(f"{more}/00000.tar", f"{path}/00000.tar")
    shards.index_shards(spark, path)
    assert members(shards.read_shards(spark, path)) == plainly(path)


def test_odd_member_names(spark, tmp_path):
    os.makedirs(tmp_path / "odd")
    names = ["a/b.c/key.part.json", "key", "dir/", "é" * 120 + ".bin", "x.bin"]
    with tarfile.open(tmp_path / "odd" / "s.tar", "w", format=tarfile.PAX_FORMAT) as tar:
        for n in names:
            info = tarfile.TarInfo(n.rstrip("/"))
            info.type, info.size = (tarfile.DIRTYPE, 0) if n.endswith("/") else (tarfile.REGTYPE, 2)
            tar.addfile(info, io.BytesIO(b"ok") if info.size else None)
    shards.index_shards(spark, str(tmp_path / "odd"))
    got = shards.read_shards(spark, str(tmp_path / "odd")).collect()
    assert sorted((r.key, r.ext, bytes(r.payload)) for r in got) == sorted([("a/b.c/key", "part.json", b"ok"), ("key", "", b"ok"), ("é" * 120, "bin", b"ok"), ("x", "bin", b"ok")])


def test_random_access_by_a_join_with_the_index(spark, folder):
    keys = spark.createDataFrame([("rec_00007",), ("rec_00123",), ("rec_00200",), ("nope",)], "key string")
    wanted = shards.read_index(spark, folder).where("ext = 'bin'").join(keys, "key")
    got = sorted((r.key, bytes(r.payload)[:4]) for r in shards.fetch_members(wanted.unionAll(wanted), folder).collect())
    assert got == sorted([("rec_00007", b"7:xx"), ("rec_00123", b"123:"), ("rec_00200", b"200:")] * 2)


# The endless reader.
def taken(spark, folder, tmp_path, name, stop_after=None, **options):
    """Rows of a stream that runs until it has nothing new, or until `stop_after` batches and then again."""
    out, check = str(tmp_path / name), str(tmp_path / f"{name}-check")
    for last in ([stop_after] if stop_after else []) + [None]:
        stream = endless.endless_samples(spark, folder, str(tmp_path / f"{name}-planned"), **options)
        rows = stream.select("epoch", "place", "shard", "sample", "key", F.col("members")["json"].cast("string").alias("json"), F.map_keys("members").alias("exts"))
        q = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", check).trigger(processingTime="0 seconds").start()
        try:
            if last is None:
                q.processAllAvailable()
            else:
                while (q.lastProgress or {"batchId": -1})["batchId"] < last and q.exception() is None:
                    q.awaitTermination(0.05)
        finally:
            q.stop()
    return spark.read.parquet(out).collect()


def test_two_epochs_hold_every_sample_once_each(spark, folder, tmp_path):
    got = taken(spark, folder, tmp_path, "two", epochs=2, buffer=30, blocks=3)
    every = Counter((e, f"rec_{i:05d}") for e in range(2) for i in range(201))
    assert Counter((r.epoch, r.key) for r in got) == every
    assert all(r.json == '{"n": "%d"}' % int(r.key[4:]) and sorted(r.exts) == ["bin", "json"] for r in got)
    orders = [[r.key for r in sorted(got, key=lambda r: r.place) if r.epoch == e] for e in range(2)]
    assert orders[0] != orders[1] != sorted(orders[1]) and sorted(r.place for r in got if r.epoch == 1) == list(range(201))


def test_a_restart_repeats_and_loses_nothing(spark, folder, tmp_path):
    got = taken(spark, folder, tmp_path, "again", stop_after=1, epochs=3, buffer=20, blocks=2)
    assert Counter((r.epoch, r.key) for r in got) == Counter((e, f"rec_{i:05d}") for e in range(3) for i in range(201))


def test_workers_share_an_epoch(spark, folder, tmp_path):
    got = [r for w in range(2) for r in taken(spark, folder, tmp_path, f"w{w}", epochs=2, worker=w, workers=2, buffer=16)]
    assert Counter((r.epoch, r.key) for r in got) == Counter((e, f"rec_{i:05d}") for e in range(2) for i in range(201))


def test_the_stream_does_not_end_by_itself():
    plan = endless.Epochs([{"shard": "a", "samples": 5}, {"shard": "b", "samples": 0}, {"shard": "c", "samples": 4}], 1, 0, 1, 4)
    at, seen = (0, 0), []
    for _ in range(9):
        to = plan.after(at, 2, 0)
        seen += [(b.epoch, s, i) for b in plan.blocks(at, to) for s, i, j in b.runs for i in range(i, j)]
        at = to
    assert at == (6, 0) and Counter(seen) == Counter((e, s, i) for e in range(6) for s, n in (("a", 5), ("c", 4)) for i in range(n))
    assert {tuple(x["shard"] for x in plan.sequence(e)) for e in range(20)} > {("a", "b", "c")}
    assert plan.after((1, 4), 50, 3) == (3, 0)
