"""Replaced documents, vacuumed versions, cached results by content, processors, stacked masks, file figures and formats."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from annospark.functions import columns as C
from annospark.operators import explore, extend, samples
from annospark.sources import tables


def frame(spark, rows, schema="uid string, x int"):
    return spark.createDataFrame(rows, schema)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


# JSON store
def test_json_store_replaces_documents(spark, tmp_path):
    s = tables.JsonStore(spark, str(tmp_path / "json"), "uid")
    assert not s.exists("a")
    s.save(frame(spark, [("a", 1), ("a", 2), ("b", 3), (None, 4)]))
    s.save(frame(spark, [("b", 5), ("c", 6)]))
    s.save(frame(spark, [(None, 7)]))
    os.makedirs(tmp_path / "json" / "save=9")  # a save that was cut off
    assert got(s.table("uid string, x int")) == sorted([("a", 1), ("a", 2), ("b", 5), ("c", 6), (None, 7)], key=str)
    assert [r.x for r in s.load("b").collect()] == [5] and s.exists("c") and not s.exists("z")
    s.compact("uid string, x int")
    assert got(s.table("uid string, x int")) == sorted([("a", 1), ("a", 2), ("b", 5), ("c", 6), (None, 7)], key=str)
    assert s.table().columns == ["uid", "x"] and len(s._saves()) == 1


def test_vacuum_removes_what_no_slot_needs(spark, tmp_path):
    s = tables.ParquetStore(spark, str(tmp_path / "store"), "uid", buckets=3)
    assert s.table_or_none() is None and s.vacuum() == 0
    for i in range(4):
        s.save(frame(spark, [("a", i), ("b", i)] if i else [(u, 0) for u in "abcdefgh"]))
    want = got(s.table())
    folders = lambda: sum(len([d for d in dirs if d.startswith("slot=")]) for _, dirs, _ in os.walk(tmp_path / "store"))
    before = folders()
    assert s.vacuum(older_than=0) == 0 and folders() == before
    gone = s.vacuum()
    assert gone > 0 and folders() == before - gone and got(s.table()) == want
    assert s.vacuum() == 0
    s.save(frame(spark, [("c", 9)]))
    assert ("c", 9) in got(s.table()) and len(got(s.table())) == 8


# Cache
def test_cache_follows_the_content_of_its_source(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def step(df):
        def double(batches):
            for pdf in batches:
                seen.add(len(pdf))
                yield pdf[pdf.x >= 0].assign(y=pdf.x * 2)

        return df.mapInPandas(double, "uid string, x int, y int")

    def run(rows, **more):
        before = seen.value
        out = got(extend.cached(spark, frame(spark, rows), step, str(tmp_path), "double", more.get("version", "1"), {}).select("uid", "x", "y"))
        return out, seen.value - before

    assert run([("a", 1), ("a", 2), ("b", 3), ("n", -1)]) == ([("a", 1, 2), ("a", 2, 4), ("b", 3, 6)], 4)
    assert run([("n", -1), ("b", 3), ("a", 2), ("a", 1)]) == ([("a", 1, 2), ("a", 2, 4), ("b", 3, 6)], 0)  # also what gave no rows
    assert run([("a", 1), ("a", 2), ("b", 4)]) == ([("a", 1, 2), ("a", 2, 4), ("b", 4, 8)], 1)  # a changed row
    assert run([("b", 4)]) == ([("b", 4, 8)], 0)  # a removed key
    assert run([("a", 1), ("b", 4)]) == ([("a", 1, 2), ("b", 4, 8)], 1)  # a row less
    assert run([("a", 1), ("a", 1), ("b", 4)]) == ([("a", 1, 2), ("a", 1, 2), ("b", 4, 8)], 2)  # a row twice
    assert run([("b", -4)]) == ([], 1)  # results that are gone
    assert run([("b", 4)], version="2") == ([("b", 4, 8)], 1)
    r = extend.cached(spark, frame(spark, [("b", 4)]), step, str(tmp_path), "double", "2", {}).first()
    assert (r.cache_name, r.cache_version, r.cache_params, r.source_id) == ("double", "2", "{}", "b") and r.cached_at is not None and len(r.source_print) == 64


def test_a_cut_off_save_is_computed_again(spark, tmp_path, monkeypatch):
    step = lambda df: df.withColumn("y", F.col("x") + 1)
    rows = frame(spark, [("a", 1), ("b", 2)])
    save = tables.ParquetStore.save

    def broken(self, new, version=None):
        if self.path.endswith("entries"):
            raise OSError("lost")
        save(self, new, version)

    with monkeypatch.context() as m:
        m.setattr(tables.ParquetStore, "save", broken)
        with pytest.raises(OSError):
            extend.cached(spark, rows, step, str(tmp_path), "plus", "1", {})
    assert got(extend.cached(spark, rows, step, str(tmp_path), "plus", "1", {}).select("uid", "x", "y")) == [("a", 1, 2), ("b", 2, 3)]


def test_processor(spark, tmp_path):
    ran = spark.sparkContext.accumulator(0)

    def step(df):
        def count(batches):
            for pdf in batches:
                ran.add(len(pdf))
                yield pdf

        return df.mapInPandas(count, "wav_id string, x int")

    p, folder = extend.Processor("count", "1", step, F.col("x") >= 0), str(tmp_path)
    rows = lambda *r: frame(spark, r, "wav_id string, x int")
    assert got(p.run(rows(("a", 1), ("b", 2)), folder)) == [("a", 1), ("b", 2)] and ran.value == 2
    assert got(p.run(rows(("a", 1), ("b", 2), ("c", 3)), folder)) == [("a", 1), ("b", 2), ("c", 3)] and ran.value == 3
    assert p.exists(spark, folder, "c") and not p.exists(spark, folder, "d") and got(p.load(spark, folder, "b")) == [("b", 2)]
    with pytest.raises(FileNotFoundError):
        p.load(spark, folder, "d")
    with pytest.raises(ValueError, match="of d"):
        p.run(rows(("d", -1), ("e", 1)), folder)
    with pytest.raises(ValueError):
        p.save(rows(("f", None)), folder)
    assert not p.exists(spark, folder, "e")
    assert extend.Processor("free", "1", step).validate(rows(("a", -1))).count() == 0


# Masks
def test_stacked_masks_equal_booleans(spark):
    rng = np.random.default_rng(3)
    rows, want = [], {}
    for batch in range(4):
        own = []
        for i in range(5):
            n = int(rng.integers(1, 40))
            masks = [None if batch == 3 or rng.random() < 0.3 else rng.random(n) < 0.5 for _ in range(3)]
            rows.append((batch, i, n, *[None if m is None else bytearray(np.packbits(m, bitorder="little").tobytes()) for m in masks]))
            own.append((n, [m for m in masks if m is not None]))
        width, labels = max((n for n, m in own if m), default=None), max(len(m) for _, m in own)
        block = None
        if width is not None:
            block = np.zeros((5, labels, width), bool)
            for r, (n, ms) in enumerate(own):
                for k, m in enumerate(ms):
                    block[r, k, :n] = m
        want[batch] = (width, labels, block)
    df = spark.createDataFrame(rows, "b int, i int, n_frames int, m0 binary, m1 binary, m2 binary").repartition(3)
    for r in samples.stack_masks(df, ["b"], ["i"], ["m0", "m1", "m2"]).collect():
        width, labels, block = want[r.b]
        assert (r.n, r.width, r.n_labels) == (5, width, labels)
        assert (r.masks is None) == (block is None)
        if block is not None:
            assert (samples.unpack_stack(bytes(r.masks), r.n, r.width, r.n_labels) == block).all()


def test_batches_are_cut_by_ranges(spark):
    df = spark.createDataFrame([("hot" if i % 3 else "s", i, [1.0] * (i % 5 + 1)) for i in range(100)], "shard string, i int, samples array<double>").repartition(5)
    got = samples.batches(df, 8, ["i"], "shard").orderBy("shard", "batch").collect()
    assert sum(r.n for r in got) == 100 and [r.n for r in got if r.shard == "hot"] == [8] * 8 + [2]
    first = [i for i in range(100) if i % 3][:8]
    assert got[0].lengths == [i % 5 + 1 for i in first] and got[0].width == 5


# Files and formats
def test_file_sizes(spark):
    files = frame(spark, [("a", 10), ("a", 5), ("c", 3), ("other", 99)], "uid string, bytes long")
    r = explore.file_sizes(frame(spark, [("a", 0), ("b", 0), ("c", 0), ("d", 0), ("a", 1)]), files).first()
    assert (r.total, r.n_found, r.n_missing, r.total_bytes, r.least, r.greatest, r["median"], r.missing) == (4, 2, 2, 18, 3, 15, 9.0, "b;d")
    none = explore.file_sizes(frame(spark, [("a", 0)]), files.limit(0)).first()
    assert (none.total, none.n_found, none.total_bytes, none["median"], none.missing) == (1, 0, 0, None, "a")


def test_durations_and_sizes_for_people(spark):
    seconds = [(0.0, "0s"), (45.4, "45s"), (59.6, "60s"), (60.0, "1m 0s"), (200.9, "3m 20s"), (3599.9, "59m 59s"), (3600.0, "1h 0m"), (8100.0, "2h 15m"), (400000.0, "111h 6m")]
    df = frame(spark, [(s,) for s, _ in seconds], "s double")
    assert [r.t for r in df.select(C.human_duration(F.col("s")).alias("t")).collect()] == [t for _, t in seconds]
    sizes = [(0, "0 B"), (1023, "1023 B"), (1024, "1.0 KB"), (5 << 20, "5.0 MB"), (3 << 50, "3.0 PB")]
    df = frame(spark, [(n,) for n, _ in sizes], "n long")
    assert [r.t for r in df.select(C.human_size(F.col("n")).alias("t")).collect()] == [t for _, t in sizes]
