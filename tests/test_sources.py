import io
import os

import numpy as np
from pyspark.sql import functions as F

from annospark.sources import arrays, shards, tables


def test_npz_sidecars(spark, tmp_path):
    np.savez(tmp_path / "rec_1.npz", snr=np.array([1, 2], np.float16), vad=np.array([0, np.nan], np.float16), step_s=0.1)
    r = arrays.read_npz(spark, str(tmp_path)).first()
    assert (r.uid, r.snr, r.c50, round(r.step_s, 3)) == ("rec_1", [1.0, 2.0], None, 0.1)
    frames = arrays.frames_of(arrays.read_npz(spark, str(tmp_path)), ("snr", "vad")).orderBy("i").collect()
    assert [(f.i, f.snr, f.vad) for f in frames] == [(0, 1.0, 0.0), (1, 2.0, None)]


def test_scan_skips_hidden_and_other_files(spark, tmp_path):
    for name in ("a.wav", ".b.wav", "c.txt", "d.FLAC"):
        (tmp_path / name).write_bytes(b"12")
    got = sorted((r.uid, r.ext, r.bytes) for r in tables.scan_files(spark, str(tmp_path)).collect())
    assert got == [("a", ".wav", 2), ("d", ".flac", 2)]


def test_tar_round_trip(spark, tmp_path):
    clips = spark.createDataFrame([("u", i) for i in range(7)], "uid string, clip_idx long")
    m = shards.assign_shards(clips, 3).select("shard", "key", F.explode(F.array(F.struct(F.lit("bin").alias("ext"), F.col("key").cast("binary").alias("payload")), F.struct(F.lit("json").alias("ext"), F.lit("not json").cast("binary").alias("payload")))).alias("m")).select("shard", "key", "m.*")
    shards.write_shards(m, str(tmp_path / "tars"))
    assert len([f for f in os.listdir(tmp_path / "tars") if f.endswith(".tar")]) == 3
    got = shards.samples_of(shards.read_shards(spark, str(tmp_path / "tars"))).orderBy("key").collect()
    assert [(r.key, r.ext, bytes(r.payload).decode()) for r in got] == [(f"u_{i:04d}", "bin", f"u_{i:04d}") for i in range(7)]


def test_log_drops_bad_lines(spark, tmp_path):
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "a.json").write_text('{"step": "vad", "s": 1}\nnot json\n{"step": "snr", "s": 2}\n')
    assert [r.s for r in tables.read_log(spark, str(tmp_path / "log"), "step string, s long", "vad").collect()] == [1]


def test_store_replaces_rows(spark, tmp_path):
    s = tables.ParquetStore(spark, str(tmp_path / "store"), buckets=2)
    s.save(spark.createDataFrame([("a", 1), ("b", 2)], "wav_id string, x int"))
    s.save(spark.createDataFrame([("b", 3)], "wav_id string, x int"))
    assert [r.x for r in s.load("b").collect()] == [3] and s.exists("a") and not s.exists("z")
    assert [r.wav_id for r in s.list_ids().collect()] == ["a", "b"]


def test_csv_flattens(spark, tmp_path):
    tables.write_csv(spark.sql("select 1 as a, array('x', 'y') as b, map('k', 2) as c"), str(tmp_path / "c"))
    assert tuple(spark.read.option("header", True).csv(str(tmp_path / "c")).first()) == ("1", "x;y", '{"k":2}')


def test_store_switches_versions_at_once(spark, tmp_path):
    s = tables.ParquetStore(spark, str(tmp_path / "store"), buckets=3)
    frame = lambda *rows: spark.createDataFrame(rows, "wav_id string, x int")
    s.save(frame(("a", 1), ("b", 2), ("c", 3)), version=0)
    s.save(frame(("b", 5)), version=1)
    frame(("a", 99)).withColumn("slot", s._slot(F.col("wav_id"))).write.partitionBy("slot").parquet(f"{s.path}/rows/version=2")  # a save that was cut off
    assert sorted(map(tuple, s.table().collect())) == [("a", 1), ("b", 5), ("c", 3)]
    s.save(frame(("b", 6)), version=2)
    s.save(frame(("b", 6)), version=2)  # tried again
    assert sorted(map(tuple, tables.ParquetStore(spark, s.path, buckets=3).table().collect())) == [("a", 1), ("b", 6), ("c", 3)]
    s.save(frame(), version=3)
    assert s.table().count() == 3


def test_files_in_any_store(spark, tmp_path):
    store, path = shards.store_of(str(tmp_path))
    assert path == str(tmp_path) and shards.store_of(f"file:{tmp_path}")[1] == shards.store_of(f"file://{tmp_path}")[1] == path
    rows = spark.createDataFrame([("r1", [1.0, 2.0]), ("r2", [0.5])], "uid string, vad array<float>")
    assert arrays.write_npz(arrays.pack_npz(rows, ("vad",)), f"file://{tmp_path}/npz") == 2
    assert sorted((r.uid, r.vad) for r in arrays.read_npz(spark, f"file://{tmp_path}/npz", ("vad",), ()).collect()) == [("r1", [1.0, 2.0]), ("r2", [0.5])]
