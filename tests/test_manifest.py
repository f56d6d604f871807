import pytest
from pyspark.sql import functions as F

from annospark.functions import columns as C
from annospark.operators import explore, extend, manifest, samples


def test_contract_and_protected_id(spark):
    df = spark.createDataFrame([(1, 2)], "wav_id long, x int")
    assert dict(manifest.contract(df).dtypes)["wav_id"] == "string"
    with pytest.raises(ValueError):
        manifest.contract(df.drop("wav_id"))
    with pytest.raises(ValueError):
        manifest.rename_columns(df, {"wav_id": "y"})
    assert manifest.select_columns(df, ["x"]).columns == ["wav_id", "x"]


def test_big_join_suffixes_and_errors(spark):
    a, b = spark.createDataFrame([("1", 5)], "wav_id string, duration int"), spark.createDataFrame([("1", 6), ("2", 7)], "wav_id string, duration int")
    assert manifest.big_join([("vad", a), ("snr", b)], "outer").columns == ["wav_id", "duration", "duration_snr"]
    assert manifest.big_join([("vad", a), ("snr", b)], "outer").count() == 2
    assert manifest.big_join([("vad", a)]) is a
    with pytest.raises(ValueError):
        manifest.big_join([])
    with pytest.raises(ValueError):
        manifest.build_manifest({"vad": None})


def test_filter_skips_missing_columns_and_drops_nulls(spark):
    df = spark.createDataFrame([("1", 5.0), ("2", None)], "wav_id string, snr_mean double")
    f = manifest.Filters(min_snr_db=5.0, max_dominant_prob=0.1)
    assert [r.wav_id for r in f.apply(df).collect()] == ["1"]


def test_upsert(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "uid long, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d"), (3, "d")], "uid long, v string")
    assert sorted(map(tuple, manifest.upsert(old, new).collect())) == [(1, "a"), (2, "c"), (3, "d")]


def test_normalize(spark):
    df = spark.createDataFrame([(1, "a/b.wav"), (2, "/x/c.wav"), (3, None)], "k long, path string")
    got = {r.k: (r.path, r.path_legacy, r.uid) for r in manifest.normalize(df, "/root/").collect()}
    assert got == {1: ("/root/a/b.wav", "a/b.wav", "b"), 2: ("/x/c.wav", None, "c")}


def test_label_ids(spark):
    df = spark.createDataFrame([("A",), (None,), ("Z",)], "label string")
    assert [r[0] for r in df.select(C.encode_label(F.col("label"), {"A": 3}, 9)).collect()] == [3, 9, 9]
    assert df.where("label is null").select(C.encode_label(F.col("label"), {"A": 3})).first()[0] == -1
    with pytest.raises(Exception, match="unknown label"):
        df.select(C.encode_label(F.col("label"), {"A": 3})).collect()


def test_sample_arrays(spark):
    df = spark.createDataFrame([([0.0, 1.0, 2.0, 3.0],)], "x array<double>")
    assert df.select(samples.resample(F.col("x"), 4, 2)).first()[0] == [0.0, 3.0]
    assert df.select(samples.normalize_peak(F.col("x"))).first()[0][-1] == 1.0
    assert df.select(samples.speech_only(F.col("x"), F.expr("array(named_struct('first', 1, 'end', 3))"))).first()[0] == [1.0, 2.0]
    assert df.select(samples.normalize_rms(F.array(F.lit(0.0)))).first()[0] == [0.0]


def test_registry_rejects_duplicates():
    r = extend.Registry()
    s = extend.Scorer("a", "1", "x long", lambda it: it)
    r.register(s)
    with pytest.raises(ValueError):
        r.register(s)
    with pytest.raises(KeyError):
        r.get("b")


def test_histogram_caps_values_at_its_bounds(spark):
    rows = spark.createDataFrame([(x,) for x in (-5.0, 0.0, 9.9, 10.0, 29.0, 30.0, 31.0, 1e9, None, float("nan"))], "x double")
    assert sorted(map(tuple, explore.histogram(rows, F.col("x"), 0, 30, 3).collect())) == [(0, 3), (1, 1), (2, 4)]
    assert [explore.log2_bins(n) for n in (0, 1, 128, 129, 1 << 20)] == [8, 8, 8, 9, 21]


def test_adapters(spark):
    esc = manifest.ADAPTERS["esc"]
    meta = spark.createDataFrame([("a", "ok"), ("b", "failed"), ("c", None), ("d", "ok"), (None, "ok")], "uid string, esc_status string")
    files = spark.createDataFrame([("a",), ("b",)], "uid string")
    assert sorted(r.wav_id for r in esc.list_ids(meta).collect()) == ["a", "d"] and [r.wav_id for r in esc.existing(meta, files).collect()] == ["a"]
    assert esc.exists(meta, "a", files) and not esc.exists(meta, "d", files)
    assert {k: df.count() for k, df in esc.load(meta, "a", arrays=files).items()} == {"meta": 1, "arrays": 1}
    with pytest.raises(FileNotFoundError):
        esc.load(meta, "z")
    with pytest.raises(ValueError):
        esc.existing(meta)
