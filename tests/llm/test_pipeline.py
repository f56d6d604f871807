"""The pipeline's stages, each held against a plain version of what it should keep."""

from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from annospark.llm import common, decontam, langid, minhash, mixing


def test_stages(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    cols, seen = docs.columns, {}
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, before, sf).write.parquet(str(tmp_path / name))
        seen[name] = spark.read.parquet(str(tmp_path / name))
        if name != "token_ids":
            assert seen[name].columns == cols
            before = seen[name]
    ids = {n: [r.doc_id for r in df.select("doc_id").collect()] for n, df in seen.items()}
    profiles = langid.learn_profiles(docs.where(common.id_remainder() != 2))
    assert sorted(ids["language"]) == sorted(r.doc_id for r in langid.identify(docs, profiles).where("not rejected").collect())
    assert len(ids["language"]) >= 0.9 * docs.count()
    assert sorted(ids["near_duplicates"]) == sorted(r.doc_id for r in minhash.near_duplicates(seen["language"]).where("kept").collect())
    assert not [r for r in decontam.decontaminate(seen["decontaminated"], spark.read.parquet(f"{sf}/benchmark.parquet")).collect() if r.contaminated]
    dirty = {r.doc_id for r in decontam.decontaminate(seen["near_duplicates"], spark.read.parquet(f"{sf}/benchmark.parquet")).collect() if r.contaminated}
    assert set(ids["decontaminated"]) == set(ids["near_duplicates"]) - dirty
    words = {r.doc_id: r.n for r in seen["decontaminated"].select("doc_id", mixing.word_count().alias("n")).collect()}
    assert max(map(ids["mixed"].count, set(ids["mixed"]))) <= 2
    taken = sum(words[i] for i in ids["mixed"])
    assert abs(taken - 1.5 * sum(words.values())) <= 0.25 * sum(words.values())
    rows = sorted(seen["token_ids"].collect(), key=lambda r: r.start)
    assert sorted(r.doc_id for r in rows) == sorted(ids["mixed"]) == [r.doc_id for r in rows]
    assert all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:]))


def test_odd_rows(spark):
    """Nulls in any column, repeated rows, extra columns whose names clash with the operators' own."""
    sf = "/root/testdata/sf0.001"
    some = spark.read.parquet(f"{sf}/documents.parquet").limit(40)
    odd = spark.createDataFrame([(1001, None, None, None, None), (1002, "", "en", None, 0), (None, "the and of to in that", None, "s", None), (1003, "...", None, "s", 3)], some.schema)
    docs = some.unionByName(odd).unionByName(some.limit(3)).withColumns({"score": F.lit("x"), "size": F.lit(-1), "rejected": F.lit(7), "times": F.lit(None).cast("int"), "hash": F.lit(0), "rep": F.lit("y")})
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        if name == "token_ids":
            assert out.count() == docs.count()
        else:
            assert out.columns == docs.columns
            rows = out.collect()
            assert all((r["score"], r["size"], r["rejected"], r["rep"]) == ("x", -1, 7, "y") for r in rows)
            assert 0 < len(rows) <= 2 * docs.count()


def test_runs_on_an_empty_table(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    none = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, sf).count() == 0


def test_null_and_shared_ids_keep_their_documents(spark):
    sf = "/root/testdata/sf0.001"
    text = lambda name, n=60: " ".join(f"{name}{j}" for j in range(n))
    rows = [(None, text("a")), (None, text("b")), (5, text("c")), (5, text("d")), (7, text("d") + " more"), (8, text("e")), (None, text("e")), (None, text("b") + " end"), (9, text("f")), (9, text("f"))]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], spark.read.parquet(f"{sf}/documents.parquet").schema)
    kept = sorted(((r.doc_id or -1, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, sf).collect()))
    b = min((text("b"), text("b") + " end"), key=lambda t: spark.range(1).select(F.xxhash64(F.lit(t))).first()[0])
    assert kept == sorted([(-1, text("a")), (-1, b), (5, text("c")), (5, text("d")), (8, text("e")), (9, text("f"))])
    # One source, whose target is 1.5 times its words: each document is taken once at least.
    one = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in kept], docs.schema).withColumn("doc_id", F.when(F.col("doc_id") > 0, F.col("doc_id")))
    times = Counter((r.doc_id or -1, r.text) for r in corpus_pipeline.mixed(spark, one, sf).collect())
    assert sorted(times) == kept and set(times.values()) == {1, 2}
