"""Hot ids, unknown ids, long documents and default parameters."""

import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from annospark.llm import ann, common, quality, queries, token_output


def tokenizer_path():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


# 1
def test_ann_with_default_parameters_finds_nine_of_ten(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(6000, 64)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = ann.search(df, df.where("vec_id % 200 = 0"), k=10).collect()
    hit, y = 0, x.astype(float)
    for q in range(0, 6000, 200):
        d = np.sqrt(((y - y[q]) ** 2).sum(1))
        best = [int(i) for i in np.lexsort((np.arange(6000), d)) if i != q][:10]
        mine = [r for r in got if r.query_id == q]
        assert all(abs(r.score - d[r.vec_id]) < 1e-12 for r in mine)
        hit += len(set(best) & {r.vec_id for r in mine})
    assert hit / 300 >= 0.9


# 6
def plain_chain(first, steps, begins):
    out = np.zeros((len(steps), 2))
    for d, (b, e) in enumerate(zip(begins[:-1], begins[1:])):
        for i in range(b, e):
            out[i] = first[d] if i == b else np.logaddexp(out[i - 1, 0] + steps[i, 0], out[i - 1, 1] + steps[i, 1])
    return out


@pytest.mark.parametrize("lens", [[1], [5, 1, 3], [40, 1, 7, 200], [1000], [2, 129, 128, 127]])
def test_chain_does_not_depend_on_its_pieces(lens):
    rng = np.random.default_rng(len(lens))
    begins = np.concatenate(([0], np.cumsum(lens)))
    steps, first = rng.normal(size=(begins[-1], 2, 2)) * 5, rng.normal(size=(len(lens), 2))
    for most in (2, 3, 16, 128, 5000):
        assert np.allclose(quality.chain(first, steps, begins, most), plain_chain(first, steps, begins))


def test_line_scores_do_not_depend_on_parts():
    rng = np.random.default_rng(2)
    weights = rng.normal(size=quality.FEATURES)
    for text in ("x y, Z\n\nword word word!\n" * 200 + "tail", "one line", "\n\n\n", "same line\n" * 50, "long " * 500 + "\nshort\n" + "é" * 300):
        data = np.frombuffer(text.encode(), np.uint8)
        offsets = np.array([0, len(data)])
        x, size, begins = quality.line_features(data, offsets)
        for most in (1, 7, 100, 5000):
            got = quality.line_scores(weights, data, offsets, most)
            assert np.allclose(got[0], x @ weights) and (got[1] == size).all() and (got[2] == begins).all()


def test_a_million_lines_are_scored_in_seconds():
    rng = np.random.default_rng(3)
    crf = quality.Crf(rng.normal(size=quality.FEATURES), rng.normal(size=(2, 2)))
    data = np.frombuffer(b"ab c\n" * 1_000_000, np.uint8)
    began = time.time()
    emit, _, begins = quality.line_scores(crf.weights, data, np.array([0, len(data)]))
    p = crf.good(emit, begins)
    assert len(p) == 1_000_001 and ((p >= 0) & (p <= 1)).all() and time.time() - began < 30


def test_penalty_by_cross_validation():
    rng = np.random.default_rng(4)
    lens = rng.integers(1, 6, 120)
    begins = np.concatenate(([0], np.cumsum(lens)))
    labels = rng.integers(0, 2, 120)
    x = rng.normal(size=(begins[-1], 4)) * 0.3
    x[:, 0] += np.repeat(labels, lens)
    x[:, 3] = 1
    got = quality.cross_validate(x, begins, np.ones(begins[-1]), labels, rng.integers(0, 3, 120), (1e-3, 1e3), steps=60)
    assert got[1e-3] > 0.9 and got[1e-3] > got[1e3]


# 6, 9
def test_unknown_ids_are_not_held_out(spark, tmp_path):
    rows = [(None, "some words here\nand there", "en", "s", 1), *[(i, f"text number {i} of the words\n" * 3, "en" if i % 2 else "fr", "s", 1) for i in range(40)]]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for query in (queries.op6_quality, queries.op9_language):
        got = {r.doc_id: r.held_out for r in query(spark, str(tmp_path)).collect()}
        assert got == {i: zlib.crc32(str(i).encode()) % 4 == 2 if i is not None else False for i in [None, *range(40)]}


# 8
def test_an_id_of_very_many_rows_is_written_in_several_ranges(spark):
    texts = [f"text number {i} of one id" for i in range(3000)]
    df = spark.createDataFrame([(7, t) for t in texts] + [(None, t) for t in texts[:500]] + [(8, "last"), (1, "first")], "doc_id long, text string").repartition(6)
    token_output.write_ids(df, path := common.shared_folder(spark, "ids"), tokenizer_path(), parts=8)
    sizes = [r["n"] for r in spark.read.parquet(f"{path}/blocks").groupBy("part").agg(F.sum(F.size("doc_ids")).alias("n")).collect()]
    assert len(sizes) >= 6 and max(sizes) < 1500 and sum(sizes) == 3502
    got = token_output.read_ids(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None] * 500 + [1] + [7] * 3000 + [8]
    assert all(b.start == a.start + a.n_tokens for a, b in zip(got, got[1:]))
    assert token_output.read_range(spark, path, got[-1].start, got[-1].n_tokens)[-1] == 0
