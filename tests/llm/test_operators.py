"""The ten operators on small fixtures, against brute force, the libraries themselves or an exact round trip."""

import base64
import hashlib
import json
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from annospark.llm import ann, common, decontam, langid, minhash, mixing, pieces, quality, secrets, suffix_dedup, token_counts, token_output

DOCS = "doc_id long, text string, lang string, source string, hash long, spans string"


def docs(spark, texts, **more):
    """Rows with null and empty texts, a null id nowhere, and extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, "en", "s", 1, "x") for i, t in enumerate(texts)], DOCS)


ODD = [None, "", " ", "!!", "Ünïcode ẞtraße", "a", "a", "word " * 3000, "x" * 20_000, "\t\n", "тест 漢字 　 end"]


def tokenizer_path():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


# 1
def test_ann_exact_scores_order_and_left_out_rows(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 8)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(400, None), (401, [0.0] * 8), (402, [float("nan")] * 8), (403, [float("inf")] + [0.0] * 7), (404, [None] + [1.0] * 7), (405, x[7].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash"))
    got = ann.search(df, df.where("vec_id % 50 = 0"), k=5, n_pivots=32, order_length=24, visit=16, share=0.1, least=64, list_rows=50).collect()
    y, hit = x.astype(float), 0
    y = np.vstack([y, y[7]])
    ids = np.array([*range(400), 405])
    for q in range(0, 400, 50):
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        d = np.sqrt(((y - y[q]) ** 2).sum(1))
        assert [r["rank"] for r in mine] == [1, 2, 3, 4, 5]
        assert all(abs(r.score - d[list(ids).index(r.vec_id)]) < 1e-12 and r.vec_id != q for r in mine)
        assert [(r.score, r.vec_id) for r in mine] == sorted((r.score, r.vec_id) for r in mine)
        best = [int(ids[i]) for i in np.lexsort((ids, d)) if ids[i] != q][:5]
        hit += len(set(best) & {r.vec_id for r in mine})
    assert hit / 40 >= 0.9
    assert not {r.query_id for r in got} & {400, 401, 402, 403, 404}
    assert ann.search(df.limit(0), df).count() == 0
    assert ann.search(df.limit(3), df.limit(1), k=10).count() == 2


def test_footrule_of_places_is_that_of_the_orders():
    rng = np.random.default_rng(1)
    pivots, x = rng.normal(size=(12, 4)), rng.normal(size=(30, 4))
    place = ann.places(x, pivots, 5)
    nearest = np.argsort(((x[:, None] - pivots[None]) ** 2).sum(2), axis=1)[:, :5]
    assert (np.argsort(place, axis=1, kind="stable")[:, :5] == nearest).all() and ((place < 5).sum(1) == 5).all()
    for q in range(5):
        assert (ann.footrule(place[q], place.T.copy(), 5) == np.abs(place - place[q]).sum(1)).all()


def test_ann_repeated_ids_other_lengths_and_a_very_frequent_vector(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 8))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(500, [1.0] * 9), (501, [1.0] * 7), (7, (x[0] + 0.01).tolist()), (7, (x[0] + 3).tolist())]
    rows += [(1000 + i, x[5].tolist()) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.search(df, df.where("vec_id in (0, 5, 7, 500)"), k=10, list_rows=40).collect()
    by = {q: [(r.vec_id, round(r.score, 9)) for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q] for q in (0, 5, 7, 500)}
    assert by[500] == [] and len(by[0]) == len(by[7]) == 10
    assert by[0][0] == (7, round(float(np.sqrt(8) * 0.01), 9)) and len({v for v, _ in by[0]}) == 10
    assert by[5] == [(1000 + i, 0.0) for i in range(10)]
    assert sorted(map(tuple, got)) == sorted(map(tuple, ann.search(df.repartition(7), df.where("vec_id in (0, 5, 7, 500)"), k=10, list_rows=40).collect()))


# 2 and 8
TRICKY = [*[t or "" for t in ODD], "it's  two\n\nlines \n x", "<|endoftext|> in <|endoftext|>x", "a\x1cb c", "tab\tand\r\nmore", " lead", "trail ", "\n", "  ", "²³ Ⅷ ́a", "don't STOP'LL 12,345.67"]


def test_pieces_give_the_librarys_ids():
    tok, enc = library(), pieces.PieceEncoder(tokenizer_path(), most=50)
    for t in TRICKY * 2:
        assert b"".join(np.array([i], "<u4").tobytes() for i in tok.encode(t, add_special_tokens=False).ids) == enc.encode(t)
        assert "".join(pieces.key_text(k) for k in pieces.piece_keys(t)) == t
        enc.trim()


def test_token_counts(spark):
    df = docs(spark, [*ODD, *TRICKY]).unionByName(docs(spark, ["again"]))
    got = Counter(map(tuple, token_counts.count_tokens(df, tokenizer_path(), buckets=3).collect()))
    tok = library()
    assert got == Counter((r.doc_id, len((r.text or "").encode()), len(tok.encode(r.text or "", add_special_tokens=False).ids)) for r in df.collect())
    assert token_counts.count_tokens(df.limit(0), tokenizer_path()).count() == 0


def test_frequent_pre_tokens_are_dealt_by_chunk_too(spark, monkeypatch):
    texts = [f"the same words and no{i}" for i in range(200)]
    got = Counter((r.doc_id, r.n_tokens) for r in token_counts.count_tokens(docs(spark, texts).repartition(5), tokenizer_path(), buckets=64).collect())
    tok = library()
    assert got == Counter((i, len(tok.encode(t, add_special_tokens=False).ids)) for i, t in enumerate(texts))
    assert len({common.spread(p << 32 | c) % 64 for p in range(16) for c in range(16)}) > 48



@pytest.mark.parametrize("bits", [1, 3, 8, 13, 16, 17, 32])
def test_packing_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 2**bits, 70_001, dtype=np.uint64).astype(np.uint32)
    raw = token_output.pack(ids, bits)
    assert len(raw) == -(-len(ids) * bits // 8)
    assert (token_output.unpack(raw, bits, 0, len(ids)) == ids).all()
    assert (token_output.unpack(raw, bits, 12_345, 40_000) == ids[12_345:52_345]).all()
    assert token_output.bits_needed(50_257) == 16 and token_output.bits_needed(2) == 1


def test_token_files(spark):
    df = docs(spark, [*ODD, *TRICKY])
    path = common.shared_folder(spark, "ids")
    token_output.write_ids(df, path, tokenizer_path(), parts=3, block_ids=64)
    got = {r.doc_id: r for r in token_output.read_ids(spark, path, with_ids=True).collect()}
    tok, start, stream = library(), 0, []
    for r in df.orderBy("doc_id").collect():
        ids = [*tok.encode(r.text or "", add_special_tokens=False).ids, 0]
        g = got[r.doc_id]
        assert (g.start, g.n_tokens, list(g.ids), g.ids_crc32) == (start, len(ids), ids, zlib.crc32(np.array(ids, "<u4").tobytes()))
        start, stream = start + len(ids), stream + ids
    assert token_output.read_range(spark, path, 100, 3000) == stream[100:3100]
    token_output.write_ids(df.limit(0), empty := common.shared_folder(spark, "ids"), tokenizer_path())
    assert token_output.read_ids(spark, empty).count() == 0


# 3
def naive_words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def naive_hits(texts, items, n):
    out = []
    for t in texts:
        w, hit, own = naive_words(t), set(), set()
        for item, text in items:
            b = naive_words(text)
            for i in range(max(1, len(b) - n + 1) if b else 0):
                win = b[i : i + n]
                for j in range(len(w) - len(win) + 1):
                    if w[j : j + len(win)] == win:
                        hit |= set(range(j, j + len(win)))
                        own.add(str(item))
        out.append((len(w), len(hit), len(own), hashlib.sha256(",".join(sorted(own)).encode()).hexdigest(), bool(hit)))
    return out


def naive_near(texts, items, distance):
    """Places of each item's rarest word (ties by the word) that have its second rarest near."""
    docs_, out = [naive_words(t) for t in texts], []
    n = Counter(w for d in docs_ for w in d)
    pairs = [p for p in (sorted(set(naive_words(text)), key=lambda w: (n[w], w))[:2] for _, text in items) if len(p) == 2]
    return [sum(any(abs(i - j) <= distance and y == b for j, y in enumerate(d)) for a, b in pairs for i, x in enumerate(d) if x == a) for d in docs_]


def test_decontamination(spark):
    rng = np.random.default_rng(3)
    vocab = ["the", "of", "É1", "and", "zu", "x9", "Rare"]
    long = " ".join(rng.choice(vocab, 40))
    items = [(3, long), (20, "the the the"), (100, None), (7, "..."), (8, long), (9, "One"), (11, " ".join(rng.choice(vocab, 12)))]
    cut = long.split()
    texts = [*ODD, "pre " + ", ".join(cut[5:17]).upper() + " post", " ".join(cut[:9]), "THE the-the the", "one", " ".join(cut + cut), *[" ".join(rng.choice(vocab, 200)) for _ in range(5)]]
    got = decontam.decontaminate(docs(spark, texts), spark.createDataFrame(items, "item_id long, text string")).orderBy("doc_id").collect()
    assert [tuple(r)[1:6] for r in got] == naive_hits(texts, items, 10)
    assert [r.n_near for r in got] == naive_near(texts, items, 10)
    assert decontam.decontaminate(docs(spark, texts).limit(0), spark.createDataFrame(items, "item_id long, text string")).count() == 0
    assert not any(r.contaminated for r in decontam.decontaminate(docs(spark, texts), spark.createDataFrame([], "item_id long, text string")).collect())
    twice = docs(spark, ["one", "one"]).withColumn("doc_id", F.lit(5))
    assert [r.n_hit for r in decontam.decontaminate(twice, spark.createDataFrame(items, "item_id long, text string")).collect()] == [1, 1]


def test_proximity(spark):
    got = decontam.proximity_hits(docs(spark, ["alpha x x beta x alpha", "alpha " + "x " * 20 + "beta", None]), spark.createDataFrame([(1, "alpha", "beta")], "pair_id long, first string, second string"), distance=3).collect()
    assert [(r.doc_id, r.n) for r in got] == [(0, 2)]


# 4
def naive_removed(texts, n):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + n] for b in raw for i in range(len(b) - n + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - n + 1):
            if seen[b[i : i + n]] > 1:
                gone[i : i + n] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((len(b), int(gone.sum()), int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(kept).hexdigest(), kept))
    return out


@pytest.mark.parametrize("n", [3, 20, 50, 400])
def test_suffix_dedup(spark, n):
    rng = np.random.default_rng(n)
    words = ["ab", "cé", "de ", "f", "gh\n"]
    base = "".join(rng.choice(words, 400))
    texts = [*ODD, base, base, "new" + base[100:700] + "end", base[:n], "".join(rng.choice(words, 300)), "q" + base[5 : 5 + n] + "r", "q" + base[5 : 4 + n] + "z"]
    got = suffix_dedup.remove_repeats(docs(spark, texts), length=n, buckets=5).orderBy("doc_id").collect()
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in got] == naive_removed(texts, n)
    assert suffix_dedup.remove_repeats(docs(spark, texts).limit(0), length=n).count() == 0


def test_suffix_dedup_of_planted_passages(spark):
    """Passages of 50 to 80 words, under and over 400 bytes, some in very many documents, over many partitions."""
    rng = np.random.default_rng(12)
    vocab = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyzé"), int(n))) for n in rng.integers(2, 9, 600)]
    prose = lambda n: " ".join(rng.choice(vocab, n))
    passages = [prose(int(n)) for n in rng.integers(50, 81, 24)]
    assert min(len(p.encode()) for p in passages) < 400 < max(len(p.encode()) for p in passages)
    texts = [f"{prose(60)} {passages[i % 24 if i % 3 else 0]} {prose(60)}" for i in range(120)] + [prose(150) for _ in range(30)]
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    got = suffix_dedup.remove_repeats(docs(spark, texts).repartition(29), length=400).orderBy("doc_id").collect()
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    want = naive_removed(texts, 400)
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in got] == want
    long = [len(passages[i % 24 if i % 3 else 0].encode()) >= 400 for i in range(120)] + [False] * 30
    assert all(bool(w[1]) == (is_long or w[1] > 0) for w, is_long in zip(want, long)) and not any(w[1] for w in want[120:])


def test_null_ids_and_repeated_rows(spark):
    """Rows without an id and rows that come twice, with whole and long texts, through all operators on documents."""
    long = "Long lines of words stand here.\n" * 1000
    base = docs(spark, [long, "one two three", None, ""]).withColumn("doc_id", F.when(F.col("doc_id") > 0, F.col("doc_id")))
    rows = base.unionByName(base)
    tok = library()
    ids = [len(tok.encode(t, add_special_tokens=False).ids) for t in (long, "one two three", "", "")]
    want = Counter({(i, n): 2 for i, n in zip((None, 1, 2, 3), ids)})
    assert Counter((r.doc_id, r.n_tokens) for r in token_counts.count_tokens(rows, tokenizer_path()).collect()) == want
    items = spark.createDataFrame([(1, "two three"), (None, "words stand")], "item_id long, text string")
    got = decontam.decontaminate(rows, items).collect()
    assert Counter((r.doc_id, r.n_hit, r.n_items) for r in got) == {(None, 2000, 1): 2, (1, 2, 1): 2, (2, 0, 0): 2, (3, 0, 0): 2}
    assert Counter((r.doc_id, r.n_removed) for r in suffix_dedup.remove_repeats(rows, length=400).collect()) == {(None, len(long)): 2, (1, 0): 2, (2, 0): 2, (3, 0): 2}
    token_output.write_ids(rows, path := common.shared_folder(spark, "ids"), tokenizer_path(), parts=3)
    assert Counter((r.doc_id, r.n_tokens - 1) for r in token_output.read_ids(spark, path).collect()) == want
    crf = quality.Crf(np.linspace(-1, 1, quality.FEATURES), np.eye(2))
    for scored in (quality.score(rows, crf), langid.identify(rows, {"en": b"words of english", "fr": b"des mots"}), secrets.find_secrets(rows)):
        seen = Counter(map(str, scored.collect()))
        assert len(seen) == 4 and set(seen.values()) == {2}


def test_suffix_dedup_counts_repeated_rows(spark):
    twice = docs(spark, ["z" * 10 + "abcdefghij" * 3, "z" * 10 + "abcdefghij" * 3]).withColumn("doc_id", F.lit(1))
    assert [r.n_removed for r in suffix_dedup.remove_repeats(twice, length=30).collect()] == [40, 40]


def test_very_long_documents_in_pieces(monkeypatch):
    """A document longer than a piece gives the same suffixes to the blocks, each once."""
    import pyarrow as pa

    text = "".join(np.random.default_rng(0).choice(list("abcdefgh"), 700))
    last = np.array([len(text) - 20], "<i8").tobytes()
    batch = pa.RecordBatch.from_pydict({"doc_id": [1], "hash": [2], "text": [text], "first": [np.array([0], "<i8").tobytes()], "last": [last]})

    class Context:
        @staticmethod
        def partitionId():
            return 0

    monkeypatch.setattr(suffix_dedup.TaskContext, "get", classmethod(lambda cls: Context))

    def starts(piece):
        monkeypatch.setattr(suffix_dedup, "PIECE", piece)
        out = []
        for b in suffix_dedup._segments(20, 6, 3)(iter([batch])):
            for r in b.to_pylist():
                if not r["own"]:
                    n, member, begin = (suffix_dedup._unpacked(r[c]).astype(int) for c in "ace")
                    out += [s + k for m, s in zip(member, begin) for k in range(n[m])]
        return sorted(out)

    assert starts(64) == starts(10**6) == list(range(len(text) - 19))


@pytest.mark.parametrize("most", [1, 12, 13, 100, 340, 700])
def test_difference_cover(most):
    v, d = suffix_dedup.difference_cover(most)
    assert v <= max(1, most)
    assert {(a - b) % v for a in d.tolist() for b in d.tolist()} == set(range(v))


def test_blocks_compare_bytes_where_fingerprints_agree(monkeypatch):
    monkeypatch.setattr(common.Rolling, "at", lambda self, starts, length: np.zeros(len(starts), np.uint64))
    text = np.frombuffer(b"abcabdabc", np.uint8)
    assert suffix_dedup.repeated(text, np.array([0, 3, 6]), np.array([1, 1, 1]), 3).tolist() == [True, False, True]


# 5
def test_targets_share_the_excess(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 500), (None, 0)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    assert got["a"] == 20.0 and got[None] == 0.0
    assert got["b"] + got["c"] == pytest.approx(1.5 * 1510 - 20) and got["c"] == 1000.0


def test_mix(spark):
    rng = np.random.default_rng(2)
    rows = [(i, " w" * int(rng.integers(0, 50)) if i % 9 else None, ["x", "y", "z", None][i % 4] if i % 3 else "x", 1) for i in range(500)]
    df = spark.createDataFrame([*rows, rows[1], rows[1]], "doc_id long, text string, source string, size int")
    got = mixing.mix(df, ranges=16).collect()
    assert len(got) == 502
    size = {r[0]: len((r[1] or "").split()) for r in rows}
    src = {r[0]: r[2] for r in rows}
    by = {}
    for r in got:
        assert r["size"] == size[r.doc_id] and 0 <= r.taken <= 2 * r["size"]
        s = by.setdefault(src[r.doc_id], [0, r.target, r.source_size])
        s[0] += r.taken
    assert all(abs(t - target) <= 0.5 and target <= 2 * whole for t, target, whole in by.values())
    assert sum(t for _, t, _ in by.values()) == pytest.approx(1.5 * sum(w for _, _, w in by.values()))
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    again = Counter(map(tuple, mixing.mix(df, ranges=16).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert again == Counter(map(tuple, got))
    assert mixing.mix(df.limit(0)).count() == 0


# 6
def test_features_by_line():
    data = np.frombuffer("Ab c\n\n!! x\nE".encode(), np.uint8)
    x, size, begins = quality.line_features(data, np.array([0, 6, 6, 11, 12]))
    assert begins.tolist()[0] == 0 and len(begins) == 5 and len(x) == begins[-1] == len(size)
    assert (np.diff(begins) >= 1).all()


def test_forward_backward_against_all_labelings():
    rng = np.random.default_rng(0)
    crf = quality.Crf(rng.normal(size=3), rng.normal(size=(2, 2)))
    x, begins = rng.normal(size=(6, 3)), np.array([0, 4, 6])
    want = []
    for s, e in ((0, 4), (4, 6)):
        n, p, z = e - s, np.zeros(e - s), 0.0
        for k in range(2**n):
            y = [(k >> i) & 1 for i in range(n)]
            w = np.exp(sum(x[s + i] @ crf.weights * y[i] for i in range(n)) + sum(crf.trans[y[i], y[i + 1]] for i in range(n - 1)))
            z += w
            p += w * np.array(y)
        want += (p / z).tolist()
    assert crf.marginals(x, begins) == pytest.approx(want)


def test_pair_marginals_and_gradients():
    rng = np.random.default_rng(1)
    crf = quality.Crf(rng.normal(size=3), rng.normal(size=(2, 2)))
    x, begins, labels, share = rng.normal(size=(7, 3)), np.array([0, 4, 5, 7]), np.array([1, 0, 1]), np.array([0.5, 0.3, 0.2])
    _, at, pairs = crf.pair_marginals(x, begins)
    assert at.tolist() == [1, 2, 3, 6] and pairs.sum((1, 2)) == pytest.approx(1)
    n, z, want = 4, 0.0, np.zeros((3, 2, 2))
    for k in range(2**n):
        y = [(k >> i) & 1 for i in range(n)]
        w = np.exp(sum(x[i] @ crf.weights * y[i] for i in range(n)) + sum(crf.trans[y[i], y[i + 1]] for i in range(n - 1)))
        z += w
        for i in range(n - 1):
            want[i, y[i], y[i + 1]] += w
    assert pairs[:3] == pytest.approx(want / z)
    _, by_weight, by_trans = quality.log_likelihood(crf, x, begins, labels, share)
    for g, part in ((by_weight, crf.weights), (by_trans, crf.trans)):
        for i in np.ndindex(part.shape):
            part[i] += 1e-6
            up = quality.log_likelihood(crf, x, begins, labels, share)[0]
            part[i] -= 2e-6
            down = quality.log_likelihood(crf, x, begins, labels, share)[0]
            part[i] += 1e-6
            assert g[i] == pytest.approx((up - down) / 2e-6, abs=1e-6)
    fitted = quality.fit_crf(x, begins, labels)
    assert len({round(float(t), 6) for t in fitted.trans.ravel()}) > 2 and np.abs(fitted.trans).max() < 50


def test_long_documents_teach_a_block_of_lines(spark):
    rows = spark.createDataFrame([(0, "bad\n" * 3000), (1, "Good words stand here.\n" * 5)], "doc_id long, text string")
    model = quality.learn(rows, spark.createDataFrame([(0, 0), (1, 1)], "doc_id long, quality int"), lines=50)
    got = {r.doc_id: r.score for r in quality.score(rows, model).collect()}
    assert got[0] < 0.5 < got[1]


def test_quality_on_held_out_rows(spark, sf):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lab = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality.learn(d, lab.where(common.id_remainder() != 2))
    scored = quality.score(d.select("doc_id", "text"), model).join(lab, "doc_id").where(common.id_remainder() == 2).collect()
    assert sum((r.score >= 0.7) == r.quality for r in scored) / len(scored) >= 0.93
    odd = quality.score(docs(spark, ODD).withColumn("score", F.lit("clash")), model).collect()
    assert len(odd) == len(ODD) and all(0 <= r.score <= 1 for r in odd)
    assert quality.score(docs(spark, ODD).limit(0), model).count() == 0
    assert all(0 <= r.good <= 1 for r in quality.line_labels(docs(spark, ODD), model).collect())
    assert 0 <= quality.score(docs(spark, ["x"]), quality.learn(d.limit(0), lab)).first().score <= 1


# 7
def naive_components(texts, percent):
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    at = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= percent * len(a | b):
                    at[i] = at[j] = min(at[i], at[j])
    return [(len(s), at[i], at[i] == i) for i, s in enumerate(sets)]


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates(spark, percent):
    rng = np.random.default_rng(percent)
    words = [f"w{i}" for i in range(300)]
    texts = [*ODD]
    for _ in range(6):
        base = list(rng.choice(words, 120))
        texts.append(" ".join(base))
        for edits in (0, 1, 2, 3, 4, 5, 8):
            copy = list(base)
            for at in rng.choice(120, edits, replace=False):
                copy[at] = "new"
            texts.append(" \n".join(copy).upper())
    got = minhash.near_duplicates(docs(spark, texts), percent=percent, buckets=5).orderBy("doc_id").collect()
    assert [(r.n_shingles, r.component_id, r.kept) for r in got] == naive_components(texts, percent)
    assert minhash.near_duplicates(docs(spark, texts).limit(0)).count() == 0


def test_large_clusters_in_blocks(spark):
    rng = np.random.default_rng(9)
    base, texts = [f"w{j}" for j in range(100)], []
    for i in range(60):  # a chain: each differs a little from the one before, far ones aren't linked themselves
        base[int(rng.integers(0, 100))] = f"n{i}"
        texts.append(" ".join(base))
    texts += [" ".join(f"u{j}" for j in range(30)), "none of these"]
    got = minhash.near_duplicates(docs(spark, texts), percent=80, block_shingles=700).orderBy("doc_id").collect()
    assert [(r.n_shingles, r.component_id, r.kept) for r in got] == naive_components(texts, 80)
    assert len({r.component_id for r in got}) < 30


def test_long_lists_and_null_ids(spark):
    many = [" ".join(f"w{j}" for j in range(60)) + f" tail{i}" for i in range(60)] + ["other words here and there now"]
    got = minhash.near_duplicates(docs(spark, many), percent=85).orderBy("doc_id").collect()
    assert {r.component_id for r in got} == {0, 60}
    nulls = docs(spark, ["a b c d e f", "a b c d e f"]).withColumn("doc_id", F.when(F.col("doc_id") == 1, 7))
    assert sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in minhash.near_duplicates(nulls).collect()) == [(-1, -1, False), (7, 7, True)]


def test_large_cluster_meets_hubs_first(spark):
    """One large group of near copies makes no cells; what is linked with some of them only is still found."""
    rng = np.random.default_rng(9)
    base = [f"w{i}" for i in range(100)]
    texts = []
    for i in range(80):
        own = list(base)
        own[int(rng.integers(0, 100))] = f"n{i}"
        texts.append(" ".join(own))
    for i in range(12):  # further and further away
        base[7 * i] = f"m{i}"
        texts.append(" ".join(base))
    got = minhash.near_duplicates(docs(spark, texts), percent=80, block_shingles=900).orderBy("doc_id").collect()
    assert [(r.n_shingles, r.component_id, r.kept) for r in got] == naive_components(texts, 80)
    sets = docs(spark, texts[:80]).select(F.lit(1).cast("long").alias("component"), F.lit(9).alias("blocks"), F.col("doc_id").alias("rep"), "text").mapInArrow(minhash._sets(5), "component long, blocks int, rep long, shingles binary")
    cells, links = minhash._dealt(sets, 80)
    assert cells.count() == 0 and common.components(links, "rep", "other").where("component = 0").count() == 80


def test_forest_against_all_pairs():
    rng = np.random.default_rng(4)
    sig = rng.integers(0, 3, (60, 8)).astype("<u4")
    sig[30:40] = sig[30] + (rng.random((10, 8)) < 0.1)
    for need in (1, 4, 6, 8):
        label = np.arange(60)
        for _ in range(60):
            for i in range(60):
                label[i] = min(label[j] for j in range(60) if (sig[i] == sig[j]).sum() >= need)
        assert minhash._forest(sig, need).tolist() == label.tolist()


def test_texts_of_a_shared_id_are_linked_each_for_itself(spark):
    text = lambda name: " ".join(f"{name}{j}" for j in range(60))
    for ids in ([3, 3, 4, 5], [4, 4, 3, 5], [3, 3, 5, 4]):
        rows = docs(spark, [text("a"), text("b"), text("a") + " x", text("b") + " y"]).withColumn("doc_id", F.element_at(F.array(*map(F.lit, ids)), (F.col("doc_id") + 1).cast("int")).cast("long"))
        got = {r.doc_id: set() for r in rows.collect()}
        for r in minhash.near_duplicates(rows).collect():
            got[r.doc_id].add((r.component_id, r.kept))
        want = {i: set() for i in ids}
        for i, j in ((0, 2), (2, 0), (1, 3), (3, 1)):
            want[ids[i]].add((min(ids[i], ids[j]), ids[i] <= ids[j]))
        assert got == want


def test_needed_matches_and_components(spark):
    assert minhash.needed_matches(24, 0.85) > minhash.needed_matches(24, 0.8) >= 8
    edges = spark.createDataFrame([(5, 4), (4, 3), (3, 9), (20, 21), (7, 7), (None, 1)], "a long, b long")
    assert sorted(map(tuple, common.components(edges).collect())) == [(3, 3), (4, 3), (5, 3), (9, 3), (20, 20), (21, 20)]


# 9
def test_language(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    profiles = langid.learn_profiles(d.where(common.id_remainder() != 2))
    assert set(profiles) == {"en", "fr", "de", "es"} and all(len(p) <= 112 << 10 for p in profiles.values())
    got = langid.identify(d.where(common.id_remainder() == 2), profiles).collect()
    assert sum(r.lang_pred == r.lang for r in got) / len(got) >= 0.95
    assert sum(r.rejected for r in got) / len(got) <= 0.05
    odd = langid.identify(docs(spark, ODD).withColumn("score", F.lit("clash")), profiles).orderBy("doc_id").collect()
    assert [r.lang_pred == "und" for r in odd] == [not t or not any(c.isalpha() for c in t) for t in ODD]
    assert all(0 <= r.score <= 1 for r in odd)
    assert langid.identify(docs(spark, ODD).limit(0), profiles).count() == 0
    assert {r.lang_pred for r in langid.identify(docs(spark, ODD), {}).collect()} == {"und"}


def test_letters_and_shares_of_the_sample(spark):
    assert {r.lang_pred for r in langid.identify(docs(spark, ["²", "½ ① 12", "…"]), {"en": b"abc", "fr": b"xyz"}).collect()} == {"und"}
    rows = [(0, "x" * 100_000, "en"), *[(i, f"short text number {i}", "en") for i in range(1, 20)]]
    held = langid.learn_profiles(spark.createDataFrame(rows, "doc_id long, text string, lang string"), dict_bytes=2000)["en"]
    assert len(held) <= 2000 and all(f"number {i}\n".encode() in held for i in range(1, 20)) and held.count(b"x") > 1000


# 10
def der(tag, *parts):
    body = b"".join(parts)
    n = len(body)
    return bytes([tag]) + (bytes([n]) if n < 128 else bytes([0x82, n >> 8, n & 255])) + body


def test_secrets(spark):
    key = der(0x30, der(0x02, b"\0"), der(0x02, bytes(range(1, 130))), der(0x30, der(0x06, b"\x2a\x86"), der(0x02, b"\x03")))
    b64 = base64.b64encode(key).decode()
    ssh = base64.b64encode(b"\0\0\0\x0bssh-ed25519" + b"\0\0\0\x20" + bytes(32)).decode()
    part = lambda x: base64.urlsafe_b64encode(json.dumps(x).encode()).decode().rstrip("=")
    jwt = part({"alg": "HS256"}) + "." + part({"sub": "1"}) + ".c2ln"
    texts = [*ODD, f'Password: "abc123!" API_KEY=short7 token = x', "AKIA" + "A" * 16 + " AKIA1", "g" + "0a" * 20 + " " + "ab" * 11, f"é {b64} {ssh}", jwt + " eyJub3Q.anything.x", f"-----BEGIN PRIVATE KEY-----\n{b64[:64]}\n{b64[64:]}\n-----END PRIVATE KEY-----", b64[:-8] + "AAAAAAAA", key.hex(), "ſecret=abcdefgh toKen=abcdefgh"]
    found = secrets.find_secrets(docs(spark, texts)).orderBy("doc_id").collect()
    patterns = [("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m[2]) >= 6), ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20), ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24)]
    for r, t in zip(found, texts):
        want = sorted((m.start(), k, m.end(), name) for k, (name, p, ok) in enumerate(patterns) for m in p.finditer(t or "") if ok(m))
        assert [(s.kind, s.start, s.end) for s in r.spans if s.kind in secrets.BASE] == [(w[3], w[0], w[2]) for w in want]
    kinds = [{s.kind for s in r.spans} - set(secrets.BASE) for r in found[len(ODD) :]]
    assert kinds == [set(), set(), set(), {"der", "ssh"}, {"jwt"}, {"pem"}, set(), {"der"}, set()]
    d = secrets.digest(secrets.find_secrets(docs(spark, texts))).orderBy("doc_id").collect()
    assert d[0].base_sha256 == hashlib.sha256(b"").hexdigest() and d[0].spans == "" and d[len(ODD)].n_assign == 2
    assert "[secret]" in secrets.redact(docs(spark, texts)).orderBy("doc_id").collect()[len(ODD) + 1].text
    assert secrets.find_secrets(docs(spark, texts).limit(0)).count() == 0


def openssh_key(public, cipher=b"none", count=1, check=b"abcdabcd"):
    field = lambda b: len(b).to_bytes(4, "big") + b
    secret = check + public + field(bytes(64)) + field(b"me")
    secret += bytes(range(1, 1 + -len(secret) % 8))
    return b"openssh-key-v1\0" + field(cipher) + field(b"none") + field(b"") + count.to_bytes(4, "big") + field(public) + field(secret)


def test_openssh_keys_are_parsed():
    public = b"\0\0\0\x0bssh-ed25519" + b"\0\0\0\x20" + bytes(32)
    good = openssh_key(public)
    assert secrets.is_ssh_key(good) and secrets.is_ssh_key(public)
    for bad in (good[:-1], good + b"x", b"openssh-key-v1\0" + bytes(range(60)), openssh_key(public, cipher=b""), openssh_key(public, count=2), openssh_key(public, check=b"abcdabce"), openssh_key(public[:-1]), openssh_key(public, cipher=b"aes256-ctr"), public[:-1], b""):
        assert not secrets.is_ssh_key(bad)


def test_keys_over_several_lines_and_long_runs_of_beginnings():
    import time

    key = der(0x30, der(0x02, b"\0"), der(0x02, bytes(range(1, 130))), der(0x30, der(0x06, b"\x2a\x86"), der(0x02, b"\x03")))
    b64 = base64.b64encode(key).decode()
    text = "see\n" + "\n".join(b64[i : i + 64] for i in range(0, len(b64), 64)) + "\nend of it"
    assert [(k, "".join(text[s:e].split())) for k, s, e in secrets.spans_of(text) if k == "der"] == [("der", b64)]
    for bad in ("eyJ", "MIIB", "AAAAB3NzaC1yc2E", "308204", "a\n", "eyJ.", "-----BEGIN X-----"):
        began = time.time()
        secrets.spans_of(bad * (1_000_000 // len(bad)))
        assert time.time() - began < 5


def test_secrets_of_random_runs():
    """Beginnings of keys cut off anywhere, at the ends of runs and texts: nothing is found but also nothing fails."""
    rng = np.random.default_rng(8)
    parts = ["30", "3082", "MII", "MC4C", "AAAAB3NzaC1yc2E", "AAAAC3NzaC1lZDI1NTE5", "b3BlbnNzaC1rZXktdjEA", "0000000b7373682d", "eyJ", ".", "=", "\n", " ", "/", "Zz09", "abcdef0123", "-----BEGIN A-----", "-----END A-----", "é"]
    for _ in range(3000):
        text = "".join(rng.choice(parts, int(rng.integers(1, 14))))
        for k, s, e in secrets.spans_of(text):
            assert 0 <= s < e <= len(text) and k in secrets.KINDS


def test_secrets_in_other_spellings():
    key = der(0x30, der(0x02, b"\0"), der(0x02, bytes(range(1, 130))), der(0x30, der(0x06, b"\x2a\x86"), der(0x02, b"\x03")))
    ssh = b"\0\0\0\x0bssh-ed25519" + b"\0\0\0\x20" + bytes(32)
    private = openssh_key(ssh)
    b64 = base64.b64encode(key).decode()
    spans = lambda t: [(k, t[s:e]) for k, s, e in secrets.spans_of(t) if k not in secrets.BASE]
    for data, kind in ((key, "der"), (ssh, "ssh"), (private, "ssh")):
        h = data.hex()
        for run in (h, h.upper(), h[:40] + h[40:].upper()):
            assert spans(f"x {run}, y") == [(kind, run)]
        assert set(spans(h.upper()[:-1])) == ({("ssh", ssh.hex().upper())} if data is private else set())  # it still holds the public key
        assert spans("0" + h) == [(kind, h)]  # behind letters of the same run
        for before in ("path/", "x", "ab+"):
            run = base64.b64encode(data).decode()
            assert spans(before + run) == [(kind, run)]
            assert (kind, run.rstrip("=")) in [(k, v.rstrip("=")) for k, v in spans(before + run + "Zz")] or run.endswith("=")
    run = base64.b64encode(private).decode()
    assert spans(f"x {run}") == [("ssh", run)]
    assert spans("A" + key.hex())[:1] == [("der", key.hex())]  # a lower-case run beside an upper-case letter
    pem = f"-----BEGIN PRIVATE KEY-----\n{b64[:64]}\r\n{b64[64:]}\n-----END PRIVATE KEY-----\n"
    for depth in range(3):
        assert [k for k, _ in spans(pem)] == ["pem"] if depth else "pem" in {k for k, _ in spans(pem)}
        pem = json.dumps({"key": pem})
    slashed = json.dumps(f"-----BEGIN PRIVATE KEY-----\n{b64}\n-----END PRIVATE KEY-----").replace("/", "\\/").replace("\\n", "\\u000a", 1)
    assert "pem" in {k for k, _ in spans(slashed)}
    assert spans("-----BEGIN PRIVATE KEY-----" + "\\n" * 200_000) == []


def long_der(tag, *parts):
    body = b"".join(parts)
    n = len(body)
    head = bytes([n]) if n < 128 else bytes([0x82, n >> 8, n & 255]) if n < 1 << 16 else bytes([0x83, n >> 16, n >> 8 & 255, n & 255])
    return bytes([tag]) + head + body


def test_keys_of_any_length_and_depth():
    rng = np.random.default_rng(10)
    big = long_der(0x30, long_der(0x02, rng.bytes(60_000)), *[long_der(0x02, rng.bytes(500)) for _ in range(300)])
    deep = long_der(0x02, b"\x05" * 30)
    for _ in range(40):
        deep = long_der(0x30, deep)
    blob = b"\0\0\0\x07ssh-rsa" + b"\0\0\0\x03\1\0\1" + (40_000).to_bytes(4, "big") + rng.bytes(40_000)
    for data, kind in ((big, "der"), (deep, "der"), (blob, "ssh")):
        for run in (base64.b64encode(data).decode(), data.hex()):
            got = [(k, s, e) for k, s, e in secrets.spans_of(f"é {run} x") if k not in secrets.BASE]
            assert got == [(kind, 2, 2 + len(run))]


def test_keys_in_interrupted_runs():
    key = der(0x30, der(0x02, b"\0"), der(0x02, bytes(range(1, 130))), der(0x30, der(0x06, b"\x2a\x86"), der(0x02, b"\x03")))
    b64, h = base64.b64encode(key).decode(), key.hex()
    lines = lambda x, n, glue: glue.join(x[i : i + n] for i in range(0, len(x), n))
    cases = [
        "path/" + lines(b64, 64, "\n"), "xyz/" + lines(b64, 40, "\r\n    "), lines(b64, 60, "\\n"), lines(b64, 60, "\\\\r\\\\n"), lines(b64, 64, "\n> "), lines(b64, 20, "\n>> \t"), "word\n" + lines(b64, 64, "\n"),
        lines(h, 2, ":"), lines(h.upper(), 2, ":"), lines(lines(h, 2, ":"), 45, "\n    "), lines(h, 64, "\n"), lines(h, 2, " "), "\\x" + lines(h, 2, "\\x"), "0x" + lines(h, 2, ", 0x"),
    ]
    for text in cases:
        whole = f"é: {text}\n\nEnd of it."
        got = [(k, whole[s:e]) for k, s, e in secrets.spans_of(whole) if k == "der"]
        assert len(got) == 1, text
        start = next(i for i in (text.find(b64[:8]), text.find("30:82"), text.find("3082"), text.find("30 82"), text.find("30\\x82"), text.find("30, 0x82")) if i >= 0)
        assert got[0][1] == text[start:], text
    for bad in ("M\nII\n", "MIIB\n", "3\n0", "30:82:", "30 82 01 ", "\\x30\\x82", "ab\n> ", "\\n\\n", "a b c d ", "fe ed de ad "):
        import time

        began = time.time()
        secrets.spans_of(bad * (1_000_000 // len(bad)))
        assert time.time() - began < 5, bad
