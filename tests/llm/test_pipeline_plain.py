"""The pipeline's stages against plain Python that shares no code with the operators."""

import re
import zlib
from collections import defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def docs(spark):
    """The documents with planted ones: near copies in a chain, passages of the benchmark, nulls and repeated rows."""
    table = spark.read.parquet(f"{SF}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").where("text is not null").orderBy("item_id").limit(3).collect()]
    base = [f"chain{i}" for i in range(200)]
    chain = [" ".join([f"x{k}" for k in range(4 * step)] + base[4 * step :]) for step in range(5)]
    planted = [(900_000 + i, t, "en", "s", 1) for i, t in enumerate(chain)]
    planted += [(910_000 + i, f"Some words before. {t.upper()}; and after", "en", "s", 1) for i, t in enumerate(items)]
    planted += [(910_010, " ".join(items[0].split()[:4]), "en", "s", 1), (None, f"no id {items[1]}", None, None, None), (None, "no id and clean of all of it", None, None, None), (920_000, None, "en", "s", 1), (920_001, "", "en", "s", 1), (920_002, " ", "en", "no words", 1)]
    extra = spark.createDataFrame(planted, table.schema)
    return table.unionByName(extra).unionByName(table.limit(4)).withColumn("positions", F.lit(3)).withColumn("item_id", F.lit("own")).checkpoint()


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def test_decontaminated_drops_what_a_plain_search_finds_and_nothing_else(spark, docs):
    windows = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        words = plain_words(r.text)
        windows |= {tuple(words[i : i + 10]) for i in range(max(1, len(words) - 9)) if words}
    short = {w for w in windows if len(w) < 10}

    def dirty(text):
        words = plain_words(text)
        return any(tuple(words[i : i + 10]) in windows for i in range(len(words))) or any(tuple(words[i : i + len(w)]) == w for w in short for i in range(len(words)))

    rows = docs.collect()
    got = corpus_pipeline.decontaminated(spark, docs, SF)
    assert got.columns == docs.columns
    key = lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or "")
    kept = [r for r in rows if not dirty(r.text)]
    assert sorted(got.collect(), key=key) == sorted(kept, key=key) and len(kept) < len(rows) - 3
    assert {r.doc_id for r in rows} - {r.doc_id for r in kept} >= {910_000, 910_001, 910_002} and (None, "no id and clean of all of it") in {(r.doc_id, r.text) for r in kept}


def test_near_duplicates_keep_the_least_of_each_plain_component(spark, docs):
    rows = docs.where("doc_id is not null").dropDuplicates(["doc_id", "text"])
    sets = {}
    for r in rows.collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", (r.text or "").translate(LOWER))
        sets[r.doc_id] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    head = {i: i for i in sets}

    def find(i):
        while head[i] != i:
            i = head[i]
        return i

    by_shingle = defaultdict(list)
    for i in sorted(sets):
        for j in {j for s in sets[i] for j in by_shingle[s]}:
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                head[max(a, b)] = min(a, b)
        for s in sets[i]:
            by_shingle[s].append(i)
    got = sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, rows, SF).collect())
    assert got == sorted(i for i in sets if find(i) == i)
    assert 900_000 in got and not {900_001, 900_002, 900_003, 900_004} & set(got)


def test_mixed_takes_about_the_target_of_each_source(spark, docs):
    rows = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    size, most = defaultdict(int), defaultdict(int)
    count = lambda text: len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    for r in rows.collect():
        size[r.source] += count(r.text)
        most[r.source] = max(most[r.source], count(r.text))
    order = sorted((s for s in size if s is not None)) + [None] * (None in size)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, left, open_ = {}, 1.5 * sum(size.values()), set(order)
    while over := {s for s in open_ if left * weight[s] / sum(weight[x] for x in open_) > 2 * size[s]}:
        target |= {s: 2 * size[s] for s in over}
        left -= sum(2 * size[s] for s in over)
        open_ -= over
    target |= {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
    taken, times = defaultdict(int), defaultdict(int)
    for r in corpus_pipeline.mixed(spark, rows, SF).collect():
        taken[r.source] += count(r.text)
        times[r.doc_id] += 1
    assert max(times.values()) <= 2
    assert all(abs(taken[s] - target[s]) <= most[s] for s in order)
    wordless = {r.doc_id: r.source for r in rows.collect() if not count(r.text)}
    assert wordless and all(times[i] == (min(2, int(target[s] // size[s])) if size[s] else 0) for i, s in wordless.items())


def test_token_ids_equal_the_library_in_order(spark, docs):
    rows = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    library, start, want = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0, []
    for r in sorted(rows.collect(), key=lambda r: r.doc_id):
        ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 0]
        want.append((r.doc_id, start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
        start += len(ids)
    got = corpus_pipeline.token_ids(spark, rows, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == want
