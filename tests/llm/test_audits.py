"""Filter interactions and source divergence, against brute force on the contract's own words."""

import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from annospark.llm import filter_audit, source_audit

DOCS = "doc_id long, text string, lang string, source string, part string, n long, digest string, fails int"
CLASH = ("p", 7, "x", 1)


def docs(spark, rows):
    """Rows (doc_id, text, lang, source) with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(*r, *CLASH) for r in rows], DOCS)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


TEXTS = [
    None, "", " \t\n", "short", "short", "UPPER CASE words HERE", "pipe | and #tag", "no " * 60, " ".join(f"w{i}" for i in range(60)), " ".join(f"w{i}" for i in range(60)),
    " ".join(f"W{i}" for i in range(60)), "É" * 40, "漢字 　 " * 30, "a\x0bb\x0cc\x1cd\x85e " * 20, "nul\x00byte " * 55,
]


# 11
def brute_audit(rows, marks):
    """part -> order -> step -> figures, by walking the documents themselves."""
    good, toxic = ({d for d, *m in marks if m[i] == 1 and d is not None} for i in (0, 1))
    docs = []
    for d, text, _, source in rows:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = set()
        if len(words) < 50:
            fails.add("A")
        if 100 * len(set(words)) < 65 * len(words):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 5 * len(t):
            fails.add("C")
        if re.search(r"[#$%&*|]", t):
            fails.add("D")
        if d is not None and any(e is not None and e < d and (u or "") == t for e, u, _, _ in rows):
            fails.add("E")
        docs.append((source or "", fails, d in good, d in toxic))
    out = {}
    for part in {p for p, *_ in docs}:
        mine = [x for x in docs if x[0] == part]
        shapley = Counter()
        for order in permutations("ABCDE"):
            left = mine
            for k, f in enumerate(order):
                gone = [x for x in left if f in x[1]]
                redundant = sum(f in x[1] for x in mine) - len(gone)
                left = [x for x in left if f not in x[1]]
                shapley[f] += len(gone)
                out[part, "".join(order), k + 1] = [len(left), len(gone), redundant, sum(x[1] == {f} for x in mine), sum(x[2] for x in gone), sum(x[3] for x in gone)]
        for key in out:
            if key[0] == part:
                out[key].append(shapley[key[1][key[2] - 1]])
    return out


def audited(spark, rows, marks):
    got = filter_audit.audit(filter_audit.cells(docs(spark, rows), labels(spark, marks)), list(filter_audit.FILTERS)).collect()
    return {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in got}


def test_audit_equals_brute_force_with_nulls_ties_and_repeated_rows(spark):
    rows = [(i, t, "en", ("a", "b", None, "")[i % 4]) for i, t in enumerate(TEXTS)]
    rows += [(3, "short", "en", "a"), (3, "short", "en", "b"), (None, "short", "en", "a"), (None, None, "en", None), (2, "short", "en", "b"), (3, "another text of this id", None, "a")]
    marks = [(0, 1, 0), (3, 1, 1), (3, 0, 0), (4, None, 1), (9, 1, None), (None, 1, 1), (999, 1, 1), (12, 0, 1)]
    got = audited(spark, rows, marks)
    assert got == brute_audit(rows, marks)
    assert len(got) == 3 * 600


def test_audit_of_random_documents(spark):
    rng = np.random.default_rng(11)
    words = ["one", "Two", "THREE", "four#", "fünf", "six|", "seven"]
    texts = [" ".join(rng.choice(words, rng.integers(0, 90))) for _ in range(25)]
    rows = [(int(i), texts[rng.integers(25)], "en", f"s{rng.integers(3)}") for i in rng.permutation(120)]
    marks = [(int(i), int(rng.integers(2)), int(rng.integers(2))) for i in range(0, 120, 3)]
    assert audited(spark, rows, marks) == brute_audit(rows, marks)


def test_audit_of_an_empty_table_and_of_a_hot_text(spark):
    assert audited(spark, [], [(1, 1, 1)]) == {}
    got = audited(spark, [(i, "the same", "en", "s") for i in range(500)], [])
    assert got["s", "EABCD", 1] == [1, 499, 0, 0, 0, 0, got["s", "EABCD", 1][-1]]


def test_measures_of_long_texts_do_not_depend_on_slices(spark):
    text = ("alpha BETA g$mma " * 9000 + "ende" * 50 + "\n") * 3
    assert [b"".join(p.split()) for p in filter_audit.slices(text.encode(), 1000)] != [] and b"".join(filter_audit.slices(text.encode(), 1000)) == text.encode()
    assert [w for p in filter_audit.slices(text.encode(), 1000) for w in p.split()] == text.encode().split()
    row = filter_audit.measure(docs(spark, [(1, text * 4, None, None)])).first()
    assert (row.part, row.n_words, row.n_distinct, row.n_chars) == ("", len(text.split()) * 4, 4, len(text) * 4)
    assert row.n_upper == text.count("BETA") * 16 and row.n_symbols == text.count("$") * 4


@pytest.mark.parametrize("n", [1, 2, 5])
def test_gray_walk_visits_every_subset(n):
    counts = np.random.default_rng(n).integers(0, 50, (2, 1 << n))
    states = filter_audit.gray_states(counts)
    for subset in range(1 << n):
        assert (states[:, subset] == counts[:, (np.arange(1 << n) & subset) == 0].sum(1)).all()


def test_audit_with_filters_of_ones_own(spark):
    rows = [(i, t, "en", "s") for i, t in enumerate(TEXTS)]
    own = {"x": "n_words = 0", "y": F.col("n_chars") > 100}
    got = filter_audit.audit(filter_audit.cells(docs(spark, rows), labels(spark, []), own, copies=None), list(own)).collect()
    kept = {(r.filter_order, r.step): r.kept for r in got}
    empty, long = sum(not (t or "").split() for t in TEXTS), sum(len(t or "") > 100 for t in TEXTS)
    assert kept["xy", 1] == len(TEXTS) - empty and kept["yx", 1] == len(TEXTS) - long and kept["xy", 2] == kept["yx", 2]


# 12
def brute_divergence(rows, min_docs=3, top=200):
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, held, groups = {}, {}, {(x[2] or "", x[3] or "") for x in rows}
    for _, text, lang, source in rows:
        c = Counter(t.translate(lower) for t in term.findall(text or ""))
        counts.setdefault((lang or "", source or ""), Counter()).update(c)
        held.setdefault(lang or "", Counter()).update(c.keys())
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in held[lang].items() if n >= min_docs]
        sources = [s for x, s in groups if x == lang]
        size = {s: sum(counts[lang, s][t] for t in kept) for s in sources}
        p = {(s, t): 1 + 10**9 * (counts[lang, s][t] + 1) // (size[s] + len(kept)) for s in sources for t in kept}
        q = {t: 1 + 10**9 * (sum(counts[lang, s][t] for s in sources) + 1) // (sum(size.values()) + len(kept)) for t in kept}
        f = lambda a, b: (a - b) ** 2 // b
        for s in sources:
            pair = sorted(((-sum(f(p[s, t], p[o, t]) for t in kept), o.encode(), o) for o in sources if o != s))
            own = sorted((-f(p[s, t], q[t]), t.encode(), t) for t in kept if counts[lang, s][t] and p[s, t] > q[t])[:top]
            out += [(lang, s, part, item, -v, i + 1) for part, found in (("pair", pair), ("term", own)) for i, (v, _, item) in enumerate(found)]
    return sorted(out)


def diverged(spark, rows, **more):
    got = source_audit.divergence(docs(spark, rows), **more)
    assert got.dtypes == [("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"), ("value", "bigint"), ("rank", "int")]
    return sorted(tuple(r) for r in got.collect())


def test_divergence_equals_brute_force_with_odd_rows(spark):
    rows = [(i, t, (None, "", "en", "de")[i % 4], ("a", None, "b")[i % 3]) for i, t in enumerate(TEXTS * 4)]
    rows += [(1, "Straße straße STRAßE É é", "de", "c"), (1, "Straße straße STRAßE É é", "de", "c"), (None, "x_y-z'q x1y", "de", "c"), (7, None, "zz", "only"), (8, "one term here", "yy", "u"), (9, "", "yy", "v")]
    assert diverged(spark, rows) == brute_divergence(rows)
    assert diverged(spark, []) == []


def test_divergence_of_random_documents_ties_and_ranks(spark):
    rng = np.random.default_rng(12)
    words = np.array([f"{a}{b}" for a in "abcdefghijklmnoö" for b in "pqrstuvwxyzéßн漢"])
    rows = []
    for i in range(300):
        lang, source = f"l{rng.integers(2)}", f"s{rng.integers(7)}"
        shift = int(source[1]) * 20
        rows.append((i, " ".join(words[(rng.zipf(1.3, rng.integers(0, 60)) + shift) % len(words)]), lang, source))
    want = brute_divergence(rows, top=12)
    assert diverged(spark, rows, top=12) == want
    assert max(r[5] for r in want if r[2] == "term") == 12 and len({r[4] for r in want if r[2] == "term"}) < sum(r[2] == "term" for r in want)


def test_divergence_does_not_depend_on_flushes_blocks_or_slices(spark, monkeypatch):
    rng = np.random.default_rng(13)
    rows = [(i, " ".join(f"w{chr(97 + x % 26)}{chr(97 + x // 26 % 26)}" for x in rng.zipf(1.2, 80) % 676), "en", f"s{i % 9}") for i in range(60)]
    want = diverged(spark, rows)
    monkeypatch.setattr(source_audit, "BLOCK_ROWS", 50)
    monkeypatch.setattr(source_audit, "FLUSH", 100)
    assert diverged(spark, rows) == want == brute_divergence(rows)
    small = source_audit.vocabulary(docs(spark, rows), flush=64).where("term <> ''").groupBy("lang").agg(F.count("*"), F.sum("n")).collect()
    assert small == source_audit.vocabulary(docs(spark, rows)).where("term <> ''").groupBy("lang").agg(F.count("*"), F.sum("n")).collect()


def test_counter_of_a_long_text():
    text = ("Wort für WORT, " * 100_000 + "x" * 3_000_000 + " ende").encode()
    assert source_audit.term_counter(text) == {b"wort": 200_000, "für".encode(): 100_000, b"x" * 3_000_000: 1, b"ende": 1}


def test_probability_is_exact_at_counts_that_a_long_cannot_multiply(spark):
    n, size, v = 10**13 + 7, 3 * 10**14 + 1, 10**8 + 3
    assert spark.sql(f"select {n}L as n, {size}L as size, {v}L as v").select(source_audit.probability("n", "size", "v").alias("p")).first().p == 1 + 10**9 * (n + 1) // (size + v)
