"""How far the sources of a language diverge in vocabulary, and by which terms.

Texts are tokenized on their bytes: one `bytes.translate` lowers A-Z and blanks separators, `bytes.split` cuts, a Counter for each document gives frequencies and, by its keys,
document counts. Counts are sparse from there on: a table has one row for each kept term of a language, with the sources that have it. Two sources differ on
all kept terms, also on those that neither has; the sum over these is a product, the sum over those that one has comes from the source's histogram of counts, and only terms that
both have are looked at one by one.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SLICE_BYTES, shared_folder, tidy

#: Letters A-Z are lowered, other letters and all bytes of non-ASCII code points stay, the rest separates.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

#: Entries of documents' counters that a task holds before it adds them up.
FLUSH = 400_000
#: Parts of a whole that probabilities count in.
SCALE = 1_000_000_000
#: Rows of one block of terms whose pairs of sources are added up together.
BLOCK_ROWS = 100_000


def term_counter(text: bytes) -> Counter:
    """How often each term occurs in a text's UTF-8 bytes; long texts are split in slices."""
    plain, counts, start = text.translate(_TABLE), Counter(), 0
    while start < len(plain):
        end = len(plain) if len(plain) - start <= SLICE_BYTES else plain.find(b" ", start + SLICE_BYTES)
        end = len(plain) if end < 0 else end
        counts.update((plain if end - start == len(plain) else plain[start:end]).split())
        start = end
    return counts


def _count(flush: int):
    names = ["lang", "source", "term", "n", "n_docs"]

    def rows(lang: str, source: str, terms: list, counts: list, docs: int) -> pa.RecordBatch:
        held = pa.table({"term": pa.array(terms, pa.binary()), "n": pa.array(counts, pa.int64())}).group_by("term").aggregate([("n", "sum"), ("n", "count")])
        term = pa.concat_arrays([pa.array([""], pa.string()), *held["term"].cast(pa.string()).chunks])
        n, n_docs = (pa.concat_arrays([pa.array([x], pa.int64()), *held[c].cast(pa.int64()).chunks]) for x, c in ((0, "n_sum"), (docs, "n_count")))
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(term), pa.string()), pa.array([source] * len(term), pa.string()), term, n, n_docs], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], list] = {}
        held = 0
        for b in batches:
            for lang, source, text in zip(b.column("lang").to_pylist(), b.column("source").to_pylist(), b.column("text")):
                counts = term_counter(text.as_py())
                group = groups.setdefault((lang, source), [[], [], 0])
                group[0].extend(counts)
                group[1].extend(counts.values())
                group[2] += 1
                held += len(counts) + 1
                if held >= flush:
                    for key, group in groups.items():
                        yield rows(*key, *group)
                    groups, held = {}, 0
        for key, group in groups.items():
            yield rows(*key, *group)

    return tidy(run)


def vocabulary(docs: DataFrame, min_docs: int = 3, flush: int = FLUSH) -> DataFrame:
    """The terms that at least `min_docs` documents of a language hold: lang, term, n, n_docs, posts (source, n); the term '' stands for the language and lists all its sources.

    Null text, lang and source count as empty; repeated rows are documents of their own; other columns are left out; an empty table gives an empty table. Tasks add up counters of
    documents before rows are shuffled once, by language and term, so a frequent term comes as a row from each task and source.
    """
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("lang", "source", "text")]
    rows = docs.select(text[0].alias("lang"), text[1].alias("source"), text[2].cast("binary").alias("text")).mapInArrow(_count(flush), "lang string, source string, term string, n long, n_docs long")
    by_source = rows.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))
    by_term = by_source.groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"), F.collect_list(F.struct("source", "n")).alias("posts"))
    return by_term.where((F.col("n_docs") >= min_docs) | (F.col("term") == ""))


def probability(n: str, size: str, terms: str) -> Column:
    """1 + floor(SCALE * (n + 1) / (size + terms)), exact at any count."""
    return F.expr(f"1 + (cast({n} as decimal(20, 0)) + 1) * {SCALE} div greatest({size} + {terms}, 1)")


def _f(p: str, q: str) -> str:
    """floor((p - q)**2 / q); both are 1e9 + 1 at most, so the square fits a long."""
    return f"(({p}) - ({q})) * (({p}) - ({q})) div ({q})"


def _together(table: pa.Table) -> pa.Table:
    """For terms that several sources have: what each pair of sources adds beyond the sums that treat each source's terms as absent from the other."""
    lang = table["lang"][0].as_py()
    coded = table["source"].combine_chunks().dictionary_encode()
    names, source = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    term = table["term"].combine_chunks().dictionary_encode().indices.to_numpy()
    order = np.argsort(term, kind="stable")
    source, term = source[order], term[order]
    p, p0 = (table[c].to_numpy()[order] for c in ("p", "p0"))
    start = np.searchsorted(term, term, "left")
    size = np.searchsorted(term, term, "right") - start
    ends, keys, sums = np.cumsum(size), [], []

    def gain(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a - b) * (a - b) // b

    at = 0
    while at < len(term):
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + (1 << 20), "right")))
        a = np.repeat(np.arange(at, end), size[at:end])
        b = np.arange(len(a)) - np.repeat(ends[at:end] - size[at:end] - (ends[at - 1] if at else 0), size[at:end]) + start[a]
        a, b = a[a != b], b[a != b]
        more = gain(p[a], p[b]) - gain(p[a], p0[b]) - gain(p0[a], p[b]) + gain(p0[a], p0[b])
        key, where = np.unique(source[a] * len(names) + source[b], return_inverse=True)
        total = np.zeros(len(key), np.int64)
        np.add.at(total, where, more)
        keys.append(key)
        sums.append(total)
        at = end
    key, where = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(key), np.int64)
    np.add.at(total, where, np.concatenate(sums))
    return pa.table({"lang": pa.array([lang] * len(key), pa.string()), "source": names.take(pa.array(key // len(names))), "item": names.take(pa.array(key % len(names))), "value": pa.array(total, pa.int64())})


def divergence(docs: DataFrame, *, min_docs: int = 3, top: int = 200) -> DataFrame:
    """Divergence of each source of a language from its others, and the terms it uses more than the language: lang, source, part, item, value, rank.

    A group (lang, source) and a language give each kept term p = 1 + floor(1e9 * (count + 1) / (size + V)) of V kept terms with `size` occurrences there; f = floor((p - q)**2 / q).
    Part `pair` has each other source of the language with f summed over all kept terms, all ranks; part `term` kept terms that the group holds and gives more than the
    language does, the first `top` ranks. Ranks are by value, greatest first, then by item in UTF-8 order.

    Sums of a pair stay below (1e9 + V)**2, so they fit a long for vocabularies of up to 2e9 terms. A group without terms has pairs of its own; a language without kept
    terms gives pairs of value 0. For nulls, repeated rows and empty tables see `vocabulary`. The result has a row for each pair of sources of a language; terms are met in blocks of
    about BLOCK_ROWS rows at most, by a hash of the term.
    """
    spark = docs.sparkSession
    path = shared_folder(spark, "vocabulary")
    vocabulary(docs, min_docs).write.parquet(f"{path}/terms")
    terms = spark.read.parquet(f"{path}/terms")
    kept, posts = terms.where("term <> ''"), F.explode("posts").alias("s")
    occurring = terms.where("term = ''").select("lang", posts).select("lang", "s.source")
    sizes = kept.select("lang", posts).groupBy("lang", "s.source").agg(F.sum("s.n").alias("size"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n").alias("lang_size"))
    groups = occurring.join(sizes, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["size", "v", "lang_size"])
    # One row for each source of a language: written, so that Spark knows its size where it chooses a join.
    groups.withColumn("p0", probability("0", "size", "v")).write.parquet(f"{path}/groups")
    groups = spark.read.parquet(f"{path}/groups")

    rows = kept.select("lang", "term", F.col("n").alias("lang_n"), F.size("posts").alias("holders"), posts).select("lang", "term", "lang_n", "holders", "s.source", "s.n")
    rows = rows.join(groups, ["lang", "source"]).withColumns({"p": probability("n", "size", "v"), "q": probability("lang_n", "lang_size", "v")})
    first = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    own = rows.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr(_f("p", "q")).alias("value"))
    own = own.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top)

    others = groups.select("lang", F.col("source").alias("other"), F.col("p0").alias("o0"))
    pairs = groups.join(others, "lang").where("source <> other").select("lang", "source", F.col("other").alias("item"), F.expr(f"cast(v as decimal(38, 0)) * ({_f('p0', 'o0')})").alias("value"))
    counts = rows.groupBy("lang", "source", "p", "p0").agg(F.count("*").alias("m"))
    sides = F.explode(F.array(*[F.struct(F.col(a).alias("source"), F.col(b).alias("item"), F.expr(f"cast(m as decimal(20, 0)) * (({x}) - ({y}))").cast("decimal(38,0)").alias("value")) for a, b, x, y in (("source", "other", _f("p", "o0"), _f("p0", "o0")), ("other", "source", _f("o0", "p"), _f("o0", "p0")))]))
    sided = counts.join(others, "lang").where("source <> other").select("lang", sides.alias("s")).select("lang", "s.*")
    blocks = -(-(terms.where("term <> '' and size(posts) > 1").agg(F.sum(F.size("posts"))).first()[0] or 1) // BLOCK_ROWS)
    shared = rows.where("holders > 1").select("lang", F.pmod(F.xxhash64("term"), F.lit(max(8, blocks))).alias("block"), "term", "source", "p", "p0")
    both = shared.groupBy("lang", "block").applyInArrow(_together, "lang string, source string, item string, value long")
    pairs = pairs.unionByName(sided).unionByName(both.withColumn("value", F.col("value").cast("decimal(38,0)")))
    pairs = pairs.groupBy("lang", "source", "item").agg(F.sum("value").cast("long").alias("value")).withColumn("rank", F.row_number().over(first))
    return own.unionByName(pairs.withColumn("part", F.lit("pair"))).select("lang", "source", "part", "item", "value", "rank")


#: The same in DuckDB's SQL: every group gives every kept term its count, zero included.
DIVERGENCE_SQL = r"""
with d as (select row_number() over () as id, coalesce(lang, '') as lang, coalesce(source, '') as source, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
o as (select id, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
c as (select lang, source, term, count(*) as n, count(distinct id) as docs from o group by lang, source, term),
k as (select lang, term, sum(n) as n from c group by lang, term having sum(docs) >= 3),
v as (select lang, count(*) as v, sum(n) as n from k group by lang),
g as (select distinct lang, source from d),
m as (select g.lang, g.source, k.term, coalesce(c.n, 0) as n, k.n as lang_n from g join k on g.lang = k.lang left join c on c.lang = g.lang and c.source = g.source and c.term = k.term),
z as (select lang, source, sum(n) as size from m group by lang, source),
p as (select m.lang, m.source, m.term, m.n, 1 + (1000000000::hugeint * (m.n + 1)) // (z.size + v.v) as p, 1 + (1000000000::hugeint * (m.lang_n + 1)) // (v.n + v.v) as q
  from m join z on m.lang = z.lang and m.source = z.source join v on v.lang = m.lang),
x as (select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p) as value from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by a.lang, a.source, b.source),
r as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(x.value, 0)::bigint as value from g a join g b on a.lang = b.lang and a.source <> b.source left join x on x.lang = a.lang and x.source = a.source and x.item = b.source
  union all select lang, source, 'term', term, ((p - q) * (p - q) // q)::bigint from p where n > 0 and p > q),
w as (select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank from r)
select lang, source, part, item, value, rank from w where part = 'pair' or rank <= 200
"""
