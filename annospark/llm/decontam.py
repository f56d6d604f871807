"""Benchmark decontamination with a distributed positional inverted index.

Each window of a test item is known by its two rarest terms, as all training texts count them. For these terms the postings
(term, document, position) of all training texts are stored; those of a rarest term also hold the words around.
A posting less the term's offset in the item is a place where the item might lie. The lists of a window's two terms are intersected
on that place, rarest first, and what both lists have is confirmed word by word with the words that the posting holds:
texts are not read again. Proximity matches come from the same lists: both of an item's rarest terms within a distance.
All of it is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shared_folder

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What parts words: all ASCII but digits and lower-case letters; A-Z too where the text isn't lower-cased yet.
_GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_GAPS_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes of a table made from the benchmark up to which it may be broadcast; they are summed each time.
BROADCAST_BYTES = 32 << 20


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def _cut(text: Column, gaps: str = _GAPS) -> tuple[Column, Column, Column]:
    """The text's parts between gaps, whether the first is empty, and the number of words."""
    parts = F.split(text, gaps)
    lead = (F.element_at(parts, 1) == "").cast("int")
    return parts, lead, F.size(parts) - lead - F.when((F.size(parts) > 1) & (F.element_at(parts, -1) == ""), 1).otherwise(0)


def words_of(text: Column) -> Column:
    """Lower-cased words of a text; none for null."""
    parts, lead, n = _cut(lower_ascii(F.coalesce(text, F.lit(""))))
    return F.slice(parts, lead + 1, n)


def _checked(df: DataFrame) -> DataFrame:
    """Broadcast where the summed bytes allow it, else an ordinary join side (Spark then shuffles and splits skewed keys)."""
    size = df.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def _stored(df: DataFrame, name: str) -> DataFrame:
    df.write.parquet(path := shared_folder(df.sparkSession, name))
    return df.sparkSession.read.parquet(path)


def item_windows(items: DataFrame, window: int) -> DataFrame:
    """Rows (item, item_id, first, phrase): the words of each window of an item, or one window over all words of a shorter one. item tells items of
    one id, or of none, apart by their words."""
    w = items.select("item_id", words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    w = w.select(F.xxhash64(F.col("item_id").cast("string"), "words").alias("item"), "item_id", "words", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("words") - window))).alias("first"))
    return w.select("item", "item_id", "first", F.slice("words", F.col("first") + 1, F.least(F.size("words"), F.lit(window))).alias("phrase"))


def _parts(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text_hash, parts) of the texts that aren't null; parts between gaps are words but for empty ones at either end."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), lower_ascii(F.col("text")).alias("low")).where("low is not null")
    return rows.select("doc_id", "text_hash", _cut(F.col("low"))[0].alias("parts"))


# Parts are exploded with the outer form, though there always is one: for the other, Spark adds a filter on the array's size, for which it splits each text again.


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Rows (term_id, n): how often each of the `terms` (term_id, a term's xxhash64) occurs in all texts, 0 included."""
    words = _parts(docs).select(F.explode_outer("parts").alias("term")).select(F.xxhash64("term").alias("term_id"))
    n = words.join(_checked(terms), "term_id").groupBy("term_id").agg(F.count("*").alias("n"))
    return terms.join(n, "term_id", "left").select("term_id", F.coalesce("n", F.lit(0)).alias("n"))


def build_index(docs: DataFrame, terms: DataFrame, path: str, *, around: int = 0) -> DataFrame:
    """Stores postings (term_id, doc_id, text_hash, pos, back, near) of `docs` for the rows (term_id, lead) of `terms` under `path` and returns them.

    A term's id is its xxhash64; pos counts words from 0. Postings of terms marked `lead` have in `near` up to `around` words on either side and the word
    itself, `back` of them before it. Null and empty texts have no postings. A document is known by its id and its text's hash, so that rows that
    share an id but not the text are kept apart.
    """
    words = _parts(docs).select("doc_id", "text_hash", "parts", F.posexplode_outer("parts").alias("at", "term")).withColumn("term_id", F.xxhash64("term"))
    start = F.greatest(F.col("at") - around, F.lit(0))
    near = F.when(F.col("lead"), F.slice("parts", start + 1, F.col("at") + around + 1 - start))
    first = (F.get("parts", F.lit(0)) == "").cast("int")
    words.join(_checked(terms), "term_id").select("term_id", "doc_id", "text_hash", (F.col("at") - first).alias("pos"), (F.col("at") - start).alias("back"), near.alias("near")).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def _lookups(docs: DataFrame, items: DataFrame, window: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(windows with the terms that they are looked up by, pairs of each item's two rarest terms, stored index of all these terms)."""
    windows = item_windows(items.select("item_id", "text"), window)
    spots = windows.select("item", "item_id", "first", "phrase", F.posexplode("phrase").alias("at", "term")).withColumn("term_id", F.xxhash64("term"))
    counts = _stored(term_counts(docs, spots.select("term_id").distinct()), "term-counts")
    ranked = spots.join(_checked(counts), "term_id").select("item", "item_id", "first", "phrase", "term", F.struct("n", (F.col("first") + F.col("at")).alias("p"), "term_id").alias("spot"))
    two = ranked.groupBy("item", "first").agg(F.min("item_id").alias("item_id"), F.min("phrase").alias("phrase"), F.slice(F.array_sort(F.collect_list("spot")), 1, 2).alias("two")).where("two[0].n > 0")
    looked = two.select("item", "item_id", "first", "phrase", *[F.get("two", F.lit(k))[c].alias(f"{c}{k + 1}") for k in (0, 1) for c in ("term_id", "p")])
    looked = _stored(looked, "windows")
    rare = ranked.select("item", F.struct("spot.n", "term", "spot.term_id").alias("t")).groupBy("item").agg(F.slice(F.array_sort(F.collect_set("t")), 1, 2).alias("two"))
    pairs = _stored(rare.where("size(two) = 2").select(F.col("item").alias("pair_id"), F.col("two")[0]["term_id"].alias("first"), F.col("two")[1]["term_id"].alias("second")), "pairs")
    terms = looked.select(F.col("term_id1").alias("term_id"), F.lit(True).alias("lead"))
    for df, c in ((looked, "term_id2"), (pairs, "first"), (pairs, "second")):
        terms = terms.unionByName(df.select(F.col(c).alias("term_id"), F.lit(False).alias("lead")))
    terms = terms.where("term_id is not null").groupBy("term_id").agg(F.max("lead").alias("lead"))
    return looked, pairs, build_index(docs, terms, shared_folder(docs.sparkSession, "postings"), around=window - 1)


def _phrases(index: DataFrame, windows: DataFrame) -> DataFrame:
    """Rows (doc_id, text_hash, item, item_id, positions) from the lists of the windows' terms."""
    first = index.where("near is not null").join(_checked(windows.select(F.col("term_id1").alias("term_id"), "item", "p1", "p2").distinct()), "term_id")
    first = first.select("doc_id", "text_hash", "item", (F.col("pos") - F.col("p1")).alias("place"), "p1", "p2", "back", "near")
    second = index.join(_checked(windows.where("p2 is not null").select(F.col("term_id2").alias("term_id"), "item", "p2").distinct()), "term_id")
    second = second.select("doc_id", "text_hash", "item", (F.col("pos") - F.col("p2")).alias("place"), "p2")
    # A null id is spelt out, so that the lists meet by hash.
    keyed = lambda df: df.withColumns({"id": F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "none": F.col("doc_id").isNull()})
    both = keyed(first).join(keyed(second).drop("doc_id"), ["id", "none", "text_hash", "item", "place", "p2"], "left_semi")
    places = both.drop("id", "none").unionByName(first.where("p2 is null"))
    met = places.join(_checked(windows.select("item", "item_id", "p1", F.col("p2").alias("with"), "first", "phrase")), ["item", "p1"]).where(F.col("p2").eqNullSafe(F.col("with")))
    begin = F.col("back") - (F.col("p1") - F.col("first"))  # of the window within the words that the posting holds
    met = met.where((begin >= 0) & (F.slice("near", F.greatest(begin, F.lit(0)) + 1, F.size("phrase")) == F.col("phrase")))
    start = F.col("place") + F.col("first")
    met = met.select("doc_id", "text_hash", "item", "item_id", F.sequence(start, start + F.size("phrase") - 1).alias("run"))
    return met.groupBy("doc_id", "text_hash", "item", "item_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("run")))).alias("positions"))


def phrase_hits(docs: DataFrame, items: DataFrame, *, window: int = 10) -> DataFrame:
    """Exact occurrences of item windows: rows (doc_id, text_hash, item, item_id, positions), positions being the document's words within any.

    Null texts, and items without words, have none; an item of fewer words than `window` is one window. Repeated rows of a
    document give one row; equal items under different ids give one row each, and so do different items under one id or without an id. Empty tables give no rows.
    """
    windows, _, index = _lookups(docs, items, window)
    return _phrases(index, windows)


def _near(index: DataFrame, pairs: DataFrame, distance: int) -> DataFrame:
    """Rows (doc_id, text_hash, pair_id, n) from the lists of the pairs' terms."""
    slot = F.floor(F.col("pos") / distance).cast("int")
    left = index.join(_checked(pairs.withColumnRenamed("first", "term_id")), "term_id").select("doc_id", "text_hash", "pair_id", "second", F.col("pos").alias("at"), F.explode(F.array(*[slot + k for k in (-1, 0, 1)])).alias("slot"))
    right = index.join(_checked(pairs.select(F.col("second").alias("term_id")).distinct()), "term_id").select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), F.col("term_id").alias("t"), F.col("pos").alias("to"), slot.alias("s"))
    near = left.join(right, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")) & (F.col("second") == F.col("t")) & (F.col("slot") == F.col("s")))
    near = near.where((F.abs(F.col("at") - F.col("to")) <= distance) & (F.col("at") != F.col("to")))
    return near.select("doc_id", "text_hash", "pair_id", "at").distinct().groupBy("doc_id", "text_hash", "pair_id").agg(F.count("*").alias("n"))


def proximity_hits(docs: DataFrame, pairs: DataFrame, *, distance: int = 10) -> DataFrame:
    """Documents where both terms of a pair lie within `distance` words: rows (doc_id, text_hash, pair_id, n), n counting such places of the first term.

    `pairs` has (pair_id, first, second), words in lower case. The lists of both terms meet by document and slot of `distance` words. Nulls never match;
    a term isn't near itself at the same position.
    """
    pairs = pairs.where("first is not null and second is not null").select("pair_id", F.xxhash64("first").alias("first"), F.xxhash64("second").alias("second"))
    terms = pairs.select(F.explode(F.array("first", "second")).alias("term_id")).distinct().withColumn("lead", F.lit(False))
    return _near(build_index(docs, terms, shared_folder(docs.sparkSession, "postings")), pairs, distance)


def decontaminate(docs: DataFrame, items: DataFrame, *, window: int = 10, distance: int = 10) -> DataFrame:
    """Rows (doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_near), one for each row of `docs`.

    n_hit counts words within any occurrence of an item's window, n_items the items with such windows (those without an id as one); items_sha256 is the digest
    of their ids, sorted as texts and comma-joined (of the empty text if there are none). n_near counts, over all items, the places of an item's
    rarest term with its second rarest within `distance` words. Null and empty texts have no words. Other columns are ignored.
    """
    windows, pairs, index = _lookups(docs, items, window)
    hits = _phrases(index, windows).groupBy("doc_id", "text_hash").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("positions")))).cast("long").alias("n_hit"),
        F.countDistinct(F.coalesce(F.col("item_id").cast("string"), F.lit(""))).alias("n_items"),
        F.array_join(F.array_sort(F.collect_set(F.col("item_id").cast("string"))), ",").alias("items"),
    )
    close = _near(index, pairs, distance).groupBy("doc_id", "text_hash").agg(F.sum("n").alias("n_near"))
    found = hits.join(close.toDF("d", "h", "n_near"), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")), "full")
    found = found.select(F.coalesce("doc_id", "d").alias("doc_id"), F.coalesce("text_hash", "h").alias("text_hash"), "n_hit", "n_items", "items", "n_near")
    _, _, n = _cut(F.coalesce("text", F.lit("")), _GAPS_ANY_CASE)
    base = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"), n.cast("long").alias("n_words"))
    out = base.join(found, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("text_hash")), "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select(F.col("id").alias("doc_id"), "n_words", zero("n_hit"), zero("n_items"), F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"), zero("n_near"))


#: The same result in DuckDB's SQL, by comparing all windows and all places of the pairs.
DECONTAM_SQL = """
with dw as (select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from documents),
bw as (select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from benchmark),
bs as (select distinct item_id, least(len(w), 10) as n, array_to_string(w[i + 1 : i + least(len(w), 10)], ' ') as k from (select item_id, w, unnest(range(0, greatest(1, len(w) - 9))) as i from bw where len(w) > 0)),
sizes as (select distinct n from bs),
ds as (select doc_id, n, i, array_to_string(w[i + 1 : i + n], ' ') as k from (select doc_id, w, n, unnest(range(0, greatest(0, len(w) - n + 1))) as i from dw, sizes)),
hit as (select doc_id, item_id, ds.n, i from ds join bs on ds.k = bs.k and ds.n = bs.n),
pos as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + n)) as p from hit) group by doc_id),
its as (select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as items from (select distinct doc_id, item_id::varchar as item_id from hit) group by doc_id),
dp as (select doc_id, unnest(w) as word, unnest(range(len(w))) as p from dw),
bt as (select distinct item_id, unnest(w) as word from bw),
cnt as (select word, count(*) as c from dp group by word),
rk as (select item_id, bt.word, row_number() over (partition by item_id order by coalesce(c, 0), bt.word) as r from bt left join cnt on cnt.word = bt.word),
pr as (select a.item_id, a.word as first, b.word as second from rk a join rk b on a.item_id = b.item_id where a.r = 1 and b.r = 2),
nr as (select doc_id, count(*) as n_near from (select distinct x.doc_id, item_id, x.p from pr join dp x on x.word = first join dp y on y.word = second and x.doc_id = y.doc_id and abs(x.p - y.p) <= 10) group by doc_id)
select d.doc_id, coalesce(len(w), 0)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated, coalesce(n_near, 0)::bigint as n_near
from dw d left join pos on pos.doc_id = d.doc_id left join its on its.doc_id = d.doc_id left join nr on nr.doc_id = d.doc_id
"""
