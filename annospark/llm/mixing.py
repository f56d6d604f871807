"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document gets the key -ln(u)/w: u is a hash of its id and the seed, w its quality weight. Documents
of a source, in ascending key order, are a weighted random permutation; the running sum of their sizes up
to the source's budget is the sample. A source whose target exceeds its size is first taken in whole,
once for each complete epoch; only the rest is sampled.

The running sum never needs a whole source in one task: keys fall into ranges that are summed on their own,
a table of (source, range) sums gives each range its start, and rows are summed within a range only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str = "text") -> Column:
    """Number of words in the text; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, max_epochs: float = 2.0) -> DataFrame:
    """Words that each source shall give: rows (source, source_size, target).

    `sizes` has a row (source, source_size) for each source; weights go to the sources by code point, null
    last, over and over. Targets share `share` times all sizes by weight; none exceeds `max_epochs` times its
    source's size, and what is cut off is shared again among the others. That fixed point is found at once:
    in the order of cap/weight the capped sources come first, and the first uncapped one gives the level.
    Ties share one level, an empty table gives an empty table, and sources without words get 0.
    This is a table of one row for each source, so one task orders it.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.array(*[F.lit(float(x)) for x in weights])
    t = (
        sizes.withColumn("weight", F.element_at(w, F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1))
        .withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
    )
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(whole) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))) / F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    t = t.withColumn("level", level)
    t = t.withColumn("at", F.min(F.when(F.col("level") <= F.col("ratio"), F.col("ratio"))).over(whole))
    t = t.withColumn("at", F.min(F.when(F.col("ratio") == F.col("at"), F.col("level"))).over(whole))
    target = F.when(F.col("at").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("at") * F.col("weight")))
    return t.select("source", "source_size", target.cast("double").alias("target"))


def mix(docs: DataFrame, *, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, max_epochs: int = 2, size: Column | None = None, quality: Column | None = None, seed: int = 17, ranges: int | None = None, row_key: Sequence[str] = ()) -> DataFrame:
    """How many words of each document the mix takes: rows (doc_id, *row_key, size, source_size, target, taken, epochs, part).

    `docs` needs doc_id, source and text; give `size` where the words are counted already, so that a join before needn't
    move texts. Other columns are ignored. `quality` is the positive weight of a row (default 1;
    null or not positive counts as 1). epochs is how often the whole document is taken, part the words that the
    fractional selection adds: its whole size, or what the budget still had for the one document that
    crosses it, so that a source's words add up to its target rounded to a word.
    Null or empty texts have size 0 and give nothing. Null sources are a source of their own. Repeated rows
    are separate documents. Equal keys are ordered by doc_id, size and `row_key`, columns that tell rows of one id apart and
    stand for the id in the hash where that is null. An empty table gives an empty table. `ranges` of keys are summed on their own (default: one for
    each 100,000 rows, 512 at least); their number doesn't change the result.
    """
    ranges = ranges or max(512, -(-docs.count() // 100_000))
    name = F.coalesce(F.col("doc_id").cast("string"), *([F.concat_ws(":", *[F.col(c).cast("string") for c in row_key])] if row_key else []))
    u = (F.conv(F.substring(F.md5(F.concat_ws(":", name, F.lit(str(seed)))), 1, 12), 16, 10).cast("double") + 1) / F.lit(float(2**48 + 1))
    weight = F.lit(1.0) if quality is None else F.when(quality > 0, quality.cast("double")).otherwise(F.lit(1.0))
    rows = docs.select("doc_id", *row_key, "source", (word_count() if size is None else size).alias("size"), (-F.log(u) / weight).alias("key"))
    # 1 - exp(-key) is monotone in the key and close to uniform, so ranges hold about as many rows each.
    rows = rows.select("doc_id", *row_key, "size", "key", F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("src"), F.floor((1 - F.exp(-F.col("key"))) * ranges).cast("int").alias("slot"))
    sums = rows.groupBy("none", "src", "slot").agg(F.sum("size").alias("slot_size"))
    targets = source_targets(sums.groupBy("none", "src").agg(F.sum("slot_size").alias("source_size")).select(F.when(~F.col("none"), F.col("src")).alias("source"), "source_size"), weights, share, max_epochs)
    targets = targets.select(F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("src"), "source_size", "target")
    before = F.sum("slot_size").over(Window.partitionBy("none", "src").orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)) - F.col("slot_size")
    starts = sums.withColumn("slot_start", before).join(targets, ["none", "src"]).drop("slot_size")
    order = Window.partitionBy("none", "src", "slot").orderBy("key", "doc_id", "size", *row_key).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.join(starts, ["none", "src", "slot"]).withColumn("ahead", F.col("slot_start") + F.sum("size").over(order) - F.col("size"))
    epochs = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(max_epochs))).otherwise(F.lit(0)).cast("long")
    rows = rows.withColumn("epochs", epochs)
    budget = F.floor(F.col("target") - F.col("epochs") * F.col("source_size") + 0.5)
    part = F.when(F.col("epochs") >= max_epochs, F.lit(0)).otherwise(F.greatest(F.lit(0), F.least(F.col("size"), budget - F.col("ahead")))).cast("long")
    rows = rows.withColumn("part", part)
    return rows.select("doc_id", *row_key, "size", "source_size", "target", (F.col("epochs") * F.col("size") + F.col("part")).alias("taken"), "epochs", "part")


def quality_weight(labels: DataFrame) -> DataFrame:
    """One weight for each labelled doc_id: 2 for good, 0.5 for bad documents (the best label counts); null labels or ids are left out."""
    return labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.when(F.max("quality") > 0, F.lit(2.0)).otherwise(F.lit(0.5)).alias("quality_weight"))


#: The same mix in DuckDB's SQL.
MIX_SQL = """
with q as (select doc_id, case when max(quality) > 0 then 2.0::double else 0.5::double end as qw from labels where quality is not null group by doc_id),
d as (select d.doc_id, d.source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint as size,
  -ln((('0x' || substr(md5(d.doc_id::varchar || ':17'), 1, 12))::bigint::double + 1) / 281474976710657.0::double) / coalesce(qw, 1.0::double) as key
  from documents d left join q using (doc_id)),
s as (select source, sum(size)::double as source_size from d group by source),
w as (select *, [3.0::double, 1.0::double, 2.0::double][(((row_number() over (order by source nulls last)) - 1) % 3 + 1)::int] as weight, source_size * 2 as cap from s),
l as (select *, cap / weight as ratio from w),
v as (select *, (sum(source_size) over () * 1.5::double - coalesce(sum(cap) over (order by ratio, source nulls last rows between unbounded preceding and 1 preceding), 0))
  / sum(weight) over (order by ratio, source nulls last rows between current row and unbounded following) as level from l),
a as (select *, min(case when level <= ratio then ratio end) over () as first_ratio from v),
b as (select *, min(case when ratio = first_ratio then level end) over () as at_level from a),
t as (select source, source_size::bigint as source_size, case when at_level is null then cap else least(cap, at_level * weight) end as target from b),
r as (select d.doc_id, d.size, t.source_size, t.target,
  case when t.source_size > 0 then least(floor(t.target / t.source_size), 2) else 0 end::bigint as epochs,
  sum(d.size) over (partition by d.source order by key, d.doc_id, d.size rows between unbounded preceding and current row) - d.size as ahead
  from d join t on d.source is not distinct from t.source),
p as (select *, case when epochs >= 2 then 0 else greatest(0, least(size, floor(target - epochs * source_size + 0.5) - ahead)) end::bigint as part from r)
select doc_id, size, source_size, target, epochs * size + part as taken, epochs, part from p
"""
