"""Exact quantiles and exact samples of k rows by radix selection: only what lies next to a cut is ordered."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annospark.functions.columns import seeded

#: Rows of a bucket that one task ranks when a sample is cut within it.
CUT_ROWS = 100_000


def order_statistics(rows: DataFrame, keys: Sequence[str], value: str, ranks: Column) -> DataFrame:
    """For each key the values at some ranks: keys, _rank (as given, its field `at` counts from 0), _value.

    `ranks` makes an array of structs with a field `at` out of a key's number of values `_n`. Nulls and NaN don't count. Equal values are counted first, so ties take one row;
    then ranges of (key, value) are summed, and only the ranges that hold a rank are ordered, each on its own. Needs a checkpoint folder.
    """
    k = F.struct(*keys).alias("_k") if keys else F.struct(F.lit(0).alias("all")).alias("_k")
    x = rows.select(k, F.col(value).alias("_v")).where(F.col("_v").isNotNull())
    if dict(rows.dtypes)[value] in ("double", "float"):
        x = x.where(~F.isnan("_v"))
    # Written once: Spark would draw the bounds of ranges anew each time.
    ranged = x.groupBy("_k", "_v").agg(F.count("*").alias("_c")).repartitionByRange("_k", "_v").withColumn("_range", F.spark_partition_id()).checkpoint()
    sums = ranged.groupBy("_k", "_range").agg(F.sum("_c").alias("_m"))
    by_key = Window.partitionBy("_k")
    sums = sums.withColumns({"_n": F.sum("_m").over(by_key), "_before": F.sum("_m").over(by_key.orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_m")})
    wanted = sums.withColumn("_rank", F.explode(ranks)).where((F.col("_rank.at") >= F.col("_before")) & (F.col("_rank.at") < F.col("_before") + F.col("_m")))
    here = ranged.join(wanted.select("_k", "_range").distinct(), ["_k", "_range"], "left_semi")
    end = F.sum("_c").over(Window.partitionBy("_k", "_range").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    found = here.withColumn("_end", end).join(wanted.select("_k", "_range", "_before", "_rank"), ["_k", "_range"])
    at = F.col("_rank.at") - F.col("_before")
    return found.where((at >= F.col("_end") - F.col("_c")) & (at < F.col("_end"))).select(*[F.col("_k")[c].alias(c) for c in keys], "_rank", F.col("_v").alias("_value"))


def quantiles(rows: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Exact quantiles by key, interpolated between the two nearest values as `percentile` does: keys and a column of doubles for each name of `probs`.

    Keys without values have no row; without keys there is one row, of nulls where there are no values. No task holds more than a range of a key's distinct values, whatever a key's size.
    """

    def rank(name: str, p: float, up: bool) -> Column:
        at = (F.col("_n") - 1) * F.lit(float(p))
        return F.struct(F.lit(name).alias("name"), F.lit(up).alias("up"), (F.ceil(at) if up else F.floor(at)).alias("at"), at.alias("pos"))

    found = order_statistics(rows, keys, value, F.array(*[rank(n, p, up) for n, p in probs.items() for up in (False, True)]))

    def one(name: str) -> Column:
        mine = F.col("_rank.name") == name
        low, high = (F.max(F.when(mine & (F.col("_rank.up") == up), F.col("_value"))).cast("double") for up in (False, True))
        at, floor, ceil = (F.max(F.when(mine, x)) for x in (F.col("_rank.pos"), F.floor("_rank.pos"), F.ceil("_rank.pos")))
        return F.when(floor == ceil, low).otherwise((ceil - at) * low + (at - floor) * high).alias(name)

    return found.groupBy(*keys).agg(*[one(n) for n in probs])


def upper_median(rows: DataFrame, value: str, key: str) -> DataFrame:
    """The element in the upper middle of each key's values; nulls don't count."""
    return order_statistics(rows, [key], value, F.array(F.struct(F.floor(F.col("_n") / 2).alias("at")))).select(key, F.col("_value").alias(value))


def k_of_n(rows: DataFrame, k: int, key: str, seed: int = 42) -> DataFrame:
    """Exactly k rows (all, if there are fewer): those that come first by a seeded hash of the key, so the choice is fixed whatever the partitions; not in that order.

    Counts by the first digits of the hash tell in which bucket the cut falls, then by more digits within it, until the bucket is small; only that one is ranked. At most 4,096 counts reach
    the driver at a time. Rows of one key have one hash: of these, and of null keys, which come last, those with smaller hashes of the whole row are taken.
    """
    x = rows.withColumn("_h", F.when(F.col(key).isNull(), "~").otherwise(seeded(F.col(key), seed)))
    if k <= 0:
        return rows.limit(0)
    prefix, left = "", k
    while True:
        digits = len(prefix) + 3
        counts = sorted(x.where(F.startswith("_h", F.lit(prefix))).groupBy(F.substring("_h", 1, digits).alias("p")).count().collect())
        for p, n in counts:
            if left < n:
                prefix, last = p, n
                break
            left -= n
        else:
            # Only at the first digits: there are no more than k rows.
            return rows
        if last <= CUT_ROWS or len(prefix) < digits or digits >= 30:
            break
    cut = F.substring("_h", 1, len(prefix))
    below = x.where(cut < prefix)
    if not left:
        return below.drop("_h")
    order = Window.partitionBy(F.lit(1)).orderBy("_h", F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]))
    within = x.where(cut == prefix).withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= left).drop("_place")
    return below.unionByName(within).drop("_h")
