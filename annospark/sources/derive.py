"""Annotation tables derived from a table of timestamped events.

Time is whole milliseconds from the start of a recording; seconds are derived where they are shown.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Speaker labels: female, male, key child, other child.
LABELS = ("FEM", "MAL", "KCHI", "OCH")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_id", "user_id as uid", "event_type", "value",
        "timestampdiff(MICROSECOND, timestamp_ntz'2024-01-01 00:00:00', ts) div 600000 as onset_ms",
    )


def vtc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Speaker-labelled segments: uid, onset_ms, offset_ms, label. Empty segments are left out."""
    label = "case event_type when 'view' then 'FEM' when 'purchase' then 'MAL' when 'click' then 'KCHI' when 'signup' then 'OCH' end as label"
    return _events(spark, sf_dir).where("event_type <> 'error'").selectExpr("uid", "onset_ms", "onset_ms + cast(floor(value*200) as bigint) as offset_ms", label).where("offset_ms > onset_ms")


def vad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unlabelled speech segments: uid, onset_ms, offset_ms, at least 1 ms long."""
    rows = _events(spark, sf_dir).where("event_id % 5 <> 0").selectExpr("uid", "onset_ms + (event_id % 7)*100 as onset_ms", "onset_ms + cast(floor(value*200) as bigint) + (event_id % 3)*150 as offset_ms")
    return rows.withColumn("offset_ms", F.greatest("offset_ms", F.col("onset_ms") + 1))


def durations(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    """Length of each recording: 10 s beyond its last annotation. Dealt, recordings lie in as many tasks as a shuffle has, by uid, for what makes long rows, or many, of each.

    Spark would put lengths of so few bytes into one task, and all that is made of them. A shuffle by a stated number of tasks before the grouping is the one it keeps.
    """
    both = vtc(spark, sf_dir).select("uid", "offset_ms").unionByName(vad(spark, sf_dir).select("uid", "offset_ms"))
    if dealt:
        both = both.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "uid")
    return both.groupBy("uid").agg((F.max("offset_ms") + 10_000).alias("dur_ms"))


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a second: uid, i, snr, c50 (dB) and vad (probability of speech). Grouped by uid, they needn't be shuffled."""
    return durations(spark, sf_dir, dealt=True).selectExpr("uid", "explode(sequence(0L, dur_ms div 1000 - 1)) as i").selectExpr(
        "uid", "i", "((uid*7919 + i*104729) % 4000)/100D - 5D as snr", "((uid*6007 + i*15485863) % 6000)/100D as c50", "((uid*31 + i*17) % 1000)/1000D as vad"
    )


def frame_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same frames as they are stored, one row a recording: uid, snr, c50 and vad as arrays of doubles, by i."""
    value = {"snr": "((uid*7919 + i*104729) % 4000)/100D - 5D", "c50": "((uid*6007 + i*15485863) % 6000)/100D", "vad": "((uid*31 + i*17) % 1000)/1000D"}
    rows = durations(spark, sf_dir, dealt=True)
    return rows.selectExpr("uid", *[f"transform(sequence(0L, dur_ms div 1000 - 1), i -> {v}) as {c}" for c, v in value.items()])


def windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class probabilities by window: uid, bin, class_idx, prob."""
    rows = table(spark, sf_dir, "embeddings").selectExpr("label as uid", "cast(row_number() over (partition by label order by vec_id) - 1 as bigint) as bin", "embedding")
    return rows.selectExpr("uid", "bin", "posexplode(embedding) as (class_idx, x)").selectExpr("uid", "bin", "class_idx", "abs(cast(x as double)) as prob")


#: The same tables as common table expressions of DuckDB's SQL.
SQL = """
with ev as (select event_id, user_id as uid, event_type, value, (epoch_us(ts) - 1704067200000000) // 600000 as onset_ms from events),
vtc as (select * from (select uid, onset_ms, onset_ms + cast(floor(value*200) as bigint) as offset_ms,
  case event_type when 'view' then 'FEM' when 'purchase' then 'MAL' when 'click' then 'KCHI' when 'signup' then 'OCH' end as label from ev where event_type <> 'error') where offset_ms > onset_ms),
vad as (select uid, onset_ms, greatest(offset_ms, onset_ms + 1) as offset_ms from (select uid, onset_ms + (event_id % 7)*100 as onset_ms,
  onset_ms + cast(floor(value*200) as bigint) + (event_id % 3)*150 as offset_ms from ev where event_id % 5 <> 0)),
dur as (select uid, max(offset_ms) + 10000 as dur_ms from (select uid, offset_ms from vtc union all select uid, offset_ms from vad) group by uid)"""
FRAMES_SQL = """,
frames as (select uid, i, ((uid*7919 + i*104729) % 4000)/100.0::double - 5 as snr, ((uid*6007 + i*15485863) % 6000)/100.0::double as c50, ((uid*31 + i*17) % 1000)/1000.0::double as vad
  from (select uid, unnest(range(0, dur_ms // 1000)) as i from dur))"""
WINDOWS_SQL = """
with win as (select uid, bin, unnest(range(0, len(embedding)))::int as class_idx, abs(unnest(embedding)::double) as prob
  from (select label as uid, row_number() over (partition by label order by vec_id) - 1 as bin, embedding from embeddings))"""
