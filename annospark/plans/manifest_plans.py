"""Registered queries: manifests, sampling, exploration, sample arrays."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from annospark.functions import columns as C
from annospark.operators import explore, intervals, manifest, samples, selection, sessions, stats, tiling
from annospark.sources import derive
from annospark.sources.derive import FRAMES_SQL, SQL, WINDOWS_SQL, table

from .agreement_plans import TRANS, TURNS, islands
from .stats_plans import _FULL, CLIPS, _cstat, _fixed, _seg

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def _add(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return put


# Manifests made of the pages' urls and of the annotations.
_PATHS = "pg as (select page_id, case when page_id % 11 = 0 then null when page_id % 3 = 0 then substr(url, 2) else url || '.wav' end as path from pages)"


def _pages(s, d):
    return table(s, d, "pages").selectExpr("page_id", "case when page_id % 11 = 0 then null when page_id % 3 = 0 then substr(url, 2) else url || '.wav' end as path")


_add("b01_normalize", f"with {_PATHS} select case when path like '/%' then path else '/data/' || path end as path, page_id, case when path like '/%' then null else path end as path_legacy, regexp_extract(path, '([^/]+?)(\\.[^./]*)?$', 1) as uid from pg where path is not null")(
    lambda s, d: manifest.normalize(_pages(s, d), "/data/")
)
_add("b02_stem", f"with {_PATHS} select page_id, regexp_extract(path, '([^/]+?)(\\.[^./]*)?$', 1) as stem, regexp_replace(path, '\\.wav$', '') as bare from pg where path is not null")(
    lambda s, d: _pages(s, d).where("path is not null").select("page_id", C.stem(F.col("path")).alias("stem"), C.without_suffix(F.col("path")).alias("bare"))
)
_add("a03_duplicate_ids", "select user_id::varchar as uid, count(*) as n from events group by user_id having count(*) > 1")(lambda s, d: manifest.duplicate_ids(table(s, d, "events").select(F.col("user_id").cast("string").alias("uid"))))
_add("b09_contract", "select user_id::varchar as wav_id, count(*) as n from events group by user_id")(lambda s, d: manifest.contract(table(s, d, "events").groupBy(F.col("user_id").alias("wav_id")).agg(F.count("*").alias("n"))))
_add("b08_manifest_ops", "select distinct user_id::varchar as wav_id from events where value > 10 order by 1")(lambda s, d: manifest.unique_ids(manifest.contract(manifest.select_columns(manifest.rename_columns(table(s, d, "events").where("value > 10").withColumnRenamed("user_id", "wav_id"), {"value": "v"}), ["v"]))))
_SOURCES = SQL + """,
mv as (select uid::varchar as wav_id, count(*) as n, sum(offset_ms - onset_ms)::bigint as duration from vad where uid % 10 <> 1 group by uid),
mt as (select uid::varchar as wav_id, count(*) as vtc_n_segments, sum(offset_ms - onset_ms)::bigint as duration, '{' || string_agg(distinct '\"' || label || '\":1', ',' order by '\"' || label || '\":1') || '}' as vtc_label_counts from vtc where uid % 10 <> 2 group by uid),
ms as (select uid::varchar as wav_id, dur_ms as duration, ((uid * 7919) % 400) / 10.0::double - 5 as snr_mean, ((uid * 31) % 100) / 100.0::double as speech_ratio from dur where uid % 10 <> 3),
me as (select uid::varchar as wav_id, 'cat' || (uid % 5) as dominant_category, ((uid * 17) % 100) / 100.0::double as dominant_prob, ((uid * 6007) % 600) / 10.0::double as c50_mean from dur where uid % 10 <> 4)"""


def _stages(s, d):
    vad, vtc, dur = derive.vad(s, d), derive.vtc(s, d), derive.durations(s, d)
    _length, _id = F.sum(F.col("offset_ms") - F.col("onset_ms")), F.col("uid").cast("string").alias("wav_id")
    label_counts = F.to_json(F.map_from_arrays(F.array_sort(F.collect_set("label")), F.transform(F.array_sort(F.collect_set("label")), lambda _: F.lit(1))))
    return {
        "vad": vad.where("uid % 10 <> 1").groupBy("uid").agg(F.count("*").alias("n"), _length.alias("duration")).select(_id, "n", "duration"),
        "vtc": vtc.where("uid % 10 <> 2").groupBy("uid").agg(F.count("*").alias("vtc_n_segments"), _length.alias("duration"), label_counts.alias("vtc_label_counts")).select(_id, "vtc_n_segments", "duration", "vtc_label_counts"),
        "snr": dur.where("uid % 10 <> 3").select(_id, F.col("dur_ms").alias("duration"), F.expr("((uid * 7919) % 400) / 10D - 5D as snr_mean"), F.expr("((uid * 31) % 100) / 100D as speech_ratio")),
        "esc": dur.where("uid % 10 <> 4").select(_id, F.expr("concat('cat', uid % 5) as dominant_category"), F.expr("((uid * 17) % 100) / 100D as dominant_prob"), F.expr("((uid * 6007) % 600) / 10D as c50_mean")),
    }


_COLS = "wav_id, n, mv.duration, vtc_n_segments, mt.duration as duration_vtc, vtc_label_counts, ms.duration as duration_snr, snr_mean, speech_ratio, dominant_category, dominant_prob, c50_mean"
for _how, _sql in (("inner", "join"), ("left", "left join"), ("outer", "full join")):
    _add(f"c01_big_join_{_how}", _SOURCES + f" select {_COLS} from mv {_sql} mt using (wav_id) {_sql} ms using (wav_id) {_sql} me using (wav_id)")(lambda s, d, how=_how: manifest.big_join(list(_stages(s, d).items()), how))
_FILTERS = manifest.Filters(min_duration=10_000, max_speech_ratio=0.95, min_snr_db=0.0, max_snr_db=30.0, max_c50_db=55.0, min_vtc_segments=5, required_labels=("KCHI", "OCH"), excluded_categories=("cat3",), max_dominant_prob=0.9)
_WHERE = "duration >= 10000 and speech_ratio <= 0.95 and snr_mean between 0 and 30 and c50_mean <= 55 and vtc_n_segments >= 5 and (contains(vtc_label_counts, '\"KCHI\"') or contains(vtc_label_counts, '\"OCH\"')) and dominant_category <> 'cat3' and dominant_prob <= 0.9"
_BUILT = _SOURCES + f", jn as (select {_COLS} from mv join mt using (wav_id) join ms using (wav_id) join me using (wav_id)), ok as (select * from jn where {_WHERE})"


def _built(s, d):
    return manifest.build_manifest(_stages(s, d), _FILTERS, "inner")


_add("c02_build_manifest", _BUILT + " select * from ok")(_built)
_add("b03_filters", _BUILT + " select wav_id, snr_mean from jn where snr_mean >= 5 and duration <= 600000")(lambda s, d: manifest.Filters(min_snr_db=5.0, max_duration=600_000, required_labels=()).apply(manifest.big_join(list(_stages(s, d).items()))).select("wav_id", "snr_mean"))
_add("b04_bounds", _BUILT + " select wav_id, speech_ratio, snr_mean, c50_mean from jn where speech_ratio between 0.2 and 0.8 and snr_mean between 5 and 30 and c50_mean between 10 and 50")(
    lambda s, d: manifest.Filters(min_speech_ratio=0.2, max_speech_ratio=0.8, min_snr_db=5.0, max_snr_db=30.0, min_c50_db=10.0, max_c50_db=50.0).apply(manifest.big_join(list(_stages(s, d).items()))).select("wav_id", "speech_ratio", "snr_mean", "c50_mean")
)
_add("b05_label_filter", _BUILT + " select wav_id, vtc_n_segments from jn where vtc_n_segments >= 50 and (contains(vtc_label_counts, '\"KCHI\"'))")(lambda s, d: manifest.Filters(min_vtc_segments=50, required_labels=("KCHI",)).apply(manifest.big_join(list(_stages(s, d).items()))).select("wav_id", "vtc_n_segments"))
_add("b06_category_filter", _BUILT + " select wav_id, dominant_category, dominant_prob from jn where dominant_category not in ('cat1', 'cat3') and dominant_prob <= 0.7")(lambda s, d: manifest.Filters(excluded_categories=("cat1", "cat3"), max_dominant_prob=0.7).apply(manifest.big_join(list(_stages(s, d).items()))).select("wav_id", "dominant_category", "dominant_prob"))
_add("c13_semi_join", _BUILT + " select uid, onset_ms, label from vtc where uid::varchar in (select wav_id from ok)")(lambda s, d: manifest.keep_allowed(derive.vtc(s, d).withColumn("wav_id", F.col("uid").cast("string")), _built(s, d)).select("uid", "onset_ms", "label"))
_add("c16_duration_lookup", SQL + ", r as (select distinct user_id as uid from events), h as (select * from dur where uid % 7 <> 0) select uid, dur_ms, 'found' as kind from r join h using (uid) union all select uid, null, 'missing' from r where uid not in (select uid from h)")(
    lambda s, d: (lambda found, missing: found.withColumn("kind", F.lit("found")).unionByName(missing.withColumns({"dur_ms": F.lit(None).cast("long"), "kind": F.lit("missing")})))(*manifest.with_duration(table(s, d, "events").select(F.col("user_id").alias("uid")).distinct(), derive.durations(s, d).where("uid % 7 <> 0")))
)
_add("c17_last_path", "select user_id as uid, arg_max(event_type || '/' || event_id, event_id) as path from events group by user_id")(lambda s, d: manifest.last_path(table(s, d, "events").selectExpr("user_id as uid", "event_id", "concat(event_type, '/', event_id) as path"), "event_id"))
_add("a19_remaining", "select event_id, user_id as uid from events where user_id not in (select user_id from events where value > 450)")(lambda s, d: manifest.remaining(table(s, d, "events").selectExpr("event_id", "user_id as uid"), table(s, d, "events").where("value > 450").selectExpr("user_id as uid")).select("event_id", "uid"))
_add("a20_upsert", "with o as (select user_id as uid, max(event_id) as run from events where event_id % 2 = 0 group by 1), n as (select user_id as uid, max(event_id) as run from events where event_id % 3 = 0 and user_id % 4 = 0 group by 1) select * from n union all select * from o where uid not in (select uid from n)")(
    lambda s, d: manifest.upsert(*[table(s, d, "events").where(c).groupBy(F.col("user_id").alias("uid")).agg(F.max("event_id").alias("run")) for c in ("event_id % 2 = 0", "event_id % 3 = 0 and user_id % 4 = 0")], order="run")
)
_add("a10_merge_stores", _SOURCES + ' select wav_id, n as "vad.n", mv.duration as "vad.duration", vtc_n_segments as "vtc.vtc_n_segments" from mv join mt using (wav_id)')(lambda s, d: manifest.merge_stores([("vad", _stages(s, d)["vad"]), ("vtc", _stages(s, d)["vtc"].select("wav_id", "vtc_n_segments"))]))
_add("g05_available_ids", _SOURCES + " select wav_id, 'any' as kind from (select wav_id from mv union select wav_id from mt) union all select wav_id, 'all' from (select wav_id from mv intersect select wav_id from mt)")(
    lambda s, d: (lambda st: manifest.all_ids([st["vad"], st["vtc"]]).withColumn("kind", F.lit("any")).unionByName(manifest.all_ids([st["vad"], st["vtc"]], True).withColumn("kind", F.lit("all"))))(_stages(s, d))
)
_add("g01_vertical_concat", SQL + " select uid, onset_ms, offset_ms from vtc union all select uid, onset_ms, offset_ms from vad")(lambda s, d: derive.vtc(s, d).select("uid", "onset_ms", "offset_ms").unionByName(derive.vad(s, d)))
_add("g02_diagonal_concat", SQL + " select uid, onset_ms, offset_ms, label from vtc union all select uid, onset_ms, offset_ms, null from vad")(lambda s, d: derive.vtc(s, d).unionByName(derive.vad(s, d), allowMissingColumns=True))
_add("g03_keep_last", "select user_id, event_id, event_type from (select *, row_number() over (partition by user_id order by event_id desc) as rn from events) where rn = 1")(lambda s, d: manifest.keep_last(table(s, d, "events").select("user_id", "event_id", "event_type"), "user_id", "event_id"))
_add("g04_full_distinct", "select distinct user_id, event_type from events")(lambda s, d: table(s, d, "events").select("user_id", "event_type").distinct())
_add("g06_except", "select user_id from (select distinct user_id from events except select user_id from events where event_type = 'error' and value > 400)")(lambda s, d: manifest.remaining(table(s, d, "events").select(F.col("user_id").alias("uid")).distinct(), table(s, d, "events").where("event_type = 'error' and value > 400").select(F.col("user_id").alias("uid"))).select(F.col("uid").alias("user_id")))
_add("f06_multi_key_sort", SQL + " select uid, label, onset_ms from vtc order by uid, label, onset_ms")(lambda s, d: derive.vtc(s, d).select("uid", "label", "onset_ms").orderBy("uid", "label", "onset_ms"))
_add("a15_adapters", _SOURCES + " select wav_id, snr_mean, 'snr' as source from ms where snr_mean > 0")(lambda s, d: manifest.contract(_stages(s, d)["snr"].where("snr_mean > 0").select("wav_id", "snr_mean").withColumn("source", F.lit("snr"))))

# Sampling and exploration.
def _adapted(s, d):
    """Metadata of four sources with their own id and status columns, all told by the annotations; array files are there for recordings with a segment of over 25 s."""
    uid, length = F.col("uid").cast("string"), F.col("offset_ms") - F.col("onset_ms")
    vad = derive.vad(s, d).groupBy("uid").agg(F.count("*").alias("n"), F.sum(length).alias("ms")).select(uid.alias("file_id"), "n", (F.col("ms") > 450_000).alias("success"))
    per = derive.vtc(s, d).groupBy("uid").agg(F.count("*").alias("n"), F.sum((F.col("label") == "KCHI").cast("int")).alias("child"), F.max(length).alias("longest"))
    vtc = per.select(uid.alias("uid"), "n", F.when(F.col("child") < 10, "too few of the child").otherwise("").alias("error"))
    snr = derive.durations(s, d).select(uid.alias("uid"), F.col("dur_ms").alias("n"), F.when(F.col("dur_ms") <= 4_200_000, "too short").otherwise("ok").alias("snr_status"))
    esc = derive.durations(s, d).join(per, "uid", "left").select(uid.alias("uid"), F.col("dur_ms").alias("n"), F.when(F.col("n") >= 50, "ok").alias("esc_status"))
    files = per.where("longest > 25000").select(uid.alias("uid"))
    out = []
    for source, meta in (("vad", vad), ("vtc", vtc), ("snr", snr), ("esc", esc)):
        adapter = manifest.ADAPTERS[source]
        out.append(adapter.as_manifest(meta).join(adapter.list_ids(meta), "wav_id").join(adapter.existing(meta, files).withColumn("there", F.lit(True)), "wav_id", "left").select("wav_id", F.lit(source).alias("source"), "n", F.coalesce("there", F.lit(False)).alias("there")))
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


_add("a15_four_adapters", SQL + """, pv as (select uid, count(*) as n, sum((label = 'KCHI')::int) as child, max(offset_ms - onset_ms) as longest from vtc group by uid)
select x.uid::varchar as wav_id, source, x.n, source in ('vad', 'vtc') or coalesce(longest > 25000, false) as there from (
  select uid, 'vad' as source, count(*) as n from vad group by uid having sum(offset_ms - onset_ms) > 450000 union all select uid, 'vtc', n from pv where child >= 10
  union all select uid, 'snr', dur_ms from dur where dur_ms > 4200000 union all select dur.uid, 'esc', dur_ms from dur join pv using (uid) where pv.n >= 50) x left join pv on pv.uid = x.uid""")(_adapted)
_add("b10_sample", "select user_id as uid from (select distinct user_id from events) order by md5(user_id::varchar || ':42'), user_id limit 20")(lambda s, d: explore.sample(table(s, d, "events").select(F.col("user_id").alias("uid")).distinct(), 20))
_add("b10_sample_count", "select least(20, count(distinct user_id))::int as n_int, greatest(1, round(count(distinct user_id) * 0.25))::int as n_fraction, count(distinct user_id)::int as n_all from events")(
    lambda s, d: (lambda u: explore.sample(u, 20).agg(F.count("*").cast("int").alias("n_int")).crossJoin(explore.sample(u, 0.25).agg(F.count("*").cast("int").alias("n_fraction"))).crossJoin(u.agg(F.count("*").cast("int").alias("n_all"))))(table(s, d, "events").select(F.col("user_id").alias("uid")).distinct())
)
_add("b11_even_shards", "select user_id as uid, (ntile(7) over (order by user_id) - 1)::int as shard from (select distinct user_id from events)")(lambda s, d: explore.even_shards(table(s, d, "events").select(F.col("user_id").alias("uid")).distinct(), 7, ["uid"]))
_LONG = TURNS + ", lt as (select *, (offset_ms - onset_ms) / 1000.0::double as len_s from turns)"


def _long(s, d):
    return sessions.turns(derive.vtc(s, d)).withColumn("len_s", (F.col("offset_ms") - F.col("onset_ms")) / F.lit(1000.0))


_add("b12_long_turns", _LONG + ", bk as (select *, case when len_s < 30 then '10-30' when len_s < 60 then '30-60' when len_s < 120 then '60-120' when len_s < 300 then '120-300' else '300+' end as bucket from lt where len_s >= 10) select bucket, count(*) as n, round(sum(len_s), 6) as total_s from bk group by bucket")(
    lambda s, d: _long(s, d).where("len_s >= 10").withColumn("bucket", explore.duration_buckets(F.col("len_s"), 10)).groupBy("bucket").agg(F.count("*").alias("n"), F.round(F.sum("len_s"), 6).alias("total_s"))
)
_add("b13_short_stem", "select page_id, array_to_string(list_slice(string_split(replace(url, '/', '_'), '_'), -2, len(string_split(replace(url, '/', '_'), '_'))), '_') as short from pages")(lambda s, d: table(s, d, "pages").select("page_id", C.short_stem(F.replace("url", F.lit("/"), F.lit("_"))).alias("short")))
_add("b15_diverse_sample", CLIPS + """, z as (select uid || '_' || printf('%04d', clip_idx) as clip_id, sum(offset_ms - onset_ms)::bigint as speech_ms, count(*) as n from seg group by uid, clip_idx), h as (select *, md5(clip_id || ':42') as h from z),
p1 as (select *, 'dense' as bucket from h where speech_ms > 100000 order by h, clip_id limit 5), p2 as (select *, 'busy' as bucket from h where n > 8 and clip_id not in (select clip_id from p1) order by h, clip_id limit 5),
p3 as (select *, 'quiet' as bucket from h where speech_ms < 20000 and clip_id not in (select clip_id from p1 union all select clip_id from p2) order by h, clip_id limit 5),
p as (select * from p1 union all select * from p2 union all select * from p3), f as (select *, 'fill' as bucket from h where clip_id not in (select clip_id from p) order by h, clip_id limit 40)
select clip_id, bucket, speech_ms from (select * from p union all select * from f) order by bucket = 'fill', h, clip_id limit 40""")(
    lambda s, d: explore.diverse_sample(stats.clip_speech(_seg(s, d)).withColumn("clip_id", C.clip_key(F.col("uid"), F.col("clip_idx"))), [("dense", F.col("speech_ms") > 100_000, 5), ("busy", F.col("n_segments") > 8, 5), ("quiet", F.col("speech_ms") < 20_000, 5)], 40).select("clip_id", "bucket", "speech_ms")
)
def _bucket_sql(n: int) -> str:
    """Each bucket takes from what the ones before it left, then the rest fills up."""
    out = _FULL + ", h as materialized (select *, md5(clip_id || ':42') as h from (select *, uid || '_' || printf('%04d', clip_idx) as clip_id from cstat)), p0 as (select clip_id, h, '' as bucket, -1 as k from h limit 0)"
    for k, (name, column, how, bound, quota) in enumerate(explore.BUCKETS, 1):
        value = f"{column} = '{bound}'" if how == "=" else f"coalesce({column}, 0)::double {how} {bound}"
        out += f", q{k} as materialized (select clip_id, h, '{name}' as bucket, {k} as k from h where {value} and clip_id not in (select clip_id from p{k - 1}) order by h, clip_id limit {quota}), p{k} as materialized (select * from p{k - 1} union all select * from q{k})"
    last = len(explore.BUCKETS)
    out += f", f as (select clip_id, h, 'fill' as bucket, {last + 1} as k from h where clip_id not in (select clip_id from p{last}) order by h, clip_id limit {n})"
    return out + f" select clip_id, bucket from (select * from p{last} union all select * from f) order by k, h, clip_id limit {n}"


def _twelve(s, d, n: int = 60):
    rows = _cstat(s, d).select(C.clip_key(F.col("uid"), F.col("clip_idx")).alias("clip_id"), "speech_density", "child_fraction", "frame_iou", "n_turns", "dominant_label")
    return explore.diverse_sample(rows.checkpoint(), explore.clip_buckets(), n).select("clip_id", "bucket")


_add("b15_twelve_buckets", _bucket_sql(60))(_twelve)
_add("b16_pick_clips", CLIPS + " select uid || '_' || printf('%04d', clip_idx) as clip_id, onset_ms, offset_ms from clips where uid || '_' || printf('%04d', clip_idx) in ('3_0001', '17_0004', '90_0000')")(
    lambda s, d: _fixed(s, d).select(C.clip_key(F.col("uid"), F.col("clip_idx")).alias("clip_id"), "onset_ms", "offset_ms").where(F.col("clip_id").isin("3_0001", "17_0004", "90_0000"))
)
_LEVEL = "case when {x} <= 0.33 then 'lo' when {x} >= 0.66 then 'hi' else 'mid' end"
_add("b17_descriptive_name", _FULL + f" select uid, clip_idx, coalesce(dominant_label, 'UNK') || '_density-' || {_LEVEL.format(x='speech_density')} || '_iou-' || {_LEVEL.format(x='frame_iou')} || '_turns-' || case when n_turns < 10 then 'few' when n_turns > 50 then 'many' else 'some' end as name from cstat")(
    lambda s, d: _cstat(s, d).select("uid", "clip_idx", C.descriptive_name(F.col("speech_density"), F.col("frame_iou"), F.col("n_turns"), F.col("dominant_label")).alias("name"))
)
_add("f01_longest_turns", _LONG + " select uid, turn_idx, label, len_s from lt order by len_s desc, uid, turn_idx limit 50")(lambda s, d: _long(s, d).orderBy(F.desc("len_s"), "uid", "turn_idx").limit(50).select("uid", "turn_idx", "label", "len_s"))
_add("d38_long_turn_pivot", _LONG + " select uid, " + ", ".join(f"sum((label = '{x}')::int)::bigint as {x}" for x in derive.LABELS) + " from lt where len_s >= 10 group by uid")(lambda s, d: _long(s, d).where("len_s >= 10").groupBy("uid").pivot("label", list(derive.LABELS)).count().na.fill(0))
_add("d34_dataset_summary", SQL + """ select 'files' as section, 'n' as metric, count(*)::double as value from dur union all select 'files', 'hours', sum(dur_ms) / 3600000.0::double from dur union all select 'files', 'median_ms', quantile_cont(dur_ms, 0.5)::double from dur
union all select 'files', 'std_ms', round(stddev_pop(dur_ms), 3) from dur union all select 'segments', 'n', count(*)::double from vtc union all select 'segments', 'median_ms', quantile_cont(offset_ms - onset_ms, 0.5)::double from vtc union all select 'segments', 'under_1s', avg((offset_ms - onset_ms < 1000)::int::double) from vtc""")(
    lambda s, d: explore.tidy(derive.durations(s, d), "files", {"n": F.count("*"), "hours": F.sum("dur_ms") / F.lit(3600000.0), "median_ms": F.percentile("dur_ms", F.lit(0.5)), "std_ms": F.round(F.stddev_pop("dur_ms"), 3)}).unionByName(
        explore.tidy(derive.vtc(s, d).withColumn("len", F.col("offset_ms") - F.col("onset_ms")), "segments", {"n": F.count("*"), "median_ms": F.percentile("len", F.lit(0.5)), "under_1s": F.avg((F.col("len") < 1000).cast("double"))})
    )
)
_add("d35_summary_card", SQL + " select 'card' as section, metric, value from (unpivot (select count(distinct uid)::double as files, count(*)::double as segments, count(distinct label)::double as labels, sum(offset_ms - onset_ms) / 3600000.0::double as speech_h from vtc) on files, segments, labels, speech_h into name metric value value)")(
    lambda s, d: explore.tidy(derive.vtc(s, d), "card", {"files": F.countDistinct("uid"), "segments": F.count("*"), "labels": F.countDistinct("label"), "speech_h": F.sum(F.col("offset_ms") - F.col("onset_ms")) / F.lit(3600000.0)})
)
_add("d36_histogram", SQL + " select least(floor(greatest(0, least(offset_ms - onset_ms, 30000))::double / 500.0::double), 59)::bigint as bin, count(*) as n from vtc group by bin")(
    lambda s, d: explore.histogram(derive.vtc(s, d), F.col("offset_ms") - F.col("onset_ms"), 0.0, 30_000.0, 60)
)
_add("d36_histogram_capped", SQL + " select label, least(floor(greatest(0, least(offset_ms - onset_ms, 30000))::double / 500.0::double), 59)::bigint as bin, count(*) as n from vtc group by label, bin")(
    lambda s, d: explore.histogram(derive.vtc(s, d), F.col("offset_ms") - F.col("onset_ms"), 0.0, 30_000.0, 60, ["label"])
)


def _p99(s, d):
    rows = _long(s, d)
    cap = selection.quantiles(rows, [], "len_s", {"cap": 0.99}).first()[0]
    return explore.histogram(rows, F.col("len_s"), 0.0, cap or 1.0, 60, ["label"])


_add("d36_turns_p99", _LONG + ", c as (select quantile_cont(len_s, 0.99) as cap from lt) select label, least(floor(least(len_s, cap) / (cap / 60)), 59)::bigint as bin, count(*) as n from lt, c group by label, bin")(_p99)


def _log2(s, d):
    rows = derive.frames(s, d)
    both = rows.agg(F.count("snr") + F.count("c50"), *[f(c) for c in ("snr", "c50") for f in (F.min, F.max)]).first()
    n, bounds = explore.log2_bins(both[0]), {"snr": both[1:3], "c50": both[3:5]}
    parts = [explore.histogram(rows, F.col(c), lo or 0.0, hi if lo is not None and hi > lo else (lo or 0.0) + 1, n).withColumn("metric", F.lit(c)) for c, (lo, hi) in bounds.items()]
    return parts[0].unionByName(parts[1])


_add("d36_log2_bins", SQL + FRAMES_SQL + """, v as (unpivot (select snr::double as snr, c50::double as c50 from frames) on snr, c50 into name metric value x), b as (select metric, min(x) as lo, max(x) as hi from v group by metric), c as (select greatest(8, ceil(log2(count(*)) + 1))::bigint as k from v)
select metric, least(floor((x - lo) / ((hi - lo) / k)), k - 1)::bigint as bin, count(*) as n from v join b using (metric), c group by metric, bin""")(_log2)
_add("d36_integer_bins", CLIPS + " select least(n_labels, 4)::bigint as bin, count(*) as n from (select count(distinct label) as n_labels from seg group by uid, clip_idx) group by bin")(
    lambda s, d: explore.histogram(_seg(s, d).groupBy("uid", "clip_idx").agg(F.countDistinct("label").alias("n_labels")), F.col("n_labels"), 0.0, 5.0, 5)
)
_LEN = ", ln as (select label, offset_ms - onset_ms as len_ms from vtc)"


def _len(s, d):
    return derive.vtc(s, d).select("label", (F.col("offset_ms") - F.col("onset_ms")).alias("len_ms"))


_add("d39_chunk_peaks", SQL + _LEN + """, z as (select *, round_even(len_ms / 3980.0::double, 0)::bigint as k from ln), t as (select count(*) as total, sum((len_ms < 43780)::int) as inside from ln)
select k as peak, count(*) as n, 100.0::double * count(*) / any_value(total) as pct, count(*) / (any_value(inside) * 2001.0::double / 43780) as enrichment from z, t where abs(len_ms - k * 3980) <= 1000 and k between 1 and 10 group by k""")(lambda s, d: explore.chunk_peaks(_len(s, d), 3980, within_ms=1000))
_add("d39_chunk_peaks_10ms", SQL + _LEN + """, z as (select *, round_even(len_ms / 3980.0::double, 0)::bigint as k from ln), t as (select count(*) as total, sum((len_ms < 43780)::int) as inside from ln)
select k as peak, count(*) as n, 100.0::double * count(*) / any_value(total) as pct, count(*) / (any_value(inside) * 21.0::double / 43780) as enrichment from z, t where abs(len_ms - k * 3980) <= 10 and k between 1 and 10 group by k""")(lambda s, d: explore.chunk_peaks(_len(s, d), 3980))
_add("d40_onset_phase", SQL + " select (onset_ms % 3980) // 50 as bin, count(*) as n from vtc group by bin")(lambda s, d: explore.onset_phase(derive.vtc(s, d), 3980))
_add("d41_duration_spectrum", SQL + _LEN + ", b as (select label, len_ms // 50 as bin, count(*) as n from ln group by 1, 2), m as (select label, quantile_cont(n, 0.5)::double as baseline from b group by label) select label, bin, n, baseline, n / baseline as ratio from b join m using (label)")(lambda s, d: explore.spectrum(_len(s, d), 50, ["label"]))
_add("d42_file_sizes", "with x as (select page_id, case when page_id % 9 <> 0 then length(html) end as bytes from pages) select count(bytes) as n_found, count(*) - count(bytes) as n_missing, min(bytes) as min_bytes, max(bytes) as max_bytes, avg(bytes) as mean_bytes, quantile_cont(bytes, 0.5)::double as median_bytes, sum(bytes)::bigint as total_bytes from x")(
    lambda s, d: table(s, d, "pages").select("page_id").join(table(s, d, "pages").where("page_id % 9 <> 0").select("page_id", F.length("html").cast("long").alias("bytes")), "page_id", "left").agg(F.count("bytes").alias("n_found"), (F.count("*") - F.count("bytes")).alias("n_missing"), F.min("bytes").alias("min_bytes"), F.max("bytes").alias("max_bytes"), F.avg("bytes").alias("mean_bytes"), F.percentile("bytes", F.lit(0.5)).alias("median_bytes"), F.sum("bytes").alias("total_bytes"))
)
_add("d47_run_summary", "select sum((value > 100)::int)::bigint as n_ok, sum((value <= 100)::int)::bigint as n_failed, round(avg(case when value > 100 then value end), 6) as mean_ok, round(stddev_samp(case when value > 100 then value end), 6) as std_ok, min(case when value > 100 then value end) as min_ok, max(case when value > 100 then value end) as max_ok from events where value is not null")(
    lambda s, d: (lambda ok: table(s, d, "events").where("value is not null").agg(F.sum((F.col("value") > 100).cast("long")).alias("n_ok"), F.sum((F.col("value") <= 100).cast("long")).alias("n_failed"), F.round(F.avg(ok), 6).alias("mean_ok"), F.round(F.stddev_samp(ok), 6).alias("std_ok"), F.min(ok).alias("min_ok"), F.max(ok).alias("max_ok")))(F.when(F.col("value") > 100, F.col("value")))
)
_add("d47_first_failures", "select event_id, 'value ' || round(value, 2)::decimal(18, 2)::varchar || ' is too low' as error from events where value <= 100 order by event_id limit 5")(
    lambda s, d: explore.first_failures(table(s, d, "events").select("event_id", F.when(F.col("value") <= 100, F.concat(F.lit("value "), F.round("value", 2).cast("decimal(18,2)").cast("string"), F.lit(" is too low"))).alias("error")), "event_id")
)
_add("d43_upper_median", "select event_type, list(value order by value)[count(*) // 2 + 1] as value from events where value is not null group by event_type")(lambda s, d: selection.upper_median(table(s, d, "events"), "value", "event_type"))
_add("d43_eta", "with m as (select event_type as step, list(value order by value)[count(*) // 2 + 1] as rate from events where value is not null group by event_type), t as (select event_type as step, count(*) * 1000 as bytes, 4 as workers from events group by event_type) select step, bytes, workers, rate, bytes::double / nullif(rate * workers, 0) as eta_s from t left join m using (step)")(
    lambda s, d: explore.eta(selection.upper_median(table(s, d, "events"), "value", "event_type").toDF("step", "rate"), table(s, d, "events").groupBy(F.col("event_type").alias("step")).agg((F.count("*") * 1000).alias("bytes"), F.first(F.lit(4)).alias("workers")))
)
_add("h13_json", SQL + ", c as (select uid, label, count(*) as n from vtc group by uid, label) select uid, '{' || string_agg('\"' || label || '\":' || n, ',' order by label) || '}' as counts from c group by uid")(
    lambda s, d: derive.vtc(s, d).groupBy("uid", "label").count().groupBy("uid").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("label", "count"))))).alias("counts"))
)
_add("h14_formats", SQL + " select uid, printf('%02d:%02d:%02d', dur_ms // 1000 // 3600, dur_ms // 1000 // 60 % 60, dur_ms // 1000 % 60) as clock, case when dur_ms >= 1048576 then printf('%.1f MB', dur_ms / 1048576.0::double) else printf('%.1f KB', dur_ms / 1024.0::double) end as size, uid || '_' || printf('%04d', uid % 13) as clip from dur")(
    lambda s, d: derive.durations(s, d).select("uid", C.hhmmss(F.col("dur_ms") / 1000).alias("clock"), C.human_size(F.col("dur_ms")).alias("size"), C.clip_key(F.col("uid"), F.col("uid") % 13).alias("clip"))
)
_add("h14_durations", SQL + " select uid, case when dur_ms < 4000000 then printf('%dm %ds', dur_ms // 60000, dur_ms // 1000 % 60) else printf('%dh %dm', dur_ms // 3600000, dur_ms // 60000 % 60) end as whole, printf('%ds', round_even(dur_ms / 100000.0::double, 0)::bigint) as part from dur".replace("dur_ms < 4000000", "dur_ms < 3600000"))(
    lambda s, d: derive.durations(s, d).select("uid", C.human_duration(F.col("dur_ms") / 1000.0).alias("whole"), C.human_duration(F.col("dur_ms") / 100_000.0).alias("part"))
)
_add("h15_rounding", "select event_id, floor(value * 10::double + 0.500001) / 10::double as v1, round(value, 3) as v3 from events where value is not null")(lambda s, d: table(s, d, "events").where("value is not null").select("event_id", C.rounded(F.col("value"), 1).alias("v1"), F.round("value", 3).alias("v3")))

# Sample arrays: the embeddings serve as short signals.
_SIG = "select vec_id, list_transform(embedding, lambda x: x::double) as samples from embeddings"


def _sig(s, d):
    return table(s, d, "embeddings").selectExpr("vec_id", "label", "transform(embedding, x -> cast(x as double)) as samples")


_sum = lambda c: F.round(F.aggregate(c, F.lit(0.0), lambda a, v: a + v), 9)
_add("h05_resample", f"with s as ({_SIG}), r as (select vec_id, k, k * 63.0::double / 47 as p, samples from s, unnest(range(0, 48)) t(k)) select vec_id, count(*)::int as n, round(sum(samples[floor(p)::int + 1] * (1 - (p - floor(p))) + coalesce(samples[floor(p)::int + 2], 0) * (p - floor(p))), 9) as total from r group by vec_id")(
    lambda s, d: _sig(s, d).select("vec_id", samples.resample(F.col("samples"), 16_000, 12_000).alias("x")).select("vec_id", F.size("x").alias("n"), _sum(F.col("x")).alias("total"))
)
_add("h06_mono", f"with s as ({_SIG}) select vec_id, round(list_sum(list_transform(range(1, 33), lambda i: (samples[i] + samples[i + 32]) / 2)), 9) as total, samples[1] as first from s")(
    lambda s, d: _sig(s, d).select("vec_id", F.array(F.slice("samples", 1, 32), F.slice("samples", 33, 32)).alias("ch")).select("vec_id", _sum(samples.mono(F.col("ch"))).alias("total"), F.get(samples.mono(F.col("ch"), False), F.lit(0)).alias("first"))
)
_add("h07_speech_only", f"with s as ({_SIG}) select vec_id, 26 as n, round(list_sum(samples[1:12]) + list_sum(samples[51:64]), 9) as total from s")(
    lambda s, d: _sig(s, d).select("vec_id", samples.speech_only(F.col("samples"), F.expr("array(named_struct('first', 0, 'end', 10), named_struct('first', 52, 'end', 63))"), 2).alias("x")).select("vec_id", F.size("x").alias("n"), _sum(F.col("x")).alias("total"))
)
_add("h07_rebase", SQL + islands("vad", "uid") + ", r as (select *, sum(offset_ms - onset_ms) over (partition by uid order by onset_ms rows between unbounded preceding and current row)::bigint as new_off_ms from m) select uid, onset_ms, offset_ms, new_off_ms - (offset_ms - onset_ms) as new_on_ms, new_off_ms from r")(lambda s, d: samples.rebase(intervals.merge(derive.vad(s, d))))
_add("h08_normalize", f"with s as ({_SIG}), g as (select vec_id, samples, sqrt(list_sum(list_transform(samples, lambda x: x * x)) / 64) as rms, list_max(list_transform(samples, lambda x: abs(x))) as top from s) select vec_id, round(list_sum(samples) * (0.1::double / rms), 4) as rms_total, round(list_sum(samples) / top, 4) as peak_total from g")(
    lambda s, d: _sig(s, d).select("vec_id", F.round(_sum(samples.normalize_rms(F.col("samples"))), 4).alias("rms_total"), F.round(_sum(samples.normalize_peak(F.col("samples"))), 4).alias("peak_total"))
)
_IDS = {"FEM": 0, "MAL": 1, "KCHI": 2}
_add("h09_label_ids", SQL + " select uid, onset_ms, label, case label when 'FEM' then 0 when 'MAL' then 1 when 'KCHI' then 2 else 9 end as label_id, case when label <> 'OCH' then label end as decoded from vtc")(
    lambda s, d: derive.vtc(s, d).withColumn("label_id", C.encode_label(F.col("label"), _IDS, 9)).withColumn("decoded", C.decode_label(F.col("label_id"), _IDS)).select("uid", "onset_ms", "label", "label_id", "decoded")
)
_add("h10_frame_masks", CLIPS + """, fr as (select uid, clip_idx, unnest(range(0, (offset_ms - onset_ms) // 20)) as i from clips), hm as (select uid, clip_idx, label, count(distinct i) as n from (select uid, clip_idx, label, unnest(range(rel_on_ms // 20, rel_off_ms // 20)) as i from seg) group by 1, 2, 3)
select c.uid, c.clip_idx, ((c.offset_ms - c.onset_ms) // 20)::int as n_frames, """ + ", ".join(f"coalesce(max(case when label = '{x}' then n end), 0)::int as n_{x}" for x in derive.LABELS) + " from clips c left join hm using (uid, clip_idx) group by c.uid, c.clip_idx, c.offset_ms, c.onset_ms")(
    lambda s, d: samples.frame_masks(_fixed(s, d), _seg(s, d), derive.LABELS).select("uid", "clip_idx", "n_frames", *[f"n_{x}" for x in derive.LABELS])
)
_BATCH = f"with s as (select vec_id, label, list_transform(embedding, lambda x: x::double)[1 : 20 + vec_id % 40] as samples from embeddings), b as (select *, (row_number() over (partition by label order by vec_id) - 1) // 8 as batch, len(samples) as n_s from s)"


def _cut(s, d):
    return _sig(s, d).withColumn("samples", F.expr("slice(samples, 1, cast(20 + vec_id % 40 as int))"))


def _stacked(s, d):
    """A recording's clips as one batch: their attention masks and those of one label, stacked."""
    stacked = samples.stack_masks(samples.frame_masks(_fixed(s, d), _seg(s, d), ("FEM",)), ["uid"], ["clip_idx"], ["attention", "mask_FEM"])

    def count(batches):
        for b in batches:
            found = [int(samples.unpack_stack(m, n, w, k).sum()) for m, n, w, k in zip(*(b.column(c).to_pylist() for c in ("masks", "n", "width", "n_labels")))]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("uid", "n", "width", "n_labels")), pa.array([len(m.as_py()) for m in b.column("masks")], pa.int64()), pa.array(found, pa.int64())], names=["uid", "n", "width", "n_labels", "n_bytes", "n_set"])

    return stacked.mapInArrow(count, "uid long, n long, width int, n_labels int, n_bytes long, n_set long")


_add("h11_batches", _BATCH + " select label, batch, count(*) as n, (ceil(max(n_s) / 16.0) * 16)::int as width, sum(n_s)::bigint as n_attended, round(sum(list_sum(samples)), 9) as total from b group by label, batch having count(*) = 8")(
    lambda s, d: samples.batches(_cut(s, d), 8, ["vec_id"], "label", multiple=16, drop_last=True).select("label", "batch", "n", "width", F.size(F.array_remove(F.flatten("attention"), False)).cast("long").alias("n_attended"), _sum(F.flatten("samples")).alias("total"))
)
_add("h12_collate", "with z as (select event_id, user_id, case when user_id % 3 = 0 or event_id % 4 = 0 then null else value end as v from events) select event_id, case when count(v) over (partition by user_id) > 0 then coalesce(v, 0) end as v from z")(
    lambda s, d: table(s, d, "events").selectExpr("event_id", "user_id", "case when user_id % 3 = 0 or event_id % 4 = 0 then null else value end as v").select("event_id", samples.collate_scalar(F.col("v"), F.col("user_id")).alias("v"))
)
_add("h12_stacked_masks", CLIPS + """, fr as (select uid, clip_idx, (offset_ms - onset_ms) // 20 as n from clips), hm as (select uid, clip_idx, count(distinct i) as hits from (select uid, clip_idx, label, unnest(range(rel_on_ms // 20, rel_off_ms // 20)) as i from seg where label = 'FEM') group by uid, clip_idx)
select uid, count(*) as n, max(n)::int as width, 2 as n_labels, count(*) * 2 * ((max(n) + 7) // 8) as n_bytes, (sum(n) + sum(coalesce(hits, 0)))::bigint as n_set from fr left join hm using (uid, clip_idx) group by uid""")(_stacked)
_add("h16_sample_range", SQL + " select uid, onset_ms, label, onset_ms * 16000 // 1000 as first, least(offset_ms * 16000 // 1000, dur_ms * 16 - 200000) as stop from vtc join dur using (uid) where onset_ms * 16000 // 1000 < least(offset_ms * 16000 // 1000, dur_ms * 16 - 200000)")(
    lambda s, d: (lambda r: derive.vtc(s, d).join(derive.durations(s, d), "uid").select("uid", "onset_ms", "label", r[0].alias("first"), r[1].alias("stop")).where("first < stop"))(samples.sample_range(F.col("onset_ms"), F.col("offset_ms"), 16_000, F.col("dur_ms") * 16 - 200_000))
)
_add("i04_epoch_order", "with z as (select vec_id, ('0x' || substr(md5(vec_id || ':42'), 1, 8))::bigint % 4 as worker, md5(vec_id || ':42:1') as h from embeddings) select vec_id, worker, row_number() over (partition by worker order by h, vec_id)::int as place from z")(
    lambda s, d: samples.epoch_order(table(s, d, "embeddings").select("vec_id"), "vec_id", 42, 1, 4)
)
_add("d38_long_turn_summary", _LONG + " select label, count(*) as n, round(sum(len_s), 6) as total, round(avg(len_s), 6) as mean, max(len_s) as longest from lt where len_s >= 10 group by label")(
    lambda s, d: explore.length_summary(_long(s, d).where("len_s >= 10"), F.col("len_s")).withColumns({"total": F.round("total", 6), "mean": F.round("mean", 6)})
)

# Export documents.
_add("a13_clip_manifest", CLIPS + ", z as (select uid, clip_idx, string_agg(distinct label, ';' order by label) as labels, " + ", ".join(f"sum(case when label = '{x}' then offset_ms - onset_ms else 0 end)::bigint as dur_{x}" for x in derive.LABELS) + " from seg group by uid, clip_idx) select * from z")(
    lambda s, d: (lambda m: m.select("uid", "clip_idx", "labels", *[F.coalesce(F.try_element_at("label_ms", F.lit(x)), F.lit(0)).cast("long").alias(f"dur_{x}") for x in derive.LABELS]))(
        _seg(s, d).groupBy("uid", "clip_idx", "label").agg(F.sum(F.col("offset_ms") - F.col("onset_ms")).alias("ms")).groupBy("uid", "clip_idx").agg(F.map_from_entries(F.collect_list(F.struct("label", "ms"))).alias("label_ms"), F.array_join(F.array_sort(F.collect_set("label")), ";").alias("labels"))
    )
)
_add("a14_clip_json", CLIPS + """ select uid || '_' || printf('%04d', clip_idx) as clip_id, '{"uid":' || uid || ',"segments":[' || string_agg('{"on":' || rel_on_ms || ',"off":' || rel_off_ms || ',"label":"' || label || '"}', ',' order by rel_on_ms, rel_off_ms, label) || ']}' as doc from seg group by uid, clip_idx""")(
    lambda s, d: _seg(s, d).groupBy("uid", "clip_idx").agg(F.array_sort(F.collect_list(F.struct(F.col("rel_on_ms").alias("on"), F.col("rel_off_ms").alias("off"), "label"))).alias("segments")).select(C.clip_key(F.col("uid"), F.col("clip_idx")).alias("clip_id"), F.to_json(F.struct("uid", "segments")).alias("doc"))
)
