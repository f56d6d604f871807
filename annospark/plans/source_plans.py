"""Registered queries: sources, sinks, stores, shards, streams and extension points, each over the given tables.

Results are written to a folder that the session shares and read again, so that a query shows a full round trip.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from annospark.operators import explore, extend, selection, sessions
from annospark.sources import arrays, derive, shards, tables
from annospark.sources.derive import FRAMES_SQL, SQL, table
from annospark.streaming import endless, live
from annospark.streaming import sessions as timed

from .agreement_plans import CONVS, TURNS
from .stats_plans import CLIPS, _fixed, _seg

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def _add(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return put


_folder = tables.shared_folder
_VTC = SQL + " select uid, onset_ms, offset_ms, label from vtc"


@_add("a01_all_formats", SQL + " select uid, onset_ms, label, f as format from vtc, unnest(['parquet', 'csv', 'tsv', 'jsonl']) t(f)")
@_add("a01_manifest_formats", SQL + " select uid, onset_ms, label, f as format from vtc, unnest(['parquet', 'csv', 'tsv', 'jsonl']) t(f)")
def _formats(s, d):
    rows, path = derive.vtc(s, d).select("uid", "onset_ms", "label"), _folder(s, "formats")
    rows.write.parquet(f"{path}.parquet")
    rows.write.option("header", True).csv(f"{path}.csv")
    rows.write.option("header", True).option("sep", "\t").csv(f"{path}.tsv")
    rows.write.json(f"{path}.jsonl")
    parts = [tables.read_manifest(s, f"{path}.{f}", "uid long, onset_ms long, label string").withColumn("format", F.lit(f)) for f in ("parquet", "csv", "tsv", "jsonl")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@_add("a03_scan_files", "select distinct user_id::varchar as uid, '.json' as ext, true as has_bytes from events")
def _scan(s, d):
    """A small file for each recording; hidden files and others lie beside."""
    path = _folder(s, "scan")
    rows = table(s, d, "events").select("event_id", F.col("user_id").cast("string").alias("uid"))
    tables.write_folders(rows.select("uid", F.to_json(F.struct("event_id")).alias("line")), "uid", path, ".json")
    rows.select("uid").distinct().coalesce(1).write.text(f"{path}/other")
    found = tables.scan_files(s, path, (".json",), F.regexp_extract("path", "uid=([^/]+)/", 1))
    return found.groupBy("uid", "ext").agg((F.sum("bytes") > 0).alias("has_bytes"))


@_add("d42_found_files", SQL + """, per as (select uid, sum(length(onset_ms::varchar) + 1)::bigint as bytes from vtc where label = 'OCH' and offset_ms - onset_ms > 15000 group by uid), z as (select dur.uid, bytes from dur left join per using (uid))
select count(*) as total, count(bytes) as n_found, count(*) - count(bytes) as n_missing, coalesce(sum(bytes), 0)::bigint as total_bytes, min(bytes) as least, max(bytes) as greatest, avg(bytes) as mean, quantile_cont(bytes, 0.5)::double as median,
(select coalesce(string_agg(k, ';' order by k), '') from (select uid::varchar as k from z where bytes is null order by k limit 10)) as missing from z""")
def _sizes(s, d):
    """A text file of each recording with long segments of one label, found again by a scan of the folder; the other recordings have none."""
    rows = derive.vtc(s, d).where("label = 'OCH' and offset_ms - onset_ms > 15000").select(F.col("uid").cast("string").alias("uid"), F.col("onset_ms").cast("string").alias("line"))
    tables.write_folders(rows, "uid", path := _folder(s, "texts"), ".txt")
    found = tables.scan_files(s, path, (".txt",), F.regexp_extract("path", "uid=([^/]+)/", 1))
    return explore.file_sizes(derive.durations(s, d).select(F.col("uid").cast("string").alias("uid")), found)


@_add("a04_read_shards", SQL + " select uid, onset_ms, offset_ms, label from vtc union all select uid, onset_ms, offset_ms, null from vad")
def _shards(s, d):
    path = _folder(s, "shards")
    tables.write_parquet(derive.vtc(s, d), f"{path}/one")
    tables.write_parquet(derive.vad(s, d), f"{path}/two")
    return tables.read_shards(s, path)


@_add("a05_parquet_sink", _VTC)
def _parquet(s, d):
    tables.write_parquet(derive.vtc(s, d), path := _folder(s, "parquet"))
    return s.read.parquet(path)


@_add("a06_csv_sink", CLIPS + " select uid, clip_idx, string_agg(distinct label, ';' order by label) as labels from seg group by uid, clip_idx")
def _csv(s, d):
    rows = _seg(s, d).groupBy("uid", "clip_idx").agg(F.array_sort(F.collect_set("label")).alias("labels"))
    tables.write_csv(rows, path := _folder(s, "csv"))
    return s.read.schema("uid long, clip_idx long, labels string").option("header", True).csv(path)


@_add("a07_all_sidecars", SQL + FRAMES_SQL + " select uid::varchar as uid, count(*) as n, sum((vad > 0.5)::int)::bigint as n_speech from frames group by uid")
@_add("a07_array_sidecars", SQL + FRAMES_SQL + " select uid::varchar as uid, count(*) as n, sum((vad > 0.5)::int)::bigint as n_speech from frames group by uid")
def _npz(s, d):
    rows = derive.frame_arrays(s, d).withColumn("uid", F.col("uid").cast("string"))
    arrays.write_npz(arrays.pack_npz(rows, ("snr", "c50", "vad")), path := _folder(s, "npz"))
    back = arrays.frames_of(arrays.read_npz(s, path, scalars=()))
    return back.groupBy("uid").agg(F.count("*").alias("n"), F.sum((F.col("vad") > 0.5).cast("long")).alias("n_speech"))


@_add("a08_json_store", SQL + " select uid::varchar as wav_id, dur_ms from dur")
def _json(s, d):
    store = tables.JsonStore(s, _folder(s, "json"))
    store.save(derive.durations(s, d).select(F.col("uid").cast("string").alias("wav_id"), "dur_ms"))
    return store.table("wav_id string, dur_ms long")


@_add("a08_replaced_documents", SQL + " select uid::varchar as wav_id, case when uid % 3 = 0 then -dur_ms else dur_ms end as dur_ms from dur")
def _replaced(s, d):
    """A second save of some keys replaces their documents."""
    store = tables.JsonStore(s, _folder(s, "json"))
    rows = derive.durations(s, d).select(F.col("uid").cast("string").alias("wav_id"), "dur_ms")
    store.save(rows)
    store.save(rows.where("wav_id % 3 = 0").withColumn("dur_ms", -F.col("dur_ms")))
    return store.table("wav_id string, dur_ms long")


@_add("a09_parquet_store", SQL + " select uid::varchar as wav_id, case when uid % 3 = 0 then -dur_ms else dur_ms end as dur_ms from dur")
def _store(s, d):
    store = tables.ParquetStore(s, _folder(s, "store"), buckets=8)
    rows = derive.durations(s, d).select(F.col("uid").cast("string").alias("wav_id"), "dur_ms", "uid")
    store.save(rows.drop("uid"))
    store.save(rows.where("uid % 3 = 0").select("wav_id", (-F.col("dur_ms")).alias("dur_ms")))
    return store.table()


@_add("a11_a12_all_shards", CLIPS + " select uid || '_' || printf('%04d', clip_idx) as key, 'bin' as ext, (offset_ms - onset_ms)::varchar as payload, uid::varchar as meta_uid from clips")
@_add("a11_a12_tar_shards", CLIPS + " select uid || '_' || printf('%04d', clip_idx) as key, 'bin' as ext, (offset_ms - onset_ms)::varchar as payload, uid::varchar as meta_uid from clips")
def _tar(s, d):
    clips = shards.assign_shards(_fixed(s, d), 50)
    members = clips.select("shard", "key", F.explode(F.array(F.struct(F.lit("bin").alias("ext"), (F.col("offset_ms") - F.col("onset_ms")).cast("string").cast("binary").alias("payload")), F.struct(F.lit("json").alias("ext"), F.to_json(F.struct(F.col("uid").cast("string").alias("uid"))).cast("binary").alias("payload")))).alias("m")).select("shard", "key", "m.*")
    path = _folder(s, "tars")
    shards.write_shards(members, path)
    return shards.samples_of(shards.read_shards(s, path)).select("key", "ext", F.col("payload").cast("string").alias("payload"), F.col("metadata")["uid"].alias("meta_uid"))


def _members(s, d):
    """The clips' tars, two members for each clip, in a fresh folder."""
    clips = shards.assign_shards(_fixed(s, d), 50)
    parts = F.array(F.struct(F.lit("bin").alias("ext"), (F.col("offset_ms") - F.col("onset_ms")).cast("string").cast("binary").alias("payload")), F.struct(F.lit("json").alias("ext"), F.to_json(F.struct(F.col("uid").cast("string").alias("uid"))).cast("binary").alias("payload")))
    shards.write_shards(clips.select("shard", "key", F.explode(parts).alias("m")).select("shard", "key", "m.*"), path := _folder(s, "tars"))
    return path


_KEYS = CLIPS + ", k as (select uid, uid || '_' || printf('%04d', clip_idx) as key, (offset_ms - onset_ms)::varchar as length from clips)"


@_add("a12_pushed_filters", _KEYS + " select key, length from k where key >= '5' and key < '8'")
def _pushed(s, d):
    """A range of keys: the filters reach the source, which plans and reads only the tars and members that have such keys."""
    return shards.read_shards(s, _members(s, d)).where("ext = 'bin' and key >= '5' and key < '8'").select("key", F.col("payload").cast("string").alias("length"))


@_add("a12_random_access", _KEYS + " select key, length from k join dur using (uid) where dur_ms > 4200000")
def _fetched(s, d):
    """Members that a join with another table chooses, fetched by their places in the index."""
    path = _members(s, d)
    long = derive.durations(s, d).where("dur_ms > 4200000").select(F.col("uid").cast("string").alias("uid"))
    index = shards.read_index(s, path).where("ext = 'bin'").withColumn("uid", F.regexp_extract("key", "^(.*)_", 1)).join(long, "uid", "left_semi")
    return shards.fetch_members(index, path).select("key", F.col("payload").cast("string").alias("length"))


@_add("i04_endless_epochs", _KEYS + " select epoch, key, length, uid::varchar as meta_uid from k, unnest([0, 1]) t(epoch)")
def _epochs(s, d):
    """Two epochs of the endless reader, by two workers: each epoch has every sample once."""
    path, parts = _members(s, d), []
    for worker in range(2):
        stream = endless.endless_samples(s, path, f"{_folder(s, 'planned')}.json", buffer=500, blocks=64, worker=worker, workers=2, epochs=2)
        rows = stream.select("epoch", "key", F.col("members")["bin"].cast("string").alias("length"), F.get_json_object(F.col("members")["json"].cast("string"), "$.uid").alias("meta_uid"))
        out = _folder(s, "epochs")
        q = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", _folder(s, "epochs-checkpoint")).trigger(processingTime="0 seconds").start()
        try:
            q.processAllAvailable()
        finally:
            q.stop()
        parts.append(s.read.schema(rows.schema).parquet(out))
    return parts[0].unionByName(parts[1])


@_add("i04_fixed_subset", _KEYS + " select key, length from k order by md5(key || ':42'), key limit 300")
def _subset(s, d):
    """A fixed subset for evaluation: exactly 300 samples by a seeded hash, the same whatever the shards and tasks; only their bytes are read."""
    path = _members(s, d)
    return shards.fetch_members(selection.k_of_n(shards.read_index(s, path).where("ext = 'bin'"), 300, "key"), path).select("key", F.col("payload").cast("string").alias("length"))


@_add("a16_benchmark_log", "select event_type as step, event_id, value as seconds from events where event_type = 'click'")
def _log(s, d):
    path = _folder(s, "log")
    rows = table(s, d, "events").selectExpr("event_type as step", "event_id", "value as seconds")
    tables.append_log(rows.where("event_id % 2 = 0"), path)
    tables.append_log(rows.where("event_id % 2 = 1"), path)
    return tables.read_log(s, path, "step string, event_id long, seconds double", "click")


# Streams: the table's file is read as a stream and all of it is processed at once.
def _stream(s, d, name: str):
    schema = s.read.parquet(f"{d}/{name}.parquet").schema
    return s.readStream.schema(schema).parquet(f"{d}/{name}.parque[t]")  # a stream takes folders and patterns only


def _run(s, stream, name: str):
    path, check = _folder(s, name), _folder(s, f"{name}-checkpoint")
    q = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", check).trigger(availableNow=True).start()
    q.awaitTermination()
    return s.read.schema(stream.schema).parquet(path)


def _live_vtc(s, d):
    rows = _stream(s, d, "events")
    label = "case event_type when 'view' then 'FEM' when 'purchase' then 'MAL' when 'click' then 'KCHI' when 'signup' then 'OCH' end as label"
    rows = rows.where("event_type <> 'error'").selectExpr("user_id as uid", "timestampdiff(MICROSECOND, timestamp_ntz'2024-01-01 00:00:00', ts) div 600000 as onset_ms", "cast(floor(value*200) as bigint) as len_ms", label)
    return rows.where("len_ms > 0").withColumn("offset_ms", F.col("onset_ms") + F.col("len_ms"))


@_add("i01_incremental_ingest", SQL + " select uid, label, count(*) as n from vtc group by uid, label")
def _ingest(s, d):
    store = tables.ParquetStore(s, _folder(s, "ingest"), "uid")
    live.ingest(_live_vtc(s, d), store, _folder(s, "ingest-checkpoint"))
    return store.table().groupBy("uid", "label").agg(F.count("*").alias("n"))


@_add("i01_replaced_ingest", SQL + """, z as (select uid, label, case when uid % 3 = 0 then onset_ms + 1000 else onset_ms end as onset_ms from vtc) select uid, label, count(*) as n, sum(onset_ms)::bigint as onsets from z group by uid, label""")
def _replaced_ingest(s, d):
    """Shards arrive in three batches, each to a stream that goes on from the last one's checkpoint; the third replaces recordings of the first two, and versions that no slot needs are removed."""
    rows = derive.vtc(s, d)
    store, given, check = tables.ParquetStore(s, _folder(s, "ingest"), "uid", buckets=8), _folder(s, "arriving"), _folder(s, "ingest-checkpoint")
    for batch in (rows.where("uid % 2 = 0"), rows.where("uid % 2 = 1"), rows.where("uid % 3 = 0").withColumn("onset_ms", F.col("onset_ms") + 1000)):
        batch.write.mode("append").parquet(given)
        live.ingest(s.readStream.schema(batch.schema).parquet(given), store, check)
    store.vacuum()
    return store.table().groupBy("uid", "label").agg(F.count("*").alias("n"), F.sum("onset_ms").alias("onsets"))


@_add("i02_live_conversations", SQL + """, x as (select *, max(offset_ms) over (partition by uid order by onset_ms, offset_ms rows between unbounded preceding and 1 preceding) as reach from vtc), y as (select *, sum(case when onset_ms - reach < 10000 then 0 else 1 end) over (partition by uid order by onset_ms, offset_ms rows between unbounded preceding and current row) as k from x),
z as (select uid, k, min(onset_ms) as start_ms, max(offset_ms) as end_ms, count(*) as n_segments, sum(offset_ms - onset_ms)::bigint as speech_ms from y group by uid, k) select uid, start_ms, n_segments, speech_ms from z where end_ms + 10000 < (select max(onset_ms) from vtc) - 60000""")
def _live_conversations(s, d):
    rows = _live_vtc(s, d).withColumn("ts", F.timestamp_millis("onset_ms"))
    out = _run(s, live.live_conversations(rows.select("uid", "ts", "len_ms")), "conversations")
    # Sessions that ended a little before the watermark are settled however the stream was cut.
    last = F.lit(derive.vtc(s, d).agg(F.max("onset_ms")).first()[0])
    out = out.select("uid", F.unix_millis("start").alias("start_ms"), "n_segments", "speech_ms", F.expr("end_us div 1000").alias("end_ms"))
    return out.where(F.col("end_ms") + 10_000 < last - 60_000).select("uid", "start_ms", "n_segments", "speech_ms")


def _fed(s, d, form, schema: str):
    """Segments arrive in five batches, up to 100 s out of order, each to a query that goes on where the last one was stopped; then rows without a label say that time has moved on."""
    rows = derive.vtc(s, d)
    late = F.col("onset_ms") + F.pmod(F.xxhash64("uid", "onset_ms", "label"), F.lit(100_000))
    last = rows.agg(F.max("offset_ms")).first()[0] or 0
    rows = rows.select("uid", "onset_ms", "offset_ms", "label", F.least(late * 5 / (last + 1), F.lit(4)).cast("int").alias("batch"))
    given, out, check = _folder(s, "segments"), _folder(s, "closed"), _folder(s, "closed-checkpoint")
    old = s.conf.get("spark.sql.streaming.stateStore.providerClass")
    s.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        for i in range(6):
            batch = rows.where(F.col("batch") == i).drop("batch") if i < 5 else s.createDataFrame([(-1, last + 10_000_000, None, None)], "uid long, onset_ms long, offset_ms long, label string")
            batch.write.mode("append").parquet(given)
            q = form(s.readStream.schema(batch.schema).parquet(given), "2 minutes").writeStream.format("parquet").option("path", out).option("checkpointLocation", check).trigger(availableNow=True).start()
            q.awaitTermination()
    finally:
        s.conf.set("spark.sql.streaming.stateStore.providerClass", old)
    return s.read.schema(schema).parquet(out)


_add("i02_closed_conversations", CONVS + " select uid, conv_idx, onset_ms, offset_ms, n_turns, is_multi_speaker, labels, n_transitions from convs")(lambda s, d: _fed(s, d, timed.live_conversations, timed.CONVERSATIONS))
_add("i03_live_turns", TURNS + " select uid, turn_idx, label, onset_ms, offset_ms, n_segments from turns")(lambda s, d: _fed(s, d, timed.live_turns, timed.TURNS))


@_add("i05_stream_semi_join", SQL + " select uid, onset_ms, label from vtc where uid in (select uid from dur where dur_ms > 4200000)")
def _semi(s, d):
    allowed = derive.durations(s, d).where("dur_ms > 4200000").select("uid")
    return _run(s, live.allowed_samples(_live_vtc(s, d), allowed, "uid").select("uid", "onset_ms", "label"), "semi")


# Extension points.
def _scored(batches):
    for pdf in batches:
        yield pdf.assign(score=(pdf.offset_ms - pdf.onset_ms) / 1000.0)[["uid", "onset_ms", "label", "score"]]


@_add("j01_scorer", SQL + " select uid, onset_ms, label, (offset_ms - onset_ms) / 1000.0::double as score, 'length' as scorer, '1' as version from vtc")
def _scorer(s, d):
    registry = extend.Registry()
    registry.register(extend.Scorer("length", "1", "uid long, onset_ms long, label string, score double", _scored))
    return registry.get("length").apply(derive.vtc(s, d))


def _loudness(clips):
    return clips.select("uid", "clip_idx", (F.col("clip_idx") % 3).alias("loudness"), F.lit(-1).alias("onset_ms"))


_add("j02_clip_enricher", CLIPS + " select uid, clip_idx, onset_ms, offset_ms, clip_idx % 3 as loudness from clips")(lambda s, d: extend.enrich_clips(_fixed(s, d), [_loudness]))
_add("j03_extra_document", CLIPS + """ select uid, clip_idx, '{"uid":' || uid || ',"onset_ms":' || onset_ms || ',"clip_idx":' || clip_idx || '}' as doc from clips""")(
    lambda s, d: _fixed(s, d).select("uid", "clip_idx", extend.document(["uid", "onset_ms"], ["clip_idx", "uid"]).alias("doc"))
)
_add("j04_compose", CONVS + " select uid, conv_idx, n_turns from convs where n_turns > 2")(lambda s, d: extend.compose(sessions.turns, sessions.tag_conversations, sessions.conversations, lambda c: c.where("n_turns > 2").select("uid", "conv_idx", "n_turns"))(derive.vtc(s, d)))


@_add("j05_cached_transform", SQL + " select uid, dur_ms, dur_ms // 1000 as dur_s, 'seconds' as cache_name from dur")
def _cache(s, d):
    folder = _folder(s, "cache")
    rows = derive.durations(s, d)
    step = lambda df: df.select("uid", "dur_ms", F.expr("dur_ms div 1000").alias("dur_s"))
    extend.cached(s, rows.where("uid % 2 = 0"), step, folder, "seconds", "1", {"unit": 1000})
    return extend.cached(s, rows, step, folder, "seconds", "1", {"unit": 1000}).select("uid", "dur_ms", "dur_s", "cache_name")


@_add("j05_changed_source", SQL + " select uid, dur_ms, dur_ms // 1000 as dur_s, uid::varchar as source_id from (select uid, case when uid % 5 = 0 then dur_ms + 1000 else dur_ms end as dur_ms from dur where uid % 7 <> 0)")
def _changed(s, d):
    """Cached results after some rows of the source have changed and some keys are gone: what changed is computed anew, what is gone isn't returned."""
    folder, rows = _folder(s, "cache"), derive.durations(s, d)
    step = lambda df: df.select("uid", "dur_ms", F.expr("dur_ms div 1000").alias("dur_s"))
    extend.cached(s, rows, step, folder, "seconds", "1", {"unit": 1000})
    later = rows.where("uid % 7 <> 0").withColumn("dur_ms", F.when(F.col("uid") % 5 == 0, F.col("dur_ms") + 1000).otherwise(F.col("dur_ms")))
    return extend.cached(s, later, step, folder, "seconds", "1", {"unit": 1000}).select("uid", "dur_ms", "dur_s", "source_id")


@_add("j01_processor", SQL + " select uid, count(*) as n_segments, sum(offset_ms - onset_ms)::bigint as speech_ms from vtc group by uid")
def _processor(s, d):
    """A processor on some recordings, then on all: the second run takes only what is left."""
    rows, folder = derive.vtc(s, d), _folder(s, "processor")
    step = lambda df: df.groupBy("uid").agg(F.count("*").alias("n_segments"), F.sum(F.col("offset_ms") - F.col("onset_ms")).alias("speech_ms"))
    p = extend.Processor("speech", "1.0.0", step, F.col("speech_ms") > 0, "uid")
    p.run(rows.where("uid % 2 = 0"), folder)
    return p.run(rows, folder).select("uid", "n_segments", "speech_ms")
