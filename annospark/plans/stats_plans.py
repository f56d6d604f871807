"""Registered queries: clips, statistics, frames and windows."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from annospark.operators import explore, frames, intervals, kernels, sessions, slots, stats, summary, tiling
from annospark.functions.columns import rounded, rounded_sql
from annospark.sources import derive, tables
from annospark.sources.derive import FRAMES_SQL, LABELS, SQL, WINDOWS_SQL

from .agreement_plans import islands

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def _add(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return put


# Tiling: the choices are sequential, so the oracle makes one cut of each recording in each step of a recursion.
def _clips(s, d):
    return tiling.build_clips(derive.vtc(s, d), derive.vad(s, d), derive.durations(s, d))


def _invariants(s, d):
    c = _clips(s, d).join(derive.durations(s, d), "uid")
    inner = F.col("offset_ms") < F.col("dur_ms")
    return c.groupBy("uid").agg(
        F.sum(F.col("offset_ms") - F.col("onset_ms")).alias("covered_ms"), F.min("onset_ms").alias("first_ms"), F.max("offset_ms").alias("last_ms"),
        F.sum(F.when(inner & (F.col("offset_ms") % tiling.GRID_MS != 0), 1).otherwise(0)).alias("off_grid"), F.sum(F.when(F.col("offset_ms") - F.col("onset_ms") > 600_000 + 1_990, 1).otherwise(0)).alias("too_long"), F.sum(F.when(F.col("offset_ms") <= F.col("onset_ms"), 1).otherwise(0)).alias("empty"),
    )


def _nearest(gaps: str, least: int) -> str:
    """The middle of the gap nearest to `ideal` within lo and hi, ties to the longest, then the earliest."""
    inside = f"list_transform({gaps}, lambda g: {{'a': greatest(g.a::double, lo), 'b': least(g.b::double, hi)}})"
    ranked = f"list_transform(list_filter({inside}, lambda c: c.b > c.a and c.b - c.a >= {least}), lambda c: {{'d': abs((c.a + c.b) / 2 - ideal), 's': c.a - c.b, 'a': c.a, 'm': (c.a + c.b) / 2}})"
    return f"list_sort({ranked})[1].m"


def _free(name: str) -> str:
    """Lists of the free spans between the merged intervals of a table m_{name}."""
    return f""",
g_{name} as (select uid, lag(offset_ms, 1, 0) over (partition by uid order by onset_ms) as a, onset_ms as b from m_{name} union all select uid, max(offset_ms), any_value(dur_ms) from m_{name} join dur using (uid) group by uid
  union all select uid, 0, dur_ms from dur where uid not in (select uid from m_{name})),
l_{name} as materialized (select uid, list({{'a': a, 'b': b}}) as gaps_{name} from g_{name} where b > a group by uid)"""


_TILES = SQL.replace("with ev", "with recursive ev", 1) + ", un as (select uid, onset_ms, offset_ms from vtc union all select uid, onset_ms, offset_ms from vad)" + islands("vad", "uid", name="m_vad") + islands("vtc", "uid", name="m_vtc") + islands("un", "uid", name="m_un") + _free("un") + _free("vad") + _free("vtc") + f""",
l_end as (select uid, list(distinct at_ms) as ends from (select uid, unnest([onset_ms, offset_ms]) as at_ms from vtc) group by uid),
rec as materialized (select uid, dur_ms, gaps_un, gaps_vad, gaps_vtc, coalesce(ends, []) as ends from dur left join l_un using (uid) left join l_vad using (uid) left join l_vtc using (uid) left join l_end using (uid) where dur_ms > 0),
st as (select uid, 0 as k, 0::bigint as prev, '' as tier from rec union all
  select uid, k + 1, case when snapped <= prev then least(prev + 600000, dur_ms) else snapped end, tier from (
    select uid, k, prev, dur_ms, tier, greatest(0, least((round_even(cut / 3980.0::double, 0) * 3980)::bigint, dur_ms)) as snapped from (
      select *, case when lo >= hi then 'degenerate_window' when c1 is not null then 'long_union_gap' when c2 is not null then 'short_union_gap' when c3 is not null then 'vad_only_gap' when c4 is not null then 'vtc_only_gap' when c5 is not null then 'speaker_boundary' else 'hard_cut' end as tier,
        case when lo >= hi then least(prev + 600000, dur_ms)::double else coalesce(c1, c2, c3, c4, c5, least(ideal, prev + 600000)) end as cut from (
        select *, {_nearest("gaps_un", 10_000)} as c1, {_nearest("gaps_un", 0)} as c2, {_nearest("gaps_vad", 0)} as c3, {_nearest("gaps_vtc", 0)} as c4,
          list_sort(list_transform(list_filter(ends, lambda e: e > lo and e < hi), lambda e: {{'d': abs(e - ideal), 'm': abs(e - (lo + hi) / 2), 'e': e::double}}))[1].e as c5 from (
          select *, greatest(ideal - 120000, prev + 1000) as lo, least(ideal + 120000, prev + 600000, dur_ms - 1000)::double as hi from (
            select *, prev + (dur_ms - prev)::double / ceil((dur_ms - prev) / 600000.0::double) as ideal from (select st.uid, k, prev, dur_ms, gaps_un, gaps_vad, gaps_vtc, ends from st join rec using (uid) where dur_ms - prev > 600000))))))),
cuts as (select uid, k, prev as cut, tier from st join dur using (uid) where k > 0 and prev < dur_ms),
tiles as (select uid, k - 1 as clip_idx, lag(cut, 1, 0) over (partition by uid order by k) as onset_ms, cut as offset_ms, tier from cuts union all select uid, count(cut), coalesce(max(cut), 0), any_value(dur_ms), 'end' from rec left join cuts using (uid) group by uid)"""
_add("e17_tiling", _TILES + " select uid, clip_idx::bigint as clip_idx, onset_ms::bigint as onset_ms, offset_ms::bigint as offset_ms, tier from tiles")(_clips)
_add("e17_tiling_invariants", SQL + " select uid, dur_ms as covered_ms, 0::bigint as first_ms, dur_ms as last_ms, 0::bigint as off_grid, 0::bigint as too_long, 0::bigint as empty from dur")(_invariants)
_add("d45_tier_counts", _TILES + f" select t.tier, count(clip_idx) as n from unnest({list(tiling.TIERS)}) t(tier) left join tiles on tiles.tier = t.tier group by t.tier")(lambda s, d: tiling.tier_counts(_clips(s, d)))
_add("b18_snap_to_grid", SQL + " select uid, onset_ms, label, greatest(0, least(cast(round_even(onset_ms / 3980.0::double, 0) * 3980 as bigint), dur_ms)) as snapped_ms from vtc join dur using (uid)")(
    lambda s, d: derive.vtc(s, d).join(derive.durations(s, d), "uid").select("uid", "onset_ms", "label", tiling.snap_to_grid(F.col("onset_ms"), F.col("dur_ms")).alias("snapped_ms"))
)
CLIPS = SQL + """,
clips as (select uid, k as clip_idx, k * 600000 as onset_ms, least((k + 1) * 600000, dur_ms) as offset_ms from (select uid, dur_ms, unnest(range(0, (dur_ms - 1) // 600000 + 1)) as k from dur)),
seg as (select v.uid, clip_idx, greatest(v.onset_ms, c.onset_ms) as onset_ms, least(v.offset_ms, c.offset_ms) as offset_ms, label, greatest(v.onset_ms, c.onset_ms) - c.onset_ms as rel_on_ms, least(v.offset_ms, c.offset_ms) - c.onset_ms as rel_off_ms
  from vtc v join clips c on v.uid = c.uid and v.onset_ms < c.offset_ms and c.onset_ms < v.offset_ms),
vseg as (select v.uid, clip_idx, greatest(v.onset_ms, c.onset_ms) as onset_ms, least(v.offset_ms, c.offset_ms) as offset_ms from vad v join clips c on v.uid = c.uid and v.onset_ms < c.offset_ms and c.onset_ms < v.offset_ms)"""


def _fixed(s, d):
    return tiling.fixed_clips(derive.durations(s, d))


def _seg(s, d):
    return tiling.assign_segments(derive.vtc(s, d), _fixed(s, d))


def _vseg(s, d):
    return tiling.assign_segments(derive.vad(s, d), _fixed(s, d))


_add("c09_assign_segments", CLIPS + " select * from seg")(_seg)
_add("e15_silence_gaps", CLIPS + ", u as (select uid, clip_idx, onset_ms, offset_ms from seg union all select * from vseg)" + islands("u", "uid, clip_idx") + """,
ed as (select uid, clip_idx, onset_ms as win_on, offset_ms as win_off, null::bigint as on_ms, onset_ms as off_ms from clips union all select m.uid, m.clip_idx, c.onset_ms, c.offset_ms, m.onset_ms, m.offset_ms from m join clips c on m.uid = c.uid and m.clip_idx = c.clip_idx),
gp as (select uid, clip_idx, win_on, win_off, off_ms as gap_on, coalesce(lead(on_ms) over (partition by uid, clip_idx order by on_ms nulls first), win_off) as gap_off from ed)
select uid, clip_idx, win_on, win_off, gap_on, gap_off, row_number() over (partition by uid, clip_idx order by gap_off - gap_on desc, gap_on)::int as gap_rank from gp where gap_off > gap_on""")(
    lambda s, d: intervals.silence_gaps(intervals.activity_union(_seg(s, d), _vseg(s, d), ["uid", "clip_idx"]), _fixed(s, d).withColumnsRenamed({"onset_ms": "win_on", "offset_ms": "win_off"}), ["uid", "clip_idx"])
)
_add("e16_speaker_boundaries", CLIPS + """, bp as (select uid, clip_idx, onset_ms as win_on, offset_ms as win_off, (onset_ms + offset_ms) // 2 as point from clips), en as (select distinct uid, unnest([onset_ms, offset_ms]) as at_ms from vtc)
select b.uid, clip_idx, win_on, win_off, point, at_ms as "at", row_number() over (partition by b.uid, win_on, win_off order by abs(at_ms - point), abs(2 * at_ms - win_on - win_off), at_ms)::int as near_rank from bp b join en on b.uid = en.uid and at_ms > win_on and at_ms < win_off""")(
    lambda s, d: intervals.boundaries_near(derive.vtc(s, d), _fixed(s, d).selectExpr("uid", "clip_idx", "onset_ms as win_on", "offset_ms as win_off", "(onset_ms + offset_ms) div 2 as point"))
)
_add("d01_duration_summary", SQL + " select uid, label, max(offset_ms - onset_ms) as max_ms, min(offset_ms - onset_ms) as min_ms, sum(offset_ms - onset_ms)::bigint as sum_ms, count(*) as num, avg(offset_ms - onset_ms) as avg_ms from vtc group by uid, label")(
    lambda s, d: stats.duration_summary(derive.vtc(s, d), ["uid", "label"])
)
_add("d03_file_metadata", SQL + ", p as (select uid, label, count(*) as n, sum(offset_ms - onset_ms) as ms from vtc group by uid, label), g as (select uid, sum(n)::bigint as n_segments, sum(ms)::bigint as speech_ms, '{' || string_agg('\"' || label || '\":' || n, ',' order by label) || '}' as label_counts from p group by uid) select dur.uid, coalesce(n_segments, 0) as n_segments, coalesce(speech_ms, 0) as speech_ms, coalesce(label_counts, '{}') as label_counts from dur left join g using (uid)")(
    lambda s, d: stats.file_metadata(derive.vtc(s, d), derive.durations(s, d)).withColumn("label_counts", F.to_json("label_counts"))
)
_SP = CLIPS + """,
sg as (select *, onset_ms - lag(offset_ms) over (partition by uid, clip_idx order by onset_ms, label, offset_ms) as gap_ms, case when label <> lag(label) over (partition by uid, clip_idx order by onset_ms, label, offset_ms) then 1 else 0 end as swap from seg),
sp as (select uid, clip_idx, sum(offset_ms - onset_ms)::bigint as speech_ms, count(*) as n_segments, avg(offset_ms - onset_ms) as mean_segment_ms, avg(case when gap_ms > 0 then gap_ms end) as mean_gap_ms from sg group by uid, clip_idx),
lb as (select uid, clip_idx, string_agg(distinct label, ';' order by label) as labels, count(distinct label) as n_labels, bool_or(label in ('FEM', 'MAL')) as has_adult, """ + ", ".join(
    f"sum(case when label = '{x}' then offset_ms - onset_ms else 0 end)::bigint as dur_{x.lower()}_ms" for x in LABELS
) + """, sum(case when label in ('KCHI', 'OCH') then offset_ms - onset_ms else 0 end)::bigint as child_ms, sum(case when label in ('FEM', 'MAL') then offset_ms - onset_ms else 0 end)::bigint as adult_ms from seg group by uid, clip_idx),
lab as (select *, coalesce(child_ms::double / nullif(child_ms + adult_ms, 0), 0) as child_fraction from lb),
dm0 as (select uid, clip_idx, label, sum(offset_ms - onset_ms) as ms, min(onset_ms) as first from seg group by uid, clip_idx, label),
dm as (select uid, clip_idx, label as dominant_label from (select *, row_number() over (partition by uid, clip_idx order by ms desc, first, label) as rn from dm0) where rn = 1),
ch as (select uid, clip_idx, (sum(swap) + 1)::bigint as n_turns from sg group by uid, clip_idx)"""
_add("d08_clip_speech", _SP + " select * from sp")(lambda s, d: stats.clip_speech(_seg(s, d)))
_add("d09_clip_labels", _SP + " select * from lab")(lambda s, d: stats.clip_labels(_seg(s, d)))
_add("d10_dominant_label", _SP + " select * from dm")(lambda s, d: stats.dominant_label(_seg(s, d)))
_add("d11_label_changes", _SP + " select * from ch")(lambda s, d: stats.label_changes(_seg(s, d)))
_FI = _SP + """,
ga as (select * from (select uid, clip_idx, onset_ms // 100 as onset_ms, offset_ms // 100 as offset_ms from vseg) where offset_ms > onset_ms), gb as (select * from (select uid, clip_idx, onset_ms // 100 as onset_ms, offset_ms // 100 as offset_ms from seg) where offset_ms > onset_ms)""" + islands("ga", "uid, clip_idx", name="fa") + islands("gb", "uid, clip_idx", name="fb") + """,
fo as (select fa.uid, fa.clip_idx, sum(least(fa.offset_ms, fb.offset_ms) - greatest(fa.onset_ms, fb.onset_ms)) as both_n from fa join fb on fa.uid = fb.uid and fa.clip_idx = fb.clip_idx and fa.onset_ms < fb.offset_ms and fb.onset_ms < fa.offset_ms group by fa.uid, fa.clip_idx),
fx as (select uid, clip_idx, sum(offset_ms - onset_ms) as a from fa group by uid, clip_idx), fy as (select uid, clip_idx, sum(offset_ms - onset_ms) as b from fb group by uid, clip_idx),
fi as (select uid, clip_idx, coalesce(both_n, 0)::double / (coalesce(a, 0) + coalesce(b, 0) - coalesce(both_n, 0)) as frame_iou from fx full join fy using (uid, clip_idx) left join fo using (uid, clip_idx))"""
_add("d12_frame_iou", _FI + " select * from fi")(lambda s, d: stats.frame_iou(_vseg(s, d), _seg(s, d)))
_add("c11_coverage_by_label", CLIPS + islands("vseg", "uid, clip_idx", name="cv") + """,
bo as (select g.uid, g.clip_idx, g.label, sum(least(g.offset_ms, cv.offset_ms) - greatest(g.onset_ms, cv.onset_ms)) as both_ms from seg g join cv on g.uid = cv.uid and g.clip_idx = cv.clip_idx and g.onset_ms < cv.offset_ms and cv.onset_ms < g.offset_ms group by g.uid, g.clip_idx, g.label),
al as (select uid, clip_idx, label, sum(offset_ms - onset_ms) as ms from seg group by uid, clip_idx, label)
select uid, clip_idx, label, least(1.0::double, coalesce(both_ms, 0)::double / ms) as coverage from al left join bo using (uid, clip_idx, label)""")(lambda s, d: stats.coverage_by_label(_seg(s, d), _vseg(s, d)))

# Frame values of segments; every later statistic rounds the same way as the last step.
_SNR = FRAMES_SQL + """,
sv as (select v.uid, v.onset_ms, v.offset_ms, v.label, avg(f.snr) as snr, avg(f.c50) as c50 from vtc v left join frames f on f.uid = v.uid and f.i >= v.onset_ms // 1000 and f.i < (v.offset_ms + 999) // 1000 group by v.uid, v.onset_ms, v.offset_ms, v.label)"""


def _snr(s, d):
    return kernels.segment_means(derive.vtc(s, d), derive.frame_arrays(s, d))


_add("c10_segment_snr", SQL + _SNR + f" select uid, onset_ms, offset_ms, label, {rounded_sql('snr', 2)} as snr, {rounded_sql('c50', 2)} as c50 from sv")(lambda s, d: _snr(s, d).withColumns({"snr": rounded(F.col("snr"), 2), "c50": rounded(F.col("c50"), 2)}))
_VAL = CLIPS + _SNR + f""",
val as (select g.uid, g.clip_idx, g.onset_ms, g.offset_ms, g.label, {rounded_sql("sv.snr", 1)} as snr, {rounded_sql("sv.c50", 1)} as c50 from seg g left join sv on g.uid = sv.uid and g.onset_ms = sv.onset_ms and g.offset_ms = sv.offset_ms and g.label = sv.label)"""


def _val(s, d):
    """Segments by clip with snr and c50: several statistics read them, so they are written once, dealt by clip as all of these group them."""
    tables.checkpoint_ready(s)
    return stats.join_segment_snr(_seg(s, d).drop("rel_on_ms", "rel_off_ms"), _snr(s, d)).repartition(*stats.CLIP).checkpoint()


def _both(s, d):
    val = _val(s, d)
    return val.drop("snr", "c50"), val


_add("c03_segment_stats", _VAL + " select * from val")(_val)
_TURNC = _VAL + """,
t1 as (select *, case when label = lag(label) over (partition by uid, clip_idx order by onset_ms, label, offset_ms) then 0 else 1 end as swap from val),
t2 as (select *, sum(swap) over (partition by uid, clip_idx order by onset_ms, label, offset_ms range between unbounded preceding and current row) as lr from t1),
t3 as (select *, case when onset_ms - max(offset_ms) over (partition by uid, clip_idx, lr order by onset_ms, label, offset_ms rows between unbounded preceding and 1 preceding) <= 300 then 0 else 1 end as fresh from t2),
t4 as (select *, sum(fresh) over (partition by uid, clip_idx order by onset_ms, label, offset_ms range between unbounded preceding and current row) - 1 as turn_idx from t3),
turns as (select uid, clip_idx, turn_idx::bigint as turn_idx, min(label) as label, min(onset_ms) as onset_ms, max(offset_ms) as offset_ms, count(*) as n_segments from t4 group by uid, clip_idx, turn_idx),
c1 as (select *, case when onset_ms - lag(offset_ms) over (partition by uid, clip_idx order by turn_idx) < 10000 then 0 else 1 end as fresh from turns),
tc as (select *, (sum(fresh) over (partition by uid, clip_idx order by turn_idx rows between unbounded preceding and current row) - 1)::bigint as conv_idx from c1),
c2 as (select *, case when label <> lag(label) over (partition by uid, clip_idx, conv_idx order by turn_idx) then 1 else 0 end as swap from tc),
c3 as (select uid, clip_idx, conv_idx, min(onset_ms) as onset_ms, arg_max(offset_ms, turn_idx) as offset_ms, count(*) as n_turns, count(distinct label) > 1 as is_multi_speaker, string_agg(distinct label, ';' order by label) as labels, sum(swap)::bigint as n_transitions from c2 group by uid, clip_idx, conv_idx),
convs as (select *, lead(onset_ms) over (partition by uid, clip_idx order by conv_idx) - offset_ms as gap_after_ms from c3),
ts as (select t.uid, t.clip_idx, t.turn_idx, t.label, t.onset_ms, t.offset_ms, t.n_segments, avg(v.snr) as snr_mean, avg(v.c50) as c50_mean from turns t left join val v on v.uid = t.uid and v.clip_idx = t.clip_idx and v.onset_ms >= t.onset_ms and v.offset_ms <= t.offset_ms group by all),
cs as (select t.uid, t.clip_idx, t.conv_idx, t.onset_ms, t.offset_ms, t.n_turns, t.is_multi_speaker, t.labels, t.n_transitions, t.gap_after_ms, avg(v.snr) as snr_mean, avg(v.c50) as c50_mean from convs t left join val v on v.uid = t.uid and v.clip_idx = t.clip_idx and v.onset_ms >= t.onset_ms and v.offset_ms <= t.offset_ms group by all)"""
_round = lambda df: df.withColumns({"snr_mean": rounded(F.col("snr_mean"), 4), "c50_mean": rounded(F.col("c50_mean"), 4)})
_add("d15_turn_stats", _TURNC + " select * replace (floor(snr_mean * 10000::double + 0.500001) / 10000::double as snr_mean, floor(c50_mean * 10000::double + 0.500001) / 10000::double as c50_mean) from ts")(lambda s, d: _round(stats.turn_stats(*_both(s, d))))
_add("d16_conversation_stats", _TURNC + " select * replace (floor(snr_mean * 10000::double + 0.500001) / 10000::double as snr_mean, floor(c50_mean * 10000::double + 0.500001) / 10000::double as c50_mean) from cs")(lambda s, d: _round(stats.conversation_stats(*_both(s, d))))
_add("c04_contained_means", _TURNC + " select uid, clip_idx, turn_idx, floor(snr_mean * 10000::double + 0.500001) / 10000::double as snr_mean from ts where snr_mean is not null")(lambda s, d: stats.turn_stats(*_both(s, d)).where("snr_mean is not null").select("uid", "clip_idx", "turn_idx", rounded(F.col("snr_mean"), 4).alias("snr_mean")))
_add("d17_transition_stats", _TURNC + """, r1 as (select *, lag(label) over w as from_label, onset_ms - lag(offset_ms) over w as gap_ms, lag(offset_ms - onset_ms) over w as from_ms, offset_ms - onset_ms as to_ms from tc window w as (partition by uid, clip_idx, conv_idx order by turn_idx))
select uid, clip_idx, conv_idx, turn_idx, from_label, label as to_label, gap_ms, from_ms, to_ms from r1 where from_label <> label""")(lambda s, d: sessions.transitions(sessions.tag_conversations(sessions.turns(_seg(s, d), stats.CLIP), stats.CLIP), stats.CLIP))
_add("d19_recomputed_conversations", _TURNC.replace("<= 300", "<= 600").replace("< 10000", "< 5000") + " select uid, clip_idx, conv_idx, onset_ms, offset_ms, n_turns, n_transitions from cs")(
    lambda s, d: stats.conversation_stats(*_both(s, d), turn_gap_ms=600, gap_ms=5_000).select("uid", "clip_idx", "conv_idx", "onset_ms", "offset_ms", "n_turns", "n_transitions")
)
_SC = """,
sc as (select uid, clip_idx, """ + ", ".join(f"{rounded_sql(f'{f}({c})', 1)} as {c}_{n}" for c in ("snr", "c50") for f, n in (("avg", "mean"), ("stddev_samp", "std"), ("min", "min"), ("max", "max"))) + " from val group by uid, clip_idx)"
_add("d14_snr_by_clip", _VAL + _SC + " select * from sc")(lambda s, d: stats.snr_by_clip(_val(s, d)))
_FULL = _TURNC + _FI[len(CLIPS):] + _SC + islands("vseg", "uid, clip_idx", name="va") + """,
vt as (select uid, clip_idx, sum(offset_ms - onset_ms)::bigint as vad_ms from va group by uid, clip_idx),
cv2 as (select uid, clip_idx, count(*) as n_conversations, sum(n_turns)::bigint as n_conv_turns, sum(is_multi_speaker::int)::bigint as n_multi_speaker from convs group by uid, clip_idx),
cstat as (select c.uid, c.clip_idx, c.onset_ms, c.offset_ms, coalesce(speech_ms, 0) as speech_ms, coalesce(n_segments, 0) as n_segments, mean_segment_ms, mean_gap_ms, labels, coalesce(n_labels, 0) as n_labels, has_adult,
""" + ", ".join(f"coalesce(dur_{x.lower()}_ms, 0) as dur_{x.lower()}_ms" for x in LABELS) + """, coalesce(child_ms, 0) as child_ms, coalesce(adult_ms, 0) as adult_ms, coalesce(child_fraction, 0) as child_fraction, dominant_label, coalesce(n_turns, 0) as n_turns, coalesce(vad_ms, 0) as vad_ms,
coalesce(frame_iou, 0) as frame_iou, coalesce(n_conversations, 0) as n_conversations, coalesce(n_conv_turns, 0) as n_conv_turns, coalesce(n_multi_speaker, 0) as n_multi_speaker, snr_mean, snr_std, snr_min, snr_max, c50_mean, c50_std, c50_min, c50_max,
coalesce(speech_ms, 0) / (c.offset_ms - c.onset_ms)::double as speech_density, coalesce(n_conv_turns, 0) * 60000.0::double / (c.offset_ms - c.onset_ms) as turns_per_min
from clips c left join sp using (uid, clip_idx) left join lab using (uid, clip_idx) left join dm using (uid, clip_idx) left join ch using (uid, clip_idx) left join vt using (uid, clip_idx) left join fi using (uid, clip_idx) left join cv2 using (uid, clip_idx) left join sc using (uid, clip_idx))"""


def _cstat(s, d, both=None):
    seg, val = both or _both(s, d)
    return stats.clip_stats(_fixed(s, d), seg, _vseg(s, d), val)


def _file_stats(s, d):
    both = _both(s, d)
    return stats.file_stats(_cstat(s, d, both), stats.conversation_stats(*both), stats.turn_stats(*both))


_add("d07_clip_stats", _FULL + " select * from cstat")(_cstat)
_FILE = _FULL + """,
fb0 as (select uid, count(*) as n_clips, sum(offset_ms - onset_ms)::bigint as total_ms, sum(speech_ms)::bigint as speech_ms, sum(vad_ms)::bigint as vad_ms, """ + ", ".join(f"sum(dur_{x.lower()}_ms)::bigint as dur_{x.lower()}_ms" for x in LABELS) + """, avg(snr_mean) as snr_mean, avg(c50_mean) as c50_mean from cstat group by uid),
ft as (select uid, count(*) as n_turns, avg(offset_ms - onset_ms) as mean_turn_ms from turns group by uid), fc as (select uid, count(*) as n_conversations, avg(offset_ms - onset_ms) as mean_conv_ms, avg(n_turns) as mean_turns_per_conv from convs group by uid)
select uid, n_clips, total_ms, speech_ms, vad_ms, """ + ", ".join(f"dur_{x.lower()}_ms" for x in LABELS) + """, floor(snr_mean * 10000::double + 0.500001) / 10000::double as snr_mean, floor(c50_mean * 10000::double + 0.500001) / 10000::double as c50_mean, speech_ms / total_ms::double as density, coalesce(n_turns, 0) as n_turns, mean_turn_ms, coalesce(n_conversations, 0) as n_conversations, mean_conv_ms, mean_turns_per_conv from fb0 left join ft using (uid) left join fc using (uid)"""
_add("d18_file_stats", _FILE)(lambda s, d: _round(_file_stats(s, d)))
_METRICS = ["speech_ms", "n_segments", "mean_segment_ms", "n_labels", "child_fraction", "n_turns", "vad_ms", "frame_iou", "n_conversations", "n_conv_turns", "snr_mean", "c50_mean", "speech_density"]
_CORR = _FULL + ", co as (" + " union all ".join(f"select '{a}' as a, '{b}' as b, corr({a}, {b}) as r from cstat" for a in _METRICS for b in _METRICS) + ")"
_add("d20_correlations", _CORR + " select a, b, round(r, 6) as r from co")(lambda s, d: stats.correlations(_cstat(s, d), _METRICS).withColumn("r", F.round("r", 6)))
_add("d21_strong_pairs", _CORR + " select a, b, round(r, 6) as r from co where a < b and abs(r) > 0.3 order by abs(r) desc, a, b limit 15")(lambda s, d: stats.strong_pairs(stats.correlations(_cstat(s, d), _METRICS)).withColumn("r", F.round("r", 6)))



def _figures(s, d):
    both = _both(s, d)
    seg, val = both
    tagged = sessions.tag_conversations(sessions.turns(seg, stats.CLIP), stats.CLIP)
    long = summary.long_table(_cstat(s, d, both), val, sessions.turns(seg, stats.CLIP), stats.conversation_stats(*both), sessions.transitions(tagged, stats.CLIP))
    return summary.figures(long.checkpoint())  # figures and medians both read it


_below = ", ".join(f"snr_below_{t}" for t in summary.SNR_BOUNDS)
_LONG = _FULL + """,
rx as (select *, lag(label) over w as from_label, onset_ms - lag(offset_ms) over w as gap_ms from tc window w as (partition by uid, clip_idx, conv_idx order by turn_idx)),
cl as (unpivot (select 'clips' as section, 'all' as label, (offset_ms - onset_ms) / 1000.0::double as duration_s, speech_ms / 1000.0::double as labelled_s, vad_ms / 1000.0::double as vad_s, frame_iou::double as iou, child_fraction::double as child_fraction, snr_mean::double as snr, c50_mean::double as c50, turns_per_min::double as turns_per_min,
""" + ", ".join(f"case when snr_mean < {t} then 1.0 when snr_mean is not null then 0.0 end::double as snr_below_{t}" for t in summary.SNR_BOUNDS) + f""" from cstat) on duration_s, labelled_s, vad_s, iou, child_fraction, snr, c50, turns_per_min, {_below} into name metric value value),
cv as (unpivot (select 'conversations' as section, 'all' as label, (offset_ms - onset_ms) / 1000.0::double as duration_s, n_turns::double as n_turns, is_multi_speaker::int::double as multi_speaker, gap_after_ms / 1000.0::double as gap_after_s, snr_mean::double as snr, c50_mean::double as c50 from cs) on duration_s, n_turns, multi_speaker, gap_after_s, snr, c50 into name metric value value),
lo as (select section, label, metric, value from cl union all select section, label, metric, value from cv
""" + " ".join(f"union all select 'speech', '{x}', 'speech_s', dur_{x.lower()}_ms / 1000.0::double from cstat" for x in LABELS) + """
union all select 'segments', label, 'length_s', (offset_ms - onset_ms) / 1000.0::double from val union all select 'segments', label, 'snr', snr from val
union all select 'turns', unnest(['all', label]), 'duration_s', (offset_ms - onset_ms) / 1000.0::double from turns
union all select 'transitions', unnest(['all', from_label || '>' || label]), 'gap_s', gap_ms / 1000.0::double from rx where from_label <> label),
fg as (select section, label, metric, count(*) as n, """ + ", ".join(f"{rounded_sql(f, 4)} as {n}" for n, f in (("total", "sum(value)"), ("mean", "avg(value)"), ("std", "stddev_pop(value)"), ("least", "min(value)"), ("greatest", "max(value)"), ("median", "quantile_cont(value, 0.5)"))) + " from lo where value is not null group by section, label, metric)"
_add("d34_all_figures", _LONG + " select * from fg")(_figures)
_add("d35_card", _LONG + " " + " union all ".join(f"select '{name}' as name, printf('%.{digits}f{unit}', {rounded_sql(f'({which} / {float(by)}::double)', digits)}) as text from fg where section = '{section}' and label = 'all' and metric = '{metric}'" for name, section, metric, which, by, digits, unit in summary.CARD))(lambda s, d: summary.card(_figures(s, d).checkpoint()))

# Frames.
_F = SQL + FRAMES_SQL
_RUNS = _F + """,
q1 as (select uid, i, vad > 0.5 as flag, case when (vad > 0.5) = lag(vad > 0.5) over (partition by uid order by i) then 0 else 1 end as nw from frames),
q2 as (select *, sum(nw) over (partition by uid order by i rows between unbounded preceding and current row) as run from q1),
runs as (select uid, any_value(flag) as flag, min(i) as first, max(i) + 1 as "end" from q2 group by uid, run)"""
_add("e06_runs", _RUNS + " select * from runs")(lambda s, d: intervals.runs(derive.frames(s, d), F.col("vad") > 0.5))
_add("e06_runs_by_slots", _RUNS + " select * from runs")(lambda s, d: slots.runs(derive.frames(s, d), F.col("vad") > 0.5, slot_frames=1000))
_add("e07_run_segments", _RUNS + ' select uid, first * 1000 as onset_ms, "end" * 1000 as offset_ms from runs where flag')(lambda s, d: intervals.run_segments(intervals.runs(derive.frames(s, d), F.col("vad") > 0.5), 1000))
_add("e08_threshold_segments", _F + """, sco as (select uid, unnest(['FEM', 'KCHI']) as label, i, unnest([vad, (snr + 5) / 40]) as score from frames),
q1 as (select *, score >= 0.6 as flag, case when (score >= 0.6) = lag(score >= 0.6) over (partition by uid, label order by i) then 0 else 1 end as nw from sco),
q2 as (select *, sum(nw) over (partition by uid, label order by i rows between unbounded preceding and current row) as run from q1)
select uid, label, min(i) * 1000 as onset_ms, (max(i) + 1) * 1000 as offset_ms from q2 where flag group by uid, label, run""")(
    lambda s, d: intervals.threshold_segments(derive.frames(s, d).selectExpr("uid", "i", "stack(2, 'FEM', vad, 'KCHI', (snr + 5D) / 40D) as (label, score)"), 0.6, 1000)
)
_add("d02_vad_metadata", _RUNS + ", rr as (select uid, flag, (\"end\" - first) * 1000 as ms from runs) select uid, " + ", ".join(f"coalesce({f}(case when {c} then ms end), 0)::bigint as {n}_{x}" for n, c in (("speech", "flag"), ("silence", "not flag")) for f, x in (("max", "max"), ("min", "min"), ("sum", "sum"), ("count", "num"))) + ", coalesce(avg(case when flag then ms end), 0) as speech_avg, coalesce(avg(case when not flag then ms end), 0) as silence_avg, coalesce(sum(case when flag then ms end), 0)::double / sum(ms) as speech_ratio, coalesce(max(case when flag then ms end), 0) >= 10000 as has_long_segment from rr group by uid")(
    lambda s, d: frames.run_metadata(kernels.runs(derive.frame_arrays(s, d), "vad", 0.5))
)
_six = lambda df: df.withColumns({c: F.round(c, 6) for c, t in df.dtypes if t == "double"})
_add("d04_snr_metadata", _F + " select uid, count(*) as n_frames, sum((vad > 0.5)::int)::bigint as n_speech, round(avg((vad > 0.5)::int::double), 6) as speech_fraction, " + ", ".join(f"round(coalesce({f}(case when vad > 0.5 then {c} end), {f}({c})), 6) as {c}_{n}" for c in ("snr", "c50") for f, n in (("avg", "mean"), ("stddev_pop", "std"), ("min", "min"), ("max", "max"))) + " from frames group by uid")(
    lambda s, d: _six(frames.snr_metadata(derive.frames(s, d)))
)
_add("d05_threshold_sweep", _F + ", th as (select unnest([0.5, 0.6, 0.7, 0.8, 0.9])::double as threshold) select uid, threshold, round(avg((vad > threshold)::int::double), 6) as speech_fraction, round(avg(case when vad > threshold then snr end), 6) as snr_mean, round(avg(case when vad > threshold then c50 end), 6) as c50_mean from frames, th group by uid, threshold")(
    lambda s, d: _six(frames.threshold_sweep(derive.frames(s, d)))
)
_add("d06_pool_frames", _F + " select uid, i // 60 as bin, round(avg(case when vad > 0.5 then snr end), 6) as snr, round(avg(case when vad > 0.5 then c50 end), 6) as c50 from frames group by uid, bin")(lambda s, d: _six(frames.pool_frames(derive.frames(s, d), 60, 0.5)))
_add("d46_sigmoid_summary", _F + " select uid, round(max(1 / (1 + exp(-snr))), 4) as max_sigmoid, round(avg(1 / (1 + exp(-snr))), 4) as mean_sigmoid from frames group by uid")(lambda s, d: frames.sigmoid_summary(derive.frames(s, d).withColumn("score", F.col("snr"))))

# Windows: 64 classes; the first four are speech, the others fall into seven categories and `other`.
_CATS = {f"cat{k}": [i for i in range(4, 64) if i % 8 == k] for k in range(7)}
_OLD = {f"cat{k}": [i for i in range(4, 64) if i % 16 == k] for k in range(7)}
_MAP = WINDOWS_SQL + """,
mp as (select 'new' as map, k::int as class_idx, case when k % 8 < 7 then 'cat' || (k % 8) else 'other' end as category from unnest(range(4, 64)) t(k) union all select 'old', k::int, case when k % 16 < 7 then 'cat' || (k % 16) else 'other' end from unnest(range(4, 64)) t(k)),
cat as (select map, uid, bin, category, max(prob) as prob from win join mp using (class_idx) group by map, uid, bin, category),
fm as (select map, uid, category, avg(prob) as mean_prob from cat group by map, uid, category)"""


def _maps(s):
    return frames.class_map(s, _CATS, 64, range(4), "new").unionByName(frames.class_map(s, _OLD, 64, range(4), "old"))


def _cats(s, d):
    return frames.categories(derive.windows(s, d), _maps(s))


_add("h02_categories", _MAP + " select * from cat")(_cats)
_add("h01_category_vector", _MAP + ", p as (pivot (select uid, bin, category, prob from cat where map = 'new' and category <> 'other') on category in ('cat0', 'cat1', 'cat2', 'cat3', 'cat4', 'cat5', 'cat6') using max(prob) group by uid, bin) select uid, bin, " + ", ".join(f"cat{k} as prob_cat{k}" for k in range(7)) + " from p")(
    lambda s, d: derive.table(s, d, "embeddings").selectExpr("label as uid", "cast(row_number() over (partition by label order by vec_id) - 1 as bigint) as bin", "transform(embedding, x -> abs(cast(x as double))) as probs").select("uid", "bin", *frames.category_vector(F.col("probs"), _CATS))
)
_add("h03_upsample", _MAP + " select uid, category, bin * 3 + k as bin, prob from cat, unnest([0, 1, 2]) t(k) where map = 'new'")(lambda s, d: frames.upsample(_cats(s, d).where("map = 'new'").select("uid", "category", F.col("bin").cast("long").alias("bin"), "prob"), 3))
_add("h04_fixed_windows", "select vec_id, w::bigint as win_idx, [coalesce(embedding[w * 20 + j + 1], 0) for j in range(20)]::varchar as samples from embeddings, unnest(range(0, 4)) t(w)")(
    lambda s, d: frames.fixed_windows(derive.table(s, d, "embeddings").selectExpr("vec_id", "embedding as samples"), 20).select("vec_id", "win_idx", F.expr("aggregate(samples, 0D, (a, x) -> a + cast(x as double))").alias("total"), F.size("samples").alias("n"))
)
ORACLE["h04_fixed_windows"] = "select vec_id, w::bigint as win_idx, coalesce(list_reduce([0::double] || list_transform(embedding[w * 20 + 1 : w * 20 + 20], lambda x: x::double), lambda a, x: a + x), 0) as total, 20 as n from embeddings, unnest(range(0, 4)) t(w)"
_add("d13_esc_profile", _MAP + " select uid, bin // 10 as clip_idx, category, round(avg(prob), 6) as mean_prob from cat where map = 'new' group by uid, clip_idx, category")(
    lambda s, d: _six(_cats(s, d).where("map = 'new'").groupBy("uid", F.floor(F.col("bin") / 10).alias("clip_idx"), "category").agg(F.avg("prob").alias("mean_prob")))
)
_add("d29_class_stats", _MAP + """, rk as (select *, case when class_idx < 4 then 0 else prob end as p from win), rk2 as (select *, row_number() over (partition by uid, bin order by p desc, class_idx) <= 10 as top from rk)
select class_idx, round(sum(p) * 10, 6) as pw_seconds, round(avg(p), 6) as mean_prob, round(avg(top::int::double), 6) as top_rate from rk2 group by class_idx""")(lambda s, d: _six(frames.class_stats(derive.windows(s, d), 10.0, range(4))))
_add("d30_category_stats", _MAP + " select map, category, round(sum(prob) * 10 / 3600, 6) as pw_hours, round(avg(prob), 6) as mean_prob, round(avg((prob > 0.1)::int::double), 6) as active_rate from cat group by map, category")(lambda s, d: _six(frames.category_stats(_cats(s, d), 10.0)))
_DOM = _MAP + ", dn as (select map, uid, category as dominant_category, mean_prob as dominant_prob from (select *, row_number() over (partition by map, uid order by mean_prob desc, category) as rn from fm) where rn = 1)"
_add("d31_dominant_and_top", _DOM + """, mc as (select uid, class_idx, avg(prob) as m from win group by uid, class_idx), tp as (select uid, '[' || string_agg(class_idx, ',' order by rn) || ']' as top_classes from (select *, row_number() over (partition by uid order by m desc, class_idx) as rn from mc) where rn <= 10 group by uid)
select map, uid, dominant_category, round(dominant_prob, 6) as dominant_prob, top_classes from dn join tp using (uid)""")(lambda s, d: _six(frames.dominant(frames.file_categories(_cats(s, d))).join(frames.top_classes(derive.windows(s, d)), "uid")))
_add("d33_esc_metadata", _DOM + ", p as (pivot (select uid, category, mean_prob from fm where map = 'new') on category in (" + ", ".join(f"'{c}'" for c in [*_CATS, "other"]) + ") using max(mean_prob) group by uid) select uid, " + ", ".join(f"round({c}, 6) as prob_{c}" for c in [*_CATS, "other"]) + ", dominant_category, round(dominant_prob, 6) as dominant_prob from p join (select * from dn where map = 'new') using (uid)")(
    lambda s, d: _six(frames.esc_metadata(frames.file_categories(_cats(s, d).where("map = 'new'")).drop("map"), [*_CATS, "other"]))
)
_add("c14_window_slices", _MAP + ", cl as (select uid, b as clip_idx, unnest(range(b * 600000 // 10000, ((b + 1) * 600000 + 9999) // 10000)) as bin from (select distinct uid, bin * 10000 // 600000 as b from cat)) select uid, clip_idx, category, count(*) as n_bins from cl join (select * from cat where map = 'new') using (uid, bin) group by uid, clip_idx, category")(
    lambda s, d: frames.slice_of_clip(_cats(s, d).where("map = 'new'"), _cats(s, d).selectExpr("uid", "bin * 10000L div 600000 as clip_idx").distinct().selectExpr("uid", "clip_idx", "clip_idx * 600000 as onset_ms", "(clip_idx + 1) * 600000 as offset_ms"), 10_000).groupBy("uid", "clip_idx", "category").agg(F.count("*").alias("n_bins"))
)
_add("d32_dataset_summary", _MAP + ", h as (select category, sum(prob) * 10 / 3600 as hours from cat where map = 'new' group by category) select (select count(distinct uid) from win) as n_files, (select count(*) from (select distinct uid, bin from win)) as n_windows, (select string_agg(category, ';' order by hours desc, category) from (select * from h order by hours desc, category limit 5)) as top5, round((select hours from h where category = 'other'), 6) as other_hours")(
    lambda s, d: _six(explore.dataset_summary(derive.windows(s, d), _cats(s, d).where("map = 'new'"), 10.0))
)
_add("f03_top_classes", _MAP + " select class_idx, round(sum(prob) * 10, 6) as pw_seconds from win where class_idx >= 4 group by class_idx order by sum(prob) desc, class_idx limit 50")(
    lambda s, d: _six(derive.windows(s, d).where("class_idx >= 4").groupBy("class_idx").agg((F.sum("prob") * 10.0).alias("pw_seconds")).orderBy(F.desc("pw_seconds"), "class_idx").limit(50))
)
_add("f03_top_by_metric", _MAP + """, rk as (select *, case when class_idx < 4 then 0 else prob end as p from win), rk2 as (select *, row_number() over (partition by uid, bin order by p desc, class_idx) <= 10 as top from rk),
cs as (select class_idx, sum(p) * 10 as pw_seconds, avg(p) as mean_prob, avg(top::int::double) as top_rate from rk2 where class_idx >= 4 group by class_idx),
rw as (select 'pw_seconds' as metric, class_idx, pw_seconds as value, 50 as most from cs union all select 'mean_prob', class_idx, mean_prob, 50 from cs union all select 'top_rate', class_idx, top_rate, 50 from cs
  union all select 'old_other', class_idx, pw_seconds, 30 from cs join mp using (class_idx) where map = 'old' and category = 'other'),
z as (select *, row_number() over (partition by metric order by value desc, class_idx) as rank from rw) select metric, rank, class_idx, round(value, 6) as value from z where rank <= most""")(lambda s, d: _six(_top_by_metric(s, d)))


def _top_by_metric(s, d):
    rows = frames.class_stats(derive.windows(s, d), 10.0, range(4)).where("class_idx >= 4")
    other = rows.join(_maps(s).where("map = 'old' and category = 'other'").select("class_idx"), "class_idx").select("class_idx", F.lit("old_other").alias("metric"), F.col("pw_seconds").alias("value"))
    ranked = rows.unpivot(["class_idx"], ["pw_seconds", "mean_prob", "top_rate"], "metric", "value").unionByName(other)
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("metric").orderBy(F.desc("value"), "class_idx")))  # a row for each class
    return ranked.where(F.col("rank") <= F.when(F.col("metric") == "old_other", 30).otherwise(50)).select("metric", "rank", "class_idx", "value")


_add("f04_category_shares", _MAP + " select category, round(sum(prob) * 10 / 3600, 6) as hours, round(100 * sum(prob) / sum(sum(prob)) over (), 6) as share_pct from cat where map = 'new' group by category")(
    lambda s, d: _six(explore.shares(_cats(s, d).where("map = 'new'").groupBy("category").agg((F.sum("prob") * 10.0 / 3600).alias("hours")), "hours"))
)
_add("f05_top_in_window", _MAP + " select uid, bin, list(class_idx order by prob desc, class_idx)[1:3]::varchar as top from win group by uid, bin")(
    lambda s, d: derive.windows(s, d).groupBy("uid", "bin").agg(F.concat(F.lit("["), F.array_join(F.transform(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("prob")).alias("k"), "class_idx"))), 1, 3), lambda x: x["class_idx"].cast("string")), ", "), F.lit("]")).alias("top"))
)
