"""Registered queries: interval algebra, agreement, turns and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from annospark.functions.columns import rounded_sql
from annospark.operators import agreement, explore, intervals, sessions, slots
from annospark.sources import derive
from annospark.sources.derive import SQL

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def _add(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return put


def islands(source: str, keys: str, collar: int = 0, least: int = 0, name: str = "m") -> str:
    """CTE text of merged intervals."""
    return f""",
{name}_a as (select {keys}, onset_ms, offset_ms, case when onset_ms > max(offset_ms) over (partition by {keys} order by onset_ms, offset_ms rows between unbounded preceding and 1 preceding) + {collar} then 1 else 0 end as fresh from {source}),
{name}_b as (select *, sum(fresh) over (partition by {keys} order by onset_ms, offset_ms range between unbounded preceding and current row) as island from {name}_a),
{name} as (select {keys}, min(onset_ms) as onset_ms, max(offset_ms) as offset_ms from {name}_b group by {keys}, island having max(offset_ms) - min(onset_ms) >= {least})"""


_add("e01_merge_pairs", SQL + islands("vad", "uid") + " select * from m")(lambda s, d: intervals.merge(derive.vad(s, d)))
_add("e02_merge_vad", SQL + islands("vad", "uid", 100, 100) + " select *, (offset_ms - onset_ms) / 1000.0::double as duration from m")(
    lambda s, d: intervals.merge(derive.vad(s, d), ["uid"], 100, 100).withColumn("duration", (F.col("offset_ms") - F.col("onset_ms")) / F.lit(1000.0))
)
_add("e02_merge_by_slots", SQL + islands("vad", "uid", 1) + " select uid, onset_ms, offset_ms from m")(lambda s, d: slots.merge(derive.vad(s, d), ["uid"], 1))
_add("e02_merge_vtc", SQL + islands("vtc", "uid, label", 300, 300) + " select *, (offset_ms - onset_ms) / 1000.0::double as duration from m")(
    lambda s, d: intervals.merge(derive.vtc(s, d), ["uid", "label"], 300, 300).withColumn("duration", (F.col("offset_ms") - F.col("onset_ms")) / F.lit(1000.0))
)
_add("e03_merge_tolerance", SQL + islands("vad", "uid", 1) + " select * from m")(lambda s, d: intervals.merge(derive.vad(s, d), ["uid"], 1))
_add("e04_activity_union", SQL + ", u as (select uid, onset_ms, offset_ms from vtc union all select uid, onset_ms, offset_ms from vad)" + islands("u", "uid") + " select * from m")(
    lambda s, d: intervals.activity_union(derive.vtc(s, d), derive.vad(s, d))
)
_add("e05_count_overlaps", SQL + ", l as (select uid, onset_ms < lag(offset_ms) over (partition by uid order by onset_ms, offset_ms) as early from vad) select uid, sum(case when early then 1 else 0 end)::bigint as n_overlaps from l group by uid")(
    lambda s, d: intervals.count_overlaps(derive.vad(s, d))
)
_add("e18_total_duration", SQL + " select uid, label, sum(offset_ms - onset_ms)::bigint as total_ms from vtc group by uid, label")(lambda s, d: intervals.total(derive.vtc(s, d), ["uid", "label"]))

_BOTH = SQL + islands("vad", "uid", name="a") + islands("vtc", "uid", name="b") + """,
o as (select a.uid, sum(least(a.offset_ms, b.offset_ms) - greatest(a.onset_ms, b.onset_ms))::bigint as both_ms from a join b on a.uid = b.uid and a.onset_ms < b.offset_ms and b.onset_ms < a.offset_ms group by a.uid),
x as (select uid, sum(offset_ms - onset_ms)::bigint as a_ms from a group by uid), y as (select uid, sum(offset_ms - onset_ms)::bigint as b_ms from b group by uid)"""
_add("c05_overlap_join", _BOTH + " select * from o")(lambda s, d: intervals.overlap_ms(intervals.merge(derive.vad(s, d)), intervals.merge(derive.vtc(s, d))))
_add("e19_iou", _BOTH + """ select uid, coalesce(a_ms, 0) as a_ms, coalesce(b_ms, 0) as b_ms, coalesce(both_ms, 0) as both_ms,
coalesce(coalesce(both_ms, 0)::double / nullif(coalesce(a_ms, 0) + coalesce(b_ms, 0) - coalesce(both_ms, 0), 0), 1) as iou from x full join y using (uid) left join o using (uid)""")(
    lambda s, d: intervals.iou(derive.vad(s, d), derive.vtc(s, d))
)
_AGREE = _BOTH + """,
ag as (select uid, coalesce(a_ms, 0) as vad_ms, coalesce(b_ms, 0) as vtc_ms, coalesce(both_ms, 0) as tp_ms, dur_ms from x full join y using (uid) left join o using (uid) left join dur using (uid)),
ag2 as (select *, vtc_ms - tp_ms as fp_ms, vad_ms - tp_ms as fn_ms from ag),
ag3 as (select *, tp_ms::double / nullif(tp_ms + fp_ms + fn_ms, 0) as iou, tp_ms::double / nullif(tp_ms + fp_ms, 0) as precision, tp_ms::double / nullif(tp_ms + fn_ms, 0) as recall from ag2)"""


def _agree(s, d):
    return agreement.agreement(derive.vad(s, d), derive.vtc(s, d), derive.durations(s, d))


_add("c06_agreement", _AGREE + " select * from ag3")(_agree)
_add("d22_global_agreement", _AGREE + """ select sum(tp_ms)::bigint as tp_ms, sum(fp_ms)::bigint as fp_ms, sum(fn_ms)::bigint as fn_ms, sum(tp_ms)::double / nullif(sum(tp_ms + fp_ms + fn_ms), 0) as iou,
sum(tp_ms)::double / nullif(sum(tp_ms + fp_ms), 0) as precision, sum(tp_ms)::double / nullif(sum(tp_ms + fn_ms), 0) as recall, sum(case when iou >= 0.9 then 1 else 0 end)::bigint as n_high, sum(case when iou < 0.5 then 1 else 0 end)::bigint as n_low from ag3""")(
    lambda s, d: agreement.global_agreement(_agree(s, d))
)
_add("b14_low_agreement", _AGREE + """, n as (select uid, count(*) as n_segments from vtc group by uid)
select ag3.uid, iou, coalesce(n_segments, 0) as n_segments, case when vtc_ms = 0 then 'silent' when vtc_ms < 0.5 * vad_ms then 'under' when vtc_ms > 2 * vad_ms then 'over' else 'moderate' end as category
from ag3 left join n using (uid) where coalesce(iou, 0) < 0.8""")(lambda s, d: agreement.diagnose(_agree(s, d), derive.vtc(s, d), 0.8))
_add("c15_enriched_agreement", _AGREE + """, t as (select uid, label, count(*) as n, max(offset_ms - onset_ms) as longest from vtc group by uid, label), g as (select uid, sum(n)::bigint as n_segments, max(longest) as longest_ms from t group by uid)
select uid, iou, dur_ms, coalesce(n_segments, 0) as n_segments, longest_ms, 0.5::double as vtc_threshold from ag3 left join g using (uid)""")(
    lambda s, d: agreement.enrich(_agree(s, d), derive.vtc(s, d), 0.5)
)

# Turns and conversations.
TURNS = SQL + """,
t1 as (select *, case when label = lag(label) over (partition by uid order by onset_ms, label, offset_ms) then 0 else 1 end as swap from vtc),
t2 as (select *, sum(swap) over (partition by uid order by onset_ms, label, offset_ms range between unbounded preceding and current row) as lr from t1),
t3 as (select *, case when onset_ms - max(offset_ms) over (partition by uid, lr order by onset_ms, label, offset_ms rows between unbounded preceding and 1 preceding) <= 300 then 0 else 1 end as fresh from t2),
t4 as (select *, sum(fresh) over (partition by uid order by onset_ms, label, offset_ms range between unbounded preceding and current row) - 1 as turn_idx from t3),
turns as (select uid, turn_idx::bigint as turn_idx, min(label) as label, min(onset_ms) as onset_ms, max(offset_ms) as offset_ms, count(*) as n_segments from t4 group by uid, turn_idx)"""
CONVS = TURNS + """,
c1 as (select *, case when onset_ms - lag(offset_ms) over (partition by uid order by turn_idx) < 10000 then 0 else 1 end as fresh from turns),
tc as (select uid, turn_idx, label, onset_ms, offset_ms, n_segments, (sum(fresh) over (partition by uid order by turn_idx rows between unbounded preceding and current row) - 1)::bigint as conv_idx from c1),
c2 as (select *, case when label <> lag(label) over (partition by uid, conv_idx order by turn_idx) then 1 else 0 end as swap from tc),
c3 as (select uid, conv_idx, min(onset_ms) as onset_ms, arg_max(offset_ms, turn_idx) as offset_ms, count(*) as n_turns, count(distinct label) > 1 as is_multi_speaker, string_agg(distinct label, ';' order by label) as labels, sum(swap)::bigint as n_transitions from c2 group by uid, conv_idx),
convs as (select *, lead(onset_ms) over (partition by uid order by conv_idx) - offset_ms as gap_after_ms from c3)"""
TRANS = CONVS + """,
r1 as (select *, lag(label) over w as from_label, onset_ms - lag(offset_ms) over w as gap_ms, lag(offset_ms - onset_ms) over w as from_ms, offset_ms - onset_ms as to_ms from tc window w as (partition by uid, conv_idx order by turn_idx)),
trans as (select uid, conv_idx, turn_idx, from_label, label as to_label, gap_ms, from_ms, to_ms from r1 where from_label <> label)"""


def _turns(s, d):
    return sessions.turns(derive.vtc(s, d))


def _tagged(s, d):
    return sessions.tag_conversations(_turns(s, d))


_add("e09_turns", TURNS + " select * from turns")(_turns)
_add("e10_conversations", CONVS + " select * from convs")(lambda s, d: sessions.conversations(_tagged(s, d)))
_add("e09_turns_by_slots", TURNS + " select * from turns")(lambda s, d: slots.turns(derive.vtc(s, d)))
_add("e10_tags_by_slots", CONVS + " select uid, turn_idx, label, onset_ms, offset_ms, n_segments, conv_idx from tc")(lambda s, d: slots.tag_conversations(slots.turns(derive.vtc(s, d))))
_add("e11_transitions", TRANS + " select * from trans")(lambda s, d: sessions.transitions(_tagged(s, d)))
_add("e12_inter_turn_gaps", TRANS + " select uid, conv_idx, turn_idx, gap_ms from r1 where gap_ms is not null")(lambda s, d: sessions.turn_gaps(_tagged(s, d)))
_add("e13_inter_conversation_gaps", CONVS + " select uid, conv_idx, gap_after_ms from convs where gap_after_ms is not null")(
    lambda s, d: sessions.conversations(_tagged(s, d)).where("gap_after_ms is not null").select("uid", "conv_idx", "gap_after_ms")
)
_add("e14_bouts", CONVS + """, b1 as (select *, case when label <> lag(label) over (partition by uid, conv_idx order by turn_idx) then 0 else 1 end as nb from tc),
b2 as (select *, (sum(nb) over (partition by uid, conv_idx order by turn_idx rows between unbounded preceding and current row) - 1)::bigint as bout_idx from b1)
select uid, conv_idx, bout_idx, min(onset_ms) as onset_ms, max(offset_ms) as offset_ms, count(*) as n_turns from b2 group by uid, conv_idx, bout_idx having count(*) >= 2""")(lambda s, d: sessions.bouts(_tagged(s, d)))
_add("d37_conversation_kinds", CONVS + " select is_multi_speaker, count(*) as n, sum(offset_ms - onset_ms) / 3600000.0::double as hours from convs group by is_multi_speaker")(
    lambda s, d: sessions.conversations(_tagged(s, d)).groupBy("is_multi_speaker").agg(F.count("*").alias("n"), (F.sum(F.col("offset_ms") - F.col("onset_ms")) / F.lit(3600000.0)).alias("hours"))
)
_add("f02_top_transitions", TRANS + " select from_label, to_label, count(*) as n, quantile_cont(gap_ms, 0.5)::double as gap_median, avg(gap_ms)::double as gap_mean from trans group by from_label, to_label order by n desc, from_label, to_label limit 10")(
    lambda s, d: explore.transition_counts(sessions.transitions(_tagged(s, d)), 10)
)

# Alignment of two annotators of the same kind: all segments against those that lie in the first 600 s of every 1,200 s.
_PART = ", part as (select * from vtc where onset_ms % 1200000 < 600000)"


def _part(s, d):
    return derive.vtc(s, d).where("onset_ms % 1200000 < 600000")


_MATCH = SQL + _PART + """, pr as (select f.uid, f.label, f.onset_ms, f.offset_ms, p.onset_ms as b_onset_ms, p.offset_ms as b_offset_ms,
(least(f.offset_ms, p.offset_ms + 200) - greatest(f.onset_ms, p.onset_ms + 200))::double / (greatest(f.offset_ms, p.offset_ms + 200) - least(f.onset_ms, p.onset_ms + 200)) as iou
from vtc f join part p on f.uid = p.uid and f.label = p.label and f.onset_ms < p.offset_ms + 200 and p.onset_ms + 200 < f.offset_ms),
rk as (select *, row_number() over (partition by uid, label, onset_ms, offset_ms order by iou desc, b_onset_ms, b_offset_ms) as rn from pr),
mt as (select vtc.uid, vtc.label, vtc.onset_ms, vtc.offset_ms, iou, abs(vtc.onset_ms - (b_onset_ms + 200)) as onset_err_ms, abs(vtc.offset_ms - (b_offset_ms + 200)) as offset_err_ms
from vtc left join (select * from rk where rn = 1) r on vtc.uid = r.uid and vtc.label = r.label and vtc.onset_ms = r.onset_ms and vtc.offset_ms = r.offset_ms),
mm as (select *, iou is not null as matched, coalesce(onset_err_ms <= 500 and offset_err_ms <= 500, false) as well_matched from mt)"""


def _matches(s, d):
    part = _part(s, d).withColumns({"onset_ms": F.col("onset_ms") + 200, "offset_ms": F.col("offset_ms") + 200})
    return agreement.best_matches(derive.vtc(s, d), part, collar_ms=500)


_add("c08_best_match", _MATCH + " select * from mm")(_matches)
_add("d24_match_table", _MATCH + """, tot as (select label, count(*) as n, sum(matched::int)::bigint as n_matched, 100.0::double * sum(matched::int) / count(*) as match_pct,
""" + ", ".join(f"100.0::double * sum(case when greatest(onset_err_ms, offset_err_ms) <= {c} then 1 else 0 end) / count(*) as within_{c}" for c in (500, 1000, 2000, 3000, 5000)) + """,
quantile_cont(onset_err_ms, 0.5)::double as onset_median, quantile_cont(offset_err_ms, 0.5)::double as offset_median from mm group by label) select * from tot""")(lambda s, d: agreement.match_table(_matches(s, d)))
_add("d25_error_quartiles", _MATCH + """ select 'onset' as edge, quantile_cont(onset_err_ms, 0.25)::double as q1, quantile_cont(onset_err_ms, 0.5)::double as median, quantile_cont(onset_err_ms, 0.75)::double as q3 from mm where matched
union all select 'offset', quantile_cont(offset_err_ms, 0.25)::double, quantile_cont(offset_err_ms, 0.5)::double, quantile_cont(offset_err_ms, 0.75)::double from mm where matched""")(lambda s, d: agreement.error_quartiles(_matches(s, d)))
_add("d44_error_cdf", _MATCH + """, z as (select uid, label, onset_ms, greatest(onset_err_ms, offset_err_ms) as err_ms from mm where matched)
select uid, label, onset_ms, err_ms, row_number() over (order by err_ms, uid, onset_ms, label)::double / (select count(*) from mm) as cdf from z""")(lambda s, d: agreement.error_cdf(_matches(s, d)))
_COV = SQL + _PART + """,
fx as (select uid, unnest([label, 'all_speech']) as label, onset_ms, offset_ms from vtc), px as (select uid, unnest([label, 'all_speech']) as label, onset_ms, offset_ms from part)""" + islands("fx", "uid, label", name="f") + islands("px", "uid, label", name="p") + """,
bo as (select f.label, sum(least(f.offset_ms, p.offset_ms) - greatest(f.onset_ms, p.onset_ms)) as both_ms from f join p on f.uid = p.uid and f.label = p.label and f.onset_ms < p.offset_ms and p.onset_ms < f.offset_ms group by f.label),
fa as (select label, sum(offset_ms - onset_ms) as a_ms from f group by label), pa as (select label, sum(offset_ms - onset_ms) as b_ms from p group by label)
select label, coalesce(both_ms, 0) / 3600000.0::double as both_h, (coalesce(a_ms, 0) - coalesce(both_ms, 0)) / 3600000.0::double as only_a_h, (coalesce(b_ms, 0) - coalesce(both_ms, 0)) / 3600000.0::double as only_b_h from fa full join pa using (label) left join bo using (label)"""
_add("d23_coverage_hours", _COV)(lambda s, d: agreement.coverage_hours(derive.vtc(s, d), _part(s, d)))
_add("d26_speech_hours", SQL + _PART + """, a as (select label, sum(offset_ms - onset_ms) / 3600000.0::double as a_h from vtc group by label), b as (select label, sum(offset_ms - onset_ms) / 3600000.0::double as b_h from part group by label)
select label, coalesce(a_h, 0) as a_h, coalesce(b_h, 0) as b_h, 100 * (coalesce(b_h, 0) - coalesce(a_h, 0)) / nullif(coalesce(a_h, 0), 0) as diff_pct from a full join b using (label)""")(lambda s, d: agreement.speech_hours(derive.vtc(s, d), _part(s, d)))
_UNC = SQL + islands("vad", "uid", 1, name="cv") + """,
pq as (select v.uid, v.label, v.onset_ms, v.offset_ms, greatest(v.onset_ms, cv.onset_ms) as on_ms, least(v.offset_ms, cv.offset_ms) as off_ms from vtc v left join cv on v.uid = cv.uid and v.onset_ms < cv.offset_ms and cv.onset_ms < v.offset_ms),
gp as (select uid, label, onset_ms, offset_ms, on_ms, off_ms, on_ms - coalesce(lag(off_ms) over (partition by uid, label, onset_ms, offset_ms order by on_ms), onset_ms) as gap from pq),
un as (select uid, label, onset_ms, offset_ms, (sum(case when gap > 0 then 1 else 0 end) + case when offset_ms > coalesce(max(off_ms), onset_ms) then 1 else 0 end)::bigint as n_cuts,
(coalesce(sum(case when gap > 0 then gap end), 0) + offset_ms - coalesce(max(off_ms), onset_ms))::bigint as missed_ms from gp where true group by uid, label, onset_ms, offset_ms)"""
_UNC = _UNC.replace("greatest(v.onset_ms, cv.onset_ms) as on_ms, least(v.offset_ms, cv.offset_ms) as off_ms", "case when cv.uid is not null then greatest(v.onset_ms, cv.onset_ms) end as on_ms, case when cv.uid is not null then least(v.offset_ms, cv.offset_ms) end as off_ms")


def _uncovered(s, d):
    return intervals.uncovered(derive.vtc(s, d), intervals.merge(derive.vad(s, d), ["uid"], 1))


_add("c12_cuts_and_missed", _UNC + " select * from un")(_uncovered)
_VCOV = _UNC + """, vc as (select coalesce(label, 'all') as label, count(*) as n_segments, sum(offset_ms - onset_ms)::bigint as total_ms, sum(n_cuts)::bigint as n_cuts, sum(case when n_cuts > 0 then 1 else 0 end)::bigint as n_cut_segments, sum(missed_ms)::bigint as missed_ms from un group by rollup(label))"""
_add("d27_vad_coverage", _VCOV + " select * from vc")(lambda s, d: agreement.coverage_table(_uncovered(s, d)))
_add("d28_coverage_report", _VCOV + ", lg as (unpivot (select label, n_segments, total_ms, n_cuts, n_cut_segments, missed_ms from vc) on n_segments, total_ms, n_cuts, n_cut_segments, missed_ms into name metric value value) select metric, " + ", ".join(f"max(case when label = '{x}' then value end)::varchar as {x}" for x in ("FEM", "MAL", "KCHI", "OCH", "all")).replace("as all", 'as "all"') + " from lg group by metric")(
    lambda s, d: agreement.coverage_report(agreement.coverage_table(_uncovered(s, d)))
)
_part_of = "(case when {b} > 0 then 100.0::double * {a} / {b} else 0 end)"
_FIGURES = {
    "Total VTC segments": "n_segments::varchar", "Total VTC duration (seconds)": "printf('%.3f', total_ms / 1000.0::double)", "VTC segments with >=1 cut": "n_cut_segments::varchar",
    "% VTC segments with >=1 cut": "printf('%.2f%%', " + rounded_sql(_part_of.format(a="n_cut_segments", b="n_segments"), 2) + ")", "Total number of cuts": "n_cuts::varchar",
    "Total missed speech (seconds)": "printf('%.3f', missed_ms / 1000.0::double)", "% VTC speech missed": "printf('%.2f%%', " + rounded_sql(_part_of.format(a="missed_ms", b="total_ms"), 2) + ")",
}
_add("d28_coverage_figures", _VCOV + ", z as (select l.label, coalesce(n_segments, 0) as n_segments, coalesce(total_ms, 0) as total_ms, coalesce(n_cuts, 0) as n_cuts, coalesce(n_cut_segments, 0) as n_cut_segments, coalesce(missed_ms, 0) as missed_ms from (select unnest(['all', 'KCHI', 'OCH', 'MAL', 'FEM']) as label) l left join vc using (label)), t as (" + " union all ".join(f"select label, '{m}' as metric, {v} as text from z" for m, v in _FIGURES.items()) + ") select metric, max(case when label = 'all' then text end) as all_types, " + ", ".join(f"max(case when label = '{x}' then text end) as {x}" for x in ("KCHI", "OCH", "MAL", "FEM")) + " from t group by metric")(
    lambda s, d: agreement.coverage_figures(agreement.coverage_table(_uncovered(s, d)))
)
_add("c07_clip_to_absolute", SQL + ", cl as (select uid, onset_ms // 600000 as clip_idx, onset_ms % 600000 as rel_on, onset_ms % 600000 + (offset_ms - onset_ms) as rel_off, label from vtc) select uid, clip_idx, label, clip_idx * 600000 + rel_on as onset_ms, clip_idx * 600000 + rel_off as offset_ms from cl")(
    lambda s, d: agreement.to_absolute(
        derive.vtc(s, d).selectExpr("uid", "onset_ms div 600000 as clip_idx", "label", "onset_ms % 600000 as onset_ms", "onset_ms % 600000 + (offset_ms - onset_ms) as offset_ms"),
        derive.vtc(s, d).selectExpr("uid", "onset_ms div 600000 as clip_idx", "(onset_ms div 600000) * 600000 as abs_onset_ms").distinct(),
    )
)
_add("e20_pair_iou", SQL + ", l as (select *, lag(onset_ms) over w as p_on, lag(offset_ms) over w as p_off from vtc window w as (partition by uid order by onset_ms, label, offset_ms)) select uid, onset_ms, label, coalesce(greatest(0, least(offset_ms, p_off) - greatest(onset_ms, p_on))::double / nullif(greatest(offset_ms, p_off) - least(onset_ms, p_on), 0), 0) as iou from l where p_on is not null")(
    lambda s, d: derive.vtc(s, d).selectExpr("*", "lag(onset_ms) over (partition by uid order by onset_ms, label, offset_ms) as p_on", "lag(offset_ms) over (partition by uid order by onset_ms, label, offset_ms) as p_off").where("p_on is not null").select("uid", "onset_ms", "label", intervals.pair_iou(F.col("onset_ms"), F.col("offset_ms"), F.col("p_on"), F.col("p_off")).alias("iou"))
)
