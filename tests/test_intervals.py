import random

import pytest
from pyspark.sql import functions as F

from annospark.operators import intervals, sessions, stats


def frame(spark, pairs, label=None):
    rows = [(1, a, b, *([label] if label else [])) for a, b in pairs]
    return spark.createDataFrame(rows, "uid long, onset_ms long, offset_ms long" + (", label string" if label else ""))


def pairs(df):
    return [(r.onset_ms, r.offset_ms) for r in df.orderBy("onset_ms").collect()]


@pytest.mark.parametrize(
    ("given", "want"),
    [
        ([], []),
        ([(0, 2000), (1000, 3000), (5000, 6000)], [(0, 3000), (5000, 6000)]),
        ([(0, 1000), (1000, 2000)], [(0, 2000)]),
        ([(0, 9000), (2000, 3000)], [(0, 9000)]),
        ([(4, 6), (4, 6), (0, 2)], [(0, 2), (4, 6)]),
    ],
)
def test_merge(spark, given, want):
    assert pairs(intervals.merge(frame(spark, given))) == want


def test_merge_collar_and_least(spark):
    df = frame(spark, [(0, 1000), (1100, 1500), (1601, 1650), (9000, 9050)])
    assert pairs(intervals.merge(df, ["uid"], 100, 100)) == [(0, 1500)]
    assert pairs(intervals.merge(df, ["uid"], 101, 0)) == [(0, 1650), (9000, 9050)]


@pytest.mark.parametrize(("a", "b", "want"), [([(0, 2000), (4000, 6000)], [(1000, 5000)], 2 / 6), ([(0, 5)], [], 0.0), ([(0, 5)], [(0, 5)], 1.0)])
def test_iou(spark, a, b, want):
    assert intervals.iou(frame(spark, a), frame(spark, b)).first().iou == pytest.approx(want)


def test_overlap_join_counts_each_pair_once_whatever_the_slots(spark):
    a, b = frame(spark, [(0, 5000), (5000, 20_000)]), frame(spark, [(100, 19_000), (4_999, 5_001)])
    for slot in (100, 1_000, 10**9):
        got = sorted((r.onset_ms, r.b_onset_ms, r.on_ms, r.off_ms) for r in intervals.overlap_join(a, b, ["uid"], slot).collect())
        assert got == [(0, 100, 100, 5000), (0, 4999, 4999, 5000), (5000, 100, 5000, 19000), (5000, 4999, 5000, 5001)]


def test_runs(spark):
    df = spark.createDataFrame([(1, i, x) for i, x in enumerate([1, 1, 0, 0, 1])], "uid long, i long, x int")
    got = [(r.flag, r.first, r.end) for r in intervals.runs(df, F.col("x") == 1).orderBy("first").collect()]
    assert got == [(True, 0, 2), (False, 2, 4), (True, 4, 5)]
    assert pairs(intervals.run_segments(intervals.runs(df, F.col("x") == 1), 1000)) == [(0, 2000), (4000, 5000)]


def test_silence_gaps(spark):
    spans = spark.createDataFrame([(1, 0, 100), (2, 0, 50)], "uid long, win_on long, win_off long")
    got = [(r.uid, r.gap_on, r.gap_off, r.gap_rank) for r in intervals.silence_gaps(frame(spark, [(0, 10), (30, 40), (95, 200)]), spans).orderBy("uid", "gap_rank").collect()]
    assert got == [(1, 40, 95, 1), (1, 10, 30, 2), (2, 0, 50, 1)]


def test_uncovered(spark):
    seg = frame(spark, [(0, 100), (200, 300)], "FEM")
    got = sorted((r.onset_ms, r.n_cuts, r.missed_ms) for r in intervals.uncovered(seg, frame(spark, [(10, 20), (50, 100)])).collect())
    assert got == [(0, 2, 40), (200, 1, 100)]


def labelled(spark, rows):
    return spark.createDataFrame([(1, *r) for r in rows], "uid long, onset_ms long, offset_ms long, label string")


def test_turns_break_on_label_and_gap(spark):
    df = labelled(spark, [(0, 1000, "FEM"), (1300, 2000, "FEM"), (2301, 2400, "FEM"), (2350, 2500, "MAL"), (2450, 2600, "FEM")])
    got = [(r.label, r.onset_ms, r.offset_ms, r.n_segments) for r in sessions.turns(df).orderBy("turn_idx").collect()]
    assert got == [("FEM", 0, 2000, 2), ("FEM", 2301, 2400, 1), ("MAL", 2350, 2500, 1), ("FEM", 2450, 2600, 1)]


def test_conversations_break_at_exactly_ten_seconds(spark):
    df = labelled(spark, [(0, 1000, "FEM"), (10_999, 12_000, "MAL"), (22_000, 23_000, "FEM")])
    tagged = sessions.tag_conversations(sessions.turns(df))
    got = [(r.conv_idx, r.n_turns, r.is_multi_speaker, r.labels, r.gap_after_ms) for r in sessions.conversations(tagged).orderBy("conv_idx").collect()]
    assert got == [(0, 2, True, "FEM;MAL", 10_000), (1, 1, False, "FEM", None)]
    assert [(r.from_label, r.to_label, r.gap_ms) for r in sessions.transitions(tagged).collect()] == [("FEM", "MAL", 9_999)]
    assert [(r.n_turns) for r in sessions.bouts(tagged).collect()] == [2]


def test_common_time_equals_counted_milliseconds_whatever_the_slots(spark):
    rng = random.Random(4)
    sets = []
    for _ in range(2):
        on = [(uid, rng.randrange(300)) for uid in (1, 2, 3) for _ in range(40)]
        sets.append([(uid, x, x + rng.choice([0, 1, 5, 60])) for uid, x in on] + [(1, 7, 7)] * 3)
    sets[0] += [(4, 0, 350), (4, 0, 350)]  # a group that the other set lacks
    a, b = (spark.createDataFrame(x, "uid long, onset_ms long, offset_ms long") for x in sets)
    held = [{uid: {t for u, x, y in rows if u == uid for t in range(x, y)} for uid in (1, 2, 3, 4)} for rows in sets]
    want = sorted((uid, len(held[0][uid]), len(held[1][uid]), len(held[0][uid] & held[1][uid])) for uid in (1, 2, 3, 4))
    for slot in (None, 1, 10, 64, 10**6):
        assert sorted(tuple(r) for r in intervals.common_time(a, b, ["uid"], slot).collect()) == want
    assert intervals.common_time(a.limit(0), b.limit(0)).count() == 0


def test_turns_equal_a_loop_over_nested_and_equal_segments(spark):
    rng = random.Random(9)
    rows = [(uid, x, x + rng.choice([10, 200, 900]), rng.choice("AAB")) for uid in range(6) for x in (rng.randrange(3000) for _ in range(30))]
    rows += rows[:20]
    want = []
    for uid in range(6):
        turn = None
        for _, on, off, label in sorted((r for r in rows if r[0] == uid), key=lambda r: (r[1], r[3], r[2])):
            if turn is None or label != turn[1] or on - turn[3] > 100:
                turn = [uid, label, on, off, 0]
                want.append(turn)
            turn[3], turn[4] = max(turn[3], off), turn[4] + 1
    got = sessions.turns(spark.createDataFrame(rows, "uid long, onset_ms long, offset_ms long, label string"), ["uid"], 100)
    assert [list(r) for r in got.orderBy("uid", "turn_idx").select("uid", "label", "onset_ms", "offset_ms", "n_segments").collect()] == want


def test_clip_cover_equals_merged_vad_and_frame_iou(spark):
    rng = random.Random(2)
    sets = [[(u, c, x, x + rng.choice([1, 40, 99, 350, 1200])) for u in (1, 2) for c in (0, 1) for x in (rng.randrange(5000) for _ in range(12))] for _ in range(2)]
    sets[0] += [(3, 0, 10, 20), (3, 1, 0, 500)]  # shorter than a frame; without segments
    vad, seg = (spark.createDataFrame(x, "uid long, clip_idx long, onset_ms long, offset_ms long") for x in sets)
    want = {(r.uid, r.clip_idx): r.total_ms for r in intervals.total(intervals.merge(vad, stats.CLIP), stats.CLIP).collect()}
    iou = {(r.uid, r.clip_idx): r.frame_iou for r in stats.frame_iou(vad, seg).collect()}
    got = {(r.uid, r.clip_idx): (r.vad_ms, r.frame_iou) for r in stats.clip_cover(vad, seg).collect()}
    assert got == {k: (v, iou.get(k, 0.0)) for k, v in want.items()} and 0 < iou[1, 0] < 1
