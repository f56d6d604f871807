import numpy as np
import pytest

from annospark.operators import stats, tiling

NONE = np.zeros((0, 2), np.int64)


def tiers(dur_s, vad=(), vtc=(), search_s=120, max_s=600):
    arr = lambda x: np.array(sorted(x), np.int64).reshape(-1, 2) * 1000
    union = arr([])
    both = sorted([*vad, *vtc])
    merged = []
    for a, b in both:
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(b, merged[-1][1])
        else:
            merged.append([a, b])
    union = arr(merged)
    ends = np.array(sorted({e * 1000 for s in vtc for e in s}), np.int64)
    return tiling.cut_points(dur_s * 1000, arr(vad), arr(vtc), union, ends, max_s * 1000, search_s * 1000, 10_000)


def test_short_recording_is_one_clip():
    assert tiers(600) == []


def test_long_gap_is_preferred():
    cuts = tiers(1200, vad=[(0, 570), (600, 1200)], vtc=[(0, 570), (600, 1200)])
    assert cuts[0][1] == "long_union_gap"
    assert abs(cuts[0][0] - 585_000) <= 1_990


def test_short_gap_then_single_sources():
    assert tiers(1200, vad=[(0, 580), (585, 1200)], vtc=[(0, 580), (585, 1200)])[0][1] == "short_union_gap"
    assert tiers(1200, vad=[(0, 580), (585, 1200)], vtc=[(0, 1200)])[0][1] == "vad_only_gap"
    assert tiers(1200, vad=[(0, 1200)], vtc=[(0, 580), (590, 1200)])[0][1] == "vtc_only_gap"


def test_speaker_boundary_and_hard_cut():
    assert tiers(1200, vad=[(0, 1200)], vtc=[(0, 580), (580, 1200)])[0][1] == "speaker_boundary"
    assert {t for _, t in tiers(1200, vad=[(0, 1200)], vtc=[(0, 1200)])} == {"hard_cut"}
    assert tiers(1200, max_s=1, search_s=0)[0][1] == "degenerate_window"


@pytest.mark.parametrize("dur", [601, 650, 1500, 2000, 57_600])
def test_invariants(spark, dur):
    one = spark.createDataFrame([(1, 0, dur * 1000, "FEM")], "uid long, onset_ms long, offset_ms long, label string")
    d = spark.createDataFrame([(1, dur * 1000)], "uid long, dur_ms long")
    clips = tiling.build_clips(one, one.drop("label"), d).orderBy("clip_idx").collect()
    assert clips[0].onset_ms == 0 and clips[-1].offset_ms == dur * 1000
    assert all(a.offset_ms == b.onset_ms for a, b in zip(clips, clips[1:]))
    assert all(0 < c.offset_ms - c.onset_ms <= 601_990 for c in clips)
    assert all(c.offset_ms % tiling.GRID_MS == 0 for c in clips[:-1])


def test_assignment_is_relative_and_clamped(spark):
    clips = spark.createDataFrame([(1, 0, 0, 100_000), (1, 1, 100_000, 200_000)], "uid long, clip_idx long, onset_ms long, offset_ms long")
    seg = spark.createDataFrame([(1, 90_000, 120_000, "FEM")], "uid long, onset_ms long, offset_ms long, label string")
    got = sorted((r.clip_idx, r.rel_on_ms, r.rel_off_ms) for r in tiling.assign_segments(seg, clips).collect())
    assert got == [(0, 90_000, 100_000), (1, 0, 20_000)]


def test_duration_summary(spark):
    df = spark.createDataFrame([(1, 0, 1000), (1, 0, 2000), (1, 0, 3000)], "uid long, onset_ms long, offset_ms long")
    r = stats.duration_summary(df, ["uid"]).first()
    assert (r.max_ms, r.min_ms, r.sum_ms, r.num, r.avg_ms) == (3000, 1000, 6000, 3, 2000.0)
