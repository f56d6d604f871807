"""Tiling of recordings into clips that avoid cutting activity."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import intervals

#: Step of the model grid that interior cuts are snapped to.
GRID_MS = 3_980
#: How a cut was found, in the order of preference; the last for a search window without room.
TIERS = ("long_union_gap", "short_union_gap", "vad_only_gap", "vtc_only_gap", "speaker_boundary", "hard_cut", "degenerate_window")


def snap_to_grid(t: Column, dur: Column, grid_ms: int = GRID_MS) -> Column:
    """Nearest multiple of the grid (ties to the even one), within [0, dur]."""
    return F.greatest(F.lit(0), F.least((F.bround(t / F.lit(float(grid_ms))) * grid_ms).cast("long"), dur))


def _snap(t: float, dur: int) -> int:
    return max(0, min(round(t / GRID_MS) * GRID_MS, dur))  # Python rounds ties to even, as bround does


def _gaps(active: np.ndarray, dur: int) -> np.ndarray:
    """Free spans of [0, dur] between merged intervals."""
    if not len(active):
        return np.array([[0, dur]])
    edge = np.concatenate(([0], active[:, 1])), np.concatenate((active[:, 0], [dur]))
    out = np.stack(edge, 1)
    return out[out[:, 1] > out[:, 0]]


def _nearest_gap(gaps: np.ndarray, lo: float, hi: float, ideal: float, least: int) -> float | None:
    """Middle of the gap, clamped to [lo, hi], that lies nearest to `ideal`; ties to the longest, then the earliest."""
    cut = np.stack((np.maximum(gaps[:, 0], lo), np.minimum(gaps[:, 1], hi)), 1) if len(gaps) else np.zeros((0, 2))
    size = cut[:, 1] - cut[:, 0]
    cut, size = cut[size > 0], size[size > 0]
    cut, size = cut[size >= least], size[size >= least]
    if not len(cut):
        return None
    middle = cut.mean(1)
    return float(middle[np.lexsort((cut[:, 0], -size, np.abs(middle - ideal)))[0]])


def cut_points(dur: int, vad: np.ndarray, vtc: np.ndarray, union: np.ndarray, ends: np.ndarray, max_ms: int, search_ms: int, long_gap_ms: int) -> list[tuple[int, str]]:
    """Interior cuts of one recording with their tiers. Arrays hold merged intervals; `ends` all segment ends of labelled segments, sorted."""
    gaps = {n: _gaps(x, dur) for n, x in (("union", union), ("vad", vad), ("vtc", vtc))}
    out: list[tuple[int, str]] = []
    prev = 0
    while dur - prev > max_ms:
        rest = dur - prev
        ideal = prev + rest / -(-rest // max_ms)
        lo, hi = max(ideal - search_ms, prev + 1_000), min(ideal + search_ms, prev + max_ms, dur - 1_000)
        if lo >= hi:
            cut, tier = float(min(prev + max_ms, dur)), "degenerate_window"
        else:
            for tier, name, least in (("long_union_gap", "union", long_gap_ms), ("short_union_gap", "union", 0), ("vad_only_gap", "vad", 0), ("vtc_only_gap", "vtc", 0)):
                cut = _nearest_gap(gaps[name], lo, hi, ideal, least)
                if cut is not None:
                    break
            else:
                near = ends[(ends > lo) & (ends < hi)]
                if len(near):
                    tier = "speaker_boundary"
                    cut = float(near[np.lexsort((near, np.abs(near - (lo + hi) / 2), np.abs(near - ideal)))[0]])
                else:
                    cut, tier = min(ideal, prev + max_ms), "hard_cut"
        snapped = _snap(cut, dur)
        if snapped <= prev:  # the grid left no way on
            snapped = int(min(prev + max_ms, dur))
        out.append((snapped, tier))
        prev = snapped
    return [c for c in out if c[0] < dur]


def build_clips(vtc: DataFrame, vad: DataFrame, durations: DataFrame, max_ms: int = 600_000, search_ms: int = 120_000, long_gap_ms: int = 10_000) -> DataFrame:
    """Clips that tile each recording: uid, clip_idx, onset_ms, offset_ms, tier (how the clip's end was found; `end` for the last).

    While more than `max_ms` are left, a cut is sought near the even split of the rest: the middle of a free gap of both sources, a long one
    first, then of one source, then a segment end, then the even split. Cuts are snapped to the grid and so a clip may exceed
    `max_ms` by half a grid step. Merged activity is made by windows; the choices depend on each other, so each
    recording's short arrays go through one grouped function.
    """
    packed = lambda df, name: intervals.merge(df.select("uid", "onset_ms", "offset_ms")).groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("onset_ms", "offset_ms"))).alias(name))
    ends = vtc.select("uid", F.explode(F.array("onset_ms", "offset_ms")).alias("at")).groupBy("uid").agg(F.array_sort(F.collect_set("at")).alias("ends"))
    union = vtc.select("uid", "onset_ms", "offset_ms").unionByName(vad.select("uid", "onset_ms", "offset_ms"))
    rows = durations.select("uid", "dur_ms").where("dur_ms > 0")
    for side in (packed(vad, "vad"), packed(vtc, "vtc"), packed(union, "both"), ends):
        rows = rows.join(side, "uid", "left")
    flat = lambda name: (F.transform(name, lambda x: x["onset_ms"]).alias(f"{name}_on"), F.transform(name, lambda x: x["offset_ms"]).alias(f"{name}_off"))
    rows = rows.select("uid", "dur_ms", *flat("vad"), *flat("vtc"), *flat("both"), "ends")

    def tile(batches):
        def pairs(on, off):
            return np.stack((np.asarray(on, np.int64), np.asarray(off, np.int64)), 1) if on is not None and len(on) else np.zeros((0, 2), np.int64)

        for pdf in batches:
            out = []
            for r in pdf.itertuples():
                cuts = cut_points(r.dur_ms, pairs(r.vad_on, r.vad_off), pairs(r.vtc_on, r.vtc_off), pairs(r.both_on, r.both_off), np.asarray(r.ends if r.ends is not None else [], np.int64), max_ms, search_ms, long_gap_ms)
                at = [0, *[c for c, _ in cuts], r.dur_ms]
                out += [(r.uid, i, at[i], at[i + 1], t) for i, t in enumerate([*[t for _, t in cuts], "end"])]
            yield pd.DataFrame(out, columns=["uid", "clip_idx", "onset_ms", "offset_ms", "tier"])

    kind = dict(durations.dtypes)["uid"]
    return rows.mapInPandas(tile, f"uid {kind}, clip_idx long, onset_ms long, offset_ms long, tier string")


def tier_counts(clips: DataFrame) -> DataFrame:
    """How often each tier was used, all tiers present."""
    names = clips.sparkSession.createDataFrame([(t,) for t in TIERS], "tier string")
    return names.join(clips.groupBy("tier").agg(F.count("*").alias("n")), "tier", "left").na.fill(0, ["n"])


def assign_segments(segments: DataFrame, clips: DataFrame) -> DataFrame:
    """Segments by clip, clamped to the clip; one that spans a cut lands in both. Adds clip-relative rel_on_ms, rel_off_ms."""
    pairs = intervals.overlap_join(clips.select("uid", "clip_idx", "onset_ms", "offset_ms"), segments, ["uid"])
    extra = [c for c in segments.columns if c not in ("uid", "onset_ms", "offset_ms")]
    return pairs.select("uid", "clip_idx", F.col("on_ms").alias("seg_on_ms"), F.col("off_ms").alias("seg_off_ms"), *[F.col(f"b_{c}").alias(c) for c in extra], (F.col("on_ms") - F.col("onset_ms")).alias("rel_on_ms"), (F.col("off_ms") - F.col("onset_ms")).alias("rel_off_ms")).withColumnsRenamed({"seg_on_ms": "onset_ms", "seg_off_ms": "offset_ms"})


def fixed_clips(durations: DataFrame, size_ms: int = 600_000) -> DataFrame:
    """Clips of a fixed size, the last shorter."""
    rows = durations.select("uid", "dur_ms", F.explode(F.sequence(F.lit(0), F.floor((F.col("dur_ms") - 1) / size_ms))).alias("clip_idx"))
    return rows.select("uid", "clip_idx", (F.col("clip_idx") * size_ms).alias("onset_ms"), F.least((F.col("clip_idx") + 1) * size_ms, "dur_ms").alias("offset_ms"))
