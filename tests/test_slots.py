"""Segmented scans against the windows over whole recordings."""

import random

import pytest
from pyspark.sql import functions as F

from annospark.operators import intervals, sessions, slots

SEGMENTS = "uid long, onset_ms long, offset_ms long, label string"


def rows(df):
    return sorted(tuple(map(str, r)) for r in df.select(*sorted(df.columns)).collect())


@pytest.fixture(scope="module")
def segments(spark):
    rng, out = random.Random(8), []
    for uid in range(5):
        at = rng.randrange(500)
        for _ in range(160):
            at += rng.choice([0, 0, 50, 300, 301, 1000, 9999, 10_000, 30_000])
            length = rng.choice([1, 200, 800, 4000, 60_000] if uid else [1, 200])
            out.append((uid, at, at + length, rng.choice("AB" if uid < 3 else "A")))
            at += rng.choice([0, length])
    out += out[:20]
    return spark.createDataFrame(out, SEGMENTS).repartition(3)


@pytest.mark.parametrize("slot", [1, 700, 5000, 10**9])
def test_merge(segments, slot):
    for collar, least in ((0, 0), (300, 500)):
        assert rows(slots.merge(segments, ["uid", "label"], collar, least, slot)) == rows(intervals.merge(segments, ["uid", "label"], collar, least))


@pytest.mark.parametrize("slot", [1, 700, 5000, 10**9])
def test_turns_and_conversations(segments, slot):
    want = sessions.turns(segments)
    got = slots.turns(segments, slot_ms=slot)
    assert rows(got) == rows(want)
    assert rows(slots.tag_turns(segments, slot_ms=slot)) == rows(sessions.tag_turns(segments))
    assert rows(slots.tag_conversations(want, slot_ms=slot)) == rows(sessions.tag_conversations(want))


@pytest.mark.parametrize("slot", [1, 7, 64, 10**6])
def test_runs(spark, slot):
    rng = random.Random(slot)
    frames = spark.createDataFrame([(u, i, rng.choice([True, False, None] if u == 2 else [True] * 9 + [False])) for u in range(3) for i in range(300) if u or i % 50], "uid long, i long, on boolean").repartition(4)
    assert rows(slots.runs(frames, F.col("on"), slot_frames=slot)) == rows(intervals.runs(frames, F.col("on")))


def test_empty_tables(spark):
    none = spark.createDataFrame([], SEGMENTS)
    assert slots.merge(none).count() == slots.turns(none).count() == 0


def test_one_long_recording_is_dealt_over_tasks(spark):
    """Two million frames of one recording: no window holds more than a slot of them."""
    frames = spark.range(2_000_000).selectExpr("1L as uid", "id as i", "(id div 70001) % 2 = 0 as on")
    got = slots.runs(frames, F.col("on"), slot_frames=50_000)
    assert got.count() == 2_000_000 // 70_001 + 1
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert all("_slot" in line for line in plan.splitlines() if line.strip(" :+-").startswith("Window ") and " i#" in line.split("windowspecdefinition")[-1])
    slot = frames.groupBy(F.floor(F.col("i") / 50_000)).count().agg(F.max("count")).first()[0]
    assert slot == 50_000
