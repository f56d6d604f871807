"""Live turns and conversations against the batch forms, over several micro-batches, out of order, with restarts."""

import random

import pytest
from annospark.operators import sessions as batch
from annospark.streaming import sessions as live

SEGMENTS = "uid long, onset_ms long, offset_ms long, label string"


@pytest.fixture
def rocks(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield
    spark.conf.set(name, old)


def run(spark, tmp_path, batches, form, delay="5 seconds"):
    """Feeds each batch to a query of its own that goes on from the last one's checkpoint, then says that much time has passed."""
    end = max([r[1] for b in batches for r in b], default=0) + 10_000_000
    for rows in [*batches, [(-1, end, end + 1, None)]]:
        spark.createDataFrame(rows, SEGMENTS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(SEGMENTS).parquet(str(tmp_path / "in"))
        q = form(stream, delay).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
        q.awaitTermination()
    return sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect())


def segments(seed, n=150, uids=4):
    rng = random.Random(seed)
    out = []
    for uid in range(uids):
        at = rng.randrange(3000)
        for _ in range(n // uids):
            at += rng.choice([0, 0, 100, 299, 300, 301, 900, 4000, 9999, 10_000, 10_001, 15_000])
            length = rng.choice([1, 200, 500, 3000, 9000])
            out.append((uid, at, at + length, rng.choice(["FEM", "MAL", "KCHI"])))
            at += rng.choice([0, length, length // 2])
    return out


def shuffled(rows, parts, jitter, seed):
    """Batches by onset, each row up to `jitter` later than its own, and mixed within."""
    rng = random.Random(seed)
    late = sorted(rows, key=lambda r: r[1] + rng.randrange(jitter))
    size = -(-len(late) // parts)
    out = [late[i : i + size] for i in range(0, len(late), size)]
    for b in out:
        rng.shuffle(b)
    return out


@pytest.mark.parametrize("parts", [1, 5])
def test_turns_equal_the_batch_form(spark, tmp_path, rocks, parts):
    rows = segments(parts)
    want = batch.turns(spark.createDataFrame(rows, SEGMENTS)).select("uid", "turn_idx", "label", "onset_ms", "offset_ms", "n_segments")
    assert run(spark, tmp_path, shuffled(rows, parts, 5000, 1), live.live_turns) == sorted(tuple(r) for r in want.collect())


@pytest.mark.parametrize("parts", [2, 4])
def test_conversations_equal_the_batch_form(spark, tmp_path, rocks, parts):
    rows = segments(10 + parts)
    want = batch.conversations(batch.tag_conversations(batch.turns(spark.createDataFrame(rows, SEGMENTS)))).drop("gap_after_ms")
    assert run(spark, tmp_path, shuffled(rows, parts, 5000, 2), live.live_conversations) == sorted(tuple(r) for r in want.collect())


def test_ties_repeated_segments_and_what_stays_open(spark, tmp_path, rocks):
    rows = [(1, 0, 50, "FEM"), (1, 0, 50, "FEM"), (1, 0, 90, "FEM"), (1, 0, 40, "KCHI"), (1, 390, 400, "KCHI"), (2, 7, 8, "MAL")]
    got = run(spark, tmp_path, [rows[3:], rows[:3]], live.live_turns)
    want = batch.turns(spark.createDataFrame(rows, SEGMENTS)).select("uid", "turn_idx", "label", "onset_ms", "offset_ms", "n_segments")
    assert got == sorted(tuple(r) for r in want.collect())


def test_nothing_is_emitted_before_the_watermark(spark, tmp_path, rocks):
    spark.createDataFrame([(1, 0, 50, "FEM"), (1, 2000, 2100, "MAL")], SEGMENTS).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(SEGMENTS).parquet(str(tmp_path / "in"))
    for form, name in ((live.live_turns, "turns"), (live.live_conversations, "talks")):
        q = form(stream, "1 second").writeStream.format("parquet").option("path", str(tmp_path / name)).option("checkpointLocation", str(tmp_path / f"{name}-check")).trigger(availableNow=True).start()
        q.awaitTermination()
    assert [(r.label, r.offset_ms) for r in spark.read.schema(live.TURNS).parquet(str(tmp_path / "turns")).collect()] == [("FEM", 50)]
    assert spark.read.schema(live.CONVERSATIONS).parquet(str(tmp_path / "talks")).count() == 0
