"""What Spark or a task takes for small and isn't: joins, tasks and plans whose work must not outgrow the input."""

from pyspark.sql import functions as F

from annospark.operators import intervals, kernels, slots
from annospark.plans import stats_plans
from annospark.sources import derive, shards, tables
from annospark.streaming import endless
from annospark.streaming import sessions as live


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_frame_arrays_are_not_broadcast(spark, sf):
    """Arrays made in the query count as one element each in Spark's estimate: their join was a broadcast of all frames."""
    means = kernels.segment_means(derive.vtc(spark, sf), derive.frame_arrays(spark, sf))
    assert "ShuffledHashJoin" in plan(means) and "Broadcast" not in plan(means)
    # A shuffle for segments and one for the recordings' lengths, none for arrays.
    assert plan(means).count("Exchange ") == 2


def test_segment_snr_as_it_ran_broadcasts_nothing(spark, sf):
    """The query itself, by the plan that it ended with: it gathered all blocks of frames in the driver and failed by its memory on events at 6 times sf0.1."""
    rows = stats_plans.QUERIES["c10_segment_snr"](spark, sf)
    assert len(rows.collect()) > 0 and "isFinalPlan=true" in plan(rows) and "Broadcast" not in plan(rows)


def test_segments_meet_clips_without_a_broadcast(spark, sf):
    """A file's compressed bytes were what Spark expected of its segments, so the driver held them, ten times as large, for the statistics of clips."""
    for rows in (stats_plans._seg(spark, sf), stats_plans._vseg(spark, sf)):
        assert "SortMergeJoin" in plan(rows) and "Broadcast" not in plan(rows)


def test_segment_means_of_odd_segments(spark):
    recordings = spark.createDataFrame([(1, [float(i) for i in range(2500)]), (2, []), (3, [None, float("nan"), 4.0])], "uid long, snr array<double>")
    segments = [(1, 0, 1), (1, 0, 1), (1, 1023_000, 1025_000), (1, 500, 2_500_000), (1, 9_000_000, 9_001_000), (2, 0, 1000), (3, 0, 3000), (4, 0, 1000), (None, 0, 1000)]
    got = kernels.segment_means(spark.createDataFrame(segments, "uid long, onset_ms long, offset_ms long"), recordings, ["snr"], size=1000)
    want = {(1, 0, 1, 0.0), (1, 1023_000, 1025_000, 1023.5), (1, 500, 2_500_000, 1249.5), (1, 9_000_000, 9_001_000, None), (2, 0, 1000, None), (3, 0, 3000, 4.0), (4, 0, 1000, None), (None, 0, 1000, None)}
    assert got.count() == len(want) and {tuple(r) for r in got.collect()} == want
    dealt = kernels.segment_means(spark.createDataFrame(segments, "uid long, onset_ms long, offset_ms long"), recordings.repartition(3, F.xxhash64("uid")), ["snr"], size=7)
    assert {tuple(r) for r in dealt.collect()} == want


def test_frames_stay_where_their_recording_is(spark, sf):
    """Frames were made by one task, since Spark joins partitions of few bytes, and sorted there."""
    frames = derive.frames(spark, sf)
    for rows in (intervals.runs(frames, F.col("vad") > 0.5), derive.frame_arrays(spark, sf)):
        assert plan(rows).count("Exchange ") == 1 and "REPARTITION_BY_NUM" in plan(rows)
    assert frames.select(F.spark_partition_id().alias("p")).distinct().count() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_folders_of_recordings_share_tasks(spark, tmp_path):
    """Files of few bytes were written by a task or two, each with three processes for its rights, and each folder was listed by a task of its own."""
    rows = [(f"{i}", f"{k}" if k else None) for i in range(60) for k in range(i % 3 + 1)] + [("a/b =", "é"), (None, "x")]
    tables.write_folders(spark.createDataFrame(rows, "uid string, line string"), "uid", path := str(tmp_path / "texts"), ".txt")
    want = {k: sorted(line or "" for u, line in rows if u == k) for k, _ in rows}
    name = {"a/b =": "uid=a%2Fb%20%3D", None: "uid=__HIVE_DEFAULT_PARTITION__"}
    for k, lines in want.items():
        folder = tmp_path / "texts" / name.get(k, f"uid={k}")
        assert [f.name for f in folder.iterdir()] == ["lines.txt"] and sorted((folder / "lines.txt").read_text().split("\n")[:-1]) == lines
    spark.sparkContext.setJobGroup("listing", "")
    found = tables.scan_files(spark, path, (".txt",), F.regexp_extract("path", "uid=([^/]+)/", 1))
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    spark.sparkContext.setJobGroup("", "")
    assert stages and max(s.numTasks for s in stages) <= 4 * spark.sparkContext.defaultParallelism
    assert found.count() == 62 and spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism") == "10000"
    tables.write_folders(spark.createDataFrame([], "uid string, line string"), "uid", empty := str(tmp_path / "empty"), ".txt")
    assert tables.scan_files(spark, empty, (".txt",)).count() == 0


def test_small_tars_share_tasks(spark, tmp_path):
    """Each tar had a task of its own, and a file in the table of tars, all of which each reader opens."""
    path = str(tmp_path / "tars")
    rows = [(f"{i:05d}", f"{i}_{k}", "bin", b"x" * i) for i in range(60) for k in range(3)]
    shards.write_shards(spark.createDataFrame(rows, "shard string, key string, ext string, payload binary"), path)
    assert len(list((tmp_path / "tars" / "shards").glob("*.parquet"))) <= 4 * spark.sparkContext.defaultParallelism
    parts = shards._TarReader(path, 64 << 20).partitions()
    assert len(parts) <= 6 and [r.shard for p in parts for r in (p, *p.after)] == [f"{i:05d}" for i in range(60)]
    assert sorted((r.shard, r.key, r.ext, bytes(r.payload)) for r in shards.read_shards(spark, path).collect()) == sorted(rows)


def test_an_epoch_is_ordered_once(monkeypatch):
    """Every block of a batch ordered all shards of its epoch again, more than once."""
    calls, order = [], endless._order
    monkeypatch.setattr(endless, "_order", lambda *a: calls.append(a) or order(*a))
    plan = endless.Epochs([{"shard": str(i), "samples": 10} for i in range(100)], 1, 0, 1, 5)
    assert len(list(plan.blocks((0, 0), plan.after((0, 0), 400, 2)))) == 400 and len(calls) == 200


def test_live_turns_keep_one_value_a_recording(spark, tmp_path):
    """State came by calls for each of its parts, from the one store that knows timers: the plain store holds it as well now."""
    schema = "uid long, onset_ms long, offset_ms long, label string"
    for rows in ([(1, 0, 50, "FEM"), (1, 100, 300, "FEM")], [(1, 5000, 5100, "MAL"), (-1, 10_000_000, 10_000_001, None)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = live.live_turns(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), "2 seconds")
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [(1, 0, "FEM", 0, 300, 2), (1, 1, "MAL", 5000, 5100, 1)]
