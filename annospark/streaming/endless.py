"""Endless shuffled samples of tar shards, as a streaming data source.

An epoch has every shard once, in a seeded order, and its samples in sequence; workers take shards in turn. The sequence is cut into blocks of `buffer` samples, each in a
seeded order of its own, as a shuffle buffer would give it. A place in the stream is (epoch, sample): all of an epoch's order follows from the seed and the table of shards, so
a restart goes on at the very next sample, and tasks of a micro-batch read their blocks on their own.
"""

from __future__ import annotations

import hashlib
import json
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import accumulate

import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from annospark.sources.shards import fetch, indexed, qualified, shard_table, store_of

SAMPLES = "epoch int, place long, shard string, sample long, key string, members map<string,binary>"


def _order(*what) -> bytes:
    return hashlib.md5(":".join(map(str, what)).encode()).digest()


@dataclass
class Block(InputPartition):
    """`runs` (shard, first sample, end) of an epoch from its place `first` on."""

    epoch: int
    first: int
    runs: list


class Epochs:
    """What a worker reads in which epoch."""

    def __init__(self, shards: Sequence[dict], seed: int, worker: int, workers: int, buffer: int):
        self.shards, self.seed, self.worker, self.workers, self.buffer = shards, seed, worker, workers, buffer
        self.known: dict[int, tuple[list[dict], list[int]]] = {}

    def _ordered(self, epoch: int) -> tuple[list[dict], list[int]]:
        """The worker's shards in the epoch's order, and the place in the epoch where each ends: ordered once, and kept for two epochs, since a batch may end in the next."""
        if epoch not in self.known:
            shards = sorted(self.shards, key=lambda s: _order(self.seed, epoch, s["shard"]))[self.worker :: self.workers]
            self.known = {k: v for k, v in self.known.items() if k == epoch - 1} | {epoch: (shards, list(accumulate(s["samples"] for s in shards)))}
        return self.known[epoch]

    def sequence(self, epoch: int) -> list[dict]:
        return self._ordered(epoch)[0]

    def size(self, epoch: int) -> int:
        ends = self._ordered(epoch)[1]
        return ends[-1] if ends else 0

    def after(self, at: tuple[int, int], blocks: int, epochs: int) -> tuple[int, int]:
        """The place `blocks` blocks on, at most the end of epoch number `epochs` (0: none)."""
        epoch, sample = at
        for _ in range(blocks):
            if epochs and epoch >= epochs:
                break
            sample = min(sample + self.buffer, self.size(epoch))
            if sample >= self.size(epoch):
                epoch, sample = epoch + 1, 0
        return epoch, sample

    def blocks(self, start: tuple[int, int], end: tuple[int, int]) -> Iterator[Block]:
        at = start
        while at < end:
            shards, ends = self._ordered(at[0])
            to = min(at[1] + self.buffer, ends[-1] if ends else 0)
            runs, n = [], at[1]
            while n < to:
                i = bisect_right(ends, n)
                first = n - (ends[i] - shards[i]["samples"])
                take = min(to, ends[i]) - n
                runs.append((shards[i]["shard"], first, first + take))
                n += take
            if runs:
                yield Block(at[0], at[1], runs)
            at = self.after(at, 1, 0)


class _EndlessReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        number = lambda name, default: int(options.get(name, default))
        self.path, self.progress = options["path"], options["progress"]
        self.step, self.epochs, self.seed, self.buffer = number("blocks", 8), number("epochs", 0), number("seed", 42), number("buffer", 1000)
        self.worker, self.workers = number("worker", 0), number("workers", 1)
        self.at: tuple[int, int] | None = None
        self.known: Epochs | None = None

    def _epochs(self) -> Epochs:
        """Read once by each run: tars must not be added meanwhile."""
        if self.known is None:
            shards = shard_table(self.path)
            if not sum(s["samples"] for s in shards):
                raise ValueError(f"{self.path} has no samples")
            self.known = Epochs(shards, self.seed, self.worker, self.workers, self.buffer)
        return self.known

    def _planned(self) -> tuple[int, int]:
        """How far any run has planned: Spark doesn't tell a restarted source where it stands, so it keeps that itself, beside the checkpoint."""
        store, path = store_of(self.progress)
        if store.get_file_info(path).type == fs.FileType.NotFound:
            return (0, 0)
        with store.open_input_stream(path) as f:
            return tuple(json.loads(f.read()))

    def _plan(self, at: tuple[int, int]) -> None:
        store, path = store_of(self.progress)
        with store.open_output_stream(f"{path}.tmp") as f:
            f.write(json.dumps(at).encode())
        store.move(f"{path}.tmp", path)

    def initialOffset(self) -> dict:
        return {"epoch": 0, "sample": 0}

    def latestOffset(self) -> dict:
        at = self.at or self._planned()
        self.at = self._epochs().after(at, self.step, self.epochs)
        if self.at != at:
            self._plan(self.at)
        return {"epoch": self.at[0], "sample": self.at[1]}

    def partitions(self, start: dict, end: dict) -> list[Block]:
        return list(self._epochs().blocks((start["epoch"], start["sample"]), (end["epoch"], end["sample"])))

    def read(self, partition: Block) -> Iterator[tuple]:
        store, folder = store_of(self.path)
        found: dict[tuple[str, int], list[dict]] = {}
        for shard, first, end in partition.runs:
            for m in indexed(store, folder, shard, (ds.field("sample") >= first) & (ds.field("sample") < end)):
                found.setdefault((shard, m["sample"]), []).append(m)
        order = sorted(found, key=lambda k: _order(self.seed, partition.epoch, *k))
        files = {shard: store.open_input_file(f"{folder}/{shard}.tar") for shard, *_ in partition.runs}
        for i, (shard, sample) in enumerate(order):  # the index was shuffled: only one sample's payloads are held
            members = found[shard, sample]
            yield partition.epoch, partition.first + i, shard, sample, members[0]["key"], {m["ext"]: bytes(payload) for m, payload in fetch(files[shard], members)}
        for file in files.values():
            file.close()

    def commit(self, end: dict) -> None:
        pass


class EndlessSamples(DataSource):
    @classmethod
    def name(cls) -> str:
        return "endless_samples"

    def schema(self) -> str:
        return SAMPLES

    def streamReader(self, schema) -> _EndlessReader:
        return _EndlessReader(self.options)


def endless_samples(spark: SparkSession, folder: str, progress: str, *, seed: int = 42, buffer: int = 1000, blocks: int = 8, worker: int = 0, workers: int = 1, epochs: int = 0) -> DataFrame:
    """A stream of samples (epoch, place, shard, sample, key, members by extension) of the indexed tars of a folder, epoch after epoch, or `epochs` of them.

    Each epoch has every sample once over all workers, in another order; `place` is a sample's in its worker's epoch. A micro-batch takes `blocks` blocks of `buffer` samples, each
    read by a task. `progress` is a file of its own for each query, best beside its checkpoint. The same seed and shards give the same stream; tars must not be added while it runs.
    """
    spark.dataSource.register(EndlessSamples)
    options = {"progress": qualified(spark, progress), "seed": seed, "buffer": buffer, "blocks": blocks, "worker": worker, "workers": workers, "epochs": epochs}
    return spark.readStream.format("endless_samples").options(**options).load(qualified(spark, folder))
