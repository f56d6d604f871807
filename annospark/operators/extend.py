"""Places to plug in own code: scorers, clip features, transforms, cached results."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annospark.sources.tables import ParquetStore


@dataclass(frozen=True)
class Scorer:
    """A named, versioned function over pandas batches, for what needs a model: runs by mapInPandas."""

    name: str
    version: str
    schema: str
    run: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]

    def apply(self, rows: DataFrame) -> DataFrame:
        return rows.mapInPandas(self.run, self.schema).withColumns({"scorer": F.lit(self.name), "version": F.lit(self.version)})


@dataclass
class Registry:
    """Scorers by name; a name can be taken once."""

    scorers: dict[str, Scorer] = field(default_factory=dict)

    def register(self, scorer: Scorer) -> Scorer:
        if scorer.name in self.scorers:
            raise ValueError(f"the scorer {scorer.name} is registered already")
        self.scorers[scorer.name] = scorer
        return scorer

    def get(self, name: str) -> Scorer:
        if name not in self.scorers:
            raise KeyError(f"no scorer {name}; there are {', '.join(sorted(self.scorers)) or 'none'}")
        return self.scorers[name]


def enrich_clips(clips: DataFrame, enrichers: Sequence[Callable[[DataFrame], DataFrame]], keys: Sequence[str] = ("uid", "clip_idx")) -> DataFrame:
    """Joins each enricher's columns to the clips; columns that are there already stay as they are."""
    out = clips
    for enrich in enrichers:
        extra = enrich(clips)
        new = [c for c in extra.columns if c not in out.columns]
        out = out.join(extra.select(*keys, *new), list(keys), "left")
    return out


def document(core: Sequence[str], extra: Sequence[str]):
    """A JSON document of core columns and those extra ones whose name isn't taken."""
    return F.to_json(F.struct(*core, *[c for c in extra if c not in core]))


def compose(*steps: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """One step that does all, in turn."""

    def run(df: DataFrame) -> DataFrame:
        for step in steps:
            df = df.transform(step)
        return df

    return run


def fingerprints(rows: DataFrame, key: str = "uid") -> DataFrame:
    """A digest of all rows of each key, whatever their order: key, source_print. Two sums of hashes and the count; rows without a key are left out."""
    columns = sorted(c for c in rows.columns)
    hashes = [F.sum(F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in columns]).cast("decimal(38,0)")) for seed in (1, 2)]
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.sha2(F.concat_ws(":", F.lit(",".join(columns)), F.count("*").cast("string"), *[h.cast("string") for h in hashes]), 256).alias("source_print"))


def cached(spark: SparkSession, source: DataFrame, step: Callable[[DataFrame], DataFrame], folder: str, name: str, version: str, params: dict, key: str = "uid") -> DataFrame:
    """The step's rows for the source's keys, computed only for keys that are new or whose rows have changed since they were cached.

    `step` works on each key's rows on their own and keeps the key. A folder belongs to a name, version and parameters. An entry is addressed by its key and the fingerprint
    of the key's source rows, so a changed row is computed anew, and a key that the source has no more isn't returned. Results carry their provenance: cache_name, cache_version,
    cache_params, source_id, source_print, cached_at. Entries become visible after the rows they stand for, so what was cut off is computed again and
    replaces what it had written.
    """
    digest = hashlib.sha256(json.dumps([name, version, params], sort_keys=True).encode()).hexdigest()[:16]
    results, entries = (ParquetStore(spark, f"{folder}/{name}-{digest}/{part}", key) for part in ("results", "entries"))
    prints = fingerprints(source, key)
    known = entries.table_or_none()
    todo = prints if known is None else prints.join(known, [key, "source_print"], "left_anti")
    todo = todo.checkpoint()  # else it would change once it is written
    if not todo.isEmpty():
        marks = {"cache_name": F.lit(name), "cache_version": F.lit(version), "cache_params": F.lit(json.dumps(params, sort_keys=True)), "source_id": F.col(key).cast("string"), "cached_at": F.current_timestamp()}
        # Written before it is saved: a save looks at its rows more than once, and the step may be dear.
        results.save(step(source.join(todo.select(key), key, "left_semi")).join(todo, key).withColumns(marks).checkpoint())
        entries.save(todo)
    return results.table().join(prints, [key, "source_print"], "left_semi")


@dataclass(frozen=True)
class Processor:
    """A named, versioned step whose results are kept by key: process what is left, validate, save, load."""

    name: str
    version: str
    step: Callable[[DataFrame], DataFrame]
    valid: Column | None = None
    key: str = "wav_id"

    def store(self, spark: SparkSession, folder: str) -> ParquetStore:
        return ParquetStore(spark, f"{folder}/{self.name}-{self.version}", self.key)

    def validate(self, results: DataFrame) -> DataFrame:
        """Rows that don't conform: none without a condition; a condition that is null doesn't hold."""
        return results.limit(0) if self.valid is None else results.where(~F.coalesce(self.valid, F.lit(False)))

    def save(self, results: DataFrame, folder: str) -> None:
        """Saves results by key, replacing earlier ones; an error, and nothing saved, if any isn't valid."""
        bad = self.validate(results).select(self.key).take(5)
        if bad:
            raise ValueError(f"{self.name}: results that aren't valid, of {', '.join(str(r[0]) for r in bad)} and perhaps others")
        self.store(results.sparkSession, folder).save(results)

    def pending(self, rows: DataFrame, folder: str) -> DataFrame:
        """Rows whose key has no saved result."""
        have = self.store(rows.sparkSession, folder).table_or_none()
        return rows if have is None else rows.join(have.select(self.key).distinct(), self.key, "left_anti")

    def run(self, rows: DataFrame, folder: str) -> DataFrame:
        """Processes the keys that are left, saves them and returns the results of all saved keys."""
        spark = rows.sparkSession
        results = self.step(self.pending(rows, folder)).checkpoint()  # validated and saved as one
        if not results.isEmpty():
            self.save(results, folder)
        saved = self.store(spark, folder).table_or_none()
        return results if saved is None else saved

    def exists(self, spark: SparkSession, folder: str, value) -> bool:
        have = self.store(spark, folder).table_or_none()
        return have is not None and not have.where(F.col(self.key) == value).isEmpty()

    def load(self, spark: SparkSession, folder: str, value) -> DataFrame:
        """The saved rows of one key; an error if there are none."""
        if not self.exists(spark, folder, value):
            raise FileNotFoundError(f"{self.name} has no result for {value}")
        return self.store(spark, folder).load(value)
