"""Manifests: contracts, joins of sources, declarative filters, upserts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annospark.functions.columns import stem

ID = "wav_id"


def normalize(manifest: DataFrame, root: str, path: str = "path") -> DataFrame:
    """Absolute paths, first column `path`; null paths are dropped and the former path is kept as path_legacy where it changed."""
    rows = manifest.where(F.col(path).isNotNull())
    full = F.when(F.col(path).startswith("/"), F.col(path)).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), F.col(path)))
    rest = [c for c in manifest.columns if c != path]
    out = rows.select(full.alias("path"), *rest, F.when(full != F.col(path), F.col(path)).alias("path_legacy"))
    return out.withColumn("uid", stem(F.col("path"))) if "uid" not in rest else out


def duplicate_ids(manifest: DataFrame, key: str = "uid") -> DataFrame:
    """Ids that occur more than once, with their counts."""
    return manifest.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def contract(manifest: DataFrame, key: str = ID) -> DataFrame:
    """Checks that the id column is there and makes it a string."""
    if key not in manifest.columns:
        raise ValueError(f"a manifest needs the column {key}; it has {', '.join(manifest.columns)}")
    return manifest.withColumn(key, F.col(key).cast("string"))


def select_columns(manifest: DataFrame, columns: Sequence[str], key: str = ID) -> DataFrame:
    """The named columns, the id always among them."""
    return manifest.select(key, *[c for c in columns if c != key])


def rename_columns(manifest: DataFrame, names: dict[str, str], key: str = ID) -> DataFrame:
    """Renames columns; the id can't be renamed."""
    if key in names:
        raise ValueError(f"{key} can't be renamed")
    return manifest.withColumnsRenamed(names)


def unique_ids(manifest: DataFrame, key: str = ID) -> DataFrame:
    """Distinct ids in order."""
    return manifest.select(key).distinct().orderBy(key)


def has_id(manifest: DataFrame, value: str, key: str = ID) -> bool:
    return not manifest.where(F.col(key) == value).isEmpty()


def big_join(manifests: Sequence[tuple[str, DataFrame]], how: str = "inner", key: str = ID) -> DataFrame:
    """Joins manifests (source, table) from the left on the id. A column that is there already gets the suffix _{source}."""
    if not manifests:
        raise ValueError("no manifests to join")
    how = {"outer": "full"}.get(how, how)
    out = manifests[0][1]
    for source, right in manifests[1:]:
        clash = {c: f"{c}_{source}" for c in right.columns if c in out.columns and c != key}
        out = out.join(right.withColumnsRenamed(clash), key, how)
    return out


@dataclass(frozen=True)
class Filters:
    """Criteria that a manifest's rows must all meet; one whose column is missing is left out, and a null value meets none."""

    min_duration: float | None = None
    max_duration: float | None = None
    min_speech_ratio: float | None = None
    max_speech_ratio: float | None = None
    min_snr_db: float | None = None
    max_snr_db: float | None = None
    min_c50_db: float | None = None
    max_c50_db: float | None = None
    min_vtc_segments: int | None = None
    required_labels: tuple[str, ...] = ()
    excluded_categories: tuple[str, ...] = ()
    max_dominant_prob: float | None = None

    def predicates(self, columns: Sequence[str]) -> list[Column]:
        bounds = {"duration": (self.min_duration, self.max_duration), "speech_ratio": (self.min_speech_ratio, self.max_speech_ratio), "snr_mean": (self.min_snr_db, self.max_snr_db), "c50_mean": (self.min_c50_db, self.max_c50_db), "vtc_n_segments": (self.min_vtc_segments, None), "dominant_prob": (None, self.max_dominant_prob)}
        out = [F.col(c) >= lo for c, (lo, _) in bounds.items() if lo is not None and c in columns]
        out += [F.col(c) <= hi for c, (_, hi) in bounds.items() if hi is not None and c in columns]
        if self.required_labels and "vtc_label_counts" in columns:
            out.append(reduce(lambda a, b: a | b, [F.col("vtc_label_counts").contains(f'"{x}"') for x in self.required_labels]))
        if self.excluded_categories and "dominant_category" in columns:
            out.append(~F.col("dominant_category").isin(*self.excluded_categories))
        return out

    def apply(self, manifest: DataFrame) -> DataFrame:
        return reduce(lambda df, p: df.where(p), self.predicates(manifest.columns), manifest)


def build_manifest(stages: dict[str, DataFrame | None], filters: Filters | None = None, how: str = "inner", wanted: Sequence[str] | None = None) -> DataFrame:
    """Joins the stages that are there and filters. Unknown wanted stages are ignored; none at all is an error."""
    have = [(name, contract(df)) for name, df in stages.items() if df is not None and (wanted is None or name in wanted)]
    if not have:
        raise ValueError("none of the stages has a table")
    out = big_join(have, how)
    return filters.apply(out) if filters else out


def keep_allowed(samples: DataFrame, manifest: DataFrame, key: str = ID) -> DataFrame:
    """Samples whose id passed the filters."""
    return samples.join(manifest.select(key).distinct(), key, "left_semi")


def with_duration(recordings: DataFrame, durations: DataFrame, key: str = "uid") -> tuple[DataFrame, DataFrame]:
    """Recordings with their duration, and those that have none."""
    both = recordings.join(durations, key, "left")
    return both.where("dur_ms is not null"), both.where("dur_ms is null").drop("dur_ms")


def last_path(manifest: DataFrame, position: str, key: str = "uid", path: str = "path") -> DataFrame:
    """One path for each id: the last by position."""
    return manifest.groupBy(key).agg(F.max_by(path, position).alias(path))


def remaining(manifest: DataFrame, done: DataFrame, key: str = "uid") -> DataFrame:
    """Rows whose id hasn't been processed yet."""
    return manifest.join(done.select(key).distinct(), key, "left_anti")


def upsert(old: DataFrame, new: DataFrame, key: str = "uid", order: str | None = None) -> DataFrame:
    """Replaces the rows of re-processed ids; with an order column only the last row of an id stays, else full-row duplicates go."""
    out = old.join(new.select(key).distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True)
    if order is None:
        return out.distinct()
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order)))
    return out.withColumn("_rn", rank).where("_rn = 1").drop("_rn")


def merge_stores(stores: Sequence[tuple[str, DataFrame]], strict: bool = True, key: str = ID) -> DataFrame:
    """Columns of several stores under {namespace}.{column}, by id; strict keeps ids that all stores have."""
    named = [(n, df.select(key, *[F.col(c).alias(f"{n}.{c}") for c in df.columns if c != key])) for n, df in stores]
    return big_join(named, "inner" if strict else "full", key)


def all_ids(tables: Sequence[DataFrame], strict: bool = False, key: str = ID) -> DataFrame:
    """Ids of any table, or of all."""
    ids = [t.select(key).distinct() for t in tables]
    return reduce(lambda a, b: a.intersect(b), ids) if strict else reduce(lambda a, b: a.unionByName(b), ids).distinct()


def keep_last(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key."""
    return rows.withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order)))).where("_rn = 1").drop("_rn")


@dataclass(frozen=True)
class Adapter:
    """How the tables of one source are read: the column with the recording's id, which rows count as successful, and whether each needs its array file."""

    source: str
    key: str
    success: str
    needs_arrays: bool = False

    def as_manifest(self, meta: DataFrame) -> DataFrame:
        """The metadata with the id renamed, for joins."""
        return meta.withColumnRenamed(self.key, ID)

    def list_ids(self, meta: DataFrame) -> DataFrame:
        """Ids that were processed with success."""
        return meta.where(self.success).select(F.col(self.key).alias(ID)).where(F.col(ID).isNotNull()).distinct()

    def existing(self, meta: DataFrame, arrays: DataFrame | None = None) -> DataFrame:
        """Ids whose outputs are there: processed with success, and with an array file where the source has them; `arrays` has a row (uid, ...) for each
        of these files, as scan_files or read_npz give them."""
        if not self.needs_arrays:
            return self.list_ids(meta)
        if arrays is None:
            raise ValueError(f"{self.source} needs the table of its array files")
        return self.list_ids(meta).join(arrays.select(F.col("uid").alias(ID)).distinct(), ID, "left_semi")

    def exists(self, meta: DataFrame, value, arrays: DataFrame | None = None) -> bool:
        return not self.existing(meta.where(F.col(self.key) == value), arrays).isEmpty()

    def load(self, meta: DataFrame, value, **segments: DataFrame) -> dict[str, DataFrame]:
        """The metadata row and the named tables (raw, merged, arrays ...) of one recording; an unknown id is an error."""
        own = self.as_manifest(meta).where(F.col(ID) == value)
        if own.isEmpty():
            raise FileNotFoundError(f"{self.source} has no metadata for {value}")
        return {"meta": own} | {name: df.where(F.col("uid") == value) for name, df in segments.items()}


#: The sources that the loader joins; their status columns and id columns are fixed values.
ADAPTERS = {a.source: a for a in (Adapter("vad", "file_id", "success"), Adapter("vtc", "uid", "error = ''"), Adapter("snr", "uid", "snr_status = 'ok'", True), Adapter("esc", "uid", "esc_status = 'ok'", True))}
