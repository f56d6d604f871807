"""Language identification by compression.

For each language a raw-content zstandard dictionary is made of a bounded sample of its texts. A text is
compressed with every dictionary; the smallest result names the language, and how far the second lies
behind is the margin. A narrow margin means that no language fits well: the text is rejected. Case is folded, and a
long text is compressed block by block, all of it: in one piece it would soon refer to itself rather than to the dictionary.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import zstandard as zstd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import tidy

#: Bytes that are compressed at a time.
BLOCK = 4096
#: Pieces that a longer text gives to the sample.
PIECES = 8


def learn_profiles(docs: DataFrame, per_language: int = 64, dict_bytes: int = 112 << 10) -> dict[str, bytes]:
    """Dictionary content by language from rows (doc_id, text, lang).

    The bound on what is learned from is `per_language` rows, those with the smallest hash of their id, and
    `dict_bytes` of their text: each row gives an equal share, and what shorter ones leave goes to the others. Of a text over its share, pieces spread
    evenly over all of it are taken. Null languages and ids, null and empty
    texts are left out; repeated rows count once. Only the bounded sample reaches the driver. No rows give {}.
    """
    known = docs.where("lang is not null and doc_id is not null and text is not null and length(text) > 0")
    rows = known.select("lang", "doc_id", F.xxhash64("doc_id").alias("h"))
    for part in (Window.partitionBy("lang", F.pmod("h", F.lit(64))), Window.partitionBy("lang")):  # a frequent language is cut down in 64 groups first
        rows = rows.withColumn("n", F.row_number().over(part.orderBy("h", "doc_id"))).where(F.col("n") <= per_language).drop("n")
    picked = [r.doc_id for r in rows.select("doc_id").distinct().collect()]  # per_language ids for each language
    if not picked:
        return {}
    rows = known.where(F.col("doc_id").isin(picked)).select("lang", F.xxhash64("doc_id").alias("h"), _spread(F.col("text"), dict_bytes).alias("text"))
    texts: dict[str, dict] = {}
    for r in sorted(rows.toLocalIterator(), key=lambda r: (r.lang, r.h, r.text)):
        texts.setdefault(r.lang, {})[r.text.lower()] = None
    out = {}
    for lang, parts in texts.items():
        raw = [p.encode() + b"\n" for p in parts]
        left, share = dict_bytes, {}
        for n, i in enumerate(sorted(range(len(raw)), key=lambda i: len(raw[i]))):
            share[i] = min(len(raw[i]), left // (len(raw) - n))
            left -= share[i]
        out[lang] = b"".join(r if share[i] == len(r) else _pieces(r, share[i]) for i, r in enumerate(raw))
    return out


def _spread(text: Column, most: int) -> Column:
    """The text, or of a longer one pieces of `most` characters in all, evenly spread over it."""
    step, size = F.length(text) / PIECES, most // PIECES
    parts = [F.substring(text, F.floor(step * k).cast("int") + 1, F.lit(size)) for k in range(PIECES)]
    return F.when(F.length(text) <= most, text).otherwise(F.concat(*parts))


def _pieces(raw: bytes, most: int) -> bytes:
    size = most // PIECES
    return b"".join(raw[i : i + size] for i in range(0, len(raw) - size + 1, max(1, (len(raw) - size) // max(1, PIECES - 1))))[:most] if size else raw[:most]


class _Profiles:
    def __init__(self, profiles: dict[str, bytes], level: int):
        self.by = []
        for lang in sorted(profiles):
            d = zstd.ZstdCompressionDict(profiles[lang], dict_type=zstd.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            c = zstd.ZstdCompressor(level=level, dict_data=d, write_content_size=False, write_dict_id=False)
            self.by.append((lang, c, len(c.compress(b""))))

    def best(self, text: str | None, margin: float) -> tuple[str, float, bool]:
        if not text or not self.by or not any(map(str.isalpha, text)):
            return "und", 0.0, True
        raw = text.lower().encode("utf-8", "replace")
        blocks = [raw[i : i + BLOCK] for i in range(0, len(raw), BLOCK)]
        sizes = sorted((sum(len(c.compress(b)) - empty for b in blocks), lang) for lang, c, empty in self.by)
        (least, lang), second = sizes[0], sizes[1][0] if len(sizes) > 1 else 2 * sizes[0][0]
        gap = (second - least) / max(second, 1)
        return lang, min(1.0, max(0.0, 0.5 + gap)), gap < margin


def identify(docs: DataFrame, profiles: dict[str, bytes], *, level: int = 6, margin: float = 0.002) -> DataFrame:
    """docs with lang_pred, score and rejected added (columns of these names are replaced).

    score is 0.5 plus the share by which the smallest size lies below the second, at most 1; rejected holds where
    that share is below `margin`, and where the text is null or has no letter (lang_pred `und`, score 0). Ties go to the first
    language by code point. Repeated rows are judged alike, without profiles all rows are `und` and rejected, an empty table gives
    an empty table. The dictionaries, `dict_bytes` for each language, go to the tasks with the function. Nothing is shuffled; a whole text is compressed in the task that reads it.
    """
    docs = docs.drop("lang_pred", "score", "rejected")
    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _Profiles(profiles, level)
        for b in batches:
            found = [model.best(t.as_py(), margin) for t in b.column("text")]
            extra = [pa.array([f[i] for f in found], k) for i, k in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*b.columns, *extra], names=[*b.schema.names, "lang_pred", "score", "rejected"])

    return docs.mapInArrow(tidy(run), schema)
