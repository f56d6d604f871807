"""Audit of how filters interact: what each one removes at each place of every order, and what it alone would remove.

Every document is measured once and gets a mask: bit i says that it fails filter i. All that an audit asks of a part of the corpus is how many
documents have each mask, so the rest works on 2**n cells a part. A Gray-code walk visits all subsets of active filters, one toggle at a time: each
cell counts its active failures, and survivors change by the cells whose counter leaves or returns to zero. The states of all subsets are stored, and each
step of an order is the difference of two of them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Mapping
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SLICE_BYTES, tidy

_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_WITHIN = bytes(range(0x80, 0xC0))  # bytes of a code point after its first
SYMBOLS = b"#$%&*|"

#: The failure conditions of the audit, on columns of `measure` and `is_copy`, in order of their letters.
FILTERS: dict[str, Column | str] = {
    "A": "n_words < 50",
    "B": "100 * n_distinct < 65 * n_words",
    "C": "100 * n_upper > 5 * n_chars",
    "D": "n_symbols > 0",
    "E": "is_copy",
}


def slices(text: bytes, most: int = SLICE_BYTES) -> Iterator[bytes]:
    """text in pieces of about `most` bytes that end where a word does."""
    start = 0
    while len(text) - start > most:
        found = _SPACE.search(text, start + most)
        if found is None:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:] if start else text


_MEASURES = "n_words long, n_distinct long, n_chars long, n_upper long, n_symbols long, digest binary"


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for value in b.column("_text"):
            text = value.as_py()
            words, distinct = 0, set()
            for piece in slices(text):
                found = piece.split()
                words += len(found)
                distinct.update(found)
            lost = [len(text) - len(text.translate(None, gone)) for gone in (_WITHIN, _UPPER, SYMBOLS)]
            rows.append((words, len(distinct), len(text) - lost[0], *lost[1:], hashlib.blake2b(text, digest_size=16).digest()))
        columns = list(zip(*rows)) or [()] * 6
        names = [n for n in b.schema.names if n != "_text"]
        values = [pa.array(c, pa.int64()) for c in columns[:5]] + [pa.array(columns[5], pa.binary())]
        yield pa.RecordBatch.from_arrays([*[b.column(n) for n in names], *values], names=[*names, "n_words", "n_distinct", "n_chars", "n_upper", "n_symbols", "digest"])


def measure(docs: DataFrame, part: str = "source") -> DataFrame:
    """doc_id, part, numbers of words, distinct words, code points, letters A-Z and symbols of each whole text, and a digest of 128 bits.

    Null texts count as empty, a null part as the empty string; repeated rows stay; other columns are left out. An empty table gives an empty table.
    A text is split in slices, so a task holds one text and its distinct words.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("_text"))
    return rows.mapInArrow(tidy(_measure), "doc_id long, part string, " + _MEASURES)


def _mask(filters: Mapping[str, Column | str], names: list[str]) -> Column:
    """One bit for each filter of `names`, at its place among all; a condition that is null doesn't fail."""
    out = F.lit(0)
    for i, (name, fails) in enumerate(filters.items()):
        if name in names:
            out = out + F.when(F.expr(fails) if isinstance(fails, str) else fails, 1 << i).otherwise(0)
    return out


def cells(docs: DataFrame, labels: DataFrame, filters: Mapping[str, Column | str] = FILTERS, part: str = "source", copies: str | None = "E") -> DataFrame:
    """How many documents of each part fail which filters: part, fails (mask), n, good, toxic.

    The filter named `copies` (none if null) fails where a text equals that of any smaller doc_id of the whole table. Null ids are neither smaller nor
    larger, so they fail nothing there; rows that share the smallest id and the text don't fail. A document counts as good or toxic if any row of `labels` with its
    id says 1; labels of unknown ids are ignored.

    No group of copies is gathered: rows shrink to (text's digest, part, labels, least id) before they meet by digest. Null ids are dealt by partition.
    """
    plain = [f for f in filters if f != copies]
    rows = measure(docs, part).select("doc_id", "part", "digest", _mask(filters, plain).alias("fails"), F.when(F.col("doc_id").isNull(), F.spark_partition_id() + 1).otherwise(0).alias("_deal"))
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(*[F.max(F.coalesce(F.col(c) == 1, F.lit(False)).cast("long")).alias(f"_{m}") for m, c in (("good", "quality"), ("toxic", "toxic"))])
    rows = rows.join(marks.withColumn("_deal", F.lit(0)), ["doc_id", "_deal"], "left").withColumns({m: F.coalesce(f"_{m}", F.lit(0)) for m in ("good", "toxic")})
    cell = ["part", "fails", "good", "toxic"]
    if copies is None:
        out = rows.groupBy(*cell).agg(F.count("*").alias("n"))
    else:
        # Rows of one id meet where the join has put them; then those of one text, part and label shrink to one row.
        by_id = rows.groupBy("doc_id", "_deal", "digest", *cell).agg(F.count("*").alias("n"))
        by_text = by_id.groupBy("digest", *cell).agg(F.sum("n").alias("n"), F.min("doc_id").alias("least"), F.min_by("n", "doc_id").alias("n_least"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("n_unknown"))
        first = F.min("least").over(Window.partitionBy("digest"))
        free = F.col("n_unknown") + F.when(F.col("least") == first, F.col("n_least")).otherwise(0)
        bit = 1 << list(filters).index(copies)
        split = F.explode(F.array(F.struct(F.lit(0).alias("bit"), F.col("free").alias("m")), F.struct(F.lit(bit).alias("bit"), (F.col("n") - F.col("free")).alias("m"))))
        out = by_text.withColumn("free", free).select(*cell, split.alias("s")).where("s.m > 0").groupBy("part", (F.col("fails") + F.col("s.bit")).alias("fails"), "good", "toxic").agg(F.sum("s.m").alias("n"))
    return out.groupBy("part", "fails").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic"))


def gray_states(counts: np.ndarray) -> np.ndarray:
    """counts[..., mask] of documents by what they fail -> survivors[..., subset] for every subset of active filters."""
    n = counts.shape[-1].bit_length() - 1
    masks, active = np.arange(1 << n), np.zeros(1 << n, np.int64)
    states, running, subset = np.empty_like(counts), counts.sum(-1), 0
    states[..., 0] = running
    for step in range(1, 1 << n):
        f = (step & -step).bit_length() - 1
        hit = (masks >> f & 1).astype(bool)
        subset ^= 1 << f
        if subset >> f & 1:
            running = running - counts[..., hit & (active == 0)].sum(-1)
            active[hit] += 1
        else:
            active[hit] -= 1
            running = running + counts[..., hit & (active == 0)].sum(-1)
        states[..., subset] = running
    return states


def _walk(names: list[str]):
    n = len(names)
    orders = list(permutations(range(n)))
    steps = np.array([(sum(1 << f for f in o[:k]), f) for o in orders for k, f in enumerate(o)]).reshape(-1, 2)
    before, which = steps[:, 0], steps[:, 1]
    after = before | 1 << which
    texts = [x for o in orders for x in ["".join(names[f] for f in o)] * n]
    place = np.tile(np.arange(1, n + 1, dtype=np.int32), len(orders))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, held in zip(b.column("part").to_pylist(), b.column("cells").to_pylist()):
                counts = np.zeros((3, 1 << n), np.int64)
                for c in held:
                    counts[:, c["fails"]] = c["n"], c["good"], c["toxic"]
                states = gray_states(counts)
                kept = states[:, after]
                removed = states[:, before] - kept
                failing = np.array([counts[0, (np.arange(1 << n) >> f & 1) == 1].sum() for f in range(n)], np.int64)
                alone = counts[0, 1 << np.arange(n)]
                shapley = np.zeros(n, np.int64)
                np.add.at(shapley, which, removed[0])
                values = [kept[0], removed[0], failing[which] - removed[0], alone[which], removed[1], removed[2], shapley[which]]
                yield pa.RecordBatch.from_arrays([pa.array([part] * len(texts), pa.string()), pa.array(texts, pa.string()), pa.array(place), *[pa.array(v, pa.int64()) for v in values]], names=_AUDIT)

    return run


_AUDIT = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def audit(cell_rows: DataFrame, names: list[str]) -> DataFrame:
    """Each part, order of the filters and step (from 1; its filter is that letter): kept after this step, removed by it, redundant (fails its filter but was removed before),
    unique_fails (fails its filter only), good_lost and toxic_lost (removed here), shapley (what the filter removes, summed over all orders).

    A part's cells, at most 2**n, meet in one row; a table without rows gives none. With n filters a part has n! * n rows, zeros included.
    """
    by_part = cell_rows.groupBy("part").agg(F.collect_list(F.struct("fails", "n", "good", "toxic")).alias("cells"))
    kinds = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in _AUDIT[3:])
    return by_part.mapInArrow(_walk(names), kinds)


#: The same audit in DuckDB's SQL: every order and step counts the cells anew.
AUDIT_SQL = r"""
with w as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents),
l as (select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic from labels group by doc_id),
f as (select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
  case when len(words) < 50 then 1 else 0 end + case when 100 * len(list_distinct(words)) < 65 * len(words) then 2 else 0 end
  + case when 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t) then 4 else 0 end + case when regexp_matches(t, '[#$%&*|]') then 8 else 0 end
  + case when doc_id > min(doc_id) over (partition by t) then 16 else 0 end as fails from w left join l using (doc_id)),
c as (select part, fails, count(*) as n, sum(good) as good, sum(toxic) as toxic from f group by part, fails),
b as (select unnest(['A', 'B', 'C', 'D', 'E']) as letter, unnest([1, 2, 4, 8, 16]) as bit),
o as (select b1.letter || b2.letter || b3.letter || b4.letter || b5.letter as filter_order, [b1.bit, b2.bit, b3.bit, b4.bit, b5.bit] as bits
  from b b1, b b2, b b3, b b4, b b5 where b1.bit + b2.bit + b3.bit + b4.bit + b5.bit = 31),
s as (select filter_order, k::int as step, bits[k] as bit, coalesce(list_sum(bits[:k - 1]), 0)::int as before from o, unnest([1, 2, 3, 4, 5]) t(k)),
r as (select part, filter_order, step, bit,
  sum(case when fails & (before | bit) = 0 then n else 0 end)::bigint as kept, sum(case when fails & before = 0 and fails & bit <> 0 then n else 0 end)::bigint as removed,
  sum(case when fails & before <> 0 and fails & bit <> 0 then n else 0 end)::bigint as redundant, sum(case when fails = bit then n else 0 end)::bigint as unique_fails,
  sum(case when fails & before = 0 and fails & bit <> 0 then good else 0 end)::bigint as good_lost, sum(case when fails & before = 0 and fails & bit <> 0 then toxic else 0 end)::bigint as toxic_lost
  from c, s group by part, filter_order, step, bit)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, sum(removed) over (partition by part, bit)::bigint as shapley from r
"""
