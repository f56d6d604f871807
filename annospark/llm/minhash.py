"""Near-duplicate documents by a signature-coordinate inverted join.

Documents with the same shingles form a class; one of them stands for it. Each representative is posted under every (coordinate,
value) pair of a prefix of its MinHash signature: two signatures that agree in t of k coordinates agree in one of any k - t + 1, so
shorter lists lose nothing. Documents that meet in a list count in how many coordinates they collide: the lists of the other coordinates
are merged, by the same prefix only the shortest of them, skipping the long ones, and what comes up is counted in all. Those with t
collisions are joined to a cluster; a list hands on a spanning forest of these links, never all pairs. Within a cluster, whole
shingle sets confirm the links: the search grows one component at a time and asks only for links to documents outside it.

A cluster with more shingles than a block has first meets a few of its own documents, in one pass over it: what is linked with these forms
groups. The largest group, in blocks, is then searched together with the blocks of the rest, and the rest with itself, so that any two
documents that aren't in one group yet meet somewhere and no task holds more than two blocks; the components of all links are joined in the end.
t is the greatest number that a pair at the threshold misses with a probability of 1e-5 at most.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Rolling, byte_slices, checkpoint_ready, components, cut_lineage, mixed, shuffle_parts, tidy

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_ODD = mixed(np.arange(1, 65, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_KEYS = mixed(np.arange(1001, 1257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)
#: Documents that a large cluster meets first.
HUBS = 16


def needed_matches(k: int, similarity: float, miss: float = 1e-5) -> int:
    """Greatest t such that a pair of this similarity agrees in fewer than t of k coordinates with probability `miss` at most."""
    total, t = 0.0, 0
    while t < k:
        total += math.comb(k, t) * similarity**t * (1 - similarity) ** (k - t)
        if total > miss:
            break
        t += 1
    return max(1, t)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """For each row of the byte slice its distinct shingles as sorted 64-bit hashes. Words are parted by ASCII white space, A-Z lower-cased."""
    low = data.copy()
    upper = (low >= 65) & (low <= 90)
    low[upper] += 32
    word = ~_SPACE[low]
    before = np.concatenate(([False], word[:-1])) if len(word) else word.copy()
    inner = offsets[1:-1][offsets[1:-1] < len(word)]
    before[inner] = False
    starts = np.flatnonzero(word & ~before)
    after = np.concatenate((word[1:], [False])) if len(word) else word.copy()
    ends_at = inner[inner > 0] - 1
    after[ends_at] = False
    ends = np.flatnonzero(word & ~after) + 1
    hashes = Rolling(low).between(starts, ends)
    edges = np.searchsorted(starts, offsets)
    full = np.zeros(max(0, len(hashes) - size + 1), np.uint64)
    for j in range(size):
        full += hashes[j : len(hashes) - size + 1 + j] * _ODD[j]
    full = mixed(full)
    out = []
    for s, e in zip(edges[:-1].tolist(), edges[1:].tolist()):
        if e - s >= size:
            out.append(np.unique(full[s : e - size + 1]))
        elif e > s:
            out.append(mixed((hashes[s:e] * _ODD[: e - s]).sum(dtype=np.uint64, keepdims=True) + _ODD[size + e - s]))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _signature(s: np.ndarray, k: int) -> np.ndarray:
    out = np.full(k, 0xFFFFFFFF, np.uint64)
    for i in range(0, len(s), 4096):
        np.minimum(out, (((s[i : i + 4096, None] ^ _KEYS[None, :k]) * _KEYS[None, k : 2 * k]) >> np.uint64(32)).min(0), out=out)
    return out.astype("<u4")


def _sketch(size: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, offsets in byte_slices(b):
                sets = shingle_sets(data, offsets, size)
                a = np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
                x = np.array([np.bitwise_xor.reduce(mixed(s * _ODD[63])) if len(s) else 0 for s in sets], np.uint64).view(np.int64)
                sig = [_signature(s, k).tobytes() for s in sets]
                yield pa.RecordBatch.from_arrays([*[b.column(c).slice(i, j - i) for c in ("doc_id", "text_hash")], pa.array([len(s) for s in sets], pa.int64()), pa.array(a), pa.array(x), pa.array(sig, pa.binary())], names=["doc_id", "text_hash", "n_shingles", "key_a", "key_b", "sig"])

    return tidy(run)


def _post(k: int, prefix: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Postings of a batch, packed by bucket: (coordinate, value), document and signature."""
        for b in batches:
            if not b.num_rows:
                continue
            sig = np.frombuffer(b"".join(b.column("sig").to_pylist()), "<u4").reshape(-1, k)
            ids = np.array(b.column("rep").to_pylist(), np.int64)
            at = (sig[:, :prefix].astype(np.uint64) | (np.arange(prefix, dtype=np.uint64) << np.uint64(32))).ravel()
            bucket = (mixed(at * _ODD[60]) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
            rows = [(n, at[o].tobytes(), ids[o // prefix].tobytes(), sig[o // prefix].tobytes()) for n in range(buckets) if len(o := order[edges[n] : edges[n + 1]])]
            for i in range(0, len(rows), 256):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[i : i + 256]), (pa.int32(), *[pa.binary()] * 3))], names=["bucket", "at", "ids", "sigs"])

    return tidy(run)


def _forest(sig: np.ndarray, need: int) -> np.ndarray:
    """Smallest index of each row's component, rows being linked if they agree in `need` columns.

    A row looks for partners outside its component in its k - need + 1 shortest lists of rows with its value in a column: whoever agrees in
    `need` columns is in one of them. The lists are made anew each time half of their rows have found a component.
    """
    m, k = sig.shape
    label, outside, left = np.full(m, -1), np.ones(m, bool), m

    def listed() -> tuple[list, np.ndarray, np.ndarray]:
        rows = np.flatnonzero(outside)
        by = [np.argsort(sig[rows, c], kind="stable") for c in range(k)]
        values = [sig[rows[o], c] for c, o in enumerate(by)]
        return [rows[o] for o in by], *(np.stack([np.searchsorted(v, sig[:, c], side) for c, v in enumerate(values)], 1) for side in ("left", "right"))

    held, first, end = listed()
    at_index = left
    for seed in range(m):
        if not outside[seed]:
            continue
        outside[seed], label[seed], left = False, seed, left - 1
        todo = [seed]
        while todo and left:
            d = todo.pop()
            if 2 * left < at_index:
                (held, first, end), at_index = listed(), left
            few = np.argsort(end[d] - first[d], kind="stable")[: k - need + 1]
            near = np.concatenate([held[c][first[d, c] : end[d, c]] for c in few])
            near = np.unique(near[outside[near]])
            near = near[(sig[near] == sig[d]).sum(1) >= need]
            outside[near], label[near], left = False, seed, left - len(near)
            todo += near.tolist()
    return label


def _links(k: int, need: int):
    def each(table: pa.Table) -> pa.Table:
        at, ids, sig = (b"".join(table.column(c).to_pylist()) for c in ("at", "ids", "sigs"))
        at, ids, sig = np.frombuffer(at, np.uint64), np.frombuffer(ids, np.int64), np.frombuffer(sig, "<u4").reshape(-1, k)
        order = np.lexsort((ids, at))
        at, ids = at[order], ids[order]
        edge = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1], [True])))
        length = np.diff(edge)
        a, b = [], []
        short = np.repeat(length, length) <= 24
        place = np.arange(len(at)) - np.repeat(edge[:-1], length)
        left = np.repeat(length, length) - place  # documents of the list from here on
        for lag in range(1, int(length[length <= 24].max(initial=1))):
            i = np.flatnonzero(short & (left > lag))
            same = (sig[order[i]] == sig[order[i + lag]]).sum(1) >= need
            a.append(ids[i[same]])
            b.append(ids[i[same] + lag])
        for n in np.flatnonzero(length > 24):
            s = slice(edge[n], edge[n + 1])
            label = _forest(sig[order[s]], need)
            other = np.flatnonzero(label != np.arange(len(label)))
            a.append(ids[s][label[other]])
            b.append(ids[s][other])
        pairs = np.unique(np.stack([np.concatenate(a), np.concatenate(b)], 1), axis=0) if a else np.zeros((0, 2), np.int64)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return each


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, offsets in byte_slices(b):
                sets = shingle_sets(data, offsets, size)
                keys = [b.column(c).slice(i, j - i) for c in ("component", "blocks", "rep")]
                yield pa.RecordBatch.from_arrays([*keys, pa.array([s.tobytes() for s in sets], pa.binary())], names=["component", "blocks", "rep", "shingles"])

    return tidy(run)


def _met(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Which of its cluster's hubs each document is linked with: rows (rep, hub)."""
        for b in batches:
            reps, hubs = [], []
            for rep, raw, others in zip(b.column("rep").to_pylist(), b.column("shingles").to_pylist(), b.column("hubs").to_pylist()):
                own = np.frombuffer(raw, np.uint64)
                for hub in others:
                    other = np.frombuffer(hub["shingles"], np.uint64)
                    shared = len(np.intersect1d(own, other, assume_unique=True))
                    if shared and 100 * shared >= percent * (len(own) + len(other) - shared):
                        reps.append(rep)
                        hubs.append(hub["rep"])
            yield pa.RecordBatch.from_arrays([pa.array(reps, pa.int64()), pa.array(hubs, pa.int64())], names=["rep", "hub"])

    return tidy(run)


def confirmed(ids: np.ndarray, sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Smallest id of each document's component, two being linked if 100 * shared >= percent * all of their shingles."""
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, term = np.unique(np.concatenate(sets), return_inverse=True)
    mine = np.split(term, np.cumsum(sizes)[:-1])
    out, outside = np.full(len(ids), -1, np.int64), np.ones(len(ids), bool)

    def listed() -> tuple[np.ndarray, np.ndarray]:
        keep = outside[owner]
        by = np.argsort(term[keep], kind="stable")
        return owner[keep][by], np.searchsorted(term[keep][by], np.arange(term.max() + 2))

    who, edge = listed()
    at_index = outside.sum()
    for seed in np.argsort(ids, kind="stable"):
        if not outside[seed]:
            continue
        outside[seed] = False
        out[seed] = ids[seed]
        todo = [seed]
        while todo:
            d = todo.pop()
            left = outside.sum()
            if not left:
                continue
            if 2 * left < at_index:
                (who, edge), at_index = listed(), left
            t = mine[d]
            n = edge[t + 1] - edge[t]
            flat = np.repeat(edge[t] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
            shared = np.bincount(who[flat], minlength=len(ids))
            linked = np.flatnonzero(outside & (100 * shared >= percent * (sizes[d] + sizes - shared)) & (shared > 0))
            outside[linked] = False
            out[linked] = ids[seed]
            todo += linked.tolist()
    return out


def _confirm(percent: int):
    def each(table: pa.Table) -> pa.Table:
        ids = np.array(table.column("rep").to_pylist(), np.int64)
        sets = [np.frombuffer(s.as_py(), np.uint64) for s in table.column("shingles")]
        return pa.table({"rep": ids, "component_id": confirmed(ids, sets, percent)})

    return each


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, kept), one for each row of `docs`; options are those of `linked` but `null_ids`.

    n_shingles counts the distinct shingles of `size` words (a shorter text's whole sequence is one); component_id is the smallest
    doc_id reachable over links with 100 * shared >= percent * all shingles, kept whether that is the row's own. Null and empty
    texts and those without words have no shingles and are linked with nothing. Repeated rows share a component, different texts of
    one id have each their own; null ids aren't linked (component_id null, kept false). Other columns are ignored; an empty table
    gives an empty table.
    """
    own = F.col("head.doc_id")
    return linked(docs, **options).select("doc_id", "n_shingles", own.alias("component_id"), F.coalesce(own == F.col("doc_id"), F.lit(False)).alias("kept"))


def _dealt(sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(cells, links) of clusters of several blocks, from rows (component, blocks, rep, shingles).

    links (rep, other) are the documents' links with the cluster's hubs, those with the least hash. Each cell (component, low, high) holds
    two blocks that may have further links; blocks of the largest group have numbers from 0 on, those of the rest negative ones. Two blocks of the largest
    group make no cell, so the cells grow with the size of the rest rather than with the square of the cluster.
    """
    large = sets.where("blocks > 1")
    # HUBS rows for each cluster of several blocks.
    hubs = large.groupBy("component").agg(*[F.min(F.struct(F.xxhash64("rep", F.lit(k)), "rep"))["rep"].alias(f"r{k}") for k in range(HUBS)])
    hubs = hubs.select("component", F.explode(F.array_distinct(F.array(*[f"r{k}" for k in range(HUBS)]))).alias("rep"))
    hubs = large.join(hubs, ["component", "rep"]).groupBy("component").agg(F.collect_list(F.struct("rep", "shingles")).alias("hubs"))
    met = large.select("component", "rep", "shingles").join(hubs, "component").select("rep", "shingles", "hubs").mapInArrow(_met(percent), "rep long, hub long").where("rep <> hub")
    links = met.toDF("rep", "other").checkpoint()
    groups = components(links, "rep", "other").toDF("rep", "grp")
    own = large.select("component", "blocks", "rep").join(groups, "rep", "left")
    most = own.where("grp is not null").groupBy("component", "grp").count().groupBy("component").agg(F.max(F.struct("count", "grp")).alias("top"))
    own = own.join(most.select("component", F.col("top.grp").alias("top")), "component", "left").withColumn("main", F.coalesce(F.col("grp") == F.col("top"), F.lit(False)))
    shares = own.groupBy("component").agg(F.ceil(F.max("blocks") * F.avg(F.col("main").cast("int"))).cast("int").alias("mains"), F.ceil(F.max("blocks") * F.avg((~F.col("main")).cast("int"))).cast("int").alias("rests"))
    own = own.select("component", "rep", "main").join(shares, "component")
    block = lambda n: F.pmod(F.xxhash64("rep"), F.greatest(n, F.lit(1))).cast("int")
    own = own.withColumn("own", F.when(F.col("main"), block(F.col("mains"))).otherwise(-1 - block(F.col("rests"))))
    rests = F.when(F.col("rests") > 0, F.sequence(-F.col("rests"), F.lit(-1))).otherwise(F.array().cast("array<int>"))
    mains = F.when(F.col("mains") > 0, F.sequence(F.lit(0), F.col("mains") - 1)).otherwise(F.array().cast("array<int>"))
    own = own.select("component", "rep", "own", F.explode(F.when(F.col("main"), rests).otherwise(F.concat(rests, mains))).alias("other"))
    cells = large.select("rep", "shingles").join(own, "rep").select("component", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "rep", "shingles")
    return cells, links


def linked(docs: DataFrame, *, percent: int = 80, size: int = 5, k: int = 24, buckets: int | None = None, block_shingles: int = 1 << 16, null_ids: bool = False) -> DataFrame:
    """Rows (doc_id, text_hash, n_shingles, head), one for each row of `docs`: head (none, doc_id, text_hash) is the least row that links reach.

    A row is told by its id and the xxhash64 of its text, so different texts of one id are linked each for itself. Rows are ordered by
    doc_id, null last, then text_hash. Null ids are linked if `null_ids`, otherwise each is its own head, as are rows without shingles.
    `buckets` (default: 2 for each shuffle partition) parts the postings; a task holds one bucket, or two blocks of a cluster with about
    `block_shingles` shingles each.
    """
    spark = docs.sparkSession
    checkpoint_ready(spark)
    buckets = buckets or 2 * shuffle_parts(spark)
    need = needed_matches(k, percent / 100)
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    sketch = keyed.mapInArrow(_sketch(size, k), "doc_id long, text_hash long, n_shingles long, key_a long, key_b long, sig binary").checkpoint()
    key = ["n_shingles", "key_a", "key_b"]
    row, may_link = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash"), F.lit(null_ids) | F.col("doc_id").isNotNull()
    classes = sketch.where((F.col("n_shingles") > 0) & may_link).groupBy(*key).agg(F.min(row).alias("head"), F.min("sig").alias("sig"))
    classes = cut_lineage(classes.withColumn("rep", F.monotonically_increasing_id()))  # numbers are fixed once they are written
    posted = classes.select("rep", "sig").mapInArrow(_post(k, k - need + 1, buckets), "bucket int, at binary, ids binary, sigs binary")
    links = posted.groupBy("bucket").applyInArrow(_links(k, need), "a long, b long")
    cluster = components(links).withColumnRenamed("node", "rep").join(classes.select("rep", "n_shingles", "head"), "rep")
    sizes = cluster.groupBy("component").agg(F.ceil(F.sum("n_shingles") / block_shingles).cast("int").alias("blocks"))
    # Null ids are spelt out as two columns, which joins by hash as eqNullSafe does.
    places = cluster.join(sizes, "component").select("component", "blocks", "rep", F.coalesce("head.doc_id", F.lit(0)).alias("id"), "head.none", "head.text_hash")
    texts = keyed.select(F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("none"), "text_hash", "text").join(places, ["id", "none", "text_hash"]).select("component", "blocks", "rep", "text")
    sets = texts.mapInArrow(_sets(size), "component long, blocks int, rep long, shingles binary").dropDuplicates(["component", "rep"])
    confirm = lambda cells: cells.groupBy("component", "low", "high").applyInArrow(_confirm(percent), "rep long, component_id long")
    if sizes.where("blocks > 1").isEmpty():
        found = confirm(sets.select("component", F.lit(0).alias("low"), F.lit(0).alias("high"), "rep", "shingles")).checkpoint()
    else:
        sets = sets.checkpoint()  # read several times from here on
        small = confirm(sets.where("blocks = 1").select("component", F.lit(0).alias("low"), F.lit(0).alias("high"), "rep", "shingles"))
        cells, met = _dealt(sets, percent)
        further = confirm(cells).toDF("rep", "other").where("rep <> other")
        joined = components(met.unionByName(further), "rep", "other").toDF("rep", "joined")
        large = sets.where("blocks > 1").select("rep").join(joined, "rep", "left").select("rep", F.coalesce("joined", "rep").alias("component_id"))
        found = small.unionByName(large).checkpoint()
    # Written, so that the join shuffles both sides for itself and Spark can split the rows of a large component.
    heads = cut_lineage(found.join(classes.select("rep", "head"), "rep").groupBy("component_id").agg(F.min("head").alias("least")))
    found = found.join(heads, "component_id").select("rep", "least")
    by_class = classes.select(*key, "rep", "head").join(found, "rep", "left").select(*key, F.coalesce("least", "head").alias("found"))
    out = sketch.drop("sig").join(by_class, key, "left")
    return out.select("doc_id", "text_hash", "n_shingles", F.coalesce(F.when(may_link, F.col("found")), row).alias("head"))


#: near_duplicates(percent=85, size=5) in DuckDB's SQL, by counting the shared shingles of all pairs that share any.
NEAR_SQL = """
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w from documents),
sh as (select distinct doc_id, array_to_string(w[i + 1 : i + 5], ' ') as s from (select doc_id, w, unnest(range(0, greatest(1, len(w) - 4))) as i from w where len(w) > 0)),
n as (select doc_id, count(*) as n from sh group by doc_id),
pairs as (select a.doc_id as x, b.doc_id as y, count(*) as c from sh a join sh b on a.s = b.s and a.doc_id <> b.doc_id group by 1, 2),
links as (select x, y from pairs join n nx on nx.doc_id = x join n ny on ny.doc_id = y where 100 * c >= 85 * (nx.n + ny.n - c)),
reach as (select doc_id, doc_id as other from w union select r.doc_id, l.y from reach r join links l on l.x = r.other),
comp as (select doc_id, min(other) as component_id from reach group by doc_id)
select w.doc_id, coalesce(n.n, 0)::bigint as n_shingles, component_id, component_id = w.doc_id as kept from w join comp using (doc_id) left join n using (doc_id)
"""
