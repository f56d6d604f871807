"""Document quality from a linear-chain conditional random field over lines.

Each line is good or bad. Its features describe the line itself and its neighbours; transitions tie successive
labels. Forward-backward gives each line's probability of being good, and a document's quality is the mean of these
probabilities weighted by the lines' lengths. A labelled document teaches that all of its lines carry its label.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SLICE_BYTES, byte_slices, tidy

#: Sorts of bytes whose share of a line is a feature.
_SORTS = ("lower", "upper", "digit", "space", "mark", "symbol", "high")
_SORT = np.full(256, 5, np.uint8)
_SORT[97:123], _SORT[65:91], _SORT[48:58] = 0, 1, 2
_SORT[[9, 10, 11, 12, 13, 32]] = 3
_SORT[[ord(c) for c in ".,;:!?'\"()-"]] = 4
_SORT[128:] = 6
#: Features of a line alone: shares of the sorts, length, words, word length, repeats of words, "!" and "|", no letters, one.
_OWN = len(_SORTS) + 9
FEATURES = 3 * _OWN + 2


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines of a byte slice, their lengths in bytes, and where each document's lines begin.

    A document without bytes has one line of length 0. Each line's row holds its own features, those of the line before
    and behind (zeros beyond the document), and whether it repeats the one before.
    """
    n = len(offsets) - 1
    feeds = np.flatnonzero(data == 10)
    # A feed at the very end of a document opens no line of the next one.
    doc = np.concatenate((np.arange(n), np.searchsorted(offsets, feeds, side="right") - 1))
    starts = np.concatenate((offsets[:-1], feeds + 1))
    order = np.lexsort((starts, doc))
    doc, starts = doc[order], starts[order]
    last = np.concatenate((doc[1:] != doc[:-1], [True]))
    ends = np.where(last, offsets[doc + 1], np.concatenate((starts[1:] - 1, [0])))
    size = (ends - starts).astype(np.float64)
    m = len(starts)

    def held(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(mask, dtype=np.int32)))
        return (total[ends] - total[starts]).astype(np.float64)

    sort = _SORT[data]
    own = np.zeros((m, _OWN))
    some = np.maximum(size, 1)
    for i in range(len(_SORTS)):
        own[:, i] = held(sort == i) / some
    word = sort != 3
    first = word.copy()
    first[1:] &= ~word[:-1]
    inner = offsets[1:-1][offsets[1:-1] < len(data)]
    first[inner] = word[inner]
    words = held(first)
    k = len(_SORTS)
    own[:, k] = np.log1p(size) / 8
    own[:, k + 1] = np.log1p(words) / 6
    own[:, k + 2] = np.minimum((size - own[:, 3] * size) / np.maximum(words, 1), 20) / 10
    at = np.flatnonzero(first)
    ids = np.zeros(len(at), np.int64)
    if len(at):  # a word is known by the sum of its bytes and the way to the next: enough to see repeats
        plain = np.concatenate(([0], np.cumsum(data.astype(np.int64) * word)))
        stop = np.concatenate((at[1:], [len(data)]))
        ids = (plain[stop] - plain[at]) * 8209 + (stop - at) % 64
    same = np.zeros(len(data) + 1, np.int32)
    if len(at) > 1:
        repeat = np.flatnonzero(ids[1:] == ids[:-1]) + 1
        same[at[repeat] + 1] = 1
    total = np.cumsum(same)
    own[:, k + 3] = np.where(size > 0, total[ends] - total[starts], 0) / np.maximum(words, 1)
    own[:, k + 4] = held(data == 33) / np.maximum(words, 1)
    own[:, k + 5] = held(data == 124) / np.maximum(words, 1)
    own[:, k + 6] = (own[:, 0] + own[:, 1] + own[:, 6] == 0) & (size > 0)
    own[:, k + 7] = size == 0
    own[:, k + 8] = 1
    begins = np.searchsorted(doc, np.arange(n + 1))
    x = np.zeros((m, FEATURES))
    x[:, :_OWN] = own
    head = np.zeros(m, bool)
    head[begins[:-1]] = True
    x[1:, _OWN : 2 * _OWN] = own[:-1] * ~head[1:, None]
    x[:-1, 2 * _OWN : 3 * _OWN] = own[1:] * ~head[1:, None]
    x[1:, 3 * _OWN] = (np.abs(own[1:, : k + 3] - own[:-1, : k + 3]).max(1) < 1e-12) & ~head[1:]
    x[:, 3 * _OWN + 1] = head & last
    return x, size, begins


@dataclass
class Crf:
    """weights: of the features for the label good (bad has none); trans: 2 x 2 scores of successive labels, bad first."""

    weights: np.ndarray
    trans: np.ndarray

    def marginals(self, x: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """P(good) of each line."""
        return self.good(x @ self.weights, begins)

    def pair_marginals(self, x: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """P(good) of each line, the lines that have one before them, and P(label before, label) of these as rows of 2 x 2."""
        fwd, bwd, emit = self._passes(x, begins)
        both = fwd + bwd
        total = np.logaddexp(both[:, 0], both[:, 1])  # the same along a document
        inner = np.ones(len(x), bool)
        inner[begins[:-1]] = False
        at = np.flatnonzero(inner)
        here = bwd[at] + np.stack([np.zeros(len(at)), emit[at]], 1)
        pairs = np.exp(fwd[at - 1][:, :, None] + self.trans[None] + here[:, None, :] - total[at, None, None])
        return np.exp(both[:, 1] - total), at, pairs

    def _passes(self, x: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Forward and backward scores of both labels and the lines' own scores, over all documents at once."""
        emit = x @ self.weights
        return *self._scores(emit, begins), emit

    def _scores(self, emit: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward and backward scores from the lines' own scores for the label good."""
        own = np.stack([np.zeros(len(emit)), emit], 1)
        steps = self.trans[None] + own[:, None, :]
        fwd = chain(own[begins[:-1]], steps, begins)
        # Backward: the same from the last line on, with what follows a line as its step.
        back = np.zeros_like(steps)
        back[:-1] = steps[1:].transpose(0, 2, 1)
        bwd = chain(np.zeros((len(begins) - 1, 2)), back[::-1], len(emit) - begins[::-1])[::-1]
        return fwd, bwd

    def good(self, emit: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """P(good) of each line from the lines' own scores."""
        fwd, bwd = self._scores(emit, begins)
        both = fwd + bwd
        return 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -500, 500)))


#: Lines that are stepped through one after the other; longer documents are cut into pieces of as many.
STEPS = 512


def chain(first: np.ndarray, steps: np.ndarray, begins: np.ndarray, most: int = STEPS) -> np.ndarray:
    """Scores of both labels along documents: `first` at a document's first line, and from line to line log-sum-exp with the 2 x 2 of `steps` that leads into a line.

    Documents of more than `most` lines are cut into pieces: products of the steps within each piece, all pieces at once, then the same chain over the pieces' products
    for what each begins with. So Python takes some hundred steps, however many lines there are.
    """
    lens = np.diff(begins)
    if lens.max(initial=0) <= most:
        out = np.zeros((len(steps), 2))
        order = np.argsort(-lens, kind="stable")
        heads, sorted_lens = begins[:-1][order], lens[order]
        out[heads[sorted_lens > 0]] = first[order][sorted_lens > 0]
        for t in range(1, int(lens.max(initial=0))):
            at = heads[: int(np.searchsorted(-sorted_lens, -t, side="left"))] + t  # documents with more than t lines
            out[at] = np.logaddexp(out[at - 1, :1] + steps[at, 0], out[at - 1, 1:] + steps[at, 1])
        return out
    pieces = -(-lens // most)
    doc = np.repeat(np.arange(len(lens)), pieces)
    piece_begins = np.concatenate(([0], np.cumsum(pieces)))
    starts = begins[:-1][doc] + (np.arange(len(doc)) - piece_begins[:-1][doc]) * most
    sizes = np.minimum(begins[1:][doc] - starts, most)
    whole = steps.copy()
    whole[starts[piece_begins[:-1][lens > 0]]] = [[0.0, -np.inf], [-np.inf, 0.0]]  # nothing leads into a document's first line
    order = np.argsort(-sizes, kind="stable")
    heads, sorted_sizes = starts[order], sizes[order]
    for t in range(1, int(sizes.max())):
        at = heads[: int(np.searchsorted(-sorted_sizes, -t, side="left"))] + t
        whole[at] = np.logaddexp(whole[at - 1, :, :1] + whole[at, :1, :], whole[at - 1, :, 1:] + whole[at, 1:, :])
    into = np.zeros((len(doc), 2, 2))
    into[1:] = whole[starts[:-1] + sizes[:-1] - 1]
    carried = chain(first, into, piece_begins, most)[np.repeat(np.arange(len(doc)), sizes)]
    return np.logaddexp(carried[:, :1] + whole[:, 0], carried[:, 1:] + whole[:, 1])


def line_scores(weights: np.ndarray, data: np.ndarray, offsets: np.ndarray, most: int = SLICE_BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each line's own score for the label good, its length and where each document's lines begin. A longer document is taken in parts of about `most` bytes of whole lines, each with
    the line before and the line behind it, so that features of all of its lines are never held at once."""
    if len(offsets) != 2 or len(data) <= most:
        x, size, begins = line_features(data, offsets)
        return x @ weights, size, begins
    ends = np.append(np.flatnonzero(data == 10), len(data))  # of lines
    starts = np.concatenate(([0], ends[:-1] + 1))
    scores, at = [], 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + most, "right")))
        low, high = max(at - 1, 0), min(to + 1, len(starts))
        x, _, _ = line_features(data[starts[low] : ends[high - 1]], np.array([0, ends[high - 1] - starts[low]]))
        scores.append((x @ weights)[at - low : to - low])
        at = to
    return np.concatenate(scores), (ends - starts).astype(np.float64), np.array([0, len(starts)])


def log_likelihood(crf: Crf, x: np.ndarray, begins: np.ndarray, labels: np.ndarray, share: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Conditional log-likelihood of documents whose lines all carry the document's label, times `share`, and its gradients by weights and transitions."""
    lens = np.diff(begins)
    y = np.repeat(labels, lens).astype(np.int64)
    w = np.repeat(share, lens)
    fwd, bwd, emit = crf._passes(x, begins)
    last = begins[1:] - 1
    stay = crf.trans[labels, labels] * (lens - 1)
    value = float((share * (np.add.reduceat(emit * y, begins[:-1]) + stay - np.logaddexp(fwd[last, 0], fwd[last, 1]))).sum())
    p, at, pairs = crf.pair_marginals(x, begins)
    seen = np.zeros((len(at), 2, 2))
    seen[np.arange(len(at)), y[at - 1], y[at]] = 1.0
    return value, x.T @ (w * (y - p)), (w[at, None, None] * (seen - pairs)).sum(0)


def fit_crf(x: np.ndarray, begins: np.ndarray, labels: np.ndarray, *, steps: int = 200, rate: float = 0.08, decay: float = 1e-5, trans_decay: float = 1e-2) -> Crf:
    """Fits weights and all four transitions by conditional likelihood with Adam, from the marginals of lines and of pairs of lines.

    Each document counts alike whatever its number of lines, the two labels alike in sum. `decay` and `trans_decay` are the quadratic penalties; as
    labels don't change within a labelled document, the penalty alone keeps the transitions finite. The default of `decay` is what `cross_validate` prefers on
    labelled documents of which none is held out.
    """
    lens = np.diff(begins)
    share = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels == 0).sum())) / np.maximum(lens, 1)
    crf = Crf(np.zeros(x.shape[1]), np.zeros((2, 2)))
    m1, m2 = np.zeros(x.shape[1] + 4), np.zeros(x.shape[1] + 4)
    for step in range(1, steps + 1):
        _, by_weight, by_trans = log_likelihood(crf, x, begins, labels, share)
        g = np.concatenate((by_weight - decay * crf.weights, (by_trans - trans_decay * crf.trans).ravel()))
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        move = rate * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-9)
        crf.weights = crf.weights + move[:-4]
        crf.trans = crf.trans + move[-4:].reshape(2, 2)
    return crf


def cross_validate(x: np.ndarray, begins: np.ndarray, size: np.ndarray, labels: np.ndarray, folds: np.ndarray, decays: Sequence[float], *, bound: float = 0.7, **options) -> dict[float, float]:
    """For each penalty on the weights the share of documents whose label is right, each told by a field that was fitted on the other folds: good from a score of `bound` on."""
    lens = np.diff(begins)
    of = np.repeat(folds, lens)
    cut = lambda keep: np.concatenate(([0], np.cumsum(lens[keep])))
    out = {}
    for decay in decays:
        right = 0
        for fold in np.unique(folds):
            own = folds == fold
            crf = fit_crf(x[of != fold], cut(~own), labels[~own], decay=decay, **options)
            p, w, at = crf.marginals(x[of == fold], cut(own)), size[of == fold] + 1e-9, cut(own)[:-1]
            right += int(((np.add.reduceat(p * w, at) / np.add.reduceat(w, at) >= bound) == (labels[own] == 1)).sum())
        out[decay] = right / len(labels)
    return out


def _first_features(lines: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, offsets in byte_slices(b):
                x, size, begins = line_features(data, offsets)
                rows = []
                for s, e in zip(begins[:-1].tolist(), begins[1:].tolist()):
                    if e - s > lines:  # successive lines, from a place that the document's length decides
                        s += (e - s) * 2654435761 % (e - s - lines + 1)
                        e = s + lines
                    rows.append(x[s:e].astype("<f4").tobytes())
                yield pa.RecordBatch.from_arrays([b.column("quality").slice(i, j - i), pa.array(rows, pa.binary())], names=["quality", "features"])

    return tidy(run)


def learn(docs: DataFrame, labels: DataFrame, *, sample: int = 4000, lines: int = 400) -> Crf:
    """Learns from rows (doc_id, text) joined to rows (doc_id, quality) of 0 or 1.

    The bound on what is learned from is `sample` documents of each label, those with the smallest hashes of their ids, and of a longer one a block of
    `lines` successive lines, cut in the task that reads it; only these lines' features reach the driver. Null labels and texts are left out; of repeated labels the least counts. With one label only,
    or none, all texts get its (or label 1's) side by the bias alone.
    """
    known = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    picked = None
    for label in (0, 1):
        few = known.where(F.col("quality") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        picked = few if picked is None else picked.unionByName(few)
    # The picked ids are at most 2 * sample rows.
    rows = docs.where("text is not null").select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("quality", "text").mapInArrow(_first_features(lines), "quality int, features binary").collect()
    rows.sort(key=lambda r: (r.quality, zlib.crc32(r.features), len(r.features)))
    if not rows:
        return Crf(np.zeros(FEATURES), np.zeros((2, 2)))
    xs = [np.frombuffer(r.features, "<f4").reshape(-1, FEATURES) for r in rows]
    return fit_crf(np.concatenate(xs).astype(np.float64), np.concatenate(([0], np.cumsum([len(x) for x in xs]))), np.array([r.quality for r in rows]))


def _score(crf: Crf):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, offsets in byte_slices(b, most=1 << 18):
                emit, size, begins = line_scores(crf.weights, data, offsets)
                p = crf.good(emit, begins)
                w = size + 1e-9
                score = np.add.reduceat(p * w, begins[:-1]) / np.add.reduceat(w, begins[:-1])
                rows = b.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(np.clip(score, 0.0, 1.0))], names=[*b.schema.names, "score"])

    return tidy(run)


def score(docs: DataFrame, crf: Crf) -> DataFrame:
    """docs with `score`, 0 to 1: the length-weighted mean of P(good) over the whole text's lines (a column of this name is replaced).

    Null and empty texts are one empty line. Rows stay as they are, repeated ones included; nothing is shuffled.
    """
    docs = docs.drop("score")
    return docs.mapInArrow(_score(crf), T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())]))


def line_labels(docs: DataFrame, crf: Crf) -> DataFrame:
    """Rows (doc_id, line, good): the probability that each line is good, lines from 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, offsets in byte_slices(b, most=1 << 18):
                emit, _, begins = line_scores(crf.weights, data, offsets)
                p, n = crf.good(emit, begins), np.diff(begins)
                ids = b.column("doc_id").slice(i, j - i).take(pa.array(np.repeat(np.arange(j - i), n)))
                yield pa.RecordBatch.from_arrays([ids, pa.array(np.arange(len(emit)) - np.repeat(begins[:-1], n)), pa.array(p)], names=["doc_id", "line", "good"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, line long, good double")
