"""Operator 11: hard negatives by rotated one-bit codes with exact error intervals.

A vector's components become the integers floor(256 x). Its integer vector is rotated
(rounds of sign flips and Hadamard transforms, padded to a power of two) and coded by
the signs of the rotated components, with its alignment: the inner product of the
rotated vector and the unit vector of its code. What the code leaves over is coded in
the same way, ``LEVELS`` times in all; the norm of the last rest is stored.

An anchor's rotated vector is rounded to ``QUERY_BITS`` bits, so its inner product with a
code is a sum of popcounts of the code and the anchor's bit planes. Alignments times
these inner products estimate a score. The rest is orthogonal to the last code, so by
Cauchy and Schwarz the error is at most the rest's norm times the norm of the anchor's
part orthogonal to that code, plus the rounding's own bound: an interval, not a chance.
Rows whose interval can't reach the best so far or the wanted range are left; all others
are scored in integers, and only such scores decide.

Anchors are taken in blocks of at most ``BLOCK_BYTES``, which are sent to all tasks; the
coded rows stay where they are. A task keeps the best rows of each anchor only, and these
are merged per anchor in a window over at most tasks x limit rows. A block takes two
passes: first the positives, then the negatives in the range of each positive's score.

Defined results: rows with a null vec_id, label or vector, or a null or non-finite
component, take no part; of rows that share a vec_id the one of least (label, vector)
does, so repeated rows count once; vectors are compared with those of the same length,
empty ones score 0; components are held to +-sqrt(2^62 / length), so no score overflows;
an anchor without positives or a positive without negatives gives no rows; an empty table
gives an empty result. Only vec_id, embedding and label are read: other columns play no part.
"""

from __future__ import annotations

from functools import lru_cache
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from landsales.llm.common import stored

SEED = 11
ROUNDS = 3                 # sign flips and Hadamard transforms of the rotation
LEVELS = 4                 # one-bit codes of a vector: of itself, of the rest, ...
QUERY_BITS = 8             # bits of an anchor's rotated components
BLOCK_BYTES = 16 << 20     # bytes of the anchors that are sent to the tasks at once
PAIRS = 1 << 18            # pairs of anchors and rows whose intervals are held at once
POSITIVES = 5
NEGATIVES = 10
RANGE = (30, 90)           # percent of the positive's score

_FAR = np.iinfo(np.int64).max


@lru_cache(maxsize=8)
def _signs(width: int) -> np.ndarray:
    return np.random.default_rng([SEED, width]).integers(0, 2, (ROUNDS, width)) * 2.0 - 1


def rotate(rows: np.ndarray) -> np.ndarray:
    """Rows (vectors of one length) rotated; the length is padded to a power of two."""
    n, length = rows.shape
    width = 1 << max(0, length - 1).bit_length()
    out = np.zeros((n, width))
    out[:, :length] = rows
    for signs in _signs(width):
        out *= signs
        half = 1
        while half < width:
            pairs = out.reshape(n, width // (2 * half), 2, half)
            out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, width)
            half *= 2
        out /= np.sqrt(width)
    return out


def _packed(bits: np.ndarray) -> np.ndarray:
    """Bits of each row in 64-bit words."""
    n, width = bits.shape
    words = -(-width // 64)
    room = np.zeros((n, words * 64), np.uint8)
    room[:, :width] = bits
    return np.packbits(room, axis=1, bitorder="little").view("<u8")


def code(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (row, level, word), alignments (row, level) and norms of the rests."""
    rest = rotate(rows.astype(np.float64))
    width = rest.shape[1]
    codes, alignments = [], []
    for _ in range(LEVELS):
        bits = rest >= 0
        signs = (bits * 2.0 - 1) / np.sqrt(width)
        alignment = (rest * signs).sum(axis=1)
        rest = rest - alignment[:, None] * signs
        codes.append(_packed(bits))
        alignments.append(alignment)
    return np.stack(codes, axis=1), np.stack(alignments, axis=1), np.sqrt((rest * rest).sum(axis=1))


class Anchors:
    """Anchors of one vector length: integer vectors, bit planes of the rotated ones."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        turned = rotate(vectors.astype(np.float64))
        self.width = turned.shape[1]
        top = (1 << (QUERY_BITS - 1)) - 1
        self.step = np.maximum(np.abs(turned).max(axis=1, initial=0), 1e-300) / top
        rounded = np.rint(turned / self.step[:, None]).astype(np.int64)
        shifted = (rounded + top).astype(np.uint64)                  # 0 to 2 * top
        self.planes = [_packed(((shifted >> np.uint64(b)) & np.uint64(1)).astype(np.uint8)) for b in range(QUERY_BITS)]
        self.sums = shifted.sum(axis=1).astype(np.int64)
        self.top = top
        self.squares = (turned * turned).sum(axis=1)
        self.norms = np.sqrt(self.squares)
        self.off = np.abs(turned - rounded * self.step[:, None]).sum(axis=1)     # of the rounding

    def along(self, some: slice, codes: np.ndarray) -> np.ndarray:
        """Inner products (anchor, row) of the rounded anchors and the unit vectors of codes."""
        ones = np.bitwise_count(codes).sum(axis=1).astype(np.int64)
        held = np.zeros((some.stop - some.start, len(codes)), np.int32)
        for b, plane in enumerate(self.planes):
            for w in range(codes.shape[1]):
                held += np.bitwise_count(plane[some, w][:, None] & codes[None, :, w]) * np.int32(1 << b)
        # sum of shifted components where the bit is 1, less that where it is 0; then without the shift
        signed = 2 * held - self.sums[some, None] - self.top * (2 * ones - self.width)[None, :]
        return signed * (self.step[some, None] / np.sqrt(self.width))

    def intervals(self, some: slice, codes: np.ndarray, alignments: np.ndarray, rests: np.ndarray):
        """Least and greatest possible scores (anchor, row)."""
        estimate = np.zeros((some.stop - some.start, len(codes)))
        slack = (self.off[some, None] / np.sqrt(self.width)) * np.abs(alignments).sum(axis=1)[None, :]
        for level in range(codes.shape[1]):
            along = self.along(some, codes[:, level])
            estimate += along * alignments[None, :, level]
        # the rest has no part along the last code: only the anchor's part across it counts
        sure = np.maximum(np.abs(along) - self.off[some, None] / np.sqrt(self.width), 0)
        across = np.sqrt(np.maximum(self.squares[some, None] * (1 + 1e-9) - sure * sure, 0))
        size = np.sqrt((alignments * alignments).sum(axis=1) + rests * rests)
        slack += across * rests[None, :] + 1e-9 * self.norms[some, None] * size[None, :] + 1e-6
        return estimate - slack, estimate + slack

    def scores(self, anchor: np.ndarray, rows: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        """Integer inner products of pairs."""
        return np.einsum("ij,ij->i", self.vectors[anchor], vectors[rows])


class Best:
    """For every want (a row of a table) the best (score, id) pairs seen: score down, id up."""

    def __init__(self, wants: int, limit: int):
        self.limit = limit
        self.scores = np.full((wants, limit), -_FAR, np.int64)
        self.ids = np.full((wants, limit), _FAR, np.int64)

    def floor(self) -> np.ndarray:
        """The score that a row must reach."""
        return self.scores[:, -1]

    def offer(self, want: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(want):
            return
        hit = np.unique(want)
        filled = self.ids[hit] != _FAR
        held = np.nonzero(filled)
        want = np.concatenate([want, hit[held[0]]])
        score = np.concatenate([score, self.scores[hit][filled]])
        ids = np.concatenate([ids, self.ids[hit][filled]])
        order = np.lexsort((ids, -score, want))
        want, score, ids = want[order], score[order], ids[order]
        first = np.flatnonzero(np.append(True, want[1:] != want[:-1]))
        place = np.arange(len(want)) - np.repeat(first, np.diff(np.append(first, len(want))))
        keep = place < self.limit
        self.scores[hit], self.ids[hit] = -_FAR, _FAR
        self.scores[want[keep], place[keep]] = score[keep]
        self.ids[want[keep], place[keep]] = ids[keep]

    def found(self):
        want, place = np.nonzero(self.ids != _FAR)
        return want, self.ids[want, place], self.scores[want, place]


def _bounded(vectors: np.ndarray, length: int) -> np.ndarray:
    limit = isqrt((1 << 62) // max(1, length))
    return np.clip(np.floor(256.0 * vectors), -limit, limit).astype(np.int64)


_CODED = "vec_id long, label long, length int, vector binary, codes binary, alignments binary, rest double"


def _encode(batches):
    for batch in batches:
        lists = batch.column(2)
        lengths = np.asarray(lists.value_lengths())
        flat = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
        starts = np.cumsum(lengths) - lengths
        for length in np.unique(lengths).tolist():
            rows = np.flatnonzero(lengths == length)
            vectors = _bounded(flat[starts[rows][:, None] + np.arange(length)].reshape(len(rows), length), length)
            codes, alignments, rests = code(vectors)
            pick = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pick), batch.column(1).take(pick), pa.array([length] * len(rows), pa.int32()),
                 pa.array([v.tobytes() for v in vectors.astype("<i8")], pa.binary()),
                 pa.array([c.tobytes() for c in codes], pa.binary()),
                 pa.array([a.tobytes() for a in alignments.astype("<f8")], pa.binary()), pa.array(rests)],
                ["vec_id", "label", "length", "vector", "codes", "alignments", "rest"])


def coded(rows: DataFrame) -> DataFrame:
    """The index: one row per vec_id with its integer vector, codes, alignments and rest.
    ``rows`` has vec_id, label and embedding (an array of numbers)."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    rows = rows.select(F.col("vec_id").cast("long"), F.col("label").cast("long"),
                       F.col("embedding").cast("array<double>")) \
        .where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL") \
        .where(F.forall("embedding", finite))
    again = stored(rows.groupBy("vec_id").count().where("count > 1").select(F.col("vec_id").alias("again")), "negatives-again")
    match = F.col("vec_id") == F.col("again")
    one = rows.join(again, match, "left_semi").groupBy("vec_id") \
        .agg(F.min(F.struct("label", "embedding")).alias("r")).select("vec_id", "r.label", "r.embedding")
    return stored(rows.join(again, match, "left_anti").unionByName(one).mapInArrow(_encode, _CODED), "negatives-codes")


def _matrix(values, count: int, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(values), kind).reshape(count, -1)


def _groups(batch):
    """Rows of a batch by vector length: ids, labels, vectors, codes, alignments, rests."""
    lengths = batch.column(2).to_numpy()
    for length in np.unique(lengths).tolist():
        part = batch.filter(pa.array(lengths == length))
        ids, labels, _, vectors, codes, alignments, rests = part.columns
        n = len(part)
        yield (length, ids.to_numpy(), labels.to_numpy(),
               _matrix(vectors.to_pylist(), n, "<i8").reshape(n, length), _matrix(codes.to_pylist(), n, "<u8").reshape(n, LEVELS, -1),
               _matrix(alignments.to_pylist(), n, "<f8"), rests.to_numpy())


def _slices(anchors: int, rows: int):
    """Blocks of anchors and rows of at most PAIRS pairs."""
    few = max(1, min(anchors, PAIRS // max(1, min(rows, 1024))))
    wide = max(1, PAIRS // few)
    for a in range(0, anchors, few):
        for r in range(0, rows, wide):
            yield slice(a, min(a + few, anchors)), slice(r, min(r + wide, rows))


def _kth_greatest(values: np.ndarray, k: int) -> np.ndarray:
    """The k-th greatest value of each row, -inf where there are fewer."""
    if values.shape[1] < k:
        return np.full(len(values), -np.inf)
    return np.partition(values, values.shape[1] - k, axis=1)[:, values.shape[1] - k]


def _positives(anchors: Anchors, best: Best, group) -> None:
    _, ids, labels, vectors, codes, alignments, rests = group
    for some, rows in _slices(len(anchors.ids), len(ids)):
        wanted = (anchors.labels[some, None] == labels[None, rows]) & (anchors.ids[some, None] != ids[None, rows])
        if not wanted.any():
            continue
        low, high = anchors.intervals(some, codes[rows], alignments[rows], rests[rows])
        floor = np.maximum(best.floor()[some], np.ceil(_kth_greatest(np.where(wanted, low, -np.inf), best.limit)))
        a, r = np.nonzero(wanted & (high >= floor[:, None]))
        a, r = a + some.start, r + rows.start
        best.offer(a, anchors.scores(a, r, vectors), ids[r])


def _negatives(anchors: Anchors, wants, best: Best, group) -> None:
    """``wants``: places of the anchors, least and greatest scores that each want allows."""
    place, least, most = wants
    _, ids, labels, vectors, codes, alignments, rests = group
    order = np.searchsorted(place, np.arange(len(anchors.ids) + 1))       # wants are in order of place
    for some, rows in _slices(len(anchors.ids), len(ids)):
        low, high = anchors.intervals(some, codes[rows], alignments[rows], rests[rows])
        other = anchors.labels[some, None] != labels[None, rows]
        asked, any_want = [], np.zeros(other.shape, bool)
        for k in range(int(np.diff(order[some.start:some.stop + 1]).max(initial=0))):     # the k-th want of each anchor
            has = np.flatnonzero(np.diff(order[some.start:some.stop + 1]) > k)
            w = order[some.start + has] + k
            under, over, mine = low[has], high[has], other[has]
            inside = mine & (under >= least[w, None]) & (over <= most[w, None])
            floor = np.maximum(np.maximum(least[w], best.floor()[w]),
                               np.ceil(_kth_greatest(np.where(inside, under, -np.inf), best.limit)))
            open_pairs = mine & (over >= floor[:, None]) & (under <= most[w, None])
            any_want[has] |= open_pairs
            asked.append((has, w, open_pairs))
        score = np.zeros(other.shape, np.int64)         # a pair is scored once, however many wants it meets
        a, r = np.nonzero(any_want)
        score[a, r] = anchors.scores(a + some.start, r + rows.start, vectors)
        for has, w, open_pairs in asked:
            a, r = np.nonzero(open_pairs)
            s = score[has[a], r]
            fits = (s >= np.maximum(least, best.floor())[w[a]]) & (s <= most[w[a]])
            best.offer(w[a[fits]], s[fits], ids[rows][r[fits]])


def _bands(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest negative scores for positive scores: low * p <= 100 * n <= high * p,
    in whole numbers that stay below 2^63."""
    whole, left = scores // 100, scores % 100
    return RANGE[0] * whole - (-(RANGE[0] * left) // 100), RANGE[1] * whole + (RANGE[1] * left) // 100


def _rows(*columns):
    names = ["anchor_id", "positive_id", "positive_score", "vec_id", "score"]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


_FOUND = "anchor_id long, positive_id long, positive_score long, vec_id long, score long"


def _search(index: DataFrame, blocks: list, positives: bool, limit: int) -> DataFrame:
    """Per task and want the best rows. blocks: (ids, labels, vectors, wants) of each vector length."""
    sent = index.sparkSession.sparkContext.broadcast(blocks)

    def run(batches):
        state = {}
        for ids, labels, vectors, wants in sent.value:
            state[vectors.shape[1]] = (Anchors(ids, labels, vectors), wants, Best(len(wants[0]), limit))
        for batch in batches:
            for group in _groups(batch):
                if group[0] not in state:
                    continue
                anchors, wants, best = state[group[0]]
                if positives:
                    _positives(anchors, best, group)
                else:
                    _negatives(anchors, (wants[0], *_bands(wants[2])), best, group)
        for anchors, (place, ids, scores), best in state.values():
            want, found, score = best.found()
            if len(want):
                yield _rows(anchors.ids[place[want]], ids[want], scores[want], found, score)

    return index.mapInArrow(run, _FOUND)


def _top(found: DataFrame, limit: int) -> DataFrame:
    """The best rows of all tasks: a window over at most tasks x limit rows of a want."""
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)


def _by_length(rows) -> list:
    """Anchors of a block by vector length, in order of their ids."""
    made = {}
    for r in sorted(rows, key=lambda r: r["vec_id"]):
        made.setdefault(r["length"], []).append(r)
    return [(np.array([r["vec_id"] for r in x]), np.array([r["label"] for r in x]),
             np.array([np.frombuffer(r["vector"], "<i8") for r in x]).reshape(len(x), length)) for length, x in made.items()]


def mine(spark: SparkSession, rows: DataFrame, is_anchor, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score. ``rows`` has
    vec_id, label and embedding; ``is_anchor`` is a condition on vec_id."""
    index = coded(rows)
    anchors = stored(index.where(is_anchor).select("vec_id", "label", "length", "vector"), "negatives-anchors")
    size = anchors.agg(F.count(F.lit(1)).alias("n"), F.max("length").alias("length")).first()
    # bytes of an anchor in a task: its vector, planes, and the best rows of its wants
    each = (size["length"] or 0) * (8 + QUERY_BITS // 4) + 16 * positives * (1 + negatives) + 64
    blocks = max(1, -(-size["n"] * each // BLOCK_BYTES))
    out = None
    for k in range(blocks):
        held = anchors.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == k).collect()     # about BLOCK_BYTES
        groups = _by_length(held)
        nothing = lambda n: (np.arange(n), np.full(n, -1), np.zeros(n, np.int64))
        first = _top(_search(index, [(*g, nothing(len(g[0]))) for g in groups], True, positives), positives)
        wanted = {}
        for r in first.select("anchor_id", "vec_id", "score").collect():      # at most `positives` of each anchor
            wanted.setdefault(r["anchor_id"], []).append((r["vec_id"], r["score"]))
        asked = []
        for ids, labels, vectors in groups:
            wants = [(n, p, s) for n, a in enumerate(ids.tolist()) for p, s in wanted.get(a, ())]
            asked.append((ids, labels, vectors, tuple(np.array([w[c] for w in wants], np.int64) for c in range(3))))
        second = _top(_search(index, asked, False, negatives), negatives)
        made = stored(second.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"),
                                    "positive_score", F.col("score").alias("negative_score")), "negatives")
        out = made if out is None else out.unionByName(made)
    return out
