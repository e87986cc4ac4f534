"""Operator 1: near-duplicates by ProbMinHash sketches, bands and exact checks.

A text's shingles are all runs of ``SHINGLE`` words (a shorter text is one
shingle), weighted by how often they occur. ProbMinHash: every shingle is a
Poisson process whose rate is its weight; its arrivals fall into random slots of
the sketch, and a slot keeps the shingle that arrives first. A shingle's process
ends once its next arrival is later than the time by which all slots are filled.
Two sketches agree in a slot with the probability Jaccard of the two weighted
sets, which is the plain Jaccard where all weights are equal, and doesn't change
when a whole text is repeated.

Texts of equal word sequence are one node, named by their least doc_id. Nodes
that share a band of slots meet in a bucket. First every node is compared with
the least node it meets, and linked nodes become components. In each bucket that
still holds several components, all nodes outside its least component are
queries against the whole bucket, in blocks of bounded size: once by sketch
bytes, which leaves the few nodes with a likely partner, then by the exact
similarity of their whole texts. No pair is written out: a task hands on one link
for every two components it joins. So every pair of a bucket that isn't yet
connected is compared, and a hot bucket costs blocks, not rows. Components of all
links are the classes.

Defined results: null, empty and blank texts are alone in their class; texts of signs
only, which have no words, are alike if they are equal; rows with a null doc_id have a
null class; rows that repeat a doc_id share its class, and copies and near copies of any
of their texts join it (each different text is a node of its own); an empty table gives
an empty result. Only doc_id and text are read: other columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landsales.llm.common import stored
from landsales.llm.components import components
from landsales.llm.kernels import ALNUM, BASE, grams, mix, slices, utf8, words

SHINGLE = 5
SIMILARITY = 0.8
BANDS, BAND_SLOTS = 24, 5
SLOTS = BANDS * BAND_SLOTS
BLOCK_ROWS, BLOCK_BYTES = 2048, 8 << 20   # of a bucket compared in one task
AGREE = 0.62              # share of equal sketch bytes before texts are compared (0.8 less 4.5 deviations)
U = np.uint64


# ------------------------------------------------------------------- sketches

def shingles(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shingles, weights, first shingle of each row) of rows of word hashes."""
    made = grams(hashes, SHINGLE)
    keys, weights, counts = [], [], []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        own = made[a:b - SHINGLE + 1] if b - a >= SHINGLE else grams(hashes[a:b], b - a) if b > a else made[:0]
        own = np.sort(own)
        start = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else np.zeros(0, np.int64)
        keys.append(own[start])
        weights.append(np.diff(np.r_[start, len(own)]))
        counts.append(len(start))
    bounds = np.zeros(len(first), np.int64)
    np.cumsum(counts, out=bounds[1:])
    return (np.concatenate(keys) if keys else made[:0]), \
        (np.concatenate(weights) if weights else np.zeros(0, np.int64)), bounds


def prob_minhash(keys: np.ndarray, weights: np.ndarray, bounds: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """(rows, slots): the shingle that arrives first in every slot; 0 for rows without any."""
    rows = len(bounds) - 1
    sketch = np.zeros((rows, slots), U)
    sizes = np.diff(bounds)
    row_of = np.repeat(np.arange(rows), sizes)
    total = np.bincount(row_of, weights=weights, minlength=rows)
    # all slots are filled by this time with a chance of about 1 - exp(-4); else it is doubled
    until = np.where(total > 0, slots * (np.log(slots) + 4) / np.maximum(total, 1), 0)
    open_rows = total > 0
    while open_rows.any():
        live = np.flatnonzero(open_rows[row_of])
        time = np.zeros(len(live))
        cells, times, names = [], [], []
        arrival = 0
        while live.size:
            with np.errstate(over="ignore"):
                drawn = mix(keys[live] + U(arrival) * U(BASE))
            uniform = ((drawn >> U(12)).astype(np.float64) + 0.5) / float(1 << 52)
            time = time - np.log(uniform) / weights[live]
            early = time <= until[row_of[live]]
            live, time = live[early], time[early]
            slot = (mix(drawn[early]) % U(slots)).astype(np.int64)
            cells.append(row_of[live] * slots + slot)
            times.append(time)
            names.append(live)
            arrival += 1
        cells, times, names = np.concatenate(cells), np.concatenate(times), np.concatenate(names)
        # later writes win: earliest arrivals are written last
        order = np.argsort(-times, kind="stable")
        filled = np.zeros(rows * slots, bool)
        flat = np.zeros(rows * slots, U)
        filled[cells] = True
        flat[cells[order]] = keys[names[order]]
        done = open_rows & filled.reshape(rows, slots).all(axis=1)
        sketch[done] = flat.reshape(rows, slots)[done]
        open_rows &= ~done
        until[open_rows] *= 2
    return sketch


def probability_jaccard(keys_a, weights_a, keys_b, weights_b) -> float:
    """Exact probability Jaccard of two weighted sets (sorted keys)."""
    common, at_a, at_b = np.intersect1d(keys_a, keys_b, assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    x, y = weights_a[at_a].astype(float), weights_b[at_b].astype(float)
    order = np.argsort(x / y, kind="stable")
    x, y = x[order], y[order]
    ratio = x / y
    # for shingle i: sum over j of max(x_j / x_i, y_j / y_i); x counts where x_j/y_j >= x_i/y_i
    more_x = np.r_[np.cumsum(x[::-1])[::-1], 0.0] + (weights_a.sum() - x.sum())
    less_y = np.r_[0.0, np.cumsum(y)] + (weights_b.sum() - y.sum())
    at = np.searchsorted(ratio, ratio, side="left")
    return float((1 / (more_x[at] / x + less_y[at] / y)).sum())


def _of_signs(batch: pa.RecordBatch, wordless: np.ndarray, names: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows of texts that have signs but no word."""
    some = [k for k, t in zip(wordless.tolist(), batch.column(1).take(pa.array(wordless)).to_pylist()) if t.encode().strip()]
    if some:
        part = batch.take(pa.array(some))
        prints = np.array([np.frombuffer(hashlib.blake2b(t.encode(), digest_size=16).digest(), "<i8")
                           for t in part.column(1).to_pylist()])
        none = pa.array([[]] * len(some), pa.list_(pa.int64()))
        columns = [part.column(0), pa.array(prints[:, 0]), pa.array(prints[:, 1]), none, pa.array([b""] * len(some), pa.binary()),
                   part.column(1)]
        yield pa.RecordBatch.from_arrays(columns[:len(names)], names=names)


SKETCH = "doc_id long, print1 long, print2 long, buckets array<long>, bytes binary"


def sketches(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """doc_id, a 128-bit print of the word sequence, band keys and one byte per slot (and the
    text, if wanted), of every row with an id and at least one word; of texts of signs only a
    print of their bytes, without bands."""
    more = ["text"] if with_text else []
    names = ["doc_id", "print1", "print2", "buckets", "bytes", *more]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for a, b in slices(offsets, 1 << 20):
                hashes, first = words(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], ALNUM)
                some = np.flatnonzero(np.diff(first) > 0)
                if some.size < b - a:
                    yield from _of_signs(batch.slice(a, b - a), np.flatnonzero(np.diff(first) == 0), names)
                if not some.size:
                    continue
                sketch = prob_minhash(*shingles(hashes, first))[some]
                begin, place = first[:-1][some], np.arange(len(hashes)) - np.repeat(first[:-1], np.diff(first))
                with np.errstate(over="ignore"):
                    prints = [np.add.reduceat(mix(hashes + mix(place.astype(U) + U(seed << 32))), begin).view(np.int64)
                              for seed in (1, 2)]
                    mixed = mix(sketch).reshape(-1, BANDS, BAND_SLOTS)
                    band = np.zeros(mixed.shape[:2], U) + mix(np.arange(BANDS))
                    for k in range(BAND_SLOTS):
                        band = mix(band * U(BASE) + mixed[:, :, k])
                low = (mixed.reshape(len(some), SLOTS) & U(255)).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b].take(pa.array(some)), pa.array(prints[0]), pa.array(prints[1]),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1, dtype=np.int32) * BANDS),
                                              pa.array(band.reshape(-1).view(np.int64))),
                     pa.array([row.tobytes() for row in low], pa.binary()),
                     *(batch.column(1)[a:b].take(pa.array(some)) for _ in more)],
                    names=names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .where("doc_id IS NOT NULL AND text IS NOT NULL")
    return rows.mapInArrow(run, SKETCH + ", text string" * with_text)


# ---------------------------------------------------------------- comparisons

def _alike(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs a > b whose sketches agree in enough slots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (utf8(batch.column(k))[0].reshape(-1, SLOTS) for k in (2, 3))
                keep = pa.array((x == y).sum(axis=1) >= AGREE * SLOTS)
                yield pa.RecordBatch.from_arrays([batch.column(k).filter(keep) for k in (0, 1)], names=["a", "b"])

    left = nodes.select(F.col("id").alias("a"), F.col("bytes").alias("bytes_a"))
    right = nodes.select(F.col("id").alias("b"), F.col("bytes").alias("bytes_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "bytes_a", "bytes_b")
    return both.mapInArrow(run, "a long, b long")


def _checked(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Pairs whose whole texts are at least ``similarity`` alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            sides = [utf8(batch.column(k)) for k in (2, 3)]
            for a, b in slices(sides[0][1] + sides[1][1], 2 << 20):
                sets = []
                for data, offsets in sides:
                    hashes, first = words(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], ALNUM)
                    sets.append(shingles(hashes, first))
                for k in range(b - a):
                    parts = [x[f[k]:f[k + 1]] for keys, weights, f in sets for x in (keys, weights)]
                    keep[a + k] = probability_jaccard(*parts) >= similarity
            keep = pa.array(keep)
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(keep) for k in (0, 1)], names=["a", "b"])

    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    wanted = stored(texts.join(ids, "id", "left_semi"), "near-texts")
    both = pairs.join(wanted.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a") \
        .join(wanted.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _blocks(members: DataFrame, payload: str, block_rows: int, compare, schema: str) -> DataFrame:
    """Compare, in every bucket of several components, the nodes outside its least
    component with all its nodes.

    members: bucket, id, root and the payload. A bucket of n rows and m bytes is dealt
    to k * k blocks, k = max(n / block_rows, m / BLOCK_BYTES): block (i, j) holds share
    i of the queries and share j of the nodes. ``compare(ids, roots, payload, queries,
    nodes)`` gets the rows of one block and yields rows of the schema."""
    size = F.octet_length(payload)
    open_buckets = members.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.greatest(
        F.ceil(F.count(F.lit(1)) / block_rows), F.ceil(F.sum(size) / BLOCK_BYTES)).cast("int").alias("k")).where("lo < hi")
    share = F.pmod(F.xxhash64("id"), F.col("k")).cast("int")
    is_query = F.col("root") != F.col("lo")
    numbers = F.sequence(F.lit(0), F.col("k") - 1)
    as_node = F.transform(numbers, lambda i: F.struct(
        i.alias("i"), F.col("share").alias("j"), F.lit(True).alias("node"),
        (F.col("is_query") & (i == F.col("share"))).alias("query")))
    as_query = F.transform(F.filter(numbers, lambda j: F.col("is_query") & (j != F.col("share"))), lambda j: F.struct(
        F.col("share").alias("i"), j.alias("j"), F.lit(False).alias("node"), F.lit(True).alias("query")))
    rows = members.join(open_buckets, "bucket").withColumns({"share": share, "is_query": is_query}) \
        .withColumn("at", F.explode(F.concat(as_node, as_query))) \
        .select("bucket", "at.i", "at.j", "id", "root", "at.query", "at.node", payload)
    rows = rows.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "id")
    names = [field.split()[0] for field in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in chain(batches, (None,)):
            if batch is not None:
                held.append(batch)
                if sum(b.num_rows for b in held) < 2:
                    continue
            table = pa.Table.from_batches(held).combine_chunks() if held else None
            if table is None or not table.num_rows:
                held = []
                continue
            keys = np.stack([table.column(k).to_numpy() for k in range(3)])
            starts = np.flatnonzero(np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)])
            stops = np.r_[starts[1:], table.num_rows]
            if batch is not None:            # the last block may go on in the next batch
                starts, stops = starts[:-1], stops[:-1]
                held = table.slice(stops[-1] if len(stops) else 0).to_batches()
            ids, roots = table.column(3).to_numpy(), table.column(4).to_numpy()
            query, node = (table.column(k).to_numpy().astype(bool) for k in (5, 6))
            column = table.column(7).combine_chunks()
            found = []
            for a, b in zip(starts.tolist(), stops.tolist()):
                if b - a > 1:
                    found += compare(ids[a:b], roots[a:b], column.slice(a, b - a), query[a:b], node[a:b], keys[0, a])
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=names)
            if batch is None:
                return

    return rows.mapInArrow(run, schema)


def _close_nodes(ids, roots, sketch, query, node, bucket) -> list[tuple]:
    """(bucket, id) of both sides of pairs whose sketches agree enough."""
    cells = utf8(sketch)[0].reshape(-1, SLOTS)
    queries, nodes = np.flatnonzero(query), np.flatnonzero(node)
    close = np.zeros(len(ids), bool)
    step = max(1, (8 << 20) // (SLOTS * max(1, len(nodes))))
    for a in range(0, len(queries), step):
        part = queries[a:a + step]
        agree = (cells[part][:, None, :] == cells[nodes][None, :, :]).sum(axis=2) >= AGREE * SLOTS
        agree &= roots[part][:, None] != roots[nodes][None, :]
        close[part] |= agree.any(axis=1)
        close[nodes] |= agree.any(axis=0)
    return [(bucket, i) for i in ids[close].tolist()]


def _linked_nodes(ids, roots, texts, query, node, bucket, similarity) -> list[tuple]:
    """(a, b) of alike nodes that join two components this block hasn't joined yet: fewer
    links than the block has components, which join the same ones as all its links.

    The overlap of two normalised weight vectors bounds their probability Jaccard from
    above; where all weights are 1 it gives the value itself."""
    data, offsets = utf8(texts)
    keys, weights, bounds = shingles(*words(data, offsets, ALNUM))
    vocabulary, place = np.unique(keys, return_inverse=True)
    sizes = np.diff(bounds)
    totals = np.add.reduceat(weights, bounds[:-1])
    share = weights / np.repeat(totals, sizes)
    unit = totals == sizes
    mine = np.zeros(len(vocabulary))
    found, joined = [], {}

    def top(root):
        while root in joined:
            root = joined[root]
        return root

    for q in np.flatnonzero(query).tolist():
        own = slice(bounds[q], bounds[q + 1])
        mine[place[own]] = share[own]
        overlap = np.add.reduceat(np.minimum(mine[place], share), bounds[:-1])
        mine[place[own]] = 0
        common = overlap * np.maximum(sizes[q], sizes)
        value = np.where(unit & unit[q], common / (sizes[q] + sizes - common), np.where(overlap >= similarity - 1e-9, 2, 0))
        alike = np.flatnonzero(node & (roots != roots[q]) & (value >= similarity - 1e-9))
        for y in alike.tolist():
            if top(roots[q]) == top(roots[y]):
                continue
            other = slice(bounds[y], bounds[y + 1])
            if value[y] <= 1.5 or probability_jaccard(keys[own], weights[own], keys[other], weights[other]) >= similarity - 1e-9:
                joined[top(roots[q])] = top(roots[y])
                found.append((max(ids[q], ids[y]), min(ids[q], ids[y])))
    return found


def _ordered(pairs: DataFrame, x: str, y: str) -> DataFrame:
    return pairs.where(F.col(x) != F.col(y)) \
        .select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).distinct()


def _own_ids(first: DataFrame, again: DataFrame, docs: DataFrame) -> DataFrame:
    """Nodes of the ids in ``again``, which name several (rows that repeat an id with other
    texts): id, print1, print2 and node, the id for one of them and a number that no doc_id has
    for the others."""
    several = first.select("id", "print1", "print2").join(again, "id", "left_semi")
    kept = several.groupBy("id").agg(F.min(F.struct("print1", "print2")).alias("kept"))
    several = several.join(kept, "id").withColumn("is_kept", F.col("kept") == F.struct("print1", "print2"))
    ids = docs.select(F.col("doc_id").cast("long").alias("node")).where("node IS NOT NULL")
    salt = 0
    while True:
        drawn = stored(several.select("id", "print1", "print2", F.when(F.col("is_kept"), F.col("id")).otherwise(
            F.xxhash64(F.lit(salt), "print1", "print2")).alias("node"), "is_kept"), "near-several")
        made = drawn.where("NOT is_kept").select("node")
        twice = made.groupBy("node").count().where("count > 1").select("node")
        if made.join(ids, "node", "left_semi").unionByName(twice).isEmpty():
            return drawn.select("id", "print1", "print2", "node")
        salt += 1


def classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id (the least doc_id of the class) of every distinct doc_id; a null
    id has a null class."""
    drawn = stored(sketches(docs), "near-sketches")
    prints = ["print1", "print2"]
    # equal word sequences: one node. Rows that repeat an id with another text link its nodes below.
    first = drawn.groupBy(*prints).agg(F.min("doc_id").alias("id"), F.first("buckets").alias("buckets"),
                                       F.first("bytes").alias("bytes"))
    first = stored(first, "near-nodes")
    copies = drawn.select("doc_id", *prints).join(first.select("id", *prints), prints) \
        .where(F.col("doc_id") != F.col("id")).select(F.greatest("doc_id", "id").alias("a"), F.least("doc_id", "id").alias("b")).distinct()
    nodes = first.select("id", "buckets", "bytes")
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text")) \
        .where("id IS NOT NULL AND text IS NOT NULL")
    # an id that names several nodes: all but one get a number, their own text, and a link to the id.
    # (The id's own node may be compared by any text of the id: what is alike to one is of its class.)
    again = first.groupBy("id").count().where("count > 1").select("id")
    extra = bool(again.take(1))
    if extra:
        own = stored(_own_ids(first, again, docs).where("id <> node"), "near-own")
        named = first.join(own, ["id", *prints], "left").withColumn("node", F.coalesce("node", "id"))
        nodes = stored(named.select(F.col("node").alias("id"), "buckets", "bytes"), "near-distinct")
        rows = sketches(docs.join(own.select("id").distinct(), F.col("doc_id").cast("long") == F.col("id"), "left_semi"), True)
        of_node = rows.withColumnRenamed("doc_id", "id").join(own, ["id", *prints]) \
            .groupBy("node").agg(F.min("text").alias("text"))
        texts = texts.unionByName(of_node.select(F.col("node").alias("id"), "text"))
        copies = copies.unionByName(own.select(F.greatest("id", "node").alias("a"), F.least("id", "node").alias("b")))
    meets = nodes.select(F.explode("buckets").alias("bucket"), "id")
    shared = meets.groupBy("bucket").agg(F.min("id").alias("least"), F.max("id").alias("most")) \
        .where("least < most").select("bucket", "least")
    members = stored(meets.join(shared, "bucket"), "near-members")

    # first every node with the least node it meets anywhere
    pairs = _ordered(members.groupBy("id").agg(F.min("least").alias("pivot")), "id", "pivot")
    likely = stored(_alike(pairs, nodes), "near-pairs")
    roots = components(_checked(likely, texts, similarity))
    # then, in buckets of several components, all that isn't connected yet, in blocks
    members = stored(members.join(roots, "id", "left").select("bucket", "id", F.coalesce("root", "id").alias("root"))
                     .join(nodes.select("id", "bytes"), "id"), "near-rooted")
    close = stored(_blocks(members, "bytes", BLOCK_ROWS, _close_nodes, "bucket long, id long").distinct(), "near-close")
    members = members.drop("bytes").join(close, ["bucket", "id"], "left_semi").join(texts, "id")
    found = _blocks(members, "text", BLOCK_ROWS, lambda *x: _linked_nodes(*x, similarity), "a long, b long")
    linked = stored(found.distinct(), "near-links")
    roots = components(roots.select(F.col("id").alias("a"), F.col("root").alias("b")).unionByName(linked))
    everything = roots.select(F.col("id").alias("a"), F.col("root").alias("b")).unionByName(copies)
    final = components(everything)
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    found = ids.join(final.withColumnRenamed("id", "doc_id"), "doc_id", "left") \
        .select("doc_id", F.coalesce("root", "doc_id").alias("class_id"))
    if extra:      # a class may be named by a node's number: its least doc_id takes its place
        found = stored(found, "near-found")
        least = found.groupBy("class_id").agg(F.min("doc_id").alias("least")).where("least <> class_id")
        found = found.join(least, "class_id", "left").select("doc_id", F.coalesce("least", "class_id").alias("class_id"))
    return found
