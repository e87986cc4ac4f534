"""Operator 12: what each filter removes under every order of the filters.

Every document is measured once and gets a mask with one bit for each filter it fails.
Per part (language) the documents of each mask are counted: at most 2^n cells, however
many documents. A Gray code then walks through all subsets of the filters, toggling one
at a time: each cell keeps a counter of the active filters it fails, and a cell whose
counter leaves or reaches 0 leaves or joins the survivors. The survivors of the 2^n
subsets are stored; a step of an order is the difference of two of them, and a filter's
Shapley sum weighs the differences by the orders that take them.

The five conditions of ``failures``: A under ``MIN_WORDS`` words; B under half of the
words distinct; C over 3 % of the characters in A-Z; D any of ``MARKS``; E the text is
that of a smaller doc_id. Equal texts meet by their SHA-256; only the least doc_id of a
repeated text is looked up, so copies of one text are never gathered.

Defined results: a null text is an empty one, so are its copies; a null lang is the
empty part; a row with a null doc_id is counted, fails E if a row with a doc_id holds
its text, and has no labels; rows that repeat a doc_id and a text are counted each and
none of them fails E by another; several labels of a doc_id count as good or toxic if
any of them is; null labels are neither. An empty table has no parts and gives an empty
result. Only the columns named here are read: others, whatever their names, play no part.
"""

from __future__ import annotations

import hashlib
from itertools import permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landsales.llm.common import stored

MIN_WORDS = 200
MARKS = b"#$%&*|"
FILTERS = "ABCDE"
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_CONTINUED = bytes(range(0x80, 0xC0))      # bytes of UTF-8 that don't start a character
_COUNTS = ("n", "good", "toxic")


def text_mask(raw: bytes) -> int:
    """Bits of the filters A to D that a text in UTF-8 fails."""
    words = raw.split()                    # of bytes: exactly the white space \\x20 \\x09-\\x0D
    points = len(raw.translate(None, _CONTINUED))
    return (len(words) < MIN_WORDS) | (100 * len(set(words)) < 50 * len(words)) << 1 \
        | (100 * (len(raw) - len(raw.translate(None, _CAPITALS))) > 3 * points) << 2 \
        | (len(raw.translate(None, MARKS)) < len(raw)) << 3


def _measure(batches):
    for batch in batches:
        texts = batch.column(2).to_pylist()
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(map(text_mask, texts), pa.int32()),
             pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())],
            ["doc_id", "part", "mask", "print"])


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask (bit k: the k-th of FILTERS fails), good and toxic (0 or 1) of every document."""
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("raw"))
    rows = stored(rows.mapInArrow(_measure, "doc_id long, part string, mask int, print binary"), "audit")
    repeated = rows.groupBy("print").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("rows")) \
        .where("rows > 1 AND first_id IS NOT NULL").select("print", "first_id")
    marked = labels.where("quality = 1 OR toxic = 1").where("doc_id IS NOT NULL") \
        .groupBy(F.col("doc_id").cast("long").alias("labelled")) \
        .agg(F.max(F.expr("int(coalesce(quality = 1, false))")).alias("good"),
             F.max(F.expr("int(coalesce(toxic = 1, false))")).alias("toxic"))
    later = (F.col("first_id") < F.col("doc_id")) | (F.col("first_id").isNotNull() & F.col("doc_id").isNull())
    return rows.join(repeated, "print", "left") \
        .join(marked, F.col("doc_id") == F.col("labelled"), "left") \
        .select("part", (F.col("mask") + F.when(later, 1 << FILTERS.index("E")).otherwise(0)).alias("mask"),
                F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))


def gray_walk(cells: dict[int, tuple], n: int) -> list[tuple]:
    """Survivors (a tuple of counts) of each subset of ``n`` filters, by the subset's bits.
    ``cells`` has the counts of every mask of failed filters."""
    failing = dict.fromkeys(cells, 0)
    alive = [sum(counts) for counts in zip(*cells.values())]
    states = [tuple(alive)] * (1 << n)
    subset = 0
    for step in range(1, 1 << n):
        bit = step & -step                              # the filter that the Gray code toggles
        subset ^= bit
        for mask, counts in cells.items():
            if mask & bit:
                was = failing[mask]
                failing[mask] = was + (1 if subset & bit else -1)
                if not was or not failing[mask]:        # it leaves or joins the survivors
                    sign = -1 if not was else 1
                    alive = [a + sign * c for a, c in zip(alive, counts)]
        states[subset] = tuple(alive)
    return states


def steps(cells: dict[int, tuple], letters: str) -> list[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)
    of every step of every order, from the counts (documents, good, toxic) of each mask."""
    n = len(letters)
    states = gray_walk(cells, n)
    every = (1 << n) - 1
    shapley, unique, failing = [], [], []
    for k in range(n):
        bit = 1 << k
        shapley.append(sum((states[s][0] - states[s | bit][0]) * factorial(s.bit_count()) * factorial(n - 1 - s.bit_count())
                           for s in range(1 << n) if not s & bit))
        unique.append(states[every ^ bit][0] - states[every][0])
        failing.append(states[0][0] - states[bit][0])
    made = []
    for order in permutations(range(n)):
        name, subset = "".join(letters[k] for k in order), 0
        for step, k in enumerate(order, 1):
            before, now = states[subset], states[subset | 1 << k]
            subset |= 1 << k
            removed = before[0] - now[0]
            made.append((name, step, now[0], removed, failing[k] - removed, unique[k],
                         before[1] - now[1], before[2] - now[2], shapley[k]))
    return made


def audit(flags: DataFrame, letters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step. ``flags`` has part, mask, good and
    toxic of every document; the mask's bit k says that it fails the filter ``letters[k]``."""
    cells = flags.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), F.sum("good").cast("long").alias("good"),
                                              F.sum("toxic").cast("long").alias("toxic"))
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("mask", *_COUNTS)).alias("cells"))   # 2^n at most

    def run(batches):
        for batch in batches:
            for part, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = steps({c["mask"]: tuple(c[x] for x in _COUNTS) for c in found}, letters)
                columns = [[part] * len(rows), *map(list, zip(*rows))]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _AUDIT)], schema=_AUDIT)

    return parts.mapInArrow(run, "part string, filter_order string, step int, kept long, removed long, redundant long, "
                                 "unique_fails long, good_lost long, toxic_lost long, shapley long")


_AUDIT = pa.schema([("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32())]
                   + [(c, pa.int64()) for c in ("kept", "removed", "redundant", "unique_fails", "good_lost",
                                                "toxic_lost", "shapley")])
