"""Operator 9: prediction by partial matching over bytes, beside a word-count base.

Training texts give counts of (5-byte context, next byte), summed over the
cluster. They form a trie: order k holds the contexts of k bytes, its counts the
sums of order k+1. A byte is coded at the longest context that knows it, with
escape method C: ``n / (N + D)`` for a byte seen n times, ``D / (N + D)`` to
escape, where N counts the context's bytes and D its distinct ones. After an
escape the bytes seen in the longer context are excluded. A context knows all
bytes its extensions know, so what is excluded from a shorter context is one sum
per context, kept with it. Below order 0 the rest of the alphabet is equally
likely. Each text ends with an end symbol; before it stand start symbols.

All counting covers all training texts, and every counted gram counts in the
scores. Up to ``MAX_GRAMS`` distinct grams, tasks hold the whole trie. With more,
they hold the probabilities of the most frequent grams, and all other grams,
counted per row, are joined to the stored counts order by order. Words use
a broadcast head of at most ``HEAD_WORDS`` words; the occurrences of all other
words are joined to their counts by a shuffle, so no word is dropped.

Defined results: a null text is empty: one token (the end); rows with a null
doc_id count as held out; repeated rows count and are scored each; with no
training text every byte has probability 1/255 and known counts are 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landsales.llm.common import stored
from landsales.llm.kernels import NON_SPACE, slices, utf8, words

ORDER = 5
MAX_GRAMS = 2_000_000
HEAD_WORDS = 1_000_000
MERGE_ROWS = 2_000_000       # partial counts a task holds before it hands them on
SLICE = 1 << 18              # bytes worked on at a time: some twenty times as much memory
START, END = 0xFE, 0xFF      # no byte of UTF-8 text
ALPHABET = 255               # all bytes but START
FOLDS = 10
GRAM, WORD = 0, 1
U = np.uint64
_FOLD_CASE = np.arange(256, dtype=np.uint8)
_FOLD_CASE[0x41:0x5B] += 32


class Lookup:
    """Open-addressing table from 64-bit keys to numbers, probed many keys at once. The slots
    hold places in the keys and values, which are kept once and as they come: every task has
    a copy of the table."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(2 * len(keys)).bit_length())
        size = 1 << self.bits
        self.keys, self.values = keys, values
        self.slots = np.full(size, -1, np.int32 if len(keys) < 1 << 31 else np.int64)
        at, left = self._slot(keys), np.arange(len(keys))
        while left.size:
            free = self.slots[at] < 0
            slot, first = np.unique(at[free], return_index=True)
            self.slots[slot] = left[free][first]
            rest = np.ones(len(left), bool)
            rest[np.flatnonzero(free)[first]] = False
            left, at = left[rest], at[rest]
            at = np.where(self.slots[at] >= 0, (at + 1) & (size - 1), at)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys * U(0x9E3779B97F4A7C15)) >> U(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(values, is the key known); values of unknown keys are 0."""
        out, known = np.zeros(len(keys), self.values.dtype), np.zeros(len(keys), bool)
        at, left = self._slot(keys), np.arange(len(keys))
        while left.size:
            place = self.slots[at]
            there = place >= 0
            at, left, place = at[there], left[there], place[there]
            same = self.keys[place] == keys[left]
            out[left[same]], known[left[same]] = self.values[place[same]], True
            left, at = left[~same], (at[~same] + 1) & (len(self.slots) - 1)
        return out, known


def _narrow(numbers: np.ndarray) -> np.ndarray:
    """Whole numbers in 32 bits if they fit."""
    return numbers.astype(np.int32) if not len(numbers) or numbers.max() < 1 << 31 else numbers


class Trie:
    """Contexts of orders 0..ORDER with what coding needs. Keys: context bytes, then the byte."""

    def __init__(self, orders: list[tuple[np.ndarray, np.ndarray]]):
        """orders[k]: sorted keys and counts of order k."""
        self.keys = [k for k, _ in orders]
        self.counts = [n for _, n in orders]
        self.contexts, self.total, self.distinct, self.excluded = [], [], [], []
        for k, (keys, counts) in enumerate(orders):
            first = np.flatnonzero(np.r_[True, (keys[1:] >> U(8)) != (keys[:-1] >> U(8))]) if len(keys) else np.zeros(0, int)
            self.contexts.append((keys >> U(8))[first])
            self.total.append(np.add.reduceat(counts, first) if len(first) else counts)
            self.distinct.append(np.diff(np.r_[first, len(keys)]))
            if k == 0 or not len(first):
                self.excluded.append(np.zeros(len(first), np.int64))
            else:
                shorter = np.searchsorted(self.keys[k - 1], keys & U((1 << 8 * k) - 1))
                self.excluded.append(np.add.reduceat(self.counts[k - 1][shorter], first))
        if len(self.keys[-1]):
            place = np.searchsorted(self.contexts[-1], self.keys[-1] >> U(8))
            logs = np.log10(self.counts[-1] / (self.total[-1] + self.distinct[-1])[place])
        else:
            logs = np.zeros(0)
        self.known = Lookup(self.keys[-1], logs)
        for numbers in (self.counts, self.total, self.distinct, self.excluded):
            numbers[:] = map(_narrow, numbers)

    @staticmethod
    def _at(sorted_keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(sorted_keys):
            return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
        at = np.minimum(np.searchsorted(sorted_keys, wanted), len(sorted_keys) - 1)
        return at, sorted_keys[at] == wanted

    def escape(self, grams: np.ndarray) -> np.ndarray:
        """log10 probability of grams the longest order doesn't know."""
        out = np.zeros(len(grams))
        live = np.arange(len(grams))
        gone_n, gone_d = np.zeros(len(grams), np.int64), np.zeros(len(grams), np.int64)
        for k in range(ORDER, -1, -1):
            if not live.size:
                return out
            key = grams[live] & U((1 << 8 * (k + 1)) - 1)
            context, there = self._at(self.contexts[k], key >> U(8))
            total = np.where(there, self.total[k][context] if len(self.total[k]) else 0, 0) - gone_n[live]
            distinct = np.where(there, self.distinct[k][context] if len(self.distinct[k]) else 0, 0) - gone_d[live]
            at, seen = self._at(self.keys[k], key)
            room = np.maximum(total + distinct, 1)
            n = self.counts[k][at] if len(self.counts[k]) else np.zeros(len(live), np.int64)
            out[live] += np.where(seen, np.log10(np.where(seen, n, 1) / room),
                                  np.where(there & (distinct > 0), np.log10(np.maximum(distinct, 1) / room), 0))
            gone_n[live] = np.where(there, self.excluded[k][context] if len(self.excluded[k]) else 0, gone_n[live] * 0)
            gone_d[live] = np.where(there, self.distinct[k][context] if len(self.distinct[k]) else 0, 0)
            live = live[~seen]
        out[live] -= np.log10(ALPHABET - gone_d[live])
        return out

    def score(self, grams: np.ndarray) -> np.ndarray:
        """log10 probability of every gram."""
        out, known = self.known.find(grams)
        unknown = np.flatnonzero(~known)
        if unknown.size:
            distinct, place = np.unique(grams[unknown], return_inverse=True)
            out[unknown] = self.escape(distinct)[place]
        return out


def byte_grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(grams, first gram of each row): context bytes and byte of every byte and end symbol."""
    view = memoryview(np.ascontiguousarray(_FOLD_CASE[data]))
    start, end = bytes([START]) * ORDER, bytes([END])
    parts = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        parts += (start, view[a:b], end)
    text = np.frombuffer(b"".join(parts), np.uint8)
    if not len(text):
        return np.zeros(0, U), np.zeros(0, np.int64)
    wide = text.astype(U)
    grams = wide[ORDER:].copy()
    for k in range(1, ORDER + 1):
        grams |= wide[ORDER - k:len(wide) - k] << U(8 * k)
    return grams[text[ORDER:] != START], offsets[:-1] + np.arange(len(offsets) - 1)


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


class Counter:
    """Counts of 64-bit keys; hands on partial counts when it holds many."""

    def __init__(self, kind: int):
        self.kind, self.parts, self.rows = kind, [], 0

    def add(self, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        keys, counts = np.unique(keys, return_counts=True)
        self.parts.append((keys, counts))
        self.rows += len(keys)
        if self.rows > MERGE_ROWS:
            merged = _merged(self.parts)
            self.parts, self.rows = [merged], len(merged[0])
            if self.rows > MERGE_ROWS // 2:
                yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            keys, counts = _merged(self.parts)
            self.parts, self.rows = [], 0
            for a in range(0, len(keys), 1 << 18):
                part = keys[a:a + (1 << 18)].view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(part), self.kind, np.int32)), pa.array(part),
                     pa.array(counts[a:a + (1 << 18)])], names=["kind", "key", "n"])


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def train(docs: DataFrame) -> DataFrame:
    """Stored counts over the rows not held out: kind (gram or word), key, n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, tokens = Counter(GRAM), Counter(WORD)
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            for a, b in slices(offsets, SLICE):
                part, own = data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
                yield from grams.add(byte_grams(part, own)[0])
                yield from tokens.add(words(part, own, NON_SPACE)[0])
        yield from grams.flush()
        yield from tokens.flush()

    texts = docs.where(~held_out(F.col("doc_id"))).select(F.col("text").cast("string").alias("text"))
    return stored(texts.mapInArrow(run, "kind int, key long, n long").groupBy("kind", "key")
                  .agg(F.sum("n").alias("n")), "lm-counts")


def _at_least(counts: DataFrame, limit: int) -> int:
    """The least count that at most ``limit`` keys reach. Only a histogram of at most a
    few hundred rows comes to the driver."""
    eighth = F.floor(F.log2("n") * 8)
    bins = sorted(counts.groupBy(eighth.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min("n").alias("least"))
                  .collect(), reverse=True)
    total, least = 0, (bins[0]["least"] + 1 if bins else 1)
    for row in bins:
        total += row["n"]
        if total > limit:
            break
        least = row["least"]
    return least


def _bounded(counts: DataFrame, least: int) -> tuple[np.ndarray, np.ndarray]:
    table = counts.where(F.col("n") >= least).select("key", "n").toArrow()
    keys, n = (table.column(c).to_numpy() for c in ("key", "n"))
    order = np.argsort(keys.view(U))
    return np.ascontiguousarray(keys.view(U)[order]), np.ascontiguousarray(n[order])


def _bits(k: int) -> F.Column:
    """The mask of a gram of order k: k context bytes and the byte."""
    return F.lit((1 << 8 * (k + 1)) - 1)


def gram_orders(counts: DataFrame) -> list[DataFrame]:
    """key, n of all grams of orders 0..ORDER; shorter orders are sums of longer ones."""
    orders = [counts.where(F.col("kind") == GRAM).select("key", "n")]
    for k in range(ORDER - 1, -1, -1):
        orders.insert(0, stored(orders[0].groupBy(F.col("key").bitwiseAND(_bits(k)).alias("key"))
                                .agg(F.sum("n").alias("n")), "lm-order"))
    return orders


def build_trie(orders: list[DataFrame]) -> Trie:
    return Trie([_bounded(grams, 0) for grams in orders])


def head_logs(grams: DataFrame, max_grams: int) -> Lookup:
    """log10 probabilities of at most ``max_grams`` grams of the longest order, the most frequent."""
    context = Window.partitionBy(F.shiftrightunsigned("key", 8))
    logs = F.log10(F.col("n") / (F.sum("n").over(context) + F.count(F.lit(1)).over(context)))
    table = grams.withColumn("log", logs).where(F.col("n") >= _at_least(grams, max_grams)).select("key", "log").toArrow()
    return Lookup(table.column("key").to_numpy().view(U), table.column("log").to_numpy())


def joined_logs(wanted: DataFrame, orders: list[DataFrame]) -> DataFrame:
    """key, log of the distinct grams ``wanted``: ``Trie.score`` as joins, one order after the other."""
    live = wanted.select("key", F.lit(0.0).alias("log"), F.lit(0).cast("long").alias("gone_n"),
                         F.lit(0).cast("long").alias("gone_d"))
    done = []
    for k in range(ORDER, -1, -1):
        grams = orders[k].select(F.col("key").alias("gram"), "n")
        own = grams.withColumn("excluded", F.lit(0).cast("long"))
        if k:
            shorter = orders[k - 1].select(F.col("key").alias("short"), F.col("n").alias("excluded"))
            own = grams.withColumn("short", F.col("gram").bitwiseAND(_bits(k - 1))).join(shorter, "short")
        contexts = own.groupBy(F.shiftrightunsigned("gram", 8).alias("context")) \
            .agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("distinct"), F.sum("excluded").alias("excluded"))
        if k < 2:                       # at most 255 grams, or 255 a context of one byte
            grams, contexts = F.broadcast(grams), F.broadcast(contexts)
        known, distinct = F.coalesce("distinct", F.lit(0)), F.coalesce("distinct", F.lit(0)) - F.col("gone_d")
        room = F.greatest(F.coalesce("total", F.lit(0)) - F.col("gone_n") + distinct, F.lit(1))
        step = F.when(F.col("n").isNotNull(), F.log10(F.col("n") / room)) \
            .when(distinct > 0, F.log10(distinct / room)).otherwise(0.0)
        live = live.withColumn("gram", F.col("key").bitwiseAND(_bits(k))) \
            .withColumn("context", F.shiftrightunsigned("gram", 8)) \
            .join(grams, "gram", "left").join(contexts, "context", "left") \
            .select("key", (F.col("log") + step).alias("log"), F.coalesce("excluded", F.lit(0)).alias("gone_n"),
                    known.alias("gone_d"), F.col("n").isNotNull().alias("seen"))
        live = stored(live, "lm-escape")
        done.append(live.where("seen").select("key", "log"))
        live = live.where("NOT seen").drop("seen")
    done.append(live.select("key", (F.col("log") - F.log10(F.lit(ALPHABET) - F.col("gone_d"))).alias("log")))
    return reduce(DataFrame.unionByName, done)


def _per_row(grams: np.ndarray, row: np.ndarray, size: int) -> list[pa.Array]:
    """Lists of the distinct grams of each row, and of their numbers."""
    order = np.lexsort((grams, row))
    grams, row = grams[order], row[order]
    new = np.flatnonzero(np.r_[True, (grams[1:] != grams[:-1]) | (row[1:] != row[:-1])]) if len(row) else np.zeros(0, np.int64)
    ends = pa.array(np.searchsorted(row[new], np.arange(size + 1)).astype(np.int32))
    return [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (grams[new].view(np.int64), np.diff(np.r_[new, len(row)]))]


def score(docs: DataFrame, max_grams: int = MAX_GRAMS, head_words: int = HEAD_WORDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score per row."""
    spark = docs.sparkSession
    counts = train(docs)
    orders = gram_orders(counts)
    whole = orders[ORDER].count() <= max_grams
    model = spark.sparkContext.broadcast(build_trie(orders) if whole else head_logs(orders[ORDER], max_grams))
    vocabulary = counts.where(F.col("kind") == WORD).select("key", "n")
    total = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    ends = docs.where(~held_out(F.col("doc_id"))).count()
    tokens, distinct = total[0] + ends, total[1] + (ends > 0)
    room = tokens + 0.1 * (distinct + 1)
    least = _at_least(vocabulary, head_words)
    head = spark.sparkContext.broadcast(Lookup(*_bounded(vocabulary, least)))
    end_log = float(np.log10((ends + 0.1) / room))

    names = ["row_id", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "tail", "grams", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row_id = TaskContext.get().partitionId() << 33
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            for a, b in slices(offsets, SLICE):
                part, own = data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
                grams, first = byte_grams(part, own)
                if whole:
                    logs, missed = model.value.score(grams), np.zeros(0, np.int64)
                else:
                    logs, known = model.value.find(grams)
                    missed = np.flatnonzero(~known)
                scores = np.add.reduceat(logs, first)
                rest_grams = _per_row(grams[missed], np.searchsorted(first, missed, side="right") - 1, b - a)
                hashes, at = words(part, own, NON_SPACE)
                n, known = head.value.find(hashes)
                logs = np.r_[0.0, np.cumsum(np.where(known, np.log10((n + 0.1) / room), 0.0))]
                found = np.r_[0, np.cumsum(known)]
                rest = np.r_[0, np.cumsum(~known)]
                tail = pa.ListArray.from_arrays(pa.array(rest[at].astype(np.int32)),
                                                pa.array(hashes[~known].view(np.int64)))
                size = b - a
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row_id + np.arange(size)), batch.column(0)[a:b], batch.column(1)[a:b],
                     pa.array(np.diff(at) + 1), pa.array(found[at[1:]] - found[at[:-1]] + int(ends > 0)),
                     pa.array(logs[at[1:]] - logs[at[:-1]] + end_log), pa.array(scores), tail,
                     *rest_grams], names=names)
                row_id += size

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"),
                       F.col("text").cast("string").alias("text"))
    scored = stored(rows.mapInArrow(run, "row_id long, doc_id long, held_out boolean, n_tokens long, n_known long, "
                                         "base_score double, score double, tail array<long>, "
                                         "grams array<long>, times array<long>"), "lm-scored")
    # words outside the head: joined to their counts, whatever their number
    rare = scored.select("row_id", F.explode("tail").alias("key"))
    rare = rare.join(vocabulary.where(F.col("n") < least), "key", "left") \
        .groupBy("row_id").agg(F.count("n").alias("more_known"),
                               F.sum(F.log10((F.coalesce("n", F.lit(0)) + 0.1) / F.lit(room))).alias("more_base"))
    scored_rows = scored.drop("tail", "grams", "times").join(rare, "row_id", "left")
    if whole:
        scored_rows = scored_rows.withColumn("more", F.lit(0.0))
    else:
        # grams outside the head: joined to the counts of all orders
        missed = scored.select("row_id", F.explode(F.arrays_zip("grams", "times")).alias("g")) \
            .select("row_id", F.col("g.grams").alias("key"), F.col("g.times").alias("times"))
        logs = joined_logs(missed.select("key").distinct(), orders)
        scored_rows = scored_rows.join(missed.join(logs, "key").groupBy("row_id")
                                       .agg(F.sum(F.col("times") * F.col("log")).alias("more")), "row_id", "left")
    return scored_rows \
        .select("doc_id", "held_out", "n_tokens",
                (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
                F.lit(int(tokens)).cast("long").alias("train_tokens"),
                (F.col("base_score") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
                (F.col("score") + F.coalesce("more", F.lit(0.0))).alias("score"))
