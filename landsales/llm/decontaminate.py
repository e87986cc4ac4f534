"""Operator 4: benchmark passages in training texts, seeded by rare n-grams and
scored by Smith-Waterman alignment.

Words are runs of ASCII letters, digits and non-ASCII characters, A-Z lowered;
each character of a script without spaces is a word of its own. Items of fewer
words than ``MIN_WORDS`` are matched by exact copies.
An alignment (word matches +1, changed, added and dropped words -1) of score s
has at most one more run of matches than errors, so at least s - 1 pairs of
adjacent words match. Of an item's pairs that some document holds, all but the
``need - 2`` found in most documents are therefore seeds: every leak has one,
wherever it was edited. A seed's place in a text fixes a diagonal; the stretch
of text that an alignment through it can reach is aligned with the whole item if
it holds ``need - 1`` pairs of the item, many stretches at a time. The result is
that of Smith-Waterman on all pairs of documents and items.

Items are handled in blocks of a bounded number of words: a block's n-grams are
broadcast and all documents are read once per block, so a benchmark of any size
is matched whole with bounded memory.

Defined results: null or empty texts and items of fewer than ``SHORTEST``
words give no hit; a hit of a row with a null doc_id has a null doc_id; rows that
repeat a doc_id or item_id count as one (the best score stays); empty tables
give no hits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landsales.llm.common import stored
from landsales.llm.kernels import ALNUM, grams, slices, utf8, words

GRAM = 2                    # words of a seed
SHORTEST = 3                # words an item must have
MIN_SHARE, MIN_WORDS = 0.4, 7   # score >= share of the item's words, and at least so many or all
UNSPACED = r"\x{E00}-\x{EFF}\x{1000}-\x{10BF}\x{1780}-\x{17FF}\x{3040}-\x{30FF}\x{3400}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}"
_PREFIXES = np.zeros(1 << 16, bool)     # the first two UTF-8 bytes of those characters
for _low, _high in ((0xE0B8, 0xE0BB), (0xE180, 0xE182), (0xE19E, 0xE19F), (0xE381, 0xE383), (0xE390, 0xE3BF),
                    (0xE480, 0xE4BF), (0xE580, 0xE5BF), (0xE680, 0xE6BF), (0xE780, 0xE7BF), (0xE880, 0xE8BF),
                    (0xE980, 0xE9BF), (0xEFA4, 0xEFAB), (0xF0A0, 0xF0BF)):
    _PREFIXES[_low:_high + 1] = True
LONG_RUN = 16               # a score that is a leak whatever the item's length
BLOCK_WORDS = 1 << 20       # item words broadcast at once
PAIRS = 512                 # passages aligned together,
PASSAGE_WORDS = 1 << 22     # of at most so many words, or one
FILTER_BITS = 22
U = np.uint64


def text_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, first word of each row and the total) over all rows."""
    lead = np.flatnonzero(data >= 0xE0)
    if lead.size:
        lead = lead[_PREFIXES[data[lead].astype(np.int64) << 8 | data[lead + 1]]]
    if lead.size:                       # a space before and after each character of its own
        cuts = np.sort(np.r_[lead, lead + np.where(data[lead] >= 0xF0, 4, 3)])
        data = np.insert(data, cuts, 0x20)
        offsets = offsets + np.searchsorted(cuts, offsets)
        offsets[-1] = len(data)
    return words(data, offsets, ALNUM)


class Seeds:
    """Sorted n-gram hashes with a bit filter in front."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[(hashes >> U(64 - FILTER_BITS)).astype(np.int64)] = True

    def find(self, grams_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions, seed numbers) of the n-grams that are seeds."""
        at = np.flatnonzero(self.filter[(grams_ >> U(64 - FILTER_BITS)).astype(np.int64)])
        if not at.size or not len(self.hashes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        number = np.minimum(np.searchsorted(self.hashes, grams_[at]), len(self.hashes) - 1)
        same = self.hashes[number] == grams_[at]
        return at[same], number[same]


def text_grams(hashes: np.ndarray, first: np.ndarray, n: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram hash per word, is it within one row)."""
    out, valid = np.zeros(len(hashes), U), np.ones(len(hashes), bool)
    made = grams(hashes, n)
    out[:len(made)] = made
    for k in range(1, n):
        ends = first[1:] - k
        valid[ends[(ends >= 0) & (ends < len(hashes))]] = False
    return out, valid


def smith_waterman(items: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best local score and its end column for each pair of rows of word hashes.

    A row of the score matrix is computed at once: the gap along the row is a
    running maximum of ``score + column``."""
    n, width = texts.shape
    column = np.arange(1, width + 1, dtype=np.int32)
    above = np.zeros((n, width + 1), np.int32)
    best, end = np.zeros(n, np.int32), np.zeros(n, np.int64)
    for k in range(items.shape[1]):
        step = np.where(texts == items[:, k:k + 1], 1, -1).astype(np.int32)
        row = np.maximum(np.maximum(above[:, :-1] + step, above[:, 1:] - 1), 0)
        row = np.maximum.accumulate(row + column, axis=1) - column
        above[:, 1:] = row
        at = row.argmax(axis=1)
        score = row[np.arange(n), at]
        better = score > best
        best[better], end[better] = score[better], at[better]
    return best, end + 1


class Block:
    """The items of one block, ready to be matched in a task."""

    def __init__(self, ids: list, hashes: np.ndarray, first: np.ndarray):
        self.ids, self.hashes, self.first = ids, hashes, first
        grams_, valid = text_grams(hashes, first)
        self.place = np.flatnonzero(valid)
        self.gram = grams_[self.place]
        self.item = np.searchsorted(first, self.place, side="right") - 1
        self.offset = self.place - first[self.item]
        self.seeds = Seeds(np.unique(self.gram))
        self.number = np.searchsorted(self.seeds.hashes, self.gram)
        size = first[1:] - first[:-1]
        self.need = np.minimum(np.maximum(np.ceil(MIN_SHARE * size), MIN_WORDS), np.minimum(size, LONG_RUN)).astype(np.int64)

    def rare(self, counts: np.ndarray) -> Block:
        """Make seeds of every item's n-grams but the ``need - 2`` in most documents; n-grams
        that no document holds go first."""
        held = counts[self.number] > 0
        item, number, offset = self.item[held], self.number[held], self.offset[held]
        order = np.lexsort((offset, -counts[number], item))
        item, number, offset = item[order], number[order], offset[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)     # 0: in most documents
        seed = (place >= self.need[item] - 2) & (self.first[item + 1] - self.first[item] >= SHORTEST)
        self.pairs = np.unique(item * len(self.seeds.hashes) + number)
        item, number, offset = item[seed], number[seed], offset[seed]
        order = np.argsort(number, kind="stable")
        self.item, self.offset = item[order], offset[order]
        self.range = np.searchsorted(number[order], np.arange(len(self.seeds.hashes) + 1))
        del self.place, self.gram, self.number
        return self

    def _enough(self, at: np.ndarray, number: np.ndarray, item: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Does the stretch hold as many n-grams of the item as its score needs?"""
        out = np.zeros(len(item), bool)
        low, high = np.searchsorted(at, begin), np.searchsorted(at, stop)
        for a, b in slices(np.r_[0, np.cumsum(high - low)], 1 << 20):
            times = (high - low)[a:b]
            which = np.repeat(np.arange(a, b), times)
            hit = np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times) + low[which]
            wanted = item[which] * len(self.seeds.hashes) + number[hit]
            found = self.pairs[np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)] == wanted
            out[a:b] = np.bincount(which[found] - a, minlength=b - a) >= self.need[item[a:b]] - 1
        return out

    def hits(self, hashes: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """(row, item, score, first and last word + 1 of the passage) of leaks."""
        grams_, valid = text_grams(hashes, first)
        at, number = self.seeds.find(grams_)
        inside = valid[at]
        at, number = at[inside], number[inside]
        low, times = self.range[number], self.range[number + 1] - self.range[number]
        seed = np.repeat(at, times)
        if not seed.size:
            return
        entry = np.arange(len(seed)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(low, times)
        item, row = self.item[entry], np.searchsorted(first, seed, side="right") - 1
        length = (self.first[1:] - self.first[:-1])[item]
        diagonal = (seed - first[row] - self.offset[entry]) // np.maximum(8, length // 2)
        row, item, diagonal = np.unique(np.stack([row, item, diagonal]), axis=1)
        length = (self.first[1:] - self.first[:-1])[item]
        # a part of an alignment before or after its seed has no more errors than matches,
        # so it is at most twice as long as its part of the item
        width = np.maximum(8, length // 2)
        begin = np.maximum(first[row], first[row] + diagonal * width - length)
        stop = np.minimum(first[row + 1], first[row] + (diagonal + 1) * width + 2 * length)
        enough = self._enough(at, number, item, begin, stop)
        row, item, length, begin, stop = (x[enough] for x in (row, item, length, begin, stop))
        order = np.argsort(length, kind="stable")
        k = 0
        while k < len(order):
            longest = 4 * length[order[min(k + PAIRS, len(order)) - 1]] + 8
            part = order[k:k + max(1, min(PAIRS, PASSAGE_WORDS // longest))]
            k += len(part)
            items = np.zeros((len(part), int(length[part].max())), U)
            texts = np.ones((len(part), int((stop - begin)[part].max())), U)
            for j, p in enumerate(part):
                items[j, :length[p]] = self.hashes[self.first[item[p]]:self.first[item[p] + 1]]
                texts[j, :stop[p] - begin[p]] = hashes[begin[p]:stop[p]]
            score, end = smith_waterman(items, texts)
            for j in np.flatnonzero(score >= self.need[item[part]]):
                p = part[j]
                # the same alignment read backwards from its end gives its start
                _, back = smith_waterman(items[j:j + 1, length[p] - 1::-1] if length[p] else items[j:j + 1],
                                         texts[j:j + 1, :end[j]][:, ::-1])
                begin_word = int(begin[p] - first[row[p]])
                yield (int(row[p]), int(item[p]), int(score[j]),
                       begin_word + int(end[j] - back[0]), begin_word + int(end[j]))


def _item_blocks(items: DataFrame, block_words: int) -> list[int]:
    """Numbers of the blocks; items are dealt to them by a hash."""
    total = items.agg(F.sum("n_words")).first()[0] or 0
    return list(range(max(1, -(-2 * total // block_words))))


def leaks(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, item_id, score, item_words, first_word, end_word: the best passage of
    each training document and test item that it leaks."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")) \
        .where("text IS NOT NULL").withColumn("n_words", F.size(F.split("text", r"[^0-9A-Za-z\x{80}-\x{10FFFF}]+"))
                    + F.length("text") - F.length(F.regexp_replace("text", f"[{UNSPACED}]", "")))
    items = stored(items, "leak-items")
    blocks = _item_blocks(items, block_words)
    return reduce(DataFrame.unionByName, [
        _block_leaks(spark, texts, items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(len(blocks))) == b))
        for b in blocks])


def _block_leaks(spark, texts: DataFrame, items: DataFrame) -> DataFrame:
    rows = items.select("item_id", "text").orderBy("item_id", "text").toArrow()   # a block is bounded
    column = rows.column("text").combine_chunks() if rows.num_rows else pa.array([], pa.string())
    column = column.cast(pa.large_string()) if not isinstance(column, pa.ChunkedArray) else column
    hashes, first = text_words(*utf8(column))
    block = Block(rows.column("item_id").to_pylist(), hashes, first)
    seeds = spark.sparkContext.broadcast(block.seeds)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(seeds.value.hashes), np.int64)
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            for a, b in slices(offsets):
                h, f = text_words(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                g, valid = text_grams(h, f)
                at, number = seeds.value.find(g)
                at, number = at[valid[at]], number[valid[at]]
                row = np.searchsorted(f, at, side="right") - 1
                once = np.unique(row * max(1, len(total)) + number)
                total += np.bincount(once % max(1, len(total)), minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["seed", "n"])

    counts = np.zeros(len(block.seeds.hashes), np.int64)
    for seed, n in texts.select("text").mapInArrow(count, "seed long, n long").groupBy("seed").sum("n").toLocalIterator():
        counts[seed] = n
    ready = spark.sparkContext.broadcast(block.rare(counts))

    schema = "doc_id long, item_id long, score long, item_words long, first_word long, end_word long"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = ready.value
        size = block.first[1:] - block.first[:-1]
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            found = []
            for a, b in slices(offsets):
                h, f = text_words(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                for row, item, score, begin, end in block.hits(h, f):
                    found.append((batch.column(0)[a + row].as_py(), block.ids[item], score, int(size[item]), begin, end))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)],
                                                 names=[f.split()[0] for f in schema.split(", ")])

    hits = stored(texts.mapInArrow(scan, schema), "leak-hits")
    best_row = F.max(F.struct("score", (-F.col("first_word")).alias("f"), (-F.col("end_word")).alias("e"), "item_words"))
    return hits.groupBy("doc_id", "item_id").agg(best_row.alias("b")) \
        .select("doc_id", "item_id", "b.score", "b.item_words", (-F.col("b.f")).alias("first_word"),
                (-F.col("b.e")).alias("end_word"))
