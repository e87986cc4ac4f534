"""Operator 6: packing documents into fixed windows by minimum bin slack.

A document's ids (with an end id) are cut into full windows and one remainder.
Full windows stand alone. Remainders are dealt by a hash of their document to
groups of bounded size; within a group only the counts of each remaining length
matter. For each window the longest length left is placed, then a bitset
subset-sum over the lengths left (kept counts, binary-split) finds the largest
sum that still fits, and walking the bitsets back gives the count of each
length. The pattern is repeated while its counts last. A window may end at a
power of two without padding, so a sum that gives one is as good as a full one.

Defined results: a null text is empty (its only id is the end id); rows with a
null doc_id are packed like any other; repeated rows are packed each; an empty
table gives no sequence.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landsales.llm.common import extended, stored
from landsales.llm.tokens import encoder

WINDOW = 1024
GROUP_ROWS = 50_000         # remainders packed together on average
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, row_key long, ids binary")


def cut(docs: DataFrame, tokenizer_path: str, end_id: int = 0, window: int = WINDOW,
        with_ids: bool = False) -> DataFrame:
    """Pieces of every document: (doc_id, start, length, ids_crc32, doc_tokens, row_key, ids)."""
    end = np.asarray([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer_path)
        for batch in batches:
            rows, held = [], 0
            doc_ids, texts, keys = (batch.column(i).to_pylist() for i in range(3))
            for doc_id, ids, key in zip(doc_ids, coder.encode_batch(texts), keys):
                ids += end
                total = len(ids) // 4
                for start in range(0, total, window):
                    part = ids[4 * start:4 * (start + window)]
                    rows.append((doc_id, start, len(part) // 4, zlib.crc32(part), total, key,
                                 part if with_ids else None))
                held += len(ids)
                if held > 8 << 20:
                    yield _batch(rows)
                    rows, held = [], 0
            if rows:
                yield _batch(rows)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                       F.xxhash64(F.col("doc_id").cast("long")).alias("row_key"))
    return rows.mapInArrow(run, PIECES)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64()] * 6 + [pa.binary()]
    names = [f.split()[0] for f in PIECES.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def best_subset(counts: dict[int, int], room: int, wanted: int) -> dict[int, int]:
    """Counts of lengths whose sum is closest to ``room`` from below; stops early
    once a sum in the bitset ``wanted`` (targets that leave no padding) is met.

    Bit s of a layer is set when a sum s can be made from the items so far. An
    item is a bundle of 1, 2, 4, ... equal lengths.
    """
    full = (1 << (room + 1)) - 1
    layers, sums = [], 1
    for length in sorted(counts, reverse=True):
        left = min(counts[length], room // length)
        bundle = 1
        while left > 0:
            take = min(bundle, left)
            left -= take
            bundle *= 2
            more = sums | (sums << (take * length)) & full
            if more != sums:
                layers.append((length, take, sums))
                sums = more
        if sums & wanted:
            break
    hit = sums & wanted
    at = (hit if hit else sums).bit_length() - 1
    used: dict[int, int] = {}
    for length, take, before in reversed(layers):
        if not (before >> at) & 1:          # only this bundle reaches the sum
            at -= length * take
            used[length] = used.get(length, 0) + take
    return used


def patterns(lengths: np.ndarray, window: int = WINDOW) -> Iterator[tuple[dict[int, int], int]]:
    """(counts per length, repetitions) of the windows that use up all lengths."""
    counts = {int(n): int(c) for n, c in zip(*np.unique(lengths, return_counts=True))}
    free = [1 << k for k in range(window.bit_length()) if 1 << k <= window] + [window]
    while counts:
        longest = max(counts)
        first = counts[longest] - 1
        left = {k: c for k, c in counts.items() if k != longest}
        if first:
            left[longest] = first
        room = window - longest
        wanted = 1 << room
        used = best_subset(left, room, wanted) if room else {}
        slack = room - sum(k * c for k, c in used.items())
        if slack:
            # no full window: an end at a power of two needs no padding either
            short = max((p - longest for p in free if longest <= p <= window - slack), default=None)
            if short is not None:
                other = best_subset(left, short, 1 << short) if short else {}
                if sum(k * c for k, c in other.items()) == short:
                    used = other
        used = dict(used)
        used[longest] = used.get(longest, 0) + 1
        times = min(counts[k] // c for k, c in used.items())
        yield used, times
        for k, c in used.items():
            counts[k] -= c * times
            if not counts[k]:
                del counts[k]


def assign(lengths: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(sequence number, offset) of each length, in the given order of rows."""
    by_length: dict[int, list[int]] = {}
    order = np.argsort(lengths, kind="stable")[::-1]
    for row in order:
        by_length.setdefault(int(lengths[row]), []).append(int(row))
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    number = 0
    for used, times in patterns(lengths, window):
        for _ in range(times):
            at = 0
            for length in sorted(used, reverse=True):
                for _ in range(used[length]):
                    row = by_length[length].pop()
                    sequence[row], offset[row] = number, at
                    at += length
            number += 1
    return sequence, offset


def pack(pieces: DataFrame, window: int = WINDOW, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Adds sequence_id and offset. Sequence k of group g is numbered 2 * (g * 2^32 + k);
    full windows have odd numbers."""
    pieces = stored(pieces, "pack-pieces")
    full = pieces.where(F.col("length") == window)
    rest = pieces.where(F.col("length") < window)
    groups = max(1, -(-rest.count() // group_rows))
    schema = extended(pieces, sequence_id=T.LongType(), offset=T.LongType())

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("length", "ascending"), ("row_key", "ascending"), ("start", "ascending"),
                               ("ids_crc32", "ascending")])
        sequence, offset = assign(group.column("length").to_numpy(), window)
        number = (group.column("grp").to_numpy() << 32) + sequence
        return group.drop_columns(["grp"]).append_column("sequence_id", pa.array(2 * number)) \
            .append_column("offset", pa.array(offset))

    # the stored row's position is part of the hash, so rows that repeat an id spread too
    dealt = rest.withColumn("grp", F.pmod(F.xxhash64("row_key", F.monotonically_increasing_id()), F.lit(groups)))
    packed = dealt.groupBy("grp").applyInArrow(run, schema)
    # numbers of full windows are odd, and unique by the piece's position in the stored table
    alone = full.withColumn("sequence_id", 2 * F.monotonically_increasing_id() + 1) \
        .withColumn("offset", F.lit(0).cast("long"))
    return packed.unionByName(alone)


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 0, window: int = WINDOW,
                   with_ids: bool = False) -> DataFrame:
    """Pieces with their sequence and offset (and ids, if wanted)."""
    pieces = cut(docs, tokenizer_path, end_id, window, with_ids)
    pieces = pieces if with_ids else pieces.drop("ids")
    return pack(pieces, window).drop("row_key")
