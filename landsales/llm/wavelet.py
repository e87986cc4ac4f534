"""Operator 7: token ids of a corpus as one wavelet matrix per shard file.

A wavelet matrix keeps n ids as bit-planes, highest bit first; after each plane
the ids are stably parted by that bit. With rank on the planes it answers
``access(i)`` and ``count(id, i)``, with select ``find(id, k)``, without
unpacking the ids. A shard file holds, behind a small JSON header, the
documents' ids and lengths, the planes and their rank samples, each part a
Zstandard frame.

Shards follow ascending doc_id: texts are range-partitioned and sorted, and each
task writes one file per ``SHARD_TOKENS`` ids (a longer document has a file of
its own).

Defined results: a null text is empty (its only id is the end id); null doc_ids
come first; rows that repeat a doc_id follow one another, ordered by a hash of
their text; an empty table makes no files.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landsales.llm.common import read_file, stored, write_file
from landsales.llm.tokens import encoder
from landsales.session import new_work_dir

MAGIC = b"WMX1"
SHARD_TOKENS = 2 << 20
BLOCK = 512               # bits per rank sample
U = np.uint64


class BitPlane:
    """Packed bits with rank and select; positions are numpy arrays."""

    def __init__(self, words: np.ndarray, n: int, samples: np.ndarray):
        self.words, self.n = words, n
        self.before = np.concatenate([[0], np.cumsum(samples, dtype=np.int64)])
        self.ones = int(self.before[-1])

    @staticmethod
    def pack(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(64-bit words, ones per block) of a 0/1 array."""
        blocks = -(-len(bits) // BLOCK)
        packed = np.zeros(blocks * BLOCK // 8, np.uint8)
        packed[:-(-len(bits) // 8)] = np.packbits(bits, bitorder="little")
        words = packed.view("<u8")
        samples = np.bitwise_count(words).reshape(blocks, -1).sum(axis=1, dtype=np.uint16)
        return words, samples

    def get(self, i: np.ndarray) -> np.ndarray:
        return ((self.words[i >> 6] >> (i & 63).astype(U)) & U(1)).astype(np.int64)

    def rank1(self, i: np.ndarray) -> np.ndarray:
        """Ones before position i (0 <= i <= n)."""
        block = i >> 9
        out = self.before[block].copy()
        word = i >> 6
        for k in range(BLOCK // 64):
            at = (block << 3) + k
            whole = at < word
            partial = (at == word) & ((i & 63) > 0)
            if whole.any():
                out[whole] += np.bitwise_count(self.words[at[whole]])
            if partial.any():
                mask = (U(1) << (i[partial] & 63).astype(U)) - U(1)
                out[partial] += np.bitwise_count(self.words[at[partial]] & mask)
        return out

    def select(self, bit: int, k: np.ndarray) -> np.ndarray:
        """Position of the k-th (from 0) one or zero, by bisection over rank."""
        low, high = np.zeros(len(k), np.int64), np.full(len(k), self.n, np.int64)
        while (low < high).any():
            middle = (low + high) // 2
            ones = self.rank1(middle + 1)
            enough = (ones if bit else middle + 1 - ones) > k
            live = low < high
            high = np.where(live & enough, middle, high)
            low = np.where(live & ~enough, middle + 1, low)
        return low


class WaveletMatrix:
    """The ids of one shard."""

    def __init__(self, n: int, width: int, planes: list[BitPlane]):
        self.n, self.width, self.planes = n, width, planes

    @staticmethod
    def build(ids: np.ndarray) -> tuple[int, list[tuple[np.ndarray, np.ndarray]]]:
        """(width, packed planes) of unsigned ids."""
        width = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        ids = ids.astype(np.uint16 if width <= 16 else np.uint32)
        planes = []
        ones, other = np.empty(len(ids), bool), np.empty_like(ids)      # written anew by every level
        for level in range(width - 1, -1, -1):
            np.not_equal(ids & ids.dtype.type(1 << level), 0, out=ones)
            planes.append(BitPlane.pack(ones))
            if level:
                zeros = len(ids) - np.count_nonzero(ones)
                np.compress(ones, ids, out=other[zeros:])
                np.compress(np.logical_not(ones, out=ones), ids, out=other[:zeros])
                ids, other = other, ids
        return width, planes

    def access(self, i) -> np.ndarray:
        """The ids at positions i."""
        i = np.asarray(i, np.int64)
        out = np.zeros(len(i), np.int64)
        for plane in self.planes:
            bit, ones = plane.get(i), plane.rank1(i)
            i = np.where(bit == 1, plane.n - plane.ones + ones, i - ones)
            out = (out << 1) | bit
        return out

    def _range(self, value: int, start: int, stop: int) -> tuple[int, int]:
        low, high = start, stop
        if value < 0 or value >> self.width:
            return 0, 0
        for level, plane in zip(range(self.width - 1, -1, -1), self.planes):
            ones = plane.rank1(np.asarray([low, high], np.int64))
            if (value >> level) & 1:
                low, high = (int(x) + plane.n - plane.ones for x in ones)
            else:
                low, high = low - int(ones[0]), high - int(ones[1])
        return low, high

    def count(self, value: int, start: int = 0, stop: int | None = None) -> int:
        """Occurrences of an id in positions [start, stop)."""
        low, high = self._range(value, start, self.n if stop is None else stop)
        return high - low

    def find(self, value: int, first: int = 0, stop: int | None = None) -> np.ndarray:
        """Positions of the occurrences numbered first, ..., stop - 1."""
        low, high = self._range(value, 0, self.n)
        k = np.arange(low + first, high if stop is None else min(high, low + stop), dtype=np.int64)
        for level, plane in reversed(list(zip(range(self.width - 1, -1, -1), self.planes))):
            bit = (value >> level) & 1
            k = plane.select(bit, k - (plane.n - plane.ones) if bit else k)
        return k

    def decode(self) -> np.ndarray:
        """All ids: undo the stable partings from the last plane upwards."""
        ids = np.zeros(self.n, np.uint32 if self.width > 16 else np.uint16)
        for level, plane in zip(range(self.width), reversed(self.planes)):
            bits = np.unpackbits(plane.words.view(np.uint8), bitorder="little", count=self.n).view(bool)
            zeros = self.n - plane.ones
            back = np.empty_like(ids)           # positions are several times faster than masks here
            back[np.flatnonzero(~bits)] = ids[:zeros]
            back[np.flatnonzero(bits)] = ids[zeros:] | ids.dtype.type(1 << level)
            ids = back
        return ids


# ------------------------------------------------------------------ one file

def shard_bytes(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> Iterator[bytes]:
    width, planes = WaveletMatrix.build(ids)
    packer = zstandard.ZstdCompressor(level=1, write_checksum=True)
    known = np.asarray([d is not None for d in doc_ids], np.uint8)
    parts = [known, np.asarray([d or 0 for d in doc_ids], "<i8"), np.asarray(lengths, "<i8")]
    for words, samples in planes:
        parts += [words, samples.astype("<u2")]
    packed = [packer.compress(np.ascontiguousarray(p).tobytes()) for p in parts]
    header = json.dumps({"n": len(ids), "docs": len(doc_ids), "width": width,
                         "parts": [len(p) for p in packed]}).encode()
    yield MAGIC + struct.pack("<I", len(header)) + header
    yield from packed


class Shard:
    """A shard file: documents, their first positions, and the wavelet matrix."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("no wavelet shard")
        size = struct.unpack_from("<I", data, 4)[0]
        header = json.loads(data[8:8 + size])
        if len(data) != 8 + size + sum(header["parts"]):
            raise ValueError("the shard is cut short")
        unpacker, at, parts = zstandard.ZstdDecompressor(), 8 + size, []
        for length in header["parts"]:
            parts.append(unpacker.decompress(data[at:at + length]) if length else b"")
            at += length
        known, ids, self.lengths = (np.frombuffer(p, t) for p, t in zip(parts, (np.uint8, "<i8", "<i8")))
        self.doc_ids = [int(d) if k else None for k, d in zip(known, ids)]
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])
        planes = [BitPlane(np.frombuffer(parts[k], "<u8"), header["n"], np.frombuffer(parts[k + 1], "<u2"))
                  for k in range(3, len(parts), 2)]
        self.matrix = WaveletMatrix(header["n"], header["width"], planes)

    def document(self, row: int) -> np.ndarray:
        """The ids of one document, by access."""
        return self.matrix.access(np.arange(self.starts[row], self.starts[row + 1]))


# ------------------------------------------------------------------ the jobs

def write_shards(docs: DataFrame, tokenizer_path: str, end_id: int, folder: str,
                 shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Manifest (part, seq, path, n_docs, n_tokens, start) of the files written.
    A task that runs again writes new names; only the manifest's files count."""
    end = np.asarray([end_id], "<u4").tobytes()
    schema = "part long, seq long, path string, n_docs long, n_tokens long"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part = encoder(tokenizer_path), TaskContext.get().partitionId()
        doc_ids, lengths, held, size, seq = [], [], [], 0, 0

        def close():
            path = f"{folder}/{uuid.uuid4().hex}.wmx"
            write_file(path, shard_bytes(doc_ids, lengths, np.frombuffer(b"".join(held), "<u4")))
            return pa.RecordBatch.from_pydict({"part": [part], "seq": [seq], "path": [path],
                                               "n_docs": [len(doc_ids)], "n_tokens": [size]})

        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), coder.encode_batch(batch.column(1).to_pylist())):
                ids += end
                if held and size + len(ids) // 4 > shard_tokens:
                    yield close()
                    doc_ids, lengths, held, size, seq = [], [], [], 0, seq + 1
                doc_ids.append(doc_id)
                lengths.append(len(ids) // 4)
                held.append(ids)
                size += len(ids) // 4
        if held:
            yield close()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    tie = F.xxhash64("text")
    ordered = rows.withColumn("tie", tie).repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    manifest = stored(ordered.drop("tie").mapInArrow(write, schema), "wavelet-manifest")
    # positions: parts (as many as shuffle partitions) are summed in one row each, files within their part
    parts = manifest.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("part", F.coalesce(before, F.lit(0)).alias("part_start"))
    within = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq")
                                    .rowsBetween(Window.unboundedPreceding, -1))
    return manifest.withColumn("within", F.coalesce(within, F.lit(0))).join(parts, "part") \
        .select("part", "seq", "path", "n_docs", "n_tokens", (F.col("part_start") + F.col("within")).alias("start"))


def _over_shards(manifest: DataFrame, visit, schema: str) -> DataFrame:
    """``visit(shard, start of the shard)`` gives the columns of its result."""
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                columns = visit(Shard(read_file(path)), start)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    files = stored(manifest.select("path", "start"), "wavelet-files")
    return files.repartition(max(1, files.count())).mapInArrow(run, schema)


def read_documents(manifest: DataFrame) -> DataFrame:
    """Per document: doc_id, start, n_tokens, ids_crc32, decoded from the files."""

    def visit(shard: Shard, start: int):
        ids = shard.matrix.decode().astype("<u4")
        crcs = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(shard.starts[:-1], shard.starts[1:])]
        return shard.doc_ids, shard.starts[:-1] + start, shard.lengths, crcs

    return _over_shards(manifest, visit, "doc_id long, start long, n_tokens long, ids_crc32 long")


def count_token(manifest: DataFrame, value: int) -> DataFrame:
    """Occurrences of an id in every shard: start of the shard, n."""
    return _over_shards(manifest, lambda s, at: ([at], [s.matrix.count(value)]), "start long, n long")


def find_token(manifest: DataFrame, value: int) -> DataFrame:
    """Every occurrence of an id: doc_id, position in the corpus."""

    def visit(shard: Shard, start: int):
        at = shard.matrix.find(value)
        rows = np.searchsorted(shard.starts, at, side="right") - 1
        return [shard.doc_ids[r] for r in rows], at + start

    return _over_shards(manifest, visit, "doc_id long, position long")


def index_corpus(docs: DataFrame, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    """Write the shards below spark.checkpoint.dir and read every document back."""
    folder = new_work_dir(docs.sparkSession, "wavelet")
    return read_documents(write_shards(docs, tokenizer_path, end_id, folder))
