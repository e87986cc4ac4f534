"""Vectorised text kernels used inside Arrow batches.

Texts stay in the batch's UTF-8 buffer. A word is a maximal run of word bytes;
its 64-bit hash is a polynomial over the bytes taken from prefix sums modulo
2^64, then mixed. Two different words share a hash with chance about 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
PIECE = 1 << 18          # bytes hashed at a time: temporary arrays stay in the cache
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads every input bit over the word."""
    with np.errstate(over="ignore"):
        x = np.asarray(x, U) + U(0x9E3779B97F4A7C15)
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


_bytes = np.arange(256)
SPACE = (_bytes == 0x20) | ((_bytes >= 0x09) & (_bytes <= 0x0D))
#: words [^\x20\x09-\x0D]+
NON_SPACE = ~SPACE
#: words of ASCII letters and digits and of all non-ASCII characters
ALNUM = ((_bytes >= 0x30) & (_bytes <= 0x39)) | ((_bytes >= 0x41) & (_bytes <= 0x5A)) \
    | ((_bytes >= 0x61) & (_bytes <= 0x7A)) | (_bytes >= 0x80)
_lowered = np.where((_bytes >= 0x41) & (_bytes <= 0x5A), _bytes + 32, _bytes)
#: a random 64-bit value per byte, A-Z valued as a-z
LETTER = mix(_lowered.astype(U) + U(1 << 32))

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(12, int(n).bit_length())
    if size not in _powers:
        with np.errstate(over="ignore"):
            made = []
            for base in (BASE, INVERSE):
                steps = np.full(size, base, U)
                steps[0] = 1
                made.append(np.cumprod(steps, dtype=U))
        if size > 4 * PIECE:      # one huge word: do not keep its table
            return tuple(made)
        _powers[size] = tuple(made)
    return _powers[size]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null counts as empty."""
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type)
                                  or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each, or of one longer row."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        to = min(max(to, at + 1), n)
        yield at, to
        at = to


def words(data: np.ndarray, offsets: np.ndarray, alphabet: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, first word of each row and the total) over all rows."""
    hashes, starts_of = [], []
    n, a = len(data), 0
    breaks = np.zeros(n + 1, bool)
    breaks[offsets] = True
    while a < n:
        b = min(a + PIECE, n)
        if b < n:
            inside = np.flatnonzero(~alphabet[data[a:b]] | breaks[a:b])
            if inside.size and inside[-1] > 0:
                b = a + int(inside[-1])
            else:                                   # one word longer than a piece
                while b < n and alphabet[data[b]] and not breaks[b]:
                    step = np.flatnonzero(~alphabet[data[b:b + PIECE]] | breaks[b:min(b + PIECE, n)])
                    b = b + int(step[0]) if step.size else min(b + PIECE, n)
                    if step.size:
                        break
        part = data[a:b]
        inside = alphabet[part]
        before = np.empty(len(part), bool)
        before[0] = False
        before[1:] = inside[:-1] & ~breaks[a + 1:b]
        starts = np.flatnonzero(inside & ~before)
        follows = np.empty(len(part), bool)
        follows[-1] = False
        follows[:-1] = before[1:] & inside[1:]
        ends = np.flatnonzero(inside & ~follows) + 1
        power, inverse = _power_table(len(part))
        with np.errstate(over="ignore"):
            sums = np.zeros(len(part) + 1, U)
            np.cumsum(LETTER[part] * power[:len(part)], dtype=U, out=sums[1:])
            hashes.append(mix((sums[ends] - sums[starts]) * inverse[starts]))
        starts_of.append(starts + a)
        a = b
    if not hashes:
        return np.zeros(0, U), np.zeros(len(offsets), np.int64)
    starts = np.concatenate(starts_of)
    return np.concatenate(hashes), np.searchsorted(starts, offsets)


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position; the last n-1 positions have none."""
    count = max(0, len(hashes) - n + 1)
    out = np.zeros(count, U)
    with np.errstate(over="ignore"):
        for k in range(n):
            out = mix(out * U(BASE) + hashes[k:k + count])
    return out
