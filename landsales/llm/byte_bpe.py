"""Operator 13: byte-level BPE encoding and decoding by a ranks file.

Texts are cut into words the way the public split pattern does, without running a
regex. Every code point has a class (letter, number, white space, the letters of
English contractions, ...). Reading one character of a class is a function from
states to states; the functions that words of classes compose to are few, so each has
a number and composition is one look-up in a table. The characters of a block are dealt
to lanes: every lane composes its functions, the lanes' results are composed in order,
and each lane then follows its states from its own entry state. A place is a word start
by its state, its class and the class after it.

The slices between starts are merged: the adjacent pair of lowest rank first, leftmost
on ties. Slices seen before come from a cache; new short ones are merged together, one
pair of each a round, and new long ones with a heap. A text's ids come with the byte
offset of every token, from which any byte range is decoded.

Defined results: a null text is an empty one (no ids); rows with a null doc_id and
repeated rows are encoded each on its own; an empty table gives an empty result; texts
longer than ``BLOCK_CHARS`` are cut block by block at word starts, so the tables of one
block bound the memory besides the text itself. Only the key and the text column are
read: other columns, whatever their names, play no part.
"""

from __future__ import annotations

import base64
import heapq
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landsales.llm.common import read_file

BLOCK_CHARS = 1 << 17      # characters whose places are found at once
LANE_CHARS = 128           # characters of a lane
CACHE_SLICES = 300_000     # slices in the young half of a worker's cache
SHORT_BYTES = 24           # slices up to here are merged side by side

# Classes of code points
END, SPACE, WHITE, LETTER, SHORT, LONG, EL, E, NUMBER, OTHER, APOSTROPHE = range(11)
CLASSES = 11
_LETTERS = {LETTER, SHORT, LONG, EL, E}
_WHITES = {SPACE, WHITE}
_OTHERS = {OTHER, APOSTROPHE}
# States: what stands before a character. BEGIN: a word ended for certain
BEGIN, AFTER_SPACE, AFTER_WHITE, IN_LETTERS, IN_NUMBERS, IN_OTHERS, QUOTE, QUOTE_LONG, QUOTE_L = range(9)
STATES = 9

# White space of Unicode besides the category of separators
WHITE_SPACE = [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x85]
# Letters and numbers that Unicode 16 added, first and last of each range
ADDED_LETTERS = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65),
    (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E),
    (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0),
    (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED),
    (0x1E5F0, 0x1E5F0),
]
ADDED_NUMBERS = [(0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139),
                 (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)]


@lru_cache(maxsize=1)
def code_classes() -> np.ndarray:
    """The class of every code point."""
    of_category = {"L": LETTER, "N": NUMBER, "Z": WHITE}
    table = np.fromiter((of_category.get(unicodedata.category(chr(c))[0], OTHER) for c in range(sys.maxunicode + 1)),
                        np.uint8, sys.maxunicode + 1)
    for kind, ranges in ((LETTER, ADDED_LETTERS), (NUMBER, ADDED_NUMBERS)):
        for first, last in ranges:
            table[first:last + 1] = kind
    table[WHITE_SPACE] = WHITE
    for kind, characters in ((SPACE, " "), (APOSTROPHE, "'"), (SHORT, "stmd"), (LONG, "rv"), (EL, "l"), (E, "e")):
        table[[ord(c) for c in characters]] = kind
    return table


def _follow(state: int, kind: int) -> int:
    """The state after a character of class ``kind``."""
    if kind == END:
        return BEGIN
    if kind in _WHITES:
        return AFTER_SPACE if kind == SPACE else AFTER_WHITE
    if kind == NUMBER:
        return IN_NUMBERS
    if kind in _OTHERS:       # an apostrophe that starts a word may start a contraction
        return IN_OTHERS if kind == OTHER or state in (IN_OTHERS, QUOTE, AFTER_SPACE) else QUOTE
    if (state, kind) in ((QUOTE, SHORT), (QUOTE_LONG, E), (QUOTE_L, EL)):
        return BEGIN          # 's 't 'm 'd, 're 've, 'll
    return {(QUOTE, LONG): QUOTE_LONG, (QUOTE, EL): QUOTE_L}.get((state, kind), IN_LETTERS)


def _starts(state: int, kind: int, after: int) -> bool:
    """Whether a character of class ``kind`` starts a word, ``after`` being the next class."""
    if state == BEGIN or kind == END:
        return True
    if kind in _WHITES:       # of a run before a word, the last character is no longer the run's
        return state not in (AFTER_SPACE, AFTER_WHITE) or not (after in _WHITES or after == END)
    if state == AFTER_SPACE:
        return False
    if kind == NUMBER:
        return state != IN_NUMBERS
    if kind in _OTHERS:
        return state not in (IN_OTHERS, QUOTE)
    if state == QUOTE:
        return not (kind == SHORT or (kind, after) in ((LONG, E), (EL, EL)))
    return state not in (IN_LETTERS, QUOTE_LONG, QUOTE_L)


class Scanner:
    """Tables of the automaton: next state, word start, and the composition of its functions."""

    def __init__(self):
        self.follow = np.array([[_follow(s, c) for c in range(CLASSES)] for s in range(STATES)], np.uint16)
        self.starts = np.array([_starts(*x) for x in product(range(STATES), range(CLASSES), range(CLASSES))])
        single = [tuple(int(x) for x in self.follow[:, c]) for c in range(CLASSES)]
        number = {tuple(range(STATES)): 0}            # function -> its number; 0 changes nothing
        found = [tuple(range(STATES))]
        for f in found:                               # grows while it is read: all compositions
            for g in single:
                if (h := tuple(g[s] for s in f)) not in number:
                    number[h] = len(found)
                    found.append(h)
        self.size = len(found)
        self.of_class = np.array([number[f] for f in single], np.uint16)
        self.functions = np.array(found, np.uint16)
        self.compose = np.array([[number[tuple(g[s] for s in f)] for g in found] for f in found], np.uint16).ravel()
        self.follow = self.follow.ravel()

    def word_starts(self, kinds: np.ndarray) -> np.ndarray:
        """True at every word start of a block of classes that begins at a word start."""
        n = len(kinds)
        lanes = -(-n // LANE_CHARS)
        padded = np.zeros(lanes * LANE_CHARS, np.uint8)           # END beyond the block
        padded[:n] = kinds
        columns = np.ascontiguousarray(padded.reshape(lanes, LANE_CHARS).T)
        whole = np.zeros(lanes, np.int32)
        for column in self.of_class[columns]:                     # each lane's own function
            whole = self.compose.take(whole * self.size + column)
            whole = whole.astype(np.int32)
        entry, state = np.empty(lanes, np.int32), BEGIN           # lanes' functions composed in order
        functions = self.functions
        for k, f in enumerate(whole.tolist()):
            entry[k] = state
            state = int(functions[f, state])
        states = np.empty((LANE_CHARS, lanes), np.int32)
        for k in range(LANE_CHARS):
            states[k] = entry
            entry = self.follow.take(entry * CLASSES + columns[k]).astype(np.int32)
        before = states.T.ravel()[:n]
        after = np.zeros(n, np.uint8)
        after[:-1] = kinds[1:]
        return self.starts.take((before * CLASSES + kinds) * CLASSES + after)


@lru_cache(maxsize=1)
def scanner() -> Scanner:
    return Scanner()


def _cut(text: str, ends: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Character places of the word starts of a text, and the byte place of each (with the
    text's length at its end). At the places in ``ends`` a text of a batch ends."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    kinds = code_classes().take(codes)
    if ends is not None:
        kinds[ends] = END
    places = np.flatnonzero(scanner().word_starts(kinds))
    if text.isascii():
        return places, np.append(places, len(codes))
    bytes_before = np.zeros(len(codes) + 1, np.int64)
    np.cumsum(1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF).astype(np.int64), out=bytes_before[1:])
    return places, np.append(bytes_before[places], bytes_before[-1])


def _slices(raw: bytes, places: list[int]) -> list[bytes]:
    return [raw[x:y] for x, y in zip(places, places[1:])]


def split_blocks(texts: list[str]) -> Iterator[list[list[bytes]]]:
    """The words of each text, in UTF-8, for about BLOCK_CHARS of texts at a time. Joined, the
    words are the text."""
    held: list[str] = []
    size = 0
    for text in texts:
        if held and size + len(text) > BLOCK_CHARS:
            yield _split_joined(held)
            held, size = [], 0
        if len(text) > BLOCK_CHARS:
            yield [_split_long(text)]
        else:
            held.append(text)
            size += len(text) + 1
    if held:
        yield _split_joined(held)


def split_batch(texts: list[str]) -> list[list[bytes]]:
    return [words for block in split_blocks(texts) for words in block]


def _split_joined(texts: list[str]) -> list[list[bytes]]:
    joined = "\0".join(texts) + "\0"
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    places, cuts = _cut(joined, ends)
    words = _slices(joined.encode(), cuts.tolist())
    marks = np.searchsorted(places, ends).tolist()       # the word that is a text's end mark
    return [words[x:y] for x, y in zip([0, *(m + 1 for m in marks)], marks)]


def _split_long(text: str) -> list[bytes]:
    """Block by block. The last word of a block and what hangs on the characters after it are
    left to the next one; a word longer than a block widens it."""
    words: list[bytes] = []
    at, size = 0, BLOCK_CHARS
    while at < len(text):
        block = text[at:at + size]
        places, cuts = _cut(block)
        if at + size < len(text):
            sure = int(np.searchsorted(places, len(block) - 3, "right")) - 1
            if sure <= 0:
                size *= 2
                continue
            places, cuts = places[:sure + 1], cuts[:sure + 1]
            at += int(places[sure])
        else:
            at = len(text)
        words += _slices(block.encode(), cuts.tolist())
        size = BLOCK_CHARS
    return words


_NONE = np.int32(2**31 - 1)


class Merger:
    """Merges words pair by pair: lowest rank first, leftmost on ties, where a pair's rank is
    the id that it becomes. ``single`` and ``last`` are the ids of a word's bytes and of its
    last byte, ``pairs`` the rank of each pair of ids (a << 32 | b)."""

    def __init__(self, single: np.ndarray, last: np.ndarray, pairs: dict[int, int]):
        self.single, self.last, self.pairs = single, last, pairs
        keys = np.fromiter(pairs, np.int64, len(pairs))
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.int64(2**63 - 1))
        self.values = np.append(np.fromiter(pairs.values(), np.int32, len(keys))[order], _NONE)
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

        self.plain = np.array_equal(single, last)         # a pair of bytes has one rank wherever it stands
        self.byte_pairs = self._rank(np.repeat(single, 256), np.tile(single, 256)).reshape(256, 256)

    def _whole(self, words: set[bytes]) -> dict[bytes, int]:
        """Ids of the words that need no merging."""
        return {}

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair; a negative id has none."""
        key = a.astype(np.int64) << 32 | b
        key[(a < 0) | (b < 0)] = -1
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.values[at], _NONE)

    def _merge_side_by_side(self, words: list[bytes]) -> None:
        """Words of one length class: one merge of each word a round, until none has a pair."""
        counts = np.fromiter(map(len, words), np.int64, len(words))
        width = int(counts.max())
        padded = np.array(words, f"S{width}").view(np.uint8).reshape(len(words), width)
        ids = np.full((len(words), width + 1), -1, np.int32)
        ids[:, :width] = self.single[padded]
        ids[np.arange(width + 1) >= counts[:, None]] = -1
        ends = np.arange(len(words)), counts - 1
        ids[ends] = self.last[padded[ends]]
        if self.plain:
            rank = np.full((len(words), width), _NONE, np.int32)
            rank[:, :-1] = self.byte_pairs[padded[:, :-1], padded[:, 1:]]
            rank[np.arange(1, width + 1) >= counts[:, None]] = _NONE
        else:
            rank = self._rank(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(words), width)
        left = np.arange(len(words))                      # rows that still merge
        done = ids.copy()
        while True:
            at = rank.argmin(axis=1)
            rows = np.arange(len(at))
            best = rank[rows, at]
            ended = best == _NONE
            if ended.any():
                done[left[ended], :ids.shape[1]] = ids[ended]
                done[left[ended], ids.shape[1]:] = -1
                going = ~ended
                left, ids, rank, at, best = left[going], ids[going], rank[going], at[going], best[going]
                rows = np.arange(len(at))
            if not len(left):
                break
            ids[rows, at] = best                          # the pair's first place; its second one goes
            places = np.arange(ids.shape[1] - 1)
            ids = np.take_along_axis(ids, places + (places > at[:, None]), axis=1)
            places = places[:-1]
            rank = np.take_along_axis(rank, places + (places > at[:, None]), axis=1) if len(places) else \
                np.full((len(rows), 1), _NONE, np.int32)
            if not len(places):
                continue
            inner = at < len(places)
            rank[rows[inner], at[inner]] = self._rank(ids[rows[inner], at[inner]], ids[rows[inner], at[inner] + 1])
            inner = at > 0
            rank[rows[inner], at[inner] - 1] = self._rank(ids[rows[inner], at[inner] - 1], ids[rows[inner], at[inner]])
        raw = done[done >= 0].astype("<u4").tobytes()
        ends = np.cumsum((done >= 0).sum(axis=1) * 4).tolist()
        self.young.update(zip(words, _slices(raw, [0, *ends])))

    def _merge_long(self, word: bytes) -> bytes:
        """One word with a heap of its pairs; linked places, each merge adds two pairs at most."""
        ids = [*self.single[list(word[:-1])].tolist(), int(self.last[word[-1]])]
        after = [*range(1, len(ids)), -1]
        before = [*range(-1, len(ids) - 1)]
        pairs = self.pairs
        heap = [(r, k) for k in range(len(ids) - 1) if (r := pairs.get(ids[k] << 32 | ids[k + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, k = heapq.heappop(heap)
            n = after[k]
            if ids[k] < 0 or n < 0 or pairs.get(ids[k] << 32 | ids[n]) != r:
                continue                                  # a place that has changed since
            ids[k], ids[n] = r, -1
            after[k] = after[n]
            if after[k] >= 0:
                before[after[k]] = k
                if (x := pairs.get(r << 32 | ids[after[k]])) is not None:
                    heapq.heappush(heap, (x, k))
            if before[k] >= 0 and (x := pairs.get(ids[before[k]] << 32 | r)) is not None:
                heapq.heappush(heap, (x, before[k]))
        return np.array([x for x in ids if x >= 0], "<u4").tobytes()

    def _learn(self, words: set[bytes]) -> None:
        again = words & self.old.keys()
        self.young.update(zip(again, map(self.old.__getitem__, again)))
        words = words - again
        whole = self._whole(words)
        self.young.update((w, n.to_bytes(4, "little")) for w, n in whole.items())
        new = sorted(words - whole.keys(), key=len)
        while new and len(new[-1]) > SHORT_BYTES:
            word = new.pop()
            self.young[word] = self._merge_long(word)
        while new:                                        # words of about the same length
            group = [w for w in new[:4096] if len(w) <= max(8, 2 * len(new[0]))]
            self._merge_side_by_side(group)
            new = new[len(group):]

    def encode_batch(self, texts: list[list[bytes]]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text's words, each word merged on its own.
        The words that the batch has new are merged together."""
        if len(self.young) > CACHE_SLICES:
            self.old, self.young = self.young, {}
        young = self.young
        if new := set().union(*texts).difference(young):
            self._learn(new)
        return [b"".join(map(young.__getitem__, words)) for words in texts]

    def encode_texts(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        return self.encode_batch(split_batch(texts))


class Vocabulary(Merger):
    """Byte strings by rank; any two tokens merge whose concatenation has a rank."""

    def __init__(self, path: str):
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, read_file(path).splitlines())}
        self.ranks = ranks
        pairs = {}
        for word, rank in ranks.items():
            for k in range(1, len(word)):
                a, b = ranks.get(word[:k]), ranks.get(word[k:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = rank
        single = np.array([ranks[bytes([n])] for n in range(256)], np.int32)
        super().__init__(single, single, pairs)
        size = max(ranks.values()) + 1                    # token bytes one after the other, by rank
        lengths = np.zeros(size + 1, np.int64)
        by_rank = sorted(ranks.items(), key=lambda x: x[1])
        for word, rank in by_rank:
            lengths[rank + 1] = len(word)
        self.places = np.cumsum(lengths)
        self.blob = np.frombuffer(b"".join(word for word, _ in by_rank), np.uint8)

    def _whole(self, words: set[bytes]) -> dict[bytes, int]:
        known = words & self.ranks.keys()
        return dict(zip(known, map(self.ranks.__getitem__, known)))

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        """Byte place of every token in its text, and the text's length in bytes."""
        made = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(self.places[ids.astype(np.int64) + 1] - self.places[ids], out=made[1:])
        return made

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> bytes:
        """The bytes of the tokens, each copied to its offset."""
        ids, offsets = ids.astype(np.int64), offsets.astype(np.int64)
        lengths = np.diff(offsets)
        if len(ids) != len(lengths) or (ids >= len(self.places) - 1).any() or \
                (self.places[ids + 1] - self.places[ids] != lengths).any():
            raise ValueError("token offsets don't belong to these ids")
        source = np.repeat(self.places[ids] - offsets[:-1], lengths) + np.arange(offsets[0], offsets[-1])
        return self.blob.take(source).tobytes()

    def decode_range(self, ids: np.ndarray, offsets: np.ndarray, start: int, stop: int) -> bytes:
        """The text's bytes from ``start`` up to ``stop``: only the tokens there are decoded."""
        start, stop = max(0, start), min(int(offsets[-1]), stop)
        if start >= stop:
            return b""
        first = int(np.searchsorted(offsets, start, "right")) - 1
        last = int(np.searchsorted(offsets, stop, "left"))
        raw = self.decode(ids[first:last], offsets[first:last + 1])
        return raw[start - int(offsets[first]):stop - int(offsets[first])]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """One vocabulary and cache per Python worker and file."""
    return Vocabulary(path)


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, n_tokens, ids (little-endian unsigned 32-bit) and token_offsets (n_tokens + 1 byte
    places, the same format) of every row. ``path`` names the ranks file, readable by all executors."""
    rows = docs.select(F.col(key), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))

    def run(batches):
        words = vocabulary(path)
        for batch in batches:
            made = words.encode_texts(batch.column(1).to_pylist())
            places = [words.offsets(np.frombuffer(ids, "<u4")).astype("<u4").tobytes() for ids in made]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(x) // 4 for x in made], pa.int64()),
                 pa.array(made, pa.binary()), pa.array(places, pa.binary())],
                [key, "n_tokens", "ids", "token_offsets"])

    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"`{key}` {kind}, n_tokens long, ids binary, token_offsets binary")


def decode(encoded: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """``encoded`` (see ``encode``) with decoded: the bytes of the whole text."""
    def run(batches):
        words = vocabulary(path)
        for batch in batches:
            made = [words.decode(np.frombuffer(a, "<u4"), np.frombuffer(b, "<u4"))
                    for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.binary())],
                                             [*batch.schema.names, "decoded"])

    kind = encoded.schema[key].dataType.simpleString()
    return encoded.select(key, "n_tokens", "ids", "token_offsets").mapInArrow(
        run, f"`{key}` {kind}, n_tokens long, ids binary, token_offsets binary, decoded binary")


def digests(docs: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """Key, n_tokens, and SHA-256 of the ids and of the decoded bytes."""
    return decode(encode(docs, path, key), path, key).select(
        key, "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
