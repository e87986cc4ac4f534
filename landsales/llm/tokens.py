"""Exact token ids of whole texts, as the tokenizers library gives them, in batches.

A byte vocabulary's texts are cut into words by the class tables of ``byte_bpe``; a
vocabulary with word ends lower-cases and drops white space, so its texts are cut there
and a piece of Latin letters is one word. Distinct words that no earlier batch had are
merged together (``byte_bpe.Merger`` with the vocabulary's own merges) or, for the
vocabulary with word ends, one by one by the library's model; other pieces (marks,
digits, other scripts) go to the library in one call. The ids are the words' ids in
order. Texts with the strings of special tokens, or, for a vocabulary that lower-cases,
with control characters U+001C-U+001F (white space to Python only) or not in NFC before
and after lower-casing, are encoded whole by the library.
"""

from __future__ import annotations

import json
import os
import struct
import unicodedata
from functools import lru_cache

import numpy as np

from landsales.llm.byte_bpe import Merger
from landsales.llm.common import read_file

CACHE_UNITS = 400_000     # pieces in the young half of a worker's cache; pieces not met again leave with the old half
_PUNCTUATION = frozenset(".,;:!?")
_CONTROL = "\x1c\x1d\x1e\x1f"
_LAST_LETTER = "\u024f"    # letters up to here are in NFC, and letters to every Unicode version
_PACK = [struct.Struct(f"<{n}I").pack for n in range(64)]


def merger(path: str) -> Merger:
    """The merges of a byte vocabulary's file. Their ids rise with their order, so ids serve as ranks."""
    from tokenizers.pre_tokenizers import ByteLevel
    model = json.loads(read_file(path))["model"]
    vocab = model["vocab"]
    spelled = [""] * 256                        # the letters that stand for bytes; bytes that UTF-8 lacks have none
    for code in [*range(0x900), *range(0x1000, 0xD000, 0x1000), *range(0xE000, 0x110000, 0x1000)]:
        letters = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(chr(code))[0][0]
        for byte, letter in zip(chr(code).encode(), letters):
            spelled[byte] = letter
    single = np.array([vocab.get(c, -1) for c in spelled], np.int32)
    pairs, before = {}, -1
    for merge in model["merges"]:
        a, b = merge.split(" ") if isinstance(merge, str) else merge
        made = vocab[a + b]
        if made <= before:
            raise ValueError(f"{path}: ids of merges don't rise with their order")
        before = made
        pairs.setdefault(vocab[a] << 32 | vocab[b], made)
    return Merger(single, single, pairs)


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids."""

    def __init__(self, path: str):
        # a task has one core: the library's own threads would only wait for work beside it
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel
        self.tokenizer = Tokenizer.from_file(path)
        special = {t.content: n for n, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.special = tuple(special)
        self.mark, self.mark_id = next(iter(special.items()), (None, None))
        # a vocabulary with word ends drops white space: its pieces are bare words. It lower-cases, letter by letter
        self.folds = bool(getattr(self.tokenizer.model, "end_of_word_suffix", None))
        if self.folds:
            spelled = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
            self.letters = {n: spelled(chr(n))[0][0] for n in range(0x80, ord(_LAST_LETTER) + 1)}
            self.model = self.tokenizer.model
        else:
            self.merger = merger(path)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        return self.encode_batch([text])[0]

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        made = [self.whole(t) if self._odd(t) else None for t in texts]
        rest = [t for t, ids in zip(texts, made) if ids is None]
        found = iter(map(self._folded, rest) if self.folds else self.merger.encode_texts(rest))
        return [next(found) if ids is None else ids for ids in made]

    def _odd(self, text: str) -> bool:
        """Whether a text must be encoded whole."""
        if _any_in(self.special, text):
            return True
        if not self.folds:
            return False
        low = text.lower()
        return _any_in(_CONTROL, text) or _any_in(self.special, low) or \
            not text.isascii() and not (unicodedata.is_normalized("NFC", text) and unicodedata.is_normalized("NFC", low))

    # ---- vocabulary with word ends ----------------------------------------

    def _folded(self, text: str) -> bytes:
        if len(self.young) > CACHE_UNITS:
            self.old, self.young = self.young, {}
        lowered = "Σ" not in text
        pieces = (text.lower() if lowered else text).split()
        made = list(map(self.young.get, pieces))
        if None in made:
            self._resolve({piece for piece, ids in zip(pieces, made) if ids is None}, lowered)
            made = map(self.young.__getitem__, pieces)
        return b"".join(made)

    def _learn(self, pieces: set[str]) -> None:
        """New pieces: words of Latin letters by the model, all others in one call of the
        library, where a special token between them parts them exactly."""
        others, young, tokenize = [], self.young, self.model.tokenize
        for piece in pieces:
            if piece.isalpha() and ((plain := piece.isascii()) or max(piece) <= _LAST_LETTER):
                ids = [t.id for t in tokenize(piece if plain else piece.translate(self.letters))]
                young[piece] = _PACK[len(ids)](*ids) if len(ids) < len(_PACK) else struct.pack(f"<{len(ids)}I", *ids)
            else:
                others.append(piece)
        if not others:
            return
        if self.mark is None:
            made = [self.whole(p) for p in others]
        else:
            joined = self.tokenizer.encode_batch_fast([self.mark.join(others)], add_special_tokens=False)[0]
            ids = np.asarray(joined.ids, "<u4")
            packed, cuts = ids.tobytes(), (np.flatnonzero(ids == self.mark_id) * 4).tolist()
            made = [packed[x:y] for x, y in zip([0, *(c + 4 for c in cuts)], [*cuts, len(packed)])]
        young.update(zip(others, made, strict=True))

    def _resolve(self, pieces: set[str], lowered: bool) -> None:
        """Puts new pieces into the cache. A word and one mark after it are encoded apart, so both
        are shared by more pieces."""
        young, old, plan, new = self.young, self.old, [], set()
        for piece in pieces:
            known = old.get(piece)
            if known is not None:
                young[piece] = known
                continue
            low = piece if lowered or "Σ" in piece else piece.lower()
            if low[-1] in _PUNCTUATION and (word := low[:-1]).isalpha():
                parts = (word, low[-1])
            elif low == piece:
                new.add(piece)
                continue
            else:
                parts = (low,)
            plan.append((piece, parts))
            for part in parts:
                if part not in young:
                    if part in old:
                        young[part] = old[part]
                    else:
                        new.add(part)
        if new:
            self._learn(new)
        for piece, parts in plan:
            young[piece] = young[parts[0]] if len(parts) == 1 else young[parts[0]] + young[parts[1]]


def _any_in(marks, text: str) -> bool:
    """Faster than a pattern of them: each is looked for by its first character."""
    for mark in marks:
        if mark in text:
            return True
    return False


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per Python worker and vocabulary."""
    return Encoder(path)
