"""Operator 10: personal data replaced by keyed, type-consistent surrogates.

Detected: e-mail addresses, IPv4 addresses, phone numbers, card and account
numbers, IBANs, social-security numbers, secrets (hex strings, access keys,
``token = ...``), and names after a title (Mr, Mrs, Herr, Frau, M., Mme, Sr, Sra
and more). An entity's surrogate is drawn from a keyed hash of its type and
normal form, so the same entity gets the same surrogate in every document
(coreference), in any spelling that normalises alike; digits stay digits,
letters keep case and script, separators, lengths and check digits stay valid,
and given names keep the title's gender.

Distinctness: all distinct entities of the corpus are grouped by surrogate. Where
two share one, or a surrogate equals a real entity, all but one draw again with
the next attempt number, until none is left. From attempt ``GROW`` on surrogates
grow by a character an attempt (IPv4 octets first leave their number of digits),
so that they never run out. Only entities that drew more than
once reach the rewriting pass, as corrections joined to their documents.

Defined results: a null text stays null and has no entity; an empty text stays
empty; rows with a null doc_id are rewritten like all others (corrections are joined
by the text's hash where there is no id); repeated rows are rewritten alike; an empty
table gives an empty table; a column of the documents that is called n_entities is
replaced by the count, all others stay as they are.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landsales.llm.common import extended, stored, unused

KEY = b"surrogate-key"        # a parameter: pass the corpus's own secret key
GROW = 8                      # attempts at the entity's own length

# Titles and the gender they tell (fixed values).
TITLES = {"mr": "m", "mister": "m", "sir": "m", "herr": "m", "monsieur": "m", "sr": "m", "señor": "m", "don": "m",
          "mrs": "f", "ms": "f", "miss": "f", "madam": "f", "frau": "f", "mme": "f", "madame": "f",
          "mademoiselle": "f", "mlle": "f", "sra": "f", "señora": "f", "srta": "f", "señorita": "f", "doña": "f",
          "dr": "n", "prof": "n", "г-н": "m", "г-жа": "f"}

_SEP = r"[ .\-]?"
PATTERNS: tuple[tuple[str, re.Pattern], ...] = (
    ("email", re.compile(r"(?<![\w.+%-])[\w.+%-]+@[\w-]+(?:\.[\w-]+)*\.[^\W\d_]{2,}")),
    ("secret", re.compile(r"(?i)(?:\b(?:token|secret|password|passwd|api[_-]?key|access[_-]?key)\b\s*[=:]\s*[\"']?)"
                          r"([^\s\"',;]{8,})")),
    ("secret", re.compile(r"\b(?=[0-9a-fA-F]*\d)(?=[0-9a-fA-F]*[a-fA-F])[0-9a-fA-F]{32,}\b|\bAKIA[0-9A-Z]{16}\b"
                          r"|\bgh[pousr]_[0-9A-Za-z]{36}\b")),
    ("iban", re.compile(r"\b[A-Z]{2}\d{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?\b")),
    ("ip", re.compile(r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\d|\.\d)")),
    ("phone", re.compile(r"(?<![\w+])\+\d{1,3}" + _SEP + r"(?:\(\d{1,4}\)|\d{1,4})(?:" + _SEP + r"\d{2,4}){2,4}(?!\d)")),
    ("phone", re.compile(r"(?<![\w(])(?:\(\d{3}\) ?|\d{3}[.\-])\d{3}[.\- ]\d{4}(?!\d)")),
    ("card", re.compile(r"(?<![\d.])(?:\d{13,19}|\d{4}(?:[ \-]\d{4}){2}[ \-]\d{1,7}|\d{4}[ \-]\d{6}[ \-]\d{5})(?![\d])")),
    ("ssn", re.compile(r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])")),
)
_title = "|".join(sorted(map(re.escape, TITLES), key=len, reverse=True))
# a title in capitals at its start, an optional dot, then one to three capitalised words
NAMES = re.compile(rf"\b((?i:{_title}|M(?=\.)))\.? ((?:[A-ZÀ-ÖØ-ÞА-ЯЁ][^\W\d_A-ZА-Я]+(?:[-'’][^\W\d_]+)?)"
                   r"(?: [A-ZÀ-ÖØ-ÞА-ЯЁ][^\W\d_A-ZА-Я]+(?:[-'’][^\W\d_]+)?){0,2})")
_KEYWORDS = ("token", "secret", "passw", "api", "access")
#: a case-folded text without any of these has no name to replace; substring tests are far faster than the pattern
_TITLE_HINTS = tuple(title + end for title in (*TITLES, "m") for end in ((" ", ". ") if title != "m" else (". ",)))
_KEY_HINTS = ("AKIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_")
_DIGIT = re.compile(r"\d")


@dataclass(frozen=True)
class Entity:
    kind: str       # email, ..., given_m, given_f, given_n, surname
    start: int
    end: int
    text: str

    @property
    def form(self) -> str:
        """What coreferent mentions share."""
        if self.kind in ("phone", "card", "ssn", "iban"):
            plain = "".join(c for c in self.text if c.isalnum())
            return plain
        return self.text.lower() if self.kind in ("email", "surname") or self.kind.startswith("given") else self.text


def find_entities(text: str | None) -> list[Entity]:
    """Entities of a text, left to right, without overlaps (earlier patterns win)."""
    if not text:
        return []
    found: list[Entity] = []
    taken: list[tuple[int, int]] = []

    def add(kind: str, start: int, end: int):
        if start < end and all(end <= a or b <= start for a, b in taken):
            taken.append((start, end))
            found.append(Entity(kind, start, end, text[start:end]))

    at_sign = "@" in text
    numeric = _DIGIT.search(text) is not None
    folded = text.casefold().replace("i\u0307", "i")     # as the patterns ignore case
    secrets = ("=" in text or ":" in text) and any(word in folded for word in _KEYWORDS)
    keys = numeric or any(hint in text for hint in _KEY_HINTS)
    if at_sign or keys or secrets:
        for kind, pattern in PATTERNS:
            wanted = at_sign if kind == "email" else numeric if kind != "secret" else secrets if pattern.groups else keys
            if not wanted:
                continue
            group = pattern.groups
            for m in (_emails(text) if kind == "email" else pattern.finditer(text)):
                add(kind, m.start(group), m.end(group))
    if _titled(text, folded):
        for m in NAMES.finditer(text):
            title = m.group(1)
            if not title[0].isupper():
                continue
            gender = TITLES.get(title.lower(), "m")
            parts = list(re.finditer(r"\S+", m.group(2)))
            for k, part in enumerate(parts):
                kind = "surname" if k == len(parts) - 1 else f"given_{gender}"
                add(kind, m.start(2) + part.start(), m.start(2) + part.end())
    return sorted(found, key=lambda e: e.start)


def _titled(text: str, folded: str) -> bool:
    """Can a title stand in the text? It starts a word, with a capital."""
    aligned = len(folded) == len(text) and "\u0307" not in text
    for hint in _TITLE_HINTS:
        at = folded.find(hint)
        while at >= 0:
            if not aligned or (text[at].isupper() and not (at and (text[at - 1].isalnum() or text[at - 1] == "_"))):
                return True
            at = folded.find(hint, at + 1)
    return False


def _emails(text: str) -> Iterator[re.Match]:
    """Addresses around each @: the pattern is tried only near one."""
    pattern, done = PATTERNS[0][1], 0
    at = text.find("@")
    while at >= 0:
        begin = at
        while begin > done and (text[begin - 1].isalnum() or text[begin - 1] in "._+%-"):
            begin -= 1
        m = pattern.match(text, begin) if begin < at else None
        if m:
            yield m
            done = m.end()
        at = text.find("@", max(at + 1, done))


# ---------------------------------------------------------------- surrogates

class Stream:
    """Numbers drawn from HMAC-SHA256 of (kind, form, attempt)."""

    def __init__(self, key: bytes, kind: str, form: str, attempt: int):
        self.seed = hmac.new(key, f"{kind}\x00{form}\x00{attempt}".encode(), hashlib.sha256)
        self.counter, self.pool = 0, b""

    def below(self, n: int) -> int:
        """A number from 0 to n - 1, without bias."""
        limit = (1 << 16) - (1 << 16) % n
        while True:
            if len(self.pool) < 2:
                block = self.seed.copy()
                block.update(self.counter.to_bytes(4, "big"))
                self.pool, self.counter = block.digest(), self.counter + 1
            value, self.pool = int.from_bytes(self.pool[:2], "big"), self.pool[2:]
            if value < limit:
                return value % n


_LATIN, _CYRILLIC, _GREEK = "abcdefghijklmnopqrstuvwxyz", "абвгдежзийклмнопрстуфхцчшщыэюя", "αβγδεζηθικλμνξοπρστυφχψω"


def _alphabet(char: str) -> str:
    code = ord(char.lower()[0])
    if 0x400 <= code < 0x530:
        return _CYRILLIC
    if 0x370 <= code < 0x400:
        return _GREEK
    return _LATIN


_SIGNS = "!#$%&*+-./:=?@^_~"


@cache
def _script(word: str, page: int, upper: bool, lower: bool) -> str:
    """Letters of a script (the first word of their names) and case on one page of 256 characters."""
    return "".join(c for c in map(chr, range(page << 8, (page + 1) << 8))
                   if c.isalpha() and (c.isupper(), c.islower()) == (upper, lower) and _script_word(c) == word)


def _script_word(char: str) -> str:
    return re.split("[ -]", unicodedata.name(char, ""))[0]


def _like(char: str, draw: Stream) -> str:
    """A character of the same class, case and script."""
    if char.isdigit():
        return str(draw.below(10))
    if not char.isalpha():
        return char
    if not char.isascii() and _alphabet(char) is _LATIN and not "À" <= char <= "ɏ":
        if "一" <= char <= "鿿":
            return chr(0x4E00 + draw.below(0x5000))
        letters = _script(_script_word(char), ord(char) >> 8, char.isupper(), char.islower())
        if len(letters) > 1:
            return letters[draw.below(len(letters))]
    letters = _alphabet(char)
    made = letters[draw.below(len(letters))]
    return made.upper() if char.isupper() else made


def luhn_digit(digits: str) -> int:
    """The check digit that makes ``digits`` + it valid."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (2 if k % 2 == 0 else 1)
        total += n - 9 if n > 9 else n
    return -total % 10


def iban_check(country: str, rest: str) -> str:
    """The two check digits by ISO 7064 mod 97-10."""
    number = "".join(str(int(c, 36)) for c in rest + country + "00")
    return f"{98 - int(number) % 97:02d}"


def _name(form: str, kind: str, draw: Stream, grown: int = 0) -> str:
    """A pronounceable name in lower case, of the form's script and about its length;
    given names end by gender."""
    letters = _alphabet(form[0])
    vowels, consonants = {_LATIN: ("aeiou", "bcdfghklmnprstvz"), _CYRILLIC: ("аеиоу", "бвгдзклмнпрстфх"),
                          _GREEK: ("αειου", "βγδζθκλμνπρστφχ")}[letters]
    size = max(5, len(form)) + grown
    made = "".join((consonants if k % 2 == 0 else vowels)[draw.below(len(consonants if k % 2 == 0 else vowels))]
                   for k in range(size))
    feminine, masculine = {_LATIN: ("a", "o"), _CYRILLIC: ("а", "й"), _GREEK: ("α", "ος")}[letters]
    if kind == "given_f":
        made = made.rstrip(vowels) + feminine
    elif kind == "given_m":
        made = made.rstrip(vowels) + (masculine if letters != _LATIN else "")
    return made


def surrogate_form(key: bytes, kind: str, form: str, attempt: int = 0) -> str:
    """The surrogate of a normal form."""
    draw, grown = Stream(key, kind, form, attempt), max(0, attempt - GROW + 1)
    if kind == "email":
        local, _, domain = form.rpartition("@")
        name, _, top = domain.rpartition(".")
        made = "".join(_like(c, draw) for c in local) + "@" + "".join(_like(c, draw) for c in name) + "." + top
        return "".join(_like("x", draw) for _ in range(grown)) + made
    if kind == "ip":
        # every octet keeps its number of digits; later any octet, at last numbers that no address has
        if grown > GROW:
            return ".".join(str(256 + draw.below(744)) + "".join(str(draw.below(10)) for _ in range(grown - GROW - 1))
                            for _ in range(4))
        if grown:
            return ".".join(str(draw.below(256)) for _ in range(4))
        return ".".join(str((draw.below(10), 10 + draw.below(90), 100 + draw.below(156))[len(str(int(o))) - 1])
                        for o in form.split("."))
    if kind == "card":
        body = "".join(str(1 + draw.below(9)) if k == 0 else str(draw.below(10)) for k in range(len(form) - 1 + grown))
        check, valid = luhn_digit(body), luhn_digit(form[:-1]) == int(form[-1])
        return body + str(check if valid else (check + 1 + draw.below(9)) % 10)
    if kind == "iban":
        rest = "".join(_like(c, draw) for c in form[4:] + "0" * grown)
        return form[:2] + iban_check(form[:2], rest) + rest
    if kind == "phone" and len(form) > 10:
        code = len(form) - 10                         # country code stays
        return form[:code] + "".join(str(draw.below(10)) for _ in form[code:] + "0" * grown)
    if kind == "secret" and re.fullmatch(r"[0-9a-fA-F]+", form):
        digits = "0123456789abcdef"
        made = "".join(digits[draw.below(16)] for _ in form + "0" * grown)
        return made.upper() if form.upper() == form else made
    if kind == "secret" and not any(c.isalpha() or c.isdigit() for c in form):
        return "".join(_SIGNS[draw.below(len(_SIGNS))] for _ in form + "*" * grown)
    if kind == "surname" or kind.startswith("given"):
        parts = re.split(r"([-'’])", form)
        return "".join(p if p in "-'’" else _name(p, kind, draw, grown) for p in parts if p)
    return "".join(_like(c, draw) for c in form + ("0" if kind in ("phone", "ssn") else "x") * grown)


def render(entity_text: str, kind: str, surrogate: str) -> str:
    """The surrogate in the mention's own spelling: separators and case."""
    if kind in ("phone", "card", "ssn", "iban"):
        made = iter(surrogate)
        return "".join(next(made) if c.isalnum() else c for c in entity_text) + "".join(made)
    if kind == "surname" or kind.startswith("given"):
        return surrogate.upper() if entity_text.isupper() else re.sub(r"[^\W\d_]+", lambda m: m.group().capitalize(), surrogate)
    if kind == "email" and entity_text != entity_text.lower():
        cased = "".join(s.upper() if c.isupper() else s for c, s in zip(entity_text, surrogate))
        return cased + surrogate[len(entity_text):]
    return surrogate


# ------------------------------------------------------------------ the jobs

MENTIONS = "row_key string, kind string, form string"


def row_key(docs: DataFrame):
    """What a row's corrections are joined by: its doc_id, or its text's hash if it has none."""
    return F.coalesce(F.concat(F.lit("d"), docs["doc_id"].cast("long").cast("string")),
                      F.concat(F.lit("t"), F.sha2(docs["text"].cast("string"), 256)))


def mentions(docs: DataFrame) -> DataFrame:
    """row_key, kind, form of every mention, once per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, text in zip(batch.column(0), batch.column(1)):
                rows += [(key.as_py(), kind, form)
                         for kind, form in dict.fromkeys((e.kind, e.form) for e in find_entities(text.as_py()))]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.string(), pa.string()))],
                    names=["row_key", "kind", "form"])

    return docs.select(row_key(docs).alias("row_key"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, MENTIONS)


def _drawn(entities: DataFrame, key: bytes) -> DataFrame:
    """kind, form, attempt, surrogate of rows kind, form, attempt."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, forms, attempts = (batch.column(k).to_pylist() for k in range(3))
            made = [surrogate_form(key, *x) for x in zip(kinds, forms, attempts)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())],
                                             names=["kind", "form", "attempt", "surrogate"])

    return entities.select("kind", "form", "attempt").mapInArrow(
        run, "kind string, form string, attempt int, surrogate string")


def surrogates(mentioned: DataFrame, key: bytes = KEY) -> DataFrame:
    """One row per distinct entity: kind, form, attempt, surrogate; no two entities of a
    kind share a surrogate, and no surrogate is an entity of that kind."""
    entities = mentioned.select("kind", "form").distinct().withColumn("attempt", F.lit(0))
    drawn = stored(_drawn(entities, key), "pii-drawn")
    while True:
        # the first form of a shared surrogate keeps it; only forms are compared, combined map-side
        shared = drawn.groupBy("kind", "surrogate").agg(F.min("form").alias("first"), F.count(F.lit(1)).alias("n")) \
            .where("n > 1").drop("n")
        real = drawn.select("kind", F.col("form").alias("surrogate"), F.lit(True).alias("is_real"))
        clash = drawn.join(shared, ["kind", "surrogate"], "left").join(real, ["kind", "surrogate"], "left") \
            .where((F.col("first") != F.col("form")) | F.col("is_real"))
        clash = stored(clash.select("kind", "form", (F.col("attempt") + 1).alias("attempt")), "pii-clash")
        if clash.isEmpty():
            return drawn
        good = drawn.join(clash.select("kind", "form"), ["kind", "form"], "left_anti")
        drawn = stored(good.unionByName(_drawn(clash, key)), "pii-drawn")


def rewrite(docs: DataFrame, corrections: DataFrame, key: bytes = KEY, count: str = "n_entities") -> DataFrame:
    """``docs`` with text rewritten, and the number of entities in the column ``count``.
    corrections: row_key and _fixes, a map from ``kind, NUL, form`` to the surrogate where it
    isn't the first drawn."""
    docs = docs.drop(count)
    names = docs.columns
    id_at, fix_name = unused("fix_id", docs), unused("fixes", docs)
    fixes_of = corrections.select(F.col("row_key").alias(id_at), F.col("_fixes").alias(fix_name))
    rows = docs.join(fixes_of, row_key(docs) == F.col(id_at), "left").select(*[docs[c] for c in names], fix_name)
    at, fix_at = names.index("text"), len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts = [], []
            fixes = batch.column(fix_at)
            for k, text in enumerate(batch.column(at)):
                text = text.as_py()
                found = find_entities(text)
                if found:
                    fix = dict(fixes[k].as_py() or ())
                    out, last = [], 0
                    for e in found:
                        made = fix.get(f"{e.kind}\x00{e.form}") or surrogate_form(key, e.kind, e.form)
                        out += [text[last:e.start], render(e.text, e.kind, made)]
                        last = e.end
                    text = "".join(out) + text[last:]
                texts.append(text)
                counts.append(len(found))
            columns = [*batch.columns[:fix_at], pa.array(counts, pa.int64())]
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=[*names, count])

    return rows.mapInArrow(run, extended(docs, **{count: T.LongType()}))


def pseudonymise(docs: DataFrame, key: bytes = KEY, count: str = "n_entities") -> DataFrame:
    """``docs`` (doc_id, text and any other columns) with surrogates in place of
    personal data, and the number of entities in the column ``count``."""
    found = stored(mentions(docs), "pii-mentions")
    redrawn = surrogates(found, key).where("attempt > 0")
    fixes = found.join(redrawn, ["kind", "form"]) \
        .select("row_key", F.concat_ws("\x00", "kind", "form").alias("k"), F.col("surrogate").alias("v")).distinct() \
        .groupBy("row_key").agg(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("_fixes"))
    return rewrite(docs, stored(fixes, "pii-fixes"), key, count)
