"""Operator 8: URL rules, and glob patterns run as one bit-parallel automaton.

Each glob (``*`` any run of bytes, ``?`` any byte, a whole-URL match) becomes a
chain of states, one bit per literal or ``?``; all chains lie side by side in a
row of 64-bit words. One Shift-And step per byte advances every pattern:
``D = ((D << 1 | starts) & accepts[byte]) | (D & loops)``, with ``loops`` the
states followed by ``*``. URLs of a batch advance together, column by column.

Canonical URL: host in lower case without user info, port and one trailing dot,
then path and query with unreserved percent-escapes decoded and the other
escapes in upper case; the fragment is cut.

Defined results: a null URL, or one without ``://``, has empty host and path,
matches no rule, and its canonical URL is empty (only globs of stars match it);
repeated rows are judged one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landsales.llm.common import extended
from landsales.llm.kernels import slices, utf8

# Host and path rules of the query (fixed values): (verdict, host, path prefix).
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))

# Globs over canonical URLs that no rule decides; a URL that matches any is blocked.
BLOCK_GLOBS = ("*ads-track.*", "*cheap-pills.*", "*casino*", "*doubleclick.*", "*/login*", "*/signin*",
               "*/wp-admin/*", "*.zip", "*.exe", "*.jpg", "*.png", "*.gif", "*.mp?", "*[?]sessionid=*",
               "*/search[?]*", "*/cart/*", "*/tag/*/page/*", "*/feed/", "*.onion/*", "*/calendar/????-??-??*")

U = np.uint64
STEP_BYTES = 1 << 20      # URLs advanced together: bounds the state matrix


@dataclass(frozen=True)
class Automaton:
    """Masks of all patterns: (256, words) accepts and (words,) rows."""
    accepts: np.ndarray
    starts: np.ndarray      # first states
    loops: np.ndarray       # states that stay on any byte
    free: np.ndarray        # first states that may begin at any byte (leading star)
    finals: np.ndarray      # last states
    always: bool            # some pattern is made of stars only
    empty: bool             # some pattern is the empty string


def _tokens(glob: str) -> list[int | None]:
    """Bytes, None for ``?``, -1 for ``*``; ``[x]`` is the character x itself."""
    out: list[int | None] = []
    for literal, char in re.findall(r"\[(.)\]|(.)", glob, re.S):
        if literal:
            out.extend(literal.encode())
        elif char == "*":
            if not out or out[-1] != -1:
                out.append(-1)
        else:
            out.extend([None] if char == "?" else char.encode())
    return out


def compile_globs(globs: Sequence[str]) -> Automaton:
    chains = [_tokens(g) for g in globs]
    bits = sum(sum(t != -1 for t in chain) for chain in chains)
    width = max(1, -(-bits // 64))
    masks = {k: np.zeros(width, U) for k in ("starts", "loops", "free", "finals")}
    accepts = np.zeros((256, width), U)
    at, always, empty = 0, False, False
    for chain in chains:
        states = [t for t in chain if t != -1]
        if not states:
            always, empty = always or bool(chain), True
            continue
        seen, leading = 0, chain[0] == -1
        for token in chain:
            if token == -1:
                if seen:
                    masks["loops"][(at + seen - 1) // 64] |= U(1) << U((at + seen - 1) % 64)
                continue
            word, bit = divmod(at + seen, 64)
            one = U(1) << U(bit)
            if token is None:
                accepts[:, word] |= one
            else:
                accepts[token, word] |= one
            if seen == 0:
                masks["free" if leading else "starts"][word] |= one
            seen += 1
        masks["finals"][(at + seen - 1) // 64] |= U(1) << U((at + seen - 1) % 64)
        at += seen
    return Automaton(accepts, masks["starts"], masks["loops"], masks["free"], masks["finals"], always, empty)


def match(auto: Automaton, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For every row: does any pattern match the whole row?"""
    out = np.zeros(len(offsets) - 1, bool)
    lengths = np.diff(offsets)
    first = auto.starts | auto.free
    for a, b in slices(offsets, STEP_BYTES):
        order = a + np.argsort(-lengths[a:b], kind="stable")      # longest first
        state = np.zeros((b - a, auto.accepts.shape[1]), U)
        size = lengths[order]
        live = b - a
        for k in range(int(size[0]) if size.size else 0):
            while live and size[live - 1] <= k:
                live -= 1
            now = state[:live]
            moved = now << U(1)
            moved[:, 1:] |= now[:, :-1] >> U(63)
            # the bit that enters a chain from its left neighbour's last state is masked
            moved &= ~first
            moved |= auto.free if k else first
            state[:live] = (moved & auto.accepts[data[offsets[order[:live]] + k]]) | (now & auto.loops)
        out[order] = (state & auto.finals).any(axis=1) | auto.always | ((size == 0) & auto.empty)
    return out


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, url.substr(at + 3, F.length(url)))


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of the contract: host after the first ``://`` with A-Z lower-cased."""
    rest = _after_scheme(url)
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    host = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def canonical(url: Column) -> Column:
    """Host (no user info, port, trailing dot), path and query; escapes made uniform."""
    rest = F.regexp_replace(_after_scheme(url), r"#[\s\S]*$", "")
    host = F.lower(F.regexp_extract(rest, r"^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(host, r"^[^@]*@", ""), r":\d*$", ""), r"\.$", "")
    return F.concat(host, F.regexp_extract(rest, r"^[^/?]*([\s\S]*)$", 1))


def _unescape(text: str) -> str:
    def one(m):
        char = chr(int(m.group(1), 16))
        return char if char.isascii() and (char.isalnum() or char in "-._~") else m.group().upper()
    return re.sub(r"%([0-9A-Fa-f]{2})", one, text) if "%" in text else text


def longest_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits; later rules win ties."""
    ranked = sorted(rules, key=lambda r: (len(r[1] + r[2])), reverse=True)
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, rule_host, prefix in reversed(ranked):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(prefix)
        name = F.when(fits, rule_host + prefix).otherwise(name)
        verdict = F.when(fits, what).otherwise(verdict)
    return name, verdict


def glob_matches(urls: DataFrame, globs: Sequence[str] = BLOCK_GLOBS) -> DataFrame:
    """Adds ``glob_hit`` to rows with a string column ``canonical``."""
    auto = compile_globs(globs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("canonical")
            texts = [_unescape(t or "") for t in batch.column(at).to_pylist()]
            column = pa.array(texts, pa.large_string())
            hits = match(auto, *utf8(column))
            arrays = [column.cast(pa.string()) if i == at else batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(hits)], names=[*batch.schema.names, "glob_hit"])

    return urls.mapInArrow(run, extended(urls, glob_hit=T.BooleanType()))


def judge_urls(pages: DataFrame, key: str = "page_id", url: str = "url", rules=RULES,
               globs: Sequence[str] = BLOCK_GLOBS) -> DataFrame:
    """key, host, path, rule, verdict, canonical, glob_hit for every row."""
    rows = pages.select(F.col(key), F.col(url).cast("string").alias("_url"))
    host, path = url_parts(F.col("_url"))
    rows = rows.select(key, host.alias("host"), path.alias("path"), F.coalesce(canonical(F.col("_url")), F.lit(""))
                       .alias("canonical"))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("glob_hit"), "block").otherwise("allow")
    return glob_matches(rows, globs).select(key, "host", "path", rule.alias("rule"),
                                            F.coalesce(verdict, method).alias("verdict"), "canonical", "glob_hit")
