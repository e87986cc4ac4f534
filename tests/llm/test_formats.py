"""File formats, kernels and models against plain versions (no Spark)."""

import math
import os
import re
import struct
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from landsales.llm import decontaminate, near_dup, packing, pii, ppm, tokens, url_filter, warc, wavelet
from landsales.llm.kernels import ALNUM, NON_SPACE, utf8, words

TEXTS = ["", "one", "The cat\x0bsat  on\tthe mat.", "Élan vital — été", "a" * 5000 + " b", None, "x y z"]


@pytest.mark.parametrize("alphabet, pattern", [(NON_SPACE, r"[^\x20\x09-\x0D]+"), (ALNUM, r"[0-9A-Za-z\u0080-\U0010ffff]+")])
def test_words_match_the_pattern(alphabet, pattern, monkeypatch):
    from landsales.llm import kernels
    whole = words(*utf8(pa.array(TEXTS)), alphabet)
    monkeypatch.setattr(kernels, "PIECE", 7)          # words over several pieces
    hashes, first = words(*utf8(pa.array(TEXTS)), alphabet)
    assert (hashes == whole[0]).all() and (first == whole[1]).all()
    plain = [re.findall(pattern, re.sub("[A-Z]", lambda m: m.group().lower(), t or "")) for t in TEXTS]
    assert np.diff(first).tolist() == [len(w) for w in plain]
    flat = [w for row in plain for w in row]
    assert len(set(flat)) == len(set(hashes.tolist())) == len(set(zip(flat, hashes.tolist())))


def _records(n=300):
    return [warc.record_bytes(i, f"http://h/{i}", "response", p := (f"<p>{i} " + "shared text " * 30).encode(),
                              __import__("hashlib").sha256(p).hexdigest(), None) for i in range(n)]


def test_warc_round_trip_with_dictionary():
    data = b"".join(warc.archive(_records()))
    assert struct.unpack_from("<I", data)[0] == warc.SKIPPABLE
    back = list(warc.read_archive(data))
    assert len(back) == 300 and back[7][1].startswith(b"<p>7 ")
    assert list(warc.read_archive(b"".join(warc.archive(_records(3)))))[2][0]["warc-type"] == "response"


def test_warc_reader_refuses_broken_files():
    data = b"".join(warc.archive(_records()))
    with pytest.raises(warc.WarcError):
        list(warc.read_archive(data[:-3]))
    with pytest.raises(warc.WarcError):
        warc.parse_record(_records(1)[0].replace(b"Content-Length: ", b"Content-Length: 1", 1))
    with pytest.raises(warc.WarcError):
        warc.parse_record(_records(1)[0].replace(b"shared", b"SHARED", 1))
    with pytest.raises(warc.WarcError):
        list(warc.read_archive(struct.pack("<II", warc.SKIPPABLE, 4) + b"oops"))


def test_wavelet_matrix_against_the_list():
    rng = np.random.default_rng(5)
    ids = rng.integers(0, 700, 3000)
    shard = wavelet.Shard(b"".join(wavelet.shard_bytes([3, None], [1000, 2000], ids)))
    m = shard.matrix
    assert (m.decode() == ids).all() and (m.access(np.arange(3000)) == ids).all()
    assert (shard.document(1) == ids[1000:]).all() and shard.doc_ids == [3, None]
    for value in (0, 5, 699, 1023, 5000):
        assert m.count(value, 10, 2500) == (ids[10:2500] == value).sum()
        assert (m.find(value) == np.flatnonzero(ids == value)).all()
    with pytest.raises(ValueError):
        wavelet.Shard(b"".join(wavelet.shard_bytes([1], [3000], ids))[:-1])


def test_globs_against_regular_expressions():
    globs = ["*", "", "a*b", "*a?c", "ab*", "*[?]x*", "a" * 70 + "*", "*é*", "?"]
    rows = ["", "a", "ab", "axxb", "xxabc", "abd", "q?x", "a" * 75, "café", "b" * 200]
    for glob in globs:
        pattern = re.sub(r"\[\?\]|[*?]|[^*?]", lambda m: {"[?]": r"\?", "*": "(?s:.*)", "?": "(?s:.)"}.get(
            m.group(), re.escape(m.group())), glob).encode()
        got = url_filter.match(url_filter.compile_globs([glob]), *utf8(pa.array(rows)))
        assert got.tolist() == [bool(re.fullmatch(pattern, r.encode())) for r in rows], glob
    many = url_filter.compile_globs(["zz*", "a*b", "*q[?]x"])
    assert url_filter.match(many, *utf8(pa.array(rows))).tolist() == [r in ("ab", "axxb", "q?x") for r in rows]


def test_tokens_equal_whole_text_encoding():
    import public_tokenizers
    from tokenizers import Tokenizer
    odd = ["a\n  b", " x\u0085y ", "it's  don't 123!!", "<|endoftext|> z", "a\x1cb", " ΣΑΣ İs.", "word. Word, WORD!", "", " \n",
           "<|ENDOFTEXT|> a", "J\u030c x", "\u0130x I\u0307", "caf\u0065\u0301, \u0152uf ª º ǅ ŉ ß ſ", "É" * 300 + ".", "中文, ابج."]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        path = public_tokenizers.path(name)
        plain, ours = Tokenizer.from_file(path), tokens.Encoder(path)
        for text in odd + [a + b for a in odd for b in odd]:
            want = np.asarray(plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
            assert ours.encode(text) == want, (name, text)


def test_encoder_starts_no_threads_of_the_library():
    import subprocess
    import sys
    code = ("import os, public_tokenizers; from landsales.llm import tokens; p = public_tokenizers.path('word_bpe_49k.json'); "
            "count = lambda: len(os.listdir('/proc/self/task')); coder = tokens.Encoder(p); before = count(); "
            "coder.encode('1 2 3'); print(count() - before)")
    env = {k: v for k, v in os.environ.items() if k != "TOKENIZERS_PARALLELISM"} | {"PYTHONPATH": os.pathsep.join(sys.path)}
    said = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, check=True).stdout
    assert said.strip() == "0"


@pytest.mark.parametrize("n", [1, 511, 512, 1537])
def test_wavelet_planes_give_the_ids_back_and_leave_them_alone(n):
    for high in (2, 300, 1 << 20):
        ids = np.random.default_rng(n).integers(0, high, n).astype("<u4")
        kept = ids.copy()
        shard = wavelet.Shard(b"".join(wavelet.shard_bytes([7], [n], ids)))
        assert (ids == kept).all() and shard.matrix.decode().tolist() == kept.tolist()
        assert shard.matrix.access(np.arange(n)).tolist() == kept.tolist()


def test_packing_fills_windows_exactly_where_possible():
    lengths = np.array([700, 324, 512, 512, 1000, 24, 3, 900, 124])
    sequence, offset = packing.assign(lengths)
    sums = Counter()
    for s, n in zip(sequence.tolist(), lengths.tolist()):
        sums[s] += n
    assert sorted(sums.values()) == [3, 1024, 1024, 1024, 1024]
    rng = np.random.default_rng(2)
    lengths = rng.integers(1, 1024, 4000)
    sequence, offset = packing.assign(lengths)
    sums = np.bincount(sequence, weights=lengths)
    assert sums.max() <= 1024 and (1024 * len(sums) - lengths.sum()) < 0.01 * lengths.sum()
    best = packing.best_subset({7: 2, 5: 1, 3: 4}, 23, 1 << 23)
    assert sum(k * v for k, v in best.items()) == 23 and all(v <= {7: 2, 5: 1, 3: 4}[k] for k, v in best.items())


def _slow_jaccard(x, y):
    return sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in x.keys() | y.keys()) for i in x.keys() & y.keys())


def test_probability_jaccard_and_its_sketch():
    rng = np.random.default_rng(3)
    for _ in range(5):
        a = {int(k): int(rng.integers(1, 5)) for k in rng.choice(400, 150, replace=False)}
        b = {**{k: v for k, v in list(a.items())[:120]}, **{int(k): 2 for k in rng.integers(1000, 1050, 20)}}
        sides = [(np.array(sorted(s), np.uint64), np.array([s[k] for k in sorted(s)])) for s in (a, b)]
        exact = near_dup.probability_jaccard(*sides[0], *sides[1])
        assert math.isclose(exact, _slow_jaccard(a, b), rel_tol=1e-9)
        keys = near_dup.mix(np.concatenate([sides[0][0], sides[1][0]]))
        bounds = np.array([0, len(a), len(a) + len(b), len(a) + len(b)])
        sketch = near_dup.prob_minhash(keys, np.concatenate([sides[0][1], sides[1][1]]), bounds, 2000)
        assert abs((sketch[0] == sketch[1]).mean() - exact) < 0.05 and not sketch[2].any()


def test_smith_waterman_against_the_table():
    rng = np.random.default_rng(4)
    items, texts = rng.integers(0, 4, (6, 9)).astype(np.uint64), rng.integers(0, 4, (6, 14)).astype(np.uint64)
    best, _ = decontaminate.smith_waterman(items, texts)
    for k in range(6):
        h = np.zeros((10, 15), int)
        for i in range(9):
            for j in range(14):
                step = 1 if items[k, i] == texts[k, j] else -1
                h[i + 1, j + 1] = max(0, h[i, j] + step, h[i, j + 1] - 1, h[i + 1, j] - 1)
        assert best[k] == h.max()


def test_ppm_probabilities_sum_to_one():
    grams, _ = ppm.byte_grams(*utf8(pa.array(["abracadabra", "the theatre", "", None])))
    orders = [tuple(np.unique(grams & np.uint64((1 << 8 * (k + 1)) - 1), return_counts=True)) for k in range(ppm.ORDER + 1)]
    for trie in (ppm.Trie(orders), ppm.Trie([(o[0][:0], o[1][:0]) for o in orders])):
        for context in (b"cadab", b"zzzzz", b"zzthe", bytes([ppm.START]) * 5):
            keys = np.array([int.from_bytes(context + bytes([s]), "big") for s in range(256) if s != ppm.START], np.uint64)
            assert math.isclose((10 ** trie.score(keys)).sum(), 1, rel_tol=1e-9)


def test_surrogates_keep_type_format_and_gender():
    make = lambda kind, form, text=None: pii.render(text or form, kind, pii.surrogate_form(b"k", kind, form))
    assert re.fullmatch(r"[a-z]{3}\.\d\d@[a-z]{4}\d\.[a-z]+\.com", make("email", "und.34@mail7.site.com"))
    card = make("card", "4111111111111111", "4111-1111-1111-1111")
    assert re.fullmatch(r"(\d{4}-){3}\d{4}", card) and pii.luhn_digit(card.replace("-", "")[:-1]) == int(card[-1])
    iban = make("iban", "DE89370400440532013000")
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1
    assert make("given_f", "anna", "Anna").endswith("a") and not make("given_m", "ivo", "Ivo").endswith("a")
    assert re.fullmatch("[А-Я][а-я]+", make("surname", "петров", "Петров"))
    text = "Mr. John Smith, a@b.org, +1 (017) 555-7713, 97.51.17.173, Mrs. Smith"
    assert [e.kind for e in pii.find_entities(text)] == ["given_m", "surname", "email", "phone", "ip", "surname"]
    assert pii.find_entities("version 3.0 of CC BY-NC 4.0, page 1234") == pii.find_entities(None) == []
