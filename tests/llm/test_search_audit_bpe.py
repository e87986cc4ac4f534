"""Hard negatives, filter audit and byte-level BPE against plain versions of the whole job."""

import base64
import hashlib
import math
import random
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from landsales.llm import byte_bpe, filter_audit, hard_negatives

public_tokenizers = pytest.importorskip("public_tokenizers")


# --- hard negatives ---------------------------------------------------------

def _plain_negatives(rows, every, positives=5, negatives=10):
    valid = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        if i not in valid or (label, v) < valid[i]:
            valid[i] = (label, v)
    ints = {i: (label, [math.floor(256 * x) for x in v]) for i, (label, v) in valid.items()}
    out = []
    for a in (i for i in ints if i % every == 0):
        label, v = ints[a]
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, other == label)
                        for i, (other, w) in ints.items() if i != a and len(w) == len(v))
        for p, pid, _ in [s for s in scored if s[2]][:positives]:
            fit = [(i, -s) for s, i, same in scored if not same and 30 * -p <= 100 * -s <= 90 * -p][:negatives]
            out += [(a, pid, k, i, -p, s) for k, (i, s) in enumerate(fit, 1)]
    return sorted(out)


def _mined(spark, rows, every, schema="vec_id long, label int, embedding array<float>", extra=()):
    frame = spark.createDataFrame(rows, schema).repartition(5)
    for name in extra:
        frame = frame.withColumn(name, F.lit("x"))
    made = hard_negatives.mine(spark, frame, F.col("vec_id") % every == 0)
    return sorted(tuple(r) for r in made.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                                                "negative_score").collect())


def _vectors(seed, n, length, close=0.5):
    rng = np.random.default_rng(seed)
    centre = rng.standard_normal(length)
    v = (rng.standard_normal((n, length)) + close * centre) / math.sqrt(length)
    return [(k, int(rng.integers(0, 4)), [float(np.float32(x)) for x in row]) for k, row in enumerate(v)]


@pytest.mark.parametrize("length", [1, 24, 64, 100])
def test_negatives_equal_all_pairs(spark, length):
    rows = _vectors(length, 400, length)
    rows += [(1000 + k, k % 4, rows[3][2]) for k in range(60)]             # ties: one vector many times
    want = _plain_negatives(rows, 20)
    assert _mined(spark, rows, 20) == want and len(want) > 100


def test_negatives_of_odd_rows(spark):
    rows = _vectors(5, 60, 8) + [(100, 1, None), (101, None, [1.0] * 8), (None, 1, [1.0] * 8), (102, 1, [None] * 8),
                                 (103, 1, [float("nan")] * 8), (104, 1, [float("inf")] * 8), (105, 2, [0.5, 1.0]),
                                 (110, 1, [1.0, 2.0]), (120, 1, [0.5, 2.0]), (130, 1, []), (131, 1, []), (132, 2, []),
                                 (140, 0, [0.0] * 8)]
    rows += [rows[10], (10, 3, rows[11][2]), rows[20]]                     # repeated rows and ids
    want = _plain_negatives(rows, 10)
    assert _mined(spark, rows, 10, extra=["length", "codes", "rest", "again", "anchor_id"]) == want and want
    assert any(r[0] == 130 for r in want) and any(r[0] == 110 for r in want)
    assert _mined(spark, [], 10) == []


def test_negatives_in_many_blocks_of_anchors(spark, monkeypatch):
    rows = _vectors(9, 200, 16)
    monkeypatch.setattr(hard_negatives, "BLOCK_BYTES", 4000)
    assert _mined(spark, rows, 5) == _plain_negatives(rows, 5)


def test_large_components_do_not_overflow(spark):
    rows = [(k, k % 2, [1e300 * (1 if k % 3 else -1), 3e5]) for k in range(20)]
    assert all(abs(r[4]) <= 2**62 and abs(r[5]) <= 2**62 for r in _mined(spark, rows, 5, "vec_id long, label int, embedding array<double>"))


def test_intervals_hold_every_score():
    rng = np.random.default_rng(2)
    for length in (1, 3, 64, 100):
        rows = rng.integers(-400, 400, (300, length)) * rng.integers(0, 3, (300, 1))
        codes, alignments, rests = hard_negatives.code(rows)
        anchors = hard_negatives.Anchors(np.arange(40), np.zeros(40), rows[:40].astype(np.int64))
        low, high = anchors.intervals(slice(0, 40), codes, alignments, rests)
        exact = rows[:40] @ rows.T
        assert (low <= exact).all() and (exact <= high).all()
        if length == 64:
            assert np.median(high - low) < 0.5 * np.median(np.linalg.norm(rows[100:], axis=1)) ** 2


# --- filter audit -----------------------------------------------------------

def _plain_audit(docs, labels):
    import re
    fails = []
    for k, (doc, text, lang) in enumerate(docs):
        t = text or ""
        w = re.findall("[^\x20\x09-\x0D]+", t)
        f = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
             "D": re.search("[#$%&*|]", t) is not None,
             "E": any((u or "") == t and o is not None and (doc is None or o < doc) for o, u, _ in docs)}
        good = doc is not None and any(d == doc and q == 1 for d, q, _ in labels)
        toxic = doc is not None and any(d == doc and x == 1 for d, _, x in labels)
        fails.append((lang or "", {x for x, y in f.items() if y}, good, toxic))
    out, sums = [], {}
    for part in {f[0] for f in fails}:
        mine = [f for f in fails if f[0] == part]
        for order in permutations("ABCDE"):
            left = mine
            for step, x in enumerate(order, 1):
                gone = [f for f in left if x in f[1]]
                left = [f for f in left if x not in f[1]]
                sums[part, x] = sums.get((part, x), 0) + len(gone)
                out.append((part, "".join(order), step, len(left), len(gone), sum(x in f[1] for f in mine) - len(gone),
                            sum(f[1] == {x} for f in mine), sum(f[2] for f in gone), sum(f[3] for f in gone)))
    return sorted((*r, sums[r[0], r[1][r[2] - 1]]) for r in out)


def _audited(spark, docs, labels):
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string") \
        .withColumn("part", F.lit("x")).withColumn("mask", F.lit(7)).withColumn("good", F.lit(1))
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("print", F.lit(1))
    return sorted(tuple(r) for r in filter_audit.audit(filter_audit.failures(frame, marks)).collect())


def test_audit_equals_every_order_run_anew(spark):
    rng = random.Random(3)
    words = [f"w{k}" for k in range(400)] + ["UP", "#x", "é", "a\x1cb", "c d"]
    docs = []
    for k in range(150):
        n = rng.choice([0, 3, 150, 199, 200, 260])
        some = words if rng.random() < 0.5 else words[:60]
        docs.append((k, rng.choice([" ", "\n", "\t "]).join(rng.choice(some) for _ in range(n)), rng.choice(["en", "de", None])))
    docs += [(200 + k, docs[rng.randrange(150)][1], "en") for k in range(60)]
    docs += [(None, docs[4][1], "de"), (None, "alone", "de"), (5, docs[5][1], "en"), (300, None, "en"), (301, "", ""),
             (302, "ÀÉ " + "A" * 30, "fr"), (302, "ÀÉ " + "A" * 30, "fr")]
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for k in range(0, 250, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1)]
    want = _plain_audit(docs, labels)
    got = _audited(spark, docs, labels)
    assert got == want and len(got) == 600 * len({r[0] for r in got})
    assert all(sum(r[col] for r in got) > 0 for col in range(4, 10))


def test_audit_of_no_documents(spark):
    assert _audited(spark, [], [(1, 1, 1)]) == []


def test_gray_walk_equals_counting_each_subset():
    rng = random.Random(1)
    cells = {m: (rng.randrange(9), rng.randrange(3)) for m in range(128) if rng.random() < 0.7}
    states = filter_audit.gray_walk(cells, 7)
    for s in range(128):
        assert states[s] == tuple(sum(c[k] for m, c in cells.items() if not m & s) for k in (0, 1))


# --- byte-level BPE ---------------------------------------------------------

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    tiktoken = pytest.importorskip("tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _odd_texts(n):
    rng = random.Random(7)
    parts = ["a", "s", "t", "re", "ve", "ll", "d", "m", "'", "'", " ", " ", "\n", "\t", "1", "²", "é", "ß", "漢字", "😀", "!",
             "\"", "-", "\0", "\x1c", " ", "́", "٣", "l", "r", "v", "e", "I'll", "don't", "THE", "   ", "<|endoftext|>"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(n)]


def test_classes_of_all_code_points(library):
    import tiktoken
    single = {bytes([n]): n for n in range(256)}
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    table = byte_bpe.code_classes()
    for pattern, kinds in ((r"\p{L}", byte_bpe._LETTERS), (r"\p{N}", {byte_bpe.NUMBER}), (r"\s", byte_bpe._WHITES)):
        found = tiktoken.Encoding("x", pat_str=pattern, mergeable_ranks=single, special_tokens={}).encode_ordinary(every)
        assert bytes(found).decode() == "".join(c for c in every if table[ord(c)] in kinds)


@pytest.mark.parametrize("block", [byte_bpe.BLOCK_CHARS, 9, 64])
def test_ids_equal_the_library(library, monkeypatch, block):
    monkeypatch.setattr(byte_bpe, "BLOCK_CHARS", block)
    texts = _odd_texts(1500) + ["", "x" * 700, " " * 300, "'" * 50, "ab" * 400 + " " + "漢" * 200, "zq'll" * 90]
    words = byte_bpe.Vocabulary(RANKS)
    made = words.encode_batch(byte_bpe.split_batch(texts))
    assert [np.frombuffer(x, "<u4").tolist() for x in made] == [library.encode_ordinary(t) for t in texts]
    for text, ids in zip(texts, made):
        ids = np.frombuffer(ids, "<u4")
        places, raw = words.offsets(ids), text.encode()
        assert words.decode(ids, places) == raw
        for start, stop in ((0, 3), (1, 2), (5, 40), (-4, 10**6), (7, 7)):
            assert words.decode_range(ids, places, start, stop) == raw[max(0, start):stop]


def test_cache_that_turns_over(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE_SLICES", 20)
    words, texts = byte_bpe.Vocabulary(RANKS), _odd_texts(300)
    for k in range(0, 300, 10):
        made = words.encode_batch(byte_bpe.split_batch(texts[k:k + 10]))
        assert [np.frombuffer(x, "<u4").tolist() for x in made] == [library.encode_ordinary(t) for t in texts[k:k + 10]]


def test_wrong_offsets_are_an_error():
    words = byte_bpe.Vocabulary(RANKS)
    ids = np.frombuffer(words.encode_batch(byte_bpe.split_batch(["some words"]))[0], "<u4")
    with pytest.raises(ValueError):
        words.decode(ids, words.offsets(ids)[::-1])


def test_digests_of_a_table(spark, library):
    texts = [*_odd_texts(200), None, "", "long " * 60_000, "tie", "tie"]
    rows = [(None if k == 3 else k % 190, t) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit(1)).withColumn("n_tokens", F.lit("x"))
    got = sorted((tuple(r) for r in byte_bpe.digests(docs, RANKS).collect()), key=repr)
    want = []
    for doc, t in rows:
        ids = library.encode_ordinary(t or "")
        want.append((doc, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=repr)
    assert byte_bpe.digests(docs.limit(0), RANKS).collect() == []
