"""Repeated ids, texts of signs, null ids and columns whose names clash: no row is lost, none crashes."""

import random

import pytest

from landsales.llm import near_dup, pii, quality

WORDS = [f"word{k}" for k in range(400)]


def _text(rng, n=60):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def _edited(text, rng, changes):
    words = text.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = "edit" + str(rng.randrange(1000))
    return " ".join(words)


def _shingles(text):
    words = text.split()
    out = {}
    for k in range(max(1, len(words) - 4)):
        gram = tuple(words[k:k + 5])
        out[gram] = out.get(gram, 0) + 1
    return out


def _plain_jaccard(a, b):
    """Probability Jaccard of two weighted sets."""
    if not set(a) & set(b):
        return 0.0
    every, total = set(a) | set(b), 0.0
    for x in set(a) & set(b):
        total += 1 / sum(max(a.get(y, 0) / a[x], b.get(y, 0) / b[x]) for y in every)
    return total


def _plain_classes(rows, similarity=0.8):
    """Classes by comparing all pairs of rows."""
    ids = sorted({i for i, _ in rows if i is not None})
    root = {i: i for i in ids}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    sets = [(i, t, _shingles(t) if any(c.isalnum() for c in t) else None) for i, t in rows if i is not None and t and t.split()]
    for k, (i, t, a) in enumerate(sets):
        for j, u, b in sets[:k]:
            if t == u or a is not None and b is not None and _plain_jaccard(a, b) >= similarity:
                x, y = top(i), top(j)
                root[max(x, y)] = min(x, y)
    return {i: top(i) for i in ids}


@pytest.fixture(scope="module")
def copies():
    rng = random.Random(8)
    rows = [(k, _text(rng)) for k in range(60)]
    rows += [(100 + k, _edited(rows[k % 30][1], rng, changes)) for k, changes in enumerate([0, 0, 1, 1, 2, 2, 3, 4, 6, 9] * 6)]
    rows += [(300, "%%% *** --- ###"), (301, "%%% *** --- ###"), (302, "%%% ***"), (303, " \t"), (304, " \t"), (305, ""), (306, None)]
    return rows


def test_classes_equal_all_pairs(spark, copies):
    got = {r.doc_id: r.class_id for r in near_dup.classes(spark.createDataFrame(copies, "doc_id long, text string")).collect()}
    assert got == _plain_classes(copies) and sum(k != v for k, v in got.items()) > 20
    assert got[301] == 300 and got[302] == 302 and got[304] == 304


def test_every_text_of_a_repeated_id_is_compared(spark, copies):
    rng = random.Random(4)
    again, other = _text(rng), _text(rng)
    rows = copies + [(5, again), (5, other), (5, other), (400, _edited(again, rng, 1)), (401, _edited(other, rng, 1)),
                     (402, again), (2, _text(rng)), (None, again), (-7, _edited(other, rng, 1))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.class_id for r in near_dup.classes(frame).collect()}
    want = _plain_classes([r for r in rows if r[0] is not None])
    same = {}
    for i, _ in rows:                              # the rows of an id are one class
        if i is not None:
            same.setdefault(i, want[i])
    assert got.pop(None) is None and got == same
    assert {got[i] for i in (5, 400, 401, 402, -7)} == {-7}


def test_measures_replace_columns_of_their_name_and_keep_leaves_them(spark):
    rows = [(1, "one two three four five six seven eight nine ten eleven", "mine", 5, "m", "v"), (2, "short", "mine", 6, "m", "v")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string, n_words int, _m string, Verdict string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    judged = {r.doc_id: r.asDict() for r in quality.judge(docs, labels).collect()}
    assert judged[1]["n_words"] == 11 and judged[1]["kept"] is True and judged[2]["kept"] is False and judged[1]["_m"] == "m"
    kept = quality.keep(docs, labels)
    assert kept.columns == docs.columns and [tuple(r) for r in kept.collect()] == [rows[0]]


def test_surrogates_beside_clashing_columns_and_without_ids(spark, monkeypatch):
    draw = pii.surrogate_form           # first attempts of all addresses collide: corrections are needed everywhere
    monkeypatch.setattr(pii, "surrogate_form", lambda key, kind, form, attempt=0: draw(key, kind, form, attempt)
                        if attempt else "same.one@mail.example.org")
    rows = [(None if k % 2 else k, f"write to person{k}.x@mail.example.com today", "x", "y", "z") for k in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_entities string, _fixes string, _fix_id string")
    made = pii.pseudonymise(docs, b"k").collect()
    addresses = {r.text.split()[2] for r in made}
    assert len(addresses) == 8 and all(r.n_entities == 1 and r._fixes == "y" and r._fix_id == "z" for r in made)
    other = pii.pseudonymise(docs, b"k", count="found")
    assert other.columns == [*docs.columns, "found"] and {r.n_entities for r in other.collect()} == {"x"}


def test_pipeline_keeps_every_text_and_column(spark, tmp_path):
    import corpus_pipeline as cp
    rng = random.Random(2)
    texts = [_text(rng) for _ in range(6)]
    rows = [(3, texts[0]), (3, texts[1]), (3, texts[1]), (4, _edited(texts[1], rng, 1)), (None, texts[2]), (None, texts[2]),
            (6, texts[3] + " mail jo.77@mail.example.com now"), (7, None), (8, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), "k", 1, "e") for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, kept string, n_words int, "
                                 "n_entities string")
    sf = str(tmp_path)
    docs.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    for name, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"] and "n_entities" in docs.columns, name
    left = sorted(((r.doc_id, r.text, r.kept, r.n_words, r.n_entities) for r in docs.collect()), key=repr)
    mail = [r for r in left if r[0] == 6]
    assert [r for r in left if r[0] != 6] == sorted(
        [(3, texts[0], "k", 1, "e"), (3, texts[1], "k", 1, "e"), (None, texts[2], "k", 1, "e"), (None, texts[2], "k", 1, "e")], key=repr)
    assert len(mail) == 1 and mail[0][1].startswith(texts[3]) and "jo.77@" not in mail[0][1] and mail[0][2:] == ("k", 1, "e")
    assert cp.STAGES[-1][1](spark, docs, sf).select("doc_id").distinct().count() == 3
    empty = docs.limit(0)
    for _, stage in cp.STAGES[:-1]:
        empty = stage(spark, empty, sf)
    assert empty.count() == 0
