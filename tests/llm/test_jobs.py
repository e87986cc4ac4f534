"""Every operator as a Spark job: nulls, empty and long texts, ties, repeated rows,
empty tables, extra columns; results against brute force."""

import math
import re
import zlib
from collections import Counter

import pytest

from landsales.llm import (decontaminate, licenses, near_dup, packing, pii, ppm, quality, queries, url_filter, warc,
                           wavelet)

PROSE = ("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon "
         "phi chi psi omega one two three four five six seven eight nine ten eleven twelve thirteen fourteen").split()
BASE = " ".join(PROSE)
EDITED = " ".join(PROSE[:-1] + ["changed"])
LONG = " ".join(f"w{k}" for k in range(30_000))
DOCS = [(1, BASE), (2, BASE), (2, BASE), (3, EDITED), (4, "quite another text of seven words"), (5, None), (6, ""), (7, ""),
        (8, LONG), (None, BASE), (9, "hi"), (10, "hi"), (11, "Mail jo.77@mail.example.com from 10.0.0.1 " + BASE[::-1])]
SCHEMA = "doc_id long, text string, id long, root string, a int, bucket string, lang string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, 7, "x", None, "y", "en") for i, t in DOCS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_near_duplicate_classes(docs, empty):
    got = {r.doc_id: r.class_id for r in near_dup.classes(docs).collect()}
    assert got == {None: None, 1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 6, 7: 7, 8: 8, 9: 9, 10: 9, 11: 11}
    assert near_dup.classes(empty).count() == 0


def test_chains_and_hot_buckets_lose_no_link(spark, monkeypatch):
    """A hub's variants, some linked only through other variants, in blocks of a few rows."""
    monkeypatch.setattr(near_dup, "BLOCK_ROWS", 4)
    rows = []
    for k in range(40):
        own = list(PROSE) * 3
        own = [f"{w}{j}" for j, w in enumerate(own)]
        for j in range(k):                       # variant k has k words in a row replaced
            own[j] = f"v{j}"
        rows.append((k, " ".join(own)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in near_dup.classes(frame).collect()}
    assert set(got.values()) == {0}              # each is alike the next, the ends are not alike


def test_warc_query_matches_the_contract(spark, docs):
    html = ["x" * 200, "x" * 200, None, "short", "short", "é" * 60, "x" * 200, "é" * 60]
    rows = [(k, f"http://h/{k}", h, 1) for k, h in enumerate(html)] + [(1, "http://h/1", html[1], 1), (None, None, html[0], 2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, first_id int")
    got = sorted((r.page_id is not None, r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to)
                 for r in warc.page_digests(spark, pages).collect())
    want = []
    for page_id, _, h, _ in rows:
        size = len((h or "").encode())
        first = min((i for i, _, g, _ in rows if g == h and i is not None), default=None)
        again = size >= 100 and page_id != first
        want.append((page_id is not None, page_id or 0, size, "revisit" if again else "response", first if again else None))
    assert got == sorted(want, key=lambda x: x[:3])
    assert warc.page_digests(spark, pages.limit(0)).count() == 0


def test_decontamination_finds_copies_and_spares_others(spark, docs, empty):
    words = BASE.split()
    items = spark.createDataFrame([(0, " ".join(words[5:30])), (1, "nothing of the kind stands in these texts at all"),
                                   (2, None), (3, ""), (4, "hi")], "item_id long, text string")
    edited = " ".join(["intro"] * 30 + words[5:15] + ["new"] + words[16:30] + ["outro"] * 30)
    more = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(20, edited)], "doc_id long, text string"))
    hits = {(r.doc_id, r.item_id): (r.score, r.first_word) for r in decontaminate.leaks(more, items).collect()}
    assert hits == {(None, 0): (25, 5), (1, 0): (25, 5), (2, 0): (25, 5), (3, 0): (25, 5), (20, 0): (23, 30)}
    blocks = {(r.doc_id, r.item_id) for r in decontaminate.leaks(more, items, block_words=20).collect()}
    assert blocks == set(hits)
    assert decontaminate.leaks(empty, items).count() == decontaminate.leaks(docs, items.limit(0)).count() == 0


def test_quality_base_columns_and_verdict(spark, docs, empty):
    texts = [BASE, "a b c d e a b c d e a b c d e", "#x $y\n#x $y\n \n\n#x $y", None, "", "one two", LONG]
    frame = spark.createDataFrame([(k, t, 1) for k, t in enumerate(texts)], "doc_id long, text string, n_words int")
    labels = spark.createDataFrame([(0, 1, 0), (6, 1, 0), (1, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    rows = quality.judge(frame.drop("n_words"), labels).collect()
    for r in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
        seen = Counter(windows)
        covered = {i + j for i, x in enumerate(windows) if seen[x] > 1 for j in range(5)}
        lines = [x for x in (r.text or "").split("\n") if x.strip(" \t\n\r\x0b\f")]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", r.text or "")), len(lines) - len(set(lines)), len(covered))
        assert r.base_failed == (len(w) < 10 or 100 * len(covered) > 20 * len(w))
    assert {r.doc_id for r in rows if r.kept} == {0, 6}
    assert quality.judge(empty, labels).count() == 0
    assert [r.kept for r in quality.judge(frame.drop("n_words").where("doc_id = 0"), labels.limit(0)).collect()] == [True]


def _vocabulary(name):
    import public_tokenizers
    return public_tokenizers.path(name)


def test_packing_covers_every_id_once(spark, docs, empty):
    from tokenizers import Tokenizer
    import numpy as np
    rows = packing.pack_documents(docs, _vocabulary("byte_bpe_50k.json")).collect()
    plain = Tokenizer.from_file(_vocabulary("byte_bpe_50k.json"))
    for doc_id, text in {(i, t) for i, t in DOCS}:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [0]
        copies = sum(d == (doc_id, text) for d in DOCS)
        want = Counter({(s, min(1024, len(ids) - s), zlib.crc32(np.array(ids[s:s + 1024], "<u4").tobytes()), len(ids)): copies
                        for s in range(0, len(ids), 1024)})
        assert Counter((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows if r.doc_id == doc_id) == want
    for sequence in {r.sequence_id for r in rows}:
        at = 0
        for r in sorted((r for r in rows if r.sequence_id == sequence), key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    assert packing.pack_documents(empty, _vocabulary("byte_bpe_50k.json")).count() == 0


def test_wavelet_files_give_the_ids_back(spark, docs, empty, tmp_path):
    from tokenizers import Tokenizer
    import numpy as np
    path = _vocabulary("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    manifest = wavelet.write_shards(docs, path, 2, f"{tmp_path}/wmx", shard_tokens=500)
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in wavelet.read_documents(manifest).collect())
    at, everything = 0, []
    for start, doc_id, n_tokens, crc in got:
        ids = plain.encode(dict(DOCS)[doc_id] or "", add_special_tokens=False).ids + [2]
        assert (start, n_tokens, crc) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
        everything += ids
    assert [d for _, d, _, _ in got] == sorted((i for i, _ in DOCS), key=lambda i: -1 if i is None else i)
    assert sum(r.n for r in wavelet.count_token(manifest, 2).collect()) == len(DOCS)
    token = everything[3]
    assert sorted(r.position for r in wavelet.find_token(manifest, token).collect()) == \
        [k for k, x in enumerate(everything) if x == token]
    assert wavelet.index_corpus(empty, path).count() == 0


def test_url_verdicts(spark):
    rows = [(1, "HTTP://WWW.Example.COM/en/x?q#f"), (2, "http://shop.example.com/en/"), (3, "http://a.net/fr/1"),
            (4, "http://x.org/a.zip#t"), (5, None), (6, "no scheme"), (7, "http://x.org/%7Elogin%2a"), (8, "http://x.org/b/login?x"),
            (8, "http://x.org/b/login?x")]
    pages = spark.createDataFrame([(i, u, "z") for i, u in rows], "page_id long, url string, host string")
    got = sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(pages).collect())
    assert got == [(1, "www.example.com", "/en/x", "www.example.com/en/", "allow"),
                   (2, "shop.example.com", "/en/", "example.com/en/", "block"), (3, "a.net", "/fr/1", "net/fr/", "block"),
                   (4, "x.org", "/a.zip", None, "block"), (5, "", "", None, "allow"), (6, "", "", None, "allow"),
                   (7, "x.org", "/%7Elogin%2a", None, "allow"), (8, "x.org", "/b/login", None, "block"),
                   (8, "x.org", "/b/login", None, "block")]
    assert {r.canonical for r in url_filter.judge_urls(pages).where("page_id = 7").collect()} == {"x.org/~login%2A"}
    assert url_filter.judge_urls(pages.limit(0)).count() == 0


def test_lm_scores_base_and_tail(spark, docs, empty):
    tokens = lambda t: re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
    held = lambda i: i is None or zlib.crc32(str(i).encode()) % 10 == 0
    counts, ends = Counter(), 0
    for i, t in DOCS:
        if not held(i):
            counts.update(tokens(t))
            ends += 1
    total, distinct = sum(counts.values()) + ends, len(counts) + 1
    log = lambda c: math.log10((c + 0.1) / (total + 0.1 * (distinct + 1)))
    rows = ppm.score(docs, max_grams=500, head_words=20).collect()
    assert len(rows) == len(DOCS)
    for r in rows:
        w = tokens(dict(DOCS)[r.doc_id])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (
            held(r.doc_id), len(w) + 1, sum(counts[x] > 0 for x in w) + 1, total)
        assert math.isclose(r.base_score, sum(log(counts[x]) for x in w) + log(ends), rel_tol=1e-9) and r.score < 0
    assert ppm.score(empty).count() == 0


def test_pii_rewriting_is_consistent_and_distinct(spark, docs, empty, monkeypatch):
    rows = {r.doc_id: r for r in pii.pseudonymise(docs).collect()}
    assert rows[5].text is None and rows[1].text == BASE and rows[11].n_entities == 2 and rows[11].lang == "en"
    assert "jo.77@" not in rows[11].text and "10.0.0.1 " not in rows[11].text
    # a tiny surrogate space forces collisions: all entities still differ, from each other and from real ones
    draw = pii.surrogate_form
    monkeypatch.setattr(pii, "surrogate_form", lambda key, kind, form, attempt=0: draw(key, kind, form, attempt)[:1] * 3)
    few = spark.createDataFrame([("secret", f"{c}{c}{c}") for c in "abcdefgh"], "kind string, form string")
    made = pii.surrogates(few, b"k")
    assert made.count() == 8
    final = made.collect()
    assert len({r.surrogate for r in final}) == 8 and not {r.surrogate for r in final} & {r.form for r in final}
    assert pii.pseudonymise(empty).count() == 0


def test_license_scan_and_inheritance(spark):
    apache, mit = "Licensed under the Apache License, Version 2.0.", "Released under the MIT License."
    rows = [(1, "/r/LICENSE", apache), (2, "/r/a/b/x.py", "print(1)"), (3, "/r/a/COPYING", mit), (4, "/r/y.py", "code\n# " + mit),
            (5, "/q/z.py", None), (6, None, apache), (7, "/r/a/b/x.py", ""), (7, "/r/a/b/x.py", "")]
    files = spark.createDataFrame([(*r, "e") for r in rows], "file_key long, path string, text string, term string")
    got = sorted((r.file_key, r.own_license or "", r.inherited_license or "", r.license or "") for r in licenses.scan(files).collect())
    assert got == [(1, "Apache-2.0", "Apache-2.0", "Apache-2.0"), (2, "", "MIT", "MIT"), (3, "MIT", "MIT", "MIT"),
                   (4, "MIT", "Apache-2.0", "MIT"), (5, "", "", ""), (6, "Apache-2.0", "", "Apache-2.0"),
                   (7, "", "MIT", "MIT"), (7, "", "MIT", "MIT")]
    assert licenses.scan(files.limit(0)).count() == 0


def test_pipeline_stages_on_planted_rows(spark, docs, tmp_path):
    import corpus_pipeline as cp
    sf = str(tmp_path)
    leak = " ".join(f"secretitem{k}" for k in range(30))
    rows = [(1, BASE), (2, BASE), (3, EDITED), (4, "too short"), (5, "x y z " + leak + " tail of it"), (6, LONG), (7, None),
            (8, "write to jo.77@mail.example.com " + " ".join(reversed(PROSE)))]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                          "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(0, leak)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0), (6, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    packed = cp.run(spark, sf).collect()
    assert {r.doc_id for r in packed} == {1, 6, 8} and len(cp.STAGES) == 5
    assert set(queries.oracle_sql()) < set(queries.queries())
