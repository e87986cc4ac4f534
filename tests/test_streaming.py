"""Streaming ingestion loads each landed file once and equals the batch load."""

import os

import pytest

from landsales.plans import load as L
from landsales.schemas import RAW_COLUMNS
from landsales.sources.raw_files import with_file, year_marker
from landsales.store import Store
from landsales.streaming.ingest import _markers, _parsed, ingest_available

from test_store import _landing, _sale, _snapshot, _write_year


def test_stream_matches_batch_and_skips_seen_files(spark, work):
    land = _landing(work)
    ckpt = f"{work}/ckpt"
    streamed = Store(spark, f"{work}/streamed")
    assert ingest_available(spark, land, streamed.root, ckpt, log=lambda m: None) >= 1
    batch = Store(spark, f"{work}/batch")
    L.load(spark, batch.root, land, [2022, 2023], log=lambda m: None)
    assert _snapshot(streamed) == _snapshot(batch)

    snapshots = streamed.state()["snapshot"]
    assert ingest_available(spark, land, streamed.root, ckpt, log=lambda m: None) == 0
    assert streamed.state()["snapshot"] == snapshots          # nothing new, nothing published

    _write_year(land, 2024, [_sale("9", "07/08/2024", "99000", plan="3")])
    assert ingest_available(spark, land, streamed.root, ckpt, log=lambda m: None) == 1
    assert streamed.table("mutation").count() == 4
    assert "valeursfoncieres-2024.txt" in {r.filename for r in streamed.table("elt_file").collect()}


def test_one_file_per_micro_batch(spark, work):
    land = _landing(work)
    streamed = Store(spark, f"{work}/one_by_one")
    runs = ingest_available(spark, land, streamed.root, f"{work}/ckpt1", max_files_per_trigger=1,
                            log=lambda m: None)
    assert runs == 2 and len(streamed.state()["batches"]) == 2
    batch = Store(spark, f"{work}/batch1")
    L.load(spark, batch.root, land, [2022, 2023], log=lambda m: None)
    assert _snapshot(streamed) == _snapshot(batch)


def _folder(land, year, files):
    """A year as a folder of part files, some with their columns in another order."""
    os.makedirs(f"{land}/{year_marker(year)}", exist_ok=True)
    for name, (columns, rows) in files.items():
        with open(f"{land}/{year_marker(year)}/{name}", "w", encoding="utf-8") as f:
            f.write("|".join(columns) + "\n")
            for kv in rows:
                f.write("|".join(kv.get(c, "") for c in columns) + "\n")
            f.write("cut short|by far\n")


def test_a_half_streamed_year_is_resumed(spark, work):
    land, streamed = f"{work}/landing", Store(spark, f"{work}/half")
    first = {"part-0.txt": (RAW_COLUMNS, [_sale("1", "01/02/2024", "100000")])}
    second = {"part-1.txt": (RAW_COLUMNS[::-1], [_sale("2", "03/04/2024", "200000", plan="2")])}
    _folder(land, 2024, first)
    L.load(spark, streamed.root, land, [], log=lambda m: None)
    manifest = lambda: {r.filename for r in streamed.table("elt_file").collect()}
    files = {f"file:{land}/{year_marker(2024)}/part-0.txt"}
    _folder(land, 2024, second)                      # lands before the first part's batch is done
    lines = with_file(spark.read.text(sorted(files)))
    state = streamed.state()
    L.append_batch(spark, streamed, state, state["batches"], _parsed(lines, sorted(files)), None,
                   _markers(spark, streamed, state["batches"], sorted(files)), lambda m: None)
    assert manifest() == {"valeursfoncieres-2024.txt/part-0.txt"} and streamed.table("mutation").count() == 1
    done = L.load(spark, streamed.root, land, [2024], log=lambda m: None)
    assert done.raw_rows == 1 and done.rejected_rows == 1            # the other part only
    assert manifest() == {year_marker(2024), *(f"{year_marker(2024)}/part-{k}.txt" for k in (0, 1))}
    whole = Store(spark, f"{work}/whole")
    L.load(spark, whole.root, land, [2024], log=lambda m: None)
    assert {k: v for k, v in _snapshot(streamed).items() if k != "elt_file"} == \
        {k: v for k, v in _snapshot(whole).items() if k != "elt_file"}
    assert L.load(spark, streamed.root, land, [2024], log=lambda m: None).years == []


def test_streamed_parts_of_other_headers_and_lines_set_aside(spark, work):
    land, streamed = f"{work}/landing", Store(spark, f"{work}/parts")
    _folder(land, 2024, {"part-0.txt": (RAW_COLUMNS, [_sale("1", "01/02/2024", "100000")]),
                         "part-1.txt": (RAW_COLUMNS[::-1], [_sale("2", "03/04/2024", "200000", plan="2")])})
    assert ingest_available(spark, land, streamed.root, f"{work}/ck", log=lambda m: None) == 1
    assert streamed.table("mutation").count() == 2
    assert year_marker(2024) in {r.filename for r in streamed.table("elt_file").collect()}
    aside = streamed.rejected_lines().collect()
    assert sorted(r.file.rsplit("/", 1)[1] for r in aside) == ["part-0.txt", "part-1.txt"]
    assert {(r.reason, r.line) for r in aside} == {("fields", "cut short|by far")}


def test_more_lines_set_aside_than_allowed_publish_nothing(spark, work):
    land, store = f"{work}/landing", Store(spark, f"{work}/strict")
    _folder(land, 2024, {"part-0.txt": (RAW_COLUMNS, [_sale("1", "01/02/2024", "100000")])})
    with pytest.raises(L.RejectedLines, match="1 raw lines"):
        L.load(spark, store.root, land, [2024], log=lambda m: None, max_rejected=0)
    assert store.state()["batches"] == []
    assert L.load(spark, store.root, land, [2024], log=lambda m: None, max_rejected=1).rejected_rows == 1
