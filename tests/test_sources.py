"""S1-S6 on small literal files."""

import json
import os
import time

import pytest

from landsales.schemas import RAW_COLUMNS
from landsales.sources.geo import first_source_wins, read_commune_centres, read_outlines
from landsales.sources.raw_files import FILE, LINE, REASON, find_year_file, read_lines, read_raw_files


def _write_raw(path, columns, rows):
    with open(path, "w", encoding="utf-8") as f:
        f.write("|".join(columns) + "\n")
        for r in rows:
            f.write("|".join(r) + "\n")


def _row(cols, **kv):
    return [kv.get(c, "") for c in cols]


def test_columns_matched_by_name(spark, work):
    a_cols = list(RAW_COLUMNS) + ["Extra"]
    b_cols = list(reversed(RAW_COLUMNS))
    _write_raw(f"{work}/a.txt", a_cols, [_row(a_cols, **{"Code commune": "004", "Code departement": "2A"})])
    _write_raw(f"{work}/b.txt", b_cols, [_row(b_cols, **{"Code commune": "105", "Code departement": "97"})])
    df = read_raw_files(spark, [f"{work}/a.txt", f"{work}/b.txt"])
    got = sorted((r["Code departement"], r["Code commune"]) for r in df.collect())
    assert got == [("2A", "004"), ("97", "105")]
    assert df.columns[:18] == RAW_COLUMNS


def test_missing_column_is_an_error(spark, work):
    cols = [c for c in RAW_COLUMNS if c != "Section"]
    _write_raw(f"{work}/m.txt", cols, [_row(cols)])
    with pytest.raises(ValueError, match="Section"):
        read_raw_files(spark, [f"{work}/m.txt"])


def test_lone_quote_and_codes_stay_text(spark, work):
    cols = list(RAW_COLUMNS)
    _write_raw(f"{work}/q.txt", cols, [_row(cols, **{"Voie": 'RUE DU "MOULIN', "Code commune": "001",
                                                      "Code departement": "01"})])
    r = read_raw_files(spark, [f"{work}/q.txt"]).first()
    assert r["Voie"] == 'RUE DU "MOULIN'
    assert r["Code departement"] + r["Code commune"] == "01001"
    assert r["Section"] is None          # empty field -> NULL


def test_ragged_line_is_flagged(spark, work):
    cols = list(RAW_COLUMNS)
    with open(f"{work}/r.txt", "w") as f:
        f.write("|".join(cols) + "\n")
        f.write("|".join(["x"] * len(cols)) + "\n")
        f.write("|".join(["y"] * 3) + "\n")
    rows = read_lines(spark, [f"{work}/r.txt"]).collect()
    assert [(r[REASON], r[LINE]) for r in rows] == [(None, None), ("fields", "y|y|y")]
    assert rows[1][FILE].endswith("/r.txt") and rows[1]["Section"] is None
    assert read_raw_files(spark, [f"{work}/r.txt"]).count() == 1


def test_bytes_that_are_no_text_are_set_aside(spark, work):
    cols = list(RAW_COLUMNS)
    with open(f"{work}/b.txt", "wb") as f:
        f.write("\ufeff".encode() + "|".join(cols).encode() + b"\r\n")
        f.write("|".join(["é"] * len(cols)).encode() + b"\r\n\r\n")
        f.write(b"\xe9|" + "|".join(["x"] * (len(cols) - 1)).encode() + b"\n")
    rows = read_lines(spark, [f"{work}/b.txt"]).collect()
    assert [r[REASON] for r in rows] == [None, "encoding"] and rows[0]["Section"] == "é" and rows[0][cols[-1]] == "é"
    assert rows[1][LINE].startswith("\ufffd|x")


def test_a_quoted_file(spark, work):
    cols = list(RAW_COLUMNS)
    with open(f"{work}/q.txt", "w") as f:
        f.write("|".join(f'"{c}"' for c in cols) + "\n")
        f.write("|".join(['"a|b"'] + [f'"{k}"' for k in range(1, len(cols))]) + "\n")
        f.write('"a"|"b"\n')
    rows = read_lines(spark, [f"{work}/q.txt"], quote='"').collect()
    assert rows[0][cols[0]] == "a|b" and rows[0][cols[5]] == "5" and [r[REASON] for r in rows] == [None, "fields"]


def test_many_files_are_one_scan_per_header(spark, work):
    cols = list(RAW_COLUMNS)
    paths = []
    for k in range(1000):
        order = cols if k % 2 else cols[::-1]
        _write_raw(f"{work}/f{k}.txt", order, [_row(order, **{"No plan": str(k)})])
        paths.append(f"{work}/f{k}.txt")
    began = time.monotonic()
    df = read_raw_files(spark, paths)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert time.monotonic() - began < 60 and plan.count("FileScan text") == 2
    assert df.selectExpr("count(*) AS n", "sum(CAST(`No plan` AS INT)) AS s").first() == (1000, 499500)


def test_find_year_file(work):
    for name in ["notes-2023.txt", "ValeursFoncieres-2023.TXT", "ValeursFoncieres-2023.txt", "valeursfoncieres-2024.txt"]:
        open(os.path.join(work, name), "w").close()
    assert find_year_file(work, 2023).endswith("ValeursFoncieres-2023.txt")
    assert find_year_file(work, 2022) is None


def test_centres_json_array_and_first_source_wins(spark, work):
    a = [{"code": "01001", "centre": {"type": "Point", "coordinates": [5.0, 46.0]}},
         {"code": "01002", "centre": None},
         {"code": "75056", "centre": {"type": "Point", "coordinates": [2.35, 48.85]}}]
    b = [{"code": "01001", "centre": {"type": "Point", "coordinates": [9.0, 9.0]}},
         {"code": "75101", "centre": {"type": "Point", "coordinates": [2.34]}}]
    for name, data in (("a.json", a), ("b.json", b)):
        with open(f"{work}/{name}", "w") as f:
            json.dump(data, f)
    ca = read_commune_centres(spark, f"{work}/a.json")
    cb = read_commune_centres(spark, f"{work}/b.json")
    rows = {r.code_commune: (r.latitude, r.longitude) for r in first_source_wins([ca, cb]).collect()}
    assert rows == {"01001": (46.0, 5.0), "75056": (48.85, 2.35), "75101": (None, 2.34)}


def test_outlines(spark, work):
    fc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"code": "01", "nom": "Ain"},
         "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [0, 1], [0, 0]]]}},
        {"type": "Feature", "properties": {"code": "2A", "nom": "Corse-du-Sud"}, "geometry": None}]}
    with open(f"{work}/d.geojson", "w") as f:
        json.dump(fc, f)
    rows = read_outlines(spark, f"{work}/d.geojson").collect()
    assert [(r.code, r.nom) for r in rows] == [("01", "Ain"), ("2A", "Corse-du-Sud")]
    assert json.loads(rows[0].geometry)["type"] == "Polygon"


def test_a_line_is_split_once(spark, work):
    """The filter on lines set aside is pushed to the scan: it must not split each line there too."""
    _write_raw(f"{work}/s.txt", RAW_COLUMNS, [_row(RAW_COLUMNS, Voie="A"), ["cut", "short"], _row(RAW_COLUMNS) + [""]])
    rows = read_raw_files(spark, [f"{work}/s.txt"])
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1
    assert [r["Voie"] for r in rows.collect()] == ["A"]
    assert [r[REASON] for r in read_lines(spark, [f"{work}/s.txt"]).collect()] == [None, "fields", "fields"]
