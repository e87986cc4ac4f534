"""Keyed append, incremental loads, snapshots, failures."""

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql.utils import CapturedException

from landsales.operators.keyed import new_rows
from landsales.plans import load as L
from landsales.schemas import KEYS, PUBLISHED, RAW_COLUMNS
from landsales.sources.raw_files import year_marker
from landsales.store import Store


def _write_year(folder, year, rows):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{year_marker(year)}", "w", encoding="utf-8") as f:
        f.write("|".join(RAW_COLUMNS) + "\n")
        for kv in rows:
            f.write("|".join(kv.get(c, "") for c in RAW_COLUMNS) + "\n")


def _sale(disp, date, value, comm="001", section="A", plan="1", typ="Maison", surf="50"):
    return {"No disposition": disp, "Date mutation": date, "Nature mutation": "Vente",
            "Valeur fonciere": value, "Code departement": "01", "Code commune": comm,
            "Commune": f"C{comm}", "Code postal": "01000", "Section": section, "No plan": plan,
            "Type local": typ, "Surface reelle bati": surf, "Nombre pieces principales": "3"}


def _landing(work):
    land = f"{work}/landing"
    _write_year(land, 2022, [_sale("1", "01/02/2022", "100000"), _sale("2", "03/04/2022", "200000", plan="2")])
    _write_year(land, 2023, [_sale("1", "05/06/2023", "150000"), _sale("1", "05/06/2023", "150000")])
    return land


def _snapshot(store):
    return {n: sorted(tuple(r) for r in store.table(n).drop("loaded_at" if n == "elt_file" else "_").collect())
            for n in PUBLISHED}


def test_keyed_append_existing_wins_and_null_key_fails(spark):
    schema, keys = PUBLISHED["commune"], KEYS["commune"]
    existing = spark.createDataFrame([("01001", "OLD", "01", "01000")], schema)
    batch = spark.createDataFrame([("01001", "NEW", "01", "01000"), ("01002", "B", "01", "01000"),
                                   ("01002", "B", "01", "01000")], schema)
    rows = new_rows(batch, existing, schema, keys, "commune").collect()
    assert [(r.code_commune, r.nom_commune) for r in rows] == [("01002", "B")]
    bad = spark.createDataFrame([(None, "X", "01", "01000")], schema)
    with pytest.raises((PySparkException, CapturedException, Exception), match="NULL key"):
        new_rows(bad, existing, schema, keys, "commune").collect()


def test_incremental_equals_one_shot_and_rerun_is_noop(spark, work):
    land = _landing(work)
    one = Store(spark, f"{work}/one")
    L.load(spark, one.root, land, [2022, 2023], log=lambda m: None)
    inc = Store(spark, f"{work}/inc")
    L.load(spark, inc.root, land, [2022], log=lambda m: None)
    assert L.pending_markers(spark, inc.table("elt_file"), [year_marker(2022), year_marker(2023)]) \
        == [year_marker(2023)]
    L.load(spark, inc.root, land, [2022, 2023], log=lambda m: None)
    assert _snapshot(one) == _snapshot(inc)
    # derived per-snapshot tables equal a recomputation from the base tables
    from landsales.plans import reports as R
    state = inc.state()
    for fn in (R.price_evolution, R.type_shares, R.top_communes, R.map_departements):
        a = sorted(map(tuple, fn(inc.tables()).collect()))
        assert a == sorted(map(tuple, fn(one.tables()).collect()))
        assert a == sorted(map(tuple, fn(inc.tables(state["batches"])).collect()))
    assert R.kpi(inc.tables()).collect() == R.kpi(inc.tables(state["batches"])).collect()
    before = _snapshot(inc)
    res = L.load(spark, inc.root, land, [2022, 2023], log=lambda m: None)
    assert res.years == [] and _snapshot(inc) == before          # K7: republished, unchanged
    assert inc.state()["snapshot"] == 3
    counts = {r.table_name: r.rows for r in L.table_counts(inc).collect()}
    assert counts["mutation"] == 3 and counts["elt_file"] == 2


def test_scenario_one_parcel_two_sales_four_pairs(spark, work):
    land = f"{work}/landing"
    _write_year(land, 2022, [_sale("1", "01/02/2022", "100000", surf="50"),
                             _sale("2", "03/04/2022", "300000", surf="100")])
    store = Store(spark, f"{work}/s")
    L.load(spark, store.root, land, [2022], log=lambda m: None)
    from landsales.plans import reports as R
    t = store.tables()
    assert R.sale_premises(t).count() == 4
    k = R.kpi(t).first()
    assert k.nb_ventes == 2 and str(k.volume_total_eur) == "400000.00"
    # pairs: 100000/50, 100000/100, 300000/50, 300000/100 -> median of 1000,2000,3000,6000
    assert k.prix_m2_median_eur == 2500.0


def test_failure_before_switch_keeps_old_snapshot(spark, work, monkeypatch):
    land = _landing(work)
    store = Store(spark, f"{work}/f")
    L.load(spark, store.root, land, [2022], log=lambda m: None)
    before = _snapshot(store)

    def boom(*a, **k):
        raise RuntimeError("crash before publish")
    monkeypatch.setattr(Store, "publish", boom)
    with pytest.raises(RuntimeError):
        L.load(spark, store.root, land, [2022, 2023], log=lambda m: None)
    monkeypatch.undo()
    assert _snapshot(store) == before                 # leftover batch folders invisible
    L.load(spark, store.root, land, [2022, 2023], log=lambda m: None)
    assert len(store.table("mutation").collect()) == 3


def test_full_reload_starts_empty(spark, work):
    land = _landing(work)
    store = Store(spark, f"{work}/r")
    L.load(spark, store.root, land, [2022, 2023], log=lambda m: None)
    L.load(spark, store.root, land, [2023], full_reload=True, log=lambda m: None)
    assert store.table("mutation").count() == 1
    assert [r.filename for r in store.table("elt_file").collect()] == [year_marker(2023)]


def test_no_file_aborts(spark, work):
    os.makedirs(f"{work}/empty", exist_ok=True)
    with pytest.raises(RuntimeError, match="no raw file"):
        L.load(spark, f"{work}/x", f"{work}/empty", [2030], log=lambda m: None)
    assert Store(spark, f"{work}/x").state()["batches"] == []


def test_pending_centres_do_not_hide_missing_raw_files(spark, work):
    os.makedirs(f"{work}/empty", exist_ok=True)
    with open(f"{work}/geo.json", "w") as handle:
        handle.write('[{"codeInsee": "69001", "latitude_mairie": 45.0, "longitude_mairie": 4.0}]')
    with pytest.raises(RuntimeError, match="no raw file"):
        L.load(spark, f"{work}/y", f"{work}/empty", [2022], [L.CentreSource("geo.json", f"{work}/geo.json")],
               log=lambda m: None)
    assert Store(spark, f"{work}/y").state()["snapshot"] == 0
