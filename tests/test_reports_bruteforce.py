"""Factorised reports against a brute-force pandas evaluation of the pair view.

The fixture has a busy parcel (several sales x several premises of two types),
a sale spread over two communes, non-qualifying sales (other nature, value 0
or NULL) and premises with surface 0, so every report's two grains (distinct
sales, pairs) and the fan-out semantics are exercised.
"""

from decimal import Decimal

import pandas as pd
import pytest

from landsales.plans import layers as Ly
from landsales.plans import reports as R
from landsales.schemas import PUBLISHED

D = Decimal

MUT = [("m1", 2022, None, "Vente", D("100000")), ("m2", 2022, None, "Vente", D("250000")),
       ("m3", 2023, None, "Vente", D("180000")), ("m4", 2023, None, "Echange", D("90000")),
       ("m5", 2023, None, "Vente", D("0")), ("m6", 2022, None, "Vente", None),
       ("m7", 2023, None, "Vente", D("420000")), ("m8", None, None, "Vente", D("50000"))]
LINK = [("m1", "p1"), ("m2", "p1"), ("m3", "p1"), ("m4", "p1"), ("m5", "p2"), ("m6", "p2"),
        ("m7", "p2"), ("m7", "p3"), ("m8", "p3"), ("m3", "p4")]
LOC = [("l1", "Maison", D("50"), 3, "p1"), ("l2", "Appartement", D("70"), 2, "p1"),
       ("l3", "Maison", D("120"), 5, "p1"), ("l4", "Maison", D("0"), 1, "p2"),
       ("l5", "Appartement", D("35"), 1, "p2"), ("l6", "Maison", D("90"), 4, "p3"),
       ("l7", "Dependance", D("15"), None, "p4")]
PAR = [("p1", "01001"), ("p2", "01002"), ("p3", "02001"), ("p4", "01001")]
COM = [("01001", "A", "01", "01000"), ("01002", "B", "01", "01000"), ("02001", "C", "02", "02000")]
GEO = [("01001", 46.0, 5.0), ("02001", 49.5, 3.25)]


@pytest.fixture(scope="module")
def tables(spark):
    data = {"mutation": MUT, "mutation_parcelle": LINK, "local": LOC, "parcelle": PAR,
            "commune": COM, "commune_geo": GEO}
    return {n: spark.createDataFrame(rows, PUBLISHED[n]) for n, rows in data.items()}


def brute_pairs():
    m = pd.DataFrame(MUT, columns=["id_mutation", "annee", "d", "nature", "valeur"])
    lk = pd.DataFrame(LINK, columns=["id_mutation", "id_parcelle"])
    lo = pd.DataFrame(LOC, columns=["id_local", "type_local", "surface", "pieces", "id_parcelle"])
    pa = pd.DataFrame(PAR, columns=["id_parcelle", "code_commune"])
    p = m.merge(lk, on="id_mutation").merge(lo, on="id_parcelle").merge(pa, on="id_parcelle")
    p = p[(p.nature == "Vente") & p.valeur.notna() & (p.valeur > 0) & (p.surface > 0)].copy()
    p["ratio"] = p.valeur.astype(float) / p.surface.astype(float)
    return p


def test_pairs_count(tables):
    assert R.sale_premises(tables).count() == len(brute_pairs())


def test_kpi(tables):
    p = brute_pairs()
    sales = p.drop_duplicates("id_mutation")
    k = R.kpi(tables).first()
    assert k.nb_ventes == len(sales)
    assert k.volume_total_eur == sum(sales.valeur)
    assert k.prix_m2_median_eur == pytest.approx(p.ratio.median(), rel=1e-12)
    assert float(k.prix_median_eur) == pytest.approx(float(sales.valeur.astype(float).median()), abs=0.01)
    e = R.kpi(tables, 1900).first()
    assert (e.nb_ventes, e.volume_total_eur, e.prix_median_eur, e.prix_m2_median_eur) == (0, None, None, None)


def test_price_evolution(tables):
    p = brute_pairs().dropna(subset=["annee"])
    exp = {(int(a), t): (round(g.ratio.mean()), g.id_mutation.nunique())
           for (a, t), g in p.groupby(["annee", "type_local"])}
    got = {(r.annee, r.type_bien): (r.prix_m2_moyen, r.nb_ventes) for r in R.price_evolution(tables).collect()}
    assert got == exp


def test_type_shares(tables):
    p = brute_pairs()
    n = p.groupby("type_local").id_mutation.nunique()
    exp = {t: (c, round(c * 100.0 / n.sum(), 1)) for t, c in n.items()}
    got = {r.type_bien: (r.nb_transactions, r.part_pct) for r in R.type_shares(tables).collect()}
    assert got == exp


def test_top_communes_and_maps(tables):
    p = brute_pairs()
    v = p.drop_duplicates(["id_mutation", "code_commune"])
    exp = {c: (len(g), round(g.valeur.astype(float).mean()), round(p[p.code_commune == c].ratio.mean()))
           for c, g in v.groupby("code_commune")}
    names = {c: n for c, n, _, _ in COM}
    got = {r.commune: (r.nb_ventes, r.prix_moyen_eur, r.prix_m2_moyen) for r in R.top_communes(tables).collect()}
    assert got == {names[c]: e for c, e in exp.items()}
    geo = {c for c, _, _ in GEO}
    mc = {r.commune: (r.nb_ventes, r.prix_moyen_eur) for r in R.map_communes(tables).collect()}
    assert mc == {names[c]: e[:2] for c, e in exp.items() if c in geo}
    dept = {c: d for c, _, d, _ in COM}
    p["dept"] = p.code_commune.map(dept)
    vd = p.drop_duplicates(["id_mutation", "dept"])
    md = {r.dept: (r.nb_ventes, r.prix_moyen_eur, r.prix_m2_moyen, r.latitude)
          for r in R.map_departements(tables).collect()}
    assert md == {d: (len(g), round(g.valeur.astype(float).mean()), round(p[p.dept == d].ratio.mean()),
                      {"01": 46.0, "02": 49.5}[d]) for d, g in vd.groupby("dept")}


def test_layers(tables, spark):
    outl = spark.createDataFrame([("01", "Ain", None), ("02", "Aisne", None), ("03", "Allier", None)],
                                 "code string, nom string, geometry string")
    rows = {r.code: r for r in Ly.choropleth(tables, outl).collect()}
    assert (rows["03"].ventes_fmt, rows["03"].prix_fmt, rows["03"].fill_r, rows["03"].fill_a) == ("0", "–", 210, 90)
    top = max(rows["01"], rows["02"], key=lambda r: int(r.ventes_fmt))
    assert (top.fill_r, top.fill_g, top.fill_b, top.fill_a) == (215, 48, 39, 190)
    b = {r.dept: r.texte for r in Ly.badges(tables).collect()}
    assert set(b) == {"01", "02"}
    mv = Ly.map_view(tables).first()
    assert mv.communes == 2 and mv.latitude == (46.0 + 49.5) / 2


def test_null_departement_group(spark):
    com = [("01001", "A", "01", "01000"), ("99", "NODEPT", None, "")]
    mut = [("m1", 2022, None, "Vente", D("100000")), ("m2", 2022, None, "Vente", D("300000"))]
    link = [("m1", "p1"), ("m2", "p2")]
    loc = [("l1", "Maison", D("50"), 3, "p1"), ("l2", "Maison", D("100"), 3, "p2")]
    par = [("p1", "01001"), ("p2", "99")]
    geo = [("01001", 46.0, 5.0), ("99", 40.0, 1.0)]
    data = {"mutation": mut, "mutation_parcelle": link, "local": loc, "parcelle": par,
            "commune": com, "commune_geo": geo}
    t = {n: spark.createDataFrame(rows, PUBLISHED[n]) for n, rows in data.items()}
    got = {r.dept: tuple(r)[1:] for r in R.map_departements(t).collect()}
    assert got["01"] == (1, 100000.0, 2000.0, 46.0, 5.0)
    assert got[None] == (1, 300000.0, None, None, None)
    assert [r[0] for r in R.filter_departements(t).collect()] == ["01", None]
