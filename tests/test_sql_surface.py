"""SQL views and table functions equal the DataFrame reports (sf0.001)."""

import os

import pytest

from landsales.plans import reports as R
from landsales.plans.driver_snapshot import snapshot_for
from landsales.plans.sql_surface import register

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def _rows(df):
    return df.columns, sorted(tuple(r) for r in df.collect())


def test_sql_functions_match_dataframe_reports(spark):
    t = snapshot_for(spark, SF).store.tables()
    register(spark, t)
    pairs = [
        ("SELECT * FROM kpi_ventes()", R.kpi(t)),
        ("SELECT * FROM kpi_ventes(p_annee => 1998)", R.kpi(t, 1998)),
        ("SELECT * FROM kpi_ventes(p_annee => 1900)", R.kpi(t, 1900)),
        ("SELECT * FROM kpi_ventes(p_type => 'PROMO')", R.kpi(t, None, "PROMO")),
        ("SELECT * FROM repartition_types()", R.type_shares(t)),
        ("SELECT * FROM repartition_types(p_annee => 1998)", R.type_shares(t, 1998)),
        ("SELECT * FROM top_communes()", R.top_communes(t)),
        ("SELECT * FROM top_communes(p_departement => '07', p_annee => 1998)", R.top_communes(t, "07", 1998)),
        ("SELECT * FROM carte_communes(p_departement => '07')", R.map_communes(t, None, "07")),
        ("SELECT * FROM carte_departements()", R.map_departements(t)),
        ("SELECT * FROM v_prix_m2_evolution", R.price_evolution(t)),
        ("SELECT * FROM v_mutations_par_annee", R.sales_per_year(t)),
        ("SELECT * FROM v_vente_local", R.sale_premises(t)),
    ]
    for sql, df in pairs:
        assert _rows(spark.sql(sql)) == _rows(df), sql


def test_views_keep_their_order(spark):
    register(spark, snapshot_for(spark, SF).store.tables())
    years = [r.annee for r in spark.sql("SELECT * FROM v_mutations_par_annee").collect()]
    assert years == sorted(years)
    keys = [(r.annee, r.type_bien) for r in spark.sql("SELECT * FROM v_prix_m2_evolution").collect()]
    assert keys == sorted(keys)
