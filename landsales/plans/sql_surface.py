"""K7 + SQL surface: views and SQL table functions over a snapshot.

``register(spark, tables)`` (re)creates temporary views for the published
tables and the reports, and SQL table functions with optional named
parameters (``DEFAULT NULL`` means "all"):

    SELECT * FROM kpi_ventes(p_annee => 2024, p_type => 'Maison')
    SELECT * FROM repartition_types(p_annee => 2023)
    SELECT * FROM top_communes(p_departement => '69')
    SELECT * FROM carte_communes(p_annee => 2024, p_departement => '13')
    SELECT * FROM carte_departements()

They use the same factorised per-parcel statistics as the DataFrame reports
(``landsales.operators.pairs``): price per m2 is never computed on the
materialised (sale x premises) fan-out. Inside a function a literal argument
folds ``p IS NULL OR col = p`` to ``col = p``, which reaches the Parquet scan.
``kpi_ventes`` is the same text as ``reports.kpi``: exact medians selected by scalar
subqueries (``operators.selection``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from landsales.operators.pairs import pairs
from landsales.plans.reports import kpi_sql, price_evolution_sql, type_shares_sql

BASE_VIEWS = {
    "ls_sales": """
SELECT id_mutation, annee, valeur_fonciere FROM mutation
WHERE nature_mutation = 'Vente' AND valeur_fonciere > 0""",
    "ls_premises": """
SELECT l.id_parcelle, p.code_commune, l.type_local, l.surface_reelle_bati
FROM local l JOIN parcelle p ON l.id_parcelle = p.id_parcelle
WHERE l.surface_reelle_bati > 0""",
    "ls_parcel_types": """
SELECT g.id_parcelle, p.code_commune, g.type_local, g.n_prem, g.inv_surf
FROM (SELECT id_parcelle, type_local, count(*) AS n_prem,
             sum(1.0D / cast(surface_reelle_bati AS double)) AS inv_surf
      FROM local WHERE surface_reelle_bati > 0 GROUP BY id_parcelle, type_local) g
JOIN parcelle p ON g.id_parcelle = p.id_parcelle""",
    "ls_sale_parcels": """
SELECT s.id_mutation, s.annee, s.valeur_fonciere, mp.id_parcelle
FROM ls_sales s JOIN mutation_parcelle mp ON s.id_mutation = mp.id_mutation""",
    "ls_sale_parcel_types": """
SELECT sp.id_mutation, sp.annee, sp.valeur_fonciere, sp.id_parcelle, pt.code_commune,
       cast(sp.valeur_fonciere AS double) * pt.inv_surf AS pair_sum, pt.n_prem AS pair_n
FROM ls_sale_parcels sp JOIN (SELECT id_parcelle, code_commune, sum(n_prem) AS n_prem, sum(inv_surf) AS inv_surf
                              FROM ls_parcel_types GROUP BY id_parcelle, code_commune) pt
  ON sp.id_parcelle = pt.id_parcelle""",
    "ls_parcel_sale_values": """
SELECT id_parcelle, annee, valeur_fonciere, count(*) AS a FROM ls_sale_parcels GROUP BY id_parcelle, annee, valeur_fonciere""",
    "ls_parcel_surfaces": """
SELECT id_parcelle, type_local, surface_reelle_bati, count(*) AS b FROM ls_premises
GROUP BY id_parcelle, type_local, surface_reelle_bati""",
    "v_prix_m2_evolution": price_evolution_sql("ls_sale_parcel_types", "ls_parcel_sale_values", "ls_parcel_surfaces"),
    "v_mutations_par_annee": """
SELECT annee, count(*) AS mutations FROM mutation WHERE annee IS NOT NULL GROUP BY annee ORDER BY annee""",
}


# Views that a snapshot's derived tables stand in for
DERIVED_VIEWS = {"ls_sale_parcel_types": "sale_parcel_types", "ls_parcel_sale_values": "parcel_sale_values",
                 "ls_parcel_surfaces": "parcel_surfaces"}

FUNCTIONS = {
    "kpi_ventes": ("p_annee INT DEFAULT NULL, p_type STRING DEFAULT NULL",
                   "nb_ventes BIGINT, volume_total_eur DECIMAL(38,2), prix_median_eur DECIMAL(15,2), "
                   "prix_m2_median_eur DOUBLE",
                   kpi_sql("ls_sale_parcel_types", "ls_parcel_sale_values", "ls_parcel_surfaces", "p_annee", "p_type")),
    "repartition_types": ("p_annee INT DEFAULT NULL",
                          "type_bien STRING, nb_transactions BIGINT, part_pct DOUBLE",
                          type_shares_sql("ls_sale_parcel_types", "ls_parcel_surfaces",
                                          "(p_annee IS NULL OR annee = p_annee)")),
    "top_communes": ("p_departement STRING DEFAULT NULL, p_annee INT DEFAULT NULL",
                     "commune STRING, dept STRING, nb_ventes BIGINT, prix_moyen_eur DOUBLE, prix_m2_moyen DOUBLE",
                     """
WITH per_sale AS (SELECT s.code_commune, s.id_mutation, s.valeur_fonciere,
                         sum(s.pair_sum) AS s, sum(s.pair_n) AS n
                  FROM ls_sale_parcel_types s JOIN commune c ON s.code_commune = c.code_commune
                  WHERE (p_annee IS NULL OR s.annee = p_annee)
                    AND (p_departement IS NULL OR c.code_departement = p_departement)
                  GROUP BY s.code_commune, s.id_mutation, s.valeur_fonciere),
per AS (SELECT code_commune, count(*) AS nb_ventes, sum(valeur_fonciere) AS v, sum(s) / sum(n) AS pm
        FROM per_sale GROUP BY code_commune)
SELECT c.nom_commune AS commune, c.code_departement AS dept, per.nb_ventes,
       round(cast(per.v AS double) / cast(per.nb_ventes AS double), 0) AS prix_moyen_eur,
       round(per.pm, 0) AS prix_m2_moyen
FROM per JOIN commune c ON per.code_commune = c.code_commune
ORDER BY per.nb_ventes DESC, c.code_commune LIMIT 10"""),
    "carte_communes": ("p_annee INT DEFAULT NULL, p_departement STRING DEFAULT NULL",
                       "commune STRING, latitude DOUBLE, longitude DOUBLE, nb_ventes BIGINT, prix_moyen_eur DOUBLE",
                       """
WITH per AS (SELECT code_commune, count(*) AS n, sum(valeur_fonciere) AS v
             FROM (SELECT DISTINCT s.code_commune, s.id_mutation, s.valeur_fonciere
                   FROM ls_sale_parcel_types s JOIN commune c ON s.code_commune = c.code_commune
                   WHERE (p_annee IS NULL OR s.annee = p_annee)
                     AND (p_departement IS NULL OR c.code_departement = p_departement))
             GROUP BY code_commune)
SELECT c.nom_commune AS commune, g.latitude, g.longitude, sum(per.n) AS nb_ventes,
       round(cast(sum(per.v) AS double) / cast(sum(per.n) AS double), 0) AS prix_moyen_eur
FROM per JOIN commune_geo g ON per.code_commune = g.code_commune
JOIN commune c ON per.code_commune = c.code_commune
GROUP BY c.nom_commune, g.latitude, g.longitude"""),
    "carte_departements": ("p_annee INT DEFAULT NULL",
                           "dept STRING, nb_ventes BIGINT, prix_moyen_eur DOUBLE, prix_m2_moyen DOUBLE, "
                           "latitude DOUBLE, longitude DOUBLE",
                           """
WITH per_sale AS (SELECT c.code_departement, s.id_mutation, s.valeur_fonciere,
                         sum(s.pair_sum) AS s, sum(s.pair_n) AS n
                  FROM ls_sale_parcel_types s JOIN commune c ON s.code_commune = c.code_commune
                  WHERE p_annee IS NULL OR s.annee = p_annee
                  GROUP BY c.code_departement, s.id_mutation, s.valeur_fonciere),
per AS (SELECT code_departement, count(*) AS nb_ventes, sum(valeur_fonciere) AS v, sum(s) / sum(n) AS pm
        FROM per_sale GROUP BY code_departement),
centres AS (SELECT c.code_departement, avg(g.latitude) AS latitude, avg(g.longitude) AS longitude
            FROM commune c JOIN commune_geo g ON c.code_commune = g.code_commune GROUP BY c.code_departement)
SELECT per.code_departement AS dept, per.nb_ventes,
       round(cast(per.v AS double) / cast(per.nb_ventes AS double), 0) AS prix_moyen_eur,
       CASE WHEN per.code_departement IS NOT NULL THEN round(per.pm, 0) END AS prix_m2_moyen,
       ce.latitude, ce.longitude
FROM per LEFT JOIN centres ce ON per.code_departement = ce.code_departement"""),
}


def register(spark: SparkSession, tables: dict[str, DataFrame]) -> list[str]:
    """(Re)register the snapshot's tables, report views and table functions."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    for name, body in BASE_VIEWS.items():
        if DERIVED_VIEWS.get(name) in tables:
            tables[DERIVED_VIEWS[name]].createOrReplaceTempView(name)   # materialised
            continue
        spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS {body}")
    pairs(tables).createOrReplaceTempView("v_vente_local")
    for name, (params, returns, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) "
                  f"RETURNS TABLE ({returns}) RETURN {body}")
    return list(tables) + list(BASE_VIEWS) + ["v_vente_local"] + list(FUNCTIONS)


def register_views(spark: SparkSession, store) -> list[str]:
    """K7: point every view and function at the store's current snapshot
    (done after each load, also when nothing new was ingested)."""
    return register(spark, store.tables())
