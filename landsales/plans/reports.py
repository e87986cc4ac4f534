"""The parametrised reports over a published snapshot.

Every report takes the snapshot's tables (``dict`` name -> DataFrame, see
``Store.tables``) and optional parameters; a parameter left as ``None`` means
"all" and adds no filter, so Catalyst only sees the predicates that matter and
pushes them to the Parquet scan.

Types follow the published model: counts are bigint, ratios and means are
double, the total value is decimal(38,2) and the median sale price is
decimal(15,2).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landsales.operators import pairs as P
from landsales.operators import selection

Tables = dict[str, DataFrame]


def _mean(total: Column, count: Column) -> Column:
    return total.cast("double") / count.cast("double")


def sale_premises(t: Tables, year: int | None = None, property_type: str | None = None) -> DataFrame:
    """Qualifying (sale, premises) pairs."""
    return P.pairs(t, year, property_type)


def kpi_sql(pairs: str, values: str, surfaces: str, year: str = "NULL", property_type: str = "NULL") -> str:
    """R1 as one SELECT. ``pairs``, ``values`` and ``surfaces`` name the relations
    sale_parcel_types, parcel_sale_values and parcel_surfaces; ``year`` and ``property_type``
    are SQL literals or parameters, NULL for all."""
    of_year, of_type = f"({year} IS NULL OR annee = {year})", f"({property_type} IS NULL OR type_local = {property_type})"
    has_type = "TRUE" if property_type == "NULL" else f"({property_type} IS NULL OR id_parcelle IN (SELECT id_parcelle FROM surf))"
    ctes = [
        f"surf AS (SELECT id_parcelle, CAST(surface_reelle_bati AS DOUBLE) AS s, b AS w FROM {surfaces} WHERE {of_type})",
        f"sold AS (SELECT DISTINCT id_mutation, valeur_fonciere FROM {pairs} WHERE {of_year} AND {has_type})",
        "price AS (SELECT CAST(valeur_fonciere AS DOUBLE) AS x, 1L AS w FROM sold)",
        f"vals AS (SELECT id_parcelle, CAST(valeur_fonciere AS DOUBLE) AS x, a AS w FROM {values} WHERE {of_year})",
        *selection.median_ctes("e", "price"),
        *selection.pair_values("p", "vals", "surf"),
        *selection.median_ctes("m", "p_x", "p_bc"),
    ]
    return selection.with_ctes(ctes, f"""
SELECT coalesce(n, 0L) AS nb_ventes,
       (SELECT CAST(sum(CAST(CAST(x AS DECIMAL(15,2)) * w AS DECIMAL(38,2))) AS DECIMAL(38,2)) FROM e_v) AS volume_total_eur,
       {selection.cents_between("lo", "hi")} AS prix_median_eur,
       (SELECT lo + (hi - lo) * 0.5D FROM m_m) AS prix_m2_median_eur
FROM e_m""")


def kpi(t: Tables, year: int | None = None, property_type: str | None = None) -> DataFrame:
    """Sales, total value, median sale price (distinct sales) and median
    price per m2 (pairs). Always exactly one row.

    One lazy plan (``operators.selection``): the distinct qualifying sales, compressed by
    value, give the count, the total and the median price; the parcels' value and surface
    counts give the median price per m2, all parcels alike, without listing their pairs.
    """
    vals = t["parcel_sale_values"] if "parcel_sale_values" in t else P.parcel_sale_values(t)
    surf = _surfaces(t)
    if year is not None:
        vals = vals.where(F.col("annee") == F.lit(year))
    if property_type is not None:
        surf = surf.where(F.col("type_local") == F.lit(property_type))
    return vals.sparkSession.sql(kpi_sql("{pairs}", "{vals}", "{surf}"), vals=vals, surf=surf,
                                 pairs=P.sale_parcel_types(t, year, property_type))


def _surfaces(t: Tables) -> DataFrame:
    return t["parcel_surfaces"] if "parcel_surfaces" in t else P.parcel_surfaces(t)


def price_evolution_sql(pairs: str, values: str, surfaces: str) -> str:
    """R2 as one SELECT over the relations sale_parcel_types, parcel_sale_values and
    parcel_surfaces. Sums over pairs are products of a parcel's totals per year and per type."""
    ctes = [
        *P.kinds_sql(pairs, surfaces, "annee IS NOT NULL"),
        f"sums AS (SELECT id_parcelle, annee, CAST(sum(CAST(valeur_fonciere * a AS DECIMAL(38,2))) AS DOUBLE) AS v, sum(a) AS a "
        f"FROM {values} WHERE annee IS NOT NULL GROUP BY id_parcelle, annee)",
        f"built AS (SELECT id_parcelle, type_local, sum(b) AS b, sum(b / CAST(surface_reelle_bati AS DOUBLE)) AS inv "
        f"FROM {surfaces} WHERE type_local IS NOT NULL GROUP BY id_parcelle, type_local)",
        "means AS (SELECT annee, type_local, sum(v * inv) / sum(a * b) AS m FROM sums JOIN built "
        "ON sums.id_parcelle = built.id_parcelle GROUP BY annee, type_local)",
    ]
    return selection.with_ctes(ctes, """
SELECT k.annee, k.type_local AS type_bien, round(means.m, 0) AS prix_m2_moyen, k.n AS nb_ventes
FROM kinds k JOIN means ON k.annee = means.annee AND k.type_local = means.type_local ORDER BY annee, type_bien""")


def price_evolution(t: Tables) -> DataFrame:
    """R2: mean price per m2 over pairs and distinct sales, per year x type."""
    vals = t["parcel_sale_values"] if "parcel_sale_values" in t else P.parcel_sale_values(t)
    return vals.sparkSession.sql(price_evolution_sql("{pairs}", "{vals}", "{surf}"), vals=vals, surf=_surfaces(t),
                                 pairs=P.sale_parcel_types(t))


def sales_per_year(t: Tables) -> DataFrame:
    """Sales of every nature per year, from the sale table alone."""
    return (t["mutation"].where(F.col("annee").isNotNull())
            .groupBy("annee").agg(F.count(F.lit(1)).alias("mutations"))
            .orderBy("annee"))


def type_shares_sql(pairs: str, surfaces: str, where: str = "TRUE") -> str:
    """R4 as one SELECT over the relations sale_parcel_types and parcel_surfaces. The share is
    rounded half away from zero on the binary value (round(x, 1) rounds the decimal text)."""
    ctes = [*P.kinds_sql(pairs, surfaces, where), "g AS (SELECT type_local, sum(n) AS n FROM kinds GROUP BY type_local)"]
    return selection.with_ctes(ctes, """
SELECT type_local AS type_bien, n AS nb_transactions,
       round(CAST(n * 100 AS DOUBLE) / CAST((SELECT sum(n) FROM g) AS DOUBLE) * 10, 0) / 10 AS part_pct
FROM g ORDER BY nb_transactions DESC, type_bien""")


def type_shares(t: Tables, year: int | None = None) -> DataFrame:
    """Distinct sales per property type and share of the sum, in %.

    A sale with premises of two types counts in both; the total is the sum of
    the groups (a scalar subquery: partial sums, no single-partition window).
    """
    surf = _surfaces(t)
    return surf.sparkSession.sql(type_shares_sql("{pairs}", "{surf}"), surf=surf, pairs=P.sale_parcel_types(t, year))


def _per_place(spt: DataFrame, place: str) -> DataFrame:
    """Sales counted once per (place, sale), with value and pair sums."""
    per_sale = (spt.groupBy(place, "id_mutation", "valeur_fonciere")
                .agg(F.sum("pair_sum").alias("s"), F.sum("pair_n").alias("n")))
    return per_sale.groupBy(place).agg(
        F.count(F.lit(1)).alias("nb_ventes"),
        F.sum("valeur_fonciere").alias("valeur_sum"),
        _mean(F.sum("s"), F.sum("n")).alias("prix_m2"))


def _in_departement(spt: DataFrame, com: DataFrame,
                    departement: str | None) -> tuple[DataFrame, DataFrame]:
    """Both sides restricted to one département before anything is shuffled."""
    if departement is None:
        return spt, com
    com = com.where(F.col("code_departement") == F.lit(departement))
    return spt.join(com.select("code_commune"), "code_commune", "left_semi"), com


def top_communes(t: Tables, departement: str | None = None, year: int | None = None,
                 k: int = 10) -> DataFrame:
    """Top communes by distinct sales; mean sale price and mean price per
    m2 over pairs. The year filters both. Ties on the count are broken by commune code."""
    spt, com = _in_departement(P.sale_parcel_types(t, year), t["commune"], departement)
    joined = _per_place(spt, "code_commune").join(com, "code_commune")
    return (joined.select(
                "code_commune",
                F.col("nom_commune").alias("commune"),
                F.col("code_departement").alias("dept"),
                "nb_ventes",
                F.round(_mean(F.col("valeur_sum"), F.col("nb_ventes")), 0).alias("prix_moyen_eur"),
                F.round(F.col("prix_m2"), 0).alias("prix_m2_moyen"))
            .orderBy(F.desc("nb_ventes"), "code_commune").limit(k)
            .drop("code_commune"))


def map_communes(t: Tables, year: int | None = None, departement: str | None = None) -> DataFrame:
    """Per commune name and centre: distinct sales and mean sale price."""
    spt, com = _in_departement(P.sale_parcel_types(t, year), t["commune"], departement)
    per = (spt.select("code_commune", "id_mutation", "valeur_fonciere").distinct()
           .groupBy("code_commune").agg(F.count(F.lit(1)).alias("n"),
                                        F.sum("valeur_fonciere").alias("v")))
    placed = per.join(t["commune_geo"], "code_commune").join(com, "code_commune")
    return (placed.groupBy("nom_commune", "latitude", "longitude")
            .agg(F.sum("n").alias("nb_ventes"), F.sum("v").alias("v"))
            .select(F.col("nom_commune").alias("commune"), "latitude", "longitude", "nb_ventes",
                    F.round(_mean(F.col("v"), F.col("nb_ventes")), 0).alias("prix_moyen_eur")))


def departement_centres(t: Tables) -> DataFrame:
    """Unweighted mean of the centres of all communes of each département."""
    return (t["commune"].join(t["commune_geo"], "code_commune")
            .groupBy("code_departement")
            .agg(F.avg("latitude").alias("latitude"), F.avg("longitude").alias("longitude")))


def map_departements(t: Tables, year: int | None = None) -> DataFrame:
    """Per département: distinct sales, mean price, mean price per m2 and
    centroid. A NULL département keeps its counts; its joined columns stay
    NULL (NULL never matches a join key)."""
    spt = P.sale_parcel_types(t, year).join(
        t["commune"].select("code_commune", "code_departement"), "code_commune")
    per = _per_place(spt, "code_departement")
    out = per.join(departement_centres(t), "code_departement", "left")
    return out.select(
        F.col("code_departement").alias("dept"),
        "nb_ventes",
        F.round(_mean(F.col("valeur_sum"), F.col("nb_ventes")), 0).alias("prix_moyen_eur"),
        F.when(F.col("code_departement").isNotNull(), F.round(F.col("prix_m2"), 0))
         .alias("prix_m2_moyen"),
        "latitude", "longitude")


def filter_years(t: Tables) -> DataFrame:
    """Years present in the sale table."""
    return (t["mutation"].where(F.col("annee").isNotNull()).select("annee").distinct()
            .orderBy("annee"))


def filter_types(t: Tables) -> DataFrame:
    return (t["local"].where(F.col("type_local").isNotNull()).select("type_local").distinct()
            .orderBy("type_local"))


def filter_departements(t: Tables) -> DataFrame:
    """NULL département is a valid choice and sorts last."""
    return (t["commune"].select("code_departement").distinct()
            .orderBy(F.asc_nulls_last("code_departement")))


def choice(value: str, all_label: str, cast=str):
    """A selector's "all" entry means no filter (None)."""
    return None if value == all_label else cast(value)
