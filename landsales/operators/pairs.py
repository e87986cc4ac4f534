"""The qualifying (sale, premises) relation and its factorised aggregates.

A qualifying pair is a sale (nature 'Vente', value > 0) linked to a parcel and
a premises (surface > 0) recorded on that same parcel, whatever sale declared
the premises: one sale pairs with every premises ever seen on its parcels.
On a busy parcel the number of pairs is (#sales x #premises), so reports
never materialise pairs. Per parcel (and property type) they carry

    n_prem   = number of qualifying premises
    inv_surf = sum over those premises of 1 / surface

and a sale's pair statistics follow exactly:  sum of value/surface over its
pairs = value * inv_surf, number of pairs = n_prem. Nor are a parcel's types listed for
each of its sales: sums per type are products of the parcel's totals, and the sales of a
type are counted from sets of types held as bits (``kinds_sql``). Only the listing of pairs
itself (R0) lists them; the exact pair median (``selection``) works from
per-parcel value and surface counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landsales.operators.hot_join import hot_join


def _dbl(c: str) -> Column:
    return F.col(c).cast("double")


def qualifying_sales(t: dict[str, DataFrame], year: int | None = None) -> DataFrame:
    m = t["mutation"]
    cond = (F.col("nature_mutation") == "Vente") & (F.col("valeur_fonciere") > 0)
    if year is not None:
        cond = cond & (F.col("annee") == F.lit(year))
    return m.where(cond).select("id_mutation", "annee", "valeur_fonciere")


def qualifying_premises(t: dict[str, DataFrame], property_type: str | None = None) -> DataFrame:
    cond = F.col("surface_reelle_bati") > 0
    if property_type is not None:
        cond = cond & (F.col("type_local") == F.lit(property_type))
    return t["local"].where(cond).select("id_local", "id_parcelle", "type_local", "surface_reelle_bati")


def sale_parcels(t: dict[str, DataFrame], year: int | None = None) -> DataFrame:
    """(id_mutation, annee, valeur_fonciere, id_parcelle) for qualifying sales."""
    return qualifying_sales(t, year).join(t["mutation_parcelle"], "id_mutation")


def parcel_totals(surfaces: DataFrame, parcelle: DataFrame) -> DataFrame:
    """Per parcel: premises count and sum of 1/surface, with the parcel's commune,
    from ``parcel_surfaces`` rows. Grouped before the join: a busy parcel's premises are
    combined map-side and never shuffled one by one."""
    totals = (surfaces.groupBy("id_parcelle")
              .agg(F.sum("b").alias("n_prem"), F.sum(F.col("b") / _dbl("surface_reelle_bati")).alias("inv_surf")))
    return totals.join(parcelle, "id_parcelle")


def _with_pair_sums(sold: DataFrame, totals: DataFrame, links: DataFrame) -> DataFrame:
    """``links`` holds the parcels of the sales, to tell busy ones by."""
    return hot_join(sold, totals, "id_parcelle", "id_mutation", "code_commune", left_keys=links).select(
        "id_mutation", "annee", "valeur_fonciere", "id_parcelle", "code_commune",
        (_dbl("valeur_fonciere") * F.col("inv_surf")).alias("pair_sum"),
        F.col("n_prem").cast("long").alias("pair_n"))


def sale_parcel_types(t: dict[str, DataFrame], year: int | None = None,
                      property_type: str | None = None) -> DataFrame:
    """One row per (sale, parcel) that has at least one pair, with the sale's pair sum of
    value/surface and its pair count on that parcel. With a type: the sales and parcels that
    have a pair of it; the sums are then of all types where a snapshot carries them.

    A published snapshot carries this relation as a derived table, one part per load (the
    parts' sums and counts add up); then it is only scanned, the year's files alone if a
    year is asked for.
    """
    if "sale_parcel_types" in t:
        spt = t["sale_parcel_types"]
        if year is not None:
            spt = spt.where(F.col("annee") == F.lit(year))
        if property_type is not None:
            of_type = t["parcel_surfaces"].where(F.col("type_local") == F.lit(property_type))
            spt = spt.join(of_type.select("id_parcelle"), "id_parcelle", "left_semi")
        return spt
    surfaces = parcel_surfaces(t)
    if property_type is not None:
        surfaces = surfaces.where(F.col("type_local") == F.lit(property_type))
    return _with_pair_sums(sale_parcels(t, year), parcel_totals(surfaces, t["parcelle"]),
                           t["mutation_parcelle"])


#: Types per word of a set held as bits.
WORD = 63


def kinds_sql(links: str, surfaces: str, where: str = "TRUE") -> list[str]:
    """CTEs that end in ``kinds`` (annee, type_local, n): the distinct sales of each type, from
    the relations sale_parcel_types and parcel_surfaces and a condition on the former.

    A sale has the types of all its parcels. Each parcel's set of types is a few words of
    bits; a sale's set is their union, so one row per link and word is shuffled, however many
    types a parcel has."""
    return [
        f"kind AS (SELECT type_local, row_number() OVER (ORDER BY type_local) - 1 AS k FROM "
        f"(SELECT DISTINCT type_local FROM {surfaces} WHERE type_local IS NOT NULL))",
        f"parcel_kinds AS (SELECT s.id_parcelle, k div {WORD} AS word, bit_or(shiftleft(1L, k % {WORD})) AS bits "
        f"FROM {surfaces} s JOIN kind ON s.type_local = kind.type_local GROUP BY 1, 2)",
        f"sale_kinds AS (SELECT l.annee, l.id_mutation, p.word, bit_or(p.bits) AS bits "
        f"FROM (SELECT annee, id_mutation, id_parcelle FROM {links} WHERE {where}) l "
        f"JOIN parcel_kinds p ON l.id_parcelle = p.id_parcelle GROUP BY 1, 2, 3)",
        f"counted AS (SELECT annee, word * {WORD} + bit AS k, count(*) AS n FROM sale_kinds LATERAL VIEW "
        f"explode(filter(sequence(0, {WORD - 1}), b -> getbit(bits, b) = 1)) t AS bit GROUP BY 1, 2)",
        "kinds AS (SELECT c.annee, kind.type_local, c.n FROM counted c JOIN kind ON c.k = kind.k)",
    ]


def pairs(t: dict[str, DataFrame], year: int | None = None,
          property_type: str | None = None) -> DataFrame:
    """The qualifying pairs themselves (output-sized by definition). A busy parcel's sales
    and premises meet in blocks, not in one task."""
    premises = qualifying_premises(t, property_type)
    placed = premises.join(t["parcelle"], "id_parcelle")
    return hot_join(sale_parcels(t, year), placed, "id_parcelle", "id_mutation", "id_local",
                    t["mutation_parcelle"], premises).select(
        "id_mutation", "annee", "valeur_fonciere", "type_local", "surface_reelle_bati",
        "code_commune")


def parcel_sale_values(t: dict[str, DataFrame]) -> DataFrame:
    """Qualifying sales per (parcel, year, value), with their count ``a``."""
    return _sale_values(sale_parcels(t))


def _sale_values(sold: DataFrame) -> DataFrame:
    return sold.groupBy("id_parcelle", "annee", "valeur_fonciere").agg(F.count(F.lit(1)).alias("a"))


def parcel_surfaces(t: dict[str, DataFrame]) -> DataFrame:
    """Qualifying premises per (parcel, type, surface), with their count ``b``."""
    per_surface = (qualifying_premises(t).groupBy("id_parcelle", "type_local", "surface_reelle_bati")
                   .agg(F.count(F.lit(1)).alias("b")))
    return per_surface.join(t["parcelle"].select("id_parcelle"), "id_parcelle", "left_semi")


def derived_of(sold: DataFrame, surfaces: DataFrame, parcelle: DataFrame) -> dict[str, DataFrame]:
    """The derived tables of sales, from ``sale_parcels`` and ``parcel_surfaces`` rows. Both are
    read several times: they should be written, not computed anew each time."""
    return {"parcel_sale_values": _sale_values(sold),
            "sale_parcel_types": _with_pair_sums(sold, parcel_totals(surfaces, parcelle), sold)}


def _with_added(before: dict[str, DataFrame], added: dict[str, DataFrame], name: str) -> DataFrame:
    return before[name].unionByName(added[name])


def new_links_sold(before: dict[str, DataFrame], added: dict[str, DataFrame], years: list[int | None]) -> DataFrame:
    """The qualifying sales of a load's new links, whose sales are of ``years``."""
    in_years = F.col("annee").isin([y for y in years if y is not None]) | F.col("annee").isNull()
    return sale_parcels({"mutation": _with_added(before, added, "mutation").where(in_years),
                         "mutation_parcelle": added["mutation_parcelle"]})


def new_surfaces(before: dict[str, DataFrame], added: dict[str, DataFrame]) -> DataFrame:
    """``parcel_surfaces`` of a load's new premises."""
    return parcel_surfaces({"local": added["local"], "parcelle": _with_added(before, added, "parcelle")})


def derived_changes(before: dict[str, DataFrame], added: dict[str, DataFrame], known_surfaces: DataFrame,
                    sold: DataFrame, surfaces: DataFrame) -> dict[str, DataFrame]:
    """What a load adds to the derived tables of sales, from the tables before it, its own rows,
    the ``parcel_surfaces`` rows before it, ``new_links_sold`` and ``new_surfaces``. The last
    two are read several times: they should be written, not computed anew each time.

    New sales meet all premises of their parcels, old sales the new premises; every other
    pair stands in earlier parts. Each part is written once: what a load writes grows with
    its own rows and the sales they meet, not with the store. A link is published with or
    after its sale and a premises with or after its parcel, so new links and new premises
    are all there is to join.
    """
    met = known_surfaces.join(sold.select("id_parcelle").distinct(), "id_parcelle", "left_semi")
    old_links = before["mutation_parcelle"].join(surfaces.select("id_parcelle").distinct(), "id_parcelle", "left_semi")
    old_sold = sale_parcels({"mutation": before["mutation"], "mutation_parcelle": old_links})
    totals = lambda rows: parcel_totals(rows, _with_added(before, added, "parcelle"))
    return {
        "parcel_sale_values": _sale_values(sold),
        "sale_parcel_types": _with_pair_sums(sold, totals(surfaces.unionByName(met)), sold)
        .unionByName(_with_pair_sums(old_sold, totals(surfaces), old_links)),
    }
