"""

``entry(spark)`` runs the flagship query (the sales KPI) on sf0.001;
``queries()`` maps every implemented operator/report to a callable
``(spark, sf_dir) -> DataFrame``; ``oracle_sql()`` gives, for the same keys,
independent DuckDB SQL over the driver's tables. Column names match.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landsales.functions.cleaning import clean_rows
from landsales.functions.display import kpi_text
from landsales.plans import layers as Ly
from landsales.plans import reports as R
from landsales.plans.driver_snapshot import CENTRES_MARKER, snapshot_for, year_files
from landsales.plans.load import load, packed, pending_frame, table_counts, with_derived
from landsales.plans.sql_surface import register
from landsales.plans.oracle_sql import (EMPTY_YEAR, HOT_PARCEL, KPI_TYPE, KPI_YEAR, SPLIT_YEAR, TOP_DEPT,
                                        oracle_queries)
from landsales.schemas import PUBLISHED, RAW_COLUMNS
from landsales.session import new_work_dir
from landsales.sources.geo import first_source_wins, read_commune_centres, read_outlines
from landsales.sources.raw_files import RAW_FILE_WORD, collect_year_files, read_raw_files, year_marker
from landsales.store import Store

try:        # the training-data operators are optional: the rest works without them
    import corpus_pipeline
    from landsales.llm import queries as training_data
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "landsales.llm"):
        raise       # a library that they need, not the operators themselves
    training_data = None

FLAGSHIP_SF = "/root/testdata/sf0.001"


def _tables(spark: SparkSession, sf_dir: str):
    return snapshot_for(spark, sf_dir, SPLIT_YEAR).store.tables()


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_raw_files(spark, year_files(snapshot_for(spark, sf_dir, SPLIT_YEAR)))


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_rows(_raw(spark, sf_dir))


def _report(fn, *args):
    return lambda spark, sf_dir: fn(_tables(spark, sf_dir), *args)


def _incremental_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    snap = snapshot_for(spark, sf_dir, SPLIT_YEAR)
    first_batch = snap.split_store.state()["batches"][:1]
    manifest = snap.split_store.table("elt_file", first_batch)
    wanted = [year_marker(y) for y in snap.years] + [CENTRES_MARKER]
    return pending_frame(spark, manifest, wanted).select("filename")


def _load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    snap = snapshot_for(spark, sf_dir, SPLIT_YEAR)
    raw = _raw(spark, sf_dir).agg(F.count(F.lit(1)).alias("rows")) \
        .select(F.lit("raw_rows").alias("table_name"), "rows")
    counts = table_counts(snap.store).where(F.col("table_name") != "elt_file")
    return raw.unionByName(counts)


def _hot_tables(spark: SparkSession, sf_dir: str):
    """The published tables with a third of all sales and premises on one parcel."""
    t = dict(_tables(spark, sf_dir))
    hot = lambda key: F.when(F.substring(key, -1, 1) < "5", HOT_PARCEL).otherwise(F.col("id_parcelle"))
    # dealt by the sale, as they are then joined: one shuffle of the links
    t["mutation_parcelle"] = packed({"links": t["mutation_parcelle"].withColumn("id_parcelle", hot("id_mutation"))})["links"] \
        .repartition("id_mutation").distinct()
    t["mutation"] = packed(t)["mutation"]
    t["local"] = t["local"].withColumn("id_parcelle", hot("id_local"))
    t["parcelle"] = t["parcelle"].unionByName(
        spark.range(1).select(F.lit(HOT_PARCEL).alias("id_parcelle"), F.lit(HOT_PARCEL[:5]).alias("code_commune")))
    return {name: t[name] for name in PUBLISHED}


def _split_state(spark: SparkSession, sf_dir: str):
    """The store filled by two loads, and its state after each of them."""
    store = snapshot_for(spark, sf_dir, SPLIT_YEAR).split_store
    batches = store.state()["batches"]
    return store, batches[:1], batches


def _rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw lines set aside, by file, reason and first field."""
    lines = snapshot_for(spark, sf_dir, SPLIT_YEAR).store.rejected_lines()
    folder = F.element_at(F.split("file", "/"), -2)
    return lines.select(folder.alias("file"), "reason", F.substring_index("line", "|", 1).alias("first_field"))


def _centres_two_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: communes of two sources; the first one's centre wins."""
    snap = snapshot_for(spark, sf_dir, SPLIT_YEAR)
    return first_source_wins([read_commune_centres(spark, path, json_array=False)
                              for path in (snap.centres, snap.more_centres)])


def _source_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The file found for each year and for one that has none, with its lines."""
    snap = snapshot_for(spark, sf_dir, SPLIT_YEAR)
    found = collect_year_files(snap.landing, [EMPTY_YEAR, *snap.years], lambda _: None)
    out = None
    for year, path in found.items():
        rows = read_raw_files(spark, [path]).agg(F.count(F.lit(1)).alias("rows"))
        rows = rows.select(F.lit(year).alias("annee"), F.lit(path.rsplit("/", 1)[-1]).alias("filename"), "rows")
        out = rows if out is None else out.unionByName(rows)
    return out


def _snapshot_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales and manifest rows seen before any load, after the first and the
    second, after a load with nothing new, and after a full reload of the late years."""
    snap = snapshot_for(spark, sf_dir, SPLIT_YEAR)
    store, first, both = _split_state(spark, sf_dir)
    late = [y for y in snap.years if y > SPLIT_YEAR]
    again = Store(spark, new_work_dir(spark, "reload"))
    load(spark, again.root, snap.landing, snap.years, log=lambda _: None)
    same = again.state()["batches"]
    load(spark, again.root, snap.landing, snap.years, log=lambda _: None)
    republished = again.state()["batches"]
    load(spark, again.root, snap.landing, late, full_reload=True, log=lambda _: None)
    steps = [("empty", store, []), ("first", store, first), ("second", store, both), ("one_load", again, same),
             ("nothing_new", again, republished), ("full_reload", again, again.state()["batches"])]
    out = None
    for name, of, batches in steps:
        files = of.table("elt_file", batches).where(F.col("filename").startswith(RAW_FILE_WORD)).agg(F.count("loaded_at"))
        row = of.table("mutation", batches).agg(F.count(F.lit(1)).alias("sales")) \
            .select(F.lit(name).alias("step"), "sales", files.scalar().alias("files"))
        out = row if out is None else out.unionByName(row)
    return out


def _chosen_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A selector's "all" entries mean no filter, its others one; the KPI as display
    texts, the years of the evolution as labels."""
    t = _tables(spark, sf_dir)
    out = None
    for picked in ("Toutes", str(KPI_YEAR)):
        kpi = R.kpi(t, R.choice(picked, "Toutes", int), R.choice("Tous", "Tous"))
        row = kpi.select(F.lit(picked).alias("part"), *kpi_text(*[F.col(c) for c in kpi.columns]))
        out = row if out is None else out.unionByName(row)
    labels = Ly.year_labels(R.price_evolution(t)).groupBy("annee").agg(F.count(F.lit(1)).cast("string").alias("n"))
    absent = [F.lit(None).cast("string").alias(c) for c in out.columns[2:]]
    return out.unionByName(labels.select(F.col("annee").alias("part"), F.col("n").alias(out.columns[1]), *absent))


def _incremental_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three reports of a store filled by two loads, from the derived tables that the second
    load added to: year and type, or commune, with sales and mean price per m2."""
    t = snapshot_for(spark, sf_dir, SPLIT_YEAR).split_store.tables()
    by_type = R.price_evolution(t).select(F.lit("evolution").alias("report"), F.col("annee").cast("string").alias("part"),
                                          F.col("type_bien").alias("item"), "nb_ventes", F.col("prix_m2_moyen").alias("value"))
    by_dept = R.map_departements(t).select(F.lit("departements"), F.col("dept"), F.lit(None).cast("string"), "nb_ventes",
                                           "prix_m2_moyen")
    kpi = R.kpi(t).select(F.lit("kpi"), F.lit(None).cast("string"), F.lit(None).cast("string"), "nb_ventes",
                          "prix_m2_median_eur")
    return by_type.union(by_dept).union(kpi)


def _choropleth(spark: SparkSession, sf_dir: str) -> DataFrame:
    snap = snapshot_for(spark, sf_dir, SPLIT_YEAR)
    layer = Ly.choropleth(snap.store.tables(), read_outlines(spark, snap.outlines))
    return layer.drop("geometry")


def _sql(statement: str):
    """A report through the SQL surface (views + SQL table functions)."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        register(spark, _tables(spark, sf_dir))
        return spark.sql(statement)
    return run


# SQL-surface twins of DataFrame reports: key -> (statement, key of the twin).
SQL_TWINS = {
    "sql_kpi": ("SELECT * FROM kpi_ventes()", "kpi"),
    "sql_kpi_year": (f"SELECT * FROM kpi_ventes(p_annee => {KPI_YEAR})", "kpi_year"),
    "sql_kpi_type": (f"SELECT * FROM kpi_ventes(p_type => '{KPI_TYPE}')", "kpi_type"),
    "sql_price_evolution": ("SELECT * FROM v_prix_m2_evolution", "price_evolution"),
    "sql_sales_per_year": ("SELECT * FROM v_mutations_par_annee", "sales_per_year"),
    "sql_type_shares_year": (f"SELECT * FROM repartition_types(p_annee => {KPI_YEAR})", "type_shares_year"),
    "sql_top_communes_dept": (f"SELECT * FROM top_communes(p_departement => '{TOP_DEPT}', "
                              f"p_annee => {KPI_YEAR})", "top_communes_dept"),
    "sql_map_communes_dept": (f"SELECT * FROM carte_communes(p_annee => {KPI_YEAR}, "
                              f"p_departement => '{TOP_DEPT}')", "map_communes_dept"),
    "sql_map_departements": ("SELECT * FROM carte_departements()", "map_departements"),
    "sql_sale_premises": ("SELECT * FROM v_vente_local", "sale_premises"),
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the sales KPI over the whole sf0.001 snapshot (one row)."""
    return R.kpi(_tables(spark, FLAGSHIP_SF))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    clean_cols = ["code_commune", "nom_commune", "code_departement", "code_postal", "id_parcelle",
                  "id_mutation", "annee", "date_mutation", "nature_mutation", "valeur_fonciere",
                  "id_local", "type_local", "surface_reelle_bati", "nombre_pieces_principales"]
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        "raw_scan": lambda s, d: _raw(s, d).select(*[F.col(f"`{c}`") for c in RAW_COLUMNS]),
        "clean_rows": lambda s, d: _clean(s, d).select(*clean_cols),
        "clean_address": lambda s, d: _clean(s, d).select("adresse_"),
        "synth_ids": lambda s, d: _clean(s, d).select("code_commune", "id_parcelle", "id_mutation", "id_local"),
        "parse_dates": lambda s, d: _clean(s, d).select("annee", "date_mutation"),
        "parse_numbers": lambda s, d: _clean(s, d).select("valeur_fonciere", "surface_reelle_bati",
                                                           "nombre_pieces_principales"),
    }
    for name in ["commune", "parcelle", "mutation", "mutation_parcelle", "local"]:
        q[f"entity_{name}"] = (lambda n: lambda s, d: _tables(s, d)[n])(name)
    q["commune_geo"] = lambda s, d: _tables(s, d)["commune_geo"]
    q["keyed_append"] = lambda s, d: snapshot_for(s, d, SPLIT_YEAR).split_store.table("mutation")
    q["incremental_selection"] = _incremental_selection
    q["load_report"] = _load_report
    q["sale_premises"] = _report(R.sale_premises)
    q["kpi"] = _report(R.kpi)
    q["kpi_year"] = _report(R.kpi, KPI_YEAR)
    q["kpi_type"] = _report(R.kpi, None, KPI_TYPE)
    q["kpi_empty"] = _report(R.kpi, EMPTY_YEAR)
    q["kpi_hot"] = lambda s, d: R.kpi(with_derived(s, _hot_tables(s, d)))
    q["kpi_hot_empty"] = lambda s, d: R.kpi(_hot_tables(s, d), EMPTY_YEAR)
    q["incremental_reports"] = _incremental_reports
    q["rejects"] = _rejects
    q["centres_two_sources"] = _centres_two_sources
    q["source_files"] = _source_files
    q["snapshot_steps"] = _snapshot_steps
    q["chosen_reports"] = _chosen_reports
    q["price_evolution"] = _report(R.price_evolution)
    q["sales_per_year"] = _report(R.sales_per_year)
    q["type_shares"] = _report(R.type_shares)
    q["type_shares_year"] = _report(R.type_shares, KPI_YEAR)
    q["top_communes"] = _report(R.top_communes)
    q["top_communes_dept"] = _report(R.top_communes, TOP_DEPT, KPI_YEAR)
    q["map_communes"] = _report(R.map_communes)
    q["map_communes_dept"] = _report(R.map_communes, KPI_YEAR, TOP_DEPT)
    q["map_departements"] = _report(R.map_departements)
    q["map_departements_year"] = _report(R.map_departements, KPI_YEAR)
    q["filter_years"] = _report(R.filter_years)
    q["filter_types"] = _report(R.filter_types)
    q["filter_departements"] = _report(R.filter_departements)
    q["choropleth"] = _choropleth
    q["badges"] = _report(Ly.badges)
    q["commune_bubbles"] = _report(Ly.commune_bubbles, None, TOP_DEPT)
    q["map_view"] = _report(Ly.map_view, None, TOP_DEPT)
    for key, (statement, _twin) in SQL_TWINS.items():
        q[key] = _sql(statement)
    if training_data is not None:
        q["pipeline"] = corpus_pipeline.run
        q.update(training_data.queries())
    return q


def oracle_sql() -> dict[str, str]:
    oracle = oracle_queries()
    for key, (_statement, twin) in SQL_TWINS.items():
        oracle[key] = oracle[twin]
    if training_data is not None:
        oracle.update(training_data.oracle_sql())
        if corpus_pipeline.ORACLE_SQL is not None:
            oracle["pipeline"] = corpus_pipeline.ORACLE_SQL
    return oracle
