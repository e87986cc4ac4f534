"""What keeps the build of a snapshot in proportion to its input."""

import gzip
import os
import re

import pytest
from pyspark.sql import functions as F

from landsales.functions.cleaning import clean_rows
from landsales.operators import pairs as P
from landsales.plans import load as L
from landsales.plans import reports as R
from landsales.plans.driver_snapshot import DriverSnapshot
from landsales.plans.sql_surface import register
from landsales.schemas import RAW_COLUMNS
from landsales.sources import fs
from landsales.sources.raw_files import read_lines, read_raw_files
from landsales.store import Store

from test_store import _sale, _write_year

SF = "/root/testdata/sf0.001"


def test_cleaning_is_small_enough_to_be_compiled(spark, work):
    _write_year(work, 2022, [_sale("1", "01/02/2022", "100000")])
    rows = clean_rows(read_lines(spark, [f"{work}/valeursfoncieres-2022.txt"])).drop("adresse_")
    text = rows._jdf.queryExecution().debug().codegenToSeq().mkString("\n")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize: ?=?(\d+)|ByteCodeStats\((\d+)", text) for n in n if n]
    assert sizes and max(sizes) < 8000


def test_types_of_a_parcel_are_not_listed_per_sale(spark, work):
    # parcel 1 has 70 types (two words of bits), parcel 2 one of them; one sale has both parcels
    rows = [_sale(str(k), "01/02/2022", str(1000 + k), typ=f"T{k:02d}", surf=str(10 + k)) for k in range(70)]
    rows += [_sale("0", "01/02/2022", "1000", plan="2", typ="T05", surf="20"), _sale("99", "03/02/2022", "500", plan="2", typ="")]
    _write_year(f"{work}/landing", 2022, rows)
    store = Store(spark, f"{work}/many")
    L.load(spark, store.root, f"{work}/landing", [2022], log=lambda m: None)
    t = store.tables()
    assert t["sale_parcel_types"].count() == 70 + 2
    assert t["sale_parcel_types"].agg(F.sum("pair_n")).first()[0] == 70 * 70 + 2 == R.sale_premises(t).count()
    pairs = {}      # type -> (ratios, sales), from the listing itself
    for r in R.sale_premises(t).collect():
        ratios, sales = pairs.setdefault(r.type_local, ([], set()))
        ratios.append(float(r.valeur_fonciere) / float(r.surface_reelle_bati))
        sales.add(r.id_mutation)
    means = {k: (round(sum(a) / len(a)), len(b)) for k, (a, b) in pairs.items()}
    register(spark, t)
    for got in (R.price_evolution(t), spark.sql("SELECT * FROM v_prix_m2_evolution")):
        assert {r.type_bien: (r.prix_m2_moyen, r.nb_ventes) for r in got.collect()} == means
    for got in (R.type_shares(t, 2022), spark.sql("SELECT * FROM repartition_types(p_annee => 2022)")):
        assert {r.type_bien: r.nb_transactions for r in got.collect()} == {k: n for k, (_, n) in means.items()}
    assert means["T05"][1] == 71 and R.kpi(t, None, "T05").first().nb_ventes == 71


def test_compressed_files_are_read(spark, work):
    with gzip.open(f"{work}/a.txt.gz", "wt", encoding="utf-8") as f:
        f.write("|".join(RAW_COLUMNS) + "\n" + "|".join(_sale("1", "01/02/2022", "5").get(c, "") for c in RAW_COLUMNS) + "\n")
    assert read_raw_files(spark, [f"{work}/a.txt.gz"]).first()["Valeur fonciere"] == "5"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_parts_are_made_when_asked_for(spark, work):
    snap = DriverSnapshot(spark, SF, f"{work}/driver-x", 1998)
    parts = lambda: {e.name for e in fs.list_dir(work) if e.name.startswith("driver-x")}
    assert snap.centres and parts() == {"driver-x-places.json"}
    assert snap.years and parts() == {"driver-x-places.json", "driver-x-raw.json"}
    assert all(e.name.endswith(".gz") for e in fs.data_files(f"{snap.landing}/valeursfoncieres-{snap.years[0]}.txt"))
    assert not fs.exists(f"{snap.landing}.rows")



def test_busy_keys_cost_no_shuffle_of_the_sides(spark, monkeypatch):
    from landsales.operators import hot_join
    monkeypatch.setattr(hot_join, "SHARE_ROWS", 3)
    left = spark.createDataFrame([(k % 4 and "a" or "b", k) for k in range(40)], "k string, x long")
    right = spark.createDataFrame([("a", 100 + k) for k in range(7)] + [("b", 200), (None, 300)], "k string, y long")
    joined = hot_join.hot_join(left, right, "k", "x", "y")
    shuffled = [line for line in joined._jdf.queryExecution().sparkPlan().toString().splitlines() if "Join" in line]
    assert sum("BroadcastHashJoin" in line and "LeftOuter" in line for line in shuffled) == 2
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, left.join(right, "k").select("k", "x", "y").collect()))


def test_tables_without_rows_are_known_to_be_empty(spark, work):
    store = Store(spark, f"{work}/empty")
    for rows in (store.table("mutation", []), store.derived("parcel_surfaces", []), store.rejected_lines([])):
        assert "LocalTableScan <empty>" in rows._jdf.queryExecution().executedPlan().toString() and rows.count() == 0
    assert store.table("mutation", []).dtypes == [("id_mutation", "string"), ("annee", "smallint"), ("date_mutation", "date"),
                                                  ("nature_mutation", "string"), ("valeur_fonciere", "decimal(15,2)")]


def test_links_of_a_sale_are_dealt_together(spark):
    from landsales.operators import entities
    clean = spark.createDataFrame([(f"s{k % 5}", f"p{k % 9}", 2022) for k in range(90)] + [(None, "p1", 2022), ("s1", None, 2022)],
                                  "id_mutation string, id_parcelle string, annee long")
    links = entities.mutation_parcelle(clean)
    assert links.count() == 45
    spread = links.select("id_mutation", F.spark_partition_id().alias("p")).distinct()
    assert spread.count() == 5
    # one shuffle, by the sale
    assert links._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(id_mutation") == 1


def test_a_load_joins_sales_and_links_once(spark, work, monkeypatch):
    from landsales.operators import pairs
    calls = []
    real = pairs.sale_parcels
    monkeypatch.setattr(pairs, "sale_parcels", lambda *a, **k: calls.append(a) or real(*a, **k))
    read = []
    changes = pairs.derived_changes
    monkeypatch.setattr(pairs, "derived_changes", lambda before, added, known, sold, surfaces: read.extend(
        r._jdf.queryExecution().optimizedPlan().toString() for r in (sold, surfaces)) or changes(before, added, known, sold, surfaces))
    _write_year(f"{work}/landing", 2022, [_sale("1", "01/02/2022", "100000"), _sale("1", "01/02/2022", "100000", plan="2"),
                                          _sale("2", "03/02/2022", "500", plan="2")])
    _write_year(f"{work}/landing", 2023, [_sale("3", "03/02/2023", "700", plan="2", surf="44")])
    store = Store(spark, f"{work}/two")
    for years in ([2022], [2022, 2023]):
        L.load(spark, store.root, f"{work}/landing", years, log=lambda m: None)
    assert len(read) == 4 and not any("Join" in plan for plan in read)       # both are read back
    t = store.tables()
    whole = {name: t[name] for name in ("mutation", "mutation_parcelle", "parcelle", "local", "commune")}
    for name, again in (("parcel_sale_values", pairs.parcel_sale_values(whole)), ("parcel_surfaces", pairs.parcel_surfaces(whole))):
        assert sorted(map(str, t[name].collect())) == sorted(map(str, again.select(*t[name].columns).collect()))
    assert t["sale_parcel_types"].agg(F.sum("pair_n")).first()[0] == R.sale_premises(whole).count()
    assert t["mutation"].where("id_mutation rlike '^[0-9a-f]{32}$'").count() == 3
    assert not [e.name for e in fs.list_dir(f"{spark.conf.get('spark.checkpoint.dir')}/landsales") if e.name.startswith("sold-")]


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_lines_of_an_order_lie_together(spark, work):
    from landsales.sources.driver_tables import adapter_sales, stage_years
    rows = adapter_sales(spark, SF)
    joins = [line for line in rows._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join Inner" in line]
    assert "l_orderkey" in joins[0] and "l_partkey" in "".join(joins[1:])      # the last join deals rows by order
    years = stage_years(spark, SF, f"{work}/landing")
    lines = spark.read.text(f"{work}/landing/valeursfoncieres-{years[0]}.txt") \
        .select(F.split("value", r"\|")[0].alias("o"), F.input_file_name().alias("f"))
    assert lines.where("o rlike '^[0-9]+$'").distinct().groupBy("o").count().where("count > 1").count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_hot_kpi_reads_links_and_premises_once(spark):
    import __spark_entry__ as E
    hot = E._hot_tables(spark, SF)
    # the links are dealt by their sale, whose id is 16 bytes, and not once more to join them to sales
    plan = P.sale_parcels(hot)._jdf.queryExecution().executedPlan().toString()
    shuffles = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert shuffles and not any("id_parcelle" in s for s in shuffles) and dict(hot["mutation_parcelle"].dtypes)["id_mutation"] == "binary"
    asked = E.queries()["kpi_hot"](spark, SF)
    plan = asked._jdf.queryExecution().optimizedPlan().toString()
    assert "id_local" not in plan and "nature_mutation" not in plan      # no scan of published sales or premises is left
    assert asked.collect() == R.kpi(hot).collect()
    of_year = L.with_derived(spark, hot)
    assert R.kpi(of_year, 1998, "ECONOMY").collect() == R.kpi(hot, 1998, "ECONOMY").collect()
    assert R.kpi(of_year, 1998).collect() == R.kpi(hot, 1998).collect()


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_lines_are_made_without_a_generator(spark, work):
    from landsales.sources import driver_tables as D
    lines = D.adapter_lines(D.adapter_raw_rows(D.adapter_sales(spark, SF).limit(500)))
    assert "Generate" not in lines._jdf.queryExecution().executedPlan().toString()
    lines.coalesce(1).write.text(f"{work}/lines")
    got = [r.value for r in spark.read.text(f"{work}/lines").collect()]
    header = "|".join(RAW_COLUMNS)
    assert got[0] == header and got.count(header) == 1
    whole = [g for g in got if g.count("|") == header.count("|") and g != header]
    cut = [g for g in got if g.count("|") == 2]
    assert len([g for g in whole if "\ufffd" not in g]) == 500 and len(whole) + len(cut) + 1 == len(got)
    orders = lambda of: sorted(g.split("|")[0] for g in whole if "\ufffd" not in g and g.split("|")[4] == "1"
                               and int(g.split("|")[0]) % of == 0)
    assert sorted(g.split("|")[0] for g in cut) == orders(29)
    assert sorted(g.split("|")[0] for g in whole if "\ufffd" in g) == orders(31)


def test_lines_set_aside_are_staged_unsorted(spark, work, monkeypatch):
    _write_year(f"{work}/landing", 2022, [_sale("1", "01/02/2022", "100000"), _sale("2", "03/02/2022", "500", plan="2")])
    with open(f"{work}/landing/valeursfoncieres-2022.txt", "a", encoding="utf-8") as f:
        f.write("cut|short\n")
    seen = []
    staged = L.staged_rows
    monkeypatch.setattr(L, "staged_rows", lambda raw: seen.append(staged(raw)) or seen[-1])
    layout = []
    real = L.with_premises
    monkeypatch.setattr(L, "with_premises", lambda rows: layout.extend(rows.inputFiles()) or real(rows))
    store = Store(spark, f"{work}/aside")
    assert L.load(spark, store.root, f"{work}/landing", [2022], log=lambda m: None).rejected_rows == 1
    assert layout and not any("=" in f.split("staging-", 1)[1] for f in layout)      # laid out by no column
    assert [r.line for r in store.rejected_lines().collect()] == ["cut|short"] and store.tables()["mutation"].count() == 2
