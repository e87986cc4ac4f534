"""Lost, raced and failed publications, remote and copied stores, deltas, year layout, one shuffle per entity append, views after an empty run."""

import shutil
import threading
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from landsales.operators import entities
from landsales.operators.keyed import new_rows
from landsales.plans import load as L
from landsales.plans.load import _manifest_rows, load
from landsales.schemas import DERIVED, KEYS, PUBLISHED
from landsales.sources import fs
from landsales.store import EMPTY, ConcurrentPublication, Store, new_batch

from test_store import _landing, _sale, _snapshot, _write_year


def test_batches_without_a_pointer_are_not_an_empty_store(spark, tmp_path):
    store = Store(spark, str(tmp_path / "lost"))
    store.write_batch("elt_file", _manifest_rows(spark, ["a"]), new_batch(store.state()))
    with pytest.raises(RuntimeError, match="snapshots"):
        store.state()


def test_a_store_has_its_first_snapshot_before_its_first_batch(spark, tmp_path):
    store = Store(spark, str(tmp_path / "new"))
    store.begin()
    store.write_batch("elt_file", _manifest_rows(spark, ["a"]), new_batch(store.state()))   # a load that fails here is invisible
    assert store.state() == EMPTY and store.table("elt_file").count() == 0


def test_a_batch_is_never_written_twice(spark, tmp_path):
    store = Store(spark, str(tmp_path / "once"))
    store.write_batch("elt_file", _manifest_rows(spark, ["a"]), "b")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        store.write_batch("elt_file", _manifest_rows(spark, ["b"]), "b")


def test_of_two_publications_after_one_snapshot_one_fails(spark, tmp_path):
    store = Store(spark, str(tmp_path / "cas"))
    store.begin()
    state = store.state()
    with ThreadPoolExecutor(8) as pool:
        def publish(k):
            try:
                return store.publish(state, [f"batch{k}"])["batches"]
            except ConcurrentPublication:
                return None
        won = [b for b in pool.map(publish, range(8)) if b]
    assert len(won) == 1 and store.state() | {"published_at": 0} == {"snapshot": 1, "batches": won[0], "published_at": 0}
    assert [e.name for e in fs.list_dir(f"{store.root}/snapshots") if not e.name.endswith(".crc")] == \
        ["000000000000.json", "000000000001.json"]                     # and no file left beside them


def test_two_loads_from_one_state_lose_nothing(spark, work):
    land = _landing(work)
    store = Store(spark, f"{work}/two")
    both = threading.Barrier(2, timeout=120)
    publish, first = Store.publish, set()

    def together(self, state, batches):
        if threading.get_ident() not in first:        # both have written all their rows by now
            first.add(threading.get_ident())
            both.wait()
        return publish(self, state, batches)

    Store.publish = together
    try:
        with ThreadPoolExecutor(2) as pool:
            done = list(pool.map(lambda y: L.load(spark, store.root, land, [y], log=lambda m: None), [2022, 2023]))
    finally:
        Store.publish = publish
    assert sorted(r.snapshot for r in done) == [1, 2]
    one = Store(spark, f"{work}/one")
    L.load(spark, one.root, land, [2022, 2023], log=lambda m: None)
    assert _snapshot(store) == _snapshot(one)
    from landsales.plans import reports as R
    for fn in (R.price_evolution, R.type_shares, R.map_departements):
        assert sorted(map(tuple, fn(store.tables()).collect())) == sorted(map(tuple, fn(one.tables()).collect()))


def test_a_failed_publication_leaves_the_snapshot(spark, work, monkeypatch):
    land = _landing(work)
    store = Store(spark, f"{work}/failed")
    L.load(spark, store.root, land, [2022], log=lambda m: None)
    before, state = _snapshot(store), store.state()

    def broken(*_):
        raise OSError("no link")
    monkeypatch.setattr(fs.os, "link", broken)
    with pytest.raises(OSError, match="no link"):
        L.load(spark, store.root, land, [2022, 2023], log=lambda m: None)
    monkeypatch.undo()
    assert store.state() == state and _snapshot(store) == before
    L.load(spark, store.root, land, [2022, 2023], log=lambda m: None)
    assert store.table("mutation").count() == 3


def test_a_store_behind_a_scheme_that_only_spark_reads(spark, work):
    land = _landing(work)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.box.link./data", f"file://{work}")
    L.load(spark, "viewfs://box/data/remote", "viewfs://box/data/landing", [2022], log=lambda m: None)
    far = Store(spark, "viewfs://box/data/remote")
    L.load(spark, far.root, "viewfs://box/data/landing", [2022, 2023], log=lambda m: None)
    assert far.state()["snapshot"] == 2 and far.table("mutation").count() == 3
    assert _snapshot(Store(spark, f"{work}/remote")) == _snapshot(far)
    stale = far.state() | {"snapshot": 1}
    with pytest.raises(ConcurrentPublication):
        far.publish(stale, [])


def test_a_copied_store_reads_its_own_derived_tables(spark, work):
    L.load(spark, f"{work}/here", _landing(work), [2022], log=lambda m: None)
    shutil.copytree(f"{work}/here", f"{work}/copy")
    files = Store(spark, f"{work}/copy").tables()["parcel_surfaces"].inputFiles()
    assert files and all("/copy/" in f for f in files)


def test_what_a_load_derives_grows_with_its_batch(spark, work):
    land = f"{work}/landing"
    many = [_sale(str(k), "01/02/2022", str(100000 + k), plan=str(k), surf=str(20 + k % 50)) for k in range(300)]
    _write_year(land, 2022, many)
    _write_year(land, 2023, [_sale("1", "05/06/2023", "150000", plan="7", surf="33"), _sale("2", "05/06/2023", "9000", plan="900")])
    store = Store(spark, f"{work}/delta")
    L.load(spark, store.root, land, [2022], log=lambda m: None)
    L.load(spark, store.root, land, [2022, 2023], log=lambda m: None)
    first, second = store.state()["batches"]
    rows = {name: [store.derived(name, [b]).count() for b in (first, second)] for name in DERIVED}
    # parcel 7: its new sale meets both premises, its old sale the new one; parcel 900: one pair
    assert rows == {"sale_parcel_types": [300, 3], "parcel_sale_values": [300, 2], "parcel_surfaces": [300, 2]}
    size = lambda b: sum(e.size for n in DERIVED for e in fs.files_below(f"{store.root}/derived/{n}/batch={b}"))
    assert size(second) < size(first)
    from landsales.plans import reports as R
    t, plain = store.tables(), store.tables(store.state()["batches"])
    for fn in (R.kpi, R.price_evolution, R.type_shares, R.top_communes, R.map_departements, R.sale_premises):
        assert sorted(map(tuple, fn(t).collect())) == sorted(map(tuple, fn(plain).collect()))
    assert t["sale_parcel_types"].agg(F.sum("pair_n")).first()[0] == R.sale_premises(t).count()


def _opened(df):
    """The year folders that rows come from."""
    return {r[0].split("/")[-2] for r in df.select(F.input_file_name()).distinct().collect()}


def test_a_year_filter_opens_that_years_files(spark, work):
    store = Store(spark, f"{work}/years")
    L.load(spark, store.root, _landing(work), [2022, 2023], log=lambda m: None)
    from landsales.plans import reports as R
    t = store.tables()
    for df in (R.top_communes(t, "01", 2022), R.kpi(t, 2022), R.sale_premises(t, 2022)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters" in plan and "annee" in plan.split("PartitionFilters", 1)[1][:300]
    assert _opened(t["mutation"].where("annee = 2022")) == {"annee=2022"}


def test_an_append_reads_published_keys_of_its_own_years(spark, work):
    store = Store(spark, f"{work}/keys")
    L.load(spark, store.root, _landing(work), [2022, 2023], log=lambda m: None)
    visible = store.state()["batches"]
    for name in ("mutation", "mutation_parcelle", "local"):
        keys = store.keys(name, visible, [2023])
        assert _opened(keys) == {"annee=2023"}, name
        plan = keys._jdf.queryExecution().executedPlan().toString()
        assert "annee" in plan.split("PartitionFilters", 1)[1].split("]")[0]
        assert store.keys(name, visible, [2024, None]).count() == 0


def test_an_entity_append_shuffles_its_batch_once(spark):
    clean = spark.range(100).select(F.col("id").cast("string").alias("id_parcelle"), F.lit("c").alias("code_commune"))
    published = spark.range(10).select(F.col("id").cast("string").alias("id_parcelle"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = new_rows(entities.parcelle(clean), published, PUBLISHED["parcelle"], KEYS["parcelle"], "parcelle",
                        distinct_keys=True)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2       # the batch and the published keys
        assert rows.count() == 90
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_views_are_registered_by_a_run_with_nothing_new(spark, tmp_path):
    load(spark, str(tmp_path / "store"), str(tmp_path), [], log=lambda *_: None)
    assert spark.sql("SELECT * FROM v_mutations_par_annee").count() == 0
