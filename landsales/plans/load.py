"""The batch load: raw files -> clean rows -> five entities -> new snapshot.

Mirrors the reference run: choose what is not yet in the manifest (K5), read
centres (S5, K3) and the yearly raw files (S1-S4), clean and derive entities
(F*, E*), append by key (K1, K2), record the manifest (K4), then publish the
snapshot in one switch (K6). Nothing new still republishes; every run points the
session's views and table functions at the current snapshot (K7).
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from landsales.functions.cleaning import staged_rows, with_premises
from landsales.operators import entities, pairs
from landsales.operators.keyed import new_rows
from landsales.plans.sql_surface import register_views
from landsales.schemas import ENTITY_TABLES, KEYS, PUBLISHED, YEAR
from landsales.sources.geo import first_source_wins, read_commune_centres
from landsales.sources.raw_files import FILE, LINE, REASON, collect_year_files, read_lines, year_marker
from landsales.session import new_work_dir
from landsales.sources import fs
from landsales.store import ConcurrentPublication, Store, new_batch


@dataclass(frozen=True)
class CentreSource:
    marker: str          # canonical manifest name
    path: str
    json_array: bool = True


class RejectedLines(RuntimeError):
    """More raw lines than allowed can't be read."""


@dataclass
class LoadResult:
    snapshot: int
    years: list[int] = field(default_factory=list)
    centre_markers: list[str] = field(default_factory=list)
    raw_rows: int = 0
    rejected_rows: int = 0
    seconds: dict[str, float] = field(default_factory=dict)


def pending_frame(spark: SparkSession, manifest: DataFrame, wanted: list[str]) -> DataFrame:
    """K5: wanted markers absent from the manifest, with their wanted order.

    The wanted list is the caller's (a handful of file names); the manifest is
    a Spark table, compared by ``left_anti``.
    """
    want = unnest(spark, wanted).select(F.col("value").alias("filename"), F.col("pos").alias("ord"))
    return want.join(manifest.select("filename"), "filename", "left_anti")


def unnest(spark: SparkSession, names: list[str]) -> DataFrame:
    """Rows (pos, value) from a bound list, built JVM-side (no Python
    data path), like SQL ``unnest`` of a list parameter."""
    arr = F.array(*[F.lit(n) for n in names]) if names else F.array().cast("array<string>")
    return spark.range(1).select(F.posexplode(arr).alias("pos", "value"))


def pending_markers(spark: SparkSession, manifest: DataFrame, wanted: list[str]) -> list[str]:
    if not wanted:
        return []
    return [r.filename for r in pending_frame(spark, manifest, wanted).orderBy("ord").collect()]


def _manifest_rows(spark: SparkSession, markers: list[str]) -> DataFrame:
    """S8 + K4: one manifest row per marker, load time defaulted to now."""
    return unnest(spark, markers).select(F.col("value").alias("filename"),
                                         F.current_timestamp().alias("loaded_at"))


#: Loads of one store at once: how often one starts anew after another has published.
ATTEMPTS = 5


def load(spark: SparkSession, store_root: str, landing: str, years: list[int],
         centres: list[CentreSource] = (), full_reload: bool = False,
         quote: str | None = None, log=print, max_rejected: int | None = None) -> LoadResult:
    """Load what the manifest lacks and publish. Raw lines that can't be read are set aside in
    ``Store.rejected_lines``; more than ``max_rejected`` of them (0: any) are an error. If
    another load publishes meanwhile, this one starts anew from the new snapshot: what it
    had written is not visible to anybody."""
    return retried(lambda: _load(spark, store_root, landing, years, centres, full_reload, quote, log,
                                 max_rejected), log)


def retried(run, log=print):
    for attempt in range(1, ATTEMPTS + 1):
        try:
            return run()
        except ConcurrentPublication as conflict:
            if attempt == ATTEMPTS:
                raise
            log(f"[INFO] {conflict}; starting anew")


def _load(spark: SparkSession, store_root: str, landing: str, years: list[int], centres: list[CentreSource],
          full_reload: bool, quote: str | None, log, max_rejected: int | None) -> LoadResult:
    store = Store(spark, store_root)
    state = store.state()
    visible = [] if full_reload else list(state["batches"])
    manifest = store.table("elt_file", visible)

    wanted = [year_marker(y) for y in sorted(years)] + [c.marker for c in centres]
    pending = set(pending_markers(spark, manifest, wanted))
    todo_years = [y for y in sorted(years) if year_marker(y) in pending]
    todo_centres = [c for c in centres if c.marker in pending]

    if not todo_years and not todo_centres:
        published = store.publish(state, visible)
        register_views(spark, store)
        log("[SUCCESS] up to date, nothing to ingest")
        return LoadResult(snapshot=published["snapshot"])

    paths = collect_year_files(landing, todo_years, log) if todo_years else {}
    if todo_years and not paths:
        raise RuntimeError("no raw file available, aborting; nothing was published")

    geo = None
    if todo_centres:
        geo = first_source_wins([read_commune_centres(spark, c.path, c.json_array)
                                 for c in todo_centres])
    files, parts = unread_parts(spark, manifest, paths)
    raw = read_lines(spark, files, quote) if files else None
    markers = [c.marker for c in todo_centres] + parts + [year_marker(y) for y in paths]
    result = append_batch(spark, store, state, visible, raw, geo, markers, log, max_rejected)
    t0 = time.monotonic()
    register_views(spark, store)
    result.seconds["register_views"] = time.monotonic() - t0
    result.years = sorted(paths)
    result.centre_markers = [c.marker for c in todo_centres]
    return result


def unread_parts(spark: SparkSession, manifest: DataFrame, paths: dict[int, str]) -> tuple[list[str], list[str]]:
    """Files to read for the years, and their manifest names where a year's folder has been read
    in part (by a stream): its other parts only. A year is in the manifest when all its parts are."""
    begun = {r[0] for r in manifest.where(F.col("filename").contains("/")).select(
        F.substring_index("filename", "/", 1)).distinct().collect()}
    files, names = [], []
    for path in paths.values():
        if fs.base_name(path) not in begun:
            files.append(path)
            continue
        parts = {fs.part_name(e.path): e.path for e in fs.data_files(path)}
        todo = pending_markers(spark, manifest, list(parts))
        files += [parts[n] for n in todo]
        names += todo
    return files, names


def append_batch(spark: SparkSession, store: Store, state: dict, visible: list[str], raw: DataFrame | None,
                 centres: DataFrame | None, markers: list[str], log=print,
                 max_rejected: int | None = None) -> LoadResult:
    """Clean, derive, append by key and publish one batch (K1, K2, K4, K6).

    ``raw`` holds raw text rows with the lines set aside (``read_lines``), ``centres`` the
    (code_commune, latitude, longitude) rows; either may be None. ``state`` is the snapshot
    that the batch follows, ``visible`` the batches it adds to. Replaying a batch is
    harmless: every table is appended by key, existing rows win.
    """
    store.begin()
    batch = new_batch(state)
    result = LoadResult(snapshot=0)

    # Independent table writes of this load, run as concurrent Spark jobs
    # (they share the executors; each only reads its own inputs).
    writes: list[tuple[str, DataFrame]] = [
        ("elt_file", new_rows(_manifest_rows(spark, markers), store.keys("elt_file", visible),
                              PUBLISHED["elt_file"], KEYS["elt_file"], "elt_file"))]
    if centres is not None:
        writes.append(("commune_geo", new_rows(centres, store.keys("commune_geo", visible),
                                               PUBLISHED["commune_geo"], KEYS["commune_geo"],
                                               "commune_geo")))
    staging = None
    if raw is not None:
        t0 = time.monotonic()
        obs = Observation("raw")
        raw = raw.observe(obs, F.count(F.lit(1)).alias("rows"), F.count(REASON).alias("rejected"))
        # The clean rows feed five entities: parse and hash them once into a
        # staged Parquet table in the shared checkpoint folder (one pass that
        # also yields the K9 counts and the lines set aside). Each entity then
        # reads only its columns, and a lost executor re-reads files instead of
        # re-parsing raw text.
        staging = new_work_dir(spark, "staging")
        rows = staged_rows(raw)
        rows.write.option("compression", "zstd").parquet(staging)       # by no column: that would sort all rows
        staged = spark.read.schema(rows.schema).parquet(staging)
        clean = with_premises(staged.where(F.col(REASON).isNull()).drop(REASON, FILE, LINE))
        result.seconds["load"] = time.monotonic() - t0
        metrics = obs.get
        result.rejected_rows = int(metrics.get("rejected") or 0)
        result.raw_rows = int(metrics.get("rows") or 0) - result.rejected_rows
        if max_rejected is not None and result.rejected_rows > max_rejected:
            fs.delete_tree(staging)
            raise RejectedLines(f"{result.rejected_rows:,} raw lines can't be read ({max_rejected:,} allowed); nothing was published")
        if result.rejected_rows:
            store.write_rejected(staged.where(F.col(REASON).isNotNull()).select(
                F.col(FILE).alias("file"), F.col(REASON).alias("reason"), F.col(LINE).alias("line")), batch)
        # Keys of sales hold their year: only published rows of these years can have them.
        years = [r[0] for r in clean.select(YEAR).distinct().collect()]
        built = entities.derive(clean)
        for name in ENTITY_TABLES:
            writes.append((name, new_rows(built[name], store.keys(name, visible, years), PUBLISHED[name],
                                          KEYS[name], name, distinct_keys=True)))

    t0 = time.monotonic()
    try:
        _at_once(writes, lambda name, rows: store.write_batch(name, rows, batch), "publish", result)
    finally:
        if staging is not None:
            fs.delete_tree(staging)
    result.seconds["transform_publish"] = time.monotonic() - t0
    if raw is not None:
        log(f"loaded {result.raw_rows:,} raw rows ({result.rejected_rows:,} rejected)")
        t0 = time.monotonic()
        _derive(spark, store, visible, batch, years, result)
        result.seconds["derive"] = time.monotonic() - t0

    result.snapshot = store.publish(state, visible + [batch])["snapshot"]
    return result


def _derive(spark: SparkSession, store: Store, visible: list[str], batch: str, years: list[int | None],
            result: LoadResult) -> None:
    """Write what a batch adds to the derived tables. Its sales with their parcels and its
    premises per parcel are written first, the former to a scratch folder: both are needed
    more than once."""
    before, added = packed(store.tables(visible)), packed(store.tables([batch]))
    scratch = new_work_dir(spark, "sold")
    sold = pairs.new_links_sold(before, added, years)
    try:
        _at_once([("parcel_surfaces", pairs.new_surfaces(before, added)), ("sold", sold)],
                 lambda name, rows: store.write_derived(name, rows, batch) if name != "sold"
                 else rows.write.option("compression", "zstd").parquet(scratch), "derive", result)
        changes = pairs.derived_changes(before, added, store.derived("parcel_surfaces", visible),
                                        spark.read.schema(sold.schema).parquet(scratch),
                                        store.derived("parcel_surfaces", [batch]))
        links = changes["sale_parcel_types"]
        changes["sale_parcel_types"] = links.withColumn("id_mutation", F.lower(F.hex("id_mutation")))
        _at_once(list(changes.items()), lambda name, rows: store.write_derived(name, rows, batch), "derive", result)
    finally:
        fs.delete_tree(scratch)


def with_derived(spark: SparkSession, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Published tables with their derived ones, as a load of all of them would leave. What a
    report reads several times is written once to a work folder, and the sales with their
    parcels too, which two of them are made from; ``sale_parcel_types`` is read once and is not."""
    folder = new_work_dir(spark, "derived")

    def written(**rows: DataFrame) -> list[DataFrame]:
        _at_once(list(rows.items()), lambda name, part: part.write.option("compression", "zstd").parquet(f"{folder}/{name}"),
                 "derive", LoadResult(snapshot=0))
        return [spark.read.schema(part.schema).parquet(f"{folder}/{name}") for name, part in rows.items()]

    sold, surfaces = written(sold=pairs.sale_parcels(tables), parcel_surfaces=pairs.parcel_surfaces(tables))
    derived = pairs.derived_of(sold, surfaces, tables["parcelle"])
    [values] = written(parcel_sale_values=derived["parcel_sale_values"])
    return tables | derived | {"parcel_surfaces": surfaces, "parcel_sale_values": values}


def packed(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Published tables with the ids of sales as the 16 bytes that their text spells: half of what
    a shuffle would move. They are made by ``cleaning.hash_id``."""
    return {name: rows.withColumn("id_mutation", F.unhex("id_mutation")) if "id_mutation" in rows.columns else rows
            for name, rows in tables.items()}


def _at_once(items: list[tuple[str, DataFrame]], write, label: str, result: LoadResult) -> None:
    """Write several tables as concurrent jobs and note the seconds of each."""
    def timed(item: tuple[str, DataFrame]) -> None:
        t0 = time.monotonic()
        write(*item)
        result.seconds[f"{label}_{item[0]}"] = time.monotonic() - t0

    with ThreadPoolExecutor(max_workers=max(1, len(items))) as pool:
        list(pool.map(timed, items))


def table_counts(store: Store) -> DataFrame:
    """K9: rows per published table (one Spark count per table)."""
    frames = [store.table(name).agg(F.count(F.lit(1)).alias("rows"))
              .select(F.lit(name).alias("table_name"), "rows") for name in PUBLISHED]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
