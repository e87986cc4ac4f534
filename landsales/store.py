"""An append-only store of published tables with atomic snapshots.

Layout under ``root``::

    tables/<table>/batch=<name>/[annee=<year>/]part-*.parquet    one folder per load
    derived/<table>/batch=<name>/[annee=<year>/]part-*.parquet   what the load adds to the derived tables
    rejects/rejected_lines/batch=<name>/part-*.parquet           raw lines that the load set aside
    snapshots/<number>.json                                      {"snapshot": s, "batches": [..]}

A load writes only its *new* rows, below a batch name that no other load has, and then
publishes the next snapshot by creating its file. Of two loads that start from the same
snapshot one creates the file; the other one gets ``ConcurrentPublication``, and its
folders stay invisible. Nothing published is ever rewritten, copied or shared by loads.
Readers keep the visible batches with a partition filter, so files of a failed or
running load are pruned before any is opened. A full reload publishes a snapshot whose
batch list starts empty.

Tables of sales are laid out by the sale's year (``LAYOUT``), also where the year is no
published column: a year filter opens that year's files only, and an append looks up
its keys among the rows of its own years.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landsales.schemas import DERIVED, KEYS, LAYOUT, PUBLISHED, REJECTED, YEAR, empty_rows, empty_table
from landsales.sources import fs

SNAPSHOTS = "snapshots"
BATCH = "batch"
EMPTY = {"snapshot": 0, "batches": []}

# Order of a table's rows inside each written file, for row-group statistics.
SORT_WITHIN = {"sale_parcel_types": ["code_commune"], "parcel_surfaces": ["type_local"]}


class ConcurrentPublication(RuntimeError):
    """Another load published a snapshot since this one read the store."""


def new_batch(state: dict) -> str:
    """A batch name that no other load uses; names sort by the snapshot they follow."""
    return f"{state['snapshot'] + 1:08d}-{uuid.uuid4().hex[:12]}"


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # --- snapshots ----------------------------------------------------------
    def _pointer(self, snapshot: int) -> str:
        return f"{self.root}/{SNAPSHOTS}/{snapshot:012d}.json"

    def state(self) -> dict:
        """The latest snapshot."""
        numbers = [e.name for e in fs.list_dir(f"{self.root}/{SNAPSHOTS}") if e.name.endswith(".json") and e.name[:1] != "."]
        if numbers:
            return json.loads(fs.read_text(f"{self.root}/{SNAPSHOTS}/{max(numbers)}"))
        if fs.exists(f"{self.root}/tables"):      # never take lost pointers for an empty store
            raise RuntimeError(f"{self.root} holds tables but no {SNAPSHOTS}; restore them before reading or loading")
        return dict(EMPTY)

    def begin(self) -> None:
        """Give a new store its first snapshot, an empty one, before a batch is written."""
        if self.state()["snapshot"] == 0:
            fs.create_text(self._pointer(0), json.dumps(EMPTY))

    def publish(self, state: dict, batches: list[str]) -> dict:
        """K6: the snapshot after ``state``, in one atomic step, or ConcurrentPublication."""
        new = {"snapshot": state["snapshot"] + 1, "batches": sorted(batches), "published_at": time.time()}
        if not fs.create_text(self._pointer(new["snapshot"]), json.dumps(new)):
            raise ConcurrentPublication(f"{self.root}: snapshot {new['snapshot']} was published by another load")
        return new

    # --- tables -------------------------------------------------------------
    def _read(self, folder: str, schema: T.StructType, name: str, batches: list[str]) -> DataFrame | None:
        """All columns of the visible batches, with those of the layout."""
        path = f"{self.root}/{folder}/{name}"
        if not batches or not fs.exists(path):
            return None
        fields = [f for f in schema.fields if f.name != LAYOUT.get(name)]
        if name in LAYOUT:
            fields.append(T.StructField(LAYOUT[name], T.ShortType()))
        full = T.StructType([*fields, T.StructField(BATCH, T.StringType())])
        df = self.spark.read.schema(full).option("basePath", path).parquet(path)
        return df.where(F.col(BATCH).isin(batches))

    def table(self, name: str, batches: list[str] | None = None) -> DataFrame:
        """The published rows of ``name`` (empty if never written)."""
        rows = self._read("tables", PUBLISHED[name], name, self.state()["batches"] if batches is None else batches)
        return empty_table(self.spark, name) if rows is None else rows.select(*PUBLISHED[name].names)

    def keys(self, name: str, batches: list[str], years: list[int | None] | None = None) -> DataFrame:
        """Published keys of ``name``; those of some years only, where the layout knows them."""
        rows = self._read("tables", PUBLISHED[name], name, batches)
        if rows is None:
            return empty_table(self.spark, name).select(*KEYS[name])
        if years is not None and name in LAYOUT:
            wanted = F.col(YEAR).isin([y for y in years if y is not None])
            rows = rows.where(wanted | F.col(YEAR).isNull() if None in years else wanted)
        return rows.select(*KEYS[name])

    def derived(self, name: str, batches: list[str]) -> DataFrame:
        """A derived table: what all visible loads added to it. Rows of a key are added up by readers."""
        rows = self._read("derived", DERIVED[name], name, batches)
        return empty_rows(self.spark, DERIVED[name]) if rows is None else rows.select(*DERIVED[name].names)

    def _write(self, folder: str, name: str, rows: DataFrame, batch: str) -> None:
        # the rows come out of a shuffle whose small partitions AQE has merged: one file per year
        # and partition, and no second shuffle of all that is written
        order = ([LAYOUT[name]] if name in LAYOUT else []) + SORT_WITHIN.get(name, [])
        if order:
            rows = rows.sortWithinPartitions(*order)
        out = rows.write.mode("errorifexists").option("compression", "zstd")
        if name in LAYOUT:
            out = out.partitionBy(LAYOUT[name])
        out.parquet(f"{self.root}/{folder}/{name}/{BATCH}={batch}")

    def write_batch(self, name: str, rows: DataFrame, batch: str) -> None:
        """One load's new rows of a table, with the layout's year if the table has one."""
        columns = dict.fromkeys([*PUBLISHED[name].names, *([LAYOUT[name]] if name in LAYOUT else [])])
        self._write("tables", name, rows.select(*columns), batch)

    def write_derived(self, name: str, rows: DataFrame, batch: str) -> None:
        self._write("derived", name, rows.select(*DERIVED[name].names), batch)

    def rejected_lines(self, batches: list[str] | None = None) -> DataFrame:
        """Raw lines that the visible loads set aside: file, reason, line."""
        name, schema = next(iter(REJECTED.items()))
        rows = self._read("rejects", schema, name, self.state()["batches"] if batches is None else batches)
        return empty_rows(self.spark, schema) if rows is None else rows.select(*schema.names)

    def write_rejected(self, rows: DataFrame, batch: str) -> None:
        self._write("rejects", "rejected_lines", rows, batch)

    def tables(self, batches: list[str] | None = None) -> dict[str, DataFrame]:
        """Published tables; for the current snapshot also its derived tables."""
        visible = self.state()["batches"] if batches is None else batches
        out = {name: self.table(name, visible) for name in PUBLISHED}
        if batches is None and visible:
            out |= {name: self.derived(name, visible) for name in DERIVED}
        return out
