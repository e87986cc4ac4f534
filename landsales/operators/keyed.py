"""K1: keyed append with "existing row wins" semantics.

``INSERT OR IGNORE`` re-expressed as DataFrame steps:
cast to the table's types (ANSI cast: a value that does not fit raises) ->
fail on a NULL key -> one row per key inside the batch -> ``left_anti`` against
the keys already published. The caller writes only the returned new rows.

A batch may hold its md5 ids as the 16 bytes that their text spells: half of what a
shuffle would move. They are compared as bytes and spelled last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landsales.schemas import LAYOUT


def _is_bytes(batch: DataFrame, name: str) -> bool:
    return isinstance(batch.schema[name].dataType, T.BinaryType)


def conform(batch: DataFrame, schema: T.StructType, keys: list[str], table: str) -> DataFrame:
    """Select the table's columns by name and cast them, with the year of its layout if it has
    one; NULL keys raise."""
    fields = list(schema.fields)
    if LAYOUT.get(table) in batch.columns and LAYOUT[table] not in schema.names:
        fields.append(T.StructField(LAYOUT[table], T.ShortType()))
    rows = batch.select(*[F.col(f.name) if _is_bytes(batch, f.name) else F.col(f.name).cast(f.dataType).alias(f.name)
                          for f in fields])
    for key in keys:
        # a filter, not a changed key column: the batch keeps its partitioning by key
        missing = F.raise_error(F.lit(f"{table}: NULL key {key}")).cast("boolean")
        rows = rows.where(F.when(F.col(key).isNull(), missing).otherwise(F.lit(True)))
    return rows


def new_rows(batch: DataFrame, existing_keys: DataFrame, schema: T.StructType,
             keys: list[str], table: str, distinct_keys: bool = False) -> DataFrame:
    """Rows of ``batch`` to append: one per key, keys not yet published.
    ``distinct_keys``: the batch already has one row per key, as the entities have."""
    unique = conform(batch, schema, keys, table)
    if not distinct_keys:
        unique = unique.dropDuplicates(keys)
    known = existing_keys.select(*[F.unhex(k).alias(k) if _is_bytes(batch, k) else F.col(k) for k in keys])
    new = unique.join(known, on=keys, how="left_anti")
    return new.select(*[F.lower(F.hex(c)).alias(c) if _is_bytes(batch, c) else F.col(c) for c in new.columns])
