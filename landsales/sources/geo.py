"""Commune centres (JSON) and département outlines (GeoJSON)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landsales.schemas import CENTRE_SCHEMA, OUTLINE_SCHEMA


def read_commune_centres(spark: SparkSession, path: str, json_array: bool = True) -> DataFrame:
    """One row per commune with a centre; coordinates are [lon, lat].

    ``json_array=True`` reads a file holding one top-level JSON array (the
    public API's format; such a file is read by one task). JSON-lines input is
    split across tasks like any text file.
    """
    raw = spark.read.schema(CENTRE_SCHEMA).option("multiLine", json_array).json(path)
    coords = F.col("centre.coordinates")
    return (raw.where(F.col("centre").isNotNull())
            .select(F.col("code").alias("code_commune"),
                    F.try_element_at(coords, F.lit(2)).cast("double").alias("latitude"),
                    F.try_element_at(coords, F.lit(1)).cast("double").alias("longitude")))


def first_source_wins(frames: list[DataFrame], key: str = "code_commune") -> DataFrame:
    """K3: sources in priority order; a key present in several keeps the first.

    Implemented as an aggregation (``min_by`` on the source rank), so a key
    repeated many times is pre-aggregated map-side instead of shuffled whole.
    """
    tagged = [f.withColumn("_src", F.lit(i)) for i, f in enumerate(frames)]
    union = reduce(DataFrame.unionByName, tagged)
    value_cols = [c for c in frames[0].columns if c != key]
    best = F.min_by(F.struct(*value_cols), F.col("_src"))
    return union.groupBy(key).agg(best.alias("_v")).select(key, *[F.col(f"_v.{c}").alias(c) for c in value_cols])


def read_outlines(spark: SparkSession, path: str) -> DataFrame:
    """One row per GeoJSON feature: code, name, geometry as JSON text."""
    fc = spark.read.schema(OUTLINE_SCHEMA).option("multiLine", True).json(path)
    feat = fc.select(F.explode("features").alias("f"))
    return feat.select(F.col("f.properties.code").alias("code"),
                       F.col("f.properties.nom").alias("nom"),
                       F.col("f.geometry").alias("geometry"))
