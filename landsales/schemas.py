"""Schemas of the raw files and of the published tables.

Fixed values: the raw column names, the published table names and their column
names are those of the public property-sale files and of the data model this
package reproduces; they must not change, or existing consumers break.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- Fixed values: the 18 raw columns read from each yearly `|`-delimited file.
RAW_COLUMNS = [
    "No disposition",
    "Date mutation",
    "Nature mutation",
    "Valeur fonciere",
    "No voie",
    "B/T/Q",
    "Type de voie",
    "Voie",
    "Code postal",
    "Commune",
    "Code departement",
    "Code commune",
    "Prefixe de section",
    "Section",
    "No plan",
    "Type local",
    "Surface reelle bati",
    "Nombre pieces principales",
]

RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])

# --- Fixed values: published tables (name -> schema) and their keys.
PUBLISHED = {
    "commune": T.StructType([
        T.StructField("code_commune", T.StringType()),
        T.StructField("nom_commune", T.StringType()),
        T.StructField("code_departement", T.StringType()),
        T.StructField("code_postal", T.StringType()),
    ]),
    "parcelle": T.StructType([
        T.StructField("id_parcelle", T.StringType()),
        T.StructField("code_commune", T.StringType()),
    ]),
    "mutation": T.StructType([
        T.StructField("id_mutation", T.StringType()),
        T.StructField("annee", T.ShortType()),
        T.StructField("date_mutation", T.DateType()),
        T.StructField("nature_mutation", T.StringType()),
        T.StructField("valeur_fonciere", T.DecimalType(15, 2)),
    ]),
    "mutation_parcelle": T.StructType([
        T.StructField("id_mutation", T.StringType()),
        T.StructField("id_parcelle", T.StringType()),
    ]),
    "local": T.StructType([
        T.StructField("id_local", T.StringType()),
        T.StructField("type_local", T.StringType()),
        T.StructField("surface_reelle_bati", T.DecimalType(10, 2)),
        T.StructField("nombre_pieces_principales", T.ShortType()),
        T.StructField("id_parcelle", T.StringType()),
    ]),
    "commune_geo": T.StructType([
        T.StructField("code_commune", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
    ]),
    "elt_file": T.StructType([
        T.StructField("filename", T.StringType()),
        T.StructField("loaded_at", T.TimestampType()),
    ]),
}

KEYS = {
    "commune": ["code_commune"],
    "parcelle": ["id_parcelle"],
    "mutation": ["id_mutation"],
    "mutation_parcelle": ["id_mutation", "id_parcelle"],
    "local": ["id_local"],
    "commune_geo": ["code_commune"],
    "elt_file": ["filename"],
}

# The sale's year: the tables laid out by it. A sale's id, and so its links' and its
# premises' keys, are made from its date: rows of one key have one year.
YEAR = "annee"
LAYOUT = dict.fromkeys(["mutation", "mutation_parcelle", "local", "sale_parcel_types", "parcel_sale_values"], YEAR)

# Parent-first order of the five entity tables built from raw rows.
ENTITY_TABLES = ["commune", "parcelle", "mutation", "mutation_parcelle", "local"]

# Commune centres: JSON records {code, centre: {type, coordinates: [lon, lat]}}.
CENTRE_SCHEMA = T.StructType([
    T.StructField("code", T.StringType()),
    T.StructField("centre", T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("coordinates", T.ArrayType(T.DoubleType())),
    ])),
])

# Département outlines: a GeoJSON FeatureCollection; geometry kept as JSON text.
OUTLINE_SCHEMA = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("features", T.ArrayType(T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("properties", T.StructType([
            T.StructField("code", T.StringType()),
            T.StructField("nom", T.StringType()),
        ])),
        T.StructField("geometry", T.StringType()),
    ]))),
])


def empty_rows(spark, schema: T.StructType):
    """No rows, known as such to the optimizer: what is joined to them is not computed."""
    return spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]).where(F.lit(False))


def empty_table(spark, name: str):
    return empty_rows(spark, PUBLISHED[name])


# Lines of raw files that were set aside: their file, why, and their text.
REJECTED = {"rejected_lines": T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("line", T.StringType()),
])}

# Derived tables: each load appends what it adds; counts and sums of a key are added up.
# ``sale_parcel_types`` has one row per sale and parcel, with sums over the parcel's types: the
# types themselves are the parcel's (``parcel_surfaces``), not repeated for each of its sales.
DERIVED = {
    "sale_parcel_types": T.StructType([
        T.StructField("id_mutation", T.StringType()),
        T.StructField("annee", T.ShortType()),
        T.StructField("valeur_fonciere", T.DecimalType(15, 2)),
        T.StructField("id_parcelle", T.StringType()),
        T.StructField("code_commune", T.StringType()),
        T.StructField("pair_sum", T.DoubleType()),
        T.StructField("pair_n", T.LongType()),
    ]),
    "parcel_sale_values": T.StructType([
        T.StructField("id_parcelle", T.StringType()),
        T.StructField("annee", T.ShortType()),
        T.StructField("valeur_fonciere", T.DecimalType(15, 2)),
        T.StructField("a", T.LongType()),
    ]),
    "parcel_surfaces": T.StructType([
        T.StructField("id_parcelle", T.StringType()),
        T.StructField("type_local", T.StringType()),
        T.StructField("surface_reelle_bati", T.DecimalType(10, 2)),
        T.StructField("b", T.LongType()),
    ]),
}
