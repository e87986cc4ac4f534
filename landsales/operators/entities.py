"""The five deduplicated entity tables derived from clean rows.

Each is one aggregation on the entity key (sorted where ``max`` runs over text). Spark aggregates map-side
first, so a key that holds a large share of the rows is reduced to one row per
task before the shuffle. ``any_value`` of the source engine returns the first
non-NULL value; ``max`` also ignores NULLs and is deterministic, so it is
always one of the allowed answers. Links and premises carry the sale's year, which
their keys determine, for the store's layout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _one_per_key(clean: DataFrame, key: str, cols: list[str]) -> DataFrame:
    return (clean.where(F.col(key).isNotNull())
            .groupBy(key).agg(*[F.max(c).alias(c) for c in cols]))


def _repeated(clean: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """For keys of many rows: their different rows are found by hashing, only these are sorted."""
    return _one_per_key(clean.select(key, *cols).distinct(), key, cols)


def commune(clean: DataFrame) -> DataFrame:
    return _repeated(clean, "code_commune", ["nom_commune", "code_departement", "code_postal"])


def parcelle(clean: DataFrame) -> DataFrame:
    return _repeated(clean, "id_parcelle", ["code_commune"])


def mutation(clean: DataFrame) -> DataFrame:
    return _one_per_key(clean, "id_mutation",
                        ["annee", "date_mutation", "nature_mutation", "valeur_fonciere"])


def mutation_parcelle(clean: DataFrame) -> DataFrame:
    # dealt by the sale, whose links then lie together: its long id is compressed to one in the
    # shuffle, in the published files and in the shuffles of those that join links to sales
    return (clean.where(F.col("id_mutation").isNotNull() & F.col("id_parcelle").isNotNull())
            .select("id_mutation", "id_parcelle", "annee").repartition("id_mutation").distinct())


def local(clean: DataFrame) -> DataFrame:
    return _one_per_key(clean, "id_local", ["type_local", "surface_reelle_bati",
                                            "nombre_pieces_principales", "id_parcelle", "annee"])


BUILDERS = {
    "commune": commune,
    "parcelle": parcelle,
    "mutation": mutation,
    "mutation_parcelle": mutation_parcelle,
    "local": local,
}


def derive(clean: DataFrame) -> dict[str, DataFrame]:
    """All five entity DataFrames (lazy) from the same clean rows."""
    return {name: build(clean) for name, build in BUILDERS.items()}
