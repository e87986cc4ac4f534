"""Test adapter: raw property-sale files made from the driver's TPC-H-like tables.

The driver provides ``lineitem orders customer part nation`` as Parquet. This
module derives, with Spark, the inputs the pipeline reads in production:
yearly `|`-delimited raw files, a commune-centre JSON file and a département
outline GeoJSON. Work grows with the driver's tables; nothing is invented.

The mapping (which driver column feeds which raw column) is a fixed test
convention shared with the DuckDB oracle in ``landsales.plans.oracle_sql``.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landsales.schemas import RAW_COLUMNS
from landsales.sources import fs
from landsales.sources.raw_files import year_marker


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pad(col, width: int):
    return F.lpad(col.cast("string"), width, "0")


def _rest(key: str, of: int):
    """A key's remainder: what its remainders by the divisors of ``of`` are made from."""
    return (F.col(key) % of).alias(key)


def adapter_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per lineitem with what its raw line is made of, and ``_year``. The orders meet
    their customers first: a quarter of the rows, and lineitem is dealt out only twice, last
    by order, so that the lines of an order, which are a sale, lie together. Of keys that the
    raw line shows as remainders only, no more than a common remainder is shuffled and kept."""
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", _rest("l_suppkey", 2 * 3 * 5 * 2),
                                              "l_linenumber", "l_quantity")
    od = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                            "o_totalprice", "o_orderdate")
    cu = _t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    pa = _t(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    placed = od.join(cu, od.o_custkey == cu.c_custkey).drop("o_custkey").withColumn("c_custkey", _rest("c_custkey", 1000))
    return (li.join(pa, li.l_partkey == pa.p_partkey).drop("p_partkey").withColumn("l_partkey", _rest("l_partkey", 53 * 5 * 11))
            .join(placed, li.l_orderkey == placed.o_orderkey).drop("o_orderkey")
            .withColumn("_year", F.year("o_orderdate")))


def adapter_raw_rows(j: DataFrame) -> DataFrame:
    """The 18 raw columns of each row of ``adapter_sales``.

    Some hold what the cleaning must cope with: no-break spaces around a name, one-digit
    dates and dates that don't exist, amounts and surfaces beyond their type, half rooms."""
    dept = _pad(F.col("c_nationkey"), 2)
    comm = _pad(F.col("c_custkey") % 1000, 3)
    price = F.replace(F.col("o_totalprice").cast("decimal(15,2)").cast("string"),
                      F.lit("."), F.lit(","))
    return j.select(
        F.col("l_orderkey").cast("string").alias("No disposition"),
        F.when(F.col("l_orderkey") % 103 == 0, F.concat(F.lit("31/02/"), F.year("o_orderdate").cast("string")))
         .when(F.col("l_orderkey") % 19 == 0, F.date_format("o_orderdate", "d/M/yyyy"))
         .otherwise(F.date_format("o_orderdate", "dd/MM/yyyy")).alias("Date mutation"),
        F.when(F.col("o_orderstatus") == "P", "Echange").otherwise("Vente").alias("Nature mutation"),
        F.when(F.col("l_orderkey") % 97 == 0, "").when(F.col("l_orderkey") % 107 == 0, "123456789012345,67")
         .otherwise(price).alias("Valeur fonciere"),
        F.col("l_linenumber").cast("string").alias("No voie"),
        F.when(F.col("l_linenumber") % 3 == 0, "B").otherwise("").alias("B/T/Q"),
        F.when(F.col("l_suppkey") % 2 == 0, "RUE").otherwise("AV").alias("Type de voie"),
        F.col("p_name").alias("Voie"),
        F.concat(dept, F.lit("000")).alias("Code postal"),
        F.when(F.col("l_suppkey") % 3 == 0, F.concat(F.lit("\u00a0COMMUNE "), dept, comm, F.lit("\u2003 ")))
         .otherwise(F.concat(F.lit("COMMUNE "), dept, comm)).alias("Commune"),
        dept.alias("Code departement"),
        comm.alias("Code commune"),
        F.when(F.col("l_suppkey") % 5 == 0, " 101 ").otherwise("").alias("Prefixe de section"),
        F.when(F.col("l_partkey") % 53 == 0, "")
         .otherwise(F.expr("chr(cast(65 + l_suppkey % 4 as int))")).alias("Section"),
        (F.col("l_partkey") % 5 + 1).cast("string").alias("No plan"),
        F.when(F.col("l_partkey") % 11 == 0, "").otherwise(F.col("p_type")).alias("Type local"),
        F.when(F.col("l_orderkey") % 13 == 0, "")
         .when(F.col("l_orderkey") % 17 == 0, "0").when(F.col("l_orderkey") % 37 == 0, "123456789.5")
         .otherwise(F.col("l_quantity").cast("int").cast("string")).alias("Surface reelle bati"),
        F.when(F.col("l_orderkey") % 13 == 0, "")
         .when(F.col("l_orderkey") % 23 == 0, F.concat(F.col("l_linenumber").cast("string"), F.lit(".5")))
         .otherwise(F.col("l_linenumber").cast("string")).alias("Nombre pieces principales"),
    )


def adapter_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commune-centre records; one commune in ten has ``centre: null``.

    Coordinates are multiples of 1/256, so every sum and mean is exact.
    """
    cu = _t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    k = F.col("c_custkey") % 1000
    code = F.concat(_pad(F.col("c_nationkey"), 2), _pad(k, 3))
    lat = F.lit(41.0) + (k % 512).cast("double") / 64.0
    lon = F.lit(-5.0) + F.col("c_nationkey").cast("double") / 4.0 + (k % 64).cast("double") / 256.0
    per_code = cu.groupBy(code.alias("code")).agg(
        F.max(lat).alias("lat"), F.max(lon).alias("lon"), F.max(k % 10 != 0).alias("located"))
    centre = F.when(F.col("located"), F.struct(F.lit("Point").alias("type"),
                                               F.array("lon", "lat").alias("coordinates")))
    return per_code.select("code", centre.alias("centre"))


def adapter_more_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second source of centres: every commune, one degree further north."""
    cu = _t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    k = F.col("c_custkey") % 1000
    moved = cu.groupBy(F.concat(_pad(F.col("c_nationkey"), 2), _pad(k, 3)).alias("code")).agg(
        (F.max((k % 512).cast("double") / 64.0) + 42.0).alias("lat"), F.max((k % 256).cast("double") / 64.0).alias("lon"))
    point = F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates"))
    return moved.select("code", point.alias("centre"))


def adapter_outlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A FeatureCollection with one square feature per nation (= département).

    The feature list is bounded by the nation dimension (25 rows in TPC-H).
    """
    na = _t(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    x0 = F.lit(-5.0) + F.col("n_nationkey").cast("double") / 4.0
    ring = F.array(*[F.array(x0 + dx, F.lit(41.0) + dy) for dx, dy in
                     [(0.0, 0.0), (0.25, 0.0), (0.25, 8.0), (0.0, 8.0), (0.0, 0.0)]])
    geometry = F.to_json(F.struct(F.lit("Polygon").alias("type"),
                                  F.array(ring).alias("coordinates")))
    feature = F.struct(F.lit("Feature").alias("type"),
                       F.struct(_pad(F.col("n_nationkey"), 2).alias("code"),
                                F.col("n_name").alias("nom")).alias("properties"),
                       geometry.alias("geometry"))
    return na.agg(F.sort_array(F.collect_list(feature)).alias("features")) \
             .select(F.lit("FeatureCollection").alias("type"), "features")


def adapter_lines(rows: DataFrame) -> DataFrame:
    """Raw rows as lines of a file: of some, the line comes once more cut short after three
    fields, of some once more with a byte that is no UTF-8. Neither may be loaded. All lines
    that come of a row, with the header before a file's first, are one value."""
    fields = [F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in RAW_COLUMNS]
    line = F.concat_ws("|", *fields)
    order, number = F.col("`No disposition`").cast("long"), F.col("`No voie`")
    bad = F.concat_ws("|", *fields[:7]).cast("binary")
    bad = F.concat(bad, F.unhex(F.lit("7CFF7C")), F.concat_ws("|", *fields[8:]).cast("binary")).cast("string")
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0       # of its file
    return rows.select(F.concat_ws("\n", F.when(first, "|".join(RAW_COLUMNS)), line,
                                   F.when((order % 29 == 0) & (number == "1"), F.concat_ws("|", *fields[:3])),
                                   F.when((order % 31 == 0) & (number == "1"), bad)).alias("value"))


def stage_years(spark: SparkSession, sf_dir: str, landing: str) -> list[int]:
    """Write the raw rows below ``landing``, one `valeursfoncieres-<year>.txt` folder of
    compressed files per calendar year, and return the years.

    The joined rows are written once, by year, as narrow compressed columns in a scratch
    folder; each year's lines are then made from its part alone.
    """
    scratch = f"{landing}.rows"
    rows = adapter_sales(spark, sf_dir).where(F.col("_year").isNotNull())
    rows.sortWithinPartitions("_year", "l_orderkey").write.mode("overwrite").partitionBy("_year").option("compression", "zstd").parquet(scratch)
    years = sorted(int(e.name.split("=", 1)[1]) for e in fs.list_dir(scratch) if e.is_dir and "=" in e.name)
    staged = spark.read.schema(rows.schema).parquet(scratch) if years else rows

    def write_year(year: int) -> None:
        lines = adapter_lines(adapter_raw_rows(staged.where(F.col("_year") == year)))
        # a tenth more bytes than the codec's own level, for half of its time
        lines.write.mode("overwrite").option("compression", "gzip").option("zlib.compress.level", "FOUR") \
            .text(f"{landing}/{year_marker(year)}")

    # One Spark job per year, submitted together so they share the cluster.
    with ThreadPoolExecutor(max_workers=max(1, len(years))) as pool:
        list(pool.map(write_year, years))
    fs.delete_tree(scratch)
    return years


def stage_places(spark: SparkSession, sf_dir: str, landing: str) -> dict:
    """Write the commune centres and the outlines below ``landing``.

    Returns {"centres": path, "more_centres": path, "outlines": path}."""
    centres = f"{landing}/communes-geo.json"
    adapter_centres(spark, sf_dir).write.mode("overwrite").json(centres)
    outlines = f"{landing}/departements.geojson"
    adapter_outlines(spark, sf_dir).coalesce(1).write.mode("overwrite").json(outlines)
    more = f"{landing}/more-centres.json"
    adapter_more_centres(spark, sf_dir).write.mode("overwrite").json(more)
    return {"centres": centres, "more_centres": more, "outlines": outlines}


def stage_landing(spark: SparkSession, sf_dir: str, landing: str) -> dict:
    """All inputs below ``landing``: {"years": [...], "centres": path, "more_centres": path, "outlines": path}."""
    return {"years": stage_years(spark, sf_dir, landing), **stage_places(spark, sf_dir, landing)}
