"""What a load stages and shuffles: ids as bytes, premises' ids made after staging."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from landsales.functions.cleaning import clean_rows, staged_rows, with_premises
from landsales.schemas import RAW_COLUMNS

BASE = {"No disposition": "1", "Date mutation": "03/02/2020", "Nature mutation": "Vente", "Valeur fonciere": "100,50",
        "Code postal": "01000", "Commune": " BOURG ", "Code departement": "01", "Code commune": "004", "Section": "A",
        "No plan": "7", "Type local": "Maison", "Surface reelle bati": " 80 ", "Nombre pieces principales": "3.5"}
CHANGES = [{}, {}, {"Date mutation": None}, {"Type local": " "}, {"Section": None}, {"Surface reelle bati": None},
           {"Nombre pieces principales": "junk", "Surface reelle bati": "80.0"}, {"Prefixe de section": "101"}]


def _raw(spark):
    rows = [tuple((BASE | change).get(c) for c in RAW_COLUMNS) for change in CHANGES]
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in RAW_COLUMNS))


def test_staged_rows_hold_no_premises_id_and_give_the_same_clean_rows(spark):
    staged = staged_rows(_raw(spark))
    assert "id_local" not in staged.columns and staged.schema["id_mutation"].dataType.simpleString() == "binary"
    again = with_premises(staged).withColumns({c: F.lower(F.hex(c)) for c in ("id_mutation", "id_local")})
    wanted = clean_rows(_raw(spark)).drop("adresse_")
    assert sorted(map(repr, again.select(*wanted.columns).collect())) == sorted(map(repr, wanted.collect()))


def test_premises_ids_are_md5_of_their_parts(spark):
    first, _, undated, *_ = with_premises(staged_rows(_raw(spark))).collect()
    sale = hashlib.md5(b"03/02/2020|1|100.50|01004").hexdigest()
    assert first.id_mutation.hex() == sale
    assert first.id_local.hex() == hashlib.md5(f"{sale}|010040000A0007|Maison|80|3.5".encode()).hexdigest()
    assert undated.id_local.hex() == hashlib.md5(b"|010040000A0007|Maison|80|3.5").hexdigest()


def test_sale_ids_of_derived_tables_are_text_again(spark, tmp_path):
    from landsales.plans.load import load
    from landsales.store import Store
    for year in (2020, 2021):
        lines = ["|".join(RAW_COLUMNS)]
        lines += ["|".join((BASE | change | {"Date mutation": f"03/02/{year}"}).get(c) or "" for c in RAW_COLUMNS) for change in CHANGES]
        (tmp_path / f"valeursfoncieres-{year}.txt").write_text("\n".join(lines))
        load(spark, str(tmp_path / "store"), str(tmp_path), [2020, year], log=lambda m: None)
    t = Store(spark, str(tmp_path / "store")).tables()
    sold = {r[0] for r in t["mutation"].select("id_mutation").collect()}
    linked = {r[0] for r in t["sale_parcel_types"].select("id_mutation").collect()}
    assert len(sold) == 2 and linked == sold


def test_remainders_of_keys_make_the_same_raw_lines(spark, tmp_path):
    from landsales.sources.driver_tables import adapter_raw_rows, adapter_sales
    keys = [-7, 0, 5, 2915, 2916, 123_456_789_012, None]
    lines = [(1, k, s, 1, 2.0) for k in keys for s in (-1, 0, 59, 60, 10**12 + 1, None)]
    tables = {"lineitem": (lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double"),
              "orders": ([(1, 10**12 + 7, "O", 10.5)], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double"),
              "customer": ([(10**12 + 7, 3)], "c_custkey long, c_nationkey int"),
              "part": ([(k, f"name {k}", "BOX") for k in keys], "p_partkey long, p_name string, p_type string")}
    for name, (rows, schema) in tables.items():
        frame = spark.createDataFrame(rows, schema)
        if name == "orders":
            frame = frame.withColumn("o_orderdate", F.to_date(F.lit("1998-05-04")))
        frame.write.parquet(str(tmp_path / f"{name}.parquet"))
    sales = adapter_sales(spark, str(tmp_path))
    assert sales.agg(F.max(F.abs("l_partkey")), F.max(F.abs("l_suppkey")), F.max("c_custkey")).first()[:] < (2915, 60, 1000)
    whole = spark.createDataFrame(lines, tables["lineitem"][1]).where("l_partkey IS NOT NULL")
    order = spark.read.parquet(str(tmp_path / "orders.parquet")).crossJoin(spark.createDataFrame(*tables["customer"]))
    whole = whole.join(spark.createDataFrame(*tables["part"]), F.col("l_partkey") == F.col("p_partkey")).crossJoin(order)
    made, wanted = (sorted(map(repr, adapter_raw_rows(x).collect())) for x in (sales, whole))
    assert made == wanted and len(made) == 36


def test_rows_of_ascii_alone_are_trimmed_alike(spark):
    from landsales.functions import cleaning
    texts = ["", " ", "  a ", "a", "\ta\t", "\u00a0a\u2003 ", "\u00e9t\u00e9 ", " \u3000", None, "a  b", "\n a\n "]
    rows = spark.createDataFrame([tuple(texts[(i + k) % len(texts)] if k % 3 else texts[i] for k in range(len(RAW_COLUMNS)))
                                  for i in range(len(texts))] + [(t,) * len(RAW_COLUMNS) for t in texts],
                                 ", ".join(f"`{c}` string" for c in RAW_COLUMNS))
    staged = staged_rows(rows)
    assert cleaning.PLAIN not in staged.columns
    assert "octet_length" in staged._jdf.queryExecution().optimizedPlan().toString()     # told by the whole row
    same = [c for c in staged.columns if c not in ("id_mutation", cleaning.AREA, cleaning.ROOMS)]
    assert list(map(str, staged.select(same).collect())) == list(map(str, clean_rows(rows).select(same).collect()))
    marked = rows.withColumn("p", F.lit(False))
    assert cleaning.normalise(rows).collect() == cleaning.normalise(marked, F.col("p")).drop("p").select(*cleaning.normalise(rows).columns).collect()
