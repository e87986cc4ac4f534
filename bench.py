"""Benchmark: the load job and every report at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line. Stages follow the reference's own timers (load,
transform + publish per table, per-query latency). ``value`` is the load job
plus the first call of every report. Staging the raw files from the driver's
tables stands in for the download step and is reported apart, not in ``value``.
Results are executed with the ``noop`` sink (the full plan runs, nothing is
collected).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from landsales.plans import layers as Ly  # noqa: E402
from landsales.plans import reports as R  # noqa: E402
from landsales.plans.load import CentreSource, load  # noqa: E402
from landsales.session import build_session, new_work_dir  # noqa: E402
from landsales.sources.driver_tables import stage_landing  # noqa: E402
from landsales.sources.geo import read_outlines  # noqa: E402
from landsales.store import Store  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
    spark = build_session(f"local[{cpus}]", app_name="landsales-bench",
                          shuffle_partitions=max(4, cpus * 2),
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g")})
    spark.range(1).count()
    times: dict[str, float] = {}

    work = new_work_dir(spark, "bench")
    t0 = time.monotonic()
    info = stage_landing(spark, sf_dir, f"{work}/landing")
    times["stage_inputs"] = time.monotonic() - t0

    t0 = time.monotonic()
    res = load(spark, f"{work}/store", f"{work}/landing", info["years"],
               [CentreSource("communes-geo.json", info["centres"], json_array=False)],
               log=lambda m: None)
    times["load_job"] = time.monotonic() - t0
    for k, v in res.seconds.items():
        times[f"load.{k}"] = v

    t = Store(spark, f"{work}/store").tables()
    outlines = read_outlines(spark, info["outlines"])
    reports = {
        "sale_premises": lambda: R.sale_premises(t),
        "kpi": lambda: R.kpi(t),
        "kpi_year": lambda: R.kpi(t, 1998),
        "kpi_type": lambda: R.kpi(t, None, "PROMO"),
        "price_evolution": lambda: R.price_evolution(t),
        "sales_per_year": lambda: R.sales_per_year(t),
        "type_shares": lambda: R.type_shares(t),
        "top_communes": lambda: R.top_communes(t),
        "top_communes_dept": lambda: R.top_communes(t, "07", 1998),
        "map_communes": lambda: R.map_communes(t),
        "map_departements": lambda: R.map_departements(t),
        "filter_years": lambda: R.filter_years(t),
        "filter_types": lambda: R.filter_types(t),
        "filter_departements": lambda: R.filter_departements(t),
        "choropleth": lambda: Ly.choropleth(t, outlines),
        "commune_bubbles": lambda: Ly.commune_bubbles(t, None, "07"),
    }
    total_reports = 0.0
    for name, build in reports.items():
        for attempt in ("", ".repeat"):
            t0 = time.monotonic()
            run(build())
            el = time.monotonic() - t0
            times[f"{name}{attempt}"] = el
            if not attempt:
                total_reports += el

    value = times["load_job"] + total_reports
    print(json.dumps({
        "metric": "load_plus_reports_sec", "value": round(value, 3), "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "sf": os.path.basename(sf_dir).replace("sf", ""),
        "raw_rows": res.raw_rows, "cpus": cpus,
        "raw_rows_per_sec": round(res.raw_rows / times["load_job"], 1) if times["load_job"] else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
