"""Print the physical plan of every report over a driver-table snapshot.

Usage: python tools/explain_reports.py [sf_dir] [--full]
Per report: number of shuffles (Exchange), broadcasts, and the pushed filters
of each Parquet scan; ``--full`` also prints ``explain("formatted")``.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from landsales.plans import layers as Ly  # noqa: E402
from landsales.plans import reports as R  # noqa: E402
from landsales.plans.driver_snapshot import snapshot_for  # noqa: E402
from landsales.session import build_session  # noqa: E402


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def main() -> None:
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    sf = args[0] if args else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    t = snapshot_for(spark, sf).store.tables()
    reports = {
        "sale_premises": R.sale_premises(t),
        "price_evolution": R.price_evolution(t),
        "sales_per_year": R.sales_per_year(t),
        "type_shares(1998)": R.type_shares(t, 1998),
        "top_communes('07', 1998)": R.top_communes(t, "07", 1998),
        "map_communes": R.map_communes(t),
        "map_departements": R.map_departements(t),
        "badges": Ly.badges(t),
    }
    for name, df in reports.items():
        text = plan_text(df)
        head = text.split("\n\n", 1)[0]
        pushed = sorted(set(re.findall(r"PushedFilters: \[(.*?)\]", text)))
        print(f"{name}: exchanges={head.count('Exchange') - head.count('BroadcastExchange')} "
              f"broadcasts={head.count('BroadcastExchange')} pushed={pushed}")
        if "--full" in sys.argv:
            print(text)


if __name__ == "__main__":
    main()
