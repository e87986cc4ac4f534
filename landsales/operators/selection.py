"""Exact medians as one lazy plan, written in SQL.

``percentile`` keeps every distinct value of a group in one task and a window over all
rows sorts them in one task. Here a median is selected in three levels, each a GROUP BY
and a choice of the bucket that holds the middle ranks:

1. buckets of 1/4096 of a power of two (left out where bounds are known), 2. 2^18 equal parts of the values' range in the
chosen bucket, 3. the distinct values left (at most 2^22 doubles fit into that range,
whatever the data).

The chosen range is a scalar subquery of the next level, so the whole selection is one
plan: it can stand in a view or a table function, nothing runs before an action, and
the windows see one row per bucket. The levels read the same compressed values; no
filter is pushed below them, so Spark computes that exchange once.

``pair_values`` gives the weighted values for a median of value / surface over the pairs
of each parcel without listing the pairs. Values and surfaces are put into blocks of
1/256 of a power of two per parcel, and every pair of blocks bounds the ratios of its
pairs (least value / largest surface to largest value / least surface). The bounds of all
block pairs bound the median. Pairs of blocks wholly below or above it count as one
value there; only those that meet it (two or three of a block's row, whatever the
parcel's size) are listed from the parcel's values and surfaces. All parcels are treated
alike; a parcel's block pairs are bounded by the grid, not by its sales.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

FINE = 4096            # buckets per power of two, first level
PARTS = 1 << 18        # equal parts of the chosen range, second level
GRID = 256             # blocks per power of two


def _octave(x: str, per: int) -> str:
    """A monotone whole number of any double."""
    return (f"CASE WHEN {x} > 0 THEN {8000 * per} + floor(log2({x}) * {per}) WHEN {x} = 0 THEN 0 "
            f"ELSE {-8000 * per} - floor(log2(-{x}) * {per}) END")


def _chosen(p: str, level: int, known: str) -> list[str]:
    """The range that holds the middle ranks, from the buckets of a level."""
    low, high = "(n - 1) div 2", "n div 2"
    holds = "CASE WHEN upto - w <= {0} AND {0} < upto THEN {1} END"
    return [
        f"{p}_r{level} AS (SELECT w, mn, mx, {known}, sum(w) OVER (ORDER BY k) AS upto FROM {p}_h{level})",
        f"{p}_s{level} AS (SELECT max(n) AS n, max(lo) AS lo, max(hi) AS hi, "
        + ", ".join(f"max({holds.format(low, x)}) AS {y}" for x, y in (("mn", "l_mn"), ("mx", "l_mx"), ("upto", "l_upto")))
        + f", max({holds.format(high, 'mn')}) AS h_mn FROM {p}_r{level})",
        # ranks in two buckets: the largest value of one and the least of the other
        f"{p}_c{level} AS (SELECT struct(n, l_mx AS mx, CASE WHEN {high} < l_upto THEN l_mn ELSE l_mx END AS mn, "
        f"coalesce(lo, CASE WHEN {high} >= l_upto THEN l_mx END) AS lo, "
        f"coalesce(hi, CASE WHEN {high} >= l_upto THEN h_mn END) AS hi) AS c FROM {p}_s{level})",
    ]


def median_ctes(p: str, values: str, bounds: str | None = None) -> list[str]:
    """CTEs that end in ``{p}_m``: one row with n (the weights' sum), lo and hi (the values of
    the middle ranks, null if there are none). ``values`` has x (double) and w (bigint);
    ``bounds`` names a CTE whose one struct c has n and bounds mn and mx of the middle
    values, so that the first level can be left out."""
    ctes = [
        f"{p}_v AS (SELECT x, CAST(sum(w) AS BIGINT) AS w FROM {values} WHERE x IS NOT NULL GROUP BY x HAVING sum(w) > 0)"]
    if bounds is None:
        bounds = f"{p}_c1"
        ctes += [
            f"{p}_h1 AS (SELECT {_octave('x', FINE)} AS k, sum(w) AS w, min(x) AS mn, max(x) AS mx FROM {p}_v GROUP BY 1)",
            *_chosen(p, 1, "sum(w) OVER () AS n, CAST(NULL AS DOUBLE) AS lo, CAST(NULL AS DOUBLE) AS hi"),
        ]
    parts = f"CASE WHEN mx > mn THEN floor((x - mn) / (mx - mn) * {PARTS}) ELSE 0L END"
    for level, least, key in ((2, "-1L", parts), (3, "CAST('-Infinity' AS DOUBLE)", "x")):
        # smaller values are the first bucket, larger ones a bucket (null) without weight
        ctes += [
            f"{p}_k{level} AS (SELECT CASE WHEN x < mn THEN {least} WHEN x <= mx THEN {key} END AS k, x, w, n, lo, hi "
            f"FROM (SELECT x, w, st.mn AS mn, st.mx AS mx, st.n AS n, st.lo AS lo, st.hi AS hi "
            f"FROM (SELECT x, w, (SELECT c FROM {bounds}) AS st FROM {p}_v)))",
            f"{p}_h{level} AS (SELECT k, sum(CASE WHEN k IS NULL THEN 0L ELSE w END) AS w, min(x) AS mn, max(x) AS mx, "
            f"max(n) AS n, max(lo) AS lo, max(hi) AS hi FROM {p}_k{level} GROUP BY k)",
            *_chosen(p, level, "n, lo, hi"),
        ]
        bounds = f"{p}_c{level}"
    ctes.append(f"{p}_m AS (SELECT c.n AS n, coalesce(c.lo, c.mn) AS lo, coalesce(c.hi, c.mx) AS hi FROM {bounds})")
    return ctes


def pair_values(p: str, values: str, surfaces: str) -> list[str]:
    """CTEs that end in ``{p}_x``: weighted values with the median of value / surface over all
    pairs of a parcel's values and surfaces, and in ``{p}_bc``: bounds of that median. ``values`` has id_parcelle, x (double, positive)
    and w, ``surfaces`` id_parcelle, s (double, positive) and w."""
    def block(c: str) -> str:
        return f"CAST(floor(log2({c}) * {GRID}) AS INT)"

    def grouped(rel: str, c: str) -> str:
        return (f"(SELECT id_parcelle, {block(c)} AS g, min({c}) AS mn, max({c}) AS mx, sum(w) AS w "
                f"FROM {rel} GROUP BY id_parcelle, {block(c)})")

    return [
        f"{p}_b AS (SELECT v.id_parcelle, v.g AS vg, s.g AS sg, v.mn / s.mx AS lo, v.mx / s.mn AS hi, v.w * s.w AS w "
        f"FROM {grouped(values, 'x')} v JOIN {grouped(surfaces, 's')} s ON v.id_parcelle = s.id_parcelle)",
        f"{p}_bh AS (SELECT k, sum(wl) AS wl, sum(wh) AS wh, min(lo) AS lo, max(hi) AS hi FROM ("
        f"SELECT {_octave('e.x', FINE)} AS k, CASE WHEN e.low THEN w ELSE 0L END AS wl, CASE WHEN e.low THEN 0L ELSE w END AS wh, "
        f"CASE WHEN e.low THEN e.x END AS lo, CASE WHEN NOT e.low THEN e.x END AS hi FROM {p}_b "
        f"LATERAL VIEW explode(array(struct(lo AS x, true AS low), struct(hi AS x, false AS low))) t AS e) GROUP BY k)",
        f"{p}_bc AS (SELECT struct(max(n) AS n, min(CASE WHEN cl > (n - 1) div 2 THEN lo END) AS mn, "
        f"min(CASE WHEN ch > n div 2 THEN hi END) AS mx, CAST(NULL AS DOUBLE) AS lo, CAST(NULL AS DOUBLE) AS hi) AS c FROM (SELECT lo, hi, sum(wl) OVER () AS n, "
        f"sum(wl) OVER (ORDER BY k) AS cl, sum(wh) OVER (ORDER BY k) AS ch FROM {p}_bh))",
        # the side comes out of a generator, so no filter on it is pushed below the subquery and doubles it
        f"{p}_d AS (SELECT id_parcelle, vg, sg, w, st.mn AS mn, st.mx AS mx, side "
        f"FROM (SELECT *, (SELECT c FROM {p}_bc) AS st FROM {p}_b) "
        f"LATERAL VIEW explode(array(CASE WHEN hi < st.mn THEN -1 WHEN lo > st.mx THEN 1 ELSE 0 END)) t AS side)",
        f"{p}_x AS (SELECT CASE side WHEN -1 THEN mn * 0.5D ELSE mx * 2D END AS x, w FROM {p}_d WHERE side <> 0 UNION ALL "
        f"SELECT v.x / s.s AS x, v.w * s.w AS w FROM {p}_d d "
        f"JOIN (SELECT *, {block('x')} AS g FROM {values}) v ON d.id_parcelle = v.id_parcelle AND d.vg = v.g "
        f"JOIN (SELECT *, {block('s')} AS g FROM {surfaces}) s ON d.id_parcelle = s.id_parcelle AND d.sg = s.g "
        f"WHERE d.side = 0)",
    ]


def cents_between(lo: str, hi: str) -> str:
    """SQL of the middle of two amounts in whole cents, given as doubles: half a cent is cut off."""
    lo, hi = (f"CAST(round({x} * 100) AS BIGINT)" for x in (lo, hi))
    return f"CAST(({lo} + ({hi} - {lo}) div 2) * 0.01BD AS DECIMAL(15,2))"


def with_ctes(ctes: list[str], select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


def median(values: DataFrame, value: str, weight: str | None = None) -> DataFrame:
    """One row: n, the values lo and hi of the middle ranks, and median (half-way), all doubles."""
    rows = values.selectExpr(f"CAST(`{value}` AS DOUBLE) AS x", f"CAST({f'`{weight}`' if weight else '1'} AS BIGINT) AS w")
    text = with_ctes(median_ctes("m", "{rows}"), "SELECT n, lo, hi, lo + (hi - lo) * 0.5D AS median FROM m_m")
    return values.sparkSession.sql(text, rows=rows)


def pair_median(values: DataFrame, surfaces: DataFrame) -> DataFrame:
    """One row: n and median of value / surface over the pairs of every parcel. ``values`` has
    id_parcelle, x, w; ``surfaces`` id_parcelle, s, w."""
    text = with_ctes([*pair_values("p", "{values}", "{surfaces}"), *median_ctes("m", "p_x", "p_bc")],
                     "SELECT n, lo + (hi - lo) * 0.5D AS median FROM m_m")
    return values.sparkSession.sql(text, values=values, surfaces=surfaces)
