"""Property test: the distributed exact median equals a brute-force median."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from landsales.operators.selection import median

values = st.lists(
    st.tuples(st.one_of(st.floats(-1e6, 1e6, allow_nan=False, allow_infinity=False),
                        st.sampled_from([0.0, 1.0, 2.5, -3.0, 1e-300])),
              st.integers(1, 5)),
    min_size=1, max_size=60)


def brute(pairs):
    v = sorted(x for x, w in pairs for _ in range(w))
    pos = (len(v) - 1) * 0.5
    lo, hi = v[math.floor(pos)], v[math.ceil(pos)]
    return lo + (hi - lo) * (pos - math.floor(pos))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(values)
def test_matches_brute_force(spark, pairs):
    df = spark.createDataFrame(pairs, "v double, w long")
    assert median(df, "v", "w").first().median == brute(pairs)


def _date_rule(text):
    import datetime as dt
    import re
    t = text.strip(" ")
    if not re.fullmatch(r"[0-9]{1,2}/[0-9]{1,2}/[0-9]{1,4}", t):
        return None
    d, m, y = (int(x) for x in t.split("/"))
    try:
        return dt.date(y, m, d)
    except ValueError:
        return None


date_texts = st.builds(
    lambda d, m, y, pad: f"{pad}{d}/{m}/{y}{pad}",
    st.from_regex(r"[0-9]{1,3}", fullmatch=True),
    st.from_regex(r"[0-9]{1,3}", fullmatch=True),
    st.from_regex(r"[1-9][0-9]{0,4}", fullmatch=True),
    st.sampled_from(["", " "]))


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(date_texts, min_size=1, max_size=40))
def test_sale_dates_follow_the_rule(spark, texts):
    from pyspark.sql import functions as F

    from landsales.functions.cleaning import parse_sale_date, text_or_empty
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    got = [r[0] for r in df.select(parse_sale_date(text_or_empty(F.col("x")))).collect()]
    assert got == [_date_rule(t) for t in texts]
