"""Inner join whose busy keys are split.

Spark splits a skewed partition only where both sides of the join have just been shuffled
for it; a side that an aggregation or another join has already dealt out by the key is
left as it is, and one busy key ends in one task. Here the keys with more than
``SHARE_ROWS`` rows on a side are counted first. On that side their rows are dealt to
shares by a hash, and the other side's rows of the key go to every share: with i shares on
the left and j on the right a key becomes i * j blocks, each of about ``SHARE_ROWS`` rows a
side. All other keys are one block, and nothing of them is copied.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARE_ROWS = 50_000


def busy_keys(rows: DataFrame, key: str, shares: str) -> DataFrame:
    """Keys with more than SHARE_ROWS rows and the number of their shares. Counted map-side."""
    return rows.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / SHARE_ROWS).cast("int").alias(shares)).where(F.col(shares) > 1)


def hot_join(left: DataFrame, right: DataFrame, key: str, left_by: str, right_by: str,
             left_keys: DataFrame | None = None, right_keys: DataFrame | None = None) -> DataFrame:
    """``left`` and ``right`` joined on ``key``. Rows of a busy key are dealt to shares by the
    columns ``left_by`` and ``right_by``. Keys are counted in ``left_keys`` and ``right_keys``,
    by default the sides themselves.

    There are at most 1/SHARE_ROWS as many busy keys as rows, so they are broadcast: otherwise
    each side is shuffled by the key to meet them and once more by the blocks."""
    busy = busy_keys(left if left_keys is None else left_keys, key, "_li") \
        .join(busy_keys(right if right_keys is None else right_keys, key, "_rj"), key, "full")
    shares = {n: F.coalesce(F.col(n), F.lit(1)) for n in ("_li", "_rj")}

    def dealt(rows: DataFrame, by: str, own: str, own_shares: str, other: str, other_shares: str) -> DataFrame:
        return rows.join(F.broadcast(busy), key, "left") \
            .withColumn(own, F.pmod(F.xxhash64(by), shares[own_shares]).cast("int")) \
            .withColumn(other, F.explode(F.sequence(F.lit(0), shares[other_shares] - 1))).drop("_li", "_rj")

    return dealt(left, left_by, "_i", "_li", "_j", "_rj").join(
        dealt(right, right_by, "_j", "_rj", "_i", "_li"), [key, "_i", "_j"]).drop("_i", "_j")
