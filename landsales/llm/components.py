"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landsales.llm.common import stored


def _star(links: DataFrame, larger_only: bool) -> DataFrame:
    """Hang the neighbours of every node on the least of them (and the node itself)."""
    both = links.select("a", "b") if larger_only else \
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("root"))
    hung = both.join(least, "a")
    if larger_only:      # small star: the node and its smaller neighbours
        made = hung.select(F.col("b").alias("a"), F.col("root").alias("b")) \
            .unionByName(least.select("a", F.col("root").alias("b")))
    else:                # large star: its larger neighbours
        made = hung.where("b > a").select(F.col("b").alias("a"), F.col("root").alias("b"))
    return made.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """id, root (the least id of its component) of every linked id that isn't the root.

    ``links`` has columns a > b. Each round is one large and one small star, written to
    the shared folder; the loop ends when a round changes nothing."""
    links = stored(links.select("a", "b").where("a > b").distinct(), "links")
    mark = _mark(links)
    while mark[0]:
        links = stored(_star(_star(links, False), True), "links")
        now = _mark(links)
        if now == mark:
            break
        mark = now
    return links.select(F.col("a").alias("id"), F.col("b").alias("root"))


def _mark(links: DataFrame) -> tuple:
    """Count and order-free checksum of the links."""
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]
