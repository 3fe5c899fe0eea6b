"""Connected components of a graph given as links, by alternating star steps.

Large star: a node's larger neighbours are linked to the smallest of its
neighbourhood.  Small star: its smaller ones and itself are.  Both keep the
components, and a few rounds leave one star for each, around its smallest node.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nodepulse.llm.common import kept


def _pairs(*columns: tuple[str, str]) -> list[Column]:
    """Each row gives one (a, b) for each pair of column names.

    Written as one explode, not as a union: what follows groups by ``a`` or ``b``.
    """
    made = F.explode(F.array(*[F.struct(F.col(x).alias("a"), F.col(y).alias("b")) for x, y in columns])).alias("p")
    return [made]


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One step over links (a, b) with a > b."""
    if large:
        both = links.select(*_pairs(("a", "b"), ("b", "a"))).select("p.a", "p.b")
        lowest = both.groupBy("a").agg(F.least("a", F.min("b")).alias("low"))
        out = both.join(lowest, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        lowest = links.groupBy("a").agg(F.min("b").alias("low"))
        out = links.join(lowest, "a").select(*_pairs(("b", "low"), ("a", "low"))).select("p.a", "p.b")
    return out.where("a > b").distinct()


def _print_of(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def star_components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in links (a, b): root is the smallest node it reaches."""
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = kept(links, "links")
    seen = _print_of(links)
    while True:
        links = kept(_star(_star(links, large=True), large=False), "links")
        now = _print_of(links)
        if now == seen:
            break
        seen = now
    return links.select(*_pairs(("a", "b"), ("b", "b"))).selectExpr("p.a as node", "p.b as root").distinct()
