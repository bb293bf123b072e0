"""Connected components of a link table by alternating star contractions.

Links are kept as (u, v) with u > v.  A large-star step moves every u of a link to the parent of v, a small-star
step moves all smaller neighbours of u to the smallest of them; both only need the smallest neighbour of a node (a
map-side combined ``min``) and a join of the links with it, never a node's whole neighbour list.  The parent table is
materialised before the join, so both join sides are plain shuffles and a hub with very many links can be split by
AQE.  The loop ends when a round changes nothing; only a count and two sums reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import cut


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node that occurs in ``links``: root is the smallest node reachable.

    Nulls, self links and repeated links are ignored; an empty table gives an empty table.
    """
    e = cut(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct())
    before = _signature(e)
    while before[0]:
        p = cut(e.groupBy("u").agg(F.min("v").alias("p")))
        large = e.join(p.select(F.col("u").alias("v"), "p"), "v", "left").select("u", F.coalesce("p", "v").alias("v")).distinct()
        # the links that share u after the large step: their smallest v becomes the parent of the others
        best = large.groupBy("u").agg(F.min("v").alias("p"))
        small = large.join(best, "u").select(F.explode(F.array(
            F.struct(F.col("u"), F.col("p").alias("v")), F.struct(F.col("v").alias("u"), F.col("p").alias("v")))).alias("x"))
        e = cut(small.select("x.u", "x.v").where("u > v").distinct())
        after = _signature(e)
        if after == before:
            break
        before = after
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _signature(e: DataFrame) -> tuple:
    h = F.xxhash64("u", "v")
    r = e.select(F.count(F.lit(1)), F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))), F.sum(F.shiftrightunsigned(h, 32))).first()
    return tuple(r)
