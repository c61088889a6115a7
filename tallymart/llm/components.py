"""Connected components of a distributed graph, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm.frames import Shelf


def components(edges: DataFrame, shelf: Shelf, name: str) -> DataFrame:
    """(node, root) of every node that has an edge and is not itself the root, its least node.

    ``edges`` are pairs (u, v) in any order. Each round hangs every node's larger neighbours, then
    its smaller ones, under the least node it knows. A node's neighbours are never collected: they
    are joined with the node's minimum, where a hub's rows can be split. Rounds end when nothing
    moved.
    """
    u, v = F.greatest("u", "v"), F.least("u", "v")
    now = shelf.put(edges.where("u <> v").select(u.alias("u"), v.alias("v")).distinct(), f"{name}0", slim=True)
    seen, turn = _state(now), 0
    while seen[0]:
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
        least = least.select("w", F.least("w", "m").alias("m"))
        large = (
            both.join(least, F.col("u") == F.col("w"))
            .where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        least = large.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
        joined = large.join(least, F.col("u") == F.col("w"))
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        own = least.select(F.col("w").alias("u"), F.col("m").alias("v"))
        turn += 1
        now = shelf.put(small.unionAll(own).distinct(), f"{name}{turn}", slim=True)
        before, seen = seen, _state(now)
        if turn > 1:
            shelf.drop(f"{name}{turn - 1}")
        if seen == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _state(edges: DataFrame) -> tuple:
    hashed = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.bit_xor(hashed), F.sum(F.pmod(hashed, F.lit(1 << 30)))).first())
