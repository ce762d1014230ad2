"""Connected components of an edge table by alternating large-star and small-star rounds.

Each round is two aggregations and two joins on a node; no component, however large, is ever gathered in one task, and joins on a
hot node can be split.  The number of rounds grows with the logarithm of the component size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import dropped, written


def _oriented(e: DataFrame, keys: Sequence[str]) -> DataFrame:
    return e.where("a != b").select(*keys, F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(e: DataFrame, keys: Sequence[str]) -> DataFrame:
    both = e.union(e.select(*keys, F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(*keys, "a").agg(F.min("b").alias("m")).select(*keys, "a", F.least("a", "m").alias("m"))
    return _oriented(both.where("b > a").join(least, [*keys, "a"]).select(*keys, F.col("b").alias("a"), F.col("m").alias("b")), keys)


def _small_star(e: DataFrame, keys: Sequence[str]) -> DataFrame:
    least = e.groupBy(*keys, "a").agg(F.min("b").alias("m"))
    return _oriented(e.join(least, [*keys, "a"]).select(*keys, F.col("b").alias("a"), F.col("m").alias("b")).union(least.select(*keys, "a", F.col("m").alias("b"))), keys)


def _state(e: DataFrame, keys: Sequence[str]) -> tuple:
    return tuple(e.agg(F.count("*"), F.sum(F.xxhash64(*keys, "a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, keys: Sequence[str] = (), rounds: int = 60) -> DataFrame:
    """(keys, node, component): every node of `edges` (keys, a, b: long) but the smallest of each component, with that smallest node.

    Edges of different keys belong to different graphs.  An empty edge table gives an empty result; loops and repeated edges don't matter.
    """
    e = written(_oriented(edges.select(*keys, "a", "b"), keys), "edges")
    state = _state(e, keys)
    for _ in range(rounds if state[0] else 0):
        nxt = written(_small_star(_large_star(e, keys), keys), "edges")
        after = _state(nxt, keys)
        dropped(e)
        e, same = nxt, after == state
        state = after
        if same:
            break
    else:
        if state[0]:
            raise RuntimeError(f"components did not settle in {rounds} rounds")
    return e.select(*keys, F.col("a").alias("node"), F.col("b").alias("component"))
