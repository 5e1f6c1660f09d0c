"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.llm.common import dropped, join_by_key, stored


def _least(links: DataFrame) -> DataFrame:
    """(node, least, links): the smallest neighbour of each node, or the node itself, and how many it has."""
    return links.groupBy("node").agg(F.min("other").alias("least"), F.count("*").alias("links")).withColumn(
        "least", F.least("node", "least")
    )


def _stars(links: DataFrame, larger_only: bool) -> DataFrame:
    """Each neighbour is linked to the smallest of the neighbourhood instead of to the node: in the large
    star all larger neighbours, in the small star the smaller ones and the node itself."""
    least = stored(_least(links), "least")
    moved = join_by_key(links, least, "node", "links")
    if larger_only:
        out = moved.filter(F.col("other") > F.col("node")).select(F.col("other").alias("node"), F.col("least").alias("other"))
    else:
        out = moved.select(F.col("other").alias("node"), F.col("least").alias("other")).unionByName(
            least.select("node", F.col("least").alias("other"))
        )
    return out.filter(F.col("node") > F.col("other")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for each node of links (a long, b long): component is the smallest node that can
    be reached. The number of rounds grows with the logarithm of the number of nodes. Hot nodes are handled
    by `join_by_key`; each round is stored, so nothing of it is computed again. Null ends and loops are
    left out; no links give no rows."""
    now = links.filter("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").alias("node"), F.least("a", "b").alias("other")
    ).distinct()
    now = stored(now, "links")
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("other").alias("node"), F.col("node").alias("other")))
        large = stored(_stars(both, larger_only=True), "large")
        small = stored(_stars(large, larger_only=False), "small")
        dropped(large, now)
        now, before = small, mark
        mark = _mark(now)
        if mark == before:
            break
    return now.select("node", F.col("other").alias("component")).unionByName(
        now.select(F.col("other").alias("node"), F.col("other").alias("component")).distinct()
    )


def _mark(links: DataFrame) -> tuple:
    """Tells whether a round has changed anything."""
    row = links.agg(F.count("*"), F.sum(F.xxhash64("node", "other").cast("decimal(38,0)"))).first()
    return tuple(row)
