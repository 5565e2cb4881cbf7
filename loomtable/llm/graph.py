"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtable.llm.common import written


def components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """Smallest reachable node of each node that has an edge.

    ``edges`` has columns a, b (long; order, loops and repeats don't matter). Returns node, root. Alternating
    large-star and small-star steps (Kiveris et al., 2014) need logarithmically many rounds; each round is two
    aggregates and two joins, whose hot keys AQE can split, and is written to the shared folder. Nothing but a count
    and a checksum reaches the driver. An empty edge table gives no rows; null ends are dropped.
    """
    now = written(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    seen = None
    for _ in range(max_rounds):
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            break
        seen = mark
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        now = written(
            joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
            .where("u <> v")
            .distinct()
        )
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
