"""Reproducible splits with exact sizes: order is a hash of seed and key, so partitions don't matter.

No rank is made in one task. Keys fall into ranges of their hash; counts of the ranges give each range its first rank,
and rows are ranked inside their range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from loomtable.plans.config import shares
from loomtable.sources.shared import written

ROWS_A_RANGE = 50_000
MISSING = "_unknown_"


def order_hash(seed: int, key: Column) -> Column:
    """Pseudo-random order of a key."""
    return F.md5(F.concat(F.lit(f"{seed}|"), key.cast("string")).cast("binary"))


def ranked(df: DataFrame, key: str, seed: int, by: Sequence[str] = ()) -> DataFrame:
    """``df`` with rank (from 1) and n (rows) within each group of ``by``, in order of the seeded hash of ``key``."""
    ranges = max(1, -(-df.count() // ROWS_A_RANGE))
    rows = df.withColumn("__h", order_hash(seed, F.col(key)))
    rows = rows.withColumn("__r", F.floor(F.conv(F.substring("__h", 1, 8), 16, 10).cast("long") * ranges / F.lit(1 << 32)).cast("int"))
    groups = [F.coalesce(F.col(c).cast("string"), F.lit(MISSING)).alias(f"__g{i}") for i, c in enumerate(by)]
    names = [f"__g{i}" for i in range(len(by))]
    rows = rows.select("*", *groups)
    counts = rows.groupBy(*names, "__r").agg(F.count("*").alias("__c"))
    each = W.partitionBy(*names) if names else W.partitionBy(F.lit(0))
    starts = counts.withColumn("__before", F.sum("__c").over(each.orderBy("__r")) - F.col("__c")).withColumn("n", F.sum("__c").over(each)).drop("__c")
    inside = W.partitionBy(*names, "__r").orderBy("__h", key)
    placed = rows.withColumn("__in", F.row_number().over(inside)).join(starts, [*names, "__r"])
    return placed.withColumn("rank", (F.col("__before") + F.col("__in")).cast("long")).drop("__h", "__r", "__in", "__before", *names)


def in_order(df: DataFrame, seq: str) -> DataFrame:
    """``df`` with place, from 0, in order of ``seq``: range-sorted, numbered inside each range, shifted by the ranges before it.

    The numbered rows are written before they are counted. Ranges come from a sample, so rows that are sorted again for the count may
    fall into other ranges than those that were numbered, and a join of the two would lose some and repeat others.
    """
    rows = written(df.repartitionByRange(seq).sortWithinPartitions(seq).withColumn("__p", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id()))
    counts = rows.groupBy("__p").agg(F.count("*").alias("__n"), F.min("__at").alias("__first"))
    before = F.sum("__n").over(W.orderBy("__p")) - F.col("__n")  # a row for each range
    shifts = written(counts.select("__p", (before - F.col("__first")).alias("__shift")))
    return rows.join(shifts, "__p").withColumn("place", F.col("__at") + F.col("__shift")).drop("__p", "__at", "__shift")


def part_of(rank: Column, n: Column, ratio: tuple[float, float, float]) -> Column:
    """train, val or test by rank: floors of the first two shares, the rest is test."""
    train = F.floor(n * F.lit(float(ratio[0])))
    val = F.floor(n * F.lit(float(ratio[1])))
    return F.when(rank <= train, "train").when(rank <= train + val, "val").otherwise("test")


def category_counts(df: DataFrame, category: str) -> DataFrame:
    """category, n, and whether it is lonely, with fewer than two rows (A07); a missing one is a category of its own."""
    counts = df.groupBy(F.coalesce(F.col(category).cast("string"), F.lit(MISSING)).alias("category")).agg(F.count("*").alias("n"))
    return counts.withColumn("lonely", F.col("n") < 2)


def split(
    df: DataFrame, key: str, ratio: tuple[float, float, float] = (0.8, 0.1, 0.1), category: str | None = None, seed: int = 42
) -> DataFrame:
    """``df`` with a column split (U05). With a category each category is split by itself (U06), a missing one as a
    category of its own; if any category has a single row, all rows are split together instead (A07)."""
    ratio = shares(ratio)
    if category is not None:
        lonely = category_counts(df, category).agg(F.bool_or("lonely")).first()[0]
        by = [category] if lonely is False else []
    else:
        by = []
    rows = ranked(df, key, seed, by)
    return rows.withColumn("split", part_of(F.col("rank"), F.col("n"), ratio)).drop("rank", "n")


def reshuffled(rows: DataFrame, key: str, seed: int = 42, split: str = "split") -> DataFrame:
    """Split rows with place, from 1, in a new seeded order inside each part (O06): categories no longer stand together."""
    return ranked(rows, key, seed + 1, (split,)).withColumnRenamed("rank", "place").drop("n")


def sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows by the seeded order, all if ``n`` is 0 or too large."""
    return df.orderBy(order_hash(seed, F.col(key)), key).limit(n) if n else df


def limited(df: DataFrame, seq: str, n: int | None) -> DataFrame:
    """The first ``n`` rows by ``seq``; no limit if it is 0 or None."""
    return df.orderBy(seq).limit(n) if n else df


def cycled(df: DataFrame, seq: str, n: int, skip: int = 0) -> DataFrame:
    """``n`` requests that go round the rows in order after the first ``skip`` (W06): i and the row's columns."""
    size = df.count()
    if not size:
        return df.select(F.lit(0).cast("long").alias("i"), *df.columns)
    rows = df.orderBy(seq).limit(min(size, skip % size + n) if n < size else size)  # no more than the requests reach
    if skip % size + n > size:
        rows = df
    rows = in_order(rows, seq).withColumnRenamed("place", "__k")
    asked = df.sparkSession.range(n).select(F.col("id").alias("i"), F.pmod(F.col("id") + skip, F.lit(size)).alias("__k"))
    return asked.join(rows, "__k").drop("__k")
