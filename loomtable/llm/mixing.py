"""Mixing sources to target weights with exact budgets, in DataFrame operations only.

Each row gets a hash-random key (md5 of its id). Rows are range-sorted by that key within their source: a range of
keys is a bucket, so a source with a third of all rows is many buckets. Sums over (source, bucket) are small; their
prefix sums give each bucket its offset, and a running sum inside the bucket gives each row its place in its source.
A source takes as many whole epochs as its target holds, then rows in key order up to the exact word that remains.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

#: Rows of a key range, and ranges at most: beyond, ranges grow instead of the table of their sums.
ROWS_A_BUCKET, MOST_BUCKETS = 1_000, 100_000


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), most: int = 3) -> DataFrame:
    """source, source_size, target from a table (source, source_size) with one row for each source.

    Sources in code point order, null last, weigh ``weights`` in turn. Targets share the whole size by weight but stop
    at ``most`` times their source's size; the excess goes to the others by weight until none is above. In order of
    most * size / weight the stopped sources come first, so one running sum finds where sharing holds: no iteration.
    """
    by_name = W.orderBy(F.col("source").isNull(), "source")
    by_room = W.orderBy("room", "no")
    before = by_room.rowsBetween(W.unboundedPreceding, -1)
    every = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("no") - 1, F.lit(len(weights))) + 1).cast("int"))
    return (
        sizes.withColumn("no", F.row_number().over(by_name))
        .withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * most)
        .withColumn("room", F.col("cap") / F.col("weight"))
        .withColumn("left", F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("share", F.col("left") / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
        .withColumn("holds", F.col("share") <= F.col("room"))
        .withColumn("level", F.min_by("share", F.when(F.col("holds"), F.struct("room", "no"))).over(every))
        .withColumn("first", F.min(F.when(F.col("holds"), F.struct("room", "no"))).over(every))
        .select(
            "source",
            "source_size",
            F.when(F.struct("room", "no") < F.col("first"), F.col("cap").cast("double"))
            .otherwise(F.col("weight") * F.col("level"))
            .alias("target"),
        )
    )


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = (5, 2, 1),
    most: int = 3,
    keep: Sequence[str] = (),
) -> DataFrame:
    """doc_id, size, source_size, target, taken for each row, and the columns named in ``keep``.

    size is the number of words (null and empty texts: 0, and take nothing). A null source is a source of its own, the
    last. taken counts words over all epochs: whole epochs times size, and in the last epoch the row's words up to the
    source's exact budget, the whole part of its target; a text of any length is counted whole. Rows that repeat an id are
    rows like any other: equal keys go by size, then by a hash of the text, so only equal rows may swap. Rows without an id
    have the key of their text, so they are spread as well. An empty table gives no rows. Columns outside ``keep`` are ignored,
    whatever their names; names in ``keep`` must differ from the five.
    """
    buckets = max(1, min(MOST_BUCKETS, -(-docs.count() // ROWS_A_BUCKET)))
    key = F.md5(F.coalesce(F.col(doc_id).cast("string"), F.concat(F.lit(" "), F.col(text)), F.lit("")).cast("binary"))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("__source"), n_words(F.col(text)).alias("size"), key.alias("__key"), F.xxhash64(F.col(text)).alias("__hash"),
        *[F.col(f"`{c}`") for c in keep if c != "doc_id"],
    ).withColumn("__bucket", F.floor(F.conv(F.substring("__key", 1, 8), 16, 10).cast("long") * buckets / F.lit(1 << 32)).cast("int"))
    sums = rows.groupBy("__source", "__bucket").agg(F.sum("size").alias("part"))
    aims = targets(sums.groupBy(F.col("__source").alias("source")).agg(F.sum("part").alias("source_size")), weights, most)
    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    plan = (
        sums.join(aims, F.col("__source").eqNullSafe(F.col("source")))
        .withColumn("__offset", F.sum("part").over(W.partitionBy("__source").orderBy("__bucket")) - F.col("part"))
        .select(
            F.col("__source").alias("p_source"), F.col("__bucket").alias("p_bucket"), "source_size", "target", "__offset",
            epochs.alias("__epochs"), (budget - epochs * F.col("source_size")).alias("__rest"),
        )
    )
    inside = W.partitionBy("__source", "__bucket").orderBy("__key", "doc_id", "size", "__hash").rowsBetween(W.unboundedPreceding, 0)
    placed = rows.withColumn("__before", F.sum("size").over(inside) - F.col("size")).join(
        plan, F.col("__source").eqNullSafe(F.col("p_source")) & (F.col("__bucket") == F.col("p_bucket"))
    )
    last = F.greatest(F.lit(0), F.least(F.col("size"), F.col("__rest") - F.col("__offset") - F.col("__before")))
    return placed.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("__epochs") + last).cast("long").alias("taken"),
        *[F.col(f"`{c}`") for c in keep if c != "doc_id"],
    )


SQL = r"""
WITH s AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(CAST(doc_id AS VARCHAR)) AS k
  FROM {docs}),
p AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM s GROUP BY source),
n AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS no FROM p),
v AS (SELECT *, CASE (no - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, source_size * 3 AS cap FROM n),
r AS (SELECT *, CAST(cap AS DOUBLE) / weight AS room FROM v),
h AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0) AS DOUBLE)
            / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS DOUBLE) AS share,
         row_number() OVER (ORDER BY room, no) AS place
  FROM r WINDOW b AS (ORDER BY room, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT min(place) AS first FROM h WHERE share <= room),
t AS (
  SELECT source, source_size,
         CASE WHEN place < first THEN CAST(cap AS DOUBLE) ELSE weight * (SELECT share FROM h WHERE place = first) END AS target
  FROM h, f),
b AS (
  SELECT t.*, CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS epochs FROM t)
SELECT {keep} size, source_size, target,
       CAST(size * epochs + greatest(0, least(size, CAST(floor(target) AS BIGINT) - epochs * source_size - before)) AS BIGINT) AS taken
FROM (SELECT s.*, CAST(sum(size) OVER (PARTITION BY source ORDER BY k, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS before FROM s) x
JOIN b ON x.source IS NOT DISTINCT FROM b.source
"""
