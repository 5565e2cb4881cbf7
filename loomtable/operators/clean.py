"""Cleaning: one pass that gives each listing its first reason to be dropped, or none."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtable.functions import text as X
from loomtable.plans.schema import Schema
from loomtable.sources.shared import written

REASONS = ("empty_title", "invalid_attrs", "duplicates", "missing_images")


def valid(attributes: Column, schema: Schema) -> Column:
    """Required attributes present (F02); enum values among the allowed ones, without regard to case."""
    tests: list[Column] = []
    for a in schema.attributes:
        value = F.coalesce(attributes[a.name], F.lit(""))
        if a.required:
            tests.append(value != "")
        if a.type == "enum":
            tests.append((value == "") | X.folded(value).isin([v.strip().lower() for v in a.values]))
    return reduce(lambda x, y: x & y, tests, F.lit(True))


def has_images(image_urls: Column) -> Column:
    """Whether a listing has an image."""
    return F.size(F.coalesce(image_urls, F.array().cast("array<string>"))) > 0


def normalised(listings: DataFrame) -> DataFrame:
    """Titles and attribute values in their normal form (T01, T02); a null title counts as empty, a null attribute as absent."""
    present = F.map_filter(F.coalesce("attributes", F.create_map().cast("map<string,string>")), lambda k, v: v.isNotNull())
    return listings.withColumn("title", X.normal(F.coalesce("title", F.lit("")))).withColumn("attributes", present).withColumn("attributes", X.normal_values(F.col("attributes")))


def keyed(listings: DataFrame, schema: Schema) -> DataFrame:
    """``listings`` normalised, with content_hash and __first: the reason that a listing has in itself."""
    rows = normalised(listings).withColumn("content_hash", X.content_hash(F.col("title"), F.col("attributes")))
    return rows.withColumn("__first", F.when(F.col("title") == "", F.lit("empty_title")).when(~valid(F.col("attributes"), schema), F.lit("invalid_attrs")))


def with_reason(listings: DataFrame, schema: Schema, *, deduplicate: bool = True, require_images: bool = False, seq: str = "seq") -> DataFrame:
    """``listings`` normalised, with content_hash and drop_reason.

    Reasons come in order: empty title, invalid attributes, duplicate of an earlier valid listing (same title and
    attributes; the smallest ``seq`` stays, A06), no image. Duplicates are found before images are looked at, so a
    first copy without an image takes the others with it. ``seq`` tells rows apart. Hashes of valid rows alone are shuffled
    and reduced to their smallest ``seq`` before that, so a hash that a third of all rows share is one row a task; listings
    meet the ``seq`` of duplicates, and stay where they are while those are few enough for the planner to broadcast.
    """
    rows = keyed(listings, schema)
    if deduplicate:
        rows = written(rows)  # normalised and hashed once; what follows reads it
    last = F.when(~has_images(F.col("image_urls")), F.lit("missing_images")) if require_images else F.lit(None).cast("string")
    if deduplicate:
        hashes = rows.where("__first is null").select("content_hash", seq)
        many = hashes.groupBy("content_hash").agg(F.min(seq).alias("__least"), F.count("*").alias("__n")).where("__n > 1")
        later = hashes.join(many, "content_hash").where(F.col(seq) > F.col("__least")).select(seq, F.lit("duplicates").alias("__again"))
        rows = rows.join(later, seq, "left")
    else:
        rows = rows.withColumn("__again", F.lit(None).cast("string"))
    return rows.withColumn("drop_reason", F.coalesce("__first", "__again", last)).drop("__first", "__again")


def clean(listings: DataFrame, schema: Schema, **options) -> DataFrame:
    """The listings that stay."""
    return with_reason(listings, schema, **options).where("drop_reason is null").drop("drop_reason", "content_hash")


def counters() -> list[Column]:
    """total, kept and each reason, as aggregates: of a table, or observed while it is written."""
    each = [F.count_if(F.col("drop_reason") == r).alias(r) for r in REASONS]
    return [F.count("*").alias("total"), F.count_if(F.col("drop_reason").isNull()).alias("kept"), *each]


def reasons(rows: DataFrame) -> DataFrame:
    """One row of counters (A05): total, kept and each reason."""
    return rows.agg(*counters())


def first_by(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row by ``order`` of each group of equal keys: a least value, not a sort, so a key that many rows share is one row a task."""
    whole = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    return rows.groupBy(*keys).agg(F.min_by(whole, F.struct(*order)).alias("__first")).select("__first.*")


def distinct_listings(listings: DataFrame, keys: list[str], seq: str = "seq") -> DataFrame:
    """First by ``seq`` of each group of equal keys."""
    return first_by(listings, keys, [seq])
