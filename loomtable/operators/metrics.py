"""Evaluation of predicted attributes against the truth."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtable.functions.text import folded

UNKNOWN = "unknown"


def paired(predictions: DataFrame, truths: DataFrame, seq: str = "seq") -> DataFrame:
    """seq, prediction, ground_truth of rows that belong together (J01); the job fails if one side has a row without the other."""
    both = predictions.select(seq, "prediction", F.lit(True).alias("__p")).join(truths.select(seq, "ground_truth", F.lit(True).alias("__t")), seq, "full_outer")
    alone = F.raise_error("predictions and truths differ in their rows").cast("boolean")
    return both.where(F.when(F.col("__p").isNull() | F.col("__t").isNull(), alone).otherwise(True)).drop("__p", "__t")


def _same(p: Column, t: Column, key: Column) -> Column:
    none = F.lit("none")  # a null value reads as that word on both sides
    return F.coalesce(folded(p[key]), none) == F.coalesce(folded(t[key]), none)


def same_keys(p: Column, t: Column) -> Column:
    """Whether both maps have the same keys."""
    return F.array_sort(F.map_keys(p)) == F.array_sort(F.map_keys(t))


def exact(p: Column, t: Column) -> Column:
    """Whether both maps have the same keys and equal values, without regard to case and outer space."""
    return same_keys(p, t) & F.forall(F.map_keys(t), lambda k: _same(p, t, k))


def exact_match(rows: DataFrame) -> DataFrame:
    """exact_match, total_samples; 0.0 without rows."""
    flag = exact(F.col("prediction"), F.col("ground_truth")).cast("int")
    return rows.agg(F.coalesce(F.avg(flag), F.lit(0.0)).alias("exact_match"), F.count("*").alias("total_samples"))


def hit(p: Column, t: Column, name: str) -> Column:
    """Whether an attribute is right: a null or missing value on either side is wrong."""
    return F.coalesce(folded(p[name]) == folded(t[name]), F.lit(False)).cast("int")


def per_attribute(rows: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """attribute, accuracy for each attribute in one pass; the denominator is all rows, 0.0 without any."""
    one = rows.agg(*[F.coalesce(F.avg(hit(F.col("prediction"), F.col("ground_truth"), a)), F.lit(0.0)).alias(f"a{i}") for i, a in enumerate(attributes)])
    pairs = F.array(*[F.struct(F.lit(i).alias("ord"), F.lit(a).alias("attribute"), F.col(f"a{i}").alias("accuracy")) for i, a in enumerate(attributes)])
    return one.select(F.explode(pairs).alias("x")).select("x.ord", "x.attribute", "x.accuracy")


def category(t: Column, name: str) -> Column:
    """A row's category: unknown if absent, the word None if null."""
    return F.when(~F.map_contains_key(t, F.lit(name)), UNKNOWN).otherwise(F.coalesce(t[name], F.lit("None")))


def by_category(rows: DataFrame, name: str) -> DataFrame:
    """category, exact_match, n for each category of the truth, sorted."""
    flag = exact(F.col("prediction"), F.col("ground_truth")).cast("int")
    return rows.groupBy(category(F.col("ground_truth"), name).alias("category")).agg(F.avg(flag).alias("exact_match"), F.count("*").alias("n")).orderBy("category")


def summary(rows: DataFrame, attributes: Sequence[str], category_field: str | None = None) -> DataFrame:
    """overall, category, exact_match, total_samples and the accuracy of each attribute (a0, a1, ...), for all rows and, with a category field,
    for each category: grouping sets over one scan (A03, A04)."""
    p, t = F.col("prediction"), F.col("ground_truth")
    named = rows.withColumn("category", category(t, category_field) if category_field else F.lit(None).cast("string"))
    flags = named.select("category", exact(p, t).cast("int").alias("exact"), *[hit(p, t, a).alias(f"h{i}") for i, a in enumerate(attributes)])
    sets = [[F.col("category")], []] if category_field else [[]]
    grouped = flags.groupingSets(sets, F.col("category"))
    return grouped.agg(
        (F.grouping("category") == 1).alias("overall"), F.avg("exact").alias("exact_match"), F.count("*").alias("total_samples"), *[F.avg(f"h{i}").alias(f"a{i}") for i in range(len(attributes))]
    )


def evaluate(rows: DataFrame, attributes: Sequence[str], category_field: str | None = None) -> dict:
    """All metrics of a run as plain values (A04), with the time in UTC (T26). One pass over the rows."""
    got = summary(rows, attributes, category_field).orderBy("category").collect()  # a row for all, and one a category
    whole = next((r for r in got if r.overall), None)
    cats = {r.category: r.exact_match for r in got if not r.overall} if category_field else None
    return {
        "exact_match": whole.exact_match if whole else 0.0, "per_attribute": {a: whole[f"a{i}"] if whole else 0.0 for i, a in enumerate(attributes)}, "category_breakdown": cats,
        "total_samples": whole.total_samples if whole else 0, "timestamp": datetime.now(timezone.utc).isoformat(),
    }


def nested(result: dict) -> dict:
    """A run's metrics as reports of benchmarks nest them (P13): overall figures, then one object for each attribute and category."""
    overall = {k: result[k] for k in ("exact_match", "total_samples", "timestamp")}
    parts = {"per_attribute": result["per_attribute"], "category_breakdown": result.get("category_breakdown") or {}}
    return overall | {what: {name: {"accuracy": value} for name, value in found.items()} for what, found in parts.items()}


def label_shares(rows: DataFrame, label: str, top: int = 20) -> DataFrame:
    """The ``top`` most frequent labels with their share of all rows."""
    counts = rows.groupBy(label).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.crossJoin(F.broadcast(total)).select(label, "n", (F.col("n") / F.col("total")).alias("share")).orderBy(F.desc("n"), label).limit(top)


def spread(runs: DataFrame, by: str, value: str) -> DataFrame:
    """Mean and sample standard deviation of a value over runs."""
    return runs.groupBy(by).agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.count("*").alias("runs"))
