"""Exact percentiles of groups of any size, without a buffer that grows with a group.

A wanted value is a rank. The values of its group are counted in bins, first by their power of two, then in equal steps between
the least and greatest value of the bin that holds the rank. Bins are counted where the rows are and only counts are shuffled. Once a bin holds few
values, or a single one, it is sorted and the rank picked. A group that is small from the start needs no bins at all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from loomtable.sources.shared import written

#: Values that are sorted in one place.
AT_ONCE = 100_000
BINS = 1024
_SPAN = ["g", "c", "lo", "hi"]


def _binade(x: Column) -> Column:
    """A whole number in the order of x: its sign and power of two; 0 for zero."""
    power = F.least(F.floor(F.log2(F.abs(x))).cast("double"), F.lit(1100.0)) + 2000
    return F.when(x == 0, 0.0).otherwise(F.signum(x) * power)


def _narrowed(values: DataFrame, spans: DataFrame, powers: bool, bins: int) -> DataFrame:
    """Spans (g, c, k, lo, hi, before, size) whose rank k lies among fewer values: those of its bin."""
    step = _binade(F.col("x")) if powers else F.least(F.floor((F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1))
    inside = values.join(spans.select(*_SPAN).distinct(), ["g", "c"]).where("x >= lo and x <= hi")
    counts = inside.groupBy(*_SPAN, step.alias("bin")).agg(F.count("*").alias("m"), F.min("x").alias("least"), F.max("x").alias("most"))
    counts = counts.withColumn("below", F.sum("m").over(W.partitionBy(*_SPAN).orderBy("bin")) - F.col("m"))  # a row a bin
    at = F.col("k") - F.col("before")
    return spans.join(counts, _SPAN).where((at >= F.col("below")) & (at < F.col("below") + F.col("m"))).select(
        "g", "c", "k", F.col("least").alias("lo"), F.col("most").alias("hi"), (F.col("before") + F.col("below")).alias("before"), F.col("m").alias("size")
    )


def percentiles(rows: DataFrame, by: Sequence[str], wanted: dict[str, tuple[Column, float]], at_once: int = AT_ONCE, bins: int = BINS) -> DataFrame:
    """The columns ``by`` and, under each name, the percentile (0 to 100) of a column with linear interpolation.

    Nulls and NaN count for nothing; a group without a value has no percentile, and no row if it has none at all. A null is
    a group of its own. Ties and infinite values are values like others. No task holds more than ``at_once`` values or ``bins`` counts of a group.
    """
    columns: dict[str, tuple[int, Column]] = {}
    for x, _ in wanted.values():
        columns.setdefault(str(x), (len(columns), x))
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("c"), x.cast("double").alias("x")) for i, x in columns.values()]))
    values = rows.select(F.struct(*by, F.lit(0).alias("__all")).alias("g"), each.alias("v")).select("g", "v.c", "v.x").where(F.col("x").isNotNull() & ~F.isnan("x"))
    counts = values.groupBy("g", "c").agg(F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    asked = F.explode(F.array(*[F.struct(F.lit(columns[str(x)][0]).alias("of"), F.lit(name).alias("name"), F.lit(p / 100).alias("p")) for name, (x, p) in wanted.items()]))
    ranks = counts.select("*", asked.alias("a")).where("c = a.of").withColumn("r", (F.col("n") - 1) * F.col("a.p")).withColumn("k", F.floor("r"))
    two = F.explode(F.array(F.struct("k", (1 - (F.col("r") - F.col("k"))).alias("w")), F.struct((F.col("k") + 1).alias("k"), (F.col("r") - F.col("k")).alias("w"))))
    targets = written(ranks.select("g", "c", "n", "lo", "hi", "a.name", two.alias("t")).where("t.w > 0").select("g", "c", "n", "lo", "hi", "name", "t.k", "t.w"))
    spans = targets.select("g", "c", "k", "lo", "hi", F.lit(0).cast("long").alias("before"), F.col("n").alias("size")).distinct()
    wide, powers = (F.col("size") > at_once) & (F.col("lo") < F.col("hi")), True
    while not spans.where(wide).isEmpty():
        spans = written(spans.where(~wide).unionByName(_narrowed(values, spans.where(wide), powers, bins)))
        powers = False
    many = spans.where("lo < hi")
    held = values.join(many.select(*_SPAN, "before").distinct(), ["g", "c"]).where("x >= lo and x <= hi")
    sorted_ = held.groupBy(*_SPAN, "before").agg(F.sort_array(F.collect_list("x")).alias("xs"))  # at_once values at most
    picked = many.join(sorted_, [*_SPAN, "before"]).select("g", "c", "k", F.get("xs", (F.col("k") - F.col("before")).cast("int")).alias("value"))
    found = picked.unionByName(spans.where("lo = hi").select("g", "c", "k", F.col("lo").alias("value")))
    named = targets.join(found, ["g", "c", "k"]).groupBy("g", "name").agg(F.sum(F.col("w") * F.col("value")).alias("value"))
    one = named.groupBy("g").agg(*[F.max(F.when(F.col("name") == name, F.col("value"))).alias(name) for name in wanted])
    return one.select(*[F.col(f"g.`{c}`").alias(c) for c in by], *[F.col(f"`{name}`") for name in wanted])
