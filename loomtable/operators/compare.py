"""Comparison of evaluation runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Headings of the report (fixed values: readers of earlier reports look for them).
TITLE, NOTHING = "# Evaluation Comparison Report\n", "No results to compare.\n"
EXACT = ("## Exact Match\n", "| Run | Exact Match | Samples |", "|-----|------------|---------|")

def across(values: DataFrame, key: str, runs: Sequence[str], *, by_name: bool = False) -> DataFrame:
    """One row for each key, one column for each run; 0.0 where a run has no such key.

    ``values`` has run, ord, ``key``, accuracy. Keys go in the order in which runs list them first (U02), or by name.
    """
    wide = values.groupBy(key).pivot("run", list(runs)).agg(F.first("accuracy"))
    first = values.groupBy(key).agg(F.min(F.struct(F.array_position(F.array(*map(F.lit, runs)), F.col("run")).alias("run"), F.col("ord"))).alias("at"))
    filled = wide.select(key, *[F.coalesce(F.col(f"`{r}`"), F.lit(0.0)).alias(r) for r in runs])
    if by_name:
        return filled.orderBy(key)
    return filled.join(first, key).orderBy("at").drop("at")


def delta(values: DataFrame, key: str, old: str, new: str) -> DataFrame:
    """new - old for each key, and its sign (J05); a key that one run lacks counts 0.0 there."""
    return across(values, key, [old, new], by_name=True).select(
        key, F.col(f"`{old}`").alias("old"), F.col(f"`{new}`").alias("new"), (F.col(f"`{new}`") - F.col(f"`{old}`")).alias("delta")
    ).withColumn("sign", F.signum("delta").cast("int"))


def results_table(results: DataFrame, what: str = "per_attribute", run: str = "run") -> DataFrame:
    """run, ord, name, accuracy of the map column ``what`` of evaluation results."""
    return results.select(F.col(run).alias("run"), F.posexplode(F.map_entries(what)).alias("ord", "e")).select("run", "ord", F.col("e.key").alias("name"), F.col("e.value").alias("accuracy"))


def compared(paths: Sequence[str], names: Sequence[str] | None = None) -> str:
    """The report over result files (G07); runs are called by their folders unless named."""
    from pathlib import Path

    from loomtable.sources.files import load_result

    names = names or [Path(p).parent.name or Path(p).stem for p in paths]
    return report([(n, load_result(p)) for n, p in zip(names, paths, strict=True)])


def _table(title: str, first: str, runs: Sequence[str], rule: str, rows: list[tuple[str, list[float]]]) -> list[str]:
    head = [f"## {title}\n", f"| {first} | " + " | ".join(runs) + " |", rule + "|".join(["----------"] * len(runs)) + "|"]
    return [*head, *["| " + " | ".join([name, *(f"{v:.1%}" for v in values)]) + " |" for name, values in rows], ""]


def report(results: Sequence[tuple[str, dict]]) -> str:
    """Markdown comparison of named results (G06); one that has no categories counts 0.0 in them."""
    if not results:
        return NOTHING
    runs = [name for name, _ in results]
    lines = [TITLE, *EXACT]
    lines += [f"| {name} | {r['exact_match']:.1%} | {r['total_samples']} |" for name, r in results]
    lines.append("")
    pick = lambda what, key: [(r.get(what) or {}).get(key, 0.0) for _, r in results]
    names = list(dict.fromkeys(a for _, r in results for a in r["per_attribute"]))
    if names:
        lines += _table("Per-Attribute Accuracy", "Attribute", runs, "|-----------|", [(a, pick("per_attribute", a)) for a in names])
    cats = sorted({c for _, r in results for c in (r.get("category_breakdown") or {})})
    if cats:
        lines += _table("Per-Category Exact Match", "Category", runs, "|----------|", [(c, pick("category_breakdown", c)) for c in cats])
    return "\n".join(lines)
