"""Writers: distributed ones for rows, driver-side ones for results and reports, which are a few lines each."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from loomtable.functions.text import json_text


def write_jsonl(df: DataFrame, path: str) -> None:
    """One object a line, other than ASCII as it is, nulls kept."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_text(df: DataFrame, column: str, path: str) -> None:
    """Lines made elsewhere, for byte-exact JSON."""
    df.select(F.col(column).alias("value")).write.mode("overwrite").text(path)


def write_json_arrays(df: DataFrame, path: str) -> None:
    """JSON arrays, one in each part file, an object a line (K04 for tables of any size): no row leaves its task. ``files.read_array`` reads them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead = "["
        for b in batches:
            if b.num_rows:
                lines = b.column(0).to_pylist()
                yield pa.RecordBatch.from_arrays([pa.array([(lead if i == 0 else ",") + t for i, t in enumerate(lines)])], names=["value"])
                lead = ","
        yield pa.RecordBatch.from_arrays([pa.array(["[]" if lead == "[" else "]"])], names=["value"])

    df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).mapInArrow(run, "value string").write.mode("overwrite").text(path)


class counts_of:  # noqa: N801  reads like a function
    """The rows of each split, counted while they are written: the plan runs once."""

    def __init__(self, split: str = "split") -> None:
        self.split, self.seen, self.names = split, Observation(), ("train", "val", "test")

    def on(self, df: DataFrame) -> DataFrame:
        return df.observe(self.seen, *[F.count_if(F.col(self.split) == s).alias(s) for s in self.names])

    def get(self) -> dict[str, int]:
        found = self.seen.get
        return {s: found.get(s) or 0 for s in self.names}


def write_splits(df: DataFrame, path: str, split: str = "split") -> dict[str, int]:
    """One folder for each split (K02, K03); the rows in each and in total."""
    counted = counts_of(split)
    counted.on(df).write.mode("overwrite").partitionBy(split).option("ignoreNullFields", False).json(path)
    return counted.get() | {"total": sum(counted.get().values())}


def manifest_text(manifests: DataFrame) -> DataFrame:
    """Each entry as JSON text with an indent of two, as it stands in the array."""
    text = lambda x: F.concat(F.lit("["), F.when(F.size(x) > 0, F.concat(F.lit("\n"), F.array_join(F.transform(x, lambda v: F.concat(F.lit("      "), json_text(v))), ",\n"), F.lit("\n    "))).otherwise(""), F.lit("]"))
    entry = F.concat(
        F.lit('  {\n    "listing_id": '), json_text(F.col("listing_id")), F.lit(',\n    "local_paths": '), text(F.col("local_paths")),
        F.lit(',\n    "hashes": '), text(F.col("hashes")), F.lit("\n  }"),
    )
    return manifests.select("listing_id", entry.alias("entry"))


def put(path: str | Path, text: str, *, more: bool = False) -> None:
    """A driver's small text in a local file whose folders are made: reports (K07), and with ``more`` lines that are added."""
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    with open(path, "a" if more else "w", encoding="utf-8") as f:
        f.write(text)


def write_json(value: object, path: str | Path, *, newline: bool = True) -> None:
    """A small value with an indent of two."""
    put(path, json.dumps(value, indent=2, ensure_ascii=False) + ("\n" if newline else ""))


def log_line(path: str | Path, **values: object) -> None:
    """One line of key=value pairs at the end of a log."""
    put(path, " ".join(f"{k}={v}" for k, v in values.items()) + "\n", more=True)


def tail(lines: DataFrame, n: int, seq: str = "seq") -> DataFrame:
    """The last ``n`` lines of a log (L07), by their numbers."""
    return lines.orderBy(F.desc(seq)).limit(n).orderBy(seq)


def write_manifest(manifests: DataFrame, path: str, *, lines: bool = False) -> None:
    """The manifest as one JSON array with an indent of two (K04), its entries streamed to the file in order of the listing;
    or as JSON lines, which scale. ``files.read_manifest`` reads the array, Spark both."""
    if lines:
        manifests.write.mode("overwrite").option("ignoreNullFields", False).json(path)
        return
    put(path, "[")
    began = False
    for r in manifest_text(manifests).orderBy(F.length("listing_id"), "listing_id").toLocalIterator():
        put(path, (",\n" if began else "\n") + r.entry, more=True)
        began = True
    put(path, "\n]" if began else "]", more=True)


def result_lines(result: dict) -> list[str]:
    """An evaluation result as lines for the console."""
    rows = [("exact match", result["exact_match"]), *result["per_attribute"].items(), *(result.get("category_breakdown") or {}).items()]
    width = max(len(n) for n, _ in rows)
    return [f"{n:<{width}}  {v:6.1%}" for n, v in rows] + [f"{'samples':<{width}}  {result['total_samples']:6d}"]
