"""Readers of listing, chat, manifest and result files. Schemas are always given, never inferred."""

from __future__ import annotations

import json
import re
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from loomtable.plans.schema import EVAL_RESULT, LISTING, MANIFEST, PREDICTION
from loomtable.sources.cut import Json, Malformed, csv_cells, json_elements
from loomtable.sources.shared import written

_SUFFIX = re.compile(r"(\d+)$")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """seq, value: the lines of text files, numbered in order of the files' names and of the lines in them.

    A split's lines stand together and in order in a task, so a line's number is its place among them and the lines of
    all splits before it. Only a row for each split is shuffled; lines stay where they are.
    """
    place = [F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__start")]
    lines = spark.read.text(path).select("value", *place, F.monotonically_increasing_id().alias("__at"))
    splits = lines.groupBy("__file", "__start").agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    before = F.sum("__n").over(W.orderBy("__file", "__start")) - F.col("__n")  # a row for each split, in one task
    starts = splits.select("__file", "__start", (before - F.col("__first")).alias("__shift"))
    return lines.join(starts, ["__file", "__start"]).select((F.col("__at") + F.col("__shift")).alias("seq"), "value")


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType, *, blank_fails: bool = False) -> DataFrame:
    """One object a line (S01): blank lines are skipped, or fail where ``blank_fails`` (S11); malformed lines fail."""
    lines = spark.read.text(path)
    if not blank_fails:
        lines = lines.where(F.trim("value") != "")
    text = lines.select(F.when(F.trim("value") == "", "!").otherwise(F.col("value")).alias("value"))
    return text.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def read_listings(spark: SparkSession, path: str) -> DataFrame:
    """Listings with ``seq``, their place in the file."""
    body = T.StructType([f for f in LISTING.fields if f.name != "seq"])
    lines = numbered_lines(spark, path).where(F.trim("value") != "")
    parsed = lines.select("seq", F.from_json("value", body, {"mode": "FAILFAST"}).alias("r")).select("seq", "r.*")
    return parsed.withColumn("attributes", F.map_from_entries(F.map_entries("attributes")))  # keeps the last of repeated keys


def read_csv(spark: SparkSession, path: str, header: list[str] | None = None, *, overflow: str | None = None, seq: str | None = None) -> DataFrame:
    """A table with a header in each file (S02): all values text, line ends in quotes allowed, files split all the same (``cut``).

    Cells that a short row lacks are null. Cells beyond the header go to ``overflow``, an array, if it is named; of columns
    with one name the last counts; empty rows are left out. ``seq`` numbers the rows in order of the files.
    """
    rows = written(csv_cells(spark, path))
    heads = rows.groupBy("file").agg(F.min("seq").alias("__head"), F.min_by("cells", "seq").alias("__names"))  # a row a file
    first = heads.orderBy("file").first()
    names = header or (first["__names"] if first else [])
    at = {name: i for i, name in enumerate(names)}
    over = F.when(F.size("cells") > len(names), F.slice("cells", len(names) + 1, 1 << 30))
    other = F.raise_error(F.concat(F.lit("another header than the first file's: "), F.col("file"))).cast("boolean")
    same = F.lit(True) if header else F.when(F.col("__names") != F.array(*map(F.lit, names)).cast("array<string>"), other).otherwise(True)
    body = rows.join(heads, "file").where(F.col("seq") > F.col("__head")).where(same)
    return body.select(*([F.col("seq").alias(seq)] if seq else []), *[F.get("cells", F.lit(i)).alias(name) for name, i in at.items()], *([over.alias(overflow)] if overflow else []))


def read_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The objects of JSON arrays (S03, S07), each parsed once; a file's splits are read by many tasks, on one line or many.

    ``cut.Malformed`` if a file is no array of objects, an error when it is read if an object can't be parsed."""
    return json_elements(spark, path).select(F.from_json("text", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A JSON array, or else one object a line (S03). What begins like an array but is none is read as lines."""
    head = spark.read.option("lineSep", Json.sep).text(path).select(F.regexp_replace("value", r"^\s+", "").alias("v")).where("v <> ''").first()
    if head and head.v.startswith("["):
        try:
            return read_array(spark, path, schema)
        except Malformed:
            pass
    return read_jsonl(spark, path, schema)


def read_results(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Evaluation results with the file that each comes from."""
    found = spark.read.schema(EVAL_RESULT).option("multiLine", True).option("mode", "FAILFAST").json(paths)
    return found.withColumn("path", F.col("_metadata.file_path"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """An image manifest: a JSON array of listings' files and hashes."""
    return read_array(spark, path, MANIFEST)


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    return read_jsonl(spark, path, PREDICTION)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, by the file system that serves it."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


CONTENT = T.StructType([
    T.StructField("messages", T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())]))),
    T.StructField("title", T.StringType()),
    T.StructField("image_urls", T.ArrayType(T.StringType())),
    T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
])


def read_test_rows(spark: SparkSession, path: str, *, blank_fails: bool = False) -> DataFrame:
    """Chat or raw rows (S10, S11), for ``operators.chat.unify``."""
    return read_jsonl(spark, path, CONTENT, blank_fails=blank_fails)


def read_training(spark: SparkSession, train: str, val: str | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Chat rows for training and, where the file is there, for validation."""
    return read_test_rows(spark, train), read_test_rows(spark, val) if val and exists(spark, val) else None


def newest(paths: list[str]) -> str | None:
    """Of checkpoint folders the one with the largest number at its end."""
    numbered = [(int(m[1]), p) for p in paths if (m := _SUFFIX.search(p.rstrip("/")))]
    return max(numbered)[1] if numbered else None


def newest_in(spark: SparkSession, folder: str, prefix: str = "checkpoint-") -> str | None:
    """The checkpoint folder in ``folder`` with the largest number (S20), by the file system that serves it; None without any."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return None
    return newest([f.getPath().toUri().getPath() for f in fs.listStatus(p) if f.isDirectory() and f.getPath().getName().startswith(prefix)])


def newest_of(names: DataFrame, name: str = "name") -> DataFrame:
    """The name with the largest number at its end (O04), one row."""
    return names.agg(F.max_by(name, F.regexp_extract(name, r"(\d+)/?$", 1).cast("long")).alias(name))


def load_result(path: str | Path) -> dict:
    """One evaluation result on the driver; a missing breakdown is None."""
    raw = json.loads(Path(path).read_text(encoding="utf-8"))
    return {
        "exact_match": float(raw["exact_match"]), "per_attribute": dict(raw["per_attribute"]),
        "category_breakdown": raw.get("category_breakdown"), "total_samples": int(raw["total_samples"]), "timestamp": raw.get("timestamp", ""),
    }
