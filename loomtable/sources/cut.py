"""Records of large text files, cut where they end and not where their lines do: CSV with line ends in quotes, JSON arrays.

A file's splits are read by many tasks, but only what comes before a split says whether it begins inside quotes or how deep in an
array. So a split is first run from both states that it can begin in, which gives it a small transition; the transitions of a file's splits
are composed in order, a row a split; and then each split, knowing the state it begins in, is cut. A record that spans splits is put together
from its fragments. An array on a single line is split like any other: pieces end at closing braces, not at line ends.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from loomtable.sources.shared import written

#: So many splits' states are broadcast; beyond, pieces are shuffled to them.
FEW_SPLITS = 1_000_000


#: Rows that a task turns into Python's objects at a time, and characters that it gathers before it hands them on.
SLICE, GATHERED = 250, 1 << 20


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of batches: a batch of many long records is never whole in Python's objects."""
    for b in batches:
        for at in range(0, b.num_rows, SLICE):
            yield b.slice(at, SLICE)


class Csv:
    """Lines; quoted is the state, and a record ends with a line that ends outside quotes. Quotes inside an unquoted cell are text."""

    sep, base = "\n", 0

    @staticmethod
    def step(line: str, quoted: int) -> tuple[int, int]:
        if '"' not in line:
            return quoted, 0
        at = 0
        while True:
            if quoted:
                at = line.find('"', at)
                while at >= 0 and line.startswith('"', at + 1):
                    at = line.find('"', at + 2)
                if at < 0:
                    return 1, 0
            elif line.startswith('"', at):
                quoted, at = 1, at + 1
                continue
            quoted, at = 0, line.find(",", at) + 1
            if not at:
                return 0, 0


_REST = re.compile(r'[^"\\]*(?:\\.[^"\\]*)*"', re.S)
_STRING = re.compile(r'"[^"\\]*(?:\\.[^"\\]*)*"', re.S)


class Json:
    """Pieces up to a closing brace; being inside a string is the state, and a record ends at the depth of the array's elements."""

    sep, base = "}", 1

    @staticmethod
    def step(piece: str, quoted: int) -> tuple[int, int]:
        if quoted:
            end = _REST.match(piece)
            if not end:
                return 1, 0
            piece = piece[end.end():]
        plain, edge = _STRING.sub("", piece), -1
        if '"' in plain:
            edge = plain.index('"')
            plain = plain[:edge]
        depth = plain.count("{") + plain.count("[") - plain.count("]") - plain.count("}")
        return (0, depth - 1) if edge < 0 else (1, depth)


def _pieces(spark: SparkSession, path: str, kind) -> DataFrame:
    lines = spark.read.option("lineSep", kind.sep).text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def _runs(batches: Iterator[pa.RecordBatch], *more: str) -> Iterator[tuple]:
    """file, start, value and more columns of a task's pieces, in order."""
    for b in _slices(batches):
        yield from zip(*[b.column(c).to_pylist() for c in ("file", "start", "value", *more)], strict=True)


_SUMMARY = "file string, start long, end0 int, depth0 long, low0 long, end1 int, depth1 long, low1 long"


def _transitions(pieces: DataFrame, kind) -> DataFrame:
    """What each split does to either state: the state at its end, the change of depth, and the least depth at which a piece ends outside quotes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(key, now) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([dict(zip([x.split()[0] for x in _SUMMARY.split(", ")], [*key, *now[0], *now[1]], strict=True))], schema=arrow)

        arrow = pa.schema([(x.split()[0], {"string": pa.string(), "long": pa.int64(), "int": pa.int32()}[x.split()[1]]) for x in _SUMMARY.split(", ")])
        key, now = None, []
        for file, start, value in _runs(batches):
            if (file, start) != key:
                if key:
                    yield told(key, now)
                key, now = (file, start), [(0, 0, None), (1, 0, None)]
            after = []
            for state, depth, low in now:
                state, change = kind.step(value, state)
                depth += change
                after.append((state, depth, low if state else depth if low is None else min(low, depth)))
            now = after
        if key:
            yield told(key, now)

    return pieces.mapInArrow(run, _SUMMARY)


def _begun(transitions: DataFrame, kind) -> DataFrame:
    """The state and depth that each split begins in, and the split in which the record that is open there began. A row a split, a task a file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state, depth, origin = None, 0, 0, 0
        for b in batches:
            rows = []
            for r in b.to_pylist():
                if r["file"] != last:
                    last, state, depth, origin = r["file"], 0, 0, r["start"]
                rows.append((r["file"], r["start"], state, depth, origin))
                low = r[f"low{state}"]
                if origin is None or (low is not None and depth + low <= kind.base):
                    origin = r["start"]  # what is open at the end began here
                state, depth = r[f"end{state}"], depth + r[f"depth{state}"]
                if not state and depth <= kind.base:
                    origin = None  # nothing is open
            names = ["file", "start", "state", "depth", "origin"]
            if not rows:
                continue
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64()), strict=True)], names=names)

    in_order = transitions.repartition("file").sortWithinPartitions("file", "start")
    return written(in_order.mapInArrow(run, "file string, start long, state int, depth long, origin long"))


def records(spark: SparkSession, path: str, kind) -> DataFrame:
    """seq, file, text: the records of the files under ``path``, numbered in order of file and place. Written; no task holds more than a split and a record."""
    begun = _begun(_transitions(_pieces(spark, path, kind), kind), kind)
    pieces = _pieces(spark, path, kind)
    if begun.count() <= FEW_SPLITS:
        known = pieces.join(F.broadcast(begun), ["file", "start"], "left")
    else:
        pieces = pieces.withColumn("__at", F.monotonically_increasing_id())
        known = pieces.join(begun.hint("merge"), ["file", "start"], "left").sortWithinPartitions("file", "start", "__at").drop("__at")
    lost = F.raise_error(F.concat(F.lit("a split has changed while it was read: "), F.col("file"))).cast("int")
    known = known.withColumn("state", F.when(F.col("state").isNull(), lost).otherwise(F.col("state")))
    arrow = pa.schema([("file", pa.string()), ("start", pa.int64()), ("n", pa.int64()), ("part", pa.int64()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []

        def full() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), arrow, strict=True)], schema=arrow)
            done.clear()
            return made

        key, gathered = None, 0
        for file, start, value, state0, depth0, origin in _runs(batches, "state", "depth", "origin"):
            if (file, start) != key:
                if key and held:
                    done.append((*owner, n if owner == key else -1, key[1], kind.sep.join(held)))
                key, state, depth, held, n = (file, start), state0, depth0, [], 0
                owner = key if origin is None else (file, origin)  # of the record that is open
            state, change = kind.step(value, state)
            depth += change
            held.append(value)
            if not state and depth <= kind.base:
                text = kind.sep.join(held)
                if owner == key:
                    done.append((file, start, n, None, text))
                    n += 1
                else:
                    done.append((*owner, -1, start, text))
                held, owner, gathered = [], key, gathered + len(text)
            if len(done) >= 5000 or gathered >= GATHERED:
                if done:
                    yield full()
                gathered = 0
        if key and held:
            done.append((*owner, n if owner == key else -1, key[1], kind.sep.join(held)))
        if done:
            yield full()

    cut = written(known.select("file", "start", "value", "state", "depth", "origin").mapInArrow(run, "file string, start long, n long, part long, text string"))
    inside = F.transform(F.array_sort(F.collect_list(F.struct("part", "text"))), lambda x: x["text"])  # a record's fragments
    spanning = cut.where("part is not null").groupBy("file", "start").agg(F.max("n").alias("n"), F.array_join(inside, kind.sep).alias("text"))
    whole = cut.where("part is null").select("file", "start", "n", "text").unionByName(spanning)
    counts = whole.groupBy("file", "start").agg(F.count("*").alias("__c"))
    first = written(counts.select("file", "start", (F.sum("__c").over(W.orderBy("file", "start")) - F.col("__c")).alias("__before")))  # a row a split
    return whole.join(first, ["file", "start"]).select((F.col("__before") + F.col("n")).alias("seq"), "file", "text")


def csv_cells(spark: SparkSession, path: str) -> DataFrame:
    """seq, file, cells (array of text) of every row of CSV files, headers among them; empty rows are left out, as Python's reader leaves them out of tables."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit((1 << 31) - 1)
        for b in _slices(batches):
            cells = [next(csv.reader(io.StringIO(t, newline="")), []) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("seq"), b.column("file"), pa.array(cells, pa.list_(pa.string()))], names=["seq", "file", "cells"])

    return records(spark, path, Csv).mapInArrow(run, "seq long, file string, cells array<string>").where(F.size("cells") > 0)


_OPEN, _NEXT, _END = r"^\s*\[\s*\{", r"^\s*,\s*\{", r"^\s*(\[\s*)?\]\s*$"


class Malformed(ValueError):
    """A file that is no JSON array of objects."""


def json_elements(spark: SparkSession, path: str) -> DataFrame:
    """seq, file, text of every object of the JSON arrays in files. ``Malformed`` if one of them is something else."""
    found = written(records(spark, path, Json).withColumn("kind", F.when(F.col("text").rlike(_END), "end").when(F.col("text").rlike(_NEXT), "next").when(F.col("text").rlike(_OPEN), "open").otherwise("odd")))
    by = found.groupBy("file").agg(
        F.count_if(F.col("kind") == "odd").alias("odd"), F.count_if((F.col("kind") == "open") | F.col("text").rlike(r"^\s*\[\s*\]")).alias("opened"), F.count_if(F.col("kind") == "end").alias("ended"),
        F.max_by("kind", "seq").alias("last"), F.min_by("text", "seq").alias("first"),
    )
    bad = by.where((F.col("odd") > 0) | (F.col("opened") != 1) | (F.col("ended") != 1) | (F.col("last") != "end") | ~F.col("first").rlike(r"^\s*\["))
    worst = bad.select("file").first()
    if worst:
        raise Malformed(f"no JSON array of objects: {worst.file}")
    return found.where("kind <> 'end'").select("seq", "file", F.concat(F.regexp_replace("text", r"^\s*[\[,]\s*", ""), F.lit("}")).alias("text"))
