"""Files of bytes with a commit in two phases: a job that fails leaves none of its files, one that ends leaves all of them whole.

Tasks write into folders of their own under ``<root>/.staged-<job>``, each with a table of its rows. The driver's commit writes the names of the
attempts that count, which is the point of no return; an abort deletes the job's folder. Then tasks move the files to their places, which may be
done again: a file that has gone is one that has arrived. Paths are those of any file system that both Arrow and Spark know (``file:``, ``hdfs:``,
``s3:`` and others, or a plain path that all machines share).
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from loomtable.sources.shared import _file_system, written

PREFIX, MARK, ROWS = ".staged-", "committed.json", "rows.parquet"


@dataclass
class Attempt(WriterCommitMessage):
    name: str


class StagedWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]) -> None:
        self.folder, self.body = options["path"], options["body"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Attempt:
        fs, folder = pyarrow.fs.FileSystem.from_uri(self.folder)
        name = uuid.uuid4().hex
        mine, rows, n = f"{folder}/{name}", None, 0
        fs.create_dir(mine, recursive=False)  # none in a folder that an abort has taken away
        try:
            for b in iterator:
                at = []
                for x in b.column(b.schema.get_field_index(self.body)):
                    at.append(f"{n:09d}")
                    n += 1
                    with fs.open_output_stream(f"{mine}/{at[-1]}") as f:
                        f.write(x.as_buffer())
                left = b.drop_columns([self.body]).append_column("__at", pa.array(at, pa.string()))
                rows = rows or pa.parquet.ParquetWriter(f"{mine}/{ROWS}", left.schema, filesystem=fs)
                rows.write_batch(left)
        except BaseException:
            if fs.get_file_info(mine).type != pyarrow.fs.FileType.NotFound:
                fs.delete_dir(mine)
            raise
        if rows:
            rows.close()
        return Attempt(name if rows else "")

    def commit(self, messages: list[Attempt | None]) -> None:
        fs, folder = pyarrow.fs.FileSystem.from_uri(self.folder)
        with fs.open_output_stream(f"{folder}/{MARK}.part") as f:
            f.write(json.dumps([m.name for m in messages if m and m.name]).encode())
        fs.move(f"{folder}/{MARK}.part", f"{folder}/{MARK}")

    def abort(self, messages: list[Attempt | None]) -> None:
        fs, folder = pyarrow.fs.FileSystem.from_uri(self.folder)
        if fs.get_file_info(folder).type != pyarrow.fs.FileType.NotFound:
            fs.delete_dir(folder)


class StagedFiles(DataSource):
    """Options ``path``: the job's folder; ``body``: the column of bytes."""

    @classmethod
    def name(cls) -> str:
        return "loom_files"

    def writer(self, schema, overwrite: bool) -> StagedWriter:
        return StagedWriter(self.options)


def _uri(spark: SparkSession, path: str) -> str:
    """A folder with its scheme, the cluster's own where it names none, as both Spark and Arrow read it."""
    fs, p = _file_system(spark, path.rstrip("/"))
    return re.sub("^file:/+", "file:///", fs.makeQualified(p).toString())


def _place(path: str) -> str:
    """Where a path lies in its file system."""
    return pyarrow.fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))[1] if re.match(r"\w+:/", path) else path


def _arrived(spark: SparkSession, folder: str, attempts: list[str]) -> DataFrame | None:
    """The rows of a committed job, written once their files are in place; the job's folder goes then."""
    done = None
    if attempts:
        rows = spark.read.parquet(*[f"{folder}/{a}/{ROWS}" for a in attempts]).selectExpr("*", "_metadata.file_path AS __from")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            fs, root = pyarrow.fs.FileSystem.from_uri(folder)
            gone = lambda p: fs.get_file_info(p).type == pyarrow.fs.FileType.NotFound
            for b in batches:
                for at, held, path in zip(*[b.column(b.schema.get_field_index(c)).to_pylist() for c in ("__at", "__from", "path")], strict=True):
                    source, place = f"{root}/{held.rsplit('/', 2)[1]}/{at}", _place(path)
                    fs.create_dir(place.rsplit("/", 1)[0])
                    try:
                        fs.move(source, place)
                    except OSError:
                        if not gone(source):  # some file systems do not move over a file that is there
                            fs.delete_file(place)
                            fs.move(source, place)
                        elif gone(place):
                            raise
                yield b.drop_columns(["__at", "__from"])

        done = written(rows.mapInArrow(run, rows.drop("__at", "__from").schema))
    fs, p = _file_system(spark, folder)
    fs.delete(p, True)
    return done


def write_files(rows: DataFrame, root: str, body: str = "body") -> DataFrame:
    """Writes each row's ``body`` to the file that its ``path`` names, under ``root``, and gives back the other columns of those written.

    Rows without a body have no file and do not come back. Rows that name one path leave one file, whole, of either. If a task fails for good
    no file is left, and none was at its place before all were written. Of a driver that is lost, ``settle`` clears up.
    """
    spark = rows.sparkSession
    spark.dataSource.register(StagedFiles)
    folder = f"{_uri(spark, root)}/{PREFIX}{uuid.uuid4().hex}"
    rows = rows.where(rows[body].isNotNull())
    fs, p = _file_system(spark, folder)
    fs.mkdirs(p)
    try:
        rows.write.format("loom_files").mode("append").option("path", folder).option("body", body).save()
    except Exception:
        fs.delete(p, True)  # once more: tasks that were still at work when the job was aborted may have left files
        raise
    found = _arrived(spark, folder, _attempts(spark, folder))
    return spark.createDataFrame([], rows.drop(body).schema) if found is None else found


def _attempts(spark: SparkSession, folder: str) -> list[str]:
    """What a job's commit lists: a name for each of its tasks."""
    return json.loads(spark.read.text(f"{folder}/{MARK}", wholetext=True).first()[0])


def settle(spark: SparkSession, root: str) -> int:
    """Ends what jobs whose driver was lost have left under ``root``, and tells how many there were: committed ones go on to their places, others go.
    Only for when no job writes there."""
    fs, p = _file_system(spark, root)
    left = [s.getPath() for s in fs.listStatus(p) if s.getPath().getName().startswith(PREFIX)] if fs.exists(p) else []
    for found in left:
        folder = f"{_uri(spark, root)}/{found.getName()}"
        inner, mark = _file_system(spark, f"{folder}/{MARK}")
        if inner.exists(mark):
            _arrived(spark, folder, _attempts(spark, folder))
        else:
            fs.delete(found, True)
    return len(left)
