import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomtable.operators import images
from loomtable.sources import committed


def files_under(root):
    return sorted(os.path.relpath(os.path.join(d, f), root) for d, _, fs in os.walk(root) for f in fs if not f.endswith(".crc"))


def made(spark, root, n=40):
    rows = spark.range(n, numPartitions=4).select(F.col("id").alias("seq"), F.lit(0).alias("img_idx"), F.when(F.col("id") % 5 != 0, F.concat(F.lit("é"), F.col("id").cast("string")).cast("binary")).alias("jpeg"))
    return rows.withColumn("path", images.stored_path(root, F.col("seq"), F.col("img_idx")))


@pytest.mark.parametrize("scheme", ["", "file://"])
def test_all_files_arrive_whole(spark, tmp_path, scheme):
    root = f"{scheme}{tmp_path}/img"
    got = images.stored(made(spark, root), root)
    wanted = [i for i in range(40) if i % 5]
    assert sorted(r.seq for r in got.collect()) == wanted and got.columns == ["seq", "img_idx", "path"]
    assert files_under(tmp_path / "img") == sorted(f"{i}/0.jpg" for i in wanted)
    assert all((tmp_path / f"img/{i}/0.jpg").read_text() == f"é{i}" for i in wanted)
    again = images.stored(made(spark, root), root)  # over files that are there
    assert again.count() == len(wanted) and files_under(tmp_path / "img") == sorted(f"{i}/0.jpg" for i in wanted)


def test_a_failed_task_leaves_no_file(spark, tmp_path):
    root = str(tmp_path / "img")

    def broken(batches):
        for b in batches:
            for i in range(b.num_rows):
                if b.column(0)[i].as_py() == 33:
                    raise ValueError("lost in the middle")
                yield b.slice(i, 1)

    rows = made(spark, root)
    with pytest.raises(Exception, match="lost in the middle"):
        images.stored(rows.mapInArrow(broken, rows.schema), root)
    assert files_under(root) == [] and committed.settle(spark, root) == 0


def test_no_rows_and_no_bytes(spark, tmp_path):
    root = str(tmp_path / "img")
    for rows in (made(spark, root).limit(0), made(spark, root).where("seq % 5 = 0")):
        assert images.stored(rows, root).count() == 0
    assert files_under(root) == []


def test_lost_drivers_are_settled(spark, tmp_path):
    """A job that stops after its commit goes on to its places, one that stops before goes."""
    root = str(tmp_path)
    for job, commits in (("a", True), ("b", False)):
        (tmp_path / f"{committed.PREFIX}{job}").mkdir()
        writer = committed.StagedWriter({"path": f"{root}/{committed.PREFIX}{job}", "body": "body"})
        batch = pa.RecordBatch.from_pydict({"path": [f"{root}/{job}/{i}" for i in range(3)], "body": [f"{job}{i}".encode() for i in range(3)]})
        done = writer.write(iter([batch]))
        writer.write(iter([batch]))  # an attempt that does not count
        if commits:
            writer.commit([done, None])
    assert committed.settle(spark, root) == 2 and files_under(root) == ["a/0", "a/1", "a/2"]
    assert (tmp_path / "a/2").read_text() == "a2"
