"""Intermediate tables in the folder that a cluster's machines share: they cut lineage and outlive lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, from ``spark.checkpoint.dir``.

    Where that setting is absent a temporary folder is made, but only if all runs on this machine; a cluster without it
    is an error, since its machines share no local folder.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        sc = spark.sparkContext
        if sc.getCheckpointDir() is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="loomtable-"))
        found = sc.getCheckpointDir()
    return found.rstrip("/")


#: Folders that each application has written and not swept.
_FOLDERS: dict[str, list[str]] = {}


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def written(df: DataFrame, compression: str = "zstd") -> DataFrame:
    """``df`` written to the shared folder as Parquet and read again: cuts lineage and survives lost executors.

    The folder goes with ``sweep``, or else when the application ends: a lazy result may read it until then.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stage-{uuid.uuid4().hex}"
    fs, p = _file_system(spark, path)
    fs.deleteOnExit(p)
    df.write.option("compression", compression).parquet(path)
    _FOLDERS.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(spark: SparkSession) -> str:
    """A path in the shared folder for files that others read; what is written there goes as the files of ``written`` do."""
    path = f"{shared_dir(spark)}/stage-{uuid.uuid4().hex}"
    fs, p = _file_system(spark, path)
    fs.deleteOnExit(p)
    _FOLDERS.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def bucketed(df: DataFrame, key: str, buckets: int, compression: str = "zstd") -> DataFrame:
    """As ``written``, in files dealt by the hash of ``key``: a group, join or cogroup by it reads them in place, without a shuffle.

    The catalog's entry that the write needs goes again at once; the files stay as those of ``written`` do.
    """
    spark = df.sparkSession
    name = f"stage_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/{name}"
    fs, p = _file_system(spark, path)
    fs.deleteOnExit(p)
    df.write.option("compression", compression).option("path", path).bucketBy(buckets, key).format("parquet").saveAsTable(name)
    _FOLDERS.setdefault(spark.sparkContext.applicationId, []).append(path)
    made = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return made


def dropped(*tables: DataFrame) -> None:
    """Deletes the files of tables that ``written`` has made, once all that reads them is written itself."""
    for df in tables:
        spark = df.sparkSession
        mine = _FOLDERS.get(spark.sparkContext.applicationId, [])
        held = {f.rsplit("/", 1)[0].rsplit("/", 1)[1] for f in df.inputFiles()}
        for path in [p for p in mine if p.rsplit("/", 1)[1] in held]:
            fs, p = _file_system(spark, path)
            fs.delete(p, True)
            mine.remove(path)


def sweep(spark: SparkSession, keep: DataFrame | None = None) -> None:
    """Deletes what ``written`` has left in this application, but for ``keep``'s files. Only for when no lazy result still reads them."""
    held = {f.rsplit("/", 1)[0] for f in keep.inputFiles()} if keep is not None else set()
    mine = _FOLDERS.get(spark.sparkContext.applicationId, [])
    for path in [p for p in mine if not any(h.endswith(p.rsplit("/", 1)[1]) for h in held)]:
        fs, p = _file_system(spark, path)
        fs.delete(p, True)
        mine.remove(path)
