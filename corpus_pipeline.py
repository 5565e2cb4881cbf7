"""The corpus pipeline: five of the corpus operators in a row, each on all that the one before it kept.

Every stage takes (spark, docs, sf_dir); all but the last return the columns of ``documents``, and columns beyond these
are left out, whatever their names. An empty table gives an empty table. Texts of any length are read whole. Rows that
repeat an id are rows of their own but where a stage says otherwise. ``run`` writes each stage's rows to the shared folder
and reads them again, so a lost executor repeats one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtable.llm import fmindex, mixing, quality, simhash, templates
from loomtable.llm.common import let, sweep, words, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go.

    Null and empty texts have no words and go; nulls in other columns stay as they are. Nothing hangs on order.
    """
    return quality.keep_good(docs).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go, but for each template's first document; documents stay, whatever is left of them.

    A null text stays null. A null id counts as the last; rows that share an id are one document, so they keep each other's
    lines. n_chars is counted anew.
    """
    kept = templates.drop_templates(docs, keep=("lang", "source"))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays.

    Texts are linked if the SimHashes of their three-word shingles differ in two bits or fewer, or if they share 0.8 or
    more of their five-word shingles. Of rows that repeat an id and a text one stays; rows that share an id otherwise stay
    or go together, as do those without an id, which stay if one of them has a group without any id. Null and empty texts
    have one fingerprint, so they are one group.
    """
    first = simhash.near_duplicates(docs, similarity=0.8).where("doc_id <=> component_id").select(F.col("doc_id").alias("first")).distinct()
    kept = docs.join(first, F.col("doc_id").eqNullSafe(F.col("first")), "left_semi")
    return kept.withColumn("__text", F.xxhash64("text")).dropDuplicates(["doc_id", "__text"]).select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark are cut out of the texts; a document goes if no word is left of it after a cut.

    Null and empty texts hold no passage and stay; so does everything if the benchmark has no words. An item without an id
    counts like any other. n_chars is counted anew.
    """
    clean = fmindex.scan(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), keep=("lang", "source"), cut=True)
    return (
        clean.where((F.col("n_hit") == 0) | (F.col("n_hit") < F.col("n_words")))
        .select("doc_id", F.col("clean_text").alias("text"), "lang", "source", F.length("clean_text").cast("long").alias("n_chars"))
    )


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each document and epoch that the mix takes, with ``taken``, its words in that epoch.

    Where a source's budget ends inside a document, the row holds that document's first words, joined by a space. Texts
    without words take nothing and have no row. A null source is a source of its own. Documents of a source go by a hash of
    their id, rows that share it by size and text; those without an id by a hash of the text.
    """
    mixed = mixing.mix(docs, keep=COLUMNS[1:])
    full = F.floor(F.col("taken") / F.col("size")).cast("int")
    rows = mixed.where("taken > 0").withColumn("epoch", F.explode(F.sequence(F.lit(1), F.ceil(F.col("taken") / F.col("size")).cast("int"))))
    part = (F.col("taken") - full * F.col("size")).cast("int")
    cut = F.col("epoch") > full
    text = F.when(cut, let(words(F.col("text")), lambda w: F.array_join(F.slice(w, F.lit(1), F.greatest(part, F.lit(1))), " "))).otherwise(F.col("text"))
    return rows.select(
        "doc_id", text.alias("text"), "lang", "source", F.length(text).cast("long").alias("n_chars"),
        "epoch", F.when(cut, part.cast("long")).otherwise(F.col("size")).alias("taken"),
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs)
            sweep(spark, keep=docs)
    return docs


#: Components of SimHash links, and texts cut at word spans, are beyond plain SQL; tests compare run() with brute force.
ORACLE_SQL = None
