"""What the corpus operators share: the shared folder, written intermediates, skew-safe sums and small helpers."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from loomtable.sources.shared import bucketed, dropped, shared_dir, sweep, written

__all__ = ["bucketed", "dropped", "shared_dir", "sweep", "written"]

#: Code points that separate words in most contracts: space and tab to carriage return.
SPACES = " \t\n\x0b\x0c\r"
WORD_GAP = r"[\x20\x09-\x0D]+"


#: Stands for a null id in ``numbered``: after all others, beside 2^63 - 1 itself.
LATE = (1 << 63) - 1


def numbered(docs: DataFrame, doc_id: str = "doc_id") -> tuple[DataFrame, Column]:
    """``docs`` and a long in the order of its ids, null last.

    Whole-number ids are that long themselves. Ids of any other kind are ranked: distinct ids are range-sorted, numbered
    in that order, written, and joined back.
    """
    if isinstance(docs.schema[doc_id].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return docs, F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(LATE))
    ids = docs.select(F.col(f"`{doc_id}`").alias("__id")).where("__id is not null").distinct()
    ids = written(ids.repartitionByRange("__id").sortWithinPartitions("__id").withColumn("__rank", F.monotonically_increasing_id()))
    return docs.join(ids, F.col(f"`{doc_id}`") == F.col("__id"), "left").drop("__id"), F.coalesce("__rank", F.lit(LATE))


def text_key(value: Column) -> Column:
    """A value as a text that is never null and keeps the order of texts by their UTF-8 bytes, null first."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit("-"))


def placed(rows: DataFrame, group: str, order: Sequence[Column]) -> DataFrame:
    """``rows`` with i, their place from 0 in their group by ``order``, and size, the rows of the group. Written.

    Rows are range-sorted by group and order, so a large group is spread over many tasks, and written as they are numbered: what is
    counted afterwards is what was written. ``group`` is never null. A row for each group and partition gives the places before it.
    """
    by = [F.asc(group), *order]
    laid = rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("__p", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id())
    laid = written(laid)
    counts = laid.groupBy(group, "__p").agg(F.count("*").alias("__n"), F.min("__at").alias("__first"))
    each = W.partitionBy(group)
    before = F.sum("__n").over(each.orderBy("__p")) - F.col("__n")
    shifts = written(counts.select(group, "__p", (before - F.col("__first")).alias("__shift"), F.sum("__n").over(each).alias("size")))
    return written(laid.join(shifts, [group, "__p"]).withColumn("i", F.col("__at") + F.col("__shift")).drop("__p", "__at", "__shift"))


#: A key of more than one row in so many is hot: there can be no more hot keys than this.
HOT_SHARE = 4096


def beside(rows: DataFrame, one: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` joined with ``one``, a written table with one row for each key and n, how many rows have the key.

    A third of all rows may share a key. Keys with more than 1/``HOT_SHARE`` of all that n counts are ``HOT_SHARE`` at most, so
    they are broadcast and their rows stay where they are; the others are shuffled, and none of them is large.
    """
    total = one.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    is_hot = F.col("n") * HOT_SHARE > total
    hot, cold = F.broadcast(one.where(is_hot).drop("n")), one.where(~is_hot).drop("n").hint("merge")
    return rows.join(hot, keys).unionByName(rows.join(hot.select(*keys), keys, "left_anti").join(cold, keys))


BITS = 26


def bitmap(wanted: DataFrame, key: str) -> Broadcast:
    """A bit for each value of the long ``key``, by its low bits: 2^``BITS`` bits, whatever the number of rows."""
    word = F.pmod(key, F.lit(1 << (BITS - 6))).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftright(key, BITS - 6), F.lit(64)).cast("int"))
    rows = wanted.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()  # 2^(BITS - 6) rows at most
    full = np.zeros(1 << (BITS - 6), np.int64)
    full[rows.column("word").to_numpy()] = rows.column("bits").to_numpy()
    return wanted.sparkSession.sparkContext.broadcast(full)


def flagged(bits: Broadcast, key: np.ndarray) -> np.ndarray:
    """Whether a bitmap may hold each key: always for one that it was made of, seldom for others."""
    return bits.value[key & ((1 << (BITS - 6)) - 1)] >> (key >> (BITS - 6) & 63) & 1 == 1


def among(rows: DataFrame, bits: Broadcast, key: str) -> DataFrame:
    """The rows whose ``key`` the bitmap may hold: keeps most others out of the shuffle of an exact join."""
    at = rows.columns.index(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(flagged(bits, b.column(at).to_numpy())))

    return rows.mapInArrow(run, rows.schema)


def frequent(keys: DataFrame, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys (column key, long) that are found ``least`` times or more, in order as unsigned, and the power of two of their counts.

    The most frequent powers whose keys number ``most`` or fewer together: what reaches the driver has that bound.
    """
    found = written(keys.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") >= least).select("key", F.floor(F.log2("n")).cast("int").alias("rank")))
    edge, total = 99, 0
    for r in sorted(found.groupBy("rank").count().collect(), reverse=True):  # a row for each power of two
        total += r["count"]
        if total > most:
            break
        edge = r["rank"]
    listed = found.where(F.col("rank") >= edge).toArrow()
    at = listed.column("key").to_numpy().view(np.uint64)
    order = np.argsort(at)
    return at[order], listed.column("rank").to_numpy()[order]


class WordHashes(dict):
    """Hash of a word in 63 bits, kept for a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word) >> 1
        return found


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where ``body`` uses it in a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as an array; null has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_GAP), lambda w: w != "")


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone, so that no extra column can clash with one that an operator adds."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(n))


#: For SQL: the table t of crc32, from its polynomial, and the crc32 of a text of ASCII characters by it.
CRC_TABLE = """crc_table AS (
  SELECT list(list_reduce(list_prepend(b, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY b) AS t FROM range(256) r(b)
)"""


def crc_sql(text: str) -> str:
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295, {codes}), lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])))"


def sha(texts: list[bytes], by: bytes) -> str:
    return hashlib.sha256(by.join(texts)).hexdigest()


def parts(total_bytes: int, each: int, least: int = 1) -> int:
    """Number of buckets so that each holds about ``each`` bytes."""
    return max(least, -(-int(total_bytes or 0) // each))


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """Bytes of all texts, one aggregate over the column."""
    return docs.agg(F.sum(F.octet_length(F.col(text)).cast("long"))).first()[0] or 0
