"""Near-duplicate documents by 64-bit SimHash with Pigeonring filtering.

Fingerprints that are equal collapse to one row first, so copies never meet as pairs. For ``tau`` differing bits, the
64 bits form a ring of eight segments of eight bits. By the strong pigeonring principle two fingerprints within tau
have a start segment from which every chain of l consecutive segments differs in at most l * tau / 8 bits. The longest
chain whose budget is zero is an equality key; for two bits these are three segments, and of the next four, which differ
in one bit at most, the first two or the last two are equal as well: 40 bits for each start segment and half. Rows that
share a key are candidates; the longer chains prune them before the full Hamming check.

A key shared by more than ``cap`` different fingerprints would make too many pairs. Its members leave the pair join
and are linked exactly in another way (tau <= 2): each emits all values within one bit of itself; two fingerprints
within two bits meet at such a value, and all that meet at one are within two bits of each other, so one star of links
(at most 64 a value) replaces the pairs.

Texts that share most of their words but differ in several places lie many bits apart. ``similarity`` links them too,
exactly, by prefix filtering: in any one order of all shingles, two texts whose shingles have a share t or more in common
share one among the first n - ceil(t * n) + 1 of each. Shingles that a sample of the texts repeats come last in the
order, so a common passage is a key of such texts only that hold little else. Lengths and places prune the pairs of a
key; the whole shingle sets decide.

A key of more than ``HOT`` texts is taken in two steps: each text meets the smallest one, then, once the links so far
have made groups, each pair of texts from different groups is taken, in salted parts. A family of near copies is one
group by then and makes no pairs; texts that are alike are never left uncompared.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtable.llm.common import WordHashes, among, bitmap, dropped, frequent, written
from loomtable.llm.graph import components

SEGMENTS = 8
#: Texts of a shingle beyond which its pairs are taken in two steps, and the parts of the second.
HOT, PARTS = 32, 16
#: One text in ``SAMPLE`` is looked through for common shingles: those in ``OFTEN`` such texts, ``LISTED`` shingles at most.
SAMPLE, OFTEN, LISTED = 16, 3, 1 << 20


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Unsigned 64-bit fingerprint of a whole text; no words: 0."""
    w = text.encode().lower().split() if text else []
    if not w:
        return 0
    grams = [b" ".join(w)] if len(w) < shingle else map(b" ".join, zip(*[w[i:] for i in range(shingle)], strict=False))
    raw = np.frombuffer(b"".join(map(xxhash.xxh64_digest, grams, repeat(42))), np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(raw), 1 << 15):
        ones += np.unpackbits(raw[at : at + (1 << 15)], axis=1).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > len(raw)).tobytes(), "big")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long), th (a hash of the whole text) of every row; null and empty texts have fp 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.record_batch([b.column(0), pa.array(fps.view(np.int64)), b.column(2)], names=["doc_id", "fp", "th"])

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("th"))
    return rows.mapInArrow(run, f"doc_id {kind}, fp long, th long")


def shingles(text: str | None, hashes: WordHashes, shingle: int = 5) -> np.ndarray:
    """64-bit hashes of a text's different shingles, in order; a shorter text is one shingle, one without words has none."""
    w = text.encode().lower().split() if text else []
    if not w:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, w), np.int64, len(w)).view(np.uint64)
    n = max(1, len(h) - shingle + 1)
    g = np.zeros(n, np.uint64)
    for j in range(min(shingle, len(h))):
        g = g * np.uint64(0x9E3779B97F4A7C15) + h[j : j + n]
    g ^= g >> np.uint64(32)
    g *= np.uint64(0xD6E8FEB86659FD93)
    g ^= g >> np.uint64(32)
    return np.unique(g)


def prefix(g: np.ndarray, common: np.ndarray, rank: np.ndarray, similarity: float) -> np.ndarray:
    """The first shingles of ``g``, common ones last by rank: a text with ``similarity`` or more in common has one of them first as well."""
    n = len(g) - math.ceil(similarity * len(g) - 1e-9) + 1 if len(g) else 0
    if not n or not len(common):
        return g[:n]
    at = np.minimum(np.searchsorted(common, g), len(common) - 1)
    listed = common[at] == g
    return np.concatenate([g[~listed], g[listed][np.argsort(rank[at[listed]], kind="stable")]])[:n]


def _common(texts: DataFrame, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that the sampled texts repeat, in order, and the power of two of their counts. ``texts`` has th, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in batches:
            for t in b.column(0):
                yield pa.record_batch([pa.array(shingles(t.as_py(), hashes, shingle).view(np.int64))], names=["key"])

    some = texts.where(F.pmod("th", F.lit(SAMPLE)) == 0).dropDuplicates(["th"]).select("text").mapInArrow(run, "key long")
    return frequent(some, OFTEN, LISTED)


def _near_sizes(similarity: float):
    """Whether postings a and b with a key in common can be of texts alike, by sizes n and places p of the key."""
    rest = F.least(F.col("a.n") - F.col("a.p"), F.col("b.n") - F.col("b.p"))
    return rest >= F.lit(similarity / (1 + similarity)) * (F.col("a.n") + F.col("b.n")) - 1e-6


def _alike(pairs: DataFrame, made: DataFrame, texts: DataFrame, similarity: float, shingle: int) -> DataFrame:
    """Those of ``pairs`` (a, b, without repeats) whose whole shingle sets have ``similarity`` or more in common.

    What two texts differ by is at least the sum of the differences of their parts' sizes, so pairs beyond the
    difference allowed are known without their texts.
    """

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8).reshape(-1, 64).astype(np.int32) for c in (4, 5))
            most = (b.column(2).to_numpy() + b.column(3).to_numpy()) * (1 - similarity) / (1 + similarity)
            yield pa.record_batch([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(np.abs(x - y).sum(axis=1) <= most + 1e-6))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in batches:
            sets = [shingles(t.as_py(), hashes, shingle).view(np.int64) for t in b.column(1)]
            yield pa.record_batch([b.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["th", "s"])

    size = lambda c: made.select(F.col("th").alias(c), F.col("n").alias(f"n{c}"), F.col("parts").alias(f"p{c}"))
    pairs = written(pairs.join(size("a"), "a").join(size("b"), "b").select("a", "b", "na", "nb", "pa", "pb").mapInArrow(near, "a long, b long"))
    if pairs.isEmpty():
        return pairs
    met = written(pairs.select(F.explode(F.array("a", "b")).alias("th")).distinct())
    sets = written(among(texts.select("th", "text"), bitmap(met, "th"), "th").join(met, "th", "left_semi").dropDuplicates(["th"]).select("th", "text").mapInArrow(run, "th long, s array<long>"))
    side = lambda c: sets.select(F.col("th").alias(c), F.col("s").alias(f"s{c}"))
    both = F.size(F.array_intersect("sa", "sb"))  # on the JVM, one pair at a time: sets can be long, and a batch of them large
    alike = both * (1 + similarity) >= similarity * (F.size("sa") + F.size("sb")) - 1e-9
    found = written(pairs.join(side("a"), "a").join(side("b"), "b").where(alike).select("a", "b"))
    dropped(pairs, met, sets)
    return found


def similar(docs: DataFrame, text: str, similarity: float, shingle: int = 5) -> DataFrame:
    """Edges a, b between texts, by their hashes, that connect exactly those whose share of common shingles is ``similarity`` or more.

    A text stands for all rows that hold it, whatever their ids. ``similarity`` is above 0.
    """
    texts = docs.select(F.xxhash64(F.col(text)).alias("th"), F.col(text).alias("text")).where("text is not null")
    listed = docs.sparkSession.sparkContext.broadcast(_common(texts, shingle))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        common, rank = listed.value
        for b in batches:
            made = [shingles(t, hashes, shingle) for t in b.column(1).to_pylist()]
            first = [prefix(g, common, rank, similarity).view(np.int64) for g in made]
            parts = [np.minimum(np.bincount((g >> np.uint64(58)).astype(np.int64), minlength=64), 255).astype(np.uint8).tobytes() for g in made]
            yield pa.record_batch(
                [b.column(0), pa.array([len(g) for g in made], pa.int32()), pa.array(parts, pa.binary()), pa.array(first, pa.list_(pa.int64()))],
                names=["th", "n", "parts", "keys"],
            )

    made = written(texts.select("th", "text").mapInArrow(run, "th long, n int, parts binary, keys array<long>").dropDuplicates(["th"]))
    keyed = made.select("th", "n", F.posexplode("keys").alias("p", "key")).repartition("key")
    # The least row is taken whole: with the same columns in both uses the shuffle is one.
    shared = keyed.groupBy("key").agg(F.count("*").alias("m"), F.min(F.struct("th", "n", "p")).alias("least"))
    shared = shared.where("m > 1").select("key", "m", F.col("least.th").alias("least"))
    keyed = written(keyed.join(shared, "key"))
    few = keyed.where(F.col("m") <= HOT)
    a, b = few.alias("a"), few.alias("b")
    pairs = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.th") < F.col("b.th")) & _near_sizes(similarity)).select(F.col("a.th").alias("a"), F.col("b.th").alias("b"))
    hot = keyed.where(F.col("m") > HOT)
    stars = hot.where("th <> least").select(F.col("least").alias("a"), F.col("th").alias("b"))
    done = pairs.unionByName(stars).distinct()
    edges = _alike(done, made, texts, similarity, shingle)
    root = written(components(edges))
    grouped = hot.join(root, hot.th == root.node, "left").select("key", "th", "n", "p", F.coalesce("root", "th").alias("root"))
    split = grouped.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x < y").select("key")
    grouped = written(grouped.join(split, "key"))
    dropped(keyed, root)
    a = grouped.withColumn("part", F.pmod(F.xxhash64("th"), F.lit(PARTS)).cast("int")).alias("a")
    b = grouped.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1)))).alias("b")
    apart = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.part") == F.col("b.part")) & (F.col("a.th") < F.col("b.th")) & (F.col("a.root") != F.col("b.root")) & _near_sizes(similarity))
    more = _alike(apart.select(F.col("a.th").alias("a"), F.col("b.th").alias("b")).distinct(), made, texts, similarity, shingle)
    dropped(grouped, made)
    return edges.unionByName(more)


def links(fps: DataFrame, tau: int = 2, cap: int = 64) -> DataFrame:
    """Edges a, b that connect exactly the fingerprints within ``tau`` bits, directly or through a common neighbour.

    ``fps`` has one column fp without repeats. tau is 0 to 2. Edges of hot keys run through values that need not be
    fingerprints themselves; their components, cut to ``fps``, are the wanted ones.
    """
    if not 0 <= tau <= 2:
        raise ValueError("tau must be 0, 1 or 2")
    width = 64 // SEGMENTS
    zero = max(n for n in range(1, SEGMENTS) if n * tau // SEGMENTS == 0)  # longest chain without a difference
    starts = []
    for s in range(SEGMENTS):
        turned = _turn("fp", width * s)
        chain = F.shiftrightunsigned(turned, 64 - width * zero)
        # With a budget of one bit for the next four segments, two neighbours of them are equal too.
        halves = [32 - width, 16 - width] if tau == 2 else [None]
        keys = [chain if h is None else F.shiftleft(chain, 16).bitwiseOR(F.shiftrightunsigned(turned, h).bitwiseAND(F.lit(0xFFFF))) for h in halves]
        starts += [F.struct(F.lit(len(halves) * s + i).alias("s"), k.alias("k"), turned.alias("r")) for i, k in enumerate(keys)]
    keyed = fps.select("fp", F.explode(F.array(*starts)).alias("x")).select("fp", "x.s", "x.k", "x.r")
    sizes = keyed.groupBy("s", "k").agg(F.count("*").alias("n")).where("n > 1")
    small = keyed.join(sizes.where(F.col("n") <= cap), ["s", "k"], "left_semi")
    a, b = small.alias("a"), small.alias("b")
    differ = F.expr("a.r ^ b.r")
    near = (F.col("a.s") == F.col("b.s")) & (F.col("a.k") == F.col("b.k")) & (F.col("a.fp") < F.col("b.fp"))
    for n in range(zero + 1, SEGMENTS):
        if n == SEGMENTS - 1 or n * tau // SEGMENTS < (n + 1) * tau // SEGMENTS:  # the longest chain of each budget
            near &= F.bit_count(F.shiftrightunsigned(differ, 64 - width * n)) <= n * tau // SEGMENTS
    near &= F.bit_count(differ) <= tau
    pairs = a.join(b, near).select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))
    hot = keyed.join(sizes.where(F.col("n") > cap), ["s", "k"], "left_semi").select("fp").distinct()
    if tau == 2:
        around = F.concat(F.array("fp"), F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))))
        ball = hot.select("fp", F.explode(around).alias("z"))
        star = ball.groupBy("z").agg(F.min("fp").alias("a"), F.max("fp").alias("m"), F.collect_list("fp").alias("all"))  # 65 at most
        stars = star.where("a < m").select("a", F.explode("all").alias("b")).where("a <> b")
    elif tau == 1:
        bits = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.struct(i.alias("i"), F.col("fp").bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(1).cast("long"), i))).alias("z")))
        ball = hot.select("fp", F.explode(bits).alias("x"))
        stars = ball.groupBy("x").agg(F.min("fp").alias("a"), F.max("fp").alias("b")).where("a < b").select("a", "b")
    else:
        stars = hot.select(F.col("fp").alias("a"), F.col("fp").alias("b")).where("a <> b")
    return pairs.unionByName(stars).distinct()


def _turn(name: str, by: int):
    """The 64 bits rotated to the left."""
    if not by:
        return F.col(name)
    return F.shiftleft(name, by).bitwiseOR(F.shiftrightunsigned(name, 64 - by))


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, tau: int = 2, cap: int = 64,
    similarity: float | None = None,
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable by links of ``tau`` bits or fewer,
    and, with ``similarity``, by five-word shingles in common; see ``similar``).

    One row for each input row. Null and empty texts have fingerprint 0, linked like any other. Rows that repeat a
    doc_id are each fingerprinted; a null doc_id keeps its row, and its component_id is the smallest other id, or null.
    An empty table gives no rows. Other columns of ``docs`` are ignored, whatever their names.
    """
    fps = fingerprints(docs, doc_id, text, shingle)
    fps = written(fps if similarity is not None else fps.drop("th"))
    ids = fps.groupBy("fp").agg(F.min("doc_id").alias("first"))
    edges = links(ids.select("fp"), tau, cap)
    if similarity is not None:
        own = fps.where("doc_id is not null").select("th", "fp").distinct()  # texts without any id get no such links
        side = lambda c: own.select(F.col("th").alias(c), F.col("fp").alias(f"fp_{c}"))
        alike = similar(docs, text, similarity).join(side("a"), "a").join(side("b"), "b")
        edges = edges.unionByName(alike.select(F.col("fp_a").alias("a"), F.col("fp_b").alias("b")).where("a <> b"))
    found = written(components(edges))
    classes = ids.join(found, ids.fp == found.node, "left").select(ids.fp, "first", F.coalesce("root", ids.fp).alias("root"))
    least = classes.groupBy("root").agg(F.min("first").alias("component_id"))
    named = classes.join(least, "root").select("fp", "component_id")
    return fps.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
