"""Substring deduplication by relative Lempel-Ziv parsing against indexed reference blocks.

A word goes if a window of ``WINDOW`` words that covers it also starts in a document with a smaller id.

1. Texts that are equal collapse first, by a 128-bit hash: the smallest id's text is parsed for all of them, and every
   window of the others is a repeat.
2. Each window names an anchor, the first of its ``GRAM``-word grams in one order of all grams: equal windows name equal
   anchors, so a window can only repeat where its anchor does. Grams that a sample of the texts repeats come last in the
   order. Thus a common passage is an anchor of such windows only that hold nothing else, and those are alike. The order
   never changes the result. Neighbouring windows mostly share an anchor; a run of them is a piece.
3. Pieces whose anchor stands in two documents or more collapse where they are equal, with partial minima of the ids
   before the shuffle. What is left, each different piece once, is the reference, dealt into blocks by its anchors.
4. A block is indexed by a suffix array over words, and each of its pieces is factored greedily, from left to right,
   against what smaller ids have there: a factor is the longest prefix of the rest that starts in a smaller document.
   Lengths are only compared where the parse stops. Factors of a window or more are duplicate spans. A window may also
   lie across a factor boundary: those that start less than a window before one are looked up singly. No other repeated
   window can exist, since one that starts inside a factor ends inside it or crosses its end.
5. A document's factors come together from all blocks, overlapping ones are joined into its spans, and the words go.

A text is shuffled only if it has a piece to be cut out, and again if it has a span to lose: a bitmap of fixed size tells
most others, which stay where they are. Keys that many rows share are split off (``common.beside``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtable.llm.common import WordHashes, among, beside, bitmap, flagged, frequent, numbered, parts, text_bytes, written

WINDOW, GRAM, RUN = 50, 10, 64
#: Bytes of pieces in a reference block, if all text repeated.
BLOCK_BYTES = 12 << 20
#: One text in ``SAMPLE`` is looked through for common grams: those in ``OFTEN`` such texts, ``LISTED`` at most. They order anchors, no more.
SAMPLE, OFTEN, LISTED = 16, 3, 1 << 20
_ALL = (1 << 31) - 1  # as the last start of a span: to the text's end


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        found = self[word] = len(self)
        return found


def grams(words: list[bytes], hashes: WordHashes, gram: int) -> np.ndarray:
    """64-bit hashes of the runs of ``gram`` words; ``words`` holds that many at least."""
    h = np.fromiter(map(hashes.__getitem__, words), np.int64, len(words)).view(np.uint64)
    m = len(h) - gram + 1
    g = np.zeros(m, np.uint64)
    for j in range(gram):
        g = g * np.uint64(0x9E3779B97F4A7C15) + h[j : j + m]
    g ^= g >> np.uint64(31)
    g *= np.uint64(0xBF58476D1CE4E5B9)
    g ^= g >> np.uint64(29)
    return g


def runs(words: list[bytes], hashes: WordHashes, window: int = WINDOW, common: np.ndarray = np.empty(0, np.uint64)) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """anchor, first and last start of each run of windows that share an anchor; at most ``RUN`` starts in a run.

    ``common`` holds, in order, the grams that are an anchor only where a window has no other.
    """
    n = len(words) - window + 1
    if n < 1:
        return (np.empty(0, np.int64),) * 3
    gram = min(GRAM, window)
    g = grams(words, hashes, gram)
    late = np.zeros(len(g), bool)
    if len(common):
        late = common[np.minimum(np.searchsorted(common, g), len(common) - 1)] == g
    g = (g >> np.uint64(1)) | (late.astype(np.uint64) << np.uint64(63))
    span, have = window - gram + 1, 1
    while 2 * have <= span:
        g = np.minimum(g[:-have], g[have:])
        have *= 2
    least = np.minimum(g[:n], g[span - have : span - have + n])
    first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    length = np.diff(np.append(first, n))
    if length.max() > RUN:
        pieces = -(-length // RUN)
        first = np.repeat(first, pieces) + RUN * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    return least[first].view(np.int64), first, np.append(first[1:], n) - 1


def factor(bodies: list[bytes], docs: np.ndarray, window: int = WINDOW) -> list[list[tuple[int, int]]]:
    """For each piece (words joined by a space) of one block, the runs (first, last) of starts of windows that a smaller document has too."""
    numbers = _Numbers()
    parts_, lens = [], []
    for k, body in enumerate(bodies):
        w = np.fromiter(map(numbers.__getitem__, body.split(b" ")), np.int64)
        parts_ += [w, [-1 - k]]
        lens.append(len(w) + 1)
    x = np.concatenate(parts_).astype(np.int64)
    x[x < 0] = len(numbers) - 1 - x[x < 0]  # each separator is a symbol of its own, so no match runs over it
    n, lens_ = len(x), np.array(lens)
    begins = np.cumsum(lens_) - lens_
    whose = np.repeat(docs, lens_)
    names = [x]  # names[k][i]: rank of the 2^k words from i on
    order = None
    for k in range(6):
        now, step = names[-1], 1 << k
        after = np.zeros(n, np.int64)
        after[: n - step] = now[step:] + 1
        key = now * (n + len(numbers) + len(bodies) + 2) + after
        order = np.argsort(key)
        name = np.empty(n, np.int64)
        name[order] = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        names.append(name)
    beside_ = np.full((2, n), -1)  # of each place, the nearest suffix of a smaller document on both sides
    d = whose[order]
    for side in (0, 1):
        near = _smaller(d[::-1] if side else d)
        if side:
            near = np.where(near[::-1] < 0, -1, n - 1 - near[::-1])
        have = near >= 0
        beside_[side, order[have]] = order[near[have]]

    def longest(at: np.ndarray) -> np.ndarray:
        """Words that each place has in common with a smaller document."""
        found = np.zeros(len(at), np.int64)
        for other in beside_:
            have = np.flatnonzero(other[at] >= 0)
            found[have] = np.maximum(found[have], _common(names, at[have], other[at[have]], n))
        return found

    cut = np.zeros(n + 1, np.int32)  # windows before a boundary
    long = np.zeros(n + 1, np.int32)  # windows inside a factor
    at, start, end = begins.copy(), begins, begins + lens_ - 1
    while len(at):
        length = longest(at)
        whole = at[length >= window]
        long[whole] += 1
        np.add.at(long, whole + length[length >= window] - window + 1, -1)
        at = at + np.maximum(length, 1)
        more = at < end
        at, start, end = at[more], start[more], end[more]
        np.add.at(cut, np.maximum(start, at - window + 1), 1)
        cut[at] -= 1
    dup = np.cumsum(long[:n]) > 0
    across = np.flatnonzero((np.cumsum(cut[:n]) > 0) & ~dup)
    dup[across[longest(across) >= window]] = True
    edge = np.diff(np.concatenate([[0], dup.view(np.int8), [0]]))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1
    to = np.searchsorted(first, np.append(begins, n))  # separators are no starts, so no run goes over a piece's end
    return [list(zip((first[a:b] - s).tolist(), (last[a:b] - s).tolist(), strict=True)) for a, b, s in zip(to[:-1], to[1:], begins, strict=True)]


def _smaller(d: np.ndarray) -> np.ndarray:
    """Index of the nearest earlier entry that is smaller, or -1: pointers jump until all have settled."""
    at = np.arange(len(d)) - 1
    live = np.flatnonzero(at >= 0)
    while len(live):
        live = live[(at[live] >= 0)]
        live = live[d[at[live]] >= d[live]]
        at[live] = at[at[live]]
    return at


def _common(names: list[np.ndarray], a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Words that the texts from a and from b have in common, up to 127; no piece is longer."""
    long = np.zeros(len(a), np.int64)
    for k in range(len(names) - 1, -1, -1):
        i, j = np.minimum(a + long, n - 1), np.minimum(b + long, n - 1)
        long += (names[k][i] == names[k][j]) * (1 << k)
    return long


def _common_grams(texts: DataFrame, gram: int) -> np.ndarray:
    """Grams that the sampled texts repeat, in order; ``texts`` has k1, t."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in batches:
            for t in b.column(0):
                w = t.as_py().encode().split()
                if len(w) >= gram:
                    yield pa.record_batch([pa.array(np.unique(grams(w, hashes, gram)).view(np.int64))], names=["key"])

    some = texts.where(F.pmod("k1", F.lit(SAMPLE)) == 0).dropDuplicates(["k1"]).select("t")
    return frequent(some.mapInArrow(run, "key long"), OFTEN, LISTED)[0]


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text (kept words joined by a space) of every row.

    Words are runs without space, tab to carriage return. Null and empty texts have no words, a text of any length is
    taken whole. Ids of any kind that has an order will do; a null id counts as larger than all others but 2^63 - 1, with
    which it ties. Rows that share an id never remove each other's words, and each gets its own row. An empty table gives no
    rows. Other columns are ignored, whatever their names. ``window`` is 127 - RUN words at most.
    """
    if not 1 <= window <= 127 - RUN:
        raise ValueError(f"window must be 1 to {127 - RUN}")
    rows, number = numbered(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("t")), "doc_id")
    base = rows.select("doc_id", number.alias("d"), F.xxhash64("t").alias("k1"), F.xxhash64(F.lit(1), "t").alias("k2"), "t")
    total = text_bytes(docs, text)
    blocks, key = parts(total * 4, BLOCK_BYTES), ["k1", "k2"]
    texts = base.where("t is not null").select("d", *key, "t")

    many = texts.groupBy(*key).agg(F.min("d").alias("lo"), F.max("d").alias("hi"), F.count("*").alias("n")).where("lo < hi").drop("hi")
    copies = beside(texts.select("d", *key), written(many), key).where("d > lo").groupBy("d", *key).agg(F.first("lo").alias("lo"))
    common = docs.sparkSession.sparkContext.broadcast(_common_grams(texts, min(GRAM, window)))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in batches:
            out: list[list[np.ndarray]] = [[], [], [], []]
            for i in range(b.num_rows):
                found = runs(b.column(3)[i].as_py().encode().split(), hashes, window, common.value)
                if len(found[0]):
                    for o, v in zip(out, (np.full(len(found[0]), i), *found), strict=True):
                        o.append(v)
            if out[0]:
                which = pa.array(np.concatenate(out[0]))
                yield pa.record_batch(
                    [*(b.column(c).take(which) for c in range(3)), *(pa.array(np.concatenate(o), kind) for o, kind in zip(out[1:], (pa.int64(), pa.int32(), pa.int32()), strict=True))],
                    names=["d", "k1", "k2", "anchor", "a", "z"],
                )

    seen = written(texts.mapInArrow(find, "d long, k1 long, k2 long, anchor long, a int, z int"))
    ends = [f(c).alias(f"{n}_{c}") for c in ("d", *key) for f, n in ((F.min, "lo"), (F.max, "hi"))]
    shared = seen.groupBy("anchor").agg(F.count("*").alias("n"), *ends).where("lo_d < hi_d and (lo_k1 < hi_k1 or lo_k2 < hi_k2)")
    places = (
        beside(seen, written(shared.select("anchor", "n")), ["anchor"]).groupBy(*key)
        .agg(F.min("d").alias("d"), F.sort_array(F.collect_set(F.struct("a", "z", "anchor"))).alias("runs"))  # of one text, whose copies all have the same
    )
    places = written(places)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for d, k1, k2, t, rs in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
                w = t.encode().split()
                for r in rs:
                    body = b" ".join(w[r["a"] : r["z"] + window])
                    out.append((d, k1, k2, r["a"], r["z"], r["anchor"], xxhash.xxh128_digest(body), body))
                if len(out) > 20_000:
                    yield _rows(out)
                    out = []
            if out:
                yield _rows(out)

    def _rows(out: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
        return pa.record_batch([pa.array(c, x) for c, x in zip(zip(*out, strict=True), kinds, strict=True)], names=["d", "k1", "k2", "a", "z", "anchor", "m", "body"])

    # The first row of each text that has a piece.
    firsts = among(texts, bitmap(places, "k1"), "k1").join(places.hint("merge"), ["d", *key]).select("d", *key, "t", "runs")
    pieces = written(firsts.mapInArrow(cut, "d long, k1 long, k2 long, a int, z int, anchor long, m binary, body binary"))
    # The reference: each different piece once, under its smallest id.
    each = pieces.groupBy("m").agg(F.min("d").alias("d"), F.max("d").alias("hi"), F.count("*").alias("n"), F.min("anchor").alias("anchor"), F.min("body").alias("body"))

    def parse(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("d", "ascending"), ("m", "ascending")])
        found = factor(rows.column("body").to_pylist(), rows.column("d").to_numpy(), window)
        again = rows.column("hi").to_numpy() > rows.column("d").to_numpy()
        hit = [i for i, f in enumerate(found) if f or again[i]]
        at = pa.array(hit, pa.int64())
        spans = pa.array([[{"s": s, "e": e} for s, e in found[i]] for i in hit], pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())])))
        return pa.table([rows.column("m").take(at), rows.column("n").take(at), rows.column("d").take(at), spans], names=["m", "n", "lo", "spans"])

    each = each.withColumn("block", F.pmod("anchor", F.lit(blocks)).cast("int"))
    known = written(each.groupBy("block").applyInArrow(parse, "m binary, n long, lo long, spans array<struct<s:int,e:int>>"))
    whole = F.array(F.struct(F.col("a").alias("s"), F.col("z").alias("e")))
    moved = F.transform("spans", lambda x: F.struct((x["s"] + F.col("a")).alias("s"), (x["e"] + F.col("a")).alias("e")))
    factors = beside(pieces.select("d", *key, "a", "z", "m"), known, ["m"]).select("d", *key, F.when(F.col("d") > F.col("lo"), whole).otherwise(moved).alias("spans"))
    spans = factors.where(F.size("spans") > 0).groupBy("d", *key).agg(F.flatten(F.collect_list("spans")).alias("spans"))  # of one text
    spans = written(spans.unionByName(copies.select("d", *key, F.array(F.struct(F.lit(0).alias("s"), F.lit(_ALL).alias("e"))).alias("spans"))))
    # Rows that may have spans meet them; all others stay where they are.
    bits = bitmap(spans.select((F.col("k1").bitwiseXOR(F.col("d"))).alias("x")), "x")
    every = base.select("doc_id", F.coalesce(F.col("k1").bitwiseXOR(F.col("d")), F.lit(0)).alias("x"), "d", *key, "t")
    met = among(every, bits, "x").join(spans.hint("merge"), ["d", *key], "left").select("doc_id", "t", "spans")
    kind = f"doc_id {base.schema['doc_id'].dataType.simpleString()}, n_words long, n_removed long, kept_text string"
    return met.mapInArrow(_remover(window), kind).unionByName(every.select("doc_id", "t", "x").mapInArrow(_remover(window, bits), kind))


def _remover(window: int, others: Broadcast | None = None):
    """Rows (doc_id, t, spans) without their spans, or of rows (doc_id, t, x) those that the bitmap ``others`` does not hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if others is not None:
                b = b.filter(pa.array(~flagged(others, b.column(2).to_numpy())))
            n_words, n_removed, kept = [], [], []
            for t, spans in zip(b.column(1).to_pylist(), b.column(2), strict=True):
                w = t.encode().split() if t else []
                n_words.append(len(w))
                if others is None and spans.is_valid and len(w) >= window:
                    s, e = (spans.values.field(f).to_numpy() for f in ("s", "e"))
                    edge = np.zeros(len(w) + 1, np.int32)
                    np.add.at(edge, s, 1)
                    np.add.at(edge, np.minimum(e, len(w) - window) + window, -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    w = [x for x, g in zip(w, gone.tolist(), strict=True) if not g]
                n_removed.append(n_words[-1] - len(w))
                kept.append(b" ".join(w).decode())
            yield pa.record_batch([b.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_text"])

    return run


SQL = r"""
WITH w AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS ws FROM documents),
s AS (SELECT doc_id, i, array_to_string(ws[i:i+49], ' ') AS win FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 49)) AS i FROM w)),
d AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY win) AS lo FROM s) WHERE lo < doc_id),
g AS (SELECT DISTINCT doc_id, i + o AS p FROM d, (SELECT unnest(generate_series(0, 49)) AS o)),
l AS (SELECT doc_id, list(p) AS ps FROM g GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(list_filter(ws, lambda x, i: ps IS NULL OR NOT list_contains(ps, i)), ' '), '')) AS kept_sha256
FROM w LEFT JOIN l ON w.doc_id = l.doc_id
"""
