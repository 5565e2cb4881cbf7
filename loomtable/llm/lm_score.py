"""Language-model scores by cross-entropy difference.

Two word bigram models of one form, over one vocabulary (all words of the corpus), are counted: the target model on
the documents labelled good, the background model on all documents. A document's score is the mean over its words of
the target model's loss less the background model's, so low scores are close to the target.

    p(w | v) = L * c(v, w) / c(v) + (1 - L) * (c(w) + 1) / (N + V)

with L = 0 where the model has not seen v. A document begins with a start symbol; the end of a document is an event
of its own, so c(v) counts every v. A document never scores itself: its own counts are taken out of every c and N, in the
target model if it is part of that. Thus what only it says is unseen by both models, and what another document says as
well is not. Both models have one order, one vocabulary and one smoothing; the background covers all documents, since a
sample of the target's size would not know most repeats. Counts grow with the corpus; none is capped or sampled. Words
are told apart by 63 bits and pairs by 63, so a sum may, once in some 10^9 different ones, hold two of them.

Documents are dealt into blocks by a hash of their id. A block asks for each of its different words and pairs once:
it sends their hashes with its own counts, packed and cut by ranges of the hash. Each range adds up its counts and answers
every block in the order that it asked, and the block reads its documents again with all counts at hand. Documents are
dealt twice, by the same hash.

The most frequent words and pairs, ``LISTED`` at most, which stand in most blocks, take another way: blocks send what they
count of them as one message, a task adds up those of ``TOGETHER`` blocks, a sum by word or pair follows, and the totals
are broadcast. Which ones are listed is guessed from a sample; only the way hangs on it, no count does. So a range's
entries are of words that most blocks lack, and its task does not grow with the corpus.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtable.llm.common import WordHashes, frequent, parts, text_bytes, written

BLOCK_BYTES, RANGE_BYTES = 8 << 20, 8 << 20
#: One text in ``SAMPLE`` is looked through for frequent words and pairs: those found ``OFTEN`` times or more, ``LISTED`` at most.
SAMPLE, OFTEN, LISTED, TOGETHER = 256, 8, 1 << 16, 256
MIX = 0.5
_TOP = 1 << 63


def _pack(x: np.ndarray) -> bytes:
    """Whole numbers, byte by byte of their width, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes())


def _unpack(raw: bytes, kind: type) -> np.ndarray:
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(flat.reshape(width, -1).T).reshape(-1).view(kind)


def numbers(texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words of some texts, of the word before each (0 at a start) and of each pair, and the words of each text."""
    hashes, each = WordHashes(), []
    for s in texts:
        w = s.encode().lower().split() if s else []
        each.append(np.fromiter(map(hashes.__getitem__, w), np.int64, len(w)).view(np.uint64) | np.uint64(1))  # 0 is the start
    lens = np.array([len(p) for p in each], np.int64)
    words = np.concatenate(each) if each else np.empty(0, np.uint64)
    before = np.concatenate([[np.uint64(0)], words[:-1]]) if len(words) else words
    if len(words):
        before[(np.cumsum(lens) - lens)[lens > 0]] = 0
    pairs = before * np.uint64(0x9E3779B97F4A7C15) + words * np.uint64(0xC2B2AE3D27D4EB4F)
    pairs ^= pairs >> np.uint64(29)
    return words, before, (pairs * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(1), lens


class Block:
    """The documents of one block as numbers: each place's word and pair, among the block's different ones."""

    def __init__(self, rows: pa.Table):
        good = {i for i, y in zip(rows.column("doc_id").to_pylist(), rows.column("y").to_pylist(), strict=True) if y == 1}
        docs = rows.filter(pa.compute.is_null(rows.column("y")))
        self.ids = docs.column("doc_id").combine_chunks()
        words, before, pairs, self.lens = numbers(t.as_py() for t in docs.column("t"))
        self.doc = np.repeat(np.arange(len(self.lens)), self.lens)
        starts = np.zeros(int((self.lens > 0).sum()), np.uint64)
        mine = np.isin(np.arange(len(self.lens)), [k for k, i in enumerate(self.ids.to_pylist()) if i is not None and i in good])
        self.target = mine[self.doc]
        self.words, at, n = np.unique(np.concatenate([words, starts]), return_inverse=True, return_counts=True)
        self.at = at[: len(words)]
        self.n_words = n, np.bincount(at, np.concatenate([self.target, mine[self.lens > 0]]), len(n))
        self.before = np.searchsorted(self.words, before)
        self.pairs, self.pair, n = np.unique(pairs, return_inverse=True, return_counts=True)
        self.n_pairs = n, np.bincount(self.pair, self.target, len(n))

    def own(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each place, how often its document has the word, the word before it (the start: once) and the pair."""

        def times(values: np.ndarray, asked: np.ndarray) -> np.ndarray:
            width = np.int64(max(len(self.words), len(self.pairs)) + 1)
            keys, n = np.unique(self.doc * width + values, return_counts=True)
            wanted = self.doc * width + asked
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            return np.where(keys[at] == wanted, n[at], 1)

        if not len(self.doc):
            return (np.empty(0, np.int64),) * 3
        return times(self.at, self.at), times(self.at, self.before), times(self.pair, self.pair)


def _listed(docs: DataFrame) -> np.ndarray:
    """Hashes of frequent words and pairs in order, the start of a document among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in b.column(0):
                words, _, pairs, _ = numbers([t.as_py()])
                yield pa.record_batch([pa.array(np.concatenate([words, pairs]).view(np.int64))], names=["key"])

    some = docs.where(F.pmod(F.xxhash64("text"), F.lit(SAMPLE)) == 0).select("text").mapInArrow(run, "key long")
    return np.unique(np.concatenate([frequent(some, OFTEN, LISTED)[0], np.zeros(1, np.uint64)]))


def _among(keys: np.ndarray, listed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``keys`` are listed, and the places of those."""
    at = np.minimum(np.searchsorted(listed, keys), len(listed) - 1)
    here = listed[at] == keys
    return here, at[here]


def _dealt(docs: DataFrame, labels: DataFrame, label: str, blocks: int) -> DataFrame:
    """Texts and labels of a block together."""
    key = F.coalesce(F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id")), F.xxhash64("t"))
    every = docs.select("doc_id", F.col("text").alias("t"), F.lit(None).cast("int").alias("y")).unionByName(
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .groupBy("doc_id").agg(F.max(label).cast("int").alias("y")).select(F.col("doc_id").cast(docs.schema["doc_id"].dataType), F.lit(None).cast("string").alias("t"), "y")
    )
    return every.withColumn("block", F.pmod(key, F.lit(blocks)).cast("int")).repartition(max(8, blocks // 2), "block")


def _totals(sums: DataFrame, n: int) -> np.ndarray:
    """By pair or not, by model, the counts of each listed word or pair, of packed sums: ``LISTED`` rows at most of each come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for pair, *raw in zip(*(b.column(c).to_pylist() for c in range(3)), strict=True):
                x, y = (_unpack(r, np.uint64).astype(np.int64) for r in raw)
                at = np.flatnonzero(x)
                yield pa.record_batch([pa.array(np.full(len(at), pair, np.int32)), pa.array(at), pa.array(x[at]), pa.array(y[at])], names=["pair", "at", "n", "t"])

    found = sums.select("pair", "n", "t").mapInArrow(run, "pair int, at long, n long, t long").groupBy("pair", "at").agg(F.sum("n").alias("n"), F.sum("t").alias("t")).toArrow()
    out = np.zeros((2, 2, n), np.int64)
    for k, c in enumerate(("n", "t")):
        out[found.column("pair").to_numpy(), k, found.column("at").to_numpy()] = found.column(c).to_numpy()
    return out


def score(docs: DataFrame, labels: DataFrame, label: str = "quality", good: int = 1) -> DataFrame:
    """doc_id, n_tokens, loss_target, loss_background, score of every row.

    Words are runs without space, tab to carriage return, with A-Z in lower case. Null and empty texts have no words and
    null scores; a text of any length is read whole. If no other document has the label, the target model is uniform over the
    vocabulary. Labels with a null id or value are left out; of several for an id the largest counts. Rows that repeat an id
    are counted and scored each; a row with a null id is background. An empty table gives no rows; other columns are ignored.
    """
    if good != 1:
        labels = labels.withColumn(label, (F.col(label) == good).cast("int"))
    total = text_bytes(docs)
    blocks, ranges = parts(total, BLOCK_BYTES), parts(total, RANGE_BYTES)
    dealt = _dealt(docs, labels, label, blocks)
    kind = docs.schema["doc_id"].dataType.simpleString()
    edges = np.array([_TOP // ranges * k for k in range(1, ranges)], np.uint64)
    known = docs.sparkSession.sparkContext.broadcast(_listed(docs))

    def ask(key: tuple, rows: pa.Table) -> pa.Table:
        b = Block(rows)
        out = []
        for pair, (keys, (n, t)) in enumerate(((b.words, b.n_words), (b.pairs, b.n_pairs))):
            hot, at = _among(keys, known.value)
            if len(at):
                out.append((ranges + key[0].as_py() // TOGETHER, key[0].as_py(), pair, _pack(at.astype(np.uint32)), _pack(n[hot].astype(np.uint32)), _pack(t[hot].astype(np.uint32))))
            keys, n, t = keys[~hot], n[~hot], t[~hot]
            cuts = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]
            for k, (i, j) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                if j > i:
                    first = np.diff(keys[i:j], prepend=np.uint64(0))
                    out.append((k, key[0].as_py(), pair, _pack(first), _pack(n[i:j].astype(np.uint32)), _pack(t[i:j].astype(np.uint32))))
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
        return pa.table([pa.array(c, x) for c, x in zip(zip(*out, strict=True) if out else [[]] * 6, kinds, strict=True)], names=["range", "block", "pair", "keys", "n", "t"])

    def add_listed(rows: pa.Table) -> list[tuple]:
        """What some blocks counted of the listed words and pairs, as one message each."""
        out = []
        for pair in (0, 1):
            sums = np.zeros((2, len(known.value)), np.uint64)
            mine = rows.filter(pa.compute.equal(rows.column("pair"), pair))
            for keys, *counts in zip(*(mine.column(c).to_pylist() for c in ("keys", "n", "t")), strict=True):
                for k, raw in enumerate(counts):
                    sums[k, _unpack(keys, np.uint32)] += _unpack(raw, np.uint32)  # a place stands once in a message
            out.append((-2, 0, pair, _pack(sums[0]), _pack(sums[1])))
        return out

    def add(key: tuple, rows: pa.Table) -> pa.Table:
        hot = key[0].as_py() >= ranges
        out = add_listed(rows) if hot else []
        for pair in () if hot else (0, 1):
            mine = rows.filter(pa.compute.equal(rows.column("pair"), pair))
            asked = [np.cumsum(_unpack(k, np.uint64)) for k in mine.column("keys").to_pylist()]
            if not asked:
                continue
            keys, at = np.unique(np.concatenate(asked), return_inverse=True)
            sums = []
            for c in ("n", "t"):
                each = np.concatenate([_unpack(x, np.uint32) for x in mine.column(c).to_pylist()])
                sums.append(np.bincount(at, each, len(keys)).astype(np.uint64))
            if pair == 0:
                real = keys > 0
                out.append((-1, key[0].as_py(), int(real.sum()), str(int(sums[0][real].sum())).encode(), str(int(sums[1][real].sum())).encode()))
            begin = 0
            for block, a in zip(mine.column("block").to_pylist(), asked, strict=True):
                own = at[begin : begin + len(a)]
                begin += len(a)
                out.append((block, key[0].as_py(), pair, _pack(sums[0][own]), _pack(sums[1][own])))
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
        return pa.table([pa.array(c, x) for c, x in zip(zip(*out, strict=True) if out else [[]] * 5, kinds, strict=True)], names=["block", "range", "pair", "n", "t"])

    asked = dealt.groupBy("block").applyInArrow(ask, "range int, block int, pair int, keys binary, n binary, t binary")
    asked = asked.repartition(max(8, ranges // 2), "range")  # by the input, whatever the session's number of partitions
    told = written(asked.groupBy("range").applyInArrow(add, "block int, range int, pair int, n binary, t binary"))
    whole = told.where("block = -1").agg(F.sum("pair"), F.sum(F.col("n").cast("string").cast("long")), F.sum(F.col("t").cast("string").cast("long"))).first()
    listed = _totals(told.where("block = -2"), len(known.value))
    real = listed[0, 0] * (known.value > 0)
    vocabulary = (whole[0] or 0) + int((real > 0).sum())
    sizes = tuple((whole[k + 1] or 0) + int((listed[0, k] * (known.value > 0)).sum()) for k in (0, 1))
    totals = docs.sparkSession.sparkContext.broadcast(listed.astype(np.float64))

    def read(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        b = Block(rows)
        answers = answers.sort_by([("pair", "ascending"), ("range", "ascending")])
        losses, own, whole = [], b.own(), b.lens[b.doc]
        for c, size in (("t", sizes[1]), ("n", sizes[0])):
            mine = b.target if c == "t" else np.ones(len(b.doc), bool)
            counts = []
            for p, keys in enumerate((b.words, b.pairs)):
                hot, at = _among(keys, known.value)
                got = np.concatenate([np.empty(0), *[_unpack(x, np.uint64).astype(np.float64) for x in answers.filter(pa.compute.equal(answers.column("pair"), p)).column(c).to_pylist()]])
                if len(got) + len(at) != len(keys):
                    raise RuntimeError("a block's documents changed between the two reads")
                counts.append(np.empty(len(keys)))
                counts[p][hot], counts[p][~hot] = totals.value[p, int(c == "t")][at], got
            words, pairs = counts
            context = words[b.before] - mine * own[1]
            p = (words[b.at] - mine * own[0] + 1) / (size - mine * whole + vocabulary)
            seen = np.where(context > 0, MIX, 0.0)
            p = (1 - seen) * p + seen * (pairs[b.pair] - mine * own[2]) / np.maximum(context, 1)
            losses.append(np.bincount(b.doc, -np.log(p), len(b.lens)) / np.maximum(b.lens, 1))
        none = b.lens == 0
        cols = [pa.array(x, mask=none) for x in (losses[0], losses[1], losses[0] - losses[1])]
        return pa.table([b.ids, pa.array(b.lens), *cols], names=["doc_id", "n_tokens", "loss_target", "loss_background", "score"])

    return (
        dealt.groupBy("block").cogroup(told.where("block >= 0").groupBy("block"))
        .applyInArrow(read, f"doc_id {kind}, n_tokens long, loss_target double, loss_background double, score double")
    )


SQL = r"""
WITH l AS (SELECT doc_id, max(quality) AS q FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
d AS (
  SELECT d.doc_id, coalesce(l.q = 1, false) AS good,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS ws
  FROM documents d LEFT JOIN l ON d.doc_id = l.doc_id),
t AS (SELECT doc_id, good, i, ws[i] AS w, CASE WHEN i = 1 THEN '' ELSE ws[i - 1] END AS v FROM (SELECT *, unnest(generate_series(1, len(ws))) AS i FROM d)),
u AS (SELECT w, count(*) AS b, count(*) FILTER (WHERE good) AS g FROM t GROUP BY w),
c AS (SELECT * FROM u UNION ALL SELECT '', count(*), count(*) FILTER (WHERE good) FROM d WHERE len(ws) > 0),
p AS (SELECT v, w, count(*) AS b, count(*) FILTER (WHERE good) AS g FROM t GROUP BY v, w),
s AS (SELECT count(*) AS vocabulary, sum(b) AS b, sum(g) AS g FROM u),
o AS (SELECT doc_id, good, v, w, count(*) AS k FROM t GROUP BY ALL),
x AS (SELECT doc_id, w, count(*) AS k FROM t GROUP BY ALL),
e AS (
  SELECT o.doc_id, o.k, vocabulary, p.b - o.k AS pb, p.g - o.k * q AS pg, c.b - coalesce(y.k, 1) AS cb, c.g - coalesce(y.k, 1) * q AS cg,
         u.b - x.k + 1 AS ub, u.g - x.k * q + 1 AS ug, s.b - len(d.ws) + vocabulary AS nb, coalesce(s.g, 0) - len(d.ws) * q + vocabulary AS ng
  FROM (SELECT *, CASE WHEN good THEN 1 ELSE 0 END AS q FROM o) o JOIN d ON o.doc_id = d.doc_id JOIN p ON o.v = p.v AND o.w = p.w JOIN c ON o.v = c.w JOIN u ON o.w = u.w
  JOIN x ON o.doc_id = x.doc_id AND o.w = x.w LEFT JOIN x y ON o.doc_id = y.doc_id AND o.v = y.w, s),
m AS (
  SELECT doc_id, sum(k) AS k,
    sum(-k * ln(CASE WHEN cb > 0 THEN 0.5 * pb / cb + 0.5 * ub / nb ELSE CAST(ub AS DOUBLE) / nb END)) AS lb,
    sum(-k * ln(CASE WHEN cg > 0 THEN 0.5 * pg / cg + 0.5 * ug / ng ELSE CAST(ug AS DOUBLE) / ng END)) AS lg
  FROM e GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_tokens, round(lg / k, 6) AS loss_target, round(lb / k, 6) AS loss_background, round((lg - lb) / k, 6) AS score
FROM d LEFT JOIN m ON d.doc_id = m.doc_id
"""
