"""Benchmark decontamination: an FM-index for each shard of training text, searched backwards for test phrases.

A shard is a bounded run of documents of one task. Its text is the sequence of its words as symbols of the phrases'
own alphabet; any other word, and each end of a document, is a separator, since no phrase can hold one. Runs shorter
than the shortest phrase can't hold a phrase either and stay out of the index. The suffix array of what is left gives
the Burrows-Wheeler transform, kept as a wavelet matrix with rank counts; phrases are searched from their last word to
their first, all at once, and found rows walk back to the next sampled suffix position.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtable.llm.common import written

WINDOW = 10
#: Words of a shard (a longer document is a shard of its own) and suffix positions between samples.
SHARD_WORDS, SAMPLE = 1 << 20, 8
#: UTF-8 bytes of benchmark text that one pass may broadcast; a larger benchmark is searched in several passes.
PASS_BYTES = 16 << 20

_MAP = bytes(c + 32 if 0x41 <= c <= 0x5A else 32 if c <= 0x2F or 0x3A <= c <= 0x60 or 0x7B <= c <= 0x7F else c for c in range(256))


#: The same words in a str, either case.
_WORD = re.compile(r"[0-9A-Za-z\x80-\U0010FFFF]+")


def tokens(text: str | None) -> list[bytes]:
    """Words of digits, letters and all beyond ASCII, A-Z lower-cased."""
    return text.encode().translate(_MAP).split() if text else []


class FMIndex:
    """Of an array of symbols 1 to size - 1, where 1 separates and is never searched; 0 is the end's alone."""

    def __init__(self, symbols: np.ndarray, size: int):
        text = np.append(symbols, 0).astype(np.int64)
        n = self.n = len(text)
        rank = text.copy()
        step = 1
        while True:  # prefix doubling
            after = np.zeros(n, np.int64)
            after[: n - step] = rank[step:] + 1 if step < n else 0
            key = rank * (max(int(rank.max()), int(after.max())) + 2) + after
            order = np.argsort(key, kind="stable")
            new = np.empty(n, np.int64)
            new[order] = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
            rank = new
            if rank[order[-1]] == n - 1 or step >= n:
                break
            step *= 2
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=size))])  # rows of smaller symbols
        bwt = text[order - 1]
        self.levels: list[tuple[np.ndarray, int]] = []
        self.width = max(1, int(size - 1).bit_length())
        now = bwt
        for level in range(self.width - 1, -1, -1):
            bit = (now >> level) & 1
            ones = np.concatenate([[0], np.cumsum(bit)]).astype(np.int32)
            zeros = n - int(ones[-1])
            self.levels.append((ones, zeros))
            now = np.concatenate([now[bit == 0], now[bit == 1]])
        self.starts = np.zeros(1 << self.width, np.int64)  # where each symbol begins in the last level's order
        values, first = np.unique(now, return_index=True)
        self.starts[values] = first
        self.bwt = bwt
        kept = order % SAMPLE == 0
        self.marked = np.concatenate([[0], np.cumsum(kept)]).astype(np.int64)
        self.samples = order[kept]

    def rank(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """How often each symbol stands in the transform before each row."""
        at = row
        for level, (ones, zeros) in zip(range(self.width - 1, -1, -1), self.levels, strict=True):
            up = ones[at]
            at = np.where((symbol >> level) & 1, zeros + up, at - up)
        return at - self.starts[symbol]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [lo, hi) of each phrase; ``phrases`` holds one a line, of equal lengths."""
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        live = np.arange(len(phrases))
        for k in range(phrases.shape[1] - 1, -1, -1):
            c = phrases[live, k]
            a = self.before[c] + self.rank(c, lo[live])
            b = self.before[c] + self.rank(c, hi[live])
            lo[live], hi[live] = a, b
            live = live[b > a]
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: steps back to a sampled suffix are counted."""
        rows, found, steps = rows.copy(), np.empty(len(rows), np.int64), 0
        live = np.arange(len(rows))
        while len(live):
            r = rows[live]
            hit = self.marked[r + 1] > self.marked[r]
            found[live[hit]] = self.samples[self.marked[r[hit]]] + steps
            live, r = live[~hit], r[~hit]
            c = self.bwt[r]
            rows[live] = self.before[c] + self.rank(c, r)
            steps += 1
        return found


class Phrases:
    """Windows of benchmark items over their own alphabet, grouped by length."""

    def __init__(self, items: Iterable[tuple[object, str | None]], window: int = WINDOW):
        self.ids: dict[bytes, int] = {}
        whose: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            w = [self.ids.setdefault(x, len(self.ids) + 2) for x in tokens(text)]
            for i in range(max(len(w) - window, 0) + 1 if w else 0):
                whose.setdefault(tuple(w[i : i + window]), set()).update([] if item is None else [str(item)])
        by: dict[int, list[tuple[int, ...]]] = {}
        for p in whose:
            by.setdefault(len(p), []).append(p)
        self.groups = [(np.array(ps, np.int64), [sorted(whose[p]) for p in ps]) for _, ps in sorted(by.items())]
        self.shortest = min(by, default=0)

    def hits(self, docs: list[list[bytes]]) -> list[tuple[np.ndarray | None, set[str]]]:
        """For each document of a shard: a mask of hit words (None: no hit) and the items found in it."""
        out: list[tuple[np.ndarray | None, set[str]]] = [(None, set())] * len(docs)
        if not self.groups:
            return out
        n = sum(map(len, docs)) + len(docs)
        symbols = np.ones(n, np.int64)
        starts = np.zeros(len(docs), np.int64)
        at, get = 0, self.ids.get
        for k, d in enumerate(docs):
            starts[k] = at
            symbols[at : at + len(d)] = np.fromiter((get(x, 1) for x in d), np.int64, len(d))
            at += len(d) + 1
        known = np.concatenate([[0], (symbols > 1).astype(np.int8), [0]])
        edge = np.diff(known)
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        long = last - first >= self.shortest
        first, last = first[long], last[long]
        if not len(first):
            return out
        keep = np.zeros(n + 1, np.int32)  # the runs and one separator after each
        np.add.at(keep, first, 1)
        np.add.at(keep, np.minimum(last + 1, n), -1)
        where = np.flatnonzero(np.cumsum(keep[:n]))
        index = FMIndex(symbols[where], len(self.ids) + 2)
        masks: dict[int, np.ndarray] = {}
        items: dict[int, set[str]] = {}
        for phrases, owners in self.groups:
            lo, hi = index.search(phrases)
            found = np.flatnonzero(hi > lo)
            if not len(found):
                continue
            counts = (hi - lo)[found]
            rows = np.repeat(lo[found] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
            places = where[index.locate(rows)]
            which = np.searchsorted(starts, places, side="right") - 1
            for p, k, f in zip(places.tolist(), which.tolist(), np.repeat(found, counts).tolist(), strict=True):
                if k not in masks:
                    masks[k], items[k] = np.zeros(len(docs[k]), bool), set()
                masks[k][p - starts[k] : p - starts[k] + phrases.shape[1]] = True
                items[k].update(owners[f])
        for k, m in masks.items():
            out[k] = (m, items[k])
        return out


def shards(batches: Iterator[pa.RecordBatch], words: int = SHARD_WORDS) -> Iterator[tuple[pa.Table, list[list[bytes]]]]:
    """Rows of a task in runs of about so many words, and the tokens of each text (column 1)."""
    held, docs, n = [], [], 0
    for b in batches:
        start = 0
        for k in range(b.num_rows):
            docs.append(tokens(b.column(1)[k].as_py()))
            n += len(docs[-1])
            if n >= words:
                yield pa.Table.from_batches([*held, b.slice(start, k + 1 - start)]), docs
                held, docs, n, start = [], [], 0, k + 1
        if start < b.num_rows:
            held.append(b.slice(start))
    if docs:
        yield pa.Table.from_batches(held), docs


def passes(benchmark: DataFrame, item_id: str, text: str, most: int) -> Iterator[list[tuple[object, str]]]:
    """The benchmark's items in groups of ``most`` bytes at most (or of one larger text), packed one after another.

    Items come to the driver a partition at a time, and partitions are dealt by size, so it never holds much more than two
    groups, however many items there are or how many are alike.
    """
    items = benchmark.select(F.col(item_id).alias("i"), F.col(text).alias("t")).where("t is not null")
    total = items.agg(F.sum(F.octet_length("t").cast("long"))).first()[0] or 0
    group, size = [], 0
    for r in items.repartition(max(1, -(-total // most)), F.xxhash64("i", "t", F.monotonically_increasing_id())).toLocalIterator():
        n = len(r.t.encode())
        if group and size + n > most:
            yield group
            group, size = [], 0
        group.append((r.i, r.t))
        size += n
    yield group


def scan(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", window: int = WINDOW, most: int = PASS_BYTES, keep: tuple[str, ...] = (), cut: bool = False,
) -> DataFrame:
    """doc_id, n_words, n_hit, items (sorted array), then ``keep``'s columns, of every row of ``docs``.

    A word is hit if an occurrence of a window covers it; an item of fewer words than the window is one window. With
    ``cut`` a column clean_text follows: the text without the merged spans of hit words (null stays null).

    Null and empty texts have no words and no hits, a text of any length is searched whole, items without words are never
    found, an empty benchmark hits nothing and an empty table gives no rows. Items that repeat a text are all named, an id
    that several items share is named once, and an item without an id hits words but has no name. Rows that repeat a
    doc_id are searched each. Columns outside ``keep`` are ignored, whatever their names; names in ``keep`` must differ
    from the others here. A benchmark of more than ``most`` bytes is searched in passes over the texts, each of which
    writes no more than the hits; the last one brings them together with the rows.
    """
    kept = [c for c in keep if c != doc_id]
    now = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("__text"), *[F.col(f"`{c}`") for c in kept])
    kind = now.schema["doc_id"].dataType.simpleString()
    out = ", ".join([f"doc_id {kind}, n_words long, n_hit long, items array<string>", *[f"`{f.name}` {f.dataType.simpleString()}" for f in now.schema.fields[2:]], *["clean_text string"] * cut])
    groups = passes(benchmark, item_id, item_text, most)
    first, more = next(groups), next(groups, None)
    send = docs.sparkSession.sparkContext.broadcast  # ``most`` bytes, or one text
    none = [F.lit(None).cast("binary").alias("__mask"), F.array().cast("array<string>").alias("__items")]
    if more is None:
        return now.select("doc_id", "__text", *none, *[F.col(f"`{c}`") for c in kept]).mapInArrow(_searcher(send(first), window, cut), out)
    # A text's hits are the same in every row that holds it, so they are kept by text.
    key = [F.xxhash64("__text").alias("__k1"), F.xxhash64(F.lit(1), "__text").alias("__k2")]
    texts = now.select(*key, "__text").where("__text is not null")
    found = None
    for group in itertools.chain([first, more], groups):
        part = written(texts.mapInArrow(_finder(send(group), window), "__k1 long, __k2 long, mask binary, items array<string>"))
        found = part if found is None else found.unionByName(part)
    hits = found.groupBy("__k1", "__k2").agg(F.collect_set("mask").alias("__masks"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("__items"))
    rows = now.select("doc_id", "__text", *key, *[F.col(f"`{c}`") for c in kept]).join(hits, ["__k1", "__k2"], "left")
    one = F.udf(_together, "binary")("__masks").alias("__mask")
    rows = rows.select("doc_id", "__text", one, F.coalesce("__items", F.array().cast("array<string>")).alias("__items"), *[F.col(f"`{c}`") for c in kept])
    return rows.mapInArrow(_searcher(send([]), window, cut), out)


def _together(masks: list[bytes] | None) -> bytes | None:
    """The packed masks of one text from all passes as one; called for texts with hits alone."""
    return np.bitwise_or.reduce([np.frombuffer(m, np.uint8) for m in masks]).tobytes() if masks else None


def _finder(sent, window: int):
    """Of rows (k1, k2, text), those with hits: the keys, the packed mask and the items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = Phrases(sent.value, window)
        for rows, words in shards((b.select([0, 2, 1]) for b in batches)):
            got = [(k, np.packbits(m).tobytes(), sorted(items)) for k, (m, items) in enumerate(phrases.hits(words)) if m is not None]
            at = pa.array([g[0] for g in got], pa.int64())
            cols = [rows.column(0).take(at), rows.column(2).take(at), pa.array([g[1] for g in got], pa.binary()), pa.array([g[2] for g in got], pa.list_(pa.string()))]
            yield from pa.Table.from_arrays(cols, names=["__k1", "__k2", "mask", "items"]).combine_chunks().to_batches()

    return run


def _searcher(sent, window: int, cut: bool):
    """Rows (doc_id, text, mask, items, ...) searched for the phrases sent, together with the hits that they bring along."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = Phrases(sent.value, window)
        for rows, words in shards(batches):
            masks, items = [], []
            for w, (mask, found), old, had in zip(words, phrases.hits(words), rows.column("__mask").to_pylist(), rows.column("__items").to_pylist(), strict=True):
                if old is not None:
                    old = np.unpackbits(np.frombuffer(old, np.uint8), count=len(w)).astype(bool)
                    mask = old if mask is None else mask | old
                masks.append(mask)
                items.append(sorted(found.union(had)))
            names = ["doc_id", "n_words", "n_hit", "items", *rows.column_names[4:], *["clean_text"] * cut]
            cols = [
                rows.column(0), pa.array([len(w) for w in words], pa.int64()),
                pa.array([0 if m is None else int(m.sum()) for m in masks], pa.int64()), pa.array(items, pa.list_(pa.string())), *rows.columns[4:],
            ]
            if cut:
                cols.append(pa.array([t if m is None else without(t, m) for t, m in zip(rows.column(1).to_pylist(), masks, strict=True)], pa.string()))
            yield from pa.Table.from_arrays(cols, names=names).combine_chunks().to_batches()

    return run


def without(text: str, mask: np.ndarray) -> str:
    """The text without its hit words; words hit one after another go with all that stands between them."""
    spans: list[list[int]] = []
    previous = -2
    for k, m in enumerate(_WORD.finditer(text)):
        if mask[k]:
            if previous == k - 1:
                spans[-1][1] = m.end()
            else:
                spans.append([m.start(), m.end()])
            previous = k
    kept, at = [], 0
    for a, b in spans:
        kept.append(text[at:a])
        at = b
    return "".join([*kept, text[at:]])


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row; see ``scan`` for the odd cases."""
    return scan(docs, benchmark).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws FROM documents),
b AS (SELECT item_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws FROM benchmark),
i AS (SELECT DISTINCT item_id, least(len(ws), 10) AS n, array_to_string(ws[k:k+9], ' ') AS win FROM (SELECT *, unnest(generate_series(1, greatest(len(ws) - 9, 1))) AS k FROM b WHERE len(ws) > 0)),
l AS (SELECT DISTINCT n FROM i),
s AS (SELECT doc_id, n, k, array_to_string(ws[k:k+n-1], ' ') AS win FROM (SELECT doc_id, ws, n, unnest(generate_series(1, len(ws) - n + 1)) AS k FROM d, l WHERE len(ws) >= n)),
h AS (SELECT s.doc_id, s.k, s.n, i.item_id FROM s JOIN i ON s.n = i.n AND s.win = i.win),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(k, k + n - 1)) AS p FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM h WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN c ON d.doc_id = c.doc_id LEFT JOIN t ON d.doc_id = t.doc_id
"""
