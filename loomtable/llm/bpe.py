"""BPE encoding and decoding with a public byte-level tokenizer: each distinct word is merged once for the whole corpus.

Documents are split into words in blocks of about ``BLOCK_BYTES`` of text. A block lists its distinct words once and keeps
each document as the places of its words in that list. The lists of all blocks meet in a table of distinct words, dealt over
tasks by the words' hash, where each word's ids are found once; ids go back to the blocks by place, and a document's ids are put
together in its block. Blocks are written in buckets, so documents are not shuffled at all, only each block's lists, packed. A word that every
document holds stands once in the list of each block, so no key is hot.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomtable.llm.common import bucketed, parts, text_bytes

#: Bytes of text in a block; a longer text is a block of its own.
BLOCK_BYTES = 8 << 20
#: Bytes of text for each share of the table of distinct words: a share's words fit in one task whatever the corpus.
SHARE_BYTES = 64 << 20
#: Ids that decoding looks up at once.
DECODED = 500_000
#: Most buckets of the blocks' table.
MOST_BUCKETS = 20_000
#: How byte-level tokenizers of this family split a text (a fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_CODEC = "zstd"


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in such vocabularies: itself if it can be printed, else the next code point from 256."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Vocabulary:
    """What a tokenizer file says: its special tokens, the library's merges and its splitter."""

    def __init__(self, source: str) -> None:
        from tokenizers import Tokenizer

        said = json.loads(source)
        split = said.get("pre_tokenizer") or {}
        if said["model"]["type"] != "BPE" or said.get("normalizer") or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True):
            raise ValueError("only byte-level BPE without a normalizer or a prefix space is supported")
        odd = [t["content"] for t in said["added_tokens"] if t["lstrip"] or t["rstrip"] or t["single_word"]]
        if odd:
            raise ValueError(f"special tokens that take in what is beside them are not supported: {odd}")
        self.special = {t["content"]: t["id"] for t in said["added_tokens"]}
        whole = Tokenizer.from_str(source)
        self.splitter = whole.pre_tokenizer
        self.merges = Tokenizer(whole.model)  # no splitting: a word goes in as it is
        self.letters = byte_letters()
        self.cut = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.agreed: set[str] = {chr(c) for c in range(128) if not 0x1C <= c <= 0x1F}
        self.disputed: set[str] = set()
        self.pattern = regex.compile(PATTERN)

    def _by_library(self, text: str) -> list[str]:
        return [text[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(text)]

    def _disputed(self, text: str) -> bool:
        """Whether the text has a code point that this machine's pattern and the library class differently (their Unicode versions differ)."""
        found = set(text) - self.agreed
        for c in found - self.disputed:
            probe = f"a{c}1{c}!{c} x"
            (self.agreed if self.pattern.findall(probe) == self._by_library(probe) else self.disputed).add(c)
        return not found.isdisjoint(self.disputed)

    def words(self, text: str) -> list[str]:
        """The words of a text in order; joined they are the text."""
        if self.cut is None or not self.cut.search(text):
            return self._by_library(text) if self._disputed(text) else self.pattern.findall(text)
        found: list[str] = []
        for i, part in enumerate(self.cut.split(text)):
            found += [part] if i % 2 else self._by_library(part) if self._disputed(part) else self.pattern.findall(part)
        return found

    def ids(self, words: Sequence[str]) -> list[list[int]]:
        """Ids of each word."""
        mapped = [w.encode().decode("latin-1").translate(self.letters) for w in words]
        found = [e.ids for e in self.merges.encode_batch(mapped, add_special_tokens=False)]
        return [[self.special[w]] if w in self.special else e for w, e in zip(words, found, strict=True)]


@lru_cache(maxsize=2)
def _vocabulary(source: str) -> Vocabulary:
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    return Vocabulary(source)


@lru_cache(maxsize=2)
def _pieces(source: str) -> list[bytes]:
    """The bytes of each id's piece; a piece with a letter that stands for no byte is its own text."""
    said, back = json.loads(source), {c: b for b, c in byte_letters().items()}
    named = {i: p for p, i in said["model"]["vocab"].items()} | {t["id"]: t["content"] for t in said["added_tokens"]}
    found = [b""] * (max(named) + 1)
    for i, piece in named.items():
        found[i] = bytes(back[c] for c in piece) if all(c in back for c in piece) else piece.encode()
    return found


def tokenizer_source(path: str) -> str:
    """The text of a tokenizer file, read on the driver; its size is that of a vocabulary, whatever the corpus."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers below 2^32 as bytes: four planes, of which the high ones are mostly zero, compressed."""
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return pa.Codec(_CODEC).compress(np.ascontiguousarray(planes).tobytes(), asbytes=True)


def _unpacked(body: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.Codec(_CODEC).decompress(body, decompressed_size=4 * n, asbytes=True), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


class _Places(dict):
    """The place of each word of a block, in order of first use."""

    def __missing__(self, word: str) -> int:
        found = self[word] = len(self)
        return found


#: Beside a document's columns: its block, how many words it has and their places; or a share of the block's words, in packed columns.
_CUT = [
    ("__block", T.LongType(), pa.int64()), ("__share", T.IntegerType(), pa.int32()), ("__n", T.IntegerType(), pa.int32()),
    ("__places", T.BinaryType(), pa.binary()), ("__lengths", T.BinaryType(), pa.binary()), ("__words", T.BinaryType(), pa.binary()),
]


def _blocks(docs: DataFrame, source, text: str, names: Sequence[str], block_bytes: int, size: int, shares: int) -> DataFrame:
    """Rows of two kinds, written and dealt by block: a document with the places of its words (share is null), and a block's words of one
    share with theirs."""
    schema = T.StructType([T.StructField(f"__k{i}", docs.schema[n].dataType) for i, n in enumerate(names)] + [T.StructField(n, t) for n, t, _ in _CUT])
    rows = docs.select(*[F.col(f"`{n}`").alias(f"__k{i}") for i, n in enumerate(names)], F.col(f"`{text}`").cast("string").alias("__t"))
    width = len(names)

    def closed(block: int, batches: list, places: _Places, bodies: list[np.ndarray], arrow: pa.Schema) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(places), np.int64)
        for b in bodies:
            counts += np.bincount(b, minlength=len(places))
        rank = np.empty(len(places), np.int64)
        rank[np.argsort(-counts, kind="stable")] = np.arange(len(places))  # frequent words get small places
        at = 0
        for keys in batches:
            m = keys.num_rows
            mine = bodies[at:at + m]
            at += m
            yield pa.RecordBatch.from_arrays([
                *keys.columns, pa.array([block] * m, pa.int64()), pa.nulls(m, pa.int32()), pa.array([len(b) for b in mine], pa.int32()),
                pa.array([_packed(rank[b]) for b in mine], pa.binary()), pa.nulls(m, pa.binary()), pa.nulls(m, pa.binary()),
            ], schema=arrow)
        dealt: dict[int, list[bytes]] = {}
        mapped = {w.encode(): i for w, i in places.items()}
        for w in sorted(mapped):
            dealt.setdefault(zlib.crc32(w) % shares, []).append(w)
        for share, listed in dealt.items():
            yield pa.RecordBatch.from_arrays([
                *[pa.nulls(1, f.type) for f in list(arrow)[:width]], pa.array([block], pa.int64()), pa.array([share], pa.int32()), pa.array([len(listed)], pa.int32()),
                pa.array([_packed(rank[[mapped[w] for w in listed]])], pa.binary()), pa.array([_packed(np.array([len(w) for w in listed]))], pa.binary()),
                pa.array([pa.Codec(_CODEC).compress(b"".join(listed), asbytes=True)], pa.binary()),
            ], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc = _vocabulary(source.value)
        block = TaskContext.get().partitionId() << 32
        held, places, bodies, size, arrow = [], _Places(), [], 0, None
        for b in batches:
            keys = pa.RecordBatch.from_arrays(b.columns[:width], names=b.schema.names[:width])
            if arrow is None:
                arrow = pa.schema([*keys.schema, *[pa.field(n, t) for n, _, t in _CUT]])
            begun = 0
            for i, t in enumerate(b.column(width)):
                t = t.as_py() or ""
                found = voc.words(t)
                bodies.append(np.fromiter(map(places.__getitem__, found), np.uint32, len(found)))
                size += len(t)
                if size >= block_bytes:
                    held.append(keys.slice(begun, i + 1 - begun))
                    yield from closed(block, held, places, bodies, arrow)
                    held, places, bodies, size, begun, block = [], _Places(), [], 0, i + 1, block + 1
            if begun < b.num_rows:
                held.append(keys.slice(begun))
        if held:
            yield from closed(block, held, places, bodies, arrow)

    return bucketed(rows.mapInArrow(run, schema), "__block", min(MOST_BUCKETS, parts(size, block_bytes // 2, 8)))


def _known(lists: DataFrame, source) -> DataFrame:
    """Ids of each block's words, from the table of distinct words: a share of the table is held by one task at a time.

    Words are dealt to shares by their hash and the lists of a share come one after another, so each word of the corpus is encoded
    once, when its first list comes, and every later list finds it in the table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc, codec = _vocabulary(source.value), pa.Codec(_CODEC)
        table: dict[bytes, bytes] = {}
        now = None
        for b in batches:
            for share, block, n, places, lengths, body in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if share != now:
                    table, now = {}, share
                edges = np.concatenate([[0], np.cumsum(_unpacked(lengths, n), dtype=np.int64)]).tolist()
                whole = codec.decompress(body, decompressed_size=edges[-1], asbytes=True)
                words = [whole[x:y] for x, y in zip(edges[:-1], edges[1:], strict=True)]
                new = [w for w in words if w not in table]
                for w, ids in zip(new, voc.ids([w.decode() for w in new]), strict=True):
                    table[w] = np.array(ids, "<u4").tobytes()
                found = [table[w] for w in words]
                flat = np.frombuffer(b"".join(found), "<u4")
                yield pa.RecordBatch.from_arrays([
                    pa.array([block], pa.int64()), pa.array([n], pa.int32()), pa.array([places], pa.binary()),
                    pa.array([_packed(np.array([len(x) // 4 for x in found]))], pa.binary()), pa.array([_packed(flat)], pa.binary()),
                ], names=["__b", "__n", "__places", "__counts", "__ids"])

    dealt = lists.select("__share", "__block", "__n", "__places", "__lengths", "__words").repartition("__share").sortWithinPartitions("__share")
    return dealt.mapInArrow(run, "__b long, __n int, __places binary, __counts binary, __ids binary")


def encode(
    docs: DataFrame, source: str, doc_id: str = "doc_id", text: str = "text", keep: Sequence[str] = (), block_bytes: int = BLOCK_BYTES, share_bytes: int = SHARE_BYTES
) -> DataFrame:
    """doc_id, the columns ``keep`` and ids (array of int) of every row, as the tokenizer whose file has the text ``source`` gives them.

    No tokens are added, nothing is cut or padded; the string of a special token in a text is that token, as in the
    library. A null or empty text has no ids. Rows stay rows: ids that repeat or are null, equal texts and extra columns of any name do
    no harm. A text of any length is read whole, by one task. An empty table gives an empty table.
    """
    spark, names = docs.sparkSession, [doc_id, *keep]
    shared = spark.sparkContext.broadcast(source)
    size = text_bytes(docs, text)
    cut = _blocks(docs, shared, text, names, block_bytes, size, parts(size, share_bytes))
    known = _known(cut.where("__share is not null"), shared)
    bodies = cut.where("__share is null").drop("__share", "__lengths", "__words")
    schema = T.StructType([*[T.StructField(f"__k{i}", docs.schema[n].dataType) for i, n in enumerate(names)], T.StructField("__ids", T.ArrayType(T.IntegerType()))])
    width = len(names)

    def put_together(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.combine_chunks()
        lists = [(_unpacked(p, n), _unpacked(c, n), i) for n, p, c, i in zip(*[right.column(c).to_pylist() for c in ("__n", "__places", "__counts", "__ids")], strict=True)]
        size = sum(len(p) for p, _, _ in lists)
        starts, lengths, flats, base = np.zeros(size, np.int64), np.zeros(size, np.int64), [np.zeros(0, np.int32)], 0
        for place, count, ids in lists:
            total = int(count.sum())
            lengths[place] = count
            starts[place] = base + np.cumsum(count, dtype=np.int64) - count
            flats.append(_unpacked(ids, total).astype(np.int32))
            base += total
        flat, made, sizes = np.concatenate(flats), [], []
        for body, n in zip(left.column("__places"), left.column("__n").to_pylist(), strict=True):
            at = _unpacked(body.as_py(), n)
            many = lengths[at]
            total = int(many.sum())
            first = np.repeat(starts[at] - (np.cumsum(many) - many), many)
            made.append(flat[first + np.arange(total)])
            sizes.append(total)
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([flat[:0], *made]), pa.int32()))
        return pa.table([*left.columns[:width], ids], names=[*left.column_names[:width], "__ids"])

    made = bodies.groupBy("__block").cogroup(known.groupBy("__b")).applyInArrow(put_together, schema)
    return made.select(*[F.col(f"__k{i}").alias(n) for i, n in enumerate(names)], F.col("__ids").alias("ids"))


def pieces(spark: SparkSession, source: str) -> DataFrame:
    """id and piece (bytes) of every token of a tokenizer: a table of the vocabulary's size."""
    return spark.createDataFrame(list(enumerate(_pieces(source))), "id int, piece binary")


def decode(rows: DataFrame, source: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``rows`` with the text of their ids in the column ``into``.

    Every id meets its piece in a broadcast of the vocabulary (its size is fixed by the tokenizer, not by the data), batch by batch,
    without a shuffle; the bytes of a row's pieces stand together as the look-up leaves them. Bytes that are no UTF-8 give U+FFFD, as in the
    library; ids outside the vocabulary give nothing; null or no ids give an empty text. A column of the name ``into`` is replaced.
    """
    shared = rows.sparkSession.sparkContext.broadcast(source)
    kept = [c for c in rows.columns if c != into]
    at = kept.index(ids)
    schema = T.StructType([*[rows.schema[c] for c in kept], T.StructField(into, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.array([*_pieces(shared.value), b""], pa.large_binary())
        none = len(table) - 1

        def texts(b: pa.RecordBatch) -> pa.RecordBatch:
            lists = b.column(at)
            lists = lists.fill_null([]) if lists.null_count else lists
            edge = lists.offsets.to_numpy().astype(np.int64)
            wanted = lists.values.fill_null(none).to_numpy()[edge[0]:edge[-1]]
            found = table.take(pa.array(np.where((wanted >= 0) & (wanted < none), wanted, np.int32(none))))
            buffers = found.buffers()
            offsets = np.frombuffer(buffers[1], np.int64)[found.offset:found.offset + len(found) + 1] if len(found) else np.zeros(1, np.int64)
            data, cuts = memoryview(buffers[2] or b""), offsets[edge - edge[0]]
            made = [bytes(data[x:y]).decode("utf-8", "replace") for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
            return pa.RecordBatch.from_arrays([*b.columns, pa.array(made, pa.string())], names=[*b.schema.names, into])

        for b in batches:
            ends, begun = b.column(at).offsets.to_numpy(), 0
            while begun < b.num_rows:  # rows of about DECODED ids at once, a row at least
                end = max(begun + 1, int(np.searchsorted(ends, ends[begun] + DECODED, "right")) - 1)
                yield texts(b.slice(begun, end - begun))
                begun = end

    return rows.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(run, schema)
