"""Merkle manifest of a table: a tree of 16 children for each source, a tree over the sources, and each row's authentication path.

Rows are reduced to a digest each, range-sorted by source and id and numbered without a rank in one task. Aligned blocks of
16^``BLOCK_LEVELS`` leaves are then independent: their roots are the leaves of the next, smaller round of blocks, until a source is
one block. On the way back each block is walked once by fractal traversal, which gives the paths of its leaves in order, and
what lies above the block (made by the rounds before) is appended.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomtable.llm.common import CRC_TABLE, beside, crc_mod, crc_sql, placed, text_key, written

FANOUT = 16
#: Levels that one task climbs at once: blocks of 16^3 leaves.
BLOCK_LEVELS = 3
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PROOF = T.ArrayType(T.StructType([T.StructField("before", T.StringType()), T.StructField("after", T.StringType())]))


def leaf(values: Sequence[Column]) -> Column:
    """The digest of a row: each value's UTF-8 length, a colon and the value; a dash for null."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def fold(start: Column, proof: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(proof, start, lambda node, p: F.sha2(F.concat(p["before"], node, p["after"]), 256))


def _node(run: list[bytes]) -> bytes:
    return hashlib.sha256(b"".join(run)).hexdigest().encode()


class Growing:
    """Nodes of one level, grown leaf by leaf: at most 16 digests wait on each level below it."""

    def __init__(self, level: int) -> None:
        self.waiting: list[list[bytes]] = [[] for _ in range(level)]
        self.nodes: list[bytes] = []

    def add(self, node: bytes) -> None:
        for run in self.waiting:
            run.append(node)
            if len(run) < FANOUT:
                return
            node = _node(run)
            run.clear()
        self.nodes.append(node)

    def closed(self) -> list[bytes]:
        """The nodes, after the last leaf: runs that are not full become nodes too."""
        node = None
        for run in self.waiting:
            if node is not None:
                run.append(node)
            node = _node(run) if run else None
            run.clear()
        if node is not None:
            self.nodes.append(node)
        return self.nodes


def block_root(leaves: Sequence[bytes], levels: int) -> bytes:
    grown = Growing(levels)
    for x in leaves:
        grown.add(x)
    return grown.closed()[0]


def fractal(leaves: Sequence[bytes], levels: int) -> Iterator[list[tuple[bytes, bytes]]]:
    """The path inside a block of each leaf in order: for each level the siblings before and after the leaf's node.

    Fractal traversal: each level keeps the existing subtree, which is the run of siblings that the present path
    goes through, and the desired one, the next run. A step feeds each desired subtree one leaf, so it is complete when
    the walk enters it. Beside the leaves, 3 * 16 * levels^2 digests are held at most, whatever the size of the block.
    """
    spans = [FANOUT ** (k + 1) for k in range(levels)]  # leaves below a run of each level
    existing, desired = [], []
    for k, span in enumerate(spans):
        first = Growing(k)
        for x in leaves[:span]:
            first.add(x)
        existing.append(first.closed())
        desired.append(Growing(k))
    for t in range(len(leaves)):
        path = []
        for k, span in enumerate(spans):
            at = t % span * FANOUT // span
            path.append((b"".join(existing[k][:at]), b"".join(existing[k][at + 1:])))
        yield path
        for k, span in enumerate(spans):
            if t + span < len(leaves):
                desired[k].add(leaves[t + span])
            if (t + 1) % span == 0:
                existing[k], desired[k] = desired[k].closed(), Growing(k)


def levels_of(size: int) -> int:
    """Levels between a tree's leaves and its root: none for a lone leaf."""
    found = 0
    while size > 1:
        size, found = -(-size // FANOUT), found + 1
    return found


def _climb(size: int, block_levels: int) -> int:
    """Levels inside a block of a tree of ``size`` leaves."""
    return min(levels_of(size), block_levels)


def _proved(nodes: DataFrame, upper: DataFrame, block_levels: int, keep: Sequence[str] = ()) -> DataFrame:
    """``nodes`` (g, i, size, d) with ``upper``'s columns of their block and the whole path: the block's part, then what is above it."""
    tops = [c for c in upper.columns if c not in ("g", "i", "proof")]
    schema = T.StructType([nodes.schema[c] for c in ("g", "i", *keep, "d")] + [upper.schema[c] for c in tops] + [T.StructField("proof", PROOF)])
    span = FANOUT ** block_levels

    def walk(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("i").combine_chunks()
        n = left.num_rows
        leaves = [x.encode() for x in left.column("d").to_pylist()]
        above = [(p["before"].encode(), p["after"].encode()) for p in right.column("proof")[0].as_py()]
        before, after, ends = [], [], [0]
        for path in fractal(leaves, _climb(left.column("size")[0].as_py(), block_levels)):
            for b, a in [*path, *above]:
                before.append(b)
                after.append(a)
            ends.append(len(before))
        texts = [pa.array(x, pa.binary()).cast(pa.string()) for x in (before, after)]
        proofs = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(texts, ["before", "after"]))
        shared = [pa.array([right.column(c)[0].as_py()] * n, right.schema.field(c).type) for c in tops]
        return pa.table([*[left.column(c) for c in ("g", "i", *keep, "d")], *shared, proofs], names=["g", "i", *keep, "d", *tops, "proof"])

    held = nodes.withColumn("__b", F.floor(F.col("i") / span))
    return held.groupBy("g", "__b").cogroup(upper.select(F.col("g").alias("__g"), "i", "proof", *tops).groupBy("__g", "i")).applyInArrow(walk, schema)


def _uppers(nodes: DataFrame, block_levels: int) -> DataFrame:
    """g, i, size, top, proof for each block i of ``nodes``: the root of g's tree and the path from the block's root to it. Written."""
    span = FANOUT ** block_levels

    def root(block: pa.Table) -> pa.Table:
        block = block.sort_by("i")
        size = block.column("size")[0].as_py()
        made = block_root([x.encode() for x in block.column("d").to_pylist()], _climb(size, block_levels))
        return pa.table({"g": block.column("g")[:1], "i": pa.array([block.column("i")[0].as_py() // span]), "size": pa.array([-(-size // span)]), "d": pa.array([made.decode()])})

    slim = nodes.select("g", "i", "size", "d").withColumn("__b", F.floor(F.col("i") / span))
    roots = written(slim.groupBy("g", "__b").applyInArrow(root, "g string, i long, size long, d string"))
    if (roots.agg(F.max("size")).first()[0] or 0) <= 1:
        return roots.select("g", "i", "size", F.col("d").alias("top"), F.array().cast(PROOF).alias("proof"))
    above = _uppers(roots, block_levels)
    return written(_proved(roots, above.select("g", "i", "top", "proof"), block_levels, keep=("size",)).drop("d"))


def manifest(docs: DataFrame, columns: Sequence[str] = COLUMNS, group: str = "source", doc_id: str = "doc_id", keep: Sequence[str] = (), block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """Each row's leaf, path and roots: doc_id, the columns ``keep``, group, place, leaf, subroot, root, proof.

    ``columns`` go into the leaf. Rows of a group stand in order of their ids, null first, rows that share an id in
    order of their leaves; ``place`` counts from 0. Runs of 16 nodes become their digest until one is left, the subroot; subroots in
    order of their groups (null first, then by UTF-8 bytes) become the root likewise. A proof holds for each level, lowest first, the
    siblings before and after the node as joined digests; ``fold`` leads from a leaf to the root with it. Nulls in any column have
    a leaf of their own kind, texts of any length are hashed whole where they stand, repeated rows are leaves of their own, an empty table
    gives an empty table, and extra columns of any name don't matter. ``keep`` is carried along; let it be small.
    """
    slim = docs.select(
        text_key(F.col(f"`{group}`")).alias("g"), F.col(f"`{doc_id}`").alias("__id"), F.col(f"`{group}`").alias("__group"),
        leaf([F.col(f"`{c}`") for c in columns]).alias("d"), *[F.col(f"`{c}`").alias(f"__k{i}") for i, c in enumerate(keep)],
    )
    carried = ["__id", "__group", *[f"__k{i}" for i in range(len(keep))]]
    nodes = placed(written(slim), "g", [F.asc_nulls_first("__id"), F.asc("d")])  # texts are hashed once, not again for the sample of the sort
    inside = _uppers(nodes, block_levels)
    tops = placed(inside.where("i = 0").select(F.lit("").alias("g"), F.col("g").alias("__name"), F.col("size").alias("n"), F.col("top").alias("d")), "g", [F.asc("__name")])
    over = written(_proved(tops, _uppers(tops, block_levels).select("g", "i", F.col("top").alias("root"), "proof"), block_levels, keep=("__name", "n")))
    over = over.select(F.col("__name").alias("g"), "n", "root", F.col("proof").alias("__rest"))
    upper = beside(inside, over, ["g"]).select("g", "i", F.col("top").alias("subroot"), "root", F.concat("proof", "__rest").alias("proof"))
    made = _proved(nodes, upper, block_levels, keep=carried)
    return made.select(
        F.col("__id").alias(doc_id), *[F.col(f"__k{i}").alias(c) for i, c in enumerate(keep)], F.col("__group").alias(group), F.col("i").alias("place"),
        F.col("d").alias("leaf"), "subroot", "root", "proof",
    )


def tampered(docs: DataFrame) -> DataFrame:
    """``docs`` with __claim, the leaf that a verifier sees: of the rows whose id's crc32 5 divides, texts have lost their capitals A-Z."""
    lowered = F.translate("text", UPPER, LOWER)
    text = F.when(F.coalesce(crc_mod(F.col("doc_id"), 5) == 0, F.lit(False)), lowered).otherwise(F.col("text"))
    return docs.withColumn("__claim", leaf([text if c == "text" else F.col(c) for c in COLUMNS]))


#: The same in SQL: trees level by level, paths from the runs, crc32 from its polynomial.
SQL = f"""
WITH RECURSIVE {CRC_TABLE}, docs AS (
  SELECT doc_id, coalesce('=' || source, '-') AS g, source, lang, n_chars, text,
    CASE WHEN {crc_sql('doc_id::VARCHAR')} % 5 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS seen
  FROM documents, crc_table
), head AS (
  SELECT doc_id, g, text, seen, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS h FROM docs
), hashed AS (
  SELECT doc_id, g, sha256(h || coalesce(strlen(text) || ':' || text, '-')) AS leaf, sha256(h || coalesce(strlen(seen) || ':' || seen, '-')) AS claim FROM head
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM hashed
), tree AS (
  SELECT g, 0 AS level, i, leaf AS d, n FROM leaves
  UNION ALL
  SELECT g, level + 1, i // 16, sha256(string_agg(d, '' ORDER BY i)), (n + 15) // 16 FROM tree WHERE n > 1 GROUP BY g, level, i // 16, n
), subroots AS (
  SELECT g, d AS subroot, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM tree WHERE n = 1
), top AS (
  SELECT 0 AS level, i, subroot AS d, n FROM subroots
  UNION ALL
  SELECT level + 1, i // 16, sha256(string_agg(d, '' ORDER BY i)), (n + 15) // 16 FROM top WHERE n > 1 GROUP BY level, i // 16, n
), runs AS (SELECT g, level, i // 16 AS run, list(d ORDER BY i) AS ds FROM tree WHERE n > 1 GROUP BY g, level, i // 16
), top_runs AS (SELECT level, i // 16 AS run, list(d ORDER BY i) AS ds FROM top WHERE n > 1 GROUP BY level, i // 16
), steps AS (
  SELECT l.g, l.i, r.level AS level, (l.i // (16 ** r.level)::BIGINT) % 16 AS spot, r.ds FROM leaves l JOIN runs r ON r.g = l.g AND r.run = l.i // (16 ** (r.level + 1))::BIGINT
  UNION ALL
  SELECT l.g, l.i, 1000 + r.level, (s.i // (16 ** r.level)::BIGINT) % 16, r.ds FROM leaves l JOIN subroots s USING (g) JOIN top_runs r ON r.run = s.i // (16 ** (r.level + 1))::BIGINT
), proofs AS (
  SELECT g, i, list({{'b': array_to_string(list_slice(ds, 1, spot), ''), 'a': array_to_string(list_slice(ds, spot + 2, 16), '')}} ORDER BY level) AS p FROM steps GROUP BY g, i
), done AS (
  SELECT l.doc_id, l.leaf, s.subroot, (SELECT d FROM top WHERE n = 1) AS root, coalesce(q.p, []) AS p,
    list_reduce(list_prepend({{'b': l.claim, 'a': ''}}, coalesce(q.p, [])), lambda x, y: {{'b': sha256(y.b || x.b || y.a), 'a': ''}}).b AS folded_root
  FROM leaves l JOIN subroots s USING (g) LEFT JOIN proofs q ON q.g = l.g AND q.i = l.i
)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(p, lambda x: x.b || x.a), '')) AS proof_sha256, folded_root, folded_root = root AS verified FROM done
"""
