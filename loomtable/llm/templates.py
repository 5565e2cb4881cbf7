"""Line deduplication by a log-template tree of fixed depth.

A line's words, those with a digit masked, lead it down the tree: first the number of words, then the first ``LEAD``
words. What reaches a leaf shares length and beginning. A leaf holds any number of templates of two kinds:

* constant: a masked line that recurs as it is in ``min_docs`` documents;
* with variable fields: of a leaf's other lines, a word counts at its place by the lines that have it there. A template
  keeps of a line the words beyond the lead that reach a level of counts (``min_docs`` times a power of two) and has
  fields in all other places. A line has a template for each level that its own words reach, from the one with most
  constant words to the most general, as far as the share ``alike`` of the places beyond the lead is constant. Words of a
  template are in all its lines, values of a field in few, so counts tell them apart, whatever else is in the leaf.

Lines of a template that is found in ``min_docs`` documents are dropped, but for the document with the smallest id among
them. The tree is built from counts (line, leaf and word), so no leaf is ever gathered in one task, however many lines
share it. Lines, leaves and templates are told apart by 128 bits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtable.llm.common import among, beside, bitmap, let, numbered, written

LEAD, MIN_DOCS, ALIKE = 3, 5, 0.6
#: Levels of counts, each twice the one before it: beyond 10^12 lines.
LEVELS = 40
MASK = "<*>"
#: A word with a digit; each is only tried at its beginning, so the work is linear.
NUMBERED = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+"
#: Space inside a line other than one blank.
ODD_SPACE = r"\x20?[\x09\x0B-\x0D][\x20\x09\x0B-\x0D]*+|\x20[\x20\x09\x0B-\x0D]++"


def _digest(x: Column) -> Column:
    return F.unhex(F.md5(x))


def _times(x: Column, char: str) -> Column:
    """How often a character of one byte stands in a text."""
    return F.octet_length(x) - F.octet_length(F.replace(x, F.lit(char), F.lit("")))


def _lines(docs: DataFrame) -> DataFrame:
    """d, h, pos, size (words), s (masked words, a space between) of each line that has a word; ``docs`` has d, h, t."""
    clean = F.when(F.col("t").rlike(ODD_SPACE), F.regexp_replace("t", ODD_SPACE, " ")).otherwise(F.col("t"))
    masked = lambda x: F.trim(F.when(x.rlike("[0-9]"), F.regexp_replace(x, NUMBERED, MASK)).otherwise(x))
    at = F.transform(F.split(clean, "\n"), lambda x, i: F.struct(i.alias("pos"), masked(x).alias("s")))
    rows = docs.where("t is not null").select("d", "h", F.explode(F.filter(at, lambda x: x["s"] != "")).alias("x"))
    return rows.select("d", "h", "x.pos", (_times(F.col("x.s"), " ") + 1).alias("size"), "x.s")


def drop_templates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: Sequence[str] = (), min_docs: int = MIN_DOCS, alike: float = ALIKE
) -> DataFrame:
    """doc_id, text without the dropped lines, n_lines, n_dropped of every row, then the columns of ``keep``.

    Lines are split at \\n; lines without a word always stay. A null text stays null and has no lines, an empty text one;
    a text of any length is taken whole. Ids of any kind that has an order will do; a null id counts as larger than all
    others but 2^63 - 1, with which it ties. Rows that share an id are one document; each gets its own row, and its lines
    count at their places beside those of the others. An empty table gives no rows. Columns outside ``keep`` are ignored, whatever
    their names; names in ``keep`` must differ from n_lines and n_dropped.
    """
    kept = [c for c in keep if c not in (doc_id, text)]
    rows, number = numbered(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), *[F.col(f"`{c}`") for c in kept]), "doc_id")
    rows = rows.select("doc_id", "text", number.alias("__d"), F.xxhash64("text").alias("__h"), *[F.col(f"`{c}`") for c in kept])
    leaf = _digest(F.concat(F.col("size").cast("string"), F.lit(" "), F.substring_index("s", " ", LEAD)))
    seen = _lines(rows.select(F.col("__d").alias("d"), F.col("__h").alias("h"), F.col("text").alias("t")))
    seen = written(seen.select("d", "h", "pos", "size", leaf.alias("leaf"), _digest(F.col("s")).alias("line"), "s"))
    where = seen.select(F.xxhash64("line").alias("x"), "d", "h", "pos", "line")

    by_doc = seen.groupBy("leaf", "line", "d").agg(F.count("*").alias("n"), F.max("size").alias("size"))
    lines = written(by_doc.groupBy("leaf", "line").agg(F.count("*").alias("docs"), F.min("d").alias("first"), F.sum("n").alias("n"), F.max("size").alias("size")))
    # Constant templates.
    constant = lines.where(F.col("docs") >= min_docs).select("line", "first", "n")
    fixed = beside(where.select("d", "h", "pos", "line"), constant, ["line"]).where("d > first").select("d", "h", "pos")

    # Other lines, each different one once with its number n, in leaves where they come from enough documents: no other leaf can hold a template.
    other = lines.where((F.col("docs") < min_docs) & (F.col("size") > LEAD))
    busy = written(other.groupBy("leaf").agg(F.sum("docs").alias("docs"), F.count("*").alias("n")).where(F.col("docs") >= min_docs).drop("docs"))
    rest = written(beside(other.select("leaf", "line", "size", F.col("n").alias("times")), busy, ["leaf"]))
    bits = bitmap(rest.select(F.xxhash64("line").alias("x")), "x")
    text_of = among(seen.select(F.xxhash64("line").alias("x"), "line", "s"), bits, "x").groupBy("line").agg(F.first("s").alias("s"))
    places = rest.join(text_of, "line").select("leaf", "line", "size", "times", F.posexplode(F.split("s", " ")).alias("p", "t")).where(F.col("p") >= LEAD)
    places = written(places)
    level = sum((F.col("count") >= min_docs * 2**k).cast("int") for k in range(LEVELS))
    counts = places.groupBy("leaf", "p", "t").agg(F.sum("times").alias("count"), F.count("*").alias("n")).where(F.col("count") >= min_docs)
    often = beside(places, written(counts.select("leaf", "p", "t", level.alias("level"), "n")), ["leaf", "p", "t"])
    words = often.groupBy("leaf", "line", "size").agg(F.sort_array(F.collect_list(F.struct("p", "t", "level"))).alias("w"))  # of one line
    levels = words.select("*", F.explode(F.array_distinct(F.transform("w", lambda x: x["level"]))).alias("least"))
    of_level = F.filter("w", lambda x: x["level"] >= F.col("least"))
    made = levels.where(F.size(of_level) >= F.lit(alike) * (F.col("size") - LEAD))
    parts = F.transform(of_level, lambda x: F.concat(x["p"].cast("string"), F.lit(" "), x["t"]))
    made = written(made.select("line", _digest(F.concat_ws("\n", F.hex("leaf"), F.array_join(parts, "\n"))).alias("template")))
    bits = bitmap(made.select(F.xxhash64("line").alias("x")), "x")
    follow = written(among(where, bits, "x").drop("x").join(made, "line").select("d", "h", "pos", "template"))
    found = follow.groupBy("template", "d").agg(F.count("*").alias("n")).groupBy("template")
    found = written(found.agg(F.count("*").alias("docs"), F.min("d").alias("first"), F.sum("n").alias("n")).where(F.col("docs") >= min_docs).drop("docs"))
    fields = beside(follow, found, ["template"]).where("d > first").select("d", "h", "pos")

    gone = fixed.unionByName(fields).groupBy("d", "h").agg(F.collect_set("pos").alias("gone"))  # lines of one text
    joined = rows.join(gone, (F.col("__d") == F.col("d")) & (F.col("__h") == F.col("h")), "left")
    left = let(
        F.map_from_arrays(F.col("gone"), F.col("gone")),
        lambda g: F.array_join(F.filter(F.split("text", "\n"), lambda x, i: F.element_at(g, i).isNull()), "\n"),
    )
    return joined.select(
        "doc_id",
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(left).alias("text"),
        F.coalesce(_times(F.col("text"), "\n") + 1, F.lit(0)).cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_dropped"),
        *[F.col(f"`{c}`") for c in kept],
    )


SQL = r"""
WITH l AS (
  SELECT doc_id, pos, x, list_transform(regexp_extract_all(x, '[^\x20\x09-\x0D]+'), lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END) AS w
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents WHERE text IS NOT NULL)),
m AS (SELECT doc_id, pos, w, len(w) AS n, w[1:3] AS lead FROM l WHERE len(w) > 0),
c AS (SELECT w, min(doc_id) AS first FROM m GROUP BY w HAVING count(DISTINCT doc_id) >= 5),
r AS (SELECT * FROM m WHERE n > 3 AND w NOT IN (SELECT w FROM c)),
b AS (SELECT n, lead FROM r GROUP BY n, lead HAVING count(DISTINCT doc_id) >= 5),
e AS (SELECT doc_id, pos, n, lead, unnest(w) AS t, generate_subscripts(w, 1) AS p FROM r SEMI JOIN b USING (n, lead)),
f AS (
  SELECT n, lead, p, t, list_sum(list_transform(range(40), lambda k: CASE WHEN count(*) >= 5 * CAST(pow(2, k) AS BIGINT) THEN 1 ELSE 0 END)) AS level
  FROM e WHERE p > 3 GROUP BY n, lead, p, t HAVING count(*) >= 5),
o AS (SELECT e.doc_id, e.pos, e.n, e.lead, e.p, e.t, f.level FROM e JOIN f ON e.n = f.n AND e.lead = f.lead AND e.p = f.p AND e.t = f.t),
a AS (SELECT DISTINCT doc_id, pos, level AS least FROM o),
s AS (
  SELECT o.doc_id, o.pos, o.n, o.lead, a.least, list((o.p, o.t) ORDER BY o.p) AS template
  FROM o JOIN a ON o.doc_id = a.doc_id AND o.pos = a.pos AND o.level >= a.least
  GROUP BY o.doc_id, o.pos, o.n, o.lead, a.least HAVING count(*) >= CAST(0.6 AS DOUBLE) * (o.n - 3)),
v AS (SELECT n, lead, template, min(doc_id) AS first FROM s GROUP BY n, lead, template HAVING count(DISTINCT doc_id) >= 5),
g AS (
  SELECT m.doc_id, m.pos FROM m JOIN c ON m.w = c.w WHERE m.doc_id > c.first
  UNION
  SELECT s.doc_id, s.pos FROM s JOIN v ON s.n = v.n AND s.lead = v.lead AND s.template = v.template WHERE s.doc_id > v.first),
k AS (
  SELECT l.doc_id, count(g.pos) AS n_dropped, count(*) AS n_lines, coalesce(string_agg(l.x, chr(10) ORDER BY l.pos) FILTER (WHERE g.pos IS NULL), '') AS kept
  FROM l LEFT JOIN g ON l.doc_id = g.doc_id AND l.pos = g.pos GROUP BY l.doc_id)
SELECT d.doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_dropped, 0) AS BIGINT) AS n_dropped, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN k ON d.doc_id = k.doc_id
"""
