"""Attribute extraction from HTML pages by CSS selectors, on a small tree over the standard parser.

Unclosed elements hold all that follows up to the end of their parent; an end tag closes the nearest open element of its
name. Selectors: names, *, .class, #id, [attr], [attr=value], :nth-child(n), :first-child, and the combinators space, >, +
and ~, in comma lists. ``css@attr`` takes an attribute instead of the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache, reduce
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from loomtable.operators.split import in_order
from loomtable.plans.config import Settings
from loomtable.sources.shared import written

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_HIDDEN = frozenset(("script", "style", "template"))
_WITH_ATTR = re.compile(r"(.+?)@(\w+)", re.S)
_PART = re.compile(r"(?P<name>\*|[\w-]+)|\.(?P<cls>[\w-]+)|#(?P<id>[\w-]+)|\[(?P<attr>[\w-]+)(?:=[\"']?(?P<val>[^\]\"']*)[\"']?)?\]|:nth-child\((?P<nth>\d+)\)|(?P<first>:first-child)")


class Node:
    __slots__ = ("name", "attrs", "parent", "kids", "place", "before", "last")

    def __init__(self, name: str, attrs: dict[str, str], parent: Node | None):
        self.name, self.attrs, self.parent = name, attrs, parent
        self.kids: list[Node | str] = []
        self.place = 0  # among its parent's elements, from 1
        self.before: Node | None = None  # the element before it there
        self.last: Node | None = None  # its own last element so far

    def elements(self) -> Iterator[Node]:
        """All below, in the order of the page."""
        rest = [iter(self.kids)]
        while rest:
            for kid in rest[-1]:
                if isinstance(kid, Node):
                    yield kid
                    rest.append(iter(kid.kids))
                    break
            else:
                rest.pop()

    def text(self) -> str:
        """Stripped pieces of text, one after the other."""
        out, rest = [], [iter(self.kids)]
        while rest:
            for kid in rest[-1]:
                if isinstance(kid, str):
                    out.append(kid.strip())
                elif kid.name not in _HIDDEN:
                    rest.append(iter(kid.kids))
                    break
            else:
                rest.pop()
        return "".join(out)


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        node = Node(tag, {k: v or "" for k, v in reversed(attrs)}, self.at)
        node.before, self.at.last = self.at.last, node
        node.place = 1 + (node.before.place if node.before else 0)
        self.at.kids.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.at = self.at.parent or self.root

    def handle_endtag(self, tag: str) -> None:
        node: Node | None = self.at
        while node is not None and node.name != tag:
            node = node.parent
        if node is not None and node.parent is not None:
            self.at = node.parent

    def handle_data(self, data: str) -> None:
        self.at.kids.append(data)


def parse(html: str | None) -> Node:
    tree = _Tree()
    tree.feed(html or "")
    tree.close()
    return tree.root


def split_selector(raw: str) -> tuple[str, str | None]:
    """(css, attribute or None); only a plain word after the last @ is an attribute."""
    m = _WITH_ATTR.fullmatch(raw.strip())
    return (m[1].strip(), m[2]) if m else (raw.strip(), None)


def selector_parts(raw: Column) -> Column:
    """The same as a struct column (css, attr)."""
    has = raw.rlike(r"^.+?@\w+$")
    return F.struct(
        F.when(has, F.trim(F.regexp_extract(raw, r"^(.+?)@(\w+)$", 1))).otherwise(F.trim(raw)).alias("css"),
        F.when(has, F.regexp_extract(raw, r"^(.+?)@(\w+)$", 2)).alias("attr"),
    )


@lru_cache(256)
def _compiled(css: str) -> list[list[tuple[str, list[tuple[str, str, str | None]]]]]:
    chains = []
    for one in css.split(","):
        chain: list[tuple[str, list]] = []
        how = " "
        for token in re.findall(r"[>+~]|[^\s>+~]+", one):
            if token in ">+~":
                how = token
                continue
            tests, end = [], 0
            for m in _PART.finditer(token):
                if m.start() != end:
                    break
                end = m.end()
                kind = m.lastgroup if m.lastgroup != "val" else "attr"
                tests.append((kind, m[kind], m["val"]))
            if end != len(token) or not tests:
                raise ValueError(f"selector not understood: {css!r}")
            chain.append((how, tests))
            how = " "
        if not chain:
            raise ValueError(f"empty selector: {css!r}")
        chains.append(chain)
    return chains


def _fits(node: Node, tests: list[tuple[str, str, str | None]]) -> bool:
    for kind, want, value in tests:
        if kind == "name":
            ok = want == "*" or node.name == want.lower()
        elif kind == "cls":
            ok = want in node.attrs.get("class", "").split()
        elif kind == "id":
            ok = node.attrs.get("id") == want
        elif kind == "attr":
            ok = want in node.attrs and (value is None or node.attrs[want] == value)
        elif kind == "nth":
            ok = node.place == int(want)
        else:
            ok = node.place == 1
        if not ok:
            return False
    return True


def _matches(node: Node, chain: list, at: int) -> bool:
    how, tests = chain[at]
    if not _fits(node, tests):
        return False
    if at == 0:
        return True
    if how in "+~":
        others, back = [], node.before
        while back is not None:
            others.append(back)
            back = back.before if how == "~" else None
    else:
        others, up = [], node.parent
        while up is not None and up.name:
            others.append(up)
            up = up.parent
        others = others[:1] if how == ">" else others
    return any(_matches(x, chain, at - 1) for x in others)


def select(root: Node, css: str) -> list[Node]:
    """Elements that fit, in the order of the page."""
    chains = _compiled(css)
    return [n for n in root.elements() if any(_matches(n, c, len(c) - 1) for c in chains)]


def value(node: Node, attr: str | None) -> str | None:
    """Text, or an attribute; one of several values (class) is joined by spaces."""
    return node.text() if attr is None else node.attrs.get(attr)


def first(root: Node, selector: str) -> str | None:
    """Value of the first match."""
    css, attr = split_selector(selector)
    found = select(root, css)
    return value(found[0], attr) if found else None


def every(root: Node, selector: str) -> list[str]:
    """Values of all matches that have one."""
    css, attr = split_selector(selector)
    return [v for n in select(root, css) if (v := value(n, attr))]


def detail(html: str | None, url: str, selectors: dict[str, str]) -> tuple[str, list[str], dict[str, str]]:
    """title, image_urls, attributes of a detail page (P08). ``images`` names all images and is no attribute."""
    root = parse(html)
    found = {k: v for k, s in selectors.items() if k != "images" and (v := first(root, s))}
    title, image = found.pop("title", ""), found.pop("image", None)
    if "images" in selectors:
        return title, [urljoin(url, u) for u in every(root, selectors["images"])], found
    return title, [urljoin(url, image)] if image else [], found


def index(html: str | None, url: str, listing: str, pagination: Settings) -> tuple[list[str], str | None]:
    """listing_urls and next_page_url of an index page."""
    root = parse(html)
    links = [urljoin(url, u) for u in every(root, listing)]
    onward = first(root, pagination.selector) if pagination.type == "next_link" and pagination.selector else None
    return links, urljoin(url, onward) if onward else None


def details(pages: DataFrame, selectors: dict[str, str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Listings of pages (url, html): one parse a page, rows of ``keep`` carried along."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [detail(h, u or "", selectors) for u, h in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
            yield pa.record_batch(
                [
                    b.column(0), pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.list_(pa.string())),
                    pa.array([list(r[2].items()) for r in rows], pa.map_(pa.string(), pa.string())), *b.columns[2:],
                ],
                names=["url", "title", "image_urls", "attributes", *keep],
            )

    kinds = "".join(f", `{c}` {pages.schema[c].dataType.simpleString()}" for c in keep)
    return pages.select("url", "html", *keep).mapInArrow(run, "url string, title string, image_urls array<string>, attributes map<string,string>" + kinds)


def indexes(pages: DataFrame, site: Settings, keep: tuple[str, ...] = ()) -> DataFrame:
    """url, listing_urls, next_page_url of index pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [index(h, u or "", site.listing_selector, site.pagination) for u, h in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
            yield pa.record_batch(
                [b.column(0), pa.array([r[0] for r in rows], pa.list_(pa.string())), pa.array([r[1] for r in rows], pa.string()), *b.columns[2:]],
                names=["url", "listing_urls", "next_page_url", *keep],
            )

    kinds = "".join(f", `{c}` {pages.schema[c].dataType.simpleString()}" for c in keep)
    return pages.select("url", "html", *keep).mapInArrow(run, "url string, listing_urls array<string>, next_page_url string" + kinds)


def next_page(pagination: Settings, found: str | None, scraped: int) -> str | None:
    """Address of the page after ``scraped`` ones."""
    if pagination.type == "next_link":
        return found
    if pagination.type == "page_number":
        return pagination.url_pattern.format(page=scraped + 1) if pagination.url_pattern else None
    raise NotImplementedError("infinite scroll needs a browser: see ``scrolled``")


def numbered_pages(spark, pagination: Settings, base_url: str) -> DataFrame:
    """page, url of all pages that a pattern names; the first is ``base_url``."""
    ids = spark.range(1, pagination.max_pages + 1).select(F.col("id").alias("page"))
    made = F.replace(F.lit(pagination.url_pattern or ""), F.lit("{page}"), F.col("page").cast("string"))
    return ids.select("page", F.when(F.col("page") == 1, F.lit(base_url)).otherwise(made).alias("url"))


def fetched(wanted: DataFrame, pages: DataFrame) -> DataFrame:
    """``wanted`` addresses with html of their stored pages (url, html); one that is missing raises when it is read.

    Only pages that are wanted are joined, by sorting: a store of pages may be small in its files and is not held in a task.
    """
    some = pages.select("url", "html").join(wanted.select("url"), "url", "left_semi").withColumn("there", F.lit(True))
    have = wanted.join(some.hint("merge"), "url", "left")
    gone = F.raise_error(F.concat(F.lit("page not found: "), F.col("url"))).cast("string")
    return have.withColumn("html", F.when(F.col("there").isNull(), gone).otherwise(F.col("html"))).drop("there")


def crawl(pages: DataFrame, site: Settings) -> DataFrame:
    """Listings of a site over stored pages (url, html): S15 with L01 and L02.

    Each index page is parsed once for its onward link. The walk over these links doubles its length with each join
    (pages 1 to n, then n + 1 to 2n by links that go n pages on), so ``max_pages`` pages take a few joins of addresses and
    no job each; details are taken in parallel (J08). A page that is missing raises, as a failed fetch does. A link that several
    index pages have is fetched for each. A walk that comes back to a page ends there.
    """
    spark, most = pages.sparkSession, site.pagination.max_pages
    if site.pagination.type == "page_number":
        front = numbered_pages(spark, site.pagination, site.base_url)
    else:
        jump = written(indexes(pages, site).select("url", F.col("next_page_url").alias("to")).where("to is not null"))
        front, steps = spark.createDataFrame([(1, site.base_url)], "page long, url string"), 1
        while steps < most and site.pagination.type == "next_link":
            front = front.unionByName(front.join(jump, "url").select((F.col("page") + steps).alias("page"), F.col("to").alias("url")))
            front, steps = written(front), 2 * steps
            if steps < most:
                jump = written(jump.join(jump.select(F.col("url").alias("to"), F.col("to").alias("on")), "to").select("url", F.col("on").alias("to")))
        front = front.where(F.col("page") <= most).groupBy("url").agg(F.min("page").alias("page"))  # a walk in a circle ends where it began
    found = indexes(fetched(written(front.select("page", "url")), pages), site, keep=("page",)).select("page", F.posexplode("listing_urls").alias("pos", "url"))
    if site.max_listings:
        found = found.orderBy("page", "pos").limit(site.max_listings)
    have = fetched(written(found), pages)
    got = details(have, site.detail_selectors, keep=("page", "pos"))
    return got.orderBy("page", "pos").select("url", "title", "image_urls", "attributes")


def unseen(links: DataFrame, seen: DataFrame, url: str = "url") -> DataFrame:
    """New addresses (J09), each once."""
    return links.select(url).distinct().join(seen.select(url), url, "left_anti")


def scrolled(snapshots: DataFrame, site: Settings) -> DataFrame:
    """Addresses by the order in which scrolling shows them (S16): snapshots (scroll, url, html) of one page, each address
    at its first scroll and place; the first scroll that shows none that is new ends it (X03), as ``max_pages`` does (L03).

    A snapshot that is too long for a row comes in pieces, say its list's elements, with their place in ``part`` (from 0): each piece has what the
    selectors look for around an address. What later scrolls repeat of earlier ones is parsed once, where it is first shown.
    """
    one = snapshots.where(F.col("scroll") <= site.pagination.max_pages)
    part = F.col("part").cast("long") if "part" in snapshots.columns else F.lit(0)
    far = F.raise_error(F.lit("scrolls go to 2^22 and their parts to 2^40")).cast("long")
    at = F.when(F.col("scroll").between(0, 1 << 22) & (part >= 0) & (part < 1 << 40), F.col("scroll").cast("long") * (1 << 40) + part).otherwise(far)  # a number, which is summed up by hash
    shown = one.groupBy("url", "html").agg(F.min(at).alias("at"))
    rows = indexes(shown, site, keep=("at",)).select("at", F.posexplode("listing_urls").alias("pos", "link"))
    first_seen = written(rows.where("link is not null").groupBy("link").agg(F.min(F.struct("at", "pos")).alias("at")).withColumn("scroll", F.shiftright("at.at", 40)))
    fresh = one.select(F.col("scroll").cast("long").alias("scroll")).distinct().join(first_seen.groupBy("scroll").count(), "scroll", "left")
    stop = fresh.where("count is null and scroll > 1").agg(F.coalesce(F.min("scroll"), F.lit(1 << 31)).alias("stop"))  # one row
    got = first_seen.crossJoin(F.broadcast(stop)).where("scroll < stop").select("link", "at")
    if site.max_listings:
        got = got.orderBy("at").limit(site.max_listings)
    return in_order(got, "at").select("link", (F.col("place") + 1).alias("seq"))


def reached(links: DataFrame, seeds: DataFrame, max_depth: int, per_host: int | None = None) -> DataFrame:
    """url, host, depth of what a crawl of many sites reaches (S12, S15, L01): links (url, to) between pages, seeds (url).

    A round a level: the addresses of the frontier meet the links of their pages, and those that no earlier round has seen are the next
    frontier. Addresses are dealt by host, so that a site's pages are a task's and its pace can be kept there; only a
    frontier is written in a round, and depth is at most ``max_depth``. Of a host's addresses that are new in a round, ``per_host`` are
    taken, the first by address, and the others wait for the next rounds. An address reached in several ways has its least depth, seeds have 0; a link
    to another host is followed like any other; a null address is none.
    """
    host = F.coalesce(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")).alias("host")
    links = written(links.select("url", "to").where("url is not null and to is not null"))  # each round reads them; they may be costly to make
    waiting = written(seeds.select("url").where("url is not null").distinct().select("url", host, F.lit(0).alias("depth")))
    seen, found = None, []
    while not waiting.isEmpty():
        if per_host:
            place = F.row_number().over(W.partitionBy("host").orderBy("depth", "url"))
            placed = written(waiting.withColumn("__n", place))
            front, late = placed.where(F.col("__n") <= per_host).drop("__n"), placed.where(F.col("__n") > per_host).drop("__n")
        else:
            front, late = waiting, None
        found.append(front)
        seen = reduce(DataFrame.unionByName, found)
        ahead = front.where(F.col("depth") < max_depth).select("url", "depth").join(links, "url").groupBy(F.col("to").alias("url")).agg((F.min("depth") + 1).cast("int").alias("depth"))
        known = seen.select("url") if late is None else seen.select("url").unionByName(late.select("url"))
        fresh = ahead.join(known, "url", "left_anti").select("url", host, "depth")
        waiting = written((fresh if late is None else fresh.unionByName(late)).repartition("host"))
    return seen if seen is not None else waiting
