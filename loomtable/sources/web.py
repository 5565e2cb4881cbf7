"""Page sources: Python data sources that fetch addresses on the executors, one for plain HTTP and one for a browser."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from urllib.request import Request, urlopen

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from loomtable.plans.config import Settings

TIMEOUT_S, WAIT_S = 30, 10


class _Urls(InputPartition):
    def __init__(self, urls: list[str]):
        self.urls = urls


class _Reader(DataSourceReader):
    """Options: urls (one a line), partitions, rate_limit (seconds between requests of a partition), header.<name>."""

    def __init__(self, options: dict):
        self.options = {k.lower(): v for k, v in options.items()}

    def partitions(self) -> list[InputPartition]:
        urls = [u for u in self.options.get("urls", "").split("\n") if u]
        n = max(1, min(int(self.options.get("partitions", 1)), len(urls) or 1))
        return [_Urls(urls[i::n]) for i in range(n)]

    def read(self, partition: _Urls) -> Iterator[tuple]:
        pause = float(self.options.get("rate_limit", 0))
        with self.opened() as fetch:
            for k, url in enumerate(partition.urls):
                if k and pause:
                    time.sleep(pause)  # X05
                yield (url, fetch(url))

    def opened(self):
        raise NotImplementedError


class _Plain:
    """GET with redirects and a timeout; any status but success raises."""

    def __init__(self, headers: dict[str, str]):
        self.headers = headers

    def __enter__(self):
        return self

    def __exit__(self, *_):
        return False

    def __call__(self, url: str) -> str:
        with urlopen(Request(url, headers=self.headers), timeout=TIMEOUT_S) as answer:  # noqa: S310  the site's own addresses
            return answer.read().decode(answer.headers.get_content_charset() or "utf-8", "replace")


class _Browser(_Plain):
    """Rendered pages (S13); the browser starts with the first page and waits for a selector where one is named."""

    def __init__(self, headers: dict[str, str], selector: str | None):
        super().__init__(headers)
        self.selector, self.page, self.stop = selector, None, []

    def __call__(self, url: str) -> str:
        if self.page is None:
            from playwright.sync_api import sync_playwright

            play = sync_playwright().start()
            browser = play.chromium.launch()
            self.stop = [browser.close, play.stop]
            self.page = browser.new_page(extra_http_headers=self.headers)
        self.page.goto(url, timeout=TIMEOUT_S * 1000)
        if self.selector:
            self.page.wait_for_selector(self.selector, timeout=WAIT_S * 1000)
        return self.page.content()

    def __exit__(self, *_):
        for f in self.stop:
            f()
        return False


class _HttpReader(_Reader):
    def opened(self):
        return _Plain({k[7:]: v for k, v in self.options.items() if k.startswith("header.")})


class _BrowserReader(_Reader):
    def opened(self):
        return _Browser({k[7:]: v for k, v in self.options.items() if k.startswith("header.")}, self.options.get("wait_for_selector"))


class HttpPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "http_pages"

    def schema(self) -> str:
        return "url string, html string"

    def reader(self, schema) -> DataSourceReader:
        return _HttpReader(dict(self.options))


class BrowserPages(HttpPages):
    @classmethod
    def name(cls) -> str:
        return "browser_pages"

    def reader(self, schema) -> DataSourceReader:
        return _BrowserReader(dict(self.options))


def source_name(site: Settings) -> str:
    """Which source a site needs."""
    return "browser_pages" if site.use_playwright else "http_pages"


def fetch(spark: SparkSession, site: Settings, urls: list[str], partitions: int = 1) -> DataFrame:
    """url, html of the addresses, with the site's headers and rate limit."""
    for source in (HttpPages, BrowserPages):
        spark.dataSource.register(source)
    read = spark.read.format(source_name(site)).option("urls", "\n".join(urls)).option("partitions", partitions).option("rate_limit", site.rate_limit)
    for k, v in site.headers.items():
        read = read.option(f"header.{k}", v)
    if site.wait_for_selector:
        read = read.option("wait_for_selector", site.wait_for_selector)
    return read.load()


def fetched(urls: DataFrame, site: Settings, tasks: int = 8) -> DataFrame:
    """url, html of a table of addresses (url), each fetched once, by ``tasks`` tasks that keep the site's rate limit between them."""
    headers, pause, selector = dict(site.headers), site.rate_limit * tasks, site.wait_for_selector
    opened = (lambda: _Browser(headers, selector)) if site.use_playwright else (lambda: _Plain(headers))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with opened() as get:
            began = False
            for b in batches:
                for url in b.column(0).to_pylist():
                    if began and pause:
                        time.sleep(pause)
                    began = True
                    yield pa.record_batch([pa.array([url]), pa.array([get(url)])], names=["url", "html"])

    return urls.select("url").where("url is not null").distinct().repartition(tasks).mapInArrow(run, "url string, html string")


def walk(site: Settings, get: Callable[[str], str], onward: Callable[[str, str], str | None]) -> Iterator[tuple[str, str]]:
    """Index pages (url, html) of a live site, one after another along their next links (S15), ``max_pages`` at most."""
    url, seen = site.base_url, set()
    while url and url not in seen and len(seen) < site.pagination.max_pages:
        if seen and site.rate_limit:
            time.sleep(site.rate_limit)
        seen.add(url)
        html = get(url)
        yield url, html
        url = onward(html, url)


def scrolls(page, site: Settings, links: Callable[[str], list[str]], wait: Callable[[float], None] = time.sleep) -> Iterator[tuple[int, str, str]]:
    """Snapshots (scroll, url, html) of an open browser page that grows as it scrolls (S16): the next scroll follows while the
    last one showed an address that is new (X03), ``max_pages`` scrolls at most (L03)."""
    seen: set[str] = set()
    for scroll in range(1, site.pagination.max_pages + 1):
        html = page.content()
        yield scroll, site.base_url, html
        fresh = set(links(html)) - seen
        if scroll > 1 and not fresh or site.max_listings and len(seen | fresh) >= site.max_listings:
            return
        seen |= fresh
        page.evaluate("window.scrollTo(0, document.body.scrollHeight)")
        wait(site.rate_limit)


def plain(site: Settings) -> _Plain:
    """Something that gets a page's text, for use in a with statement: by HTTP, or in a browser where the site needs it."""
    return _Browser(dict(site.headers), site.wait_for_selector) if site.use_playwright else _Plain(dict(site.headers))


def image(url: str, timeout: float = 5.0) -> tuple[str, bytes] | None:
    """Content type and bytes of an image (S17); None if it can't be had in time."""
    try:
        with urlopen(url, timeout=timeout) as answer:  # noqa: S310  the listing's own addresses
            return answer.headers.get("Content-Type") or "", answer.read()
    except (OSError, ValueError):
        return None


def healthy(url: str, timeout: float = 5.0) -> bool:
    """Whether a server answers its health address with success."""
    try:
        with urlopen(url.rstrip("/") + "/health", timeout=timeout) as answer:  # noqa: S310
            return answer.status == 200
    except OSError:
        return False
