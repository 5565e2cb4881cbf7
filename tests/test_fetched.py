"""A crawl takes the pages that it wants from a store and holds the store nowhere."""

import re

from pyspark.sql import functions as F

from loomtable.operators import pages
from loomtable.plans.config import Settings


def test_no_store_is_broadcast(spark, tmp_path):
    front = spark.createDataFrame([("http://h/1", '<a class="i" href="a"></a><a class="i" href="b"></a>')], "url string, html string")
    other = spark.range(500).select(F.concat(F.lit("http://h/x"), F.col("id")).alias("url"), F.lit("<h1>no</h1>").alias("html"))
    items = spark.createDataFrame([(f"http://h/{c}", f"<h1>{c}</h1>") for c in "ab"], "url string, html string")
    front.unionByName(items).unionByName(other).coalesce(1).write.parquet(str(tmp_path / "pages"))
    site = Settings("site", name="s", base_url="http://h/1", listing_selector="a.i@href", detail_selectors={"title": "h1"}, pagination={"type": "page_number", "url_pattern": "http://h/{page}", "max_pages": 1})
    got = pages.crawl(spark.read.parquet(str(tmp_path / "pages")), site)
    joins = re.findall(r"(\w+Join) .*LeftOuter", got._jdf.queryExecution().executedPlan().toString())
    assert joins and set(joins) == {"SortMergeJoin"}
    assert [r.title for r in got.collect()] == ["a", "b"]
