"""A crawl of many sites against a plain breadth-first walk."""

import random

from loomtable.operators import pages


def plain(links, seeds, most):
    depth, front = {u: 0 for u in seeds}, list(seeds)
    for k in range(most):
        front = [t for t in dict.fromkeys(t for u in front for a, t in links if a == u) if t not in depth]
        depth.update({u: k + 1 for u in front})
    return depth


def test_reached_is_the_plain_walk(spark):
    rng = random.Random(4)
    page = lambda: f"http://h{rng.randrange(4)}.example/{rng.randrange(15)}"
    links = [(page(), page()) for _ in range(90)]
    seeds = [page() for _ in range(3)]
    df = spark.createDataFrame([*links, (None, "http://x/1"), (seeds[0], None)], "url string, to string")
    start = spark.createDataFrame([(u,) for u in [*seeds, seeds[0], None]], "url string")
    for most in (0, 2, 9):
        got = pages.reached(df, start, most).collect()
        assert {r.url: r.depth for r in got} == plain(links, dict.fromkeys(seeds), most) and len(got) == len({r.url for r in got})
        assert all(r.host == r.url.split("/")[2] for r in got)
    paced = pages.reached(df, start, 50, per_host=2).collect()  # slower, and all the same pages
    assert {r.url for r in paced} == set(plain(links, dict.fromkeys(seeds), 50)) and len(paced) == len({r.url for r in paced})
    assert pages.reached(df, start.limit(0), 3).count() == 0


def test_links_are_made_once(spark):
    """Rounds read written links: what makes the links, a parse of all pages, does not run again in each round."""
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    df = spark.createDataFrame([(f"http://h/{k}", f"http://h/{k + 1}") for k in range(40)], "url string, to string").coalesce(1)
    start = spark.createDataFrame([("http://h/0",)], "url string")
    got = pages.reached(df.mapInArrow(count, "url string, to string"), start, 3)
    assert sorted((r.url, r.depth) for r in got.collect()) == [(f"http://h/{k}", k) for k in range(4)]
    assert made.value == 40
