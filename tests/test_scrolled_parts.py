"""Snapshots of a scrolled page that come in pieces."""

import pytest

from loomtable.operators import pages
from loomtable.plans.config import Settings


def card(name):
    return f'<a class="i" href="{name}"></a>'


def test_pieces_are_a_snapshot(spark):
    """Pieces come in any order of rows; those that later scrolls repeat stay where they were first shown, and places in a page count before places in a piece."""
    site = Settings("site", name="x", base_url="", listing_selector="a.i@href", detail_selectors={})
    shots = [(1, 9, "b"), (1, 2, "cz"), (2, 0, "d"), (2, 1, "cz"), (2, 9, "b"), (2, 10, "a"), (3, 5, "b"), (3, 4, "zc"), (4, 0, "e")]  # 3 shows none that is new
    df = spark.createDataFrame([(s, p, "http://h/", "".join(map(card, x))) for s, p, x in reversed(shots)], "scroll int, part long, url string, html string")
    for rows in (df, df.repartition(5)):
        assert [r.link[-1] for r in pages.scrolled(rows, site).orderBy("seq").collect()] == ["c", "z", "b", "d", "a"]
    with pytest.raises(Exception, match="parts to 2"):
        pages.scrolled(df.withColumn("part", df.part + (1 << 40)), site).collect()


def test_a_row_of_a_scrolled_query_is_a_piece(spark, tmp_path, monkeypatch):
    """No snapshot stands whole in a row, however many parts it shows."""
    from loomtable.plans import queries

    longest = []
    scrolled = pages.scrolled
    monkeypatch.setattr(pages, "scrolled", lambda rows, site: longest.append(rows.selectExpr("max(length(html))").first()[0]) or scrolled(rows, site))
    spark.range(3000).selectExpr("id p_partkey", "cast(id % 4 + 1 as int) p_size").write.parquet(str(tmp_path / "part.parquet"))
    got = queries.QUERIES["s16_scrolled"](spark, str(tmp_path)).collect()
    want = sorted(range(3000), key=lambda k: (k % 4, k))
    assert [r.link for r in sorted(got, key=lambda r: r.seq)] == [f"http://h/{k}" for k in want] and longest[0] < 100
