import hashlib
import html
import json
import random
import re

import pytest

from loomtable.functions import text as X
from loomtable.operators import clean, ingest, metrics
from loomtable.plans.schema import LISTING, bikes
from loomtable.sources import sinks
from pyspark.sql import functions as F


def listing(seq, title, images, **attributes):
    return (seq, "", title, images, dict(attributes))


EDGES = [
    (listing(1, "  Pixel&nbsp;&nbsp;8 &amp; case ", [], maker="kestrel", frame="8"), "missing_images"),
    (listing(2, "Pixel 8 & case", ["a.jpg"], maker="kestrel", frame="8"), "duplicates"),
    (listing(3, "&nbsp; ", ["a"], maker="Vela", frame="1"), "empty_title"),
    (listing(4, "X", ["a"], maker="Nokia", frame="1"), "invalid_attrs"),
    (listing(5, "X", ["a"], maker=" VELA ", frame="1"), None),
    (listing(6, "X", ["a"], maker="Vela", frame="1"), None),
    (listing(7, "X", ["a"], maker="Vela"), "invalid_attrs"),
    (listing(8, "Y", ["a"], maker="Vela", frame="1", z="extra"), None),
    (listing(9, "Y", ["a"], maker="Vela", frame="1", paint=""), None),
    (listing(10, "", [], maker="Nokia"), "empty_title"),
    (listing(11, None, ["a"], maker="Vela", frame="1"), "empty_title"),
]


@pytest.mark.parametrize("parts", [1, 7])
def test_first_reason_wins(spark, parts):
    rows = clean.with_reason(spark.createDataFrame([r for r, _ in EDGES], LISTING).repartition(parts), bikes(), require_images=True)
    got = {r.seq: r for r in rows.collect()}
    assert {s: r.drop_reason for s, r in got.items()} == {r[0]: why for r, why in EDGES}
    assert got[1].title == "Pixel 8 & case"
    assert got[6].content_hash == hashlib.sha256(b"X|frame=1|maker=Vela").hexdigest()
    stats = clean.reasons(rows).first().asDict()
    assert stats == {"total": 11, "kept": 4, "empty_title": 3, "invalid_attrs": 2, "duplicates": 1, "missing_images": 1}


def test_options(spark):
    df = spark.createDataFrame([r for r, _ in EDGES], LISTING)
    assert clean.clean(df, bikes()).count() == 5
    assert clean.clean(df, bikes(), deduplicate=False).count() == 6
    empty = clean.reasons(clean.with_reason(df.limit(0), bikes())).first()
    assert (empty.total, empty.kept) == (0, 0)


def test_normal_form_is_pythons(spark):
    rng = random.Random(3)
    alphabet = [chr(c) for c in (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)] + ["a", "é", "&amp;", "&lt;", "&amp;lt;", "&nbsp;", "İ", "Σ"]
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(12))) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    for r in df.select("i", X.normal(F.col("t")).alias("n"), X.folded(F.col("t")).alias("f")).collect():
        t = texts[r.i]
        assert r.n == re.sub(r"\s+", " ", html.unescape(t)).strip()
        assert r.f == t.strip().lower()


def test_ingest(spark):
    df = spark.createDataFrame([(1, "A", "i.jpg", "red", ""), (2, None, None, None, "x")], "k long, name string, img string, colour string, note string")
    flat = {r.seq: r for r in ingest.to_listings(df, ingest.Mapping("name", "img"), seq="k").collect()}
    assert flat[1].image_urls == ["i.jpg"] and flat[1].attributes == {"colour": "red"}
    assert flat[2].title == "" and flat[2].image_urls == [] and flat[2].attributes == {"note": "x"}
    picked = ingest.to_listings(df, ingest.Mapping("name", attribute_fields={"c": "colour", "gone": "nowhere"}, url_field="img"), seq="k").first()
    assert picked.attributes == {"c": "red"} and picked.url == "i.jpg"
    assert ingest.Mapping("name", "img", None, "u").reserved() == {"name", "img", "u"}


def test_python_spelling(spark):
    line = '{"title": "t", "attributes": {"a": true, "b": null, "c": 1.5, "d": ["x", 1], "e": "s"}}'
    got = spark.createDataFrame([(line,), ("{}",), ("oops",)], "j string").select(X.python_attributes(F.col("j")).alias("a")).collect()
    assert got[0].a == {"a": "True", "b": "None", "c": "1.5", "d": "['x', 1]", "e": "s"} and got[1].a is None and got[2].a is None


def test_typed_listings(spark):
    """Against the rules spelled out in Python over the same JSON."""
    lines = [
        '{"url": "u", "title": "t", "image_urls": "one.jpg", "attributes": {"a": 0, "b": "0", "c": 1.0, "d": true, "e": [0], "f": {"x": null}, "g": " ", "a": "last", "é": "ü"}}',
        '{"title": null, "image_urls": "", "attributes": {"z": -0.0, "y": 1e-7, "x": 0e9, "w": false, "v": null, "u": {}, "t": [], "s": ""}}',
        '{"url": "only", "image_urls": ["a", "b"], "attributes": {}}',
        '{"title": "flat", "img": "i.jpg", "colour": "red", "n": 0, "m": 2, "k": "", "attributes": "text"}',
        '{"title": "none", "img": null, "colour": null}',
    ]
    df = spark.createDataFrame(list(enumerate(lines)), "k long, value string")

    def truthy(record):
        return {k: str(v) for k, v in record.items() if v}

    got = {r.seq: r for r in ingest.typed_listings(df, ingest.Mapping("title", "img"), seq="k").collect()}
    for k in (0, 1, 2):
        record = json.loads(lines[k])
        images = record.get("image_urls", [])
        assert got[k].attributes == truthy(record["attributes"]), k
        assert got[k].image_urls == (images if isinstance(images, list) else [images] if images else [])
        assert (got[k].url, got[k].title) == (record.get("url") or "", record.get("title") or "")
    assert got[3].attributes == {"colour": "red", "m": "2", "attributes": "text"} and got[3].image_urls == ["i.jpg"] and got[3].title == "flat"
    assert got[4].attributes == {} and got[4].image_urls == []
    picked = ingest.typed_listings(df, ingest.Mapping("title", attribute_fields={"c": "colour", "size": "m", "gone": "n"}), seq="k").where("seq = 3").first()
    assert picked.attributes == {"c": "red", "size": "2"}
    with pytest.raises(Exception, match="(?i)malformed"):
        ingest.typed_listings(spark.createDataFrame([("{oops",)], "value string")).collect()


def test_metrics_in_one_scan(spark):
    rows = spark.createDataFrame([({"a": "1"}, {"a": "1", "c": "x"}), ({"a": "2", "c": "x"}, {"a": "2", "c": "x"}), ({}, {"a": "3"})], "prediction map<string,string>, ground_truth map<string,string>")
    found = metrics.evaluate(rows, ["a", "c"], "c")
    assert found["exact_match"] == pytest.approx(1 / 3) and found["total_samples"] == 3 and found["per_attribute"] == {"a": pytest.approx(2 / 3), "c": pytest.approx(1 / 3)}
    assert found["category_breakdown"] == {"x": 0.5, "unknown": 0.0}
    assert metrics.evaluate(rows.limit(0), ["a"], "c")["total_samples"] == 0 and metrics.evaluate(rows, [])["category_breakdown"] is None
    plan = metrics.summary(spark.range(10).select(F.create_map(F.lit("a"), F.col("id").cast("string")).alias("prediction"), F.create_map(F.lit("a"), F.lit("1")).alias("ground_truth")), ["a"], "a")
    assert plan._jdf.queryExecution().executedPlan().toString().count("Range (") == 1


def test_splits_are_counted_as_they_are_written(spark, tmp_path):
    runs = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            runs.add(b.num_rows)
            yield b

    rows = spark.range(30).select("id", F.when(F.col("id") < 20, "train").when(F.col("id") < 25, "val").otherwise("other").alias("split")).mapInArrow(seen, "id long, split string")
    assert sinks.write_splits(rows, str(tmp_path / "s")) == {"train": 20, "val": 5, "test": 0, "total": 25}
    assert runs.value == 30
    assert sinks.write_splits(rows.where("id < 0"), str(tmp_path / "none"))["total"] == 0


def test_percent_rounds_as_python_does(spark):
    rng = random.Random(6)
    values = [0.0, 0.1225, 0.00125, 0.15, 0.0005, 0.00049999, 1.0, -0.123456, 2 / 3, 1e9, 12345.67885] + [rng.randrange(20001) / 20000 for _ in range(500)] + [rng.random() for _ in range(500)] + [rng.randrange(4001) / 4000 for _ in range(500)]
    got = spark.createDataFrame(list(enumerate(values)), "i int, x double").select("i", X.percent(F.col("x")).alias("p")).collect()
    assert {r.i: r.p for r in got} == {i: f"{x:.1%}" for i, x in enumerate(values)}
