import random

import pytest

from loomtable.operators import compare, latency, metrics, split
from loomtable.plans import config, schema
from loomtable.plans.schema import PREDICTION


@pytest.mark.parametrize(("n", "sizes"), [(0, {}), (2, {"train": 1, "test": 1}), (10, {"train": 8, "val": 1, "test": 1}), (29, {"train": 23, "val": 2, "test": 4})])
def test_exact_sizes(spark, n, sizes):
    got = split.split(spark.range(n), "id")
    assert {r.split: r["count"] for r in got.groupBy("split").count().collect()} == sizes
    assert got.select("id").distinct().count() == n


def test_large_sizes_over_several_ranges(spark, monkeypatch):
    monkeypatch.setattr(split, "ROWS_A_RANGE", 1000)
    got = split.split(spark.range(32398), "id")
    assert {r.split: r["count"] for r in got.groupBy("split").count().collect()} == {"train": 25918, "val": 3239, "test": 3241}
    again = split.split(spark.range(32398).repartition(7), "id")
    assert got.exceptAll(again).count() == 0


def test_stratified_and_fallback(spark):
    rows = [(i, "ab"[i % 2] if i else None) for i in range(41)] + [(99, None)]
    df = spark.createDataFrame(rows, "id long, c string")
    got = {(r.c, r.split): r["count"] for r in split.split(df, "id", category="c").groupBy("c", "split").count().collect()}
    assert got[("a", "train")] == 16 and got[("b", "train")] == 16 and got[(None, "test")] == 1
    lonely = df.where("id <> 99")
    assert sorted(map(tuple, split.split(lonely, "id", category="c").select("id", "split").collect())) == sorted(map(tuple, split.split(lonely.select("id"), "id").collect()))


def test_sample_cycle_limit(spark):
    df = spark.range(20)
    assert split.sample(df, "id", 0).count() == 20 and split.sample(df, "id", 5).count() == 5 and split.sample(df, "id", 50).count() == 20
    assert [r.id for r in split.cycled(df.where("id < 3"), "id", 7, 2).orderBy("i").collect()] == [2, 0, 1, 2, 0, 1, 2]
    assert split.limited(df, "id", None).count() == 20


def pairs(spark, rows):
    return spark.createDataFrame(rows, PREDICTION)


def test_metrics_edges(spark):
    rows = [
        ({"a": " RED ", "b": "1"}, {"a": "red", "b": "1"}), ({"a": "red", "b": "1", "z": "x"}, {"a": "red", "b": "1"}),
        ({"a": None, "b": "1"}, {"a": None, "b": "1"}), ({}, {"a": "red", "b": "2"}),
    ]
    df = pairs(spark, rows)
    got = metrics.evaluate(df, ["a", "b"], "c")
    assert got["exact_match"] == 0.5 and got["per_attribute"] == {"a": 0.5, "b": 0.75}
    assert got["category_breakdown"] == {"unknown": 0.5} and got["total_samples"] == 4
    none = metrics.evaluate(df.limit(0), ["a"])
    assert none["exact_match"] == 0.0 and none["per_attribute"] == {"a": 0.0}


def test_metrics_ignore_order(spark):
    rng = random.Random(1)
    rows = [({"a": rng.choice("xyz"), "b": "1"}, {"a": rng.choice("xyz"), "b": rng.choice("12")}) for _ in range(60)]
    one = metrics.evaluate(pairs(spark, rows), ["a", "b"], "b")
    rng.shuffle(rows)
    two = metrics.evaluate(pairs(spark, rows).repartition(5), ["a", "b"], "b")
    assert all(one[k] == two[k] for k in one if k != "timestamp")
    flat = lambda m: {k: v.strip().lower() for k, v in m.items()}
    assert one["exact_match"] == pytest.approx(sum(flat(p) == flat(t) for p, t in rows) / 60)


def test_pairs_must_match(spark):
    p = spark.createDataFrame([(1, {"a": "x"}), (2, {"a": "y"})], "seq long, prediction map<string,string>")
    t = spark.createDataFrame([(1, {"a": "x"})], "seq long, ground_truth map<string,string>")
    for rows in (metrics.paired(p, t), metrics.paired(p.limit(0), t)):
        with pytest.raises(Exception, match="differ"):
            rows.select("seq").count()


def test_comparison_report():
    a = {"exact_match": 0.0625, "per_attribute": {"x": 1.0, "y": 0.5}, "category_breakdown": {"k": 1.0}, "total_samples": 2}
    b = {"exact_match": 1.0, "per_attribute": {"z": 0.25}, "category_breakdown": None, "total_samples": 3}
    text = compare.report([("one", a), ("two", b)])
    assert "| one | 6.2% | 2 |" in text and "| z | 0.0% | 25.0% |" in text and "| k | 100.0% | 0.0% |" in text
    assert compare.report([]) == "No results to compare.\n"


def test_latency(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (8.0,)], "v double")
    got = df.agg(*[latency.percentile(df.v, p) for p in (50, 95, 99)]).first()
    assert tuple(round(x, 6) for x in got) == (3.0, 7.4, 7.88)
    assert df.limit(0).agg(latency.percentile(df.v, 50)).first()[0] == 0.0
    chunks = spark.createDataFrame(
        [(1, 10.0, False, None, 9.0), (1, 10.5, True, None, 9.0), (1, 11.0, True, None, 9.0), (1, 11.5, False, 4, 9.0), (2, 3.0, False, None, 2.0)],
        "request_id long, ts double, has_content boolean, usage_tokens long, start double",
    )
    r = {x.request_id: x for x in latency.requests(chunks).collect()}
    assert r[1].ttft_ms == 1500 and r[1].total_latency_ms == 2500 and r[1].completion_tokens == 4 and r[1].tokens_per_sec == 4.0 and r[1].token_latencies_ms == [500.0]
    assert r[2].ttft_ms == 1000 and r[2].tokens_per_sec == 0.0 and r[2].token_latencies_ms == []
    batch = latency.batches(latency.requests(chunks), []).first().asDict()
    assert batch["requests"] == 2 and batch["avg_per_token_latency_ms"] == 500.0
    text = latency.report([{"label": "p", "prompt_chars": 5, "cold": r[1].asDict(), "warm": batch | {"wall_clock_ms": 7.0}, "scaling": {4: batch | {"wall_clock_ms": 9.0}}}], None, {"Model": "m"})
    assert "| 4 | 9 |" in text and "unavailable" in text
    gpu = latency.gpu(spark.createDataFrame([(1.0, 5.0, 50.0, 8.0), (2.0, 7.0, 70.0, 9.0)], "ts double, memory_used_mb double, utilization_pct double, memory_total_mb double")).first()
    assert tuple(gpu) == (7.0, 60.0, 9.0, 2)


def test_schema_and_config(tmp_path):
    s = schema.bikes()
    js = schema.json_schema(s)
    assert js["required"] == ["maker", "frame"] and js["properties"]["gears"]["enum"][-1] == "21" and js["additionalProperties"] is False
    assert schema.system_prompt(s).endswith("Attributes to extract: maker, frame, paint, gears")
    assert "frame: free text string" in schema.value_prompt(s) and schema.value_prompt(s).splitlines()[2] == ""
    with pytest.raises(ValueError):
        schema.Attribute("x", "enum", ())
    with pytest.raises(ValueError):
        config.Settings("dataset", schema_path="s", split_ratio=(0.5, 0.4, 0.2))
    with pytest.raises(FileNotFoundError):
        config.load(tmp_path / "none.yaml", "dataset")
    (tmp_path / "site.yaml").write_text("name: n\nbase_url: u\nlisting_selector: a\ndetail_selectors: {title: h1}\npagination: {type: page_number, url_pattern: 'p{page}', max_pages: 3}\n")
    site = config.load(tmp_path / "site.yaml", "site")
    assert site.pagination.max_pages == 3 and site.detail_selectors == {"title": "h1"}
    with pytest.raises(SystemExit):
        config.check_enough(3, 10)


def test_order_without_one_task(spark):
    rows = spark.createDataFrame([(i * 7 % 50, f"r{i}") for i in range(50)], "k long, v string").repartition(5)
    assert {r.k: r.place for r in split.in_order(rows, "k").collect()} == {k: k for k in range(50)}
    got = split.cycled(rows.select("k"), "k", 120, 47).collect()
    assert {r.i: r.k for r in got} == {i: (i + 47) % 50 for i in range(120)}
    assert {r.i: r.k for r in split.cycled(rows.select("k"), "k", 3, 2).collect()} == {0: 2, 1: 3, 2: 4} and split.cycled(rows.limit(0), "k", 3).count() == 0
    parts = split.split(rows, "k")
    again = split.reshuffled(parts, "k")
    assert {(r.split, r.place) for r in again.collect()} == {(s, i + 1) for s, n in (("train", 40), ("val", 5), ("test", 5)) for i in range(n)}
    assert metrics.nested({"exact_match": 1.0, "per_attribute": {"a": 0.5}, "category_breakdown": None, "total_samples": 2, "timestamp": "t"}) == {
        "exact_match": 1.0, "total_samples": 2, "timestamp": "t", "per_attribute": {"a": {"accuracy": 0.5}}, "category_breakdown": {},
    }


def test_settings():
    site = config.Settings("site", {"name": "n", "base_url": "u", "listing_selector": "a", "detail_selectors": {}, "odd": 1})
    assert site.pagination.max_pages == 100 and site.but(max_listings=3).max_listings == 3 and "odd" not in site and site.headers == {}
    with pytest.raises(TypeError, match="base_url"):
        config.Settings("site", name="n")
    with pytest.raises(ValueError):
        config.Settings("pagination", type="by_magic")
    with pytest.raises(AttributeError):
        site.name = "x"
    import pickle

    assert pickle.loads(pickle.dumps(site)) == site
    command = config.serve_command(config.Settings("server", model="m", max_model_len=2048))
    assert command[:3] == ["vllm", "serve", "m"] and command[-2:] == ["--max-model-len", "2048"]
