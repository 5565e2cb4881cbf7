import json

import pytest

from loomtable.functions import text as X
from loomtable.operators import chat, images, pages, predict
from loomtable.plans import cli, config
from loomtable.plans.schema import LISTING, bikes
from loomtable.sources import files, sinks, web
from loomtable.streaming import live
from pyspark.sql import functions as F

PAGE = """<html><body><div class="foo bar" id=d><h1> Big <b>Deal</b> </h1><p>one<p>two<img src="/a.png"><img src="b.png"></div>
<ul><li>1</li><li class=next><a href="page2">n</a></li><li><a href="x">third</a></li></ul><script>var a="<h1>no</h1>";</script></body>"""


def test_selectors():
    root = pages.parse(PAGE)
    assert pages.split_selector("div.foo img@src") == ("div.foo img", "src") and pages.split_selector("h1.title") == ("h1.title", None)
    assert pages.split_selector("img@data-src") == ("img@data-src", None)
    assert pages.first(root, "div.foo h1") == "BigDeal" and pages.first(root, "#d@class") == "foo bar" and pages.first(root, "h7") is None
    assert pages.every(root, "div img@src") == ["/a.png", "b.png"]
    assert pages.first(root, "ul li:nth-child(3) a") == "third" and pages.first(root, "h1 ~ p") == "onetwo" and pages.first(root, "li.next > a@href") == "page2"
    with pytest.raises(ValueError):
        pages.select(root, "a:hover")


def site(**more):
    return config.Settings("site", name="s", base_url="http://h/1", listing_selector="a.item@href", detail_selectors={"title": "h1", "image": "img@src", "price": "p.price"}, **more)


def stored(spark):
    front = lambda items, nxt: "".join(f'<a class="item" href="{i}">x</a>' for i in items) + (f'<li class="next"><a href="{nxt}">n</a></li>' if nxt else "")
    item = lambda n: f'<h1>Item {n}</h1><img src="i{n}.jpg"><p class="price">{n}</p>'
    rows = [("http://h/1", front("ab", "2")), ("http://h/2", front("bc", None)), *[(f"http://h/{c}", item(c)) for c in "abc"]]
    return spark.createDataFrame(rows, "url string, html string")


def test_crawl(spark):
    by_link = config.Settings("pagination", selector="li.next a@href")
    got = pages.crawl(stored(spark), site(pagination=by_link)).collect()
    assert [r.title for r in got] == ["Item a", "Item b", "Item b", "Item c"] and got[0].image_urls == ["http://h/ia.jpg"] and got[0].attributes == {"price": "a"}
    assert pages.crawl(stored(spark), site(pagination=by_link, max_listings=3)).count() == 3
    assert pages.crawl(stored(spark), site(pagination=config.Settings("pagination", selector="li.next a@href", max_pages=1))).count() == 2
    numbered = config.Settings("pagination", type="page_number", url_pattern="http://h/{page}", max_pages=2)
    assert pages.crawl(stored(spark), site(pagination=numbered)).count() == 4
    with pytest.raises(Exception, match="page not found"):
        pages.crawl(stored(spark).where("url <> 'http://h/2'"), site(pagination=by_link)).count()
    with pytest.raises(NotImplementedError):
        pages.next_page(config.Settings("pagination", type="infinite_scroll"), None, 1)


def test_scrolling(spark):
    shots = [(1, "http://h/1", "ab"), (2, "http://h/1", "abc"), (3, "http://h/1", "abc"), (4, "http://h/1", "abcd")]
    df = spark.createDataFrame([(s, u, "".join(f'<a class="item" href="{c}"></a>' for c in x)) for s, u, x in shots], "scroll long, url string, html string")
    assert [r.link[-1] for r in pages.scrolled(df, site()).orderBy("seq").collect()] == ["a", "b", "c"]


def test_files_round_trip(spark, tmp_path):
    raw = tmp_path / "raw.jsonl"
    raw.write_text('{"url": "u", "title": "é", "image_urls": ["i"], "attributes": {"b": "1", "a": "x", "b": "2"}}\n\n  \n{"title": "t"}\n', encoding="utf-8")
    got = files.read_listings(spark, str(raw)).orderBy("seq").collect()
    assert [(r.seq, r.title) for r in got] == [(0, "é"), (3, "t")] and got[0].attributes == {"a": "x", "b": "2"}
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        raw.with_name("bad.jsonl").write_text('{"title": "x"}\n{oops\n')
        files.read_listings(spark, str(raw.with_name("bad.jsonl"))).collect()
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        files.read_test_rows(spark, str(raw), blank_fails=True).collect()
    (tmp_path / "t.csv").write_text('name,img,colour\n"a\nb",i.jpg,red\nshort\n', encoding="utf-8")
    assert [tuple(r) for r in files.read_csv(spark, str(tmp_path / "t.csv")).collect()] == [("a\nb", "i.jpg", "red"), ("short", None, None)]
    for name, text in (("a.json", json.dumps([{"title": "1"}, {"title": "2"}], indent=1)), ("b.json", '{"title": "1"}\n{"title": "2"}\n')):
        (tmp_path / name).write_text(text)
        assert [r.title for r in files.read_json(spark, str(tmp_path / name), LISTING).collect()] == ["1", "2"]
    result = {"exact_match": 0.5, "per_attribute": {"a": 1.0}, "category_breakdown": None, "total_samples": 2, "timestamp": "t"}
    sinks.write_json(result, tmp_path / "r/eval.json")
    assert files.load_result(tmp_path / "r/eval.json") == result
    assert files.read_results(spark, [str(tmp_path / "r/eval.json")]).first().per_attribute == {"a": 1.0}
    assert files.newest(["m/checkpoint-9", "m/checkpoint-100", "m/final"]) == "m/checkpoint-100" and files.newest([]) is None
    assert sinks.write_splits(spark.createDataFrame([(1, "train"), (2, "val")], "a int, split string"), str(tmp_path / "s")) == {"train": 1, "val": 1, "test": 0, "total": 2}
    assert files.read_training(spark, str(raw), str(tmp_path / "none"))[1] is None


def test_chat(spark):
    rows = spark.createDataFrame([(1, "u", 'T "q"', ["d/i.jpg"], {"frame": "é", "maker": "Vela", "z": "1"}), (2, "", "plain", [], {})], LISTING)
    made = chat.messages(rows, bikes())
    lines = {r.seq: json.loads(r.j) for r in made.select("seq", chat.message_json(F.col("messages")).alias("j")).collect()}
    assert lines[1]["messages"][1]["content"] == [{"type": "image", "image": "d/i.jpg"}, {"type": "text", "text": 'Title: "T "q""'}]
    assert json.loads(lines[1]["messages"][2]["content"]) == {"frame": "é", "maker": "Vela"} and lines[2]["messages"][1]["content"] == 'Title: "plain"'
    back = {r.seq: r for r in chat.unify(made).collect()}
    assert back[1].title == 'Title: "T "q""' and back[1].ground_truth == {"frame": "é", "maker": "Vela"}
    asked = {r.seq: r for r in chat.prompts(made, "s").collect()}
    assert asked[1].text == 'Title: "T "q""' and asked[1].image == "d/i.jpg" and asked[2].image is None
    have = spark.createDataFrame([("d/i.jpg",)], "path string")
    assert chat.with_images(made, have).count() == 2 and chat.with_images(made, have.limit(0)).count() == 1


def test_images_and_text(spark):
    row = spark.createDataFrame([(b"x" * 100, "<think>a</think>no", 3000, 10)], "c binary, r string, w int, h int")
    got = row.select(X.data_uri(F.col("c")).alias("u"), X.parsed_response(F.col("r")).alias("p"), images.fitted(F.col("w"), F.col("h"), 1024).alias("s")).first()
    assert "\n" not in got.u and got.u.startswith("data:image/jpeg;base64,eHh4") and got.p == {} and tuple(got.s) == (1024, 3)
    kinds = spark.createDataFrame([("image/png",), (None,), ("text/html",)], "k string")
    assert [r[0] for r in kinds.select(images.is_image(F.col("k"))).collect()] == [True, True, False]
    one = spark.createDataFrame([(1, 0, "u1"), (1, 1, "u2"), (2, 0, "u3")], "seq long, img_idx int, image_url string")
    kept = images.first_of_each(images.fetched(one, lambda u: None if u == "u2" else ("image/jpeg", b"same")))
    assert [(r.seq, r.img_idx) for r in kept.collect()] == [(1, 0)]


def test_predictor(spark):
    calls, waits = [], []

    def flaky(title):
        calls.append(title)
        if len(calls) < 3:
            raise OSError("down")
        return {"a": 1, "b": None}

    assert predict.retried(flaky, wait=waits.append)("t") == {"a": 1, "b": None} and waits == [1.0, 2.0]
    with pytest.raises(RuntimeError):
        predict.retried(lambda t: 1 / 0, 2, waits.append)("t")
    df = spark.createDataFrame([(i, f"t{i}") for i in range(20)], "seq long, title string")
    got = {r.seq: r.prediction for r in predict.predict(df, lambda t: {"t": t, "n": 1}).collect()}
    assert got[7] == {"t": "t7", "n": "1"} and len(got) == 20


def test_command_line(spark, tmp_path):
    (tmp_path / "schema.yaml").write_text("name: p\ncategory_field: brand\nattributes:\n- {name: brand, type: enum, values: [A, B]}\n- {name: size, type: string, required: false}\n")
    (tmp_path / "data.yaml").write_text(f"schema_path: {tmp_path}/schema.yaml\ntext_only: true\nmin_samples: 5\ncategory_field: brand\n")
    rows = [{"url": "", "title": f"t{i}", "image_urls": [], "attributes": {"brand": "AB"[i % 2], "size": str(i)}} for i in range(20)] + [{"title": "", "attributes": {}}]
    (tmp_path / "raw.jsonl").write_text("\n".join(map(json.dumps, rows)))
    counts = cli.prepare(spark, config.load(tmp_path / "data.yaml", "dataset"), str(tmp_path / "raw.jsonl"), str(tmp_path / "out"))
    assert counts == {"train": 16, "val": 2, "test": 2}
    cfg = config.Settings("evaluation", test_data_path=str(tmp_path / "out/splits/split=test"), schema_path=str(tmp_path / "schema.yaml"), output_dir=str(tmp_path / "rep"))
    truth = {f'Title: "t{i}"': rows[i]["attributes"] for i in range(20)}
    result = cli.evaluate(spark, cfg, predictor=lambda t: truth[t])
    assert result["exact_match"] == 1.0 and result["total_samples"] == 2
    again = cli.evaluate(spark, cfg, predictor=lambda t: {}, compare_with=(str(tmp_path / "rep/eval_result.json"),))
    assert again["exact_match"] == 0.0 and "run_1" in (tmp_path / "rep/comparison.md").read_text()
    with pytest.raises(SystemExit):
        cli.prepare(spark, config.Settings("dataset", schema_path=str(tmp_path / "schema.yaml"), min_samples=100, text_only=True), str(tmp_path / "raw.jsonl"), str(tmp_path / "out2"))
    cli.scrape(spark, site(pagination=config.Settings("pagination", selector="li.next a@href")), str(tmp_path / "got"), stored(spark), pictures=False)
    assert files.read_json(spark, str(tmp_path / "got/listings"), LISTING).count() == 4


def test_web_source(spark):
    assert web.source_name(site()) == "http_pages" and web.source_name(site(use_playwright=True)) == "browser_pages"
    reader = web.HttpPages({"urls": "a\nb\nc", "partitions": "2"}).reader(None)
    assert [p.urls for p in reader.partitions()] == [["a", "c"], ["b"]]
    assert web.healthy("http://127.0.0.1:9", timeout=0.2) is False


def test_streams(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = [{"ts": f"2024-01-01T00:00:0{i}", "url": "ab"[i % 2], "request_id": i % 2, "has_content": i > 1, "usage_tokens": None, "memory_used_mb": float(i), "utilization_pct": 50.0, "event_type": "x", "value": 1.0} for i in range(6)]
    (tmp_path / "in/1.json").write_text("\n".join(map(json.dumps, rows)))
    shape = "ts timestamp, url string, request_id long, has_content boolean, usage_tokens long, memory_used_mb double, utilization_pct double, event_type string, value double"
    plans = {"links": (live.new_links, "append", 2), "requests": (live.token_stream, "update", 2), "gpu": (live.telemetry, "complete", 6), "events": (live.event_counts, "complete", 1)}
    for name, (make, mode, n) in plans.items():
        source = spark.readStream.schema(shape).json(str(tmp_path / "in"))
        q = make(source).writeStream.format("memory").queryName(name).outputMode(mode).start()
        q.processAllAvailable()
        q.stop()
        assert spark.table(name).count() == n, name
    r = {x.request_id: x for x in spark.table("requests").collect()}
    assert r[0].chunks == 2 and r[0].first_ts.second == 2


def test_manifest_logs_and_odd_files(spark, tmp_path):
    rows = [("1", ["a/1/0.jpg", 'q".jpg'], ["h", "i"]), ("2", [], []), ("10", ["é"], ["k"])]
    df = spark.createDataFrame(rows, "listing_id string, local_paths array<string>, hashes array<string>")
    sinks.write_manifest(df.repartition(3), str(tmp_path / "m/manifest.json"))
    want = [dict(zip(df.columns, r)) for r in rows]
    assert (tmp_path / "m/manifest.json").read_text(encoding="utf-8") == json.dumps(want, indent=2, ensure_ascii=False)
    assert [r.listing_id for r in files.read_manifest(spark, str(tmp_path / "m/manifest.json")).collect()] == ["1", "2", "10"]
    sinks.write_manifest(df.limit(0), str(tmp_path / "m/none.json"))
    assert json.loads((tmp_path / "m/none.json").read_text()) == []
    (tmp_path / "odd.json").write_text('[1, 2\n{"title": "x"}\n')
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        files.read_json(spark, str(tmp_path / "odd.json"), LISTING).collect()
    (tmp_path / "two.json").write_text('\n[{"title": "1"},\n{"title": "2"}]')
    assert files.read_json(spark, str(tmp_path / "two.json"), LISTING).count() == 2
    for n in (9, 10, 100):
        (tmp_path / f"run/checkpoint-{n}").mkdir(parents=True)
        sinks.log_line(tmp_path / "run/log.txt", step=n, loss=0.5)
    (tmp_path / "run/checkpoint-999").write_text("a file")
    assert files.newest_in(spark, str(tmp_path / "run")).endswith("run/checkpoint-100") and files.newest_in(spark, str(tmp_path / "gone")) is None
    last = sinks.tail(files.numbered_lines(spark, str(tmp_path / "run/log.txt")), 2).collect()
    assert [(r.seq, r.value) for r in last] == [(1, "step=10 loss=0.5"), (2, "step=100 loss=0.5")]


def test_line_numbers_over_splits(spark, tmp_path):
    for name, n in (("b", 3000), ("a", 2000)):
        (tmp_path / name).write_text("".join(f"{name}{i} {'x' * (i % 90)}\n" for i in range(n)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        lines = files.numbered_lines(spark, str(tmp_path))
        got = {r.seq: r.value.split(" ")[0] for r in lines.collect()}
        assert "Python" not in lines._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == {i: f"a{i}" if i < 2000 else f"b{i - 2000}" for i in range(5000)}


class _Site:
    """A small web server: index pages, items and images."""

    def __enter__(self):
        import http.server
        import threading

        front = lambda items, nxt: "".join(f'<a class="item" href="/{i}">x</a>' for i in items) + (f'<li class="next"><a href="/{nxt}">n</a></li>' if nxt else "")
        bodies = {"/1": front("ab", "2"), "/2": front("bc", "1"), **{f"/{c}": f'<h1>Item {c}</h1><img src="/{c}.jpg"><p class="price">{c}</p>' for c in "abc"}}
        pictures = {"/a.jpg": b"same", "/b.jpg": b"same"}
        self.asked = asked = []

        class Handler(http.server.BaseHTTPRequestHandler):
            def do_GET(self):  # noqa: N802
                asked.append(self.path)
                body, kind = (bodies[self.path].encode(), "text/html") if self.path in bodies else (pictures.get(self.path), "image/jpeg")
                self.send_response(200 if body else 404)
                self.send_header("Content-Type", kind)
                self.end_headers()
                self.wfile.write(body or b"")

            def log_message(self, *_):
                pass

        self.server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        self.url = f"http://127.0.0.1:{self.server.server_address[1]}"
        return self

    def __exit__(self, *_):
        self.server.shutdown()
        self.server.server_close()


def test_live_crawl_and_images(spark, tmp_path):
    with _Site() as live_site:
        by_link = {"selector": "li.next a@href"}
        s = site(pagination=by_link, rate_limit=0).but(base_url=f"{live_site.url}/1")
        got = cli.scrape(spark, s, str(tmp_path / "out"), raw_images=True)
        assert [r.title for r in got.orderBy("seq").collect()] == ["Item a", "Item b", "Item b", "Item c"]
        pages_asked = [p for p in live_site.asked if "." not in p]
        assert sorted(pages_asked) == ["/1", "/2", "/a", "/b", "/c"]  # each once
        manifest = json.loads((tmp_path / "out/images/manifest.json").read_text())
        assert [len(m["local_paths"]) for m in manifest] == [1, 0, 0, 0] and (tmp_path / "out/images/0/0.jpg").read_bytes() == b"same"
        asked = len(live_site.asked)
        cli.scrape(spark, s, str(tmp_path / "out2"), pictures=False)
        assert len(live_site.asked) == asked + 5 and not (tmp_path / "out2/images").exists()
        assert web.image(f"{live_site.url}/none.jpg") is None and web.image("no address") is None
    if images.Image is None:
        with pytest.raises(ImportError):
            images.download(got, str(tmp_path / "x"), web.image)


def test_scrolling_stops_when_nothing_is_new():
    class Page:
        shown = 1

        def content(self):
            return " ".join("abcde"[: self.shown])

        def evaluate(self, _):
            self.shown = min(self.shown + 2, 5)

    waits = []
    shots = list(web.scrolls(Page(), site(rate_limit=0.5), str.split, waits.append))
    assert [s[2] for s in shots] == ["a", "a b c", "a b c d e", "a b c d e"] and waits == [0.5] * 3
    assert len(list(web.scrolls(Page(), site(max_listings=3), str.split, waits.append))) == 2
