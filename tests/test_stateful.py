"""Streams in several arrivals, started again from their checkpoint each time."""

import json
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from loomtable.plans.schema import LISTING, bikes
from loomtable.sources import samples
from loomtable.streaming import live, stateful


def arrive(spark, tmp_path, k, rows, shape, make, mode="append"):
    """Rows come in as a file; the stream runs over what is new. All its output so far."""
    (tmp_path / "in").mkdir(exist_ok=True)
    (tmp_path / f"in/{k}.json").write_text("\n".join(map(json.dumps, rows)))
    stateful.run_arrived(make(spark.readStream.schema(shape).json(str(tmp_path / "in"))), str(tmp_path / "out"), str(tmp_path / "check"))
    return spark.read.parquet(str(tmp_path / "out")).collect()


def test_a_repeat_never_passes_however_late(spark, tmp_path):
    shape = "seq long, url string, ts string"
    make = lambda s: stateful.first_wins(s, ["url"], "seq")
    got = [
        arrive(spark, tmp_path, k, [{"seq": s, "url": u, "ts": t} for s, u, t in rows], shape, make)
        for k, rows in enumerate([[(3, "a", "2024"), (1, "a", "2024"), (2, "b", "2024"), (4, None, "2024")], [(5, "a", "2031"), (7, "c", "2031"), (6, "c", "2031"), (8, None, "2031")], [(0, "b", "1999"), (9, "d", "1999")]])
    ]
    assert [sorted((r.seq, r.url) for r in g if r.url) for g in got] == [[(1, "a"), (2, "b")], [(1, "a"), (2, "b"), (6, "c")], [(1, "a"), (2, "b"), (6, "c"), (9, "d")]]
    assert [r.seq for r in got[-1] if r.url is None] == [4]


def test_listings_are_cleaned_as_they_arrive(spark, tmp_path):
    row = lambda seq, title, maker: {"seq": seq, "url": "", "title": title, "image_urls": [], "attributes": {"maker": maker, "frame": "1"}}
    make = lambda s: stateful.distinct_listings(s, bikes())
    arrive(spark, tmp_path, 0, [row(1, "X", "Vela"), row(2, " X ", "Vela"), row(3, "", "Vela"), row(4, "Y", "Nokia")], LISTING, make)
    got = arrive(spark, tmp_path, 1, [row(5, "X", "Vela"), row(6, "Y", "Vela")], LISTING, make)
    assert sorted(r.seq for r in got) == [1, 6]


def test_requests_end_by_usage_or_silence(spark, tmp_path):
    begin = datetime(2024, 1, 1)

    def chunk(request, seconds, content=True, usage=None):
        return {"request_id": request, "ts": (begin + timedelta(seconds=seconds)).isoformat() + "Z", "start": begin.isoformat() + "Z", "has_content": content, "usage_tokens": usage}

    shape = "request_id string, ts timestamp, start timestamp, has_content boolean, usage_tokens int"
    make = lambda s: stateful.requests(s, silence="60 seconds", late="10 seconds")
    first = arrive(spark, tmp_path, 0, [chunk("a", 1), chunk("a", 2), chunk("b", 1, False), chunk("b", 2), chunk("c", 3)], shape, make)
    assert first == []
    second = {r.request_id: r for r in arrive(spark, tmp_path, 1, [chunk("a", 4), chunk("a", 5, False, 9), chunk("b", 6)], shape, make)}
    assert set(second) == {"a"}  # its usage came, in another batch than its first chunks
    a = second["a"]
    assert (a.ttft_ms, a.total_latency_ms, a.completion_tokens, a.token_latencies_ms, a.tokens_per_sec) == (1000.0, 5000.0, 9, [1000.0, 2000.0], 9 / 4)
    arrive(spark, tmp_path, 2, [chunk("d", 200)], shape, make)
    third = {r.request_id: r for r in arrive(spark, tmp_path, 3, [chunk("d", 201, False, 1)], shape, make)}
    assert set(third) == {"a", "b", "c", "d"}  # b and c were silent for a minute
    assert (third["b"].ttft_ms, third["b"].completion_tokens, third["b"].token_latencies_ms) == (2000.0, 2, [4000.0])
    assert (third["c"].completion_tokens, third["c"].tokens_per_sec) == (1, 0.0)


def test_samples_are_neither_lost_nor_repeated(spark, tmp_path):
    """A source with offsets: lines appended between runs, a line in the making, a limit a trigger, and a restart."""
    logs, sizes = tmp_path / "logs", []
    logs.mkdir()
    spark.dataSource.register(samples.Samples)

    def append(host, numbers, tail=""):
        with open(logs / f"{host}.log", "a") as f:
            f.write("".join(f"2024-01-01T00:00:{n:02}+00:00,{n}.5,{n * 10},80000\n" for n in numbers) + tail)

    def run():
        def keep(df, k):
            sizes.append(df.count())
            df.write.mode("append").parquet(str(tmp_path / "out"))

        stream = spark.readStream.format("loom_samples").option("path", str(logs)).option("lines", "4").load()
        q = stream.writeStream.foreachBatch(keep).option("checkpointLocation", str(tmp_path / "check")).start()
        q.processAllAvailable()
        q.stop()

    append("a", range(10))
    append("b", range(3), "oops\n2024-01-01T00:00:4")
    run()
    assert max(sizes) <= 8
    append("b", [], "0+00:00,1,2,3\n")
    append("a", range(10, 15))
    append("c", [1])
    run()
    run()
    got = [(r.host, r.utilization_pct) for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert sorted(got) == sorted([("a", n + 0.5) for n in range(15)] + [("b", n + 0.5) for n in range(3)] + [("b", 1.0), ("c", 1.5)])
    stream = spark.readStream.format("loom_samples").option("path", str(logs)).load()
    q = live.telemetry(stream, "10 seconds").writeStream.format("memory").queryName("seen").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("seen").agg(F.sum("samples"), F.max("peak_memory_mb")).first()[:] == (20, 140.0)
