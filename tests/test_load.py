import itertools

from loomtable.operators import latency, load
from loomtable.sources import sinks
from pyspark.sql import functions as F


def test_measure():
    ticks = itertools.count(0, 0.5)
    got = load.measure([(None, None), ("a", None), ("b", None), (None, {"prompt_tokens": 7, "completion_tokens": 3})], lambda: next(ticks))
    assert got == {"ttft_ms": 500.0, "total_latency_ms": 1500.0, "prompt_tokens": 7, "completion_tokens": 3, "token_latencies_ms": [500.0], "tokens_per_sec": 3.0}
    assert load.measure([])["completion_tokens"] == 0


def test_run(spark):
    asked = []

    def ask(record):
        asked.append(record)
        if record == "bad":
            raise OSError
        return [("x", None), ("y", None)]

    rows = load.frame(spark, load.run(ask, ["a", "b", "bad"], "p", levels=(2,), iterations=3, warmup=1, requests=6))
    assert asked[:5] == ["a", "a", "b", "bad", "a"]
    got = {r.concurrency: r for r in latency.batches(rows, ["concurrency"], ok="ok").collect()}
    assert got[0].requests == 1 and (got[1].requests, got[1].failed_requests) == (2, 1) and (got[2].requests, got[2].failed_requests) == (4, 2)
    assert rows.groupBy("concurrency").agg(F.countDistinct("wall_clock_ms").alias("n")).where("n > 1").count() == 0


def test_gpu():
    assert load.parse_smi("50, 100, 8188\nbad\n1, 2\n", 3.0) == [(3.0, 50.0, 100.0, 8188.0)]
    with load.gpu_monitor(0.01, lambda: "1, 2, 3\n") as samples:
        while not samples:
            pass
    assert samples[0][1:] == (1.0, 2.0, 3.0)
    with load.gpu_monitor(read=lambda: None) as none:
        pass
    assert none == []


def test_console():
    lines = sinks.result_lines({"exact_match": 0.5, "per_attribute": {"a": 1.0}, "category_breakdown": None, "total_samples": 4})
    assert lines[0].endswith("50.0%") and lines[-1].endswith("4") and len(lines) == 3
