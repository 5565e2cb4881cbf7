"""Percentiles by bins against numpy."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomtable.operators import latency
from loomtable.operators.quantiles import percentiles


def draws(rng, n):
    kinds = {
        "flat": lambda: rng.random(), "ties": lambda: float(rng.randrange(3)), "far": lambda: rng.choice([1e-300, 1e300, -1e300, 0.0, 5e-324]) * rng.random(),
        "signs": lambda: rng.gauss(0, 1e6), "one": lambda: 7.5, "near": lambda: 1.0 + rng.randrange(50) * 2.0 ** -52, None: lambda: rng.lognormvariate(0, 8), "inf": lambda: rng.choice([math.inf, 1.0, -math.inf, 2.0]),
    }
    return [(k, f(), rng.random() if k == "flat" else None) for k, f in kinds.items() for _ in range(n)] + [("few", 3.0, None), ("few", 9.0, None), ("none", None, 4.0), ("flat", None, None), ("flat", math.nan, None)]


@pytest.mark.parametrize(("at_once", "bins"), [(100_000, 1024), (20, 8)])
def test_percentiles_are_numpys(spark, at_once, bins):
    rows = draws(random.Random(1), 300)
    df = spark.createDataFrame(rows, "k string, x double, y double").repartition(5)
    wanted = {f"p{p}": (F.col("x"), p) for p in (0, 1, 50, 95, 99.9, 100)} | {"y50": (F.col("y") * 2, 50)}
    got = {r.k: r for r in percentiles(df, ["k"], wanted, at_once, bins).collect()}
    assert set(got) == {k for k, *_ in rows}
    for k, r in got.items():
        x = sorted(v for g, v, _ in rows if g == k and v is not None and not math.isnan(v))
        y = [2 * v for g, _, v in rows if g == k and v is not None]
        for name, (_, p) in wanted.items():
            of = y if name == "y50" else x
            if k == "inf" and name != "y50":
                at = (len(of) - 1) * p / 100
                if at != int(at) and not math.isfinite(of[int(at)] + of[int(at) + 1]):
                    continue
                assert r[name] == of[round(at)] or math.isfinite(r[name])
            elif of:
                assert r[name] == pytest.approx(float(np.percentile(of, p)), rel=1e-12, abs=1e-320), (k, name)
            else:
                assert r[name] is None


def test_whole_tables_and_nothing(spark):
    df = spark.range(1001).select((F.col("id") * 1.0).alias("x"))
    assert tuple(percentiles(df, [], {"a": (F.col("x"), 25), "b": (F.col("x"), 99.95)}, 10, 4).first()) == (250.0, 999.5)
    assert percentiles(df.where("x < 0"), [], {"a": (F.col("x"), 25)}).count() == 0


def test_batches_keep_groups_without_success(spark):
    rows = [("a", 10.0 * i, 1.0 * i, 5, [1.0, 2.0], 3.0, i % 3 != 0) for i in range(30)] + [("b", 1.0, 1.0, 1, [], 0.0, False), (None, 4.0, 2.0, 2, [1.0], 8.0, True)]
    df = spark.createDataFrame(rows, "k string, total_latency_ms double, ttft_ms double, completion_tokens long, token_latencies_ms array<double>, tokens_per_sec double, ok boolean")
    got = {r.k: r for r in latency.batches(df, ["k"], ok="ok").collect()}
    good = [r[1] for r in rows if r[0] == "a" and r[6]]
    assert got["a"].p95_latency_ms == pytest.approx(np.percentile(good, 95)) and (got["a"].requests, got["a"].failed_requests) == (20, 10)
    assert (got["b"].p99_ttft_ms, got["b"].requests, got["b"].failed_requests) == (0.0, 0, 1) and got[None].p50_latency_ms == 4.0
