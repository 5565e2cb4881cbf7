"""Latency and telemetry of model serving, from event tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from loomtable.operators.quantiles import percentiles


def percentile(x: Column, p: float) -> Column:
    """Percentile with linear interpolation as an aggregate, for groups that fit in a task; 0.0 without values. ``quantiles`` has one for any group."""
    return F.coalesce(F.percentile(x, F.lit(p / 100)), F.lit(0.0))


def deltas(chunks: DataFrame, request: str = "request_id", order: Sequence[str] = ("ts",), ts: str = "ts") -> DataFrame:
    """``chunks`` with delta_ms since the request's chunk before; null for the first (W02). ``ts`` is in seconds."""
    return chunks.withColumn("delta_ms", (F.col(ts) - F.lag(ts).over(W.partitionBy(request).orderBy(*order))) * 1000)


def requests(chunks: DataFrame, request: str = "request_id", by: Sequence[str] = ()) -> DataFrame:
    """One row a request (A11) from chunks with ts (seconds), start, has_content, usage_tokens (null but at the end).

    Time to the first content, or to the end without any; tokens a second after it, 0 where that is no time; tokens as
    reported, else the number of chunks with content. Sorted gaps of one request are gathered; a request is bounded by
    the model's longest answer.
    """
    gaps = deltas(chunks.where("has_content"), request).where("delta_ms is not null")
    gaps = gaps.groupBy(request).agg(F.transform(F.array_sort(F.collect_list(F.struct("ts", "delta_ms"))), lambda x: x["delta_ms"]).alias("token_latencies_ms"))
    one = chunks.groupBy(request, *by).agg(
        F.min("start").alias("start"), F.min(F.when(F.col("has_content"), F.col("ts"))).alias("first"), F.max("ts").alias("end"),
        F.count_if("has_content").alias("chunks"), F.max("usage_tokens").alias("usage"),
    )
    one = one.withColumn("first", F.coalesce("first", "end")).withColumn("completion_tokens", F.coalesce("usage", "chunks"))
    span = F.col("end") - F.col("first")
    return one.join(gaps, request, "left").select(
        request, *by, ((F.col("first") - F.col("start")) * 1000).alias("ttft_ms"), ((F.col("end") - F.col("start")) * 1000).alias("total_latency_ms"),
        "completion_tokens", F.coalesce("token_latencies_ms", F.array().cast("array<double>")).alias("token_latencies_ms"),
        F.when(span > 0, F.col("completion_tokens") / span).otherwise(0.0).alias("tokens_per_sec"),
    )


def batches(done: DataFrame, by: Sequence[str], ok: str | None = None) -> DataFrame:
    """Aggregates of requests (A10): percentiles, means, failures (F13). Gaps are averaged over all tokens, not over requests."""
    good = F.col(ok) if ok else F.lit(True)
    only = lambda c: F.when(good, F.col(c))
    total = F.sum(F.when(good, F.aggregate("token_latencies_ms", F.lit(0.0), lambda a, x: a + x)))
    count = F.sum(F.when(good, F.size("token_latencies_ms")))
    shares = {f"p{p}_{short}_ms": (only(c), p) for c, short in (("total_latency_ms", "latency"), ("ttft_ms", "ttft")) for p in (50, 95, 99)}
    ranked = percentiles(done, by, shares).select(F.struct(*by, F.lit(0).alias("__all")).alias("__g"), *shares)
    rest = done.groupBy(*by).agg(
        F.coalesce(F.avg(only("tokens_per_sec")), F.lit(0.0)).alias("avg_tokens_per_sec"),
        F.coalesce(F.when(count > 0, total / count), F.lit(0.0)).alias("avg_per_token_latency_ms"),
        F.coalesce(F.avg(only("completion_tokens")), F.lit(0.0)).alias("avg_completion_tokens"),
        F.count_if(good).alias("requests"), F.count_if(~good).alias("failed_requests"),
    )
    both = rest.withColumn("__g", F.struct(*by, F.lit(0).alias("__all"))).join(ranked, "__g", "left")
    last = ["avg_tokens_per_sec", "avg_per_token_latency_ms", "avg_completion_tokens", "requests", "failed_requests"]
    return both.select(*by, *[F.coalesce(n, F.lit(0.0)).alias(n) for n in shares], *last)


def gpu(samples: DataFrame) -> DataFrame:
    """Peak memory, mean utilisation and last total (A12); 0.0 without samples."""
    zero = F.lit(0.0)
    return samples.agg(
        F.coalesce(F.max("memory_used_mb"), zero).alias("peak_memory_mb"), F.coalesce(F.avg("utilization_pct"), zero).alias("avg_utilization_pct"),
        F.coalesce(F.max_by("memory_total_mb", "ts"), zero).alias("total_memory_mb"), F.count("*").alias("samples"),
    )


def speedup(cold: Column, warm: Column) -> Column:
    """How many times faster; 0 if there is nothing to divide by."""
    return F.when(warm > 0, cold / warm).otherwise(0.0)


def errors(rows: DataFrame, failed: str, seconds: str) -> DataFrame:
    """Failures, and mean time of all samples."""
    return rows.agg(F.count_if(failed).alias("errors"), (F.sum(seconds) / F.greatest(F.count("*"), F.lit(1))).alias("mean_seconds"))


_SCALING = ("Concurrency", "Wall clock (ms)", "p50 latency (ms)", "p95 latency (ms)", "p99 latency (ms)", "p50 TTFT (ms)", "Throughput (tok/s)", "Failed")


def _grid(head: Sequence[str], rows: Sequence[Sequence[str]]) -> list[str]:
    line = lambda cells: "| " + " | ".join(cells) + " |"
    return [line(head), "|" + "|".join("-" * (len(h) + 1) for h in head) + "|", *map(line, rows), ""]


def report(variants: Sequence[dict], gpu_row: dict | None, config: dict) -> str:
    """Markdown latency report (G08). A variant has label, prompt_chars, cold (a request), warm (a batch), scaling
    (batch by concurrency); batches have wall_clock_ms besides what ``batches`` gives."""
    out = ["# Latency Benchmark Report", "", *[f"**{k}**: {v}" for k, v in config.items()], "", "## GPU Utilization", ""]
    if gpu_row and gpu_row["samples"]:
        out += _grid(("Metric", "Value"), [
            ("Peak memory", f"{gpu_row['peak_memory_mb']:.0f} MB / {gpu_row['total_memory_mb']:.0f} MB"),
            ("Avg utilization", f"{gpu_row['avg_utilization_pct']:.1f}%"), ("Samples collected", str(gpu_row["samples"])),
        ])
    else:
        out += ["*GPU monitoring unavailable*", ""]
    out += ["## Prompts Tested", "", *_grid(("Prompt", "Length (chars)"), [(v["label"], str(v["prompt_chars"])) for v in variants])]
    out += ["## Cold vs Warm Cache Latency", ""]
    for v in variants:
        cold, warm = v.get("cold"), v.get("warm")
        out += [f"### {v['label']}", ""]
        if not (cold and warm):
            out += ["*No data collected*", ""]
            continue
        faster = lambda a, b: f"{a / b if b > 0 else 0:.1f}x"
        gaps = cold["token_latencies_ms"]
        out += _grid(("Metric", "Cold (1st req)", "Warm p50", "Warm p95", "Warm p99", "Speedup"), [
            (label, f"{cold[c]:.1f}", *(f"{warm[f'p{p}_{short}_ms']:.1f}" for p in (50, 95, 99)), faster(cold[c], warm[f"p50_{short}_ms"]))
            for label, c, short in (("TTFT (ms)", "ttft_ms", "ttft"), ("Total latency (ms)", "total_latency_ms", "latency"))
        ] + [
            ("Tokens/sec", f"{cold['tokens_per_sec']:.1f}", f"{warm['avg_tokens_per_sec']:.1f}", "—", "—", "—"),
            ("Per-token latency (ms)", f"{sum(gaps) / len(gaps):.2f}" if gaps else "—", f"{warm['avg_per_token_latency_ms']:.2f}", "—", "—", "—"),
            ("Completion tokens", str(cold["completion_tokens"]), f"{warm['avg_completion_tokens']:.0f} (avg)", "—", "—", "—"),
        ])
    out += ["## Batch Scaling", ""]
    for v in variants:
        levels = ({1: v["warm"]} if v.get("warm") else {}) | dict(sorted((v.get("scaling") or {}).items()))
        out += [f"### {v['label']}", ""]
        cells = [
            (str(c), f"{b['wall_clock_ms']:.0f}", *(f"{b[k]:.1f}" for k in ("p50_latency_ms", "p95_latency_ms", "p99_latency_ms", "p50_ttft_ms", "avg_tokens_per_sec")), str(b["failed_requests"]))
            for c, b in levels.items()
        ]
        out += _grid(_SCALING, cells) if cells else ["*No data collected*", ""]
    out += ["## Token Generation Throughput", ""]
    out += _grid(("Prompt", "Warm tok/s (single)", "Warm per-token (ms)", "Avg completion tokens"), [
        (v["label"], f"{w['avg_tokens_per_sec']:.1f}", f"{w['avg_per_token_latency_ms']:.2f}", f"{w['avg_completion_tokens']:.0f}") for v in variants if (w := v.get("warm"))
    ])
    return "\n".join(out)
