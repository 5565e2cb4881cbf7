"""Command line: scrape, prepare, evaluate, predict (training and serving are outside the engine)."""

from __future__ import annotations

import argparse
import json
import shlex
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from loomtable.operators import chat, clean, compare, images, metrics, pages, predict, split
from loomtable.plans import config as C
from loomtable.plans.schema import MANIFEST, load_schema
from loomtable.session import session
from loomtable.sources import files, sinks, web


def prepare(spark: SparkSession, cfg: C.Settings, raw: str, out: str, image_dir: str | None = None) -> dict[str, int]:
    """Raw listings to formatted splits (C02): clean, guard, split, format, write. Returns the rows of each split."""
    schema = load_schema(cfg.schema_path)
    rows = clean.with_reason(files.read_listings(spark, raw), schema, deduplicate=cfg.deduplicate, require_images=not cfg.text_only)
    seen = Observation()
    rows.observe(seen, *clean.counters()).write.mode("overwrite").parquet(f"{out}/_cleaned")  # counted as it is written
    rows = spark.read.parquet(f"{out}/_cleaned")
    C.check_enough(seen.get.get("kept") or 0, cfg.min_samples)
    kept = rows.where("drop_reason is null").drop("drop_reason", "content_hash")
    category = cfg.category_field
    keyed = kept.withColumn("__c", F.col("attributes")[category]) if category else kept
    parts = split.split(keyed, "seq", cfg.split_ratio, "__c" if category else None)
    image = None
    if image_dir and not cfg.text_only:
        listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(image_dir).select(F.regexp_replace("path", "^file:", "").alias("path"))
        parts, image = chat.resolve_images(parts, listing, image_dir), "image"
    made = chat.messages(parts, schema, cfg.system_prompt, text_only=cfg.text_only, image=image)
    lines = made.select("seq", "split", chat.message_json(F.col("messages")).alias("value"))
    places = split.reshuffled(parts.select("seq", "split"), "seq")
    lines = lines.join(places.select("seq", "place"), "seq").repartitionByRange("split", "place").sortWithinPartitions("split", "place").select("split", "value")
    counted = sinks.counts_of()
    counted.on(lines).write.mode("overwrite").partitionBy("split").text(f"{out}/splits")
    return counted.get()


def scrape(
    spark: SparkSession, site: C.Settings, out: str, pages_table: DataFrame | None = None, *, pictures: bool = True,
    fetch_image: Callable = web.image, raw_images: bool = False,
) -> DataFrame:
    """A site's listings, written as JSON lines (C03, C04), then, with ``pictures``, their images and manifest.

    Over stored pages, or live: index pages are walked on the driver, one after another as their links tell, ``max_pages`` at
    most, and written; the listings' pages are fetched by tasks from a table of addresses and written too, so no page is
    fetched twice.
    """
    if pages_table is None:
        if site.pagination.type == "page_number":
            fronts = web.fetched(pages.numbered_pages(spark, site.pagination, site.base_url), site)
        else:
            with web.plain(site) as get:
                fronts = spark.createDataFrame(list(web.walk(site, get, lambda html, url: pages.index(html, url, site.listing_selector, site.pagination)[1])), "url string, html string")
        fronts.write.mode("overwrite").parquet(f"{out}/_fronts")
        fronts = spark.read.parquet(f"{out}/_fronts")
        links = pages.unseen(pages.indexes(fronts, site).select(F.explode("listing_urls").alias("url")), fronts)
        web.fetched(links, site).write.mode("overwrite").parquet(f"{out}/_pages")
        pages_table = fronts.unionByName(spark.read.parquet(f"{out}/_pages"))
    sinks.write_jsonl(pages.crawl(pages_table, site), f"{out}/listings")
    found = files.read_listings(spark, f"{out}/listings")
    if pictures:
        made = images.download(found, f"{out}/images", fetch_image, raw=raw_images)
        sinks.write_manifest(made, f"{out}/_manifest", lines=True)
        sinks.write_manifest(spark.read.schema(MANIFEST).json(f"{out}/_manifest"), f"{out}/images/manifest.json")
    return found


def evaluate(spark: SparkSession, cfg: C.Settings, predictor: predict.Predictor | None = None, compare_with: tuple[str, ...] = ()) -> dict:
    """Predictions of a test file and their metrics (C06), the report against other results."""
    schema = load_schema(cfg.schema_path)
    rows = chat.unify(files.numbered_lines(spark, cfg.test_data_path).where(F.trim("value") != "").select("seq", F.from_json("value", files.CONTENT, {"mode": "FAILFAST"}).alias("r")).select("seq", "r.*"))
    call = predictor or predict.retried(predict.server(schema, cfg.server_url, cfg.model_name))
    predict.predict(rows, call, cfg.batch_concurrency).write.mode("overwrite").parquet(f"{cfg.output_dir}/_predicted")  # the model is asked once
    got = spark.read.parquet(f"{cfg.output_dir}/_predicted")
    pairs = metrics.paired(got, rows)
    result = metrics.evaluate(pairs, schema.names, schema.category_field)
    out = Path(cfg.output_dir)
    sinks.write_json(result, out / "eval_result.json")
    sinks.write_jsonl(pairs.orderBy("seq").select("prediction", "ground_truth"), str(out / "predictions"))
    others = [(f"run_{i}", files.load_result(p)) for i, p in enumerate(compare_with or cfg.compare_with, 1)]
    if others:
        sinks.put(out / "comparison.md", compare.report([("current", result), *others]))
    return result


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser("loomtable", description=__doc__)
    verbs = parser.add_subparsers(dest="verb", required=True)
    p = verbs.add_parser("prepare")
    for name, need in (("--config", True), ("--raw-data", True), ("--output-dir", True), ("--image-dir", False)):
        p.add_argument(name, required=need)
    p = verbs.add_parser("scrape")
    for name, need in (("--config", True), ("--output-dir", True), ("--pages", False)):
        p.add_argument(name, required=need)
    p.add_argument("--max-listings", type=int)
    p.add_argument("--no-images", action="store_true")
    p = verbs.add_parser("evaluate")
    p.add_argument("--config", required=True)
    p.add_argument("--compare-with", action="append", default=[])
    p = verbs.add_parser("predict")
    for name, need in (("--title", True), ("--schema", True), ("--server-url", False)):
        p.add_argument(name, required=need)
    verbs.add_parser("serve").add_argument("--config", required=True)
    a = parser.parse_args(args)
    if a.verb == "serve":  # C10: the command; starting it is outside the engine
        print(shlex.join(C.serve_command(C.load(a.config, "server"))))
        return 0
    if a.verb == "predict":  # C09: one row needs no cluster
        schema = load_schema(a.schema)
        print(json.dumps(predict.retried(predict.server(schema, a.server_url or "http://localhost:8000"))(a.title), ensure_ascii=False, indent=2))
        return 0
    spark = session()
    if a.verb == "prepare":
        print(prepare(spark, C.load(a.config, "dataset"), a.raw_data, a.output_dir, a.image_dir))
    elif a.verb == "scrape":
        site = C.load(a.config, "site")
        if a.max_listings is not None:
            site = site.but(max_listings=a.max_listings)
        scrape(spark, site, a.output_dir, spark.read.parquet(a.pages) if a.pages else None, pictures=not a.no_images)
    else:
        result = evaluate(spark, C.load(a.config, "evaluation"), compare_with=tuple(a.compare_with))
        print(json.dumps(result, indent=2))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
