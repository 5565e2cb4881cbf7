"""Predictions through a pluggable predictor: the boundary to model serving."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from urllib.request import Request, urlopen

import pyarrow as pa
from pyspark.sql import DataFrame

from loomtable.plans.schema import INSTRUCTION, Schema, json_schema, system_prompt

#: title -> attributes
Predictor = Callable[[str], dict]


def retried(call: Predictor, attempts: int = 3, wait: Callable[[float], None] = time.sleep) -> Predictor:
    """``call`` with pauses of 1, 2, 4 ... seconds between failures; the last failure raises."""

    def run(title: str) -> dict:
        for k in range(attempts):
            try:
                return call(title)
            except Exception as e:  # noqa: BLE001
                if k + 1 == attempts:
                    raise RuntimeError(f"prediction failed after {attempts} attempts: {e}") from e
                wait(2.0**k)
        raise ValueError("attempts must be 1 or more")

    return run


def server(schema: Schema, url: str = "http://localhost:8000", model: str = "default", timeout: float = 30.0, prompt: str | None = None) -> Predictor:
    """A predictor over an OpenAI-style chat endpoint, constrained by the schema's JSON Schema."""
    system = prompt or system_prompt(schema, INSTRUCTION)
    guided = json_schema(schema)

    def call(title: str) -> dict:
        body = {
            "model": model, "temperature": 0.0, "guided_json": guided,
            "messages": [{"role": "system", "content": system}, {"role": "user", "content": f'Title: "{title}"'}],
        }
        request = Request(url.rstrip("/") + "/v1/chat/completions", json.dumps(body).encode(), {"Content-Type": "application/json"})
        with urlopen(request, timeout=timeout) as answer:  # noqa: S310  the configured server
            return json.loads(json.load(answer)["choices"][0]["message"]["content"] or "{}")

    return call


def predict(rows: DataFrame, predictor: Predictor, concurrency: int = 8, seq: str = "seq") -> DataFrame:
    """seq, prediction of rows (seq, title) (J10): each task asks ``concurrency`` at a time; one failure fails the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with ThreadPoolExecutor(concurrency) as pool:
            for b in batches:
                made = list(pool.map(predictor, b.column(1).to_pylist()))
                maps = [[(str(k), None if v is None else v if isinstance(v, str) else json.dumps(v)) for k, v in m.items()] for m in made]
                yield pa.record_batch([b.column(0), pa.array(maps, pa.map_(pa.string(), pa.string()))], names=[seq, "prediction"])

    kind = rows.schema[seq].dataType.simpleString()
    return rows.select(seq, "title").mapInArrow(run, f"{seq} {kind}, prediction map<string,string>")
