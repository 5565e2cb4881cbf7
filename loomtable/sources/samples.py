"""Telemetry samples as a streaming source: ``spark.readStream.format("loom_samples")`` over logs that pollers append to."""

from __future__ import annotations

import os
from collections.abc import Iterator
from datetime import datetime

from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

SCHEMA = "host string, ts timestamp, utilization_pct double, memory_used_mb double, memory_total_mb double"


def parsed(host: str, line: bytes) -> tuple | None:
    """A line of a log: ISO time, utilisation, memory used, memory in all; None for a line that is none, as pollers are cut off."""
    cells = line.decode("utf-8", "replace").strip().split(",")
    try:
        return (host, datetime.fromisoformat(cells[0].strip()), *(float(c) for c in cells[1:4])) if len(cells) == 4 else None
    except ValueError:
        return None


class Logs(SimpleDataSourceStreamReader):
    """Samples (S18, X02) by byte offsets into each host's log, so a batch can be read again as it was.

    A trigger takes ``lines`` lines of each log at most, so a reader that was away catches up in steps. A line that is still being written waits for
    its end. Polls are few a second, so they are read where the query is driven; logs may be mounted there alone.
    """

    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.lines = options["path"], int(options.get("lines", "10000"))

    def initialOffset(self) -> dict:
        return {}

    def _taken(self, host: str, start: int, end: int | None) -> tuple[list[bytes], int]:
        found, at = [], start
        with open(os.path.join(self.path, host + ".log"), "rb") as f:
            f.seek(start)
            while (len(found) < self.lines if end is None else at < end) and (line := f.readline()).endswith(b"\n"):
                found.append(line)
                at += len(line)
        return found, at

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        end, rows = dict(start), []
        for name in sorted(os.listdir(self.path)) if os.path.isdir(self.path) else []:
            if name.endswith(".log"):
                host = name.removesuffix(".log")
                found, end[host] = self._taken(host, start.get(host, 0), None)
                rows += [r for line in found if (r := parsed(host, line))]
        return iter(rows), end

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        rows = [parsed(host, line) for host in sorted(end) for line in self._taken(host, start.get(host, 0), end[host])[0]]
        return iter([r for r in rows if r])


class Samples(DataSource):
    """Option ``path``: the folder of logs, one ``<host>.log`` a machine; ``lines``: how many of each a trigger takes."""

    @classmethod
    def name(cls) -> str:
        return "loom_samples"

    def schema(self) -> str:
        return SCHEMA

    def simpleStreamReader(self, schema) -> Logs:
        return Logs(self.options)
