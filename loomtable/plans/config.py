"""Settings of the command line: sections of YAML files, checked on the driver, read as attributes."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from pathlib import Path
from types import MappingProxyType

import yaml

from loomtable.plans.schema import INSTRUCTION

NEEDED = object()
#: The keys that files may have in each section, and what an absent one means (fixed values: the file format).
KEYS: dict[str, dict[str, object]] = {
    "pagination": {"max_pages": 100, "selector": None, "type": "next_link", "url_pattern": None},
    "site": {
        "base_url": NEEDED, "detail_selectors": NEEDED, "headers": {}, "listing_selector": NEEDED, "max_listings": None, "name": NEEDED,
        "pagination": {}, "rate_limit": 1.0, "use_playwright": False, "wait_for_selector": None,
    },
    "dataset": {
        "category_field": None, "deduplicate": True, "min_samples": 10, "schema_path": NEEDED, "split_ratio": (0.8, 0.1, 0.1),
        "system_prompt": INSTRUCTION, "text_only": False,
    },
    "evaluation": {
        "batch_concurrency": 8, "compare_with": (), "model_name": "default", "output_dir": "reports/", "schema_path": NEEDED,
        "server_url": "http://localhost:8000", "test_data_path": NEEDED,
    },
    "server": {"dtype": "auto", "gpu_memory_utilization": 0.9, "host": "0.0.0.0", "max_model_len": None, "model": NEEDED, "port": 8000, "quantization": None},
    "pipeline": {"dataset": None, "evaluation": None, "site": None},
}
#: Ways from one index page to the next (fixed values: the file format).
WAYS = ("next_link", "page_number", "infinite_scroll")


class Settings(Mapping):
    """Checked values of one section; unknown keys are left out and a needed one that is absent raises."""

    def __init__(self, section: str, given: Mapping | None = None, **more: object):
        given = {**(given or {}), **more}
        values: dict[str, object] = {}
        for key, default in KEYS[section].items():
            value = given.get(key, default)
            if value is NEEDED:
                raise TypeError(f"{section}: {key} is needed")
            if key in KEYS and isinstance(value, Mapping) and not isinstance(value, Settings):
                value = Settings(key, value)
            values[key] = tuple(value) if isinstance(value, list) else value
        for key, check in CHECKS.get(section, {}).items():
            values[key] = check(values[key])
        self.__dict__.update(section=section, values=MappingProxyType(values))

    def __getattr__(self, key: str):
        try:
            return self.__dict__["values"][key]
        except KeyError:
            raise AttributeError(key) from None

    def __setattr__(self, key: str, value: object) -> None:
        raise AttributeError("settings do not change; see but()")

    def __getitem__(self, key: str):
        return self.values[key]

    def __iter__(self) -> Iterator[str]:
        return iter(self.values)

    def __len__(self) -> int:
        return len(self.values)

    def __reduce__(self):  # a read-only view can't be sent to workers as it is
        return Settings, (self.section, dict(self.values))

    def but(self, **changes: object) -> Settings:
        """The same with some values changed, checked again."""
        return Settings(self.section, {**self.values, **changes})


def shares(given: object) -> tuple[float, float, float]:
    """Split shares (F11): train, val and test, none below nothing, the whole together."""
    try:
        train, val, test = (float(x) for x in given)
    except (TypeError, ValueError):
        raise ValueError(f"a split needs three shares, not {given!r}") from None
    if min(train, val, test) < 0 or not 1 - 1e-6 <= train + val + test <= 1 + 1e-6:
        raise ValueError(f"shares {given!r} don't make a whole")
    return train, val, test


def way(given: object) -> object:
    if given not in WAYS:
        raise ValueError(f"{given!r} is no way through index pages; there are {', '.join(WAYS)}")
    return given


CHECKS: dict[str, dict[str, Callable]] = {"dataset": {"split_ratio": shares}, "pagination": {"type": way}}


def load(path: str | Path, section: str) -> Settings:
    """A section from a YAML file (S05): FileNotFoundError if there is none; an empty file has no values."""
    with open(path, encoding="utf-8") as f:
        return Settings(section, yaml.safe_load(f))


def check_enough(kept: int, least: int) -> None:
    """Stops a run that kept too few rows."""
    if kept < least:
        raise SystemExit(f"only {kept} rows are left; at least {least} are needed")


def serve_command(server: Settings) -> list[str]:
    """The command that would start the model server (C10); running it is outside the engine."""
    options = {"--host": server.host, "--port": server.port, "--dtype": server.dtype, "--gpu-memory-utilization": server.gpu_memory_utilization}
    options |= {"--max-model-len": server.max_model_len, "--quantization": server.quantization}
    return ["vllm", "serve", server.model, *(str(x) for k, v in options.items() if v is not None for x in (k, v))]
