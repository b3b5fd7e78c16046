"""Options of the source: typed, with defaults, looked up whatever their case."""

from __future__ import annotations

import json
import warnings
from dataclasses import dataclass
from typing import Any

KNOWN = {"tree": str, "threadcount": int, "path": str, "paths": str, "columns": str, "entriesperpartition": int, "uint64": str, "batchrows": int, "codec": str, "types": str, "planning": str, "ranges": str}
DEFAULTS = {"tree": "Events", "threadcount": 16, "entriesperpartition": 200_000, "uint64": "wrap", "batchrows": 65_536, "planning": "auto", "ranges": "file"}


class OptionError(ValueError):
    pass


@dataclass(frozen=True)
class Options:
    tree: str
    threads: int
    paths: tuple[str, ...]
    columns: tuple[str, ...] | None
    entries_per_partition: int
    uint64: str
    batch_rows: int
    planning: str
    ranges: str = "file"

    @staticmethod
    def parse(given: dict[str, Any]) -> Options:
        low = {k.lower(): v for k, v in given.items()}
        for name in low:
            if name not in KNOWN:
                warnings.warn(f"unknown option {name}", stacklevel=2)

        def value(name: str):
            raw = low.get(name, DEFAULTS.get(name))
            if raw is None:
                return None
            try:
                return KNOWN[name](raw)
            except ValueError as e:
                raise OptionError(f"option {name}: {raw!r} is no {KNOWN[name].__name__}") from e

        paths = list(json.loads(low["paths"])) if low.get("paths") else []
        if low.get("path"):
            paths.append(low["path"])
        per, threads = value("entriesperpartition"), value("threadcount")
        if per < 1 or threads < 0 or value("batchrows") < 1:
            raise OptionError("entriesPerPartition and batchRows must be positive, threadCount not negative")
        if value("uint64") not in ("wrap", "decimal"):
            raise OptionError("uint64 must be wrap or decimal")
        if value("planning") not in ("auto", "driver", "executor"):
            raise OptionError("planning must be auto, driver or executor")
        if value("ranges") not in ("file", "all") or value("ranges") == "all" and value("planning") == "executor":
            raise OptionError("ranges must be file or all, and all is planned on the driver")
        columns = low.get("columns")
        names = tuple(c.strip() for c in columns.split(",") if c.strip()) if columns is not None else None
        return Options(value("tree"), threads, tuple(sorted(paths)), names, per, value("uint64"), value("batchrows"), value("planning"), value("ranges"))

    def need_paths(self) -> Options:
        if not self.paths:
            raise OptionError("no path given")
        return self
