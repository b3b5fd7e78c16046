"""What users call: reading trees into DataFrames, row counts, and direct access to arrays."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .datasource import EventSource
from .options import Options
from .paths import resolve
from .planning import EntryRange, column_plan, count_entries as _count, open_tree as _open
from .reading import ColumnReader
from .rootio.container import EventFile
from .rootio.trees import Tree


def register(spark: SparkSession) -> None:
    """Makes format("root") known to the session."""
    spark.dataSource.register(EventSource)


def read_events(spark: SparkSession, paths: str | list[str], tree: str = "Events", columns: list[str] | None = None, **options) -> DataFrame:
    """A tree of all files of paths (files, folders, globs) as a DataFrame of the columns asked for.

    Session settings spark.datasource.root.* are options too, weaker than those given here.
    """
    register(spark)
    given = {k.removeprefix("spark.datasource.root."): v for k, v in spark.conf.getAll.items() if k.startswith("spark.datasource.root.")}
    given |= {k: str(v) for k, v in options.items()} | {"tree": tree}
    if columns is not None:
        given["columns"] = ",".join(columns)
    return spark.read.format("root").options(**given).load([paths] if isinstance(paths, str) else list(paths))


def count_events(paths: str | list[str], tree: str = "Events") -> int:
    """Rows of all files, from metadata alone."""
    return _count(resolve([paths] if isinstance(paths, str) else paths), tree)


class TreeView:
    """A tree without Spark."""

    def __init__(self, tree: Tree):
        self.tree = tree

    @property
    def entries(self) -> int:
        return self.tree.entries

    @property
    def names(self) -> list[str]:
        return [b.short_name for b in self.tree.branches()]

    def branches(self, *names: str):
        """The named branches, or all; a missing one is an error."""
        return [self.tree.branch(n) for n in names] if names else self.tree.branches()

    def array(self, name: str | tuple[str, ...], start: int = 0, stop: int | None = None) -> pa.Array:
        """Entries [start, stop) of a column."""
        stop = self.entries if stop is None else stop
        if not 0 <= start <= stop <= self.entries:
            raise IndexError(f"entries {start} to {stop} of {self.entries}")
        path = (name,) if isinstance(name, str) else name
        plan = column_plan(self.tree, path).trim(start, stop)
        reader = ColumnReader(self.tree.file, EntryRange(self.tree.file.path, self.tree.name, start, stop, (plan,)), plan, None)
        reader.ask(start, stop)
        return reader.array(start, stop)

    def baskets(self, name: str | tuple[str, ...]) -> list[tuple[int, int, int]]:
        """(first entry, last entry + 1, bytes on disk; 0 if embedded) of a column's baskets."""
        plan = column_plan(self.tree, (name,) if isinstance(name, str) else name)
        sizes = [n for _, n in plan.baskets] + [0] * len(plan.embedded)
        return list(zip(plan.starts[:-1], plan.starts[1:], sizes))

    def iterate(self, names: list[str], rows: int = 65_536) -> Iterator[pa.RecordBatch]:
        for at in range(0, self.entries, rows):
            stop = min(at + rows, self.entries)
            yield pa.RecordBatch.from_arrays([self.array(n, at, stop) for n in names], names)


def open_events(path: str, tree: str = "Events", profile: list | None = None) -> TreeView:
    """A tree for direct reads. profile, a list, gets (level, path, offset, bytes, start, end) of every read: upper as
    asked for, lower as done on the file."""
    return TreeView(Tree(EventFile(path, profile), tree) if profile is not None else _open(path, tree))


def profile_frame(spark: SparkSession, profile: list) -> DataFrame:
    return spark.createDataFrame(profile, "level string, file string, start long, length long, began double, ended double") if profile else spark.createDataFrame([], "level string, file string, start long, length long, began double, ended double")


__all__ = ["Options", "count_events", "open_events", "profile_frame", "read_events", "register"]
