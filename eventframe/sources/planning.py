"""Partitions: entry ranges of files, or of all files as one table, each with the baskets of the requested columns that it overlaps."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import types as T
from pyspark.sql.datasource import InputPartition

from .options import Options
from .paths import size_of
from .rootio.container import FILES
from .rootio.trees import Tree
from .schema import leaves

PLANNERS = 16
#: With planning=auto, so many files are opened by the driver at most; of more, each is one partition that its task plans.
DRIVER_FILES = 4096


@dataclass(frozen=True)
class ColumnPlan:
    """Where a leaf column's values are: disk baskets as (seek, bytes), then embedded ones by number."""

    path: tuple[str, ...]
    type_name: str
    kind: str
    length: int
    skip: int
    starts: tuple[int, ...]  # first entry of each basket, and a cap
    baskets: tuple[tuple[int, int], ...]
    embedded: tuple[int, ...]

    def trim(self, start: int, stop: int) -> ColumnPlan:
        lo, hi = overlap(self.starts, start, stop)
        n = len(self.baskets)
        return ColumnPlan(self.path, self.type_name, self.kind, self.length, self.skip, self.starts[lo : hi + 1], self.baskets[lo:hi], self.embedded[max(0, lo - n) : max(0, hi - n)])


def overlap(starts: tuple[int, ...] | list[int], start: int, stop: int) -> tuple[int, int]:
    """Which baskets [lo, hi) hold entries of [start, stop)."""
    if stop <= start or len(starts) < 2:
        return 0, 0
    lo = max(0, bisect_right(starts, start, 0, len(starts) - 1) - 1)
    return lo, max(lo, bisect_left(starts, stop, 0, len(starts) - 1))


#: The end of a range that is a whole file, whatever it holds.
#: A file that a task looks at itself is cut into slices of about so many bytes; the k-th of n has start k and stop -n.
SLICE_BYTES = 64 << 20


@dataclass
class EntryRange(InputPartition):
    file: str
    tree: str
    start: int
    stop: int
    columns: tuple[ColumnPlan, ...]

    def __init__(self, file: str, tree: str, start: int, stop: int, columns: tuple[ColumnPlan, ...]):
        super().__init__(None)
        self.file, self.tree, self.start, self.stop, self.columns = file, tree, start, stop, columns


@dataclass
class EntryRanges(InputPartition):
    """Neighbouring ranges of several files, read in order."""

    ranges: tuple[EntryRange, ...]

    def __init__(self, ranges: tuple[EntryRange, ...]):
        super().__init__(None)
        self.ranges = ranges


def open_tree(path: str, name: str) -> Tree:
    """A tree, decoded once per process and file state."""
    file = FILES.get(path)
    trees = file.__dict__.setdefault("trees", {})
    if name not in trees:
        trees[name] = Tree(file, name)
    return trees[name]


def column_plan(tree: Tree, path: tuple[str, ...]) -> ColumnPlan:
    b = tree.branch(path)
    p, shape = b.primitive, b.shape
    loose, starts, kept = b.baskets()
    return ColumnPlan(path, p.name, shape.kind, shape.length, shape.skip, tuple(starts), tuple(loose), tuple(kept))


def plan_file(path: str, name: str, columns: list[tuple[str, ...]], per: int, first: int = 0, last: int | None = None, lead: int = 0) -> list[EntryRange]:
    """Ranges of at most per entries from first to last (by default all); the first one is shorter by lead."""
    tree = open_tree(path, name)
    plans, last = [column_plan(tree, c) for c in columns], tree.entries if last is None else last
    edges = [(max(a, first), min(a + per, last)) for a in range(first - lead, last, per)]
    return [EntryRange(path, name, a, b, tuple(c.trim(a, b) for c in plans)) for a, b in edges]


def plan_all(files: list[str], options: Options, columns: list[tuple[str, ...]]) -> list[EntryRanges]:
    """Partitions of exactly per entries of all files in order, the last one of what is left; a partition may span files."""
    per = options.entries_per_partition
    with ThreadPoolExecutor(max(1, min(PLANNERS, len(files)))) as pool:
        sizes = list(pool.map(lambda f: open_tree(f, options.tree).entries, files))
        firsts = [end - n for n, end in zip(sizes, accumulate(sizes))]
        made = list(pool.map(lambda f, at: plan_file(f, options.tree, columns, per, lead=at % per), files, firsts))
    held: list[list[EntryRange]] = []
    for at, ranges in zip(firsts, made):
        for r in ranges:
            if (at + r.start) % per == 0:
                held.append([])
            held[-1].append(r)
    return [EntryRanges(tuple(x)) for x in held]


def slice_ranges(part: EntryRange, columns: list[tuple[str, ...]], per: int) -> list[EntryRange]:
    """The entry ranges of a slice of a file, planned by the task that reads them; the slices of a file share out its entries."""
    n = open_tree(part.file, part.tree).entries
    return plan_file(part.file, part.tree, columns, per, n * part.start // -part.stop, n * (part.start + 1) // -part.stop)


def plan(files: list[str], options: Options, schema: T.StructType) -> list[EntryRange] | list[EntryRanges]:
    """All partitions of all files, in order. The driver looks at files in parallel; or, with planning=executor, not at all."""
    if options.ranges == "all":
        return plan_all(files, options, leaves(schema))
    if options.planning == "executor" or options.planning == "auto" and len(files) > DRIVER_FILES:
        with ThreadPoolExecutor(max(1, min(PLANNERS, len(files)))) as pool:
            slices = list(pool.map(lambda f: max(1, -(-size_of(f) // SLICE_BYTES)), files))
        return [EntryRange(f, options.tree, k, -n, ()) for f, n in zip(files, slices) for k in range(n)]
    columns = leaves(schema)
    with ThreadPoolExecutor(max(1, min(PLANNERS, len(files)))) as pool:
        made = list(pool.map(lambda f: plan_file(f, options.tree, columns, options.entries_per_partition), files))
    return [r for ranges in made for r in ranges]


def count_entries(files: list[str], name: str) -> int:
    """Rows, from metadata alone."""
    with ThreadPoolExecutor(max(1, min(PLANNERS, len(files)))) as pool:
        return sum(pool.map(lambda f: open_tree(f, name).entries, files))
