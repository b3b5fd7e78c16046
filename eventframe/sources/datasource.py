"""The source `root` for spark.read, spark.readStream and df.write."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)

from .options import Options
from .paths import local_path, resolve
from .planning import EntryRange, EntryRanges, open_tree, plan, slice_ranges
from .reading import read_range
from .schema import leaves, prune, schema_of
from .writer import parse_types


class EventSource(DataSource):
    """spark.read.format("root").option("tree", "Events").load(paths).

    Options (any case): tree, path or paths, columns (comma-separated, dotted for struct members), entriesPerPartition, threadCount
    (0 decodes in the task's own thread), batchRows, uint64 (wrap or decimal), planning (driver, executor or auto), ranges (file, or
    all for partitions of entriesPerPartition entries across files). A schema given to spark.read prunes
    the scan to its columns, as does the option columns.
    """

    @classmethod
    def name(cls) -> str:
        return "root"

    def schema(self) -> T.StructType:
        o = Options.parse(self.options).need_paths()
        return prune(schema_of(open_tree(resolve(o.paths)[0], o.tree), o.uint64), o.columns)

    def reader(self, schema: T.StructType) -> EventReader:
        return EventReader(Options.parse(self.options).need_paths(), schema)

    def streamReader(self, schema: T.StructType) -> EventStream:  # noqa: N802
        return EventStream(Options.parse(self.options).need_paths(), schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> EventWriter:
        low = {k.lower(): v for k, v in self.options.items()}
        return EventWriter(low["path"], low.get("tree", "Events"), low.get("codec", "zlib"), low.get("types"), schema, overwrite)


def read_part(part: EntryRange | EntryRanges, options: Options, schema: T.StructType) -> Iterator[pa.RecordBatch]:
    """The rows of an entry range or of several, or of a slice of a file, which is planned here."""
    ranges = part.ranges if isinstance(part, EntryRanges) else slice_ranges(part, leaves(schema), options.entries_per_partition) if part.stop < 0 else [part]
    for r in ranges:
        if r.stop > r.start:
            yield from read_range(r, schema, options.threads, options.batch_rows)


class EventReader(DataSourceReader):
    def __init__(self, options: Options, schema: T.StructType):
        self.options, self.schema = options, schema

    def partitions(self) -> list[InputPartition]:
        made = plan(resolve(self.options.paths), self.options, self.schema)
        return made or [EntryRange("", self.options.tree, 0, 0, ())]

    def read(self, part: EntryRange) -> Iterator[pa.RecordBatch]:
        yield from read_part(part, self.options, self.schema)


class EventStream(DataSourceStreamReader):
    """New files as a stream: an offset is the names of the files seen so far, each read whole once."""

    def __init__(self, options: Options, schema: T.StructType):
        self.options, self.schema = options, schema

    def initialOffset(self) -> dict:  # noqa: N802
        return {"files": []}

    def latestOffset(self) -> dict:  # noqa: N802
        try:
            return {"files": resolve(self.options.paths)}
        except FileNotFoundError:
            return {"files": []}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        seen = set(start["files"])
        return plan([f for f in end["files"] if f not in seen], self.options, self.schema)

    def read(self, part: EntryRange) -> Iterator[pa.RecordBatch]:
        yield from read_part(part, self.options, self.schema)

    def commit(self, end: dict) -> None:
        pass


@dataclass
class WrittenFile(WriterCommitMessage):
    temporary: str
    final: str


class EventWriter(DataSourceArrowWriter):
    """One file per task in a local or shared folder; files appear when the job commits."""

    def __init__(self, path: str, tree: str, codec: str, types: str | None, schema: T.StructType, overwrite: bool):
        folder = local_path(path)
        if folder is None:
            raise ValueError("event files are written to local or mounted folders only")
        self.folder, self.tree, self.codec, self.types, self.overwrite = folder, tree, codec, parse_types(types), overwrite
        self.job = uuid.uuid4().hex

    def write(self, batches: Iterator[pa.RecordBatch]) -> WrittenFile:
        from pyspark import TaskContext

        from .writer import Column, TreeWriter, columns_for

        os.makedirs(self.folder, exist_ok=True)
        context = TaskContext.get()
        name = f"part-{context.partitionId():05d}-{self.job}"
        temporary = f"{self.folder}/.{name}-{context.taskAttemptId()}.tmp"
        w = None
        for batch in batches:
            if w is None:
                made = columns_for(batch.schema, self.types)
                counters = [Column(c.counter, "int") for c in made if isinstance(c, Column) and c.counter]
                w = TreeWriter(temporary, self.tree, [*counters, *made], codec=self.codec)
            columns = {n: batch.column(k) for k, n in enumerate(batch.schema.names)}
            for c in w.columns:
                if isinstance(c, Column) and c.counter:
                    columns[c.counter] = columns[c.name].value_lengths()
            for n, x in columns.items():
                if x.null_count:
                    raise ValueError(f"column {n} has nulls; the format has none")
            w.write(columns)
        if w is None:
            return WrittenFile("", "")
        w.close()
        return WrittenFile(temporary, f"{self.folder}/{name}.root")

    def commit(self, messages: list[WrittenFile | None]) -> None:
        old = [os.path.join(self.folder, f) for f in os.listdir(self.folder) if f.endswith(".root")] if self.overwrite and os.path.isdir(self.folder) else []
        for m in messages:
            if m is not None and m.final:
                os.replace(m.temporary, m.final)
        for f in old:
            os.unlink(f)

    def abort(self, messages: list[WrittenFile | None]) -> None:
        for m in messages:
            if m is not None and m.temporary and os.path.exists(m.temporary):
                os.unlink(m.temporary)
