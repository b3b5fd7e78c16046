"""Executor side: an entry range as Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark.sql import types as T

from .planning import ColumnPlan, EntryRange, open_tree, overlap
from .rootio.container import FILES, EventFile
from .rootio.decoding import Piece, clip, join, piece, read_basket, split_payload
from .types import PRIMITIVES


class ColumnReader:
    """Baskets of one column, decoded when a batch first needs them and dropped when none will again."""

    def __init__(self, file: EventFile, part: EntryRange, plan: ColumnPlan, pool: ThreadPoolExecutor | None):
        self.file, self.part, self.plan, self.pool = file, part, plan, pool
        self.primitive = PRIMITIVES[plan.type_name]
        self.made: dict[int, object] = {}

    def _decode(self, k: int) -> Piece:
        plan = self.plan
        if k < len(plan.baskets):
            payload, border, key_length = read_basket(self.file, *plan.baskets[k])
            content, offsets = split_payload(payload, border, key_length)
        else:
            b = open_tree(self.part.file, self.part.tree).branch(plan.path).embedded[plan.embedded[k - len(plan.baskets)]]
            content, offsets = b.content, None
            if b.offsets is not None:
                offsets = np.r_[b.offsets[: b.entries] - b.key_length, len(content)]
        return piece(content, offsets, self.primitive, plan.kind, plan.skip)

    def ask(self, start: int, stop: int) -> None:
        """Begins to decode what a batch needs."""
        lo, hi = overlap(self.plan.starts, start, stop)
        for k in [k for k in self.made if k < lo]:
            del self.made[k]
        for k in range(lo, hi):
            if k not in self.made:
                self.made[k] = self.pool.submit(self._decode, k) if self.pool else self._decode(k)

    def array(self, start: int, stop: int) -> pa.Array:
        lo, hi = overlap(self.plan.starts, start, stop)
        pieces = []
        for k in range(lo, hi):
            x = self.made[k]
            x = x if isinstance(x, Piece) else x.result()
            a, b = self.plan.starts[k], self.plan.starts[k + 1]
            pieces.append(clip(x, self.plan.kind, self.plan.length, max(start, a) - a, min(stop, b) - a))
        out = join(pieces, self.primitive, self.plan.kind, self.plan.length)
        if len(out) != stop - start:
            raise ValueError(f"column {'.'.join(self.plan.path)} of {self.part.file} has {len(out)} of the entries {start} to {stop}")
        return out


def to_decimal(x: pa.Array) -> pa.Array:
    """64-bit patterns as unsigned decimals."""
    flat = x.flatten() if pa.types.is_list(x.type) else x
    u = pa.array(flat.to_numpy(zero_copy_only=False).view(np.uint64), pa.uint64()).cast(pa.decimal128(20, 0))
    if not pa.types.is_list(x.type):
        return u
    return pa.ListArray.from_arrays(x.offsets, u, type=pa.list_(pa.field("element", u.type, nullable=False)))


def assemble(schema: T.StructType, arrays: dict[tuple[str, ...], pa.Array], prefix: tuple[str, ...] = ()) -> list[pa.Array]:
    out = []
    for f in schema.fields:
        path = (*prefix, f.name)
        if isinstance(f.dataType, T.StructType):
            inner = assemble(f.dataType, arrays, path)
            out.append(pa.StructArray.from_arrays(inner, fields=[pa.field(g.name, x.type, nullable=False) for g, x in zip(f.dataType.fields, inner)]))
        else:
            element = f.dataType.elementType if isinstance(f.dataType, T.ArrayType) else f.dataType
            out.append(to_decimal(arrays[path]) if isinstance(element, T.DecimalType) else arrays[path])
    return out


def read_range(part: EntryRange, schema: T.StructType, threads: int, batch_rows: int) -> Iterator[pa.RecordBatch]:
    """Batches of at most batch_rows rows; with threads, baskets of the next batch decode while this one is used."""
    file = FILES.get(part.file)
    pool = ThreadPoolExecutor(threads) if threads and part.columns else None
    try:
        readers = [ColumnReader(file, part, c, pool) for c in part.columns]
        for start in range(part.start, part.stop, batch_rows):
            stop = min(start + batch_rows, part.stop)
            for r in readers:
                r.ask(start, stop)
            arrays = {r.plan.path: r.array(start, stop) for r in readers}
            if not schema.fields:
                yield pa.RecordBatch.from_struct_array(pa.array([{}] * (stop - start), pa.struct([])))
            else:
                yield pa.RecordBatch.from_arrays(assemble(schema, arrays), names=schema.names)
    finally:
        if pool:
            pool.shutdown(wait=False, cancel_futures=True)
