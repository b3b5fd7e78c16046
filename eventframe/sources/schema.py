"""The Spark schema of a tree."""

from __future__ import annotations

import logging

from pyspark.sql import types as T

from .rootio.trees import Branch, Tree
from .types import UnsupportedBranch

log = logging.getLogger(__name__)


def field_of(b: Branch, uint64: str = "wrap") -> T.StructField | None:
    children = b.children
    if children:
        inner = [f for f in (field_of(c, uint64) for c in children) if f is not None]
        return T.StructField(b.short_name, T.StructType(inner), False, {"nested": True}) if inner else None
    try:
        p, shape = b.primitive, b.shape
    except UnsupportedBranch as e:
        log.warning("column left out: %s", e)
        return None
    spark = T.DecimalType(20, 0) if p.name == "ulong" and uint64 == "decimal" else p.spark
    return T.StructField(b.short_name, spark if shape.kind == "scalar" else T.ArrayType(spark, False), False, {"rootType": p.name})


def schema_of(tree: Tree, uint64: str = "wrap") -> T.StructType:
    """All columns of the data model; branches outside it are left out and logged."""
    fields, seen = [], set()
    for b in tree.branches():
        f = field_of(b, uint64)
        if f is not None and f.name not in seen:
            seen.add(f.name)
            fields.append(f)
    return T.StructType(fields)


def prune(schema: T.StructType, columns: tuple[str, ...] | None) -> T.StructType:
    """The columns, dotted for members of structs, in the order of the schema's own fields within each struct and in the
    order asked for at the top."""
    if columns is None:
        return schema
    wanted: dict[str, list[str] | None] = {}
    for c in columns:
        head, _, rest = c.partition(".")
        if c in schema.names:
            head, rest = c, ""
        if head not in schema.names:
            raise ValueError(f"no column {c}; there are {', '.join(schema.names[:20])}")
        if rest and wanted.get(head, []) is not None:
            wanted.setdefault(head, []).append(rest)
        elif not rest:
            wanted[head] = None
    out = []
    for name, inner in wanted.items():
        f = schema[name]
        if inner is not None:
            if not isinstance(f.dataType, T.StructType):
                raise ValueError(f"column {name} has no members")
            f = T.StructField(f.name, prune(f.dataType, tuple(inner)), f.nullable, f.metadata)
        out.append(f)
    return T.StructType(out)


def leaves(schema: T.StructType, prefix: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    out = []
    for f in schema.fields:
        path = (*prefix, f.name)
        out += leaves(f.dataType, path) if isinstance(f.dataType, T.StructType) else [path]
    return out
