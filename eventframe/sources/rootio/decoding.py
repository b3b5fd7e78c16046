"""From basket bytes to Arrow arrays, one NumPy view per basket."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from ..types import Primitive
from .binary import Cursor, FormatError
from .compression import decompress
from .container import EventFile, read_key


@dataclass(frozen=True)
class Piece:
    """One basket's values: content as native numbers, and, if jagged, each entry's first item (with a cap)."""

    values: np.ndarray
    first: np.ndarray | None


def split_payload(payload: bytes, border: int, key_length: int) -> tuple[bytes, np.ndarray | None]:
    """(content, byte offset of each entry and a cap): offsets follow the content behind a count, from the key's
    start; the last of them isn't meaningful and stands for the content's end."""
    if len(payload) <= border:
        return payload, None
    offsets = np.frombuffer(payload, ">i4", offset=border + 4, count=(len(payload) - border - 4) // 4).astype(np.int64) - key_length
    offsets[-1] = border
    return payload[:border], offsets


def numbers(content, p: Primitive) -> np.ndarray:
    if len(content) % p.width:
        raise FormatError(f"{len(content)} bytes are no whole number of {p.name}")
    return np.frombuffer(content, dtype=p.disk)


def piece(content: bytes, offsets: np.ndarray | None, p: Primitive, kind: str, skip: int) -> Piece:
    if kind != "jagged":
        return Piece(numbers(content, p).astype(p.memory), None)
    if offsets is None:
        raise FormatError("a jagged basket without offsets")
    sizes = np.diff(offsets) - skip
    if (sizes < 0).any() or (sizes % p.width).any():
        raise FormatError("entry sizes and item size don't agree")
    if skip:
        keep = np.ones(len(content), dtype=bool)
        keep[(offsets[:-1, None] + np.arange(skip)).ravel()] = False
        content = np.frombuffer(content, np.uint8)[keep].tobytes()
    first = np.zeros(len(offsets), dtype=np.int64)
    np.cumsum(sizes // p.width, out=first[1:])
    return Piece(numbers(content, p).astype(p.memory), first)


def read_basket(file: EventFile, seek: int, nbytes: int) -> tuple[bytes, int, int]:
    """(payload, border between content and offsets, key length) of a basket on disk, read in one go."""
    data = file.bytes.read(seek, nbytes)
    c = Cursor(data)
    key = read_key(c, seek)
    _, _, _, _, last, _ = c.unpack("hiiiib")
    if key.nbytes != nbytes:
        raise FormatError(f"basket at {seek} has {key.nbytes} bytes, not {nbytes}")
    return decompress(data[key.key_length : key.nbytes], key.object_length), last - key.key_length, key.key_length


def clip(x: Piece, kind: str, length: int, start: int, stop: int) -> Piece:
    """Entries [start, stop) of a basket."""
    if kind == "jagged":
        first = x.first[start : stop + 1]
        return Piece(x.values[first[0] : first[-1]], first - first[0])
    return Piece(x.values[start * length : stop * length], None)


def join(pieces: list[Piece], p: Primitive, kind: str, length: int) -> pa.Array:
    values = np.concatenate([x.values for x in pieces]) if pieces else np.zeros(0, p.memory)
    flat = pa.array(values, type=p.arrow)
    if kind == "scalar":
        return flat
    if kind == "fixed":
        first = np.arange(len(values) // length + 1, dtype=np.int64) * length
    else:
        at, parts = 0, [np.zeros(1, np.int64)]
        for x in pieces:
            parts.append(x.first[1:] + at)
            at += x.first[-1]
        first = np.concatenate(parts)
    kind_of = pa.list_(pa.field("element", p.arrow, nullable=False))
    if first[-1] > np.iinfo(np.int32).max:
        raise FormatError("too many items for one batch; lower batchRows")
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), flat, type=kind_of)
