"""Compressed blocks: a run of frames of 9 bytes of header (algorithm, method, two 3-byte sizes) and data."""

from __future__ import annotations

import lzma
import zlib

import pyarrow as pa
import xxhash
import zstandard

from .binary import FormatError

FRAME = (1 << 24) - 1
CODECS = {"zlib": b"ZL", "lzma": b"XZ", "lz4": b"L4", "zstd": b"ZS"}
_HEAD = 9


def decompress(data, size: int) -> bytes:
    """The size bytes that data holds; data of that length is stored as it is."""
    if len(data) == size:
        return bytes(data)
    out, at, made = [], 0, 0
    while at < len(data) and made < size:
        head = bytes(data[at : at + _HEAD])
        if len(head) < _HEAD:
            raise FormatError("compressed frame is cut off")
        n, m = int.from_bytes(head[3:6], "little"), int.from_bytes(head[6:9], "little")
        body = bytes(data[at + _HEAD : at + _HEAD + n])
        if len(body) < n:
            raise FormatError("compressed frame is cut off")
        kind = head[:2]
        if kind == b"ZL":
            part = zlib.decompress(body)
        elif kind == b"XZ":
            part = lzma.decompress(body)
        elif kind == b"L4":
            part = pa.decompress(body[8:], decompressed_size=m, codec="lz4_raw", asbytes=True)
        elif kind == b"ZS":
            part = zstandard.ZstdDecompressor().decompress(body, max_output_size=m)
        else:
            raise FormatError(f"unknown compression {kind!r}")
        if len(part) != m:
            raise FormatError("compressed frame has another size than it says")
        out.append(part)
        made += m
        at += _HEAD + n
    if made != size:
        raise FormatError(f"{made} bytes where {size} were expected")
    return b"".join(out)


def compress(data: bytes, codec: str | None, frame: int = FRAME) -> bytes:
    """Frames of data, or data itself where compression doesn't make it shorter."""
    if codec is None or codec == "raw":
        return data
    out = []
    for at in range(0, len(data), frame):
        part = data[at : at + frame]
        if codec == "zlib":
            body, method = zlib.compress(part, 1), 8
        elif codec == "lzma":
            body, method = lzma.compress(part, preset=1), 0
        elif codec == "lz4":
            packed = pa.compress(part, codec="lz4_raw", asbytes=True)
            body, method = xxhash.xxh64(packed).digest() + packed, 1
        elif codec == "zstd":
            body, method = zstandard.ZstdCompressor(level=3, write_content_size=True).compress(part), 1
        else:
            raise ValueError(f"no codec {codec}")
        if len(body) > FRAME:
            return data
        out.append(CODECS[codec] + bytes([method]) + len(body).to_bytes(3, "little") + len(part).to_bytes(3, "little") + body)
    made = b"".join(out)
    return made if len(made) < len(data) else data
