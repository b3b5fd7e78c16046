"""Big-endian cursor over bytes."""

from __future__ import annotations

import struct

BYTE_COUNT = 0x40000000


class FormatError(ValueError):
    pass


class Cursor:
    """Reads from data at pos. base is what positions in object references count from."""

    def __init__(self, data, pos: int = 0, base: int = 0):
        self.data, self.pos, self.base = data, pos, base
        self.seen: dict[int, object] = {}

    def unpack(self, fmt: str):
        s = struct.Struct(">" + fmt)
        if self.pos + s.size > len(self.data):
            raise FormatError(f"read of {s.size} bytes at {self.pos} beyond {len(self.data)}")
        out = s.unpack_from(self.data, self.pos)
        self.pos += s.size
        return out if len(out) > 1 else out[0]

    def take(self, n: int) -> bytes:
        if n < 0 or self.pos + n > len(self.data):
            raise FormatError(f"read of {n} bytes at {self.pos} beyond {len(self.data)}")
        self.pos += n
        return bytes(self.data[self.pos - n : self.pos])

    def i1(self):
        return self.unpack("b")

    def u1(self):
        return self.unpack("B")

    def i2(self):
        return self.unpack("h")

    def u2(self):
        return self.unpack("H")

    def i4(self):
        return self.unpack("i")

    def u4(self):
        return self.unpack("I")

    def i8(self):
        return self.unpack("q")

    def f8(self):
        return self.unpack("d")

    def string(self) -> str:
        n = self.u1()
        return self.take(self.i4() if n == 255 else n).decode("utf-8", "replace")

    def c_string(self) -> str:
        end = bytes(self.data).index(0, self.pos)
        out = bytes(self.data[self.pos : end]).decode("utf-8", "replace")
        self.pos = end + 1
        return out

    def record(self) -> tuple[int, int | None]:
        """(version, end) of a versioned object; end is None where no byte count is stored."""
        at, n = self.pos, self.u4()
        if n & BYTE_COUNT:
            return self.u2(), at + 4 + (n & ~BYTE_COUNT)
        self.pos = at
        return self.u2(), None

    def close(self, end: int | None, what: str) -> None:
        """Checks that all of the object was read, and no more."""
        if end is not None and self.pos != end:
            raise FormatError(f"{what} was read {abs(self.pos - end)} bytes {'too far' if self.pos > end else 'short'}")
