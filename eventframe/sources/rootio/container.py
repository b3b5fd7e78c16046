"""Files, directories and keys."""

from __future__ import annotations

import os
import threading
import time
from collections import OrderedDict
from dataclasses import dataclass
from functools import cached_property

from .binary import Cursor, FormatError
from .compression import decompress
from .streaming import Decoder, read_infos

PAGE, PAGES, BYPASS, IDLE_S = 16 << 10, 256, 64 << 10, 60.0


class Bytes:
    """Random access to a file. Small reads go through whole pages that are kept; large ones don't. Each use of the
    file below is noted in the profile, if there is one."""

    def __init__(self, path: str, profile: list | None = None):
        self.path, self.profile = path, profile
        self.pages: OrderedDict[int, bytes] = OrderedDict()
        self.lock = threading.Lock()
        self.used = time.monotonic()
        self._open()

    def _open(self) -> None:
        from ..paths import open_file

        self.file = open_file(self.path)
        self.size = self.file.size

    def _lower(self, at: int, n: int) -> bytes:
        start = time.monotonic()
        out = self.file.read(at, n)
        if len(out) != n:
            raise FormatError(f"{self.path}: {len(out)} of {n} bytes at {at}")
        if self.profile is not None:
            self.profile.append(("lower", self.path, at, n, start, time.monotonic()))
        return out

    def read(self, at: int, n: int) -> bytes:
        self.used = time.monotonic()
        if at < 0 or n < 0 or at + n > self.size:
            raise FormatError(f"{self.path}: {n} bytes at {at} lie beyond its {self.size}")
        if self.profile is not None:
            self.profile.append(("upper", self.path, at, n, self.used, self.used))
        first = at // PAGE
        if n > BYPASS or (n and (at + n - 1) // PAGE != first):
            return self._lower(at, n)
        with self.lock:
            page = self.pages.get(first)
            if page is None:
                page = self._lower(first * PAGE, min(PAGE, self.size - first * PAGE))
                self.pages[first] = page
                if len(self.pages) > PAGES:
                    self.pages.popitem(last=False)
            else:
                self.pages.move_to_end(first)
        return page[at - first * PAGE : at - first * PAGE + n]

    def close(self) -> None:
        self.file.close()


@dataclass(frozen=True)
class Key:
    at: int
    nbytes: int
    object_length: int
    key_length: int
    cycle: int
    seek: int
    class_name: str
    name: str
    title: str


def read_key(c: Cursor, at: int) -> Key:
    nbytes, version, length, _, key_length, cycle = c.unpack("ihiIhh")
    seek, _ = c.unpack("qq" if version > 1000 else "ii")
    return Key(at, nbytes, length, key_length, cycle, seek, c.string(), c.string(), c.string())


class EventFile:
    """An open file: header, directories and decoded objects."""

    def __init__(self, path: str, profile: list | None = None):
        self.path, self.bytes = path, Bytes(path, profile)
        head = self.bytes.read(0, min(self.bytes.size, 128))
        if head[:4] != b"root":
            raise FormatError(f"{path} is no event file")
        c = Cursor(head, 4)
        self.version, self.begin = c.unpack("ii")
        large = self.version > 1_000_000
        wide = "q" if large else "i"
        self.end, _, _, _, self.name_bytes, _, self.compression, self.info_at, self.info_bytes = c.unpack(f"{wide}{wide}iiibi{wide}i")

    def key_at(self, at: int) -> Key:
        n = min(512, self.bytes.size - at)
        try:
            return read_key(Cursor(self.bytes.read(at, n)), at)
        except FormatError:  # long names
            size = Cursor(self.bytes.read(at, 18), 14).i2()
            return read_key(Cursor(self.bytes.read(at, size)), at)

    def payload(self, key: Key) -> bytes:
        """The object of a key; it begins right after the key, compressed or not."""
        return decompress(self.bytes.read(key.seek + key.key_length, key.nbytes - key.key_length), key.object_length)

    @cached_property
    def decoder(self) -> Decoder:
        if not self.info_at:
            return Decoder({})
        key = self.key_at(self.info_at)
        return Decoder(read_infos(Cursor(self.payload(key), 0, key.key_length)))

    def _listing(self, at: int) -> list[Key]:
        c = Cursor(self.bytes.read(at, min(64, self.bytes.size - at)))
        version, _, _, _, _ = c.unpack("hIIii")
        _, _, keys_at = c.unpack("qqq" if version > 1000 else "iii")
        if not keys_at:
            return []
        key = self.key_at(keys_at)
        c = Cursor(self.bytes.read(keys_at + key.key_length, key.nbytes - key.key_length))
        out = []
        for _ in range(c.i4()):
            out.append(read_key(c, c.pos))
        return out

    @cached_property
    def keys(self) -> list[Key]:
        return self._listing(self.begin + self.name_bytes)

    def find(self, name: str) -> Key:
        """The key at a path of directories; of several cycles the highest."""
        keys = self.keys
        *folders, last = name.strip("/").split("/")
        for folder in folders:
            inner = [k for k in keys if k.name == folder and k.class_name in ("TDirectory", "TDirectoryFile")]
            if not inner:
                raise KeyError(f"{self.path} has no {name}")
            k = max(inner, key=lambda k: k.cycle)
            keys = self._listing(k.seek + k.key_length)
        found = [k for k in keys if k.name == last]
        if not found:
            raise KeyError(f"{self.path} has no {name}")
        return max(found, key=lambda k: k.cycle)

    def object(self, key: Key):
        c = Cursor(self.payload(key), 0, key.key_length)
        return self.decoder.object(key.class_name, c)

    def close(self) -> None:
        self.bytes.close()


class FileCache:
    """Open files of this process by path; those idle for a minute are closed at the next use of the cache."""

    def __init__(self, idle: float = IDLE_S, clock=time.monotonic):
        self.idle, self.clock, self.open = idle, clock, {}
        self.lock = threading.Lock()

    def get(self, path: str) -> EventFile:
        with self.lock:
            now = self.clock()
            for other, (file, used) in list(self.open.items()):
                if other != path and now - used > self.idle:
                    file.close()
                    del self.open[other]
            stamp = os.stat(path).st_mtime_ns if os.path.exists(path) else 0
            file, _ = self.open.get(path, (None, 0))
            if file is None or getattr(file, "stamp", 0) != stamp:
                file = EventFile(path)
                file.stamp = stamp
            self.open[path] = (file, now)
            return file


FILES = FileCache()
