"""Which files a load means, and how they are opened.

Paths with a scheme go to the file system of that scheme; all others are local, whatever Spark's default file system is.
"""

from __future__ import annotations

import glob
import lzma
import os
import re
from urllib.parse import unquote, urlparse

SUFFIX = ".root"
SCHEME = re.compile(r"[a-zA-Z][a-zA-Z0-9+.-]*:.*")
MAGIC = re.compile(r"[*?\[{]")


def is_glob(path: str) -> bool:
    return MAGIC.search(path) is not None


def expand_braces(path: str) -> list[str]:
    """All alternatives of {a,b}, which may nest."""
    start = path.find("{")
    if start < 0:
        return [path]
    depth, parts, at = 0, [], start + 1
    for k in range(start, len(path)):
        if path[k] == "{":
            depth += 1
        elif path[k] == "}":
            depth -= 1
            if depth == 0:
                parts.append(path[at:k])
                return [x for p in parts for x in expand_braces(path[:start] + p + path[k + 1 :])]
        elif path[k] == "," and depth == 1:
            parts.append(path[at:k])
            at = k + 1
    raise ValueError(f"unbalanced braces in {path}")


def local_path(path: str) -> str | None:
    """The local path of a plain path or a file: URL, else None."""
    if not SCHEME.fullmatch(path):
        return path
    url = urlparse(path)
    return unquote(url.path) if url.scheme == "file" else None


def _walk(folder: str) -> list[str]:
    return [os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.endswith(SUFFIX)]


def _remote(path: str) -> list[str]:
    import fnmatch

    from pyarrow import fs

    scheme = path.split(":", 1)[0]
    base = path if not is_glob(path) else path[: path.rfind("/", 0, MAGIC.search(path).start()) + 1]
    system, root = fs.FileSystem.from_uri(base.rstrip("/") or base)
    prefix = base.rstrip("/")[: len(base.rstrip("/")) - len(root.lstrip("/"))] if not scheme == "file" else ""
    info = system.get_file_info(root)
    if info.type == fs.FileType.File:
        return [path]
    if info.type != fs.FileType.Directory:
        raise FileNotFoundError(path)
    inside = system.get_file_info(fs.FileSelector(root, recursive=True))
    files = [f.path for f in inside if f.type == fs.FileType.File]
    if is_glob(path):
        wanted = path[len(prefix) :].lstrip("/")
        return [prefix + f for f in files if fnmatch.fnmatchcase(f.lstrip("/"), wanted) and f.count("/") == ("/" + wanted).count("/") - (not f.startswith("/"))]
    return [prefix + f for f in files if f.endswith(SUFFIX)]


def resolve(paths: list[str] | tuple[str, ...]) -> list[str]:
    """The files of paths, globs and folders (all .root files below), each once, sorted. Nothing found is an error."""
    found: set[str] = set()
    for given in paths:
        for path in expand_braces(given):
            own = local_path(path)
            if own is None:
                more = _remote(path)
            elif is_glob(path):
                more = [f for hit in glob.glob(own) for f in (_walk(hit) if os.path.isdir(hit) else [hit])]
            elif os.path.isdir(own):
                more = _walk(own)
            elif os.path.isfile(own):
                more = [own]
            else:
                raise FileNotFoundError(path)
            found.update(os.path.normpath(f) if local_path(f) is not None else f for f in more)
        if not found:
            raise FileNotFoundError(given)
    return sorted(found)


class LocalFile:
    def __init__(self, path: str):
        self.fd = os.open(path, os.O_RDONLY)
        self.size = os.fstat(self.fd).st_size

    def read(self, at: int, n: int) -> bytes:
        parts = []
        while n:
            part = os.pread(self.fd, n, at)
            if not part:
                break
            parts.append(part)
            at, n = at + len(part), n - len(part)
        return b"".join(parts)

    def close(self) -> None:
        if self.fd >= 0:
            os.close(self.fd)
            self.fd = -1


class RemoteFile:
    def __init__(self, path: str):
        from pyarrow import fs

        system, inner = fs.FileSystem.from_uri(path)
        self.file = system.open_input_file(inner)
        self.size = self.file.size()

    def read(self, at: int, n: int) -> bytes:
        return self.file.read_at(n, at)

    def close(self) -> None:
        self.file.close()


class MemoryFile:
    """A whole file in memory, such as one unpacked from .xz."""

    def __init__(self, data: bytes):
        self.data, self.size = data, len(data)

    def read(self, at: int, n: int) -> bytes:
        return self.data[at : at + n]

    def close(self) -> None:
        self.data = b""


def size_of(path: str) -> int:
    """Bytes of a file, without opening it."""
    own = local_path(path)
    if own is not None:
        return os.stat(own).st_size
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path)
    return system.get_file_info(inner).size or 0


def open_file(path: str):
    if path.endswith(".xz"):
        with lzma.open(local_path(path)) as f:
            return MemoryFile(f.read())
    own = local_path(path)
    return LocalFile(own) if own is not None else RemoteFile(path)
