"""A writer of event files: scalar, fixed, jagged, vector and nested branches, in any of the codecs.

It stores the streamer infos of all classes it writes, so that a reader needs no knowledge of their layout.
"""

from __future__ import annotations

import os
import struct
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa

from .rootio.compression import compress
from .types import PRIMITIVES, Primitive

BEGIN = 100
DATIME = 1 << 26  # a fixed time stamp, so that equal data gives equal files
#: Classes as version and members; a member is (name, element kind, type code, C++ type, more). These are fixed values of the
#: format: base classes have code 0, basic types 1 to 18, pointers to counted arrays 40 more, objects 61, 62 and 64, strings 65.
CLASSES: dict[str, tuple[int, list[tuple]]] = {
    "TAttLine": (2, [("fLineColor", "BasicType", 2, "short"), ("fLineStyle", "BasicType", 2, "short"), ("fLineWidth", "BasicType", 2, "short")]),
    "TAttFill": (2, [("fFillColor", "BasicType", 2, "short"), ("fFillStyle", "BasicType", 2, "short")]),
    "TAttMarker": (2, [("fMarkerColor", "BasicType", 2, "short"), ("fMarkerStyle", "BasicType", 2, "short"), ("fMarkerSize", "BasicType", 5, "float")]),
    "TTree": (
        20,
        [("TNamed", "Base", 67, "BASE", 1), ("TAttLine", "Base", 0, "BASE", 2), ("TAttFill", "Base", 0, "BASE", 2), ("TAttMarker", "Base", 0, "BASE", 2)]
        + [(n, "BasicType", 16, "Long64_t") for n in "fEntries fTotBytes fZipBytes fSavedBytes fFlushedBytes".split()]
        + [("fWeight", "BasicType", 8, "double")]
        + [(n, "BasicType", 3, "int") for n in "fTimerInterval fScanField fUpdate fDefaultEntryOffsetLen".split()]
        + [("fNClusterRange", "BasicType", 6, "int")]
        + [(n, "BasicType", 16, "Long64_t") for n in "fMaxEntries fMaxEntryLoop fMaxVirtualSize fAutoSave fAutoFlush fEstimate".split()]
        + [(n, "BasicPointer", 56, "Long64_t*", "fNClusterRange") for n in ("fClusterRangeEnd", "fClusterSize")]
        + [("fIOFeatures", "ObjectAny", 62, "ROOT::TIOFeatures"), ("fBranches", "Object", 61, "TObjArray"), ("fLeaves", "Object", 61, "TObjArray"), ("fAliases", "ObjectPointer", 64, "TList*")]
        + [("fIndexValues", "ObjectAny", 62, "TArrayD"), ("fIndex", "ObjectAny", 62, "TArrayI"), ("fTreeIndex", "ObjectPointer", 64, "TVirtualIndex*")]
        + [("fFriends", "ObjectPointer", 64, "TList*"), ("fUserInfo", "ObjectPointer", 64, "TList*"), ("fBranchRef", "ObjectPointer", 64, "TBranchRef*")],
    ),
    "TBranch": (
        13,
        [("TNamed", "Base", 67, "BASE", 1), ("TAttFill", "Base", 0, "BASE", 2)]
        + [(n, "BasicType", 3, "int") for n in "fCompress fBasketSize fEntryOffsetLen fWriteBasket".split()]
        + [("fEntryNumber", "BasicType", 16, "Long64_t"), ("fIOFeatures", "ObjectAny", 62, "ROOT::TIOFeatures"), ("fOffset", "BasicType", 3, "int"), ("fMaxBaskets", "BasicType", 6, "int"), ("fSplitLevel", "BasicType", 3, "int")]
        + [(n, "BasicType", 16, "Long64_t") for n in "fEntries fFirstEntry fTotBytes fZipBytes".split()]
        + [(n, "Object", 61, "TObjArray") for n in "fBranches fLeaves fBaskets".split()]
        + [("fBasketBytes", "BasicPointer", 43, "int*", "fMaxBaskets"), ("fBasketEntry", "BasicPointer", 56, "Long64_t*", "fMaxBaskets"), ("fBasketSeek", "BasicPointer", 56, "Long64_t*", "fMaxBaskets"), ("fFileName", "String", 65, "TString")],
    ),
    "TBranchElement": (
        10,
        [("TBranch", "Base", 0, "BASE", 13)]
        + [(n, "String", 65, "TString") for n in "fClassName fParentName fClonesName".split()]
        + [("fCheckSum", "BasicType", 13, "unsigned int"), ("fClassVersion", "BasicType", 2, "short")]
        + [(n, "BasicType", 3, "int") for n in "fID fType fStreamerType fMaximum".split()]
        + [(n, "ObjectPointer", 64, "TBranchElement*") for n in ("fBranchCount", "fBranchCount2")],
    ),
    "TLeaf": (
        2,
        [("TNamed", "Base", 67, "BASE", 1)]
        + [(n, "BasicType", 3, "int") for n in "fLen fLenType fOffset".split()]
        + [(n, "BasicType", 18, "bool") for n in ("fIsRange", "fIsUnsigned")]
        + [("fLeafCount", "ObjectPointer", 64, "TLeaf*")],
    ),
    "TLeafElement": (1, [("TLeaf", "Base", 0, "BASE", 2), ("fID", "BasicType", 3, "int"), ("fType", "BasicType", 3, "int")]),
} | {f"TLeaf{k}": (1, [("TLeaf", "Base", 0, "BASE", 2), ("fMinimum", "BasicType", code, cpp), ("fMaximum", "BasicType", code, cpp)]) for k, code, cpp in (("O", 18, "bool"), ("B", 1, "char"), ("S", 2, "short"), ("I", 3, "int"), ("L", 16, "Long64_t"), ("F", 5, "float"), ("D", 8, "double"))}
LEAF_OF = {"bool": "O", "char": "B", "uchar": "B", "short": "S", "ushort": "S", "int": "I", "uint": "I", "long": "L", "ulong": "L", "float": "F", "double": "D"}
BASIC = {1: "b", 2: "h", 3: "i", 5: "f", 6: "i", 8: "d", 13: "I", 16: "q", 18: "?"}


@dataclass
class Column:
    """A column to write. kind: scalar, fixed, jagged (with a counter branch) or vector."""

    name: str
    type_name: str
    kind: str = "scalar"
    length: int = 1
    counter: str | None = None

    @property
    def primitive(self) -> Primitive:
        return PRIMITIVES[self.type_name]


@dataclass
class Group:
    """A branch of branches; prefixed: members are named after it."""

    name: str
    columns: list[Column]
    prefixed: bool = True


class Buffer:
    def __init__(self, base: int = 0):
        self.data, self.base = bytearray(), base
        self.objects: dict[int, int] = {}
        self.classes: dict[str, int] = {}

    def put(self, fmt: str, *values) -> None:
        self.data += struct.pack(">" + fmt, *values)

    def string(self, s: str) -> None:
        raw = s.encode()
        self.data += bytes([len(raw)]) + raw if len(raw) < 255 else b"\xff" + struct.pack(">i", len(raw)) + raw

    def open(self, version: int) -> int:
        self.put("IH", 0, version)
        return len(self.data) - 6

    def close(self, at: int) -> None:
        struct.pack_into(">I", self.data, at, (len(self.data) - at - 4) | 0x40000000)

    def t_object(self) -> None:
        self.put("HII", 1, 0, 0x03000000)

    def t_named(self, name: str, title: str) -> None:
        at = self.open(1)
        self.t_object()
        self.string(name)
        self.string(title)
        self.close(at)

    def tagged(self, obj, class_name: str, body) -> None:
        """An object with its class tag; one written before becomes a reference."""
        if obj is None:
            self.put("I", 0)
            return
        if id(obj) in self.objects:
            self.put("I", self.objects[id(obj)])
            return
        at = len(self.data)
        self.objects[id(obj)] = at + self.base + 2
        self.put("I", 0)
        if class_name in self.classes:
            self.put("I", self.classes[class_name] | 0x80000000)
        else:
            self.classes[class_name] = len(self.data) + self.base + 2
            self.put("I", 0xFFFFFFFF)
            self.data += class_name.encode() + b"\0"
        body()
        self.close(at)

    def obj_array(self, items: list, each) -> None:
        at = self.open(3)
        self.t_object()
        self.string("")
        self.put("ii", len(items), 0)
        for x in items:
            each(x)
        self.close(at)

    def struct(self, class_name: str, values: dict) -> None:
        """An object by the layout in CLASSES; values holds its members, callables for objects."""
        version, members = CLASSES[class_name]
        at = self.open(version)
        for name, kind, code, _, *_ in members:
            v = values.get(name, 0)
            if kind == "Base":
                if name == "TNamed":
                    self.t_named(values["fName"], values["fTitle"])
                else:
                    self.struct(name, values)
            elif kind == "BasicType":
                self.put(BASIC[code], v)
            elif kind == "BasicPointer":
                v = v if not isinstance(v, int) else []
                self.put("B", 1 if len(v) else 0)
                self.data += np.asarray(v, dtype=">i4" if code == 43 else ">i8").tobytes()
            elif kind == "String":
                self.string(v or "")
            elif callable(v):
                v()
            elif code == 64:
                self.put("I", 0)
            elif name == "fIOFeatures":
                io = self.open(1)
                self.put("B", 0)
                self.close(io)
            else:  # an empty array
                self.put("i", 0)
        self.close(at)


def streamer_infos(used: list[str]) -> bytes:
    b = Buffer(KEY_BASE("TList", "StreamerInfo", "Doubly linked list"))

    def element(name, kind, code, cpp, more=None):
        def body():
            outer = b.open({"Base": 3, "BasicPointer": 2, "BasicType": 2, "String": 2, "Object": 2, "ObjectAny": 2, "ObjectPointer": 2}[kind])
            at = b.open(4)
            b.t_named(name, f"[{more}]" if kind == "BasicPointer" else "")
            b.put("iiii", code, 0, 0, 0)
            b.put("5i", 0, 0, 0, 0, 0)
            b.string(cpp)
            b.close(at)
            if kind == "Base":
                b.put("i", more)
            elif kind == "BasicPointer":
                b.put("i", 1)
                b.string(more)
                b.string("")
            b.close(outer)

        return body

    at = b.open(5)
    b.t_object()
    b.string("")
    b.put("i", len(used))
    keep = []
    for name in used:
        version, members = CLASSES[name]
        info = object()
        keep.append(info)

        def body(name=name, version=version, members=members):
            outer = b.open(9)
            b.t_named(name, "")
            b.put("Ii", 0, version)
            array, marks = object(), [object() for _ in members]
            keep.extend([array, *marks])
            b.tagged(array, "TObjArray", lambda: b.obj_array(list(zip(marks, members)), lambda m: b.tagged(m[0], f"TStreamer{m[1][1]}", element(*m[1]))))
            b.close(outer)

        b.tagged(info, "TStreamerInfo", body)
        b.put("B", 0)
    b.close(at)
    return bytes(b.data)


def KEY_BASE(class_name: str, name: str, title: str) -> int:  # noqa: N802
    return 26 + 8 + sum(len(s.encode()) + (1 if len(s.encode()) < 255 else 5) for s in (class_name, name, title))


@dataclass
class Written:
    column: Column
    full_name: str
    sizes: list[int] = field(default_factory=list)
    starts: list[int] = field(default_factory=list)
    seeks: list[int] = field(default_factory=list)
    pending: list[tuple] = field(default_factory=list)
    total: int = 0


class TreeWriter:
    """Writes one tree into a new file, batch by batch; each batch of each column is one basket."""

    def __init__(self, path: str, tree: str, columns: list[Column | Group], codec: str | None = "zlib", embed_last: bool = False, large: bool = False, frame: int = (1 << 24) - 1, holes: bool = False):
        self.path, self.columns, self.codec, self.embed_last, self.large, self.frame, self.holes = path, columns, codec, embed_last, large, frame, holes
        *self.folders, self.tree = tree.strip("/").split("/")
        self.entries = 0
        self.out = open(path, "wb")
        self.out.write(b"\0" * BEGIN)
        self.columns_out: dict[tuple[str, ...], Written] = {}
        for c in columns:
            if isinstance(c, Group):
                for m in c.columns:
                    self.columns_out[(c.name, m.name)] = Written(m, f"{c.name}.{m.name}" if c.prefixed else m.name)
            else:
                self.columns_out[(c.name,)] = Written(c, c.name)
        name = os.path.basename(path)
        self.name_bytes = self._key_length("TFile", name, "") + 1 + len(name.encode()) + 1
        self.root_at = BEGIN
        body = bytes([len(name.encode())]) + name.encode() + b"\0"
        self.directory_at = BEGIN + self.name_bytes
        self._key("TFile", name, "", body + self._directory(0, 0, BEGIN, 0), None)

    # ---- records

    def _key_length(self, class_name: str, name: str, title: str) -> int:
        return KEY_BASE(class_name, name, title)

    def _key_head(self, class_name: str, name: str, title: str, stored: int, length: int, at: int, extra: int = 0) -> bytes:
        b = Buffer()
        size = self._key_length(class_name, name, title) + extra
        b.put("ihiIhhqq", size + stored, 1004, length, DATIME, size, 1, at, BEGIN)
        for s in (class_name, name, title):
            b.string(s)
        return bytes(b.data)

    def _key(self, class_name: str, name: str, title: str, body: bytes, codec: str | None) -> tuple[int, int, bytes]:
        at = self.out.tell()
        stored = compress(body, codec, self.frame)
        head = self._key_head(class_name, name, title, len(stored), len(body), at)
        self.out.write(head + stored)
        return at, len(head) + len(stored), head

    def _directory(self, keys_at: int, keys_bytes: int, at: int, parent: int) -> bytes:
        b = Buffer()
        b.put("hIIiiqqq", 1005, DATIME, DATIME, keys_bytes, self.name_bytes if at == BEGIN else 0, at, parent, keys_at)
        b.put("h", 1)
        b.data += b"\0" * 16
        return bytes(b.data)

    # ---- data

    def write(self, batch: pa.RecordBatch | pa.Table | dict) -> None:
        """Appends rows; structs hold the members of groups."""
        table = batch if isinstance(batch, dict) else {n: batch[n] for n in batch.schema.names}
        arrays = {k: v.combine_chunks() if isinstance(v, pa.ChunkedArray) else v for k, v in table.items()}
        arrays = {k: v.chunk(0) if isinstance(v, pa.ChunkedArray) else v for k, v in arrays.items()}
        n = None
        for path, w in self.columns_out.items():
            values = arrays[path[0]]
            if len(path) == 2:
                values = values.field(path[1])
            n = len(values) if n is None else n
            if len(values) != n:
                raise ValueError("columns of different length")
            if n:
                self._basket(w, values)
        self.entries += n or 0

    def _basket(self, w: Written, values) -> None:
        c, n = w.column, len(values)
        width, offsets = c.primitive.width, None
        if c.kind in ("jagged", "vector"):
            lists = values if isinstance(values, pa.Array) else pa.array(values)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            first = np.r_[0, np.cumsum(np.asarray(lists.value_lengths().fill_null(0)))]
            content = self._encode(flat, c)
            offsets = first * width
            if c.kind == "vector":
                sizes = np.diff(first)
                heads = np.zeros((n, 10), np.uint8)
                heads[:, 0:4] = (((sizes * width + 6) | 0x40000000).astype(">u4")[:, None]).view(np.uint8)
                heads[:, 4:6] = np.frombuffer(struct.pack(">h", 9), np.uint8)
                heads[:, 6:10] = sizes.astype(">u4")[:, None].view(np.uint8)
                out = np.empty(len(content) + 10 * n, np.uint8)
                mask = np.ones(len(out), bool)
                offsets = offsets + 10 * np.arange(n + 1)
                places = (offsets[:-1, None] + np.arange(10)).ravel()
                mask[places] = False
                out[places], out[mask] = heads.ravel(), np.frombuffer(content, np.uint8)
                content = out.tobytes()
        elif c.kind == "fixed":
            lists = values if isinstance(values, pa.Array) else pa.array(values)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            if len(flat) != n * c.length:
                raise ValueError(f"{c.name} needs {c.length} values in each row")
            content = self._encode(flat, c)
        else:
            content = self._encode(values.to_numpy(zero_copy_only=False) if isinstance(values, pa.Array) else np.asarray(values), c)
        w.pending.append((content, offsets, n, self.entries))
        if len(w.pending) > 1 or not self.embed_last:
            self._flush(w)

    @staticmethod
    def _encode(flat: np.ndarray, c: Column) -> bytes:
        return np.asarray(flat).astype(np.dtype(c.primitive.disk).newbyteorder("="), copy=False).astype(c.primitive.disk).tobytes()

    def _basket_head(self, w: Written, content: bytes, n: int, flag: int, length: int) -> tuple[bytes, int]:
        size = self._key_length("TBasket", w.full_name, self.tree) + 19
        return struct.pack(">hiiiib", 3, max(32000, length), n + 1, n, size + len(content), flag), size

    def _flush(self, w: Written) -> None:
        content, offsets, n, start = w.pending.pop(0)
        head, size = self._basket_head(w, content, n, 0, len(content))
        body = content
        if offsets is not None:
            places = np.r_[offsets[:-1] + size, 0].astype(">i4").tobytes()
            body += struct.pack(">i", n + 1) + places
        stored = compress(body, self.codec, self.frame)
        at = self.out.tell()
        key = self._key_head("TBasket", w.full_name, self.tree, len(stored), len(body), at, 19)
        self.out.write(key + head + stored)
        w.sizes.append(len(key) + len(head) + len(stored))
        w.starts.append(start)
        w.seeks.append(at)
        w.total += len(body)
        if self.holes and len(w.seeks) == 1:  # an unused slot, as recovery leaves them
            w.sizes.append(0)
            w.starts.append(start + n)
            w.seeks.append(0)

    # ---- metadata

    def _leaf(self, b: Buffer, w: Written, leaf: dict) -> None:
        c, p = w.column, w.column.primitive
        values = {"fName": w.full_name.split(".")[-1], "fTitle": leaf["title"], "fLen": c.length if c.kind == "fixed" else 1, "fLenType": p.width, "fIsUnsigned": p.name.startswith("u"), "fLeafCount": leaf["counter"]}
        if c.kind == "vector":
            values |= {"fID": -1, "fType": -1}
        b.tagged(leaf, leaf["class"], lambda: b.struct(leaf["class"], values))

    def _branch(self, b: Buffer, w: Written | None, group: Group | None, leaves: dict[int, dict], keep: list) -> None:
        mark = object()
        keep.append(mark)
        if w is None:
            members = [self.columns_out[(group.name, m.name)] for m in group.columns]
            values = {"fName": group.name + ("." if group.prefixed else ""), "fTitle": group.name, "fEntries": self.entries, "fMaxBaskets": 1, "fBasketBytes": [0], "fBasketEntry": [0], "fBasketSeek": [0]}
            values |= {"fBranches": lambda: b.obj_array(members, lambda x: self._branch(b, x, None, leaves, keep)), "fLeaves": lambda: b.obj_array([], None), "fBaskets": lambda: b.obj_array([], None), "fClassName": group.name.title()}
            b.tagged(mark, "TBranchElement", lambda: b.struct("TBranchElement", values))
            return
        c = w.column
        n = len(w.seeks)
        slots = max(10, n + 2)
        pad = lambda xs, tail=0: [*xs, tail, *[0] * (slots - len(xs) - 1)]
        flushed = self.entries - sum(x[2] for x in w.pending)
        leaf = leaves[id(w)]
        title = w.full_name if c.kind == "vector" else leaf["title"] + ("" if "/" in leaf["title"] else f"/{c.primitive.suffix}")
        values = {"fName": w.full_name, "fTitle": title, "fBasketSize": 32000, "fEntryOffsetLen": 1000 if c.kind in ("jagged", "vector") else 0, "fWriteBasket": n, "fEntryNumber": self.entries, "fMaxBaskets": slots, "fEntries": self.entries, "fTotBytes": w.total, "fZipBytes": sum(w.sizes)}
        values |= {"fBasketBytes": pad(w.sizes), "fBasketEntry": pad(w.starts, flushed), "fBasketSeek": pad(w.seeks)}
        values |= {"fBranches": lambda: b.obj_array([], None), "fLeaves": lambda: b.obj_array([leaf], lambda x: self._leaf(b, w, x)), "fBaskets": lambda: b.obj_array(w.pending, lambda x: self._embedded(b, w, x, keep))}
        kind = "TBranch"
        if c.kind == "vector":
            kind = "TBranchElement"
            values |= {"fClassName": f"vector<{c.primitive.cpp}>", "fID": -1, "fStreamerType": -1}
        b.tagged(mark, kind, lambda: b.struct(kind, values))

    def _embedded(self, b: Buffer, w: Written, pending: tuple, keep: list) -> None:
        content, offsets, n, _ = pending
        mark = object()
        keep.append(mark)

        def body():
            head, size = self._basket_head(w, content, n, 11 if offsets is not None else 12, len(content))
            key = self._key_head("TBasket", w.full_name, self.tree, 0, len(content), 0, 19)
            b.data += key + head
            if offsets is not None:
                b.put("i", n + 1)
                b.data += np.r_[offsets[:-1] + size, 0].astype(">i4").tobytes()
            b.data += b"\0" * size + content

        b.tagged(mark, "TBasket", body)

    def close(self) -> None:
        tree_b = Buffer(self._key_length("TTree", self.tree, ""))
        b, keep, leaves, by_name = tree_b, [], {}, {}
        for path, w in self.columns_out.items():
            c = w.column
            counter = by_name.get(c.counter) if c.counter else None
            shape = f"[{c.length}]" if c.kind == "fixed" else f"[{c.counter}]" if c.kind == "jagged" else ""
            leaf = {"class": "TLeafElement" if c.kind == "vector" else f"TLeaf{LEAF_OF[c.type_name]}", "title": f"{w.full_name.split('.')[-1]}{shape}", "counter": None}
            if counter is not None:
                other, held = counter
                leaf["counter"] = lambda other=other, held=held: self._leaf(b, other, held)
            leaves[id(w)] = leaf
            by_name[w.full_name] = (w, leaf)
        every = [self.columns_out[(c.name,)] if isinstance(c, Column) else c for c in self.columns]
        values = {"fName": self.tree, "fTitle": "", "fEntries": self.entries, "fTotBytes": sum(w.total for w in self.columns_out.values()), "fWeight": 1.0, "fMaxEntries": 1_000_000_000, "fEstimate": 1_000_000}
        values |= {"fBranches": lambda: b.obj_array(every, lambda x: self._branch(b, None, x, leaves, keep) if isinstance(x, Group) else self._branch(b, x, None, leaves, keep)), "fLeaves": lambda: b.obj_array([], None)}
        b.struct("TTree", values)
        at, size, head = self._key("TTree", self.tree, "", bytes(b.data), self.codec)
        keys = [head]
        parents = list(self.folders)
        while parents:  # from the inside out
            name = parents.pop()
            list_at, list_size, _ = self._key("TDirectory", name, "", struct.pack(">i", len(keys)) + b"".join(keys), None)
            here = self.out.tell()
            _, _, head = self._key("TDirectory", name, "", self._directory(list_at, list_size, here, BEGIN), None)
            keys = [head]
        list_at, list_size, _ = self._key("TFile", os.path.basename(self.path), "", struct.pack(">i", len(keys)) + b"".join(keys), None)
        info_at, info_size, _ = self._key("TList", "StreamerInfo", "Doubly linked list", streamer_infos(list(CLASSES)), self.codec)
        end = self.out.tell()
        self.out.seek(self.directory_at)
        self.out.write(self._directory(list_at, list_size, BEGIN, 0))
        self.out.seek(0)
        version, wide = (1_062_206, "q") if self.large or end >= 1 << 31 else (62_206, "i")
        self.out.write(struct.pack(f">4sii{wide}{wide}iiibi{wide}i", b"root", version, BEGIN, end, 0, 0, 1, self.name_bytes, 4 if wide == "i" else 8, 0, info_at, info_size))
        self.out.close()

    def __enter__(self) -> TreeWriter:
        return self

    def __exit__(self, kind, *_) -> None:
        if kind is None:
            self.close()
        else:
            self.out.close()


def parse_types(spec: str | None) -> dict[str, tuple[str | None, str | None, int]]:
    """Physical types by column from "a=uint, b=float[64], c=vector, d=vector uchar": (type, kind, length)."""
    out: dict[str, tuple[str | None, str | None, int]] = {}
    for item in (spec or "").split(","):
        name, _, given = (x.strip() for x in item.partition("="))
        if not name:
            continue
        vector, given = given.startswith("vector"), given.removeprefix("vector").strip()
        base, _, rest = given.partition("[")
        if base and base not in PRIMITIVES:
            raise ValueError(f"no type {base} for column {name}")
        out[name] = (base or None, "vector" if vector else "fixed" if rest else None, int(rest.rstrip("]")) if rest else 1)
    return out


def columns_for(schema: pa.Schema, types: dict[str, tuple[str | None, str | None, int]] | None = None) -> list[Column | Group]:
    """How an Arrow schema is written: primitives as scalars, fixed-size lists as fixed arrays, lists as jagged ones, structs as
    groups; types may say otherwise for a column."""
    types = types or {}
    by_type = {p.arrow: p.name for p in reversed(list(PRIMITIVES.values())) if p.name in ("bool", "char", "short", "int", "long", "float", "double")}
    by_type |= {pa.uint8(): "uchar", pa.uint16(): "ushort", pa.uint32(): "uint", pa.uint64(): "ulong"}

    def one(f: pa.Field) -> Column | Group:
        if f.name in types and not pa.types.is_struct(f.type):
            base, kind, length = types[f.name]
            item = f.type.value_type if pa.types.is_list(f.type) or pa.types.is_large_list(f.type) else f.type
            kind = kind or ("jagged" if item is not f.type else "scalar")
            return Column(f.name, base or by_type[item], kind, length, f"n_{f.name}" if kind == "jagged" else None)
        if pa.types.is_struct(f.type):
            return Group(f.name, [one(f.type.field(k)) for k in range(f.type.num_fields)])
        if pa.types.is_fixed_size_list(f.type):
            return Column(f.name, by_type[f.type.value_type], "fixed", f.type.list_size)
        if pa.types.is_list(f.type) or pa.types.is_large_list(f.type):
            return Column(f.name, by_type[f.type.value_type], "jagged", counter=f"n_{f.name}")
        if f.type not in by_type and f.name not in types:
            raise TypeError(f"column {f.name} of type {f.type} can't be written")
        return Column(f.name, by_type[f.type])

    return [one(f) for f in schema]


def write_tree(path: str, tree: str, batches: Iterable, columns: list[Column | Group], **options) -> None:
    """Writes a file under a temporary name and moves it into place when it is whole."""
    temporary = f"{path}.{uuid.uuid4().hex}.tmp"
    try:
        with TreeWriter(temporary, tree, columns, **options) as w:
            for batch in batches:
                w.write(batch)
        os.replace(temporary, path)
    finally:
        if os.path.exists(temporary):
            os.unlink(temporary)
