"""Object decoding driven by the streamer infos that a file carries."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

from .binary import Cursor, FormatError

NEW_CLASS, CLASS_MASK, MAP_OFFSET = 0xFFFFFFFF, 0x80000000, 2
#: Element code -> how a basic value is stored.
BASIC = {1: "b", 2: "h", 3: "i", 4: "q", 5: "f", 6: "i", 7: "i", 8: "d", 9: "f", 11: "B", 12: "H", 13: "I", 14: "Q", 15: "I", 16: "q", 17: "Q", 18: "?", 19: "f"}


@dataclass
class Element:
    kind: str
    name: str
    title: str
    type: int
    length: int
    type_name: str
    base_version: int = 0
    count_name: str = ""


@dataclass
class Info:
    name: str
    version: int
    elements: list[Element] = field(default_factory=list)


@dataclass
class EmbeddedBasket:
    """A basket inside the tree's own record: its content, and the entries' byte offsets if they have any."""

    key_length: int
    last: int
    entries: int
    content: bytes
    offsets: np.ndarray | None


def t_object(c: Cursor) -> dict:
    version = c.u2()
    if version & 0x4000:  # a byte count came first
        c.take(4)
    unique, bits = c.unpack("II")
    if bits & 0x10:
        c.take(2)
    return {"fUniqueID": unique, "fBits": bits}


def t_named(c: Cursor) -> dict:
    _, end = c.record()
    t_object(c)
    out = {"fName": c.string(), "fTitle": c.string()}
    c.close(end, "TNamed")
    return out


def element(kind: str):
    """Readers of the bootstrap classes, which describe all others."""

    def common(c: Cursor) -> Element:
        version, end = c.record()
        named = t_named(c)
        type_, _, length, _ = c.unpack("iiii")
        if version == 1:
            c.take(4 * c.i4())
        else:
            c.take(20)
        out = Element(kind, named["fName"], named["fTitle"], type_, length, c.string())
        if version == 3:
            c.take(24)
        c.close(end, "TStreamerElement")
        return out

    def read(c: Cursor) -> Element:
        version, end = c.record()
        if kind == "TStreamerSTLstring":
            _, inner = c.record()
            out = common(c)
            c.unpack("ii")  # kinds of container and of content
            c.close(inner, "TStreamerSTL")
        else:
            out = common(c)
            if kind == "TStreamerBase" and version > 2:
                out.base_version = c.i4()
            elif kind == "TStreamerSTL":
                c.unpack("ii")
            elif kind in ("TStreamerBasicPointer", "TStreamerLoop"):
                c.i4()
                out.count_name = c.string()
                c.string()  # the class that has the count
        c.close(end, kind)
        return out

    return read


KINDS = ("Base BasicType BasicPointer Loop Object ObjectPointer ObjectAny ObjectAnyPointer String STL STLstring Artificial").split()


class Decoder:
    """Decodes objects of one file into dicts of their members; embedded baskets become EmbeddedBasket."""

    def __init__(self, infos: dict[str, dict[int, Info]] | None = None):
        self.infos = infos or {}
        self.fixed = {
            "TObject": t_object,
            "TNamed": t_named,
            "TObjString": self._obj_string,
            "TList": self._list,
            "THashList": self._list,
            "TObjArray": self._array,
            "TStreamerInfo": self._info,
            "TBasket": self._basket,
            **{f"TStreamer{k}": element(f"TStreamer{k}") for k in KINDS},
        }
        for letter, dtype in (("D", ">f8"), ("F", ">f4"), ("I", ">i4"), ("S", ">i2"), ("L64", ">i8"), ("C", ">i1")):
            self.fixed["TArray" + letter] = lambda c, d=np.dtype(dtype): np.frombuffer(c.take(c.i4() * d.itemsize), d)

    # ---- fixed classes

    def _obj_string(self, c: Cursor) -> str:
        _, end = c.record()
        t_object(c)
        out = c.string()
        c.close(end, "TObjString")
        return out

    def _list(self, c: Cursor) -> list:
        _, end = c.record()
        t_object(c)
        c.string()
        out = []
        for _ in range(c.i4()):
            out.append(self.any(c))
            c.take(c.u1())
        c.close(end, "TList")
        return out

    def _array(self, c: Cursor) -> list:
        version, end = c.record()
        if version > 2:
            t_object(c)
        if version > 1:
            c.string()
        n, _ = c.unpack("ii")
        out = [self.any(c) for _ in range(n)]
        c.close(end, "TObjArray")
        return out

    def _info(self, c: Cursor) -> Info:
        _, end = c.record()
        name = t_named(c)["fName"]
        _, version = c.unpack("Ii")
        out = Info(name, version, [e for e in self.any(c) or [] if isinstance(e, Element)])
        c.close(end, "TStreamerInfo")
        return out

    def _basket(self, c: Cursor) -> EmbeddedBasket | None:
        _, version, _, _, key_length, _ = c.unpack("ihiIhh")
        c.take(16 if version > 1000 else 8)
        for _ in range(3):
            c.string()
        _, _, _, entries, last, flag = c.unpack("hiiiib")
        if not flag:
            return None
        offsets = None
        if flag % 10 != 2 and entries:
            offsets = np.frombuffer(c.take(4 * c.i4()), ">i4").astype(np.int64)
            if flag > 40:
                c.take(4 * c.i4())
        if flag != 1 and flag <= 10:
            return None
        return EmbeddedBasket(key_length, last, entries, c.take(last)[key_length:], offsets)

    # ---- objects

    def any(self, c: Cursor):
        """An object with its class tag, or one that was seen before."""
        at = c.pos + c.base
        count = c.u4()
        end = None
        if count & 0x40000000 and count != NEW_CLASS:
            end = c.pos + (count & ~0x40000000)
            tag_at, tag = c.pos + c.base, c.u4()
        else:
            tag_at, tag = at, count
        if not tag & CLASS_MASK:
            if tag == 0:
                return None
            found = c.seen.get(tag)
            if end is not None:
                c.pos = end
            return found
        if tag == NEW_CLASS:
            name = c.c_string()
            c.seen[tag_at + MAP_OFFSET] = name
        else:
            name = c.seen.get(tag & ~CLASS_MASK)
            if not isinstance(name, str):
                raise FormatError("reference to an unknown class")
        holder: dict = {"class": name}
        c.seen[at + MAP_OFFSET] = holder
        out = self.object(name, c, holder)
        if out is not holder:
            c.seen[at + MAP_OFFSET] = out
        c.close(end, name)
        return out

    def object(self, name: str, c: Cursor, into: dict | None = None):
        if name in self.fixed:
            return self.fixed[name](c)
        out = {"class": name} if into is None else into
        version, end = c.record()
        known = self.infos.get(name)
        if not known:
            if end is None:
                raise FormatError(f"nothing describes class {name}")
            c.pos = end
            return out
        if version == 0 and end is not None:  # a class without a version has a checksum in its place
            c.u4()
        info = known.get(version) or known[max(known)]
        for e in info.elements:
            if end is not None and c.pos >= end and e.type != 0 and version not in known:
                break  # described by another version, which has more members
            self._member(e, c, out)
        c.close(end, name)
        return out

    def _member(self, e: Element, c: Cursor, out: dict) -> None:
        t = e.type
        if e.kind == "TStreamerBase":
            if e.name == "TObject":
                t_object(c)
            elif e.name in self.fixed:
                made = self.fixed[e.name](c)
                out.update(made) if isinstance(made, dict) else out.__setitem__(e.name, made)
            else:
                self.object(e.name, c, out)
        elif t in BASIC:
            out[e.name] = c.unpack(BASIC[t])
        elif 20 < t < 40 and t - 20 in BASIC:
            d = np.dtype(">" + BASIC[t - 20])
            out[e.name] = np.frombuffer(c.take(e.length * d.itemsize), d)
        elif 40 < t < 60 and t - 40 in BASIC:
            d = np.dtype(">" + BASIC[t - 40])
            present = c.u1()
            out[e.name] = np.frombuffer(c.take(int(out[e.count_name]) * d.itemsize) if present else b"", d)
        elif t == 65:
            out[e.name] = c.string()
        elif t == 66:
            out[e.name] = t_object(c)
        elif t == 67:
            out[e.name] = t_named(c)
        elif t in (61, 62):
            out[e.name] = self.object(e.type_name.rstrip("*"), c)
        elif t in (63, 64, 68, 69):
            out[e.name] = self.object(e.type_name.rstrip("*"), c) if t in (63, 68) else self.any(c)
        elif t in (300, 365, 500):
            _, end = c.record()
            if end is None:
                raise FormatError(f"no size of member {e.name}")
            c.pos = end
        elif e.kind == "TStreamerArtificial":
            pass
        else:
            raise FormatError(f"element type {t} of member {e.name}")


def read_infos(c: Cursor) -> dict[str, dict[int, Info]]:
    out: dict[str, dict[int, Info]] = {}
    for info in Decoder()._list(c):
        if isinstance(info, Info):
            out.setdefault(info.name, {})[info.version] = info
    return out
