"""Trees and branches: physical types, and the table of baskets of each branch."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np

from ..types import BY_CODE, BY_CPP, BY_LEAF, BY_SUFFIX, PRIMITIVES, Primitive, UnsupportedBranch
from .container import EventFile
from .streaming import EmbeddedBasket

VECTOR = re.compile(r"(?:std::)?vector<\s*([\w ]+?)\s*>")
SUFFIX = re.compile(r"/([A-Za-z])$")
SHAPE = re.compile(r"\[([^\]]*)\]")
#: A vector's entry starts with its own byte count, version and size.
VECTOR_HEADER = 10


@dataclass(frozen=True)
class Shape:
    """scalar; fixed with a length; or jagged with bytes to skip at the start of an entry."""

    kind: str
    length: int = 1
    skip: int = 0


def basket_table(entries: int, sizes, starts, seeks, write_basket: int, embedded: list[EmbeddedBasket | None]) -> tuple[list[int], list[int], list[int]]:
    """(slots of baskets on disk, entry offsets of all baskets with an end cap, embedded baskets in use by number).

    A slot holds a basket on disk if it has a place in the file and isn't the one being written. Baskets that are still in
    the tree's own record follow the last of those, but only for entries beyond it: where the baskets on disk hold all
    entries, embedded ones are left-overs. The cap is the number of entries.
    """
    n = min(len(seeks), len(starts), len(sizes))
    on_disk = [i for i in range(n) if seeks[i] != 0 and sizes[i] != 0]
    kept = [k for k, b in enumerate(embedded) if b is not None]

    def end(slots: list[int]) -> int | None:
        """Where the baskets of these slots end, if the next slot's first entry says so."""
        if not slots:
            return 0
        after = slots[-1] + 1
        return int(starts[after]) if after < len(starts) and starts[after] > starts[slots[-1]] else None

    if kept and on_disk and (done := end(on_disk)) is not None and done >= entries:
        kept, write_basket = [], -1
    loose = [i for i in on_disk if i != write_basket] if kept else on_disk
    if kept:
        done = end(loose)
        least = done if done is not None else int(starts[loose[-1]]) + 1
        while kept and entries - sum(embedded[k].entries for k in kept) < least:
            kept.pop(0)
    offsets, at = [int(starts[i]) for i in loose], entries - sum(embedded[k].entries for k in kept)
    for k in kept:
        offsets.append(at)
        at += embedded[k].entries
    return loose, [*offsets, entries] if offsets else [0], kept


@dataclass
class Branch:
    file: EventFile = field(repr=False)
    tree: str
    raw: dict = field(repr=False)
    parent: Branch | None = field(default=None, repr=False)

    @property
    def name(self) -> str:
        return self.raw["fName"]

    @property
    def title(self) -> str:
        return self.raw["fTitle"]

    @property
    def short_name(self) -> str:
        """Without the parent's name in front, and without a dot at either end."""
        n = self.name
        if self.parent is not None and n.startswith(self.parent.name):
            n = n[len(self.parent.name) :]
        return n.removesuffix(".").removeprefix(".")

    @property
    def children(self) -> list[Branch]:
        made = [Branch(self.file, self.tree, b, self) for b in self.raw.get("fBranches") or [] if isinstance(b, dict)]
        return [b for b in made if b.leaves or b.children]

    @property
    def leaves(self) -> list[dict]:
        return [x for x in self.raw.get("fLeaves") or [] if isinstance(x, dict)]

    def leaf_code(self, leaf: dict) -> int:
        """The element code behind fType: of the type itself, or, for a member of a collection, of its elements."""
        code = int(leaf.get("fType", 0))
        counter = leaf.get("fLeafCount")
        if 40 < code < 61 and isinstance(counter, dict) and "fType" in counter and not code - 40 in BY_CODE:
            code = int(counter["fType"])
        elif 20 < code < 60:
            code %= 20
        return code

    @property
    def primitive(self) -> Primitive:
        m = SUFFIX.search(self.title)
        if m:
            if m[1] not in BY_SUFFIX:
                raise UnsupportedBranch(f"{self.name}: type /{m[1]}")
            return BY_SUFFIX[m[1]]
        class_name = self.raw.get("fClassName", "")
        v = VECTOR.fullmatch(class_name)
        if v and v[1] in BY_CPP:
            return BY_CPP[v[1]]
        if len(self.leaves) != 1:
            raise UnsupportedBranch(f"{self.name}: {len(self.leaves)} leaves")
        leaf = self.leaves[0]
        m = SUFFIX.search(leaf.get("fTitle", ""))
        if m and m[1] in BY_SUFFIX:
            return BY_SUFFIX[m[1]]
        kind = leaf["class"]
        if kind in BY_LEAF:
            return PRIMITIVES[BY_LEAF[kind][bool(leaf.get("fIsUnsigned"))]]
        if kind == "TLeafElement" and not class_name.startswith(("vector<", "std::vector<")) and self.leaf_code(leaf) in BY_CODE:
            return PRIMITIVES[BY_CODE[self.leaf_code(leaf)]]
        raise UnsupportedBranch(f"{self.name}: leaf of class {kind}, branch of class {class_name!r}")

    @property
    def shape(self) -> Shape:
        if VECTOR.fullmatch(self.raw.get("fClassName", "")):
            return Shape("jagged", skip=VECTOR_HEADER)
        if len(self.leaves) != 1:
            raise UnsupportedBranch(f"{self.name}: {len(self.leaves)} leaves")
        leaf = self.leaves[0]
        sizes = SHAPE.findall(leaf.get("fTitle", ""))
        if len(sizes) > 1:
            raise UnsupportedBranch(f"{self.name}: {len(sizes)} dimensions")
        if not sizes:
            return Shape("fixed", int(leaf["fLen"])) if int(leaf.get("fLen", 1)) > 1 and not leaf.get("fLeafCount") else Shape("jagged") if leaf.get("fLeafCount") else Shape("scalar")
        return Shape("fixed", int(sizes[0])) if sizes[0].isdigit() else Shape("jagged")

    @property
    def embedded(self) -> list[EmbeddedBasket]:
        """Those in the tree's own record; baskets() says which are in use."""
        return [b for b in self.raw.get("fBaskets") or [] if isinstance(b, EmbeddedBasket) and b.entries]

    @property
    def entries(self) -> int:
        return int(self.raw["fEntries"])

    def baskets(self) -> tuple[list[tuple[int, int]], list[int], list[int]]:
        """((seek, bytes) of the baskets on disk, entry offsets of these and then the embedded ones in use, with a cap, the numbers of these)."""
        r = self.raw
        loose, offsets, kept = basket_table(self.entries, r["fBasketBytes"], r["fBasketEntry"], r["fBasketSeek"], int(r["fWriteBasket"]) if self.embedded else -1, self.embedded)
        return [(int(r["fBasketSeek"][i]), int(r["fBasketBytes"][i])) for i in loose], offsets, kept


class Tree:
    """A tree of an open file."""

    def __init__(self, file: EventFile, name: str):
        self.file, self.name = file, name
        key = file.find(name)
        if key.class_name not in ("TTree", "TNtuple", "TNtupleD", "TChain"):
            raise KeyError(f"{name} of {file.path} is a {key.class_name}, no tree")
        self.raw = file.object(key)

    @property
    def entries(self) -> int:
        return int(self.raw["fEntries"])

    @property
    def index(self) -> tuple[np.ndarray, np.ndarray]:
        return np.asarray(self.raw.get("fIndexValues", ())), np.asarray(self.raw.get("fIndex", ()))

    def branches(self) -> list[Branch]:
        made = [Branch(self.file, self.name, b) for b in self.raw.get("fBranches") or [] if isinstance(b, dict)]
        return [b for b in made if b.leaves or b.children]

    def branch(self, path: tuple[str, ...] | str) -> Branch:
        """A branch by its names in the schema, or by its full name."""
        if isinstance(path, str):
            stack = self.branches()
            while stack:
                b = stack.pop(0)
                if b.name.removesuffix(".") == path.removesuffix("."):
                    return b
                stack = b.children + stack
            raise KeyError(f"{self.name} has no branch {path}")
        level, found = self.branches(), None
        for part in path:
            found = next((b for b in level if b.short_name == part), None)
            if found is None:
                raise KeyError(f"{self.name} has no branch {'.'.join(path)}")
            level = found.children
        return found
