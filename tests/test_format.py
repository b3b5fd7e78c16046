"""The file format: golden bytes, round trips of our own files, and pure functions by hand-made cases.

Files made by our writer can't prove that other writers' files are read; the golden basket is the one piece of foreign data.
"""

import itertools
import struct

import numpy as np
import pyarrow as pa
import pytest

from eventframe.sources.api import count_events, open_events
from eventframe.sources.options import OptionError, Options
from eventframe.sources.planning import ColumnPlan, overlap
from eventframe.sources.rootio.binary import Cursor, FormatError
from eventframe.sources.rootio.compression import compress, decompress
from eventframe.sources.rootio.container import FileCache
from eventframe.sources.rootio.decoding import clip, join, piece, split_payload
from eventframe.sources.rootio.streaming import EmbeddedBasket
from eventframe.sources.rootio.trees import basket_table
from eventframe.sources.schema import prune, schema_of
from eventframe.sources.types import PRIMITIVES
from eventframe.sources.writer import Column, Group, TreeWriter, write_tree

# A basket of nine entries of 32-bit integers, stored with a key of 77 bytes.
GOLDEN = struct.pack(">9i", 1, 2, 2, -2147483647, -2147483646, -2147483646, 2147483646, 2147483645, 2147483645) + struct.pack(">i", 10) + struct.pack(">10i", 77, 77, 81, 89, 89, 93, 101, 101, 105, 0)
ROWS = [[], [1], [2, 2], [], [-2147483647], [-2147483646, -2147483646], [], [2147483646], [2147483645, 2147483645]]


def golden():
    content, offsets = split_payload(GOLDEN, 113 - 77, 77)
    return piece(content, offsets, PRIMITIVES["int"], "jagged", 0)


def test_golden_basket():
    assert join([golden()], PRIMITIVES["int"], "jagged", 1).to_pylist() == ROWS


@pytest.mark.parametrize("copies", [1, 3])
def test_every_range_of_golden_baskets(copies):
    rows, starts = ROWS * copies, list(range(0, 9 * copies + 1, 9))
    for start, stop in itertools.combinations(range(len(rows) + 1), 2):
        lo, hi = overlap(starts, start, stop)
        parts = [clip(golden(), "jagged", 1, max(start, starts[k]) - starts[k], min(stop, starts[k + 1]) - starts[k]) for k in range(lo, hi)]
        assert join(parts, PRIMITIVES["int"], "jagged", 1).to_pylist() == rows[start:stop]


def test_overlap_and_trim():
    starts = (0, 10, 22, 30, 41)
    assert [overlap(starts, *r) for r in ((0, 10), (10, 25), (20, 41), (5, 5), (40, 41))] == [(0, 1), (1, 3), (1, 4), (0, 0), (3, 4)]
    c = ColumnPlan(("x",), "int", "scalar", 1, 0, starts, ((1, 1), (2, 2), (3, 3)), (0,))
    t = c.trim(20, 41)
    assert t.starts == (10, 22, 30, 41) and t.baskets == ((2, 2), (3, 3)) and t.embedded == (0,)
    assert c.trim(0, 5).embedded == ()


def test_basket_table():
    assert basket_table(9, [96] + [0] * 9, [0, 9] + [0] * 8, [1558] + [0] * 9, 1, []) == ([0], [0, 9], [])
    two = [EmbeddedBasket(77, 100, 4000, b"", None), EmbeddedBasket(77, 100, 392, b"", None)]
    assert basket_table(132_056, [9, 9, 0], [0, 63_832, 127_664], [5, 6, 0], 2, two) == ([0, 1], [0, 63_832, 127_664, 131_664, 132_056], [0, 1])
    assert basket_table(30, [9, 0, 9], [0, 0, 10], [5, 0, 6], 3, []) == ([0, 2], [0, 10, 30], [])  # a hole
    assert basket_table(0, [], [], [], 0, []) == ([], [0], [])
    assert basket_table(9, [0], [0], [0], 0, [EmbeddedBasket(77, 100, 9, b"", None)]) == ([], [0, 9], [0])


def test_left_over_embedded_baskets():
    """Embedded baskets count only for entries beyond those on disk."""
    old = [EmbeddedBasket(77, 100, 20, b"", None)]
    assert basket_table(100, [9, 9, 0], [0, 50, 100], [5, 6, 0], 2, old) == ([0, 1], [0, 50, 100], [])
    assert basket_table(100, [9, 9, 0], [0, 50, 100], [5, 6, 0], 1, old) == ([0, 1], [0, 50, 100], [])  # the slot being written is on disk
    assert basket_table(120, [9, 9, 0], [0, 50, 100], [5, 6, 0], 2, [*old, *old]) == ([0, 1], [0, 50, 100, 120], [1])
    assert basket_table(60, [9, 9], [0, 50], [5, 6], 5, old) == ([0, 1], [0, 50, 60], [])  # nothing says where the last one ends


def test_byte_counts_are_exact():
    from eventframe.sources.rootio.streaming import Decoder, Element, Info

    def record(version, body):
        return struct.pack(">IH", 0x40000000 | (len(body) + 2), version) + body

    infos = {"Bits": {1: Info("Bits", 1, [Element("TStreamerBasicType", "fBits", "", 11, 0, "unsigned char")])}}
    assert Decoder(infos).object("Bits", Cursor(record(1, b"\x1a")))["fBits"] == 26
    assert Decoder(infos).object("Bits", Cursor(record(0, b"\x1a\xa1\x2f\x10" + b"\x07")))["fBits"] == 7  # a checksum comes first
    for body in (b"", b"\x1a\x00"):
        with pytest.raises(FormatError):
            Decoder(infos).object("Bits", Cursor(record(1, body)))


@pytest.mark.parametrize("codec", ["raw", "zlib", "lzma", "lz4", "zstd"])
@pytest.mark.parametrize("frame", [100, 1 << 20])
def test_codecs(codec, frame):
    data = b"abcdef" * 500 + bytes(range(256))
    assert decompress(compress(data, codec, frame), len(data)) == data


def test_broken_frames():
    good = compress(b"x" * 1000, "zlib")
    with pytest.raises(FormatError):
        decompress(b"CS" + good[2:], 1000)
    with pytest.raises(FormatError):
        decompress(good[:-3], 1000)
    with pytest.raises(FormatError):
        Cursor(b"ab").i4()


def table_of_all_types(n=9):
    i = np.arange(n)
    t = {}
    for bits in (8, 16, 32, 64):
        low, high, top = -(2 ** (bits - 1)), 2 ** (bits - 1) - 1, 2**bits - 1
        t[f"I{bits}"] = pa.array([0, 1, 2, low, low + 1, low + 2, high, high - 1, high - 2], pa.type_for_alias(f"int{bits}"))
        t[f"UI{bits}"] = pa.array([0, 1, 2, 0, 1, 2, top, top - 1, top - 2], pa.type_for_alias(f"uint{bits}"))
    t["I1"], t["UI1"] = pa.array(i % 2 == 1), pa.array(i % 2 == 0)
    names = {"I1": "bool", "UI1": "bool", "I8": "char", "UI8": "uchar", "I16": "short", "UI16": "ushort", "I32": "int", "UI32": "uint", "I64": "long", "UI64": "ulong"}
    columns, data = [Column("nSlice", "char")], {"nSlice": pa.array((i % 3).astype("i1"))}
    for k, x in t.items():
        columns += [Column(f"Scalar{k}", names[k]), Column(f"Array{k}", names[k], "fixed", 3), Column(f"Slice{k}", names[k], "jagged", counter="nSlice"), Column(f"Vector{k}", names[k], "vector")]
        data[f"Scalar{k}"] = x
        data[f"Array{k}"] = pa.array([[v.as_py()] * 3 for v in x], pa.list_(x.type))
        data[f"Slice{k}"] = data[f"Vector{k}"] = pa.array([[v.as_py()] * (j % 3) for j, v in enumerate(x)], pa.list_(x.type))
    return columns, data, t


@pytest.fixture(scope="module")
def all_types(tmp_path_factory):
    path = str(tmp_path_factory.mktemp("f") / "all.root")
    columns, data, t = table_of_all_types()
    write_tree(path, "Events", [{k: v.slice(a, 3) for k, v in data.items()} for a in range(0, 9, 3)], columns)
    return path, t


def test_all_types(all_types):
    path, t = all_types
    v = open_events(path)
    assert len(v.names) == 41 and v.entries == 9
    for k, x in t.items():
        want = [y - 2**64 if k == "UI64" and y >= 2**63 else y for y in x.to_pylist()]
        assert v.array(f"Scalar{k}").to_pylist() == want
        assert v.array(f"Array{k}").to_pylist() == [[y] * 3 for y in want]
        for shape in ("Slice", "Vector"):
            for start, stop in itertools.combinations(range(10), 2):
                assert v.array(f"{shape}{k}", start, stop).to_pylist() == [[y] * (j % 3) for j, y in enumerate(want)][start:stop]


def test_schema(all_types):
    from pyspark.sql import types as T

    s = schema_of(open_events(all_types[0]).tree)
    assert s["ScalarUI32"].dataType == T.LongType() and s["ScalarUI32"].metadata == {"rootType": "uint"} and not s["ScalarUI32"].nullable
    assert s["SliceUI8"].dataType == T.ArrayType(T.ShortType(), False) and s["VectorI1"].dataType == T.ArrayType(T.BooleanType(), False)
    assert prune(s, ("SliceI8", "nSlice")).names == ["SliceI8", "nSlice"]
    with pytest.raises(ValueError, match="no column"):
        prune(s, ("none",))


@pytest.mark.parametrize("embed,large,holes,codec", list(itertools.product([False, True], [False, True], [False, True], ["raw", "zlib"])))
def test_layouts(tmp_path, embed, large, holes, codec):
    """Baskets in the tree's own record, 64-bit headers, unused slots, trees in folders, nested branches."""
    path = str(tmp_path / "x.root")
    columns = [Column("a", "double"), Column("n", "int"), Column("j", "float", "jagged", counter="n"), Column("v", "ushort", "vector"), Group("g", [Column("x", "int"), Column("P3y", "long")]), Group("h", [Column("z", "int")], prefixed=False)]
    n = np.arange(50)
    data = {
        "a": pa.array(n * 0.5),
        "n": pa.array((n % 4).astype("i4")),
        "j": pa.array([[k] * (k % 4) for k in n.tolist()], pa.list_(pa.float32())),
        "v": pa.array([[65535 - k] * (k % 3) for k in n.tolist()], pa.list_(pa.uint16())),
        "g": pa.StructArray.from_arrays([pa.array(n.astype("i4")), pa.array(n)], ["x", "P3y"]),
        "h": pa.StructArray.from_arrays([pa.array(n.astype("i4"))], ["z"]),
    }
    write_tree(path, "d1/d2/t", [{k: x.slice(a, 20) for k, x in data.items()} for a in range(0, 50, 20)], columns, embed_last=embed, large=large, holes=holes, codec=codec)
    v = open_events(path, "d1/d2/t")
    assert v.names == ["a", "n", "j", "v", "g", "h"]
    for start, stop in [(0, 50), (19, 21), (40, 50), (0, 0), (7, 33)]:
        for c in "anjv":
            assert v.array(c, start, stop).to_pylist() == data[c].to_pylist()[start:stop]
        assert v.array(("g", "P3y"), start, stop).to_pylist() == n.tolist()[start:stop]
        assert v.array(("h", "z"), start, stop).to_pylist() == n.tolist()[start:stop]
    assert [b[:2] for b in v.baskets("a")] == [(0, 20), (20, 40), (40, 50)]
    assert (v.baskets("a")[-1][2] == 0) == embed


def test_empty_tree(tmp_path):
    path = str(tmp_path / "e.root")
    write_tree(path, "Events", [], [Column("a", "int"), Column("v", "float", "vector")])
    v = open_events(path)
    assert v.entries == 0 and v.array("a").to_pylist() == [] and v.array("v").to_pylist() == []


def test_missing_things(all_types, tmp_path):
    v = open_events(all_types[0])
    with pytest.raises(KeyError):
        open_events(all_types[0], "none")
    with pytest.raises(KeyError):
        v.branches("ScalarI8", "none")
    with pytest.raises(IndexError):
        v.array("ScalarI8", 0, 99)
    bad = tmp_path / "bad.root"
    bad.write_bytes(b"no such file at all")
    with pytest.raises(FormatError):
        open_events(str(bad))
    cut = tmp_path / "cut.root"
    cut.write_bytes(open(all_types[0], "rb").read()[:600])
    with pytest.raises(FormatError):
        open_events(str(cut))


def test_bytes_read_for_schema_and_plan(tmp_path):
    """The budget for opening, schema and plan of one column of 46 rows in several baskets: 22 000 bytes, 5 964 of them distinct."""
    path = str(tmp_path / "f.root")
    write_tree(path, "steps", [{"data": pa.array(np.arange(a, min(a + 6, 46), dtype="i4"))} for a in range(0, 46, 6)], [Column("data", "int")])
    profile = []
    v = open_events(path, "steps", profile)
    schema_of(v.tree)
    assert v.baskets("data")
    upper = [(at, n) for level, _, at, n, _, _ in profile if level == "upper"]
    assert sum(n for _, n in upper) <= 22_000
    lower = {b for level, _, at, n, _, _ in profile if level == "lower" for b in range(at, at + n)}
    assert len(lower) <= 5_964


def test_plan_size(tmp_path):
    import pickle

    from eventframe.sources.planning import plan_file
    from eventframe.sources.schema import leaves

    path = str(tmp_path / "wide.root")
    columns = [Column(f"column_{k}", "float") for k in range(1119)]
    write_tree(path, "Events", [{c.name: pa.array(np.zeros(10, "f4")) for c in columns}] * 4, columns)
    s = schema_of(open_events(path).tree)
    ranges = plan_file(path, "Events", leaves(s), 200_000)
    assert len(s) == 1119 and len(ranges) == 1 and len(pickle.dumps(ranges[0])) < 352_000


def test_options():
    o = Options.parse({"PATH": "b", "paths": '["c", "a"]', "ThreadCount": "0", "columns": "x, y.z"})
    assert o.paths == ("a", "b", "c") and o.threads == 0 and o.columns == ("x", "y.z") and o.tree == "Events" and o.entries_per_partition == 200_000
    assert Options.parse({}).threads == 16
    for bad in ({"threadcount": "x"}, {"entriesperpartition": "0"}, {"uint64": "other"}):
        with pytest.raises(OptionError):
            Options.parse(bad)
    with pytest.raises(OptionError):
        Options.parse({}).need_paths()
    with pytest.warns(UserWarning):
        Options.parse({"nosuchoption": "1"})


def test_file_cache(all_types, tmp_path):
    now = [0.0]
    cache = FileCache(idle=60, clock=lambda: now[0])
    other = str(tmp_path / "o.root")
    write_tree(other, "Events", [{"a": pa.array([1], pa.int32())}], [Column("a", "int")])
    a = cache.get(all_types[0])
    now[0] = 50
    assert cache.get(all_types[0]) is a
    now[0] = 105
    cache.get(other)
    assert all_types[0] in cache.open
    now[0] = 111
    cache.get(other)
    assert all_types[0] not in cache.open
    assert cache.get(all_types[0]) is not a


def test_count(all_types):
    assert count_events([all_types[0]]) == 9


def test_writer_leaves_no_half_file(tmp_path):
    path = tmp_path / "x.root"
    with pytest.raises(ValueError):
        write_tree(str(path), "Events", [{"a": pa.array([1], pa.int32()), "b": pa.array([1, 2], pa.int32())}], [Column("a", "int"), Column("b", "int")])
    assert list(tmp_path.iterdir()) == []
    with TreeWriter(str(path), "T", [Column("a", "int")]) as w:
        w.write({"a": pa.array([5], pa.int32())})
    assert open_events(str(path), "T").array("a").to_pylist() == [5]
