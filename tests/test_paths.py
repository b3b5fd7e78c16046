import os

import pytest

from eventframe.sources.paths import expand_braces, local_path, open_file, resolve


@pytest.fixture
def tree(tmp_path):
    for a in "123":
        for b in "123":
            d = tmp_path / a / b
            d.mkdir(parents=True)
            for c in "123":
                (d / f"a_b_{c}.root").write_bytes(b"x")
            (d / "note.txt").write_bytes(b"x")
    return str(tmp_path)


def rel(tree, paths):
    return [os.path.relpath(p, tree) for p in resolve([os.path.join(tree, p) for p in paths])]


def test_braces():
    assert expand_braces("{1{/2,/3},2}/x") == ["1/2/x", "1/3/x", "2/x"]
    with pytest.raises(ValueError):
        expand_braces("{a,b")


@pytest.mark.parametrize(
    "given,count", [(["."], 27), (["1"], 9), (["1/1/a_b_1.root"], 1), (["*/1/*_1.root"], 3), (["{1,2}/3/a_b_[12].root"], 4), (["{1{/2,/3},2/1}/*_1.root"], 3), (["1", "1/1/a_b_1.root", "1/1/a_b_1.root"], 9), (["?/?/a_b_?.root"], 27)]
)
def test_resolution(tree, given, count):
    found = rel(tree, given)
    assert len(found) == count and found == sorted(set(found)) and all(f.endswith(".root") for f in found)


@pytest.mark.parametrize("given", [["nothing"], ["no*thing"], ["1/9/*.root"]])
def test_missing(tree, given):
    with pytest.raises(FileNotFoundError):
        rel(tree, given)


def test_schemes(tree):
    assert local_path("/a/b") == "/a/b" and local_path("file:///a/b%20c") == "/a/b c" and local_path("hdfs://h/a") is None
    assert resolve([f"file://{tree}/1/1/a_b_1.root"]) == [f"{tree}/1/1/a_b_1.root"]


def test_xz(tmp_path):
    import lzma

    p = tmp_path / "a.root.xz"
    p.write_bytes(lzma.compress(b"hello"))
    f = open_file(str(p))
    assert f.size == 5 and f.read(1, 3) == b"ell"
