import numpy as np
import pytest

from eventframe.llm import cover_tree, hashing_index
from eventframe.llm.common import min_roots
from eventframe.llm.queries import op2_multi_index_hashing, op6_cover_tree_pairs


def cloud(n, d, groups, seed=0):
    rng = np.random.default_rng(seed)
    x, at = rng.standard_normal((n, d)), 0
    for g in groups:
        x[at : at + g] = x[at] + rng.standard_normal((g, d)) * rng.choice([0, 0.05, 0.1, 0.15])
        at += g
    return x


@pytest.mark.parametrize("n,d,groups", [(1, 4, []), (5, 3, [3]), (300, 8, [50, 60, 20]), (700, 64, [300, 100, 30]), (200, 2, [20]), (2500, 16, [900, 5])])
def test_links_are_exact(n, d, groups):
    x, y = cloud(n, d, groups), cloud(max(1, n // 2), d, [n // 4], 1)
    y[: n // 8] = x[: n // 8]
    wx, wy = np.arange(n) % 3 + 1, np.arange(len(y)) % 2 + 1
    for other, w in ((None, wx), (y, wy)):
        tree = cover_tree.CoverTree(cover_tree.units(x))
        again = cover_tree.CoverTree(tree.u, np.arange(n), tree.top)  # a tree set up again from its order
        assert all((a == b).all() for a, b in zip(tree.starts, again.starts)) and len(tree.starts) == len(again.starts)
        links, _ = cover_tree.threshold_links(x, other, 0.98, wx, None if other is None else wy, tx=tree)
        z = x if other is None else other
        link = (x @ z.T) / np.outer(np.linalg.norm(x, axis=1), np.linalg.norm(z, axis=1)) >= 0.98
        if other is None:
            np.fill_diagonal(link, False)
        want = link @ w if other is None else np.r_[link @ w, wx @ link]
        assert (links.sums == want).all()
        i, j = np.nonzero(link)
        assert (min_roots(len(want), i, (0 if other is None else n) + j) == links.roots()).all()


def test_distances_are_computed_on_demand():
    """On clustered rows far fewer distances than pairs, the trees' own included; far from all pairs even across blocks."""
    rng = np.random.default_rng(3)
    x = np.repeat(rng.standard_normal((200, 32)), 30, axis=0) + 0.02 * rng.standard_normal((6000, 32))
    y = np.repeat(rng.standard_normal((150, 32)), 30, axis=0) + 0.02 * rng.standard_normal((4500, 32))
    _, asked = cover_tree.threshold_links(x, None, 0.98)
    assert asked < len(x) * (len(x) - 1) / 2 / 6
    _, asked = cover_tree.threshold_links(x, y, 0.98)
    assert asked < len(x) * len(y) / 6


def test_few_distances_without_structure():
    """Rows without structure are all centres; of their pairs the projections leave few, and no link is lost."""
    x = cover_tree.units(cloud(3000, 64, [40]))
    tree = cover_tree.CoverTree(x)
    links, asked = cover_tree.threshold_links(x, None, 0.98, tx=tree)
    assert asked < len(x) * (len(x) - 1) / 2 / 4
    link = x @ x.T >= 0.98
    np.fill_diagonal(link, False)
    assert link.any() and (links.sums == link.sum(axis=1)).all()


def test_reach_holds_every_border_pair():
    x = cover_tree.units(cloud(900, 4, [100]))
    pivots = cover_tree.choose_pivots(x[::9], 12)
    home, row, other = cover_tree.reach(x, pivots, 0.2)
    sent = set(zip(row.tolist(), other.tolist()))
    i, j = np.nonzero(np.linalg.norm(x[:, None] - x[None], axis=2) <= 0.2)
    apart = home[i] != home[j]
    assert len(pivots) == 12 and apart.any() and len(sent) < 900 * 11 / 2
    assert all((a, home[b]) in sent and (b, home[a]) in sent for a, b in zip(i[apart].tolist(), j[apart].tolist()))


def rows_for(spark, x, labels=None, ids=None):
    ids = ids if ids is not None else range(len(x))
    labels = labels if labels is not None else [0] * len(x)
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], g) for i, v, g in zip(ids, x, labels)], "vec_id long, embedding array<float>, label int")


@pytest.mark.parametrize("pivots,d", [(12, 16), (8, 4), (1, 16)])
def test_near_vectors(spark, clashing, pivots, d):
    x = cloud(400, d, [120, 60]).astype(np.float32)
    x[200:230] = x[200]  # equal vectors
    labels = np.where(np.arange(400) % 7 == 0, 1, 0)
    df = rows_for(spark, x.tolist(), labels.tolist())
    got = {r.vec_id: r for r in cover_tree.near_vectors(clashing(df), block_rows=32, pivots=pivots, pivot_groups=1, sample_rows=128).collect()}
    d = x.astype(np.float64)
    link = ((d @ d.T) / np.outer(np.linalg.norm(d, axis=1), np.linalg.norm(d, axis=1)) >= 0.98) & (labels[:, None] == labels)
    np.fill_diagonal(link, False)
    root = min_roots(400, *np.nonzero(link))
    assert len(got) == 400 and link.any()
    for i in range(400):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (link[i].sum(), root[i], root[i] == i)


def test_doubles_of_extreme_size(spark):
    x = [[1e200, 1e200], [1e200, 1.01e200], [1e-200, 1e-200], [1.0, -1.0], [1e300, 1e-300], [5e-324, 5e-324]]
    rows = spark.createDataFrame([(i, v, 0) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = cover_tree.near_vectors(rows).orderBy("vec_id").collect()
    assert [(r.n_links, r.component_id) for r in got] == [(3, 0), (3, 0), (3, 0), (0, 3), (0, 4), (3, 0)]


def test_near_vectors_odd_rows(spark):
    v = [1.0, 2.0]
    rows = rows_for(spark, [v, v, v, None, [], [0.0, 0.0], [None, 1.0], [float("nan"), 1.0], [float("inf"), 1.0], v, v, v, [1.0]], [0, 0, None, 0, 0, 0, 0, 0, 0, 0, 0, 1, 0], [5, 6, 7, 8, 9, 10, 11, 12, 13, 6, None, 14, 15])
    got = sorted((-1 if r.vec_id is None else r.vec_id, r.n_links, r.component_id, r.kept) for r in cover_tree.near_vectors(rows).collect())
    assert got == [(-1, 0, None, False), (5, 2, 5, True), (6, 2, 5, False), (6, 2, 5, False)] + [(i, 0, i, True) for i in (7, 8, 9, 10, 11, 12, 13, 14, 15)]
    assert cover_tree.near_vectors(rows.limit(0)).collect() == []


def test_double_precision_is_kept(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(0, [1.0, 1e-12], 0), (1, [0.1, 1.0], 0), (2, [1 / 3, 1.0], 0)], "vec_id long, embedding array<double>, label int")
    got = hashing_index.nearest(rows, F.col("vec_id") == 0).collect()
    assert [(r.vec_id, r.score) for r in got] == [(2, 1 / 3 + 1e-12), (1, 0.1 + 1e-12)]
    assert [r.n_links for r in cover_tree.near_vectors(rows, cosine=0.97).orderBy("vec_id").collect()] == [0, 1, 1]


def test_query_near_vectors(spark, sf):
    rows = op6_cover_tree_pairs(spark, sf).collect()
    assert len(rows) == 500 and all(r.kept == (r.vec_id == r.component_id) for r in rows)


@pytest.mark.parametrize("n,r", [(500, 0), (500, 3), (3000, 5), (3000, 11), (500, 40), (500, 80)])
def test_probing_finds_all_within_radius(n, r):
    rng = np.random.default_rng(1)
    codes, queries = (rng.integers(0, 1 << 20, (4, k)).astype(np.uint32) for k in (n, 20))
    codes[:, :50] = queries[:, :1] ^ (1 << rng.integers(0, 20, (4, 50))).astype(np.uint32)
    hit = np.zeros((20, n), bool)
    index = hashing_index.SubstringIndex(codes)
    index.probe(queries, hit, 0, r + 1)
    d = np.bitwise_count(queries[:, :, None] ^ codes[:, None, :]).astype(int)
    assert hit[d.sum(0) <= r].all()  # every code within the radius
    assert (hit == (np.min(d * 4 + np.arange(4)[:, None, None], axis=0) <= r)).all()  # and only what shares a value that near
    grown = np.zeros((20, n), bool)
    index.probe(queries, grown, 0, 2)
    index.probe(queries, grown, 2, r + 1)
    assert (grown | hit == grown).all() and (r < 2 or (grown == hit).all())


def test_probes_are_selective():
    """Neighbours of clustered rows are found among few of them; of rows without any structure among a part."""
    for x, most in ((np.repeat(np.random.default_rng(5).standard_normal((300, 32)), 40, axis=0) + 0.3 * np.random.default_rng(6).standard_normal((12_000, 32)), 0.1), (cloud(12_000, 64, []), 0.25)):
        u, ids = hashing_index.units(x), np.arange(len(x))
        rotation = hashing_index.fit_rotations(u[::3], 80 * hashing_index.BITS)
        r = hashing_index.radius_for(u[::3], rotation, 20, len(u))
        block, q = hashing_index.Block(u, ids, rotation), ids[::240]
        a, b, _, found = block.top(u[q], q, r, 20, False)
        s = u[q] @ u.T
        s[np.arange(len(q)), q] = -1
        want = {(int(q[i]), int(j)) for i in range(len(q)) for j in np.argsort(-s[i])[:20]}
        assert len(want & set(zip(a.tolist(), b.tolist()))) >= 0.9 * len(want) and found.mean() <= most * len(x)


def recall(rows, x, k, asks):
    found = {}
    for r in rows:
        found.setdefault(r.query_id, []).append(r)
    hit = total = 0
    for q in asks:
        s = x @ x[q]
        s[q] = -np.inf
        want = set(np.lexsort((np.arange(len(x)), -s))[:k].tolist())
        mine = sorted(found[q], key=lambda r: r.rank)
        assert [r.rank for r in mine] == list(range(1, min(k, len(x) - 1) + 1)) and q not in {r.vec_id for r in mine}
        assert [(-r.score, r.vec_id) for r in mine] == sorted((-r.score, r.vec_id) for r in mine)
        assert all(abs(r.score - x[q] @ x[r.vec_id]) < 1e-12 for r in mine)
        hit, total = hit + len(want & {r.vec_id for r in mine}), total + len(want)
    return hit / total


def test_recall_of_query(spark, sf):
    t = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    x = np.array([r.embedding for r in t], dtype=np.float64)
    assert [r.vec_id for r in t] == list(range(len(t)))
    assert recall(op2_multi_index_hashing(spark, sf).collect(), x, 20, range(0, len(t), 20)) >= 0.9


def test_recall_with_copies(spark):
    from pyspark.sql import functions as F

    x = cloud(3000, 32, [900, 30]).astype(np.float32)
    got = hashing_index.nearest(rows_for(spark, x.tolist()), F.col("vec_id") % 50 == 0, sample_rows=1000, block_rows=500, query_rows=30).collect()
    assert recall(got, x.astype(np.float64), 20, range(0, 3000, 50)) >= 0.9


def test_nearest_odd_rows(spark, clashing):
    from pyspark.sql import functions as F

    v = [1.0, 2.0]
    rows = rows_for(spark, [v, v, None, [], [0.0, 0.0], [None, 1.0], [float("nan"), 1.0], v, v, [1.0]], None, [0, 1, 2, 3, 4, 5, 6, None, 1, 8])
    got = hashing_index.nearest(clashing(rows), F.col("vec_id") % 2 == 0).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == [(0, 1, 1, 5.0), (0, 2, 1, 5.0)]
    assert hashing_index.nearest(rows.limit(0), F.col("vec_id") % 2 == 0).collect() == []
    assert hashing_index.nearest(rows.limit(1), F.col("vec_id") % 2 == 0).collect() == []
