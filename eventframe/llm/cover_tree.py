"""Embedding near-duplicates: exact threshold pairs by dual traversal of cover trees.

On unit vectors cosine >= c is distance <= sqrt(2 - 2c). A cover tree's nested levels halve their radii; each node keeps
the distance to its farthest descendant. Two nodes are traversed together: their pair is dropped when their centres are
farther apart than the threshold and both covering radii, taken whole when they are that much nearer, and opened
otherwise. A distance is computed only when the pair of nodes above it has been opened and, in large products, when
projections of the two centres on a few fixed directions, which are never farther apart than they are, don't rule it out. Pairs of single points within
rounding of the threshold get the exact cosine in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks_of, components, cut, min_roots, sorted_groups
from .vectors import matrix, numbers, scaled, units, usable

#: Slack for rounding in distances computed from products.
EPS = 1e-7
#: Slack within which a cosine from unit vectors is computed again from the vectors themselves.
FINE = 1e-12
#: Nodes on a side of one product, and pairs computed at once.
TILE, PAIRS = 1024, 1 << 17
#: Coordinates of a shadow, and slack for its single precision.
SHADOW, SHADOW_EPS = 16, 1e-4


class CoverTree:
    """Levels of nodes over rows of unit vectors u; level l has radius 2 / 2**l. Rows are put in an order in which the
    descendants of a node are neighbours and its centre comes first, so a level is the starts of its nodes. order: row at
    each position; u: vectors by position; starts, far (distance to the farthest descendant) and child (first child at the next
    level, with one more at the end) per level; the last level has all rows. asked: distances computed.

    With order and top (the first level at which the row at each position is a centre) a tree is set up again as it was.
    """

    def __init__(self, u: np.ndarray, order: np.ndarray | None = None, top: np.ndarray | None = None, depth: int = 7):
        self.asked = 0
        n = len(u)
        if order is None:
            order, starts = np.arange(n), [np.zeros(1, int)]
            for level in range(1, depth + 1):
                if len(starts[-1]) == n:
                    break
                found = [self._split(u, order, a, b, 2.0 / 2**level) for a, b in zip(starts[-1].tolist(), np.r_[starts[-1][1:], n].tolist())]
                starts.append(np.concatenate(found))
            if len(starts[-1]) < n:
                starts.append(np.arange(n))
        else:
            starts = [np.flatnonzero(top <= level) for level in range(int(top.max()) + 1)]
        self.order, self.u, self.starts = order, u[order], starts
        self.far, self.child = [], []
        for i, s in enumerate(starts):
            size = np.diff(np.r_[s, n])
            inner = np.flatnonzero(np.repeat(size > 1, size))
            far, self.asked = np.zeros(n), self.asked + len(inner)
            dot = pair_dots(self.u, np.repeat(s, size)[inner], self.u, inner)
            far[inner] = np.sqrt(np.maximum(2.0 - 2.0 * dot, 0.0))
            self.far.append(np.maximum.reduceat(far, s))
            if i + 1 < len(starts):
                self.child.append(np.searchsorted(starts[i + 1], np.r_[s, n]))

    def _split(self, u: np.ndarray, order: np.ndarray, a: int, b: int, radius: float) -> np.ndarray:
        """Puts the rows of one node, order[a:b], under centres of the next level; the first row, its centre, stays one.
        Returns the centres' positions. Centres are chosen in batches, whose size follows the number of them that
        the last batch yielded, so that few distances are computed for rows that turn out not to be centres."""
        if b - a == 1:
            return np.array([a])
        least = 1.0 - radius * radius / 2.0
        rest, batch, parts, starts, at = order[a:b], 1, [], [], a
        while len(rest):
            near = u[rest[:batch]] @ u[rest].T >= least
            self.asked += near.size
            centres, own = [], near[:, : len(near)]
            for i in range(len(near)):  # a row is a centre unless one before it holds it
                if not own[centres, i].any():
                    centres.append(i)
            near = near[centres]
            near[np.arange(len(centres)), centres] = True
            owner = np.where(near.any(axis=0), near.argmax(axis=0), len(centres))
            by = np.argsort(owner, kind="stable")
            size = np.bincount(owner, minlength=len(centres) + 1)
            starts.append(at + np.cumsum(size)[:-1] - size[:-1])
            held = len(rest) - size[-1]
            parts.append(rest[by[:held]])
            at, rest = at + held, rest[by[held:]]
            batch = min(256, 2 * len(centres))
        order[a:b] = np.concatenate(parts)
        return np.concatenate(starts)

    @property
    def top(self) -> np.ndarray:
        out = np.zeros(len(self.order), int)
        for level in range(len(self.starts) - 1, -1, -1):
            out[self.starts[level]] = level
        return out

    def nodes(self, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, ends, far) of a level; beyond the last one it is the last."""
        level = min(level, len(self.starts) - 1)
        return self.starts[level], np.r_[self.starts[level][1:], len(self.order)], self.far[level]

    def children(self, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First child and one beyond the last at the next level."""
        if level >= len(self.child):
            return nodes, nodes + 1
        return self.child[level][nodes], self.child[level][nodes + 1]


def pair_dots(u: np.ndarray, p: np.ndarray, w: np.ndarray, q: np.ndarray) -> np.ndarray:
    out = np.empty(len(p))
    for at in range(0, len(p), 1 << 15):
        s = slice(at, at + (1 << 15))
        out[s] = np.einsum("ij,ij->i", u[p[s]], w[q[s]])
    return out


def ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, member) of the integer ranges [start, end)."""
    size = ends - starts
    owner = np.repeat(np.arange(len(starts)), size)
    return owner, np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + starts[owner]


def shadows(u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Projections of rows on SHADOW fixed orthonormal directions, as left and right factors of the squares of their distances, in single
    precision: no two rows are nearer than their shadows."""
    basis = np.linalg.qr(np.random.default_rng(0).standard_normal((u.shape[1], SHADOW)))[0]
    p = u @ basis
    size, one = (p * p).sum(axis=1, keepdims=True), np.ones((len(p), 1))
    return np.hstack([-2.0 * p, size, one]).astype(np.float32), np.hstack([p, one, size]).astype(np.float32)


class Meeting:
    """Dual traversal of two trees, or of one with itself (ty None): links within distance tau.

    runs() yields linked pairs of position ranges (a0, a1, b0, b1) and linked pairs of positions (p, q), as arrays; each
    unordered pair comes once. asked: distances computed."""

    def __init__(self, tx: CoverTree, ty: CoverTree | None, cosine: float, exact):
        self.tx, self.ty, self.same, self.exact = tx, ty or tx, ty is None, exact
        self.cosine, self.tau, self.asked = cosine, float(np.sqrt(max(0.0, 2.0 - 2.0 * cosine))), 0

    def _tiles(self, level: int, p: int, q: int):
        """Pairs of children of one large pair, by products; only pairs that may be near, by the farthest descendants of each tile."""
        (s0,), (e0,) = (x.tolist() for x in self.tx.children(level, np.array([p])))
        (s1,), (e1,) = (x.tolist() for x in self.ty.children(level, np.array([q])))
        sx, _, fx = self.tx.nodes(level + 1)
        sy, _, fy = self.ty.nodes(level + 1)
        own = self.same and p == q
        by_far = lambda s, e, f: (k := s + np.argsort(f[s:e] > 0, kind="stable"), int((f[s:e] == 0).sum()))
        cut_up = lambda k, lone: [k[i : min(i + TILE, stop)] for at, stop in ((0, lone), (lone, len(k))) for i in range(at, stop, TILE)]
        left, right = cut_up(*by_far(s0, e0, fx)), cut_up(*by_far(s1, e1, fy))
        shade = self.tx.u.shape[1] >= 2 * SHADOW
        ends = [shadows(self.ty.u[sy[b]])[1] if shade else None for b in right]
        for i, a in enumerate(left):
            first = shadows(self.tx.u[sx[a]])[0] if shade else None
            for j in range(i if own else 0, len(right)):  # for one node with itself both lists are the same
                b, x = right[j], None
                most = self.tau + fx[a].max() + fy[b].max() + EPS
                if shade and most < 0.5:  # few shadows are that near, unless the rows are
                    x, y = np.nonzero(first @ ends[j].T <= np.float32(most * most + SHADOW_EPS))
                if x is not None and len(x) * 16 < len(a) * len(b):
                    d, x, y = pair_dots(self.tx.u, sx[a][x], self.ty.u, sy[b][y]), a[x], b[y]
                    self.asked += len(x)
                    k = d >= 1.0 - most**2 / 2.0
                    d, x, y = d[k], x[k], y[k]
                else:
                    dot = self.tx.u[sx[a]] @ self.ty.u[sy[b]].T
                    self.asked += dot.size
                    x, y = np.nonzero(dot >= 1.0 - most**2 / 2.0)
                    d, x, y = dot[x, y], a[x], b[y]
                if own:
                    keep = (x <= y) if a is b or a[0] == b[0] else np.ones(len(x), bool)
                    d, x, y = d[keep], x[keep], y[keep]
                    x, y = np.minimum(x, y), np.maximum(x, y)
                yield x, y, d

    def _opened(self, level: int, p: np.ndarray, q: np.ndarray):
        """(p, q, dot) of children, piece by piece."""
        sp, ep = self.tx.children(level, p)
        sq, eq = self.ty.children(level, q)
        size = (ep - sp) * (eq - sq)
        large = size > 4096
        for a, b in zip(p[large].tolist(), q[large].tolist()):
            yield from self._tiles(level, a, b)
        sp, ep, sq, eq, size, mine = sp[~large], ep[~large], sq[~large], eq[~large], size[~large], (p == q)[~large]
        at = np.cumsum(size)
        lo = 0
        while lo < len(size):
            hi = max(lo + 1, int(np.searchsorted(at, (at[lo - 1] if lo else 0) + PAIRS, "right")))
            pair, x = ranges(sp[lo:hi], ep[lo:hi])
            pair2, y = ranges(sq[lo:hi][pair], eq[lo:hi][pair])
            x, own = x[pair2], mine[lo:hi][pair[pair2]]
            if self.same:
                keep = ~own | (x <= y)
                x, y = x[keep], y[keep]
            self.asked += len(x)
            yield x, y, pair_dots(self.tx.u, self.tx.nodes(level + 1)[0][x], self.ty.u, self.ty.nodes(level + 1)[0][y])
            lo = hi

    def _descend(self, level: int, p: np.ndarray, q: np.ndarray, dot: np.ndarray):
        a0, a1, fx = (x[p] for x in self.tx.nodes(level))
        b0, b1, fy = (x[q] for x in self.ty.nodes(level))
        lone = (a1 - a0 == 1) & (b1 - b0 == 1)
        k = lone & (dot >= self.cosine - FINE)
        if self.same:
            k &= p != q
        if k.any():
            x, y, d = a0[k], b0[k], dot[k]
            close = np.flatnonzero(d < self.cosine + FINE)
            fits = np.ones(len(x), bool)
            fits[close] = self.exact(self.tx.order[x[close]], self.ty.order[y[close]]) >= self.cosine
            yield None, (x[fits], y[fits])
        d, spread = np.sqrt(np.maximum(2.0 - 2.0 * dot, 0.0)), fx + fy
        sure = ~lone & (d + spread <= self.tau - EPS)
        if sure.any():
            yield (a0[sure], a1[sure], b0[sure], b1[sure]), None
        go = ~lone & ~sure & (d <= self.tau + spread + EPS)
        if go.any():
            for x, y, dot in self._opened(level, p[go], q[go]):
                if len(x):
                    yield from self._descend(level + 1, x, y, dot)

    def runs(self):
        if len(self.tx.order) and len(self.ty.order):
            root = np.zeros(1, int)
            self.asked += 1
            yield from self._descend(0, root, root, pair_dots(self.tx.u, root, self.ty.u, root))


class Links:
    """Sums of weights of linked rows, and few links that connect whatever is linked."""

    def __init__(self, n: int):
        self.n, self.sums, self.left, self.right, self.held = n, np.zeros(n, int), [], [], 0

    def join(self, left: np.ndarray, right: np.ndarray) -> None:
        self.left.append(left)
        self.right.append(right)
        self.held += len(left)
        if self.held > (1 << 20) + 2 * self.n:
            root = self.roots()
            self.left, self.right = [np.flatnonzero(root != np.arange(self.n))], [root[root != np.arange(self.n)]]
            self.held = len(self.left[0])

    def roots(self) -> np.ndarray:
        return min_roots(self.n, np.concatenate(self.left or [np.zeros(0, int)]), np.concatenate(self.right or [np.zeros(0, int)]))


def threshold_links(x: np.ndarray, y: np.ndarray | None, cosine: float, wx: np.ndarray | None = None, wy: np.ndarray | None = None, tx: CoverTree | None = None, ty: CoverTree | None = None):
    """Exact links between rows of x and rows of y, or within x if y is None, with their weights and trees where given.
    Returns (links, asked): rows of x, then of y, are nodes of links, whose sums add the weights of linked rows; asked is
    the number of distances computed, trees included that were built here."""
    same, asked = y is None, 0
    if tx is None:
        tx = CoverTree(units(x))
        asked += tx.asked
    if same:
        y, wy, ty = x, wx, tx
    elif ty is None:
        ty = CoverTree(units(y))
        asked += ty.asked
    sx, sy = scaled(x), scaled(y)
    nx, ny = np.linalg.norm(sx, axis=1), np.linalg.norm(sy, axis=1)
    meeting = Meeting(tx, None if same else ty, cosine, lambda p, q: np.einsum("ij,ij->i", sx[p], sy[q]) / (nx[p] * ny[q]))
    ox, oy = tx.order, ty.order + (0 if same else len(x))
    wx = (np.ones(len(x), int) if wx is None else wx)[tx.order]
    wy = (np.ones(len(y), int) if wy is None else wy)[ty.order]
    upto_x, upto_y = np.r_[0, np.cumsum(wx)], np.r_[0, np.cumsum(wy)]
    links = Links(len(x) + (0 if same else len(y)))
    at_x, at_y = np.zeros(len(x) + 1, int), np.zeros(len(y) + 1, int)
    self_x = np.zeros(len(x) + 1, int)
    for whole, pairs in meeting.runs():
        if pairs:
            p, q = pairs
            np.add.at(links.sums, ox[p], wy[q])
            np.add.at(links.sums, oy[q], wx[p])
            links.join(ox[p], oy[q])
            continue
        a0, a1, b0, b1 = whole
        mine = (a0 == b0) if same else np.zeros(len(a0), bool)
        np.add.at(at_x, a0, upto_y[b1] - upto_y[b0])
        np.add.at(at_x, a1, upto_y[b0] - upto_y[b1])
        np.add.at(at_y, b0[~mine], (upto_x[a1] - upto_x[a0])[~mine])
        np.add.at(at_y, b1[~mine], (upto_x[a0] - upto_x[a1])[~mine])
        np.add.at(self_x, a0[mine], 1)  # a node linked with itself: its rows don't link with themselves
        np.add.at(self_x, a1[mine], -1)
        own, member = ranges(a0, a1)
        links.join(ox[member], oy[b0[own]])
        own, member = ranges(b0, b1)
        links.join(ox[a0[own]], oy[member])
    np.add.at(links.sums, ox, np.cumsum(at_x)[:-1] - np.cumsum(self_x)[:-1] * wx)
    np.add.at(links.sums, oy, np.cumsum(at_y)[:-1])
    return links, asked + meeting.asked


def choose_pivots(u: np.ndarray, most: int) -> np.ndarray:
    """Centres of the upper levels of a cover tree, at most so many, widest first."""
    tree = CoverTree(u)
    return tree.u[np.argsort(tree.top, kind="stable")[:most]]


def reach(u: np.ndarray, pivots: np.ndarray, tau: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(home, row, other): each row's nearest pivot, and the other pivots on whose side a row within tau of it may be: the
    row is within tau of the plane halfway between its own pivot and that one."""
    dot = u @ pivots.T
    home = dot.argmax(axis=1)
    apart = np.sqrt(np.maximum(2.0 - 2.0 * (pivots @ pivots.T), 0.0))
    over = dot >= dot[np.arange(len(u)), home][:, None] - apart[home] * (tau + EPS) - EPS
    over[np.arange(len(u)), home] = False
    return home, *np.nonzero(over)


def near_vectors(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = "label", cosine: float = 0.98, block_rows: int = 16_384, pivots: int = 64, pivot_groups: int = 16, sample_rows: int = 8192
) -> DataFrame:
    """One row per row of rows: id_col, n_links (other rows linked directly), component_id (the smallest id reachable),
    kept (whether the row's id is that).

    Rows link when their labels are equal and not null (any rows, if label_col is None) and their cosine in double
    precision is at least cosine; all such pairs are found. Vectors that are null, empty, zero, hold null or
    non-finite components, or differ in length link with nothing: such rows are their own component. Equal vectors of a label
    are one weighted row first. The rows of a label with more than block_rows of them are dealt to the nearest of up to
    `pivots` centres of a cover tree's upper levels (of a sample of at most sample_rows rows; for the pivot_groups largest labels; only the
    amount of work depends on them, and labels whose rows would be sent to more cells than there are blocks are not dealt), and a row goes also to the borders its threshold reaches. Cells with more than
    block_rows rows become blocks by hash, paired with each other, so that a label or cell with a third of all rows becomes many
    tasks. Each block's tree is built once. A task returns sums and a spanning forest, never its pairs. Rows that repeat an id
    count as rows of their own; rows with a null id are returned with no links, a null component and kept false.
    """
    spark, tau = rows.sparkSession, float(np.sqrt(max(0.0, 2.0 - 2.0 * cosine)))
    base = rows.select(F.col(id_col).alias("id"), numbers(rows, vector_col).alias("v"), (F.col(label_col) if label_col else F.lit(0)).alias("label"))
    base = base.select("id", "v", F.xxhash64("v", "label").alias("k1"), F.xxhash64(F.lit(1), "v", "label").alias("k2"), F.struct("label", F.size("v").alias("d")).alias("g"), (usable(F.col("v")) & F.col("label").isNotNull() & F.col("id").isNotNull()).alias("live"))
    kind = base.schema["id"].dataType.simpleString()
    apart = cut(base.where("live").groupBy("g", "k1", "k2", "v").agg(F.min("id").alias("id"), F.count("*").alias("m")))
    group = cut(apart.groupBy("g").agg(F.count("*").alias("n"), F.sum("m").alias("rows")).select(F.col("g").alias("g2"), "n", "rows", F.monotonically_increasing_id().alias("gid")))
    large = group.where(F.col("n") > block_rows)
    held = apart.join(group, F.col("g") == F.col("g2")).select("gid", "n", "k1", "id", "m", "v")

    # pivots of the largest labels, and the sides of cells: rows of a pivot, or rows of one pivot near another's
    chosen = large.orderBy(F.desc("n"), "gid").limit(pivot_groups)
    of_label: dict[int, np.ndarray] = {}
    if chosen.limit(1).count():
        picked = held.join(F.broadcast(chosen.select(F.col("gid").alias("gid2"))), F.col("gid") == F.col("gid2"))
        picked = picked.where(F.pmod(F.xxhash64(F.lit(3), "k1"), F.col("n")) < sample_rows // pivot_groups).orderBy(F.xxhash64(F.lit(4), "k1")).limit(sample_rows)
        by_gid: dict[int, list] = {}
        for r in picked.select("gid", "v").collect():
            by_gid.setdefault(r["gid"], []).append(r["v"])
        sizes = {r["gid"]: r["n"] for r in chosen.select("gid", "n").collect()}
        for gid, v in by_gid.items():
            u = units(np.array(v, dtype=np.float64))
            centres = choose_pivots(u, pivots)
            if len(u) + len(reach(u, centres, tau)[1]) < len(u) * blocks_of(sizes[gid], block_rows):  # else blocks paired with each other get fewer copies
                of_label[gid] = centres
    shared = spark.sparkContext.broadcast(of_label)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for gid in np.unique(batch.column("gid").to_numpy()).tolist():
                part = batch.filter(pa.array(batch.column("gid").to_numpy() == gid))
                home, row, other = reach(units(matrix(part["v"])), shared.value[gid], tau)
                at, to = np.r_[np.arange(len(home)), row], np.r_[home, other]
                mine = home[at]
                out = part.take(pa.array(at))
                yield pa.RecordBatch.from_arrays([*out.columns, *(pa.array(c.astype(np.int32)) for c in (np.minimum(mine, to), np.maximum(mine, to), (mine > to).astype(int)))], [*out.schema.names, "a", "b", "side"])

    block = F.ceil(F.col("n") / block_rows).cast("int")
    sides = held.where(~F.col("gid").isin(list(of_label))).select("gid", "k1", "id", "m", "v", *(F.lit(0).alias(c) for c in ("a", "b", "side")), block.alias("own"), block.alias("other"))
    blocks = group.where(~F.col("gid").isin(list(of_label))).agg(F.sum(block).cast("long"), F.max(block)).first()
    n_blocks, paired = blocks[0] or 0, (blocks[1] or 0) > 1
    if of_label:
        dealt = held.where(F.col("gid").isin(list(of_label))).mapInArrow(deal, f"gid long, n long, k1 long, id {kind}, m long, v {base.schema['v'].dataType.simpleString()}, a int, b int, side int")
        size = lambda c: F.ceil(c / block_rows).cast("int")
        cells = dealt.groupBy(F.col("gid").alias("gid2"), F.col("a").alias("a2"), F.col("b").alias("b2")).agg(size(F.sum(1 - F.col("side"))).alias("n0"), size(F.sum("side")).alias("n1"))
        cells = cut(cells.where("a2 = b2 or n0 > 0 and n1 > 0"))  # at most pivot_groups * pivots * (pivots + 1) / 2
        n_blocks += cells.agg(F.sum(F.col("n0") + F.col("n1")).cast("long")).first()[0] or 0
        paired = True
        dealt = dealt.join(F.broadcast(cells), (F.col("gid") == F.col("gid2")) & (F.col("a") == F.col("a2")) & (F.col("b") == F.col("b2")))
        own, other = F.when(F.col("side") == 0, F.col("n0")).otherwise(F.col("n1")), F.when((F.col("side") == 0) & (F.col("a") != F.col("b")), F.col("n1")).otherwise(F.col("n0"))
        sides = sides.unionByName(dealt.select("gid", "k1", "id", "m", "v", "a", "b", "side", own.alias("own"), other.alias("other")))
    spot = ["gid", "a", "b", "side", "sub"]
    sides = sides.withColumn("sub", F.pmod(F.xxhash64(F.lit(5), "k1"), F.col("own")).cast("int"))
    sides = sides.repartition(max(1, min(3 * n_blocks, 100_000)), *spot).sortWithinPartitions(*spot)
    node = f"struct<id:{kind},k:bigint>"
    link_type = f"node {node}, hub {node}, n long"
    names = [*spot, "other", "k1", "id", "m", "v"]
    pa_int = lambda c: pa.array(c, pa.int64())

    def linked(cell: pa.Table, links: Links) -> list[pa.Array]:
        root, has = links.roots(), np.flatnonzero(links.sums > 0)
        at = lambda c, rows: (k := c.combine_chunks(), k.chunk(0) if isinstance(k, pa.ChunkedArray) else k)[1].take(pa.array(rows))
        both = lambda rows: pa.StructArray.from_arrays([at(cell["id"], rows), at(cell["k1"], rows)], ["id", "k"])
        return [both(has), both(root[has]), pa_int(links.sums[has])]

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each block's tree: links within it, and, for other blocks to meet, its rows with their places in the tree."""
        for cell in sorted_groups(batches, spot):
            x, same, other = matrix(cell["v"]), cell["a"][0].as_py() == cell["b"][0].as_py(), cell["other"][0].as_py()
            tree = CoverTree(units(x))
            if same:
                found = linked(cell, threshold_links(x, None, cosine, cell["m"].to_numpy(), tx=tree)[0])
                yield pa.RecordBatch.from_arrays([*found, *(pa.nulls(len(found[0]), cell[c].type) for c in names), pa.nulls(len(found[0]), pa.int32()), pa.nulls(len(found[0]), pa.int32())], ["node", "hub", "n", *names, "pos", "top"])
            if not same or other > 1:
                n, kept = len(x), cell.select(names).take(pa.array(tree.order)).combine_chunks()
                empty = [pa.nulls(n, pa.struct([("id", cell["id"].type), ("k", pa.int64())])), pa.nulls(n, pa.struct([("id", cell["id"].type), ("k", pa.int64())])), pa.nulls(n, pa.int64())]
                table = pa.table([*empty, *kept.columns, pa.array(np.arange(n, dtype=np.int32)), pa.array(tree.top.astype(np.int32))], names=["node", "hub", "n", *names, "pos", "top"])
                yield from table.to_batches(max_chunksize=16_384)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in sorted_groups(batches, ["gid", "a", "b", "i", "j"]):
            first = cell["left"].to_numpy()
            if first.all() or not first.any():
                continue
            x, y = matrix(cell["v"].filter(pa.array(first))), matrix(cell["v"].filter(pa.array(~first)))
            m, top = cell["m"].to_numpy(), cell["top"].to_numpy()
            trees = [CoverTree(units(v), np.arange(len(v)), top[of]) for v, of in ((x, first), (y, ~first))]
            links, _ = threshold_links(x, y, cosine, m[first], m[~first], *trees)
            found = linked(pa.concat_tables([cell.filter(pa.array(first)), cell.filter(pa.array(~first))]), links)
            yield pa.RecordBatch.from_arrays(found, ["node", "hub", "n"])

    grown = cut(sides.select(*names).mapInArrow(grow, f"{link_type}, gid long, a int, b int, side int, sub int, other int, k1 long, id {kind}, m long, v {base.schema['v'].dataType.simpleString()}, pos int, top int"))
    made = grown.where("node is not null").select("node", "hub", "n")
    if paired:
        met = grown.where("pos is not null").select(*names, "pos", "top", F.explode(F.sequence(F.lit(0), F.col("other") - 1)).alias("o")).where("a <> b or sub <> o")
        left = F.when(F.col("a") == F.col("b"), F.col("sub") < F.col("o")).otherwise(F.col("side") == 0)
        met = met.withColumn("left", left).select("gid", "a", "b", F.when(F.col("left"), F.col("sub")).otherwise(F.col("o")).alias("i"), F.when(F.col("left"), F.col("o")).otherwise(F.col("sub")).alias("j"), "left", "pos", "top", "k1", "id", "m", "v")
        total = grown.where("pos = 0").agg(F.sum("other")).first()[0] or 0
        met = met.repartition(max(1, min(int(total), 100_000)), "gid", "a", "b", "i", "j").sortWithinPartitions("gid", "a", "b", "i", "j", F.desc("left"), "pos")
        made = cut(made.unionByName(met.mapInArrow(meet, link_type)))

    comp = components(made.select(F.col("node").alias("a"), F.col("hub").alias("b"))).select(F.col("node").alias("node2"), "root")
    sums = made.groupBy("node").agg(F.sum("n").alias("n"))
    found = sums.join(comp, F.col("node") == F.col("node2"), "left").select(F.col("node.id").alias("lo"), F.col("node.k").alias("lk"), "n", F.coalesce(F.col("root.id"), F.col("node.id")).alias("root"))
    # what rows get: by vector, for those that have copies or links; a vector that very many rows share is looked up in a short list
    many = apart.join(found, (F.col("id") == F.col("lo")) & (F.col("k1") == F.col("lk")), "left").where("m > 1 or n is not null")
    many = cut(many.select(F.col("k1").alias("r1"), F.col("k2").alias("r2"), "m", (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("links"), F.coalesce("root", "id").alias("root")))
    total = group.agg(F.sum("rows")).first()[0] or 0
    hot = many.where(F.col("m") * 4096 > total).select("r1", "r2", F.col("links").alias("hot_links"), F.col("root").alias("hot_root"))  # 4096 at most
    out = base.select("id", "k1", "k2", "live").join(F.broadcast(hot), F.col("live") & (F.col("k1") == F.col("r1")) & (F.col("k2") == F.col("r2")), "left").drop("r1", "r2")
    look = F.when(F.col("live") & F.col("hot_links").isNull(), F.col("k1")).otherwise(F.xxhash64("id"))
    rest = many.where(F.col("m") * 4096 <= total).drop("m")
    out = out.withColumn("look", look).join(rest, (F.col("look") == F.col("r1")) & (F.col("k2") == F.col("r2")) & F.col("live") & F.col("hot_links").isNull(), "left")
    root = F.coalesce("hot_root", "root", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("hot_links", "links", F.lit(0)).cast("long").alias("n_links"), root.alias("component_id"), F.coalesce(root == F.col("id"), F.lit(False)).alias("kept"))
