"""Approximate nearest neighbours by multi-index hashing over learned rotated binary codes.

Codes: orthogonal rotations are fitted (iterative quantisation: alternate signs and a Procrustes rotation) on a bounded
sample, and the signs of the rotated vectors are the bits. Codes are cut into m substrings of 20 bits, each indexed by value.
By the pigeonhole principle, with r = m * q + a, codes that differ in at most r bits differ by at most q bits in one of the
first a + 1 substrings or by at most q - 1 in one of the others; probing these values finds every code within the radius,
and whatever shares a value so near is reranked too, by the inner product of the original vectors. The radius is the least that
finds a share of a sample's neighbours; it grows for queries that find fewer than k.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks_of, cut
from .vectors import matrix, numbers, prevailing_size, units, usable

#: Bits of a substring: values are looked up in a table of this many entries.
BITS = 20
#: Queries probed at once; hits are flags, one for each of them and each row of a block.
CHUNK = 512


def fit_rotations(x: np.ndarray, bits: int, rounds: int = 8, rows: int = 2048, seed: int = 7) -> np.ndarray:
    """(d, bits): columns of orthogonal d x d rotations, each by iterative quantisation from its own random start and on its
    own part of the sample, of at most so many rows."""
    rng, d = np.random.default_rng(seed), x.shape[1]
    out = []
    for _ in range(-(-bits // d)):
        r = np.linalg.qr(rng.standard_normal((d, d)))[0]
        part = x[rng.permutation(len(x))[:rows]]
        for _ in range(rounds):
            u, _, vt = np.linalg.svd(np.where(part @ r >= 0, 1.0, -1.0).T @ part)
            r = (u @ vt).T
        out.append(r)
    return np.hstack(out)[:, :bits]


def encode(x: np.ndarray, rotation: np.ndarray) -> np.ndarray:
    """Codes as (m, rows): each substring's value for each row."""
    m = rotation.shape[1] // BITS
    out = np.empty((m, len(x)), dtype=np.uint32)
    for at in range(0, len(x), 2048):
        bits = (x[at : at + 2048] @ rotation >= 0).reshape(-1, m, BITS)
        out[:, at : at + 2048] = (bits @ (1 << np.arange(BITS, dtype=np.uint32))).T
    return out


def step_found(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least radius at which probing finds codes b from codes a, pairwise: the least m * (bits that differ in substring j) + j."""
    m = len(a)
    return (np.bitwise_count(a ^ b).astype(np.int64) * m + np.arange(m)[:, None]).min(axis=0)


def radius_for(x: np.ndarray, rotation: np.ndarray, k: int, n: int, share: float = 0.92, queries: int = 512) -> int:
    """The radius whose probes find this share of neighbours, by inner product, in the sample x of n rows. A query's k nearest of n rows are
    among its k * len(x) / n nearest of the sample, rounded up, on average."""
    near = min(len(x) - 1, max(1, -(-k * len(x) // max(n, 1))))
    if near < 1:
        return 0
    q = np.arange(0, len(x), max(1, len(x) // queries))
    s = x[q] @ x.T
    s[np.arange(len(q)), q] = -np.inf
    best = np.argpartition(-s, near - 1, axis=1)[:, :near]
    codes = encode(units(x), rotation)
    return int(np.quantile(step_found(np.repeat(codes[:, q], near, axis=1), codes[:, best.ravel()]), share, method="higher"))


@lru_cache(maxsize=32)
def masks(q: int) -> np.ndarray:
    """All values of exactly q bits."""
    v = np.arange(1 << BITS, dtype=np.int64)
    return v[np.bitwise_count(v) == q]


class SubstringIndex:
    """A block of codes, each substring indexed by its value: rows in the order of values, and each value's first place."""

    def __init__(self, codes: np.ndarray):
        self.codes, self.n = codes, codes.shape[1]
        self.rows = np.argsort(codes, axis=1, kind="stable").astype(np.int32)

    def probe(self, queries: np.ndarray, hit: np.ndarray, start: int, stop: int) -> None:
        """Sets hit, (queries, rows), where pairs are first found by a radius of start to stop - 1."""
        m, flat = len(self.codes), hit.reshape(-1)
        for j in range(m):
            levels = [q for q in range(BITS + 1) if start <= m * q + j < stop]
            if any(len(masks(q)) < self.n for q in levels):
                held = np.bincount(self.codes[j], minlength=1 << BITS).astype(np.int32)
                there, first = held > 0, np.cumsum(held, dtype=np.int32) - held
            for q in levels:
                if len(masks(q)) >= self.n:  # fewer values than probes: test each indexed value
                    hit |= np.bitwise_count(queries[j][:, None] ^ self.codes[j][None, :]) == q
                    continue
                probes = (queries[j].astype(np.int64)[:, None] ^ masks(q)[None, :]).reshape(-1)
                found = np.flatnonzero(there.take(probes))
                value = probes.take(found)
                size, row = held.take(value), (found // len(masks(q))) * self.n
                ends = np.cumsum(size, dtype=np.int64)
                place = np.repeat(first.take(value) - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
                flat[np.repeat(row, size) + self.rows[j].take(place)] = True


class Block:
    """Rows of one block with their index."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, rotation: np.ndarray):
        self.x, self.ids, self.rotation = x, ids, rotation
        self.index = SubstringIndex(encode(units(x), rotation))

    def top(self, qx: np.ndarray, qid: np.ndarray, r: int, k: int, grow: bool):
        """(query, id, score, candidates) arrays: the k nearest of each query among the codes that probing to radius r
        finds; with grow, the radius grows for queries that find fewer than k. candidates: rows found for each query."""
        codes, m = encode(units(qx), self.rotation), len(self.index.codes)
        hit = np.zeros((len(qx), len(self.x)), dtype=bool)
        self.index.probe(codes, hit, 0, r + 1)
        own = qid[:, None] == self.ids[None, :]
        short = np.arange(len(qx)) if grow else np.zeros(0, int)
        while len(short := short[((hit[short] & ~own[short]).sum(axis=1) < np.minimum(k, (~own[short]).sum(axis=1)))]):
            part = hit[short]
            self.index.probe(codes[:, short], part, r + 1, r + 1 + m)
            hit[short] = part
            r += m
        hit &= ~own
        qi, ri = np.nonzero(hit)
        score = np.empty(len(qi))
        for at in range(0, len(qi), 1 << 15):
            s = slice(at, at + (1 << 15))
            score[s] = np.einsum("ij,ij->i", qx[qi[s]], self.x[ri[s]])
        found = np.bincount(qi, minlength=len(qx))
        ends = np.cumsum(found)
        picked = []
        for lo, hi in zip((ends - found).tolist(), ends.tolist()):
            if hi - lo > k:  # the k-th largest score and all that tie with it
                edge = np.partition(score[lo:hi], hi - lo - k)[hi - lo - k]
                picked.append(lo + np.flatnonzero(score[lo:hi] >= edge))
            else:
                picked.append(np.arange(lo, hi))
        at = np.concatenate(picked)
        at = at[np.lexsort((self.ids[ri[at]], -score[at], qi[at]))]
        q = qi[at]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        at = at[rank < k]
        return qid[qi[at]], self.ids[ri[at]], score[at], found


def nearest(
    rows: DataFrame,
    is_query,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 20,
    substrings: int = 80,
    sample_rows: int = 8192,
    block_rows: int = 32_768,
    query_rows: int = 65_536,
) -> DataFrame:
    """(query_id, rank, id_col, score): the k rows of largest inner product found for each row where is_query holds, its
    own row left out; ties go to the smaller id.

    The rotations and the radius are fitted on at most sample_rows rows (those of smallest hash); every row is indexed.
    Rows are cut into hashed blocks of about block_rows, each indexed once for about query_rows queries, which stream through; so a
    task holds one block and one batch of queries, whatever the size of the table, and no id or cluster of copies makes a
    block larger. A row moves once for each query_rows queries and a query once for each block. Queries that find fewer
    than k in all go through the blocks again, with radii that grow until k are found in each. Vectors that are null,
    empty, zero, hold null or non-finite components or aren't of the prevailing length take no part. Rows with a null id
    take no part; of rows that repeat an id all are searched, but none of them for its own id. An empty table, or one
    without a second row, gives no rows.
    """
    from pyspark.sql import Window

    spark = rows.sparkSession
    base = rows.select(F.col(id_col).cast("long").alias("id"), numbers(rows, vector_col).alias("v"), is_query.alias("q")).where(usable(F.col("v")) & F.col("id").isNotNull())
    d = prevailing_size(base, "v")
    base = base.where(F.size("v") == d)
    sample = [r["v"] for r in base.select("v", F.xxhash64("id", "v").alias("h")).orderBy("h").limit(sample_rows).collect()]
    out_type = f"query_id long, rank int, {id_col} long, score double"
    if not sample:
        return spark.createDataFrame([], out_type)
    n, nq = base.agg(F.count("*"), F.sum(F.coalesce(F.col("q"), F.lit(False)).cast("long"))).first()
    x = np.array(sample, dtype=np.float64)
    rotation = fit_rotations(units(x), substrings * BITS)
    r = radius_for(x, rotation, k, n)
    nb, qb = blocks_of(n, block_rows), blocks_of(nq or 0, query_rows)
    block = lambda c, m, salt: F.pmod(F.xxhash64(F.lit(salt), *c), F.lit(m)).cast("int")
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))

    def search(grow: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at, held, index = None, [], None
            for batch in batches:
                spot = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(int) for c in ("b", "c", "asks")], axis=1)
                edges = np.r_[0, np.flatnonzero((spot[1:] != spot[:-1]).any(axis=1)) + 1, len(spot)]
                for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
                    if lo == hi:
                        continue
                    if at != tuple(spot[lo, :2]):
                        at, held, index = tuple(spot[lo, :2]), [], None
                    if not spot[lo, 2]:
                        held.append(batch.slice(lo, hi - lo))
                        continue
                    if index is None and held:
                        t = pa.Table.from_batches(held)
                        index, held = Block(matrix(t["v"]), t["id"].to_numpy(), rotation), []
                    for s in range(lo, hi, CHUNK) if index else ():
                        part = batch.slice(s, min(CHUNK, hi - s))
                        found = index.top(matrix(part.column("v")), part.column("id").to_numpy(), r, k, grow)[:3]
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], ["query_id", "id", "score"])

        return run

    def ask(queries: DataFrame, parts: int, grow: bool) -> DataFrame:
        held = base.select(block(["id", "v"], nb, 1).alias("b"), every(parts).alias("c"), F.lit(False).alias("asks"), "id", "v")
        asks = queries.select(every(nb).alias("b"), block(["id", "v"], parts, 2).alias("c"), F.lit(True).alias("asks"), "id", "v")
        cells = held.unionByName(asks).repartition(max(1, min(nb * parts, 100_000)), "b", "c").sortWithinPartitions("b", "c", "asks")
        found = cells.mapInArrow(search(grow), "query_id long, id long, score double")
        best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")

    out = cut(ask(base.where("q"), qb, False))
    counts = out.groupBy(F.col("query_id").alias("done")).count().where(F.col("count") >= k)
    short = base.where("q").join(counts, F.col("id") == F.col("done"), "left_anti")
    if not (n_short := short.count()):
        return out
    full = out.join(counts, F.col("query_id") == F.col("done"), "left_semi")
    return full.unionByName(ask(short, blocks_of(n_short, query_rows), True))
