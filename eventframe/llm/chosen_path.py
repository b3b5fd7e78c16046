"""N-gram Jaccard join by chosen paths.

Each text is the set of its five-word shingles; equal sets are one class from the start. A class has 64 MinHash tokens, so
that two classes share a token at any place with probability equal to their Jaccard similarity. One run is a tree: at
each node a set follows a few token places, chosen by the path so far, and sets that agree on the token go on together. Buckets
at the end of the distributed levels are split on in memory until they are small or made of one dense group, and then compared
by brute force on one-byte sketches of the tokens. Runs repeat until a pair at the threshold meets in some bucket with the
target probability. Sketch matches only group candidates; links are settled on the true sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, cut, min_roots, sorted_groups
from .shingles import mix, set_key, shingle_sets

TOKENS = 64
FAN = 2
#: A list of so many keys may be broadcast; a longer one is joined by shuffle.
BROADCAST_ROWS = 100_000
#: Rows of a list of hot keys, each of which has more than the inverse of this of all rows.
SHORT_LIST = 4096
LEVELS = 2
#: The recursion in memory: places per node, levels, and rows that are not split further.
SPLIT_FAN, SPLIT_DEPTH, SPLIT_ROWS = 4, 6, 256
#: Stops the search for the number of runs.
MOST_RUNS = 1000
#: Sets of at least this many shingles get one-permutation tokens; those of up to 5/4 of it independent ones (in between, both, since
#: linked sets differ in size by at most the threshold).
DENSE = 256
_ORDERS = np.stack([np.random.default_rng(b).permutation(TOKENS) for b in range(TOKENS)])
_SEEDS = mix(np.arange(1, TOKENS + 1, dtype=np.uint64))
_BINS = np.arange(TOKENS, dtype=np.uint64) << np.uint64(58)


def tokens(s: np.ndarray) -> np.ndarray:
    """64 independent MinHash values."""
    with np.errstate(over="ignore"):
        return mix(s[None, :] ^ _SEEDS[:, None]).min(axis=1).astype(np.uint32)


def bin_tokens(s: np.ndarray) -> np.ndarray:
    """64 values of one permutation: the least hash of each of 64 ranges; empty ranges borrow by fixed orders."""
    at = np.searchsorted(s, _BINS)
    values = s[np.minimum(at, len(s) - 1)]
    full = (at < len(s)) & ((values >> np.uint64(58)) == np.arange(TOKENS, dtype=np.uint64))
    if not full.all():
        lender = _ORDERS[np.arange(TOKENS), full[_ORDERS].argmax(axis=1)]
        values = np.where(full, values, values[lender])
    return mix(values).astype(np.uint32)


def missed(similarity: float, runs: int, least: int) -> float:
    """Bound on the probability that a pair of this similarity is in no candidate group, where all of its buckets are split on in
    memory to the last level. All runs look at the same tokens, so it is the mean over the number of those that agree."""
    total = 0.0
    for k in range(TOKENS + 1):
        agree, meets = k / TOKENS, 1.0
        for fan in [SPLIT_FAN] * SPLIT_DEPTH + [FAN] * LEVELS:
            meets = 1 - (1 - agree * meets) ** fan
        total += math.comb(TOKENS, k) * similarity**k * (1 - similarity) ** (TOKENS - k) * (1.0 if k < least else (1 - meets) ** runs)
    return total


def least_for(threshold: float, recall: float, slack: float) -> int:
    """Sketch bytes that must agree: as slack says, or fewer where that alone would lose over half of what recall allows."""
    least, lost = 0, math.comb(TOKENS, 0) * (1 - threshold) ** TOKENS
    while least < TOKENS and lost <= (1 - recall) / 2:
        least += 1
        lost += math.comb(TOKENS, least) * threshold**least * (1 - threshold) ** (TOKENS - least)
    return min(least, math.ceil((threshold - slack) * TOKENS))


def runs_for(threshold: float, recall: float, least: int = 0) -> int:
    """Runs after which a pair at the threshold has met, and passed the sketches, with this probability."""
    runs = 1
    while missed(threshold, runs, least) > 1 - recall and runs < MOST_RUNS:
        runs += 1
    return runs


def paths(t: np.ndarray, runs: int, scheme: int) -> np.ndarray:
    """Keys of the buckets that a set with tokens t reaches: FAN ** LEVELS per run."""
    node = mix(np.arange(runs, dtype=np.uint64) + np.uint64(1000 * (scheme + 1)))
    with np.errstate(over="ignore"):
        for _ in range(LEVELS):
            first = node & np.uint64(63)
            places = np.concatenate([(first + (node >> np.uint64(8)) % np.uint64(63) + np.uint64(1)) & np.uint64(63), first])
            node = np.concatenate([node, node])
            node = mix(node * np.uint64(31) + places * np.uint64(7919) ^ t[places.astype(np.int64)].astype(np.uint64))
    return node.view(np.int64)


def sketches_link(a: np.ndarray, b: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows that agree in at least so many of their bytes."""
    left, right = [], []
    step = max(1, (1 << 22) // max(1, len(b)))
    for lo in range(0, len(a), step):
        agree = np.zeros((len(a[lo : lo + step]), len(b)), dtype=np.uint8)
        for k in range(a.shape[1]):
            agree += a[lo : lo + step, k][:, None] == b[None, :, k]
        i, j = np.nonzero(agree >= least)
        left.append(i + lo)
        right.append(j)
    return np.concatenate(left), np.concatenate(right)


def split_on(rows: np.ndarray, sk: np.ndarray, seed: int, depth: int, small: int) -> Iterator[np.ndarray]:
    """The recursion in memory: buckets small enough, or too alike to split."""
    if len(rows) <= small or depth == 0:
        yield rows
        return
    own = sk[rows]
    alike = np.mean([((np.bincount(own[:, k], minlength=256) / len(rows)) ** 2).sum() for k in range(own.shape[1])])
    if alike >= 0.5:
        yield rows
        return
    rng = np.random.default_rng(seed)
    for k in rng.choice(own.shape[1], size=SPLIT_FAN, replace=False):
        order = np.argsort(own[:, k], kind="stable")
        cuts = np.flatnonzero(np.diff(own[order, k])) + 1
        for part in np.split(order, cuts):
            if len(part) > 1:
                yield from split_on(rows[part], sk, (seed * 16_411 + int(k) * 257 + int(own[part[0], k])) % (1 << 40), depth - 1, small)


def bucket_links(key: int, sk: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Candidate pairs of rows of a bucket. The places to split on follow from its key, so that buckets of a pair lose it independently."""
    left, right = [], []
    for rows in split_on(np.arange(len(sk)), sk, key % (1 << 40), SPLIT_DEPTH, SPLIT_ROWS):
        i, j = sketches_link(sk[rows], sk[rows], least)
        up = i < j
        left.append(rows[i[up]])
        right.append(rows[j[up]])
    return np.concatenate(left or [np.zeros(0, int)]), np.concatenate(right or [np.zeros(0, int)])


def forest(ids: pa.Array, root: np.ndarray) -> pa.RecordBatch:
    member = np.flatnonzero(root != np.arange(len(root)))
    return pa.RecordBatch.from_arrays([ids.take(pa.array(member)), ids.take(pa.array(root[member]))], ["a", "b"])


def flat(column: pa.ChunkedArray) -> pa.Array:
    c = column.combine_chunks()
    return c.chunk(0) if isinstance(c, pa.ChunkedArray) else c


def byte_rows(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, width)


class Links:
    """Counts of links between sets, weighted, and enough pairs to connect them."""

    def __init__(self, sets: list[np.ndarray], weight: np.ndarray, threshold: float):
        self.sets, self.weight, self.threshold = sets, weight, threshold
        self.size = np.array([len(s) for s in sets])
        self.every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        values, self.ids = np.unique(self.every, return_inverse=True)
        self.mark = np.zeros(len(values), dtype=bool)
        self.first = np.r_[0, np.cumsum(self.size)]

    def between(self, rows: range, others: range, same: bool):
        n, left, right = np.zeros(len(self.sets), dtype=np.int64), [], []
        lo, hi = self.first[others.start], self.first[others.stop]
        ids, starts = self.ids[lo:hi], self.first[others.start : others.stop] - lo
        for i in rows:
            mine = self.ids[self.first[i] : self.first[i + 1]]
            self.mark[mine] = True
            common = np.add.reduceat(self.mark[ids], starts, dtype=np.int64)
            self.mark[mine] = False
            joint = self.size[i] + self.size[others.start : others.stop] - common
            j = np.flatnonzero(common >= self.threshold * joint - 1e-9) + others.start
            j = j[j > i] if same else j
            n[i] += self.weight[j].sum()
            n[j] += self.weight[i]
            left.append(np.full(len(j), i))
            right.append(j)
        return n, np.concatenate(left or [np.zeros(0, int)]), np.concatenate(right or [np.zeros(0, int)])


def jaccard_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 5,
    threshold: float = 0.8,
    recall: float = 0.9999,
    slack: float = 0.2,
    block_rows: int = 2048,
    set_block_rows: int = 256,
) -> DataFrame:
    """One row per row of docs: id_col, text_key (xxhash64 of the text), n_links (other rows whose shingle sets have
    Jaccard similarity of at least threshold with this row's), class_id (the smallest id among the rows reachable by links),
    class_key (which tells classes apart even where ids repeat; null without a word).

    Words are maximal runs of bytes other than space and tab to carriage return, compared as they are; a text of fewer
    than five words is one shingle. Rows without a word (null, empty or blank texts) link with nothing and are classes of their own.
    Equal texts, and repeated rows, are links too, but are counted from the size of their class and never expanded.
    Null ids are allowed: they are never a class_id unless the class has no other. slack: how far the share of equal
    sketch bytes may fall short of the threshold (four standard deviations by default; it is widened where recall needs it).
    No table of documents goes to the driver, buckets over block_rows become pairs of blocks, and so do candidate groups.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = base.schema["id"].dataType.simpleString()
    least = least_for(threshold, recall, slack)
    runs = runs_for(threshold, recall, least)
    n_keys = runs * FAN**LEVELS

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                keys, small, dense = [], [], []
                for s in shingle_sets(part.column(1).fill_null("").cast(pa.large_string()), words):
                    keys.append(set_key(s) if len(s) else None)
                    small.append(tokens(s).tobytes() if 0 < len(s) <= DENSE / threshold else None)
                    dense.append(bin_tokens(s).tobytes() if len(s) >= DENSE else None)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(keys, pa.binary()), pa.array(small, pa.binary()), pa.array(dense, pa.binary())], ["id", "text_key", "sid", "small", "dense"])

    signed = base.select("id", "text", F.xxhash64("text").alias("text_key")).mapInArrow(sign, f"id {kind}, text_key long, sid binary, small binary, dense binary")
    signed = cut(signed)
    # classes of equal sets
    classes = signed.where("sid is not null").groupBy("sid").agg(F.count("*").alias("m"), F.min("id").alias("least_id"), F.min(F.struct("id", "text_key")).alias("any"), F.first("small").alias("small"), F.first("dense").alias("dense"))
    classes = cut(classes)

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                sids, keys, sketches = [], [], []
                for sid, *both in zip(*(batch.column(k).slice(lo, 4096).to_pylist() for k in range(3))):
                    for scheme, t in enumerate(both):
                        if t is not None:
                            values = np.frombuffer(t, dtype=np.uint32)
                            keys.append(paths(values, runs, scheme))
                            sketches += [(values & np.uint32(255)).astype(np.uint8).tobytes()] * n_keys
                            sids += [sid] * n_keys
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64)), pa.array(sids, pa.binary()), pa.array(sketches, pa.binary())], ["key", "sid", "sketch"])

    reached = classes.select("sid", "small", "dense").mapInArrow(reach, "key long, sid binary, sketch binary")

    # keys of buckets over block_rows: at most one per block_rows rows, counted with map-side sums
    hot = cut(reached.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > block_rows))
    n_hot = hot.count()
    hot = F.broadcast(hot) if n_hot <= BROADCAST_ROWS else hot
    modest = reached.join(hot, "key", "left_anti") if n_hot else reached

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket in sorted_groups(batches, ["key"]):
            n = bucket.num_rows
            if n == 1:
                continue
            sid = flat(bucket["sid"])
            sk = byte_rows(flat(bucket["sketch"]), TOKENS)
            yield forest(sid, min_roots(n, *bucket_links(bucket["key"][0].as_py(), sk, least)))

    edges = modest.repartition("key").sortWithinPartitions("key").mapInArrow(compare, "a binary, b binary")

    def blocks(rows: DataFrame, by: str, per: int, *cols: str) -> DataFrame:
        """Rows of a group, with its number of rows n, as cells (by, i, j) of two blocks of about per rows each."""
        own = rows.withColumn("nb", F.ceil(F.col("n") / per).cast("int")).withColumn("own", F.pmod(F.xxhash64("sid"), F.col("nb")).cast("int"))
        own = own.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
        return own.select(by, F.least("own", "o").alias("i"), F.greatest("own", "o").alias("j"), "own", "sid", *cols).repartition(by, "i", "j").sortWithinPartitions(by, "i", "j", "own", "sid")

    def compare_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in sorted_groups(batches, ["key", "i", "j"]):
            sk, own = byte_rows(flat(cell["sketch"]), TOKENS), cell["own"].to_numpy()
            i, j = cell["i"][0].as_py(), cell["j"][0].as_py()
            x, y = np.flatnonzero(own == i), np.flatnonzero(own == j)
            a, b = sketches_link(sk[x], sk[y], least) if len(x) and len(y) else (x[:0], y[:0])
            yield forest(flat(cell["sid"]), min_roots(len(sk), x[a], y[b]))

    if n_hot:
        large = reached.join(hot, "key")
        edges = edges.unionByName(blocks(large, "key", block_rows, "sketch").mapInArrow(compare_blocks, "a binary, b binary"))
    group = cut(components(edges).select(F.col("node").alias("sid"), F.col("root").alias("grp")))

    # the true sets of the classes that have candidates, from the text of one row each; groups over a block, at most one per
    # set_block_rows classes, are looked up by themselves, so that no large group meets in one task
    large = cut(group.groupBy("grp").agg(F.count("*").alias("n")).where(F.col("n") > set_block_rows))
    large = F.broadcast(large) if large.count() <= BROADCAST_ROWS else large
    chosen = group.join(classes, "sid").select("sid", "grp", "m", F.col("any.id").alias("rid"), F.col("any.text_key").alias("rkey"))
    source = base.select("id", "text", F.xxhash64("text").alias("text_key")).join(chosen, F.col("id").eqNullSafe(F.col("rid")) & (F.col("text_key") == F.col("rkey"))).select("sid", "grp", "m", "text")

    def true_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                made = [s.tobytes() for s in shingle_sets(part.column(3).cast(pa.large_string()), words)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), pa.array(made, pa.large_binary()).cast(pa.binary())], ["sid", "grp", "m", "items"])

    sets = source.mapInArrow(true_sets, "sid binary, grp binary, m long, items binary")

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in sorted_groups(batches, ["grp", "i", "j"]):
            sid = flat(cell["sid"])
            keys = sid.to_pylist()
            keep = [k for k in range(len(keys)) if not k or keys[k] != keys[k - 1]]  # repeated rows of one class
            own, items, m = cell["own"].to_numpy()[keep], cell["items"].take(keep).to_pylist(), cell["m"].to_numpy()[keep]
            sid, i, j = sid.take(pa.array(keep)), cell["i"][0].as_py(), cell["j"][0].as_py()
            split = int((own == i).sum())  # sorted by own, and i <= j
            links = Links([np.frombuffer(x, dtype=np.uint64) for x in items], m, threshold)
            if i == j:
                n, a, b = links.between(range(split), range(split), True)
            elif 0 < split < len(own):
                n, a, b = links.between(range(split), range(split, len(own)), False)
            else:
                continue
            root, has = min_roots(len(own), a, b), np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([sid.take(pa.array(has)), sid.take(pa.array(root[has])), pa.array(n[has])], ["sid", "hub", "n"])

    sets = sets.join(large, "grp", "left").withColumn("n", F.coalesce("n", F.lit(1)))
    settled = cut(blocks(sets, "grp", set_block_rows, "m", "items").mapInArrow(settle, "sid binary, hub binary, n long"))
    roots = components(settled.select(F.col("sid").alias("a"), F.col("hub").alias("b"))).select(F.col("node").alias("sid"), "root")
    linked = settled.groupBy("sid").agg(F.sum("n").alias("n"))
    label = cut(classes.select("sid", "m", "least_id").join(linked, "sid", "left").join(roots, "sid", "left").withColumn("root", F.coalesce("root", "sid")))
    n_classes, total = label.agg(F.count("*"), F.coalesce(F.sum("m"), F.lit(0))).first()
    # a class or a text with more than 1/SHORT_LIST of all is looked up in a list of at most SHORT_LIST
    low = cut(label.groupBy("root").agg(F.min("least_id").alias("class_id"), F.count("*").alias("sets")).where("sets > 1"))
    hubs, others = F.broadcast(low.where(F.col("sets") * SHORT_LIST > n_classes)), low.where(F.col("sets") * SHORT_LIST <= n_classes)
    label = label.join(hubs.select("root", F.col("class_id").alias("hub_id")), "root", "left")
    label = label.withColumn("look", F.when(F.col("hub_id").isNull(), F.col("root")).otherwise(F.col("sid")))
    label = label.join(others.select(F.col("root").alias("look2"), F.col("class_id").alias("low_id")), (F.col("look") == F.col("look2")) & F.col("hub_id").isNull(), "left")
    label = cut(label.select("sid", "m", (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"), F.coalesce("hub_id", "low_id", "least_id").alias("class_id"), F.col("root").alias("class_key")))
    got = F.struct("n_links", "class_id", "class_key")
    hot = F.broadcast(label.where(F.col("m") * SHORT_LIST > total).select("sid", got.alias("hot")))
    rest = label.where(F.col("m") * SHORT_LIST <= total).select(F.col("sid").alias("look2"), got.alias("cold"))
    out = signed.select("id", "text_key", "sid").join(hot, "sid", "left")
    out = out.withColumn("look", F.when(F.col("hot").isNull() & F.col("sid").isNotNull(), F.col("sid")).otherwise(F.unhex(F.hex(F.xxhash64("id", "text_key")))))  # 8 bytes, which no set's key has
    out = out.join(rest, F.col("look") == F.col("look2"), "left").withColumn("got", F.coalesce("hot", "cold")).select("id", "text_key", "sid", "got.*")
    return out.select(F.col("id").alias(id_col), "text_key", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("sid").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"), "class_key")
