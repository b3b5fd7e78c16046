"""What the operators share: reading tables, cutting lineage, streaming sorted groups."""

from __future__ import annotations

import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or a temporary one where none is set in local mode (tests); a cluster must set it."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        if not sc.getConf().get("spark.checkpoint.dir") and (sc.master.startswith("local-cluster") or not sc.master.startswith("local")):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(sc.getConf().get("spark.checkpoint.dir") or tempfile.mkdtemp(prefix="eventframe-"))
    return sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Materialise df in the shared folder; later reads survive the loss of any executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared store that no later step reads."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def blocks_of(n_rows: int, per_block: int) -> int:
    return max(1, -(-n_rows // per_block))


def sorted_groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of equal keys from batches sorted by them, each as one table; a run may span batches."""
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        change = np.zeros(t.num_rows, dtype=bool)
        for k in keys:
            codes = t[k].combine_chunks().dictionary_encode()
            codes = codes.combine_chunks() if isinstance(codes, pa.ChunkedArray) else codes
            c = codes.indices.fill_null(-1).to_numpy(zero_copy_only=False)
            change[1:] |= c[1:] != c[:-1]
        cuts = np.flatnonzero(change)
        edges = [0, *cuts.tolist(), t.num_rows]
        for a, b in zip(edges[:-1], edges[1:]):
            part = t.slice(a, b - a)
            if held and any(held[0][k][0].as_py() != part[k][0].as_py() for k in keys):
                yield pa.concat_tables(held)
                held = []
            held.append(part)
            if b < t.num_rows:
                yield pa.concat_tables(held)
                held = []
    if held:
        yield pa.concat_tables(held)


def min_roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest index reachable from each of 0..n-1 over the given links; vectorised hooking and jumping."""
    root = np.arange(n)
    if not len(left):
        return root
    while True:
        a, b = root[left], root[right]
        lo, hi = np.minimum(a, b), np.maximum(a, b)
        if not (lo != hi).any():
            return root
        np.minimum.at(root, hi, lo)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """(node, root) for each node of an edge; root is the smallest node of its connected component.

    Large-star and small-star steps in turn, all as joins and min-aggregations: a node's neighbours are never
    gathered in a list, so a node with very many links costs no task its memory. Nodes with more than 1/2048 of
    all link ends, 2,048 of them at most, are looked up in a short list, so that a hub's links stay where they are.
    Every round is checkpointed.
    """
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    e = cut(e.select(F.when(F.col("u") > F.col("v"), F.col("u")).otherwise(F.col("v")).alias("u"), F.when(F.col("u") > F.col("v"), F.col("v")).otherwise(F.col("u")).alias("v")).distinct())
    before, size = None, e.count()
    for _ in range(rounds):
        # large star: link every larger neighbour of u to the smallest of u and its neighbours
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("ends"))
        low = low.select(F.col("u").alias("k"), F.when(F.col("m") < F.col("u"), F.col("m")).otherwise(F.col("u")).alias("m"), (F.col("ends") * 2048 > 2 * size).alias("hub"))
        hubs, others = F.broadcast(low.where("hub")), low.where("not hub")
        large = e.join(hubs, e.v == F.col("k")).select("u", "m").unionByName(e.join(hubs, e.v == F.col("k"), "left_anti").join(others, F.col("v") == F.col("k")).select("u", "m"))
        large = large.select("u", F.col("m").alias("v")).where("u <> v").distinct()
        # small star: link the smaller neighbours of u, and u, to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m")
        small = large.join(low, large.u == low.k).select(
            F.explode(F.array(F.struct(F.col("u").alias("x"), F.col("m")), F.struct(F.col("v").alias("x"), F.col("m")))).alias("s")
        )
        e = cut(small.select(F.col("s.x").alias("u"), F.col("s.m").alias("v")).where("u <> v").distinct())
        state = e.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long")), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before:
            break
        before, size = state, state[0]
    else:
        raise RuntimeError("connected components did not settle")
    roots = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
