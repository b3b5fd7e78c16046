"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

#: Rows that a bucket of the shuffle order, or of virtual time, is meant to hold of the largest source.
BUCKET_ROWS = 50_000


def word_count(text: Column) -> Column:
    """Number of maximal runs of characters other than space and tab to carriage return; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """sizes: one row per source (source, source_size). Adds target: the sources, by code point with null last, weigh
    weights in turn and share `share` times all sizes; a target stops at `most` times its source's size, and the excess is shared
    by weight among the others until none is above."""
    order = Window.orderBy(F.col("source").isNull(), "source")
    by_ratio = Window.orderBy("ratio", "rank")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    # sources fill up in the order of cap per weight: with those before it full, a source is full if its cap per weight is
    # below what is left per weight
    level = (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (F.col("all_w") - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    ranked = (
        sizes.withColumn("rank", F.row_number().over(order))
        .withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int")))
        .withColumn("cap", F.col("source_size") * F.lit(float(most)))
        .withColumn("ratio", F.col("cap") / F.col("w"))
        .withColumn("budget", F.sum("source_size").over(Window.partitionBy()) * F.lit(float(share)))
        .withColumn("all_w", F.sum("w").over(Window.partitionBy()))
        .withColumn("level", level)
    )
    first = F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("ratio", "rank", "level"))).over(Window.partitionBy())
    free = F.coalesce((F.col("ratio") > F.col("f.ratio")) | ((F.col("ratio") == F.col("f.ratio")) & (F.col("rank") >= F.col("f.rank"))), F.lit(False))
    return ranked.withColumn("f", first).select("source", "source_size", F.when(free, F.col("w") * F.col("f.level")).otherwise(F.col("cap")).alias("target"))


def numbered(groups: DataFrame) -> DataFrame:
    """Each of m equal rows with its number, twin; those of a group of more than BUCKET_ROWS come from a task for each so many."""
    few = groups.where(F.col("m") <= BUCKET_ROWS).withColumn("twin", F.explode(F.sequence(F.lit(1).cast("long"), F.col("m"))))
    many = groups.where(F.col("m") > BUCKET_ROWS).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("m") - 1) / BUCKET_ROWS))))
    last = F.least("m", (F.col("part") + 1) * BUCKET_ROWS)
    many = many.repartition("id", "text_key", "part").withColumn("twin", F.explode(F.sequence(F.col("part") * BUCKET_ROWS + 1, last))).drop("part")
    return few.unionByName(many).drop("m")


def mix_sources(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: int = 2
) -> tuple[DataFrame, DataFrame]:
    """(rows, taken). rows: row_key, id, size, source_size, target per row of docs. taken: row_key, copy (from 1), size and finish, the
    virtual finish time, for each copy of a row that the mix takes.

    Copies of a source's rows queue in a shuffled order (a hash of id and copy, and of the text where the id is null): all rows once, then, where the target is above the
    source's size, again. A copy's virtual finish time is the words queued up to its end divided by its source's target, the
    source's effective weight. The copies of all sources, in the order of finish time, are taken while their words fit the
    total budget. Both running sums are split into buckets of the order, so that no source and no table is one task.

    A null source is a source of its own, last in order; null and empty texts have size 0 and are never taken. Rows that repeat an id
    and text are told apart by a number among them, and each is a row of its own: they are counted first, and the numbers of
    very many are dealt to several tasks. An empty table gives empty results.
    """
    base = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), F.col(text_col).cast("string").alias("text"))
    name = F.coalesce(F.col("id").cast("string"), F.md5("text"), F.lit(""))
    sized = base.select("id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("text_key"), name.alias("name"))
    rows = numbered(cut(sized.groupBy("id", "source", "text_key", "size", "name").agg(F.count("*").alias("m"))))
    digits = max(2, math.ceil(math.log(max(1, rows.count() / BUCKET_ROWS), 16)))  # hex digits of the order that name a bucket
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = cut(source_targets(sizes, weights, share, most).withColumn("source_id", F.xxhash64("source")))
    small = targets.select(F.col("source").alias("s"), "source_size", "target")
    rows = rows.join(small, F.col("source").eqNullSafe(F.col("s")))
    key = F.struct("id", "text_key", "source", "twin")
    queued = (
        rows.where("size > 0 and target > 0")
        .select(key.alias("row_key"), "name", "source", "size", "source_size", "target", F.explode(F.sequence(F.lit(1), F.ceil(F.col("target") / F.col("source_size")).cast("int"))).alias("copy"))
        .withColumn("order", F.md5(F.concat_ws(":", "name", F.col("copy").cast("string"), F.when(F.col("row_key.twin") > 1, F.col("row_key.twin").cast("string")))))
    )
    queued = running_sum(queued, ["source", "copy"], F.substring("order", 1, digits), ["order", "row_key"], "queued")
    timed = queued.withColumn("finish", ((F.col("copy") - 1) * F.col("source_size") + F.col("queued")).cast("double") / F.col("target"))
    timed = cut(timed.select("row_key", "source", "copy", "size", "order", "finish"))
    budget = targets.agg(F.sum("target").alias("budget"))
    every = running_sum(timed.withColumn("one", F.lit(1)), ["one"], F.floor(F.col("finish") * 16**digits), ["finish", "source", "order", "row_key"], "total")
    taken = every.crossJoin(F.broadcast(budget)).where(F.col("total") <= F.col("budget")).select("row_key", "copy", "size", "finish")  # budget is one row
    return rows.select(key.alias("row_key"), "id", "size", "source_size", "target"), taken


def running_sum(df: DataFrame, group: list[str], bucket: Column, order: list[str], name: str) -> DataFrame:
    """Adds the running sum of size in each group by order; bucket must grow with order. Rows are summed within (group,
    bucket); only one row for each of these is summed across buckets."""
    df = df.withColumn("bucket", bucket)
    total = df.groupBy(*group, "bucket").agg(F.sum("size").alias("s"))
    ahead = Window.partitionBy(*group).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ahead_of = total.select(*[F.col(g).alias(f"_{g}") for g in group], F.col("bucket").alias("_bucket"), F.coalesce(F.sum("s").over(ahead), F.lit(0)).alias("ahead"))
    within = Window.partitionBy(*group, "bucket").orderBy(*order)
    on = [df[g].eqNullSafe(ahead_of[f"_{g}"]) for g in group] + [df["bucket"] == ahead_of["_bucket"]]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    joined = df.withColumn(name, F.sum("size").over(within))
    return joined.join(ahead_of, cond).withColumn(name, F.col(name) + F.col("ahead")).drop("ahead", "bucket", "_bucket", *[f"_{g}" for g in group])


def mixed_counts(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per row of docs: id_col, size, source_size, target, taken (words that the mix takes of it, repeats counted)."""
    rows, taken = mix_sources(docs, id_col=id_col, **options)
    words = taken.groupBy("row_key").agg(F.sum("size").alias("taken")).withColumnRenamed("row_key", "k")
    out = rows.join(words, F.col("row_key").eqNullSafe(F.col("k")), "left")
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """docs' own columns: each row as many times as the mix takes it. Rows of size 0 are never taken."""
    rows, taken = mix_sources(docs, id_col=id_col, text_col=text_col, source_col=source_col, **options)
    copies = taken.groupBy("row_key").agg(F.count("*").alias("n")).select("row_key.*", "n")
    copies = copies.select(F.col("id").alias("_id"), F.col("text_key").alias("_k"), F.col("source").alias("_s"), F.col("twin").alias("_w"), F.col("n").alias("_n"))
    key = F.xxhash64(F.col(text_col).cast("string"))
    source = F.col(source_col).cast("string")
    repeated = rows.where(F.col("row_key.twin") > 1).limit(1).count() > 0
    twin = F.row_number().over(Window.partitionBy(id_col, key, source).orderBy(F.lit(0))) if repeated else F.lit(1)
    own = docs.withColumn("_w2", twin)
    on = own[id_col].eqNullSafe(F.col("_id")) & (key == F.col("_k")) & source.eqNullSafe(F.col("_s")) & (F.col("_w2") == F.col("_w"))
    times = F.explode(F.sequence(F.lit(1), F.col("_n").cast("int")))
    return own.join(copies, on).select(*[own[c] for c in docs.columns], times.alias("_copy")).drop("_copy")
