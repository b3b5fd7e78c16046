"""Relational operators that Spark has no single call for, composed of those it has."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Rows of a side that is broadcast; a longer one is joined by shuffle.
BROADCAST_ROWS = 100_000


def sized_join(large: DataFrame, small: DataFrame, on: Column, how: str = "inner") -> DataFrame:
    """A join that broadcasts small where it has at most BROADCAST_ROWS rows, which are counted first, and shuffles otherwise."""
    return large.join(F.broadcast(small) if small.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else small, on, how)


def as_of_join(left: DataFrame, right: DataFrame, by: str, left_on: str, right_on: str, values: list[str], width: float | None = None) -> DataFrame:
    """Each left row with the values of the last right row of the same key at or before it (null if none). One shuffle
    by key and one sort: both sides are interleaved and the last right row is carried forward.

    With a width, a key's rows are dealt by stretches of that width of a numeric time, so that a key with very many rows is
    many tasks; each stretch starts with the last right row of those before it, found from one row for each stretch. Rows with
    a null key or time find nothing."""
    carried = F.struct(*[F.col(v) for v in values])
    a = left.select(F.col(by).alias("_k"), F.col(left_on).alias("_t"), F.lit(1).alias("_side"), F.struct(*left.columns).alias("_row"), F.lit(None).alias("_v"))
    b = right.where(F.col(by).isNotNull() & F.col(right_on).isNotNull()).select(F.col(by).alias("_k"), F.col(right_on).alias("_t"), F.lit(0).alias("_side"), F.lit(None).alias("_row"), carried.alias("_v"))
    both, keys = a.unionByName(b), ["_k"]
    if width is not None:
        keys = ["_k", "_b"]
        both = both.withColumn("_b", F.floor(F.col("_t") / width))
        ends = both.groupBy("_k", "_b").agg(F.max_by("_v", F.when(F.col("_side") == 0, F.col("_t"))).alias("_v"))
        before = Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
        ends = ends.select("_k", "_b", F.last("_v", ignorenulls=True).over(before).alias("_v")).where("_v is not null")
        both = both.unionByName(ends.select("_k", (F.col("_b") * width).cast(left.schema[left_on].dataType).alias("_t"), F.lit(-1).alias("_side"), F.lit(None).alias("_row"), "_v", "_b"))
    w = Window.partitionBy(*keys).orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    both = both.withColumn("_last", F.when(F.col("_k").isNotNull() & F.col("_t").isNotNull(), F.last("_v", ignorenulls=True).over(w)))
    return both.where("_side = 1").select("_row.*", *[F.col(f"_last.{v}").alias(v) for v in values])


def range_join(points: DataFrame, ranges: DataFrame, at: str, low: str, high: str, width: float) -> DataFrame:
    """Pairs with low <= at < high, as an equi-join on buckets of the given width, so that neither side is multiplied by
    the other; a range goes to every bucket it touches."""
    p = points.withColumn("_bucket", F.floor(F.col(at) / width))
    r = ranges.withColumn("_bucket", F.explode(F.sequence(F.floor(F.col(low) / width), F.floor(F.col(high) / width))))
    return p.join(r, "_bucket").where((F.col(at) >= F.col(low)) & (F.col(at) < F.col(high))).drop("_bucket")


def histogram(df: DataFrame, bin_col: Column, weight: Column | None = None) -> DataFrame:
    """Counts (or sums of weights) per bin, combined before the shuffle."""
    return df.groupBy(bin_col.alias("bin")).agg((F.sum(weight) if weight is not None else F.count("*")).alias("n"))


def salted_sum(df: DataFrame, key: str, value: Column, salts: int = 16) -> DataFrame:
    """Sum per key in two steps, for keys so hot that even their partial sums should spread; equal rows spread too."""
    first = df.groupBy(key, F.pmod(F.monotonically_increasing_id(), F.lit(salts)).alias("_salt")).agg(F.sum(value).alias("_s"))
    return first.groupBy(key).agg(F.sum("_s").alias("total"))


def top_per_group(df: DataFrame, group: str, order: list, k: int) -> DataFrame:
    """The first k rows of each group; Spark keeps only k per group and task before the shuffle."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("rank") <= k)
