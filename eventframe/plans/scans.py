"""Queries on the source itself: types, shapes, pruning, planning, files, codecs."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import dot, total
from ..sources.api import count_events, read_events
from .fixtures import by_flag, folder, scan

SPECS: dict = {}


def query(sql: str | None):
    def add(f):
        SPECS[f.__name__] = (f, sql)
        return f

    return add


L_US = "epoch_us(l_shipdate)"


@query(f"SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount + 0 AS l_discount, l_tax, {L_US} AS l_ship_us FROM lineitem")
def scan_scalars(spark, sf):
    return scan(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", (F.col("l_discount") + 0).alias("l_discount"), "l_tax", "l_ship_us")


@query("SELECT l_orderkey, l_quantity FROM lineitem")
def scan_pruned(spark, sf):
    return scan(spark, sf, "lineitem", ["l_orderkey", "l_quantity"])


@query("SELECT l_orderkey, l_quantity FROM lineitem")
def scan_pruned_by_schema(spark, sf):
    path = folder(spark, sf, "lineitem")
    read_events(spark, path, columns=["l_orderkey"])  # registers the source
    return spark.read.format("root").schema("l_orderkey long, l_quantity double").load(path)


@query("SELECT l_orderkey, l_tax FROM lineitem WHERE l_tax > 0.04")
def scan_sql_view(spark, sf):
    path = folder(spark, sf, "lineitem")
    read_events(spark, path, columns=["l_orderkey"])
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW lineitem_events USING root OPTIONS (path '{path}', columns 'l_orderkey,l_tax')")
    return spark.sql("SELECT l_orderkey, l_tax FROM lineitem_events WHERE l_tax > 0.04")


@query("SELECT l_orderkey, l_linenumber::SMALLINT AS u8, l_quantity::INT AS u16, l_partkey AS u32 FROM lineitem")
def scan_unsigned_widen(spark, sf):
    return scan(spark, sf, "unsigned", ["l_orderkey", "u8", "u16", "u32"])


@query("SELECT l_orderkey, l_suppkey - 50 AS u64 FROM lineitem")
def scan_uint64_wrap(spark, sf):
    return scan(spark, sf, "unsigned", ["l_orderkey", "u64"])


@query("SELECT l_orderkey, (CASE WHEN l_suppkey < 50 THEN 18446744073709551616::HUGEINT ELSE 0 END + l_suppkey - 50)::VARCHAR AS u64 FROM lineitem")
def scan_uint64_decimal(spark, sf):
    return scan(spark, sf, "unsigned", ["l_orderkey", "u64"], uint64="decimal").select("l_orderkey", F.col("u64").cast("string").alias("u64"))


@query("SELECT l_orderkey, l_discount > 0.05 AS l_deal FROM lineitem")
def scan_bool(spark, sf):
    return scan(spark, sf, "lineitem", ["l_orderkey", "l_deal"])


@query("SELECT vec_id, (i - 1)::INT AS pos, embedding[i] AS x FROM embeddings, generate_series(1, 64) g(i)")
def scan_fixed_array(spark, sf):
    return scan(spark, sf, "embeddings", ["vec_id", "embedding"]).select("vec_id", F.posexplode("embedding").alias("pos", "x"))


@query("SELECT vec_id, round(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]), 4) AS self_dot FROM embeddings")
def fixed_array_dot(spark, sf):
    return scan(spark, sf, "embeddings", ["vec_id", "embedding"]).select("vec_id", F.round(dot(F.col("embedding"), F.col("embedding")), 4).alias("self_dot"))


@query("SELECT l_orderkey AS o_orderkey, l_quantity AS qty, l_extendedprice AS price FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def scan_jagged_explode(spark, sf):
    both = scan(spark, sf, "items", ["o_orderkey", "qty", "price"]).select("o_orderkey", F.explode(F.arrays_zip("qty", "price")).alias("x"))
    return both.select("o_orderkey", "x.qty", "x.price")


@query("SELECT o_orderkey, count(l_orderkey)::INT AS n, round(coalesce(sum(l_quantity), 0), 2) AS total FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1")
def jagged_empty_rows(spark, sf):
    return scan(spark, sf, "items", ["o_orderkey", "qty"]).select("o_orderkey", F.size("qty").alias("n"), F.round(total(F.col("qty")), 2).alias("total"))


@query("SELECT o_orderkey, n_qty FROM (SELECT o_orderkey, count(l_orderkey)::INT AS n_qty FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1)")
def jagged_counter(spark, sf):
    return scan(spark, sf, "items", ["o_orderkey", "n_qty"])


@query("SELECT o_orderkey, max(l_extendedprice) AS top, count(*) FILTER (l_quantity > 25)::INT AS many FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1")
def jagged_functions(spark, sf):
    s = scan(spark, sf, "items", ["o_orderkey", "qty", "price"]).where(F.size("qty") > 0)
    return s.select("o_orderkey", F.array_max("price").alias("top"), F.size(F.filter("qty", lambda x: x > 25)).alias("many"))


@query("SELECT l_orderkey AS o_orderkey, l_extendedprice::FLOAT AS x FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def vector_float(spark, sf):
    return scan(spark, sf, "vectors", ["o_orderkey", "vf"]).select("o_orderkey", F.explode("vf").alias("x"))


@query("SELECT l_orderkey AS o_orderkey, l_quantity::BIGINT AS x FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def vector_uint(spark, sf):
    return scan(spark, sf, "vectors", ["o_orderkey", "vu"]).select("o_orderkey", F.explode("vu").alias("x"))


@query("SELECT o_orderkey, c_custkey AS custkey, c_acctbal AS acctbal FROM orders JOIN customer ON o_custkey = c_custkey")
def nested_struct(spark, sf):
    return scan(spark, sf, "nested", ["o_orderkey", "cust"]).select("o_orderkey", "cust.custkey", "cust.acctbal")


@query("SELECT o_orderkey, c_acctbal AS acctbal FROM orders JOIN customer ON o_custkey = c_custkey")
def nested_pruned(spark, sf):
    return scan(spark, sf, "nested", ["o_orderkey", "cust.acctbal"]).select("o_orderkey", "cust.acctbal")


@query("SELECT count(*) AS n FROM lineitem")
def count_only(spark, sf):
    return spark.range(1).select(F.lit(count_events(folder(spark, sf, "lineitem"))).cast("long").alias("n"))


@query("SELECT i AS first, least(i + 999, (SELECT count(*) FROM orders) - 1) AS last FROM generate_series(0, (SELECT count(*) FROM orders) - 1, 1000) g(i)")
def partition_plan(spark, sf):
    df = scan(spark, sf, "codec_raw", ["o_orderkey"], entriesPerPartition=1000, ranges="all").withColumn("p", F.spark_partition_id())
    n = df.groupBy("p").agg(F.count("*").alias("c")).withColumn("last", F.sum("c").over(Window.orderBy("p")) - 1)
    return n.select((F.col("last") - F.col("c") + 1).alias("first"), "last")


def flag_sum(df):
    return df.groupBy("l_flag").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty"))


FLAGS = "SELECT ascii(l_returnflag)::TINYINT AS l_flag, count(*) AS n, round(sum(l_quantity), 2) AS qty FROM lineitem GROUP BY 1"


@query(FLAGS)
def multi_file_union(spark, sf):
    return flag_sum(read_events(spark, by_flag(spark, sf), columns=["l_flag", "l_quantity"]))


@query(FLAGS)
def glob_union(spark, sf):
    return flag_sum(read_events(spark, by_flag(spark, sf) + "/flag={6[0-9],7*,8?,9?}/*.root", columns=["l_flag", "l_quantity"]))


@query("SELECT round(sum(l_extendedprice), 2) AS total, count(*) AS n FROM lineitem")
def subdir_tree(spark, sf):
    return scan(spark, sf, "subdir", ["l_extendedprice"]).agg(F.round(F.sum("l_extendedprice"), 2).alias("total"), F.count("*").alias("n"))


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity < 10")
def scan_inline_threads(spark, sf):
    return scan(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity"], threadCount=0, batchRows=777).where("l_quantity < 10").select("l_orderkey", "l_linenumber")


def _codec(name: str):
    def run(spark, sf):
        return scan(spark, sf, f"codec_{name}", ["o_orderkey", "o_totalprice", "o_order_us"]).agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"), F.round(F.sum("o_totalprice"), 2).alias("price"), F.sum(F.col("o_order_us").cast("decimal(20,0)")).cast("string").alias("us"))

    run.__name__ = f"codec_{name}"
    SPECS[run.__name__] = (run, "SELECT count(*) AS n, sum(o_orderkey)::BIGINT AS keys, round(sum(o_totalprice), 2) AS price, sum(epoch_us(o_orderdate))::VARCHAR AS us FROM orders")


for _name in ("raw", "zlib", "lzma", "lz4", "zstd"):
    _codec(_name)


@query("SELECT event_id, user_id, value FROM events")
def sink_round_trip(spark, sf):
    import os
    import shutil

    path = folder(spark, sf, "events") + "-again"
    if os.path.isdir(path):
        shutil.rmtree(path)
    scan(spark, sf, "events", ["event_id", "user_id", "value"]).repartition(3).write.format("root").mode("append").option("tree", "t/again").save(path)
    return read_events(spark, path, "t/again")


@query("SELECT user_id, count(*) AS n, round(sum(coalesce(value, 0)), 4) AS total FROM events GROUP BY 1")
def stream_new_files(spark, sf):
    from ..streaming import drain, stream_events

    rows = drain(stream_events(spark, folder(spark, sf, "events"), "user_id long, value double"))
    return rows.groupBy("user_id").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
