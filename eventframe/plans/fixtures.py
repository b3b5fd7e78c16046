"""The driver's tables as event files, written once by the library's own sink.

Strings lie outside the data model: flags are written as code points, time stamps as microseconds.
"""

from __future__ import annotations

import hashlib
import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.api import read_events, register
from ..sources.paths import local_path

#: Microseconds of a time stamp without zone, whatever the session's time zone.
us = lambda c: F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01', CAST({c} AS TIMESTAMP_NTZ))")
code = lambda c: F.ascii(F.col(c)).cast("tinyint")


def parquet(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lineitem(spark, sf):
    keep = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return parquet(spark, sf, "lineitem").select(*keep, us("l_shipdate").alias("l_ship_us"), code("l_returnflag").alias("l_flag"), code("l_linestatus").alias("l_status"), (F.col("l_discount") > 0.05).alias("l_deal"))


def orders(spark, sf):
    return parquet(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", us("o_orderdate").alias("o_order_us"), code("o_orderstatus").alias("o_status"))


def customer(spark, sf):
    return parquet(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal")


def events(spark, sf):
    return parquet(spark, sf, "events").select("event_id", us("ts").alias("ts_us"), "user_id", F.coalesce("value", F.lit(0.0)).alias("value"), code("event_type").alias("type_code"))


def items(spark, sf):
    line = parquet(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("l_extendedprice", "l_quantity", "l_discount"))).alias("s"))
    o = parquet(spark, sf, "orders").join(line, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    part = lambda c, t: F.coalesce(F.transform("s", lambda x: x[c].cast(t)), F.array().cast(f"array<{t}>"))
    return o.select("o_orderkey", part("l_quantity", "double").alias("qty"), part("l_extendedprice", "double").alias("price"), part("l_discount", "double").alias("disc"))


def vectors(spark, sf):
    return items(spark, sf).select("o_orderkey", F.transform("price", lambda x: x.cast("float")).alias("vf"), F.transform("qty", lambda x: x.cast("long")).alias("vu"))


def unsigned(spark, sf):
    return parquet(spark, sf, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("int").alias("u8"), F.col("l_quantity").cast("int").alias("u16"), F.col("l_partkey").alias("u32"), (F.col("l_suppkey") - 50).alias("u64"))


def embeddings(spark, sf):
    return parquet(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<float>").alias("embedding"), F.coalesce("label", F.lit(-1)).alias("label"))


def nested(spark, sf):
    c = parquet(spark, sf, "customer")
    return parquet(spark, sf, "orders").join(c, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", F.struct(F.col("c_custkey").alias("custkey"), F.col("c_acctbal").alias("acctbal")).alias("cust"), "o_totalprice")


#: name -> (rows, options of the sink)
FIXTURES = {
    "lineitem": (lineitem, {}),
    "orders": (orders, {}),
    "customer": (customer, {}),
    "events": (events, {}),
    "items": (items, {}),
    "vectors": (vectors, {"types": "vf=vector float, vu=vector uint"}),
    "unsigned": (unsigned, {"types": "u8=uchar, u16=ushort, u32=uint, u64=ulong"}),
    "embeddings": (embeddings, {"types": "embedding=float[64]"}),
    "nested": (nested, {}),
    "subdir": (lineitem, {"tree": "a/b/lineitem"}),
    **{f"codec_{c}": (orders, {"codec": c}) for c in ("raw", "zlib", "lzma", "lz4", "zstd")},
}


def workspace(spark: SparkSession) -> str:
    """The shared folder of the cluster where it is a local or mounted one; a temporary folder in local mode only."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    own = local_path(shared) if shared else None
    if own is None and spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("event files need a mounted folder that all executors share; name one in spark.checkpoint.dir")
    return own or tempfile.gettempdir()


def folder(spark: SparkSession, sf_dir: str, name: str) -> str:
    """The folder of a fixture; written if it isn't there."""
    stamps = [(f, os.stat(os.path.join(sf_dir, f)).st_mtime_ns) for f in sorted(os.listdir(sf_dir))] if os.path.isdir(sf_dir) else []
    key = hashlib.sha256(repr((os.path.abspath(sf_dir), stamps, "v2")).encode()).hexdigest()[:16]
    path = os.path.join(workspace(spark), f"eventframe-fixtures-{os.getuid()}", key, name)
    if not os.path.exists(os.path.join(path, "_DONE")):
        register(spark)
        rows, options = FIXTURES[name]
        df = rows(spark, sf_dir)
        df.write.format("root").options(**({"tree": "Events"} | options)).mode("overwrite").save(path)
        open(os.path.join(path, "_DONE"), "w").close()
    return path


def by_flag(spark: SparkSession, sf_dir: str) -> str:
    """lineitem as one folder of files per flag."""
    base = folder(spark, sf_dir, "lineitem")
    path = base + "-by-flag"
    if not os.path.exists(os.path.join(path, "_DONE")):
        rows = lineitem(spark, sf_dir)
        for (flag,) in rows.select("l_flag").distinct().collect():
            rows.where(F.col("l_flag") == flag).write.format("root").mode("overwrite").save(os.path.join(path, f"flag={flag}"))
        open(os.path.join(path, "_DONE"), "w").close()
    return path


def scan(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None, **options) -> DataFrame:
    tree = FIXTURES[name][1].get("tree", "Events")
    return read_events(spark, folder(spark, sf_dir, name), tree=tree, columns=columns, **options)
