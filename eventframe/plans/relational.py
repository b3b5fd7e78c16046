"""Spark's relational algebra over scans of event files."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import operators
from ..functions import bin_of
from .fixtures import parquet, scan

SPECS: dict = {}


def query(sql: str | None):
    def add(f):
        SPECS[f.__name__] = (f, sql)
        return f

    return add


DAY = 86_400_000_000
O = ["o_orderkey", "o_custkey", "o_totalprice"]  # noqa: E741
C = ["c_custkey", "c_nationkey", "c_acctbal"]


@query(
    "SELECT round(sum(l_extendedprice * l_discount), 2) AS revenue, count(*) AS n FROM lineitem WHERE l_shipdate >= TIMESTAMP '1994-01-01' AND l_shipdate < TIMESTAMP '1996-01-01' AND l_discount BETWEEN 0.03 AND 0.08 AND l_quantity < 24"
)
def q6_filter_agg(spark, sf):
    s = scan(spark, sf, "lineitem", ["l_quantity", "l_extendedprice", "l_discount", "l_ship_us"])
    low, high = 757_382_400_000_000, 820_454_400_000_000  # 1994-01-01 and 1996-01-01
    kept = s.where((F.col("l_ship_us") >= low) & (F.col("l_ship_us") < high) & F.col("l_discount").between(0.03, 0.08) & (F.col("l_quantity") < 24))
    return kept.agg(F.round(F.sum(F.col("l_extendedprice") * F.col("l_discount")), 2).alias("revenue"), F.count("*").alias("n"))


@query(
    "SELECT ascii(l_returnflag)::TINYINT AS l_flag, ascii(l_linestatus)::TINYINT AS l_status, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_price, "
    "round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc, round(avg(l_quantity), 4) AS avg_qty, count(*) AS n FROM lineitem GROUP BY 1, 2"
)
def q1_groupby(spark, sf):
    s = scan(spark, sf, "lineitem", ["l_flag", "l_status", "l_quantity", "l_extendedprice", "l_discount"])
    price = F.col("l_extendedprice")
    return s.groupBy("l_flag", "l_status").agg(
        F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(price), 2).alias("sum_price"), F.round(F.sum(price * (1 - F.col("l_discount"))), 2).alias("sum_disc"), F.round(F.avg("l_quantity"), 4).alias("avg_qty"), F.count("*").alias("n")
    )


def _cells(df):
    return df.agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty"), F.grouping_id().cast("int").alias("gid"))


_SETS = "SELECT ascii(l_returnflag)::TINYINT AS l_flag, l_linenumber, count(*) AS n, round(sum(l_quantity), 2) AS qty, grouping_id(ascii(l_returnflag)::TINYINT, l_linenumber)::INT AS gid FROM lineitem GROUP BY {}"


@query(_SETS.format("ROLLUP (ascii(l_returnflag)::TINYINT, l_linenumber)"))
def rollup(spark, sf):
    return _cells(scan(spark, sf, "lineitem", ["l_flag", "l_linenumber", "l_quantity"]).rollup("l_flag", "l_linenumber"))


@query(_SETS.format("CUBE (ascii(l_returnflag)::TINYINT, l_linenumber)"))
def cube(spark, sf):
    return _cells(scan(spark, sf, "lineitem", ["l_flag", "l_linenumber", "l_quantity"]).cube("l_flag", "l_linenumber"))


@query(_SETS.format("GROUPING SETS ((ascii(l_returnflag)::TINYINT), (l_linenumber))"))
def grouping_sets(spark, sf):
    s = scan(spark, sf, "lineitem", ["l_flag", "l_linenumber", "l_quantity"])
    return _cells(s.groupingSets([["l_flag"], ["l_linenumber"]], "l_flag", "l_linenumber"))


@query("SELECT o_orderkey, o_totalprice, c_acctbal FROM orders JOIN customer ON o_custkey = c_custkey")
def join_inner(spark, sf):
    o, c = scan(spark, sf, "orders", O), scan(spark, sf, "customer", C)
    return o.join(c.hint("merge"), o.o_custkey == c.c_custkey).select("o_orderkey", "o_totalprice", "c_acctbal")


@query("SELECT o_orderkey, c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal > 0")
def join_hash(spark, sf):
    o, c = scan(spark, sf, "orders", O), scan(spark, sf, "customer", C).where("c_acctbal > 0")
    return o.join(c.hint("shuffle_hash"), o.o_custkey == c.c_custkey).select("o_orderkey", "c_nationkey")


@query("SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def join_broadcast(spark, sf):
    n, c = parquet(spark, sf, "nation").select("n_nationkey", "n_name"), scan(spark, sf, "customer", ["c_custkey", "c_nationkey"])
    return operators.sized_join(c, n, c.c_nationkey == n.n_nationkey).select("c_custkey", "n_name")


@query("SELECT c_custkey, count(o_orderkey) AS n, round(coalesce(sum(o_totalprice), 0), 2) AS spent FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1")
def join_left_agg(spark, sf):
    o, c = scan(spark, sf, "orders", O), scan(spark, sf, "customer", ["c_custkey"])
    per = o.groupBy("o_custkey").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("s"))  # combined before the join
    return c.join(per, c.c_custkey == per.o_custkey, "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("n"), F.round(F.coalesce("s", F.lit(0.0)), 2).alias("spent"))


@query("SELECT o_orderkey, p.p_partkey FROM orders FULL JOIN (SELECT p_partkey FROM part) p ON o_orderkey = p.p_partkey")
def join_full(spark, sf):
    p = parquet(spark, sf, "part").select("p_partkey")
    o = scan(spark, sf, "orders", ["o_orderkey"])
    return o.join(p, o.o_orderkey == p.p_partkey, "full").select("o_orderkey", "p_partkey")


@query("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 100000)")
def join_semi(spark, sf):
    o, c = scan(spark, sf, "orders", O).where("o_totalprice > 100000"), scan(spark, sf, "customer", ["c_custkey"])
    return c.join(o, c.c_custkey == o.o_custkey, "left_semi")


@query("SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def join_anti(spark, sf):
    o, line = scan(spark, sf, "orders", ["o_orderkey"]), scan(spark, sf, "lineitem", ["l_orderkey"])
    return o.join(line, o.o_orderkey == line.l_orderkey, "left_anti")


_BANDS = "(VALUES (0, 0.0, 15000.0), (1, 10000.0, 90000.0), (2, 90000.0, 200000.0)) b(band, low, high)"


@query(f"SELECT o_orderkey, band FROM orders JOIN {_BANDS} ON o_totalprice >= low AND o_totalprice < high")
def range_join(spark, sf):
    bands = spark.createDataFrame([(0, 0.0, 15000.0), (1, 10000.0, 90000.0), (2, 90000.0, 200000.0)], "band int, low double, high double")
    return operators.range_join(scan(spark, sf, "orders", ["o_orderkey", "o_totalprice"]), bands, "o_totalprice", "low", "high", 20_000.0).select("o_orderkey", "band")


@query(f"SELECT band, count(*) AS n FROM orders JOIN {_BANDS} ON o_totalprice < low GROUP BY 1")
def theta_join(spark, sf):
    bands = spark.createDataFrame([(0, 0.0), (1, 10000.0), (2, 90000.0)], "band int, low double")
    o = scan(spark, sf, "orders", ["o_totalprice"])
    return o.join(F.broadcast(bands), o.o_totalprice < bands.low).groupBy("band").agg(F.count("*").alias("n"))  # three literal rows


_FIRST = "(SELECT user_id, epoch_us(ts) AS t, min(event_id) AS ref FROM events WHERE event_type = 'purchase' GROUP BY 1, 2)"


@query(f"SELECT e.event_id, r.ref FROM (SELECT event_id, user_id, epoch_us(ts) AS t FROM events) e ASOF LEFT JOIN {_FIRST} r ON e.user_id = r.user_id AND e.t >= r.t")
def asof_join(spark, sf):
    e = scan(spark, sf, "events", ["event_id", "ts_us", "user_id", "type_code"])
    names = parquet(spark, sf, "events").where("event_type = 'purchase'").select("event_id")
    bought = e.join(names, "event_id").groupBy("user_id", "ts_us").agg(F.min("event_id").alias("ref"))
    return operators.as_of_join(e.select("event_id", "user_id", "ts_us"), bought, "user_id", "ts_us", "ts_us", ["ref"], width=DAY).select("event_id", "ref")


_W = "OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey)"


@query(f"SELECT o_orderkey, row_number() {_W} AS rn, rank() {_W} AS rk, dense_rank() {_W} AS dr, ntile(3) {_W} AS nt FROM orders")
def window_rank(spark, sf):
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return scan(spark, sf, "orders", O).select("o_orderkey", *[f.over(w).cast("long").alias(n) for n, f in (("rn", F.row_number()), ("rk", F.rank()), ("dr", F.dense_rank()), ("nt", F.ntile(3)))])


_V = "OVER (PARTITION BY user_id ORDER BY ts, event_id)"


@query(f"SELECT event_id, lag(event_id) {_V} AS before, lead(event_id, 2) {_V} AS after, first_value(event_id) {_V} AS first FROM events")
def window_analytic(spark, sf):
    w = Window.partitionBy("user_id").orderBy("ts_us", "event_id")
    return scan(spark, sf, "events", ["event_id", "user_id", "ts_us"]).select("event_id", F.lag("event_id").over(w).alias("before"), F.lead("event_id", 2).over(w).alias("after"), F.first("event_id").over(w).alias("first"))


@query(f"SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING) AS n_rows, count(*) OVER (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN {DAY} PRECEDING AND CURRENT ROW) AS n_day FROM events")
def window_frame(spark, sf):
    by = Window.partitionBy("user_id")
    rows, days = by.orderBy("ts_us", "event_id").rowsBetween(-2, 1), by.orderBy("ts_us").rangeBetween(-DAY, 0)
    return scan(spark, sf, "events", ["event_id", "user_id", "ts_us"]).select("event_id", F.count("*").over(rows).alias("n_rows"), F.count("*").over(days).alias("n_day"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def topk(spark, sf):
    return scan(spark, sf, "orders", ["o_orderkey", "o_totalprice"]).orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


@query("SELECT o_custkey, o_orderkey, rank FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey)::INT AS rank FROM orders) WHERE rank <= 2")
def topk_per_group(spark, sf):
    return operators.top_per_group(scan(spark, sf, "orders", O), "o_custkey", [F.desc("o_totalprice"), "o_orderkey"], 2).select("o_custkey", "o_orderkey", "rank")


@query("SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def distinct(spark, sf):
    return scan(spark, sf, "lineitem", ["l_partkey", "l_suppkey"]).distinct()


@query("SELECT ascii(l_returnflag)::TINYINT AS l_flag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY 1")
def distinct_agg(spark, sf):
    return scan(spark, sf, "lineitem", ["l_flag", "l_partkey", "l_suppkey"]).groupBy("l_flag").agg(F.count_distinct("l_partkey").alias("parts"), F.count_distinct("l_suppkey").alias("suppliers"))


@query("SELECT count(DISTINCT l_orderkey) AS orders, round(quantile_cont(l_extendedprice, 0.49), 2) AS low, round(quantile_cont(l_extendedprice, 0.51), 2) AS high, true AS close_count, true AS close_median FROM lineitem")
def approximate_agg(spark, sf):
    """The exact values, and whether the sketches lie within five times their stated error of them."""
    a = scan(spark, sf, "lineitem", ["l_orderkey", "l_extendedprice"]).agg(
        F.approx_count_distinct("l_orderkey", 0.02).alias("d"), F.count_distinct("l_orderkey").alias("e"), F.percentile_approx("l_extendedprice", 0.5, 1000).alias("m"), F.expr("percentile(l_extendedprice, 0.49)").alias("lo"), F.expr("percentile(l_extendedprice, 0.51)").alias("hi")
    )
    return a.select(F.col("e").alias("orders"), F.round("lo", 2).alias("low"), F.round("hi", 2).alias("high"), (F.abs(F.col("d") - F.col("e")) <= 0.1 * F.col("e")).alias("close_count"), F.col("m").between(F.col("lo"), F.col("hi")).alias("close_median"))


@query("SELECT o_custkey AS k FROM orders UNION ALL SELECT c_custkey FROM customer")
def union(spark, sf):
    return scan(spark, sf, "orders", ["o_custkey"]).select(F.col("o_custkey").alias("k")).unionByName(scan(spark, sf, "customer", ["c_custkey"]).select(F.col("c_custkey").alias("k")))


@query("SELECT o_custkey AS k FROM orders INTERSECT SELECT c_custkey FROM customer")
def intersect(spark, sf):
    return scan(spark, sf, "orders", ["o_custkey"]).select(F.col("o_custkey").alias("k")).intersect(scan(spark, sf, "customer", ["c_custkey"]).select(F.col("c_custkey").alias("k")))


@query("SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 150000")
def except_(spark, sf):
    rich = scan(spark, sf, "orders", O).where("o_totalprice > 150000")
    return scan(spark, sf, "customer", ["c_custkey"]).select(F.col("c_custkey").alias("k")).subtract(rich.select(F.col("o_custkey").alias("k")))


@query("SELECT l_partkey AS k FROM lineitem INTERSECT ALL SELECT o_custkey FROM orders")
def intersect_all(spark, sf):
    return scan(spark, sf, "lineitem", ["l_partkey"]).select(F.col("l_partkey").alias("k")).intersectAll(scan(spark, sf, "orders", ["o_custkey"]).select(F.col("o_custkey").alias("k")))


@query("SELECT o_orderkey, p_partkey FROM orders RIGHT JOIN part ON o_orderkey = p_partkey")
def join_right(spark, sf):
    o, p = scan(spark, sf, "orders", ["o_orderkey"]), parquet(spark, sf, "part").select("p_partkey")
    return o.join(p, o.o_orderkey == p.p_partkey, "right").select("o_orderkey", "p_partkey")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey")
def sort(spark, sf):
    return scan(spark, sf, "orders", ["o_orderkey", "o_totalprice"]).orderBy(F.desc("o_totalprice"), "o_orderkey")


@query("SELECT l_orderkey, count(*)::INT AS lines, max(CASE WHEN l_linenumber = 1 THEN l_quantity END) AS first, count(*) FILTER (l_quantity > 25)::INT AS large FROM (SELECT l_orderkey, l_linenumber, max(l_quantity) AS l_quantity FROM lineitem GROUP BY 1, 2) GROUP BY 1")
def map_functions(spark, sf):
    line = scan(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity"]).groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("l_quantity"))
    m = line.groupBy("l_orderkey").agg(F.map_from_entries(F.collect_list(F.struct(F.col("l_linenumber").cast("int"), "l_quantity"))).alias("m"))
    return m.select("l_orderkey", F.size(F.map_keys("m")).alias("lines"), F.try_element_at("m", F.lit(1)).alias("first"), F.size(F.map_filter("m", lambda k, v: v > 25)).alias("large"))


@query("SELECT epoch_us(time_bucket(INTERVAL 6 HOUR, ts)) AS at, count(*) AS n, round(sum(coalesce(value, 0)), 4) AS total FROM events GROUP BY 1")
def stream_watermark(spark, sf):
    """Windows of a stream with a watermark; what it holds back for late events comes with the last batch's state."""
    from ..streaming import drain, stream_events, tumbling, with_time
    from .fixtures import folder

    made = drain(tumbling(with_time(stream_events(spark, folder(spark, sf, "events"), "ts_us long, value double"), "ts_us"), "6 hours"), "update")
    last = made.groupBy("window").agg(F.max_by(F.struct("n", "total"), "n").alias("s"))
    return last.select(F.unix_micros("window.start").alias("at"), "s.n", F.round("s.total", 4).alias("total"))


@query("SELECT l_partkey AS k FROM lineitem EXCEPT ALL SELECT p_partkey FROM part")
def except_all(spark, sf):
    return scan(spark, sf, "lineitem", ["l_partkey"]).select(F.col("l_partkey").alias("k")).exceptAll(parquet(spark, sf, "part").select(F.col("p_partkey").alias("k")))


@query("SELECT greatest(-1, least(20, floor(l_extendedprice / 5000.0)))::INT AS bin, count(*) AS n FROM lineitem GROUP BY 1")
def histogram(spark, sf):
    return operators.histogram(scan(spark, sf, "lineitem", ["l_extendedprice"]), bin_of(F.col("l_extendedprice"), 0.0, 5000.0, 20))


@query("SELECT o_orderkey, round(sqrt(o_totalprice), 4) AS root, round(ln(o_totalprice + 1), 4) AS log, round(atan2(o_totalprice, 1000.0), 6) AS angle, (o_orderkey % 7)::BIGINT AS m FROM orders")
def math_functions(spark, sf):
    p = F.col("o_totalprice")
    return scan(spark, sf, "orders", ["o_orderkey", "o_totalprice"]).select("o_orderkey", F.round(F.sqrt(p), 4).alias("root"), F.round(F.log(p + 1), 4).alias("log"), F.round(F.atan2(p, F.lit(1000.0)), 6).alias("angle"), (F.col("o_orderkey") % 7).alias("m"))


@query("SELECT year(o_orderdate)::INT AS y, month(o_orderdate)::INT AS m, count(*) AS n FROM orders GROUP BY 1, 2")
def date_functions(spark, sf):
    day = F.date_from_unix_date(F.floor(F.col("o_order_us") / DAY).cast("int"))
    return scan(spark, sf, "orders", ["o_order_us"]).groupBy(F.year(day).alias("y"), F.month(day).alias("m")).agg(F.count("*").alias("n"))


@query("SELECT upper(p_brand) AS brand, length(p_name)::INT AS len, count(*) AS n FROM part JOIN lineitem ON p_partkey = l_partkey GROUP BY 1, 2")
def string_functions(spark, sf):
    p = parquet(spark, sf, "part")
    per = scan(spark, sf, "lineitem", ["l_partkey"]).groupBy("l_partkey").agg(F.count("*").alias("c"))
    return per.join(p, per.l_partkey == p.p_partkey).groupBy(F.upper("p_brand").alias("brand"), F.length("p_name").alias("len")).agg(F.sum("c").alias("n"))


@query("SELECT event_id, len(json_keys(props))::INT AS n FROM events WHERE props IS NOT NULL")
def json_functions(spark, sf):
    e, p = scan(spark, sf, "events", ["event_id"]), parquet(spark, sf, "events").where("props is not null").select("event_id", "props")
    return e.join(p, "event_id").select("event_id", F.size(F.json_object_keys("props")).alias("n"))


@query("SELECT epoch_us(time_bucket(INTERVAL 6 HOUR, ts)) AS at, count(*) AS n, round(sum(coalesce(value, 0)), 4) AS total FROM events GROUP BY 1")
def event_tumbling_window(spark, sf):
    e = scan(spark, sf, "events", ["ts_us", "value"]).withColumn("ts", F.timestamp_micros("ts_us"))
    return e.groupBy(F.window("ts", "6 hours")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")).select(F.unix_micros("window.start").alias("at"), "n", "total")


@query("SELECT epoch_us(s) AS at, count(*) AS n FROM (SELECT unnest([time_bucket(INTERVAL 6 HOUR, ts), time_bucket(INTERVAL 6 HOUR, ts) - INTERVAL 6 HOUR]) AS s FROM events) GROUP BY 1")
def event_sliding_window(spark, sf):
    e = scan(spark, sf, "events", ["ts_us"]).withColumn("ts", F.timestamp_micros("ts_us"))
    return e.groupBy(F.window("ts", "12 hours", "6 hours")).agg(F.count("*").alias("n")).select(F.unix_micros("window.start").alias("at"), "n")


@query(
    "WITH g AS (SELECT user_id, epoch_us(ts) AS t, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) < 7200000000 THEN 0 ELSE 1 END AS fresh FROM events), "
    "s AS (SELECT user_id, t, sum(fresh) OVER (PARTITION BY user_id ORDER BY t RANGE UNBOUNDED PRECEDING) AS k FROM g) SELECT user_id, min(t) AS at, count(*) AS n FROM s GROUP BY user_id, k"
)
def event_session_window(spark, sf):
    e = scan(spark, sf, "events", ["user_id", "ts_us"]).withColumn("ts", F.timestamp_micros("ts_us"))
    return e.groupBy("user_id", F.session_window("ts", "2 hours")).agg(F.count("*").alias("n")).select("user_id", F.unix_micros("session_window.start").alias("at"), "n")


@query("SELECT user_id, count(*) AS n, round(sum(coalesce(value, 0)), 4) AS total FROM events GROUP BY 1")
def stream_stateful_totals(spark, sf):
    from ..streaming import drain, running_totals, stream_events
    from .fixtures import folder

    made = drain(running_totals(stream_events(spark, folder(spark, sf, "events"), "user_id long, value double"), "user_id", "value"), "update")
    last = made.groupBy("user_id").agg(F.max_by(F.struct("n", "total"), "n").alias("s"))
    return last.select("user_id", "s.n", F.round("s.total", 4).alias("total"))


@query("SELECT ascii(l_returnflag)::TINYINT AS l_flag, round(sum(l_extendedprice), 2) AS total FROM lineitem GROUP BY 1")
def salted_aggregation(spark, sf):
    s = scan(spark, sf, "lineitem", ["l_flag", "l_orderkey", "l_extendedprice"])
    return operators.salted_sum(s, "l_flag", F.col("l_extendedprice")).select("l_flag", F.round("total", 2).alias("total"))
