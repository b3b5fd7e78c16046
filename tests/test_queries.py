"""Every query that has SQL against DuckDB on the same tables, and what else the source promises within Spark."""

import glob
import math
import os

import duckdb
import pyarrow as pa
import pytest

import eventframe
from eventframe import plans
from eventframe.plans.fixtures import folder, scan


def cell(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    return str(v)


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", list(plans.SPECS))
def test_against_sql(spark, sf, duck, name):
    run, sql = plans.SPECS[name]
    df = run(spark, sf)
    columns = sorted(df.columns)
    got = sorted((tuple(map(cell, r)) for r in df.select(*columns).collect()), key=str)
    cur = duck.execute(sql)
    names = [d[0] for d in cur.description]
    assert sorted(names) == columns
    assert got == sorted((tuple(cell(r[names.index(c)]) for c in columns) for r in cur.fetchall()), key=str)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 1
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_partitions(spark, sf):
    assert scan(spark, sf, "codec_raw", ["o_orderkey"], entriesPerPartition=400).rdd.getNumPartitions() == 4
    assert scan(spark, sf, "codec_raw", ["o_orderkey"]).rdd.getNumPartitions() == 1


def test_partitions_of_several_files(spark, sf, tmp_path):
    """The plan counts entries through all files, however many the table was written as."""
    from pyspark.sql import functions as F

    from eventframe.sources.writer import Column, write_tree

    sizes = [5, 0, 1, 24, 10, 3]
    for k, n in enumerate(sizes):
        at = sum(sizes[:k])
        write_tree(str(tmp_path / f"{k}.root"), "Events", [{"a": pa.array(range(at + b, min(at + b + 7, at + n)), pa.int32())} for b in range(0, n, 7)], [Column("a", "int")])
    df = eventframe.read_events(spark, str(tmp_path), columns=["a"], entriesPerPartition=10, ranges="all")
    got = df.groupBy(F.spark_partition_id().alias("p")).agg(F.sort_array(F.collect_list("a")).alias("a")).orderBy("p").collect()
    assert [r.a for r in got] == [list(range(a, min(a + 10, 43))) for a in range(0, 43, 10)]


def test_partition_plan_of_a_table_in_several_files(spark, sf, tmp_path):
    import __spark_entry__

    spark.read.parquet(f"{sf}/orders.parquet").repartition(3).write.parquet(str(tmp_path / "orders.parquet"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        got = sorted(map(tuple, __spark_entry__.queries()["partition_plan"](spark, str(tmp_path)).collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW orders AS SELECT * FROM '{tmp_path}/orders.parquet/*.parquet'")
    assert got == sorted(con.execute(__spark_entry__.oracle_sql()["partition_plan"]).fetchall())


def test_pruned_plan_reads_only_what_is_asked(spark, sf):
    df = scan(spark, sf, "lineitem", ["l_tax"])
    assert df.columns == ["l_tax"]
    assert "l_orderkey" not in df._jdf.queryExecution().toString()


def test_planning_on_executors(spark, sf):
    from eventframe.plans.fixtures import by_flag

    path = by_flag(spark, sf)
    a, b = (eventframe.read_events(spark, path, columns=["l_orderkey", "l_flag"], planning=p, entriesPerPartition=700) for p in ("driver", "executor"))
    assert b.rdd.getNumPartitions() == 3 < a.rdd.getNumPartitions()
    assert sorted(a.collect()) == sorted(b.collect())


def test_slices_share_out_a_file(spark, sf, monkeypatch):
    from eventframe.plans.fixtures import by_flag
    from eventframe.sources import planning
    from eventframe.sources.options import Options
    from eventframe.sources.paths import resolve

    monkeypatch.setattr(planning, "SLICE_BYTES", 10_000)
    files = resolve([by_flag(spark, sf)])
    schema = eventframe.read_events(spark, files[0], columns=["l_orderkey"]).schema
    parts = planning.plan(files, Options.parse({"path": files[0], "tree": "Events", "planning": "executor"}), schema)
    for f in files:
        ranges = [r for p in parts if p.file == f for r in planning.slice_ranges(p, [("l_orderkey",)], 100)]
        assert len({p.stop for p in parts if p.file == f}) == 1 < len([p for p in parts if p.file == f])
        assert [r.start for r in ranges] == [0, *[r.stop for r in ranges[:-1]]] and ranges[-1].stop == planning.open_tree(f, "Events").entries
        assert all(r.stop - r.start <= 100 for r in ranges)


def test_sized_join_and_hot_as_of_keys(spark, monkeypatch):
    import random

    from eventframe import operators

    monkeypatch.setattr(operators, "BROADCAST_ROWS", 2)
    a, b = spark.range(10).withColumnRenamed("id", "x"), spark.range(5).withColumnRenamed("id", "y")
    on = a.x == b.y
    assert operators.sized_join(a, b, on).count() == 5 and operators.sized_join(a, b.where("y < 2"), on).count() == 2
    rng = random.Random(1)
    left = [(i, rng.choice([1, 1, 1, 2, None]), rng.choice([None, *range(-500, 500)])) for i in range(600)]
    right = [(rng.choice([1, 1, 3, None]), t, 1000 + t) for t in rng.sample(range(-500, 500), 90)]
    l, r = spark.createDataFrame(left, "i int, k int, t long"), spark.createDataFrame(right, "k int, t long, v int")
    want = {i: max(((u, v) for q, u, v in right if q is not None and q == k and t is not None and u <= t), default=(0, None))[1] for i, k, t in left}
    for width in (None, 7, 100, 5000):
        got = operators.as_of_join(l, r, "k", "t", "t", ["v"], width=width).collect()
        assert {x.i: x.v for x in got} == want and len(got) == 600


def test_nested_columns(spark, sf):
    df = eventframe.read_events(spark, folder(spark, sf, "nested"), columns=["cust.acctbal", "o_totalprice"])
    assert df.schema.simpleString() == "struct<cust:struct<acctbal:double>,o_totalprice:double>"
    assert df.count() == eventframe.count_events(folder(spark, sf, "nested"))


def test_empty_tree(spark, tmp_path):
    from eventframe.sources.writer import Column, write_tree

    write_tree(str(tmp_path / "e.root"), "Events", [], [Column("a", "int")])
    assert eventframe.read_events(spark, str(tmp_path)).collect() == []


def test_session_settings_are_options(spark, sf):
    spark.conf.set("spark.datasource.root.entriesPerPartition", "500")
    try:
        path = folder(spark, sf, "orders")
        assert eventframe.read_events(spark, path, columns=["o_orderkey"]).rdd.getNumPartitions() == 3
        assert eventframe.read_events(spark, path, columns=["o_orderkey"], entriesPerPartition=5000).rdd.getNumPartitions() == 1
    finally:
        spark.conf.unset("spark.datasource.root.entriesPerPartition")


def test_profile(spark, sf):
    import os

    from eventframe.sources.api import open_events, profile_frame

    base = folder(spark, sf, "orders")
    profile = []
    view = open_events(os.path.join(base, next(f for f in os.listdir(base) if f.endswith(".root"))), "Events", profile)
    view.array("o_orderkey", 0, 10)
    levels = {r.level: r.n for r in profile_frame(spark, profile).groupBy("level").agg({"length": "sum"}).withColumnRenamed("sum(length)", "n").collect()}
    assert levels["upper"] > 0 and levels["lower"] > 0
    assert profile_frame(spark, []).count() == 0


def test_errors(spark, tmp_path):
    with pytest.raises(Exception, match="FileNotFound"):
        eventframe.read_events(spark, str(tmp_path / "none")).collect()


def test_sink_rejects_nulls_and_strings(spark, tmp_path):
    eventframe.register(spark)
    for sql in ("SELECT CAST(NULL AS INT) AS a", "SELECT 'x' AS a"):
        with pytest.raises(Exception):
            spark.sql(sql).write.format("root").mode("append").save(str(tmp_path / "o"))
    assert not [f for f in os.listdir(tmp_path / "o") if f.endswith(".root")]


def test_stream_sees_new_files_once(spark, tmp_path):
    from eventframe.streaming import stream_events

    eventframe.register(spark)
    put = lambda lo, hi: spark.range(lo, hi, 1, 1).write.format("root").mode("append").save(str(tmp_path / "in"))
    put(0, 5)
    q = stream_events(spark, str(tmp_path / "in"), "id long").writeStream.format("memory").queryName("seen").option("checkpointLocation", str(tmp_path / "c")).start()
    try:
        q.processAllAvailable()
        put(5, 8)
        q.processAllAvailable()
        assert sorted(r.id for r in spark.table("seen").collect()) == list(range(8))
    finally:
        q.stop()


def test_functions(spark):
    from pyspark.sql import functions as F

    from eventframe import functions as E

    df = spark.sql("SELECT array(1D, 2D, 3D) AS x, array(true, false, true) AS m")
    r = df.select(E.where(F.col("x"), F.col("m")).alias("w"), E.pairs(F.col("x")).alias("p"), E.norm(F.col("x")).alias("n"), E.delta_phi(F.lit(3.0), F.lit(-3.0)).alias("d"), E.invariant_mass(*[F.lit(v) for v in (10.0, 0.0, 0.0, 10.0, 0.0, math.pi)]).alias("mass")).first()
    assert r.w == [1, 3] and [(s.a, s.b) for s in r.p] == [(1, 2), (1, 3), (2, 3)]
    assert r.n == pytest.approx(math.sqrt(14)) and r.d == pytest.approx(6 - 2 * math.pi) and r.mass == pytest.approx(20)


def test_stream_windows(spark, sf):
    """Tumbling and session windows over a stream of files, against the same over a scan."""
    from pyspark.sql import functions as F

    from eventframe.streaming import drain, sessions, stream_events, tumbling, with_time

    timed = lambda: with_time(stream_events(spark, folder(spark, sf, "events"), "ts_us long, user_id long, value double"), "ts_us")
    e = scan(spark, sf, "events", ["ts_us", "user_id", "value"]).withColumn("ts", F.timestamp_micros("ts_us"))
    want = {(r.window.start, r.n) for r in e.groupBy(F.window("ts", "1 day")).agg(F.count("*").alias("n")).collect()}
    assert {(r.window.start, r.n) for r in drain(tumbling(timed(), "1 day"), "complete").collect()} == want
    by_user = {(r.user_id, r.session_window.start, r.n) for r in e.groupBy("user_id", F.session_window("ts", "2 hours")).agg(F.count("*").alias("n")).collect()}
    assert {(r.user_id, r.session_window.start, r.n) for r in drain(sessions(timed(), "2 hours", "user_id"), "complete").collect()} == by_user


def test_drained_streams_are_files(spark, sf, tmp_path):
    """What a stream emits is written by the executors, batch by batch; one that emits nothing is an empty table."""
    from eventframe.streaming import drain, stream_events

    eventframe.register(spark)
    made = drain(stream_events(spark, folder(spark, sf, "events"), "event_id long, value double"))
    assert made.inputFiles() and made.count() == made.distinct().count() == scan(spark, sf, "events", ["event_id"]).count()
    (tmp_path / "none").mkdir()
    empty = drain(stream_events(spark, str(tmp_path / "none"), "event_id long, value double"))
    assert empty.count() == 0 and empty.columns == ["event_id", "value"]


def test_late_events_are_dropped(spark, tmp_path):
    """What the watermark has passed is emitted once, and what comes behind it no more."""
    from eventframe.streaming import stream_events, tumbling, with_time

    eventframe.register(spark)
    minute = 60_000_000

    def put(*minutes):
        rows = spark.createDataFrame([(m * minute, 1.0) for m in minutes], "ts_us long, value double").coalesce(1)
        rows.write.format("root").mode("append").save(str(tmp_path / "in"))

    put(0, 1, 7)
    made = tumbling(with_time(stream_events(spark, str(tmp_path / "in"), "ts_us long, value double"), "ts_us", "5 minutes"), "10 minutes")
    q = made.writeStream.format("memory").queryName("late").option("checkpointLocation", str(tmp_path / "c")).outputMode("append").start()
    try:
        q.processAllAvailable()
        put(60)
        q.processAllAvailable()
        put(3, 61)  # 3 is behind the watermark by now
        q.processAllAvailable()
        put(120)
        q.processAllAvailable()
        rows = {r.at // minute: r.n for r in spark.table("late").selectExpr("unix_micros(window.start) AS at", "n").collect()}
    finally:
        q.stop()
    assert rows[0] == 3 and rows.get(60, 2) == 2
