"""Queries for targets, sinks and layouts: written, then read back whole."""

from pyspark.sql import functions as F

from millrace.functions.schemas import schema_from_ddl
from millrace.operators.layout import writer
from millrace.operators.tables import union_by_position
from millrace.operators.transforms import fan_out
from millrace.queries.registry import land, landing, query, table
from millrace.queries.scans import EVENTS_DDL, ORDERS_DDL
from millrace.session import scratch_path
from millrace.sources.files import file_scan
from millrace.specs import Sink, Target
from millrace.streaming.targets import (
    append_stream,
    fan_out_stream,
    message_rows,
    overwrite_table,
    run_once,
    write_sink,
)


def _stream(spark, sf, name, ddl):
    return file_scan(spark, sf, {"cloudFiles.format": "parquet", "pathGlobFilter": f"{name}.parquet"}, ddl)


@query("append_table", "SELECT * FROM orders")
def append_table(spark, sf):
    return land(_stream(spark, sf, "orders", ORDERS_DDL), "append")


@query(
    "append_flows",
    """SELECT o_orderkey AS id, o_totalprice AS amount, CAST(NULL AS VARCHAR) AS kind FROM orders
       UNION ALL SELECT event_id, value, event_type FROM events""",
)
def append_flows(spark, sf):
    target = landing(spark, "append-flows", schema=schema_from_ddl("id bigint, amount double, kind string"))
    orders = _stream(spark, sf, "orders", ORDERS_DDL).selectExpr("o_orderkey AS id", "o_totalprice AS amount")
    events = _stream(spark, sf, "events", EVENTS_DDL).selectExpr("event_id AS id", "value AS amount", "event_type AS kind")
    append_stream(orders, target, scratch_path(spark, "flows-orders"), "orders")
    append_stream(events, target, scratch_path(spark, "flows-events"), "events")
    return target.table()


@query("append_flow_once", "SELECT * FROM events")
def append_flow_once(spark, sf):
    target = landing(spark, "append-once")
    progress = scratch_path(spark, "once-progress")
    for _ in range(2):
        run_once(
            spark,
            lambda: _stream(spark, sf, "events", EVENTS_DDL),
            lambda batch, i: target.write_batch(batch, i, "backfill"),
            progress,
        )
    return target.table()


@query("create_target", "SELECT event_id, value, CAST(NULL AS VARCHAR) AS note FROM events")
def create_target(spark, sf):
    schema = schema_from_ddl("event_id bigint, value double, note string")
    target = landing(spark, "created", schema=schema)
    target.create(schema)
    if target.table().count() != 0:
        raise AssertionError("a created target must be empty")
    target.write_batch(table(spark, sf, "events").select("event_id", "value"), 0)
    return target.table()


@query(
    "sink_table",
    """SELECT event_id, value, 'path' AS kind FROM events WHERE value > 5
       UNION ALL SELECT event_id, value, 'name' FROM events WHERE value > 5""",
)
def sink_table(spark, sf):
    path = scratch_path(spark, "sink-path")
    name = "sink_" + path[-12:]
    by_path = Sink("by_path", "delta", {"path": path}, ["event_id", "value"], "value > 5")
    place = {"tableName": name, "path": scratch_path(spark, "sink-name")}
    by_name = Sink("by_name", "delta", place, ["event_id", "value"], "value > 5")
    stream = _stream(spark, sf, "events", EVENTS_DDL)
    writes = [lambda batch, i, s=s: write_sink(batch, s, i) for s in (by_path, by_name)]
    fan_out_stream(stream, writes, scratch_path(spark, "sink-progress"))
    return union_by_position(
        [
            spark.read.parquet(path).select("event_id", "value", F.lit("path").alias("kind")),
            spark.table(name).select("event_id", "value", F.lit("name").alias("kind")),
        ]
    )


@query(
    "sink_table_batches",
    """SELECT event_id, CASE WHEN event_id % 3 = 2 THEN -value ELSE value END AS value FROM events""",
)
def sink_table_batches(spark, sf):
    """Three batches into a named sink, with columns in another order, and the last one replayed with what counts."""
    events = table(spark, sf, "events").select("event_id", "value")
    name = "sink_" + scratch_path(spark, "sink")[-12:]
    sink = Sink("batches", "delta", {"tableName": name, "path": scratch_path(spark, "sink-batches")})
    third = events.where("event_id % 3 = 2")
    for number, rows in enumerate([events.where("coalesce(event_id % 3 = 0, true)"), events.where("event_id % 3 = 1").select("value", "event_id"), third]):
        write_sink(rows, sink, number)
    write_sink(third.withColumn("value", -F.col("value")), sink, 2)
    return spark.table(name).select("event_id", "value")


@query(
    "sink_message",
    """SELECT '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type || '"}' AS value
       FROM events""",
)
def sink_message(spark, sf):
    sink = Sink("out", "kafka", {"topic": "out", "kafka.bootstrap.servers": "broker"}, ["event_id", "user_id", "event_type"])
    return message_rows(table(spark, sf, "events"), sink)


@query("sink_select_where", "SELECT event_id, upper(event_type) AS kind FROM events WHERE value > 30")
def sink_select_where(spark, sf):
    path = scratch_path(spark, "sink-select")
    sink = Sink("picked", "delta", {"path": path}, ["event_id", "upper(event_type) AS kind"], "value > 30")
    write_sink(table(spark, sf, "events"), sink, 0)
    return spark.read.parquet(path).select("event_id", "kind")


@query(
    "sink_fanout",
    """SELECT event_id, 'large' AS sink FROM events WHERE value > 30 UNION ALL SELECT event_id, 'errors' FROM events WHERE event_type = 'error'
       UNION ALL SELECT event_id, 'all' FROM events""",
)
def sink_fanout(spark, sf):
    clauses = {"large": "value > 30", "errors": "event_type = 'error'", "all": None}
    sinks = [
        Sink(name, "delta", {"path": scratch_path(spark, f"sink-{name}")}, ["event_id"], clause)
        for name, clause in clauses.items()
    ]
    writes = [lambda batch, i, s=s: write_sink(batch, s, i) for s in sinks]
    fan_out_stream(_stream(spark, sf, "events", EVENTS_DDL), writes, scratch_path(spark, "sink-fan"))
    return union_by_position(
        [spark.read.parquet(s.option("path")).select("event_id", F.lit(s.name).alias("sink")) for s in sinks]
    )


@query(
    "silver_fanout",
    """SELECT c_custkey, c_name, lower(c_mktsegment) AS branch FROM customer
       WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE')""",
)
def silver_fanout(spark, sf):
    segments = ("BUILDING", "MACHINERY", "AUTOMOBILE")
    branches = {
        s.lower(): (["c_custkey", "c_name", "lower(c_mktsegment) AS branch"], [f"c_mktsegment = '{s}'"])
        for s in segments
    }
    targets = {name: landing(spark, f"fan-{name}") for name in branches}
    ddl = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"

    def writes(name):
        return lambda batch, i: targets[name].write_batch(fan_out(batch, branches)[name], i)

    fan_out_stream(_stream(spark, sf, "customer", ddl), [writes(n) for n in branches], scratch_path(spark, "fan"))
    return union_by_position([t.table() for t in targets.values()])


def _laid_out(spark, sf, **layout):
    target = Target(scratch_path(spark, "layout"), **layout)
    writer(table(spark, sf, "lineitem"), target).save(target.path)
    return spark.read.schema(table(spark, sf, "lineitem").schema).parquet(target.path)


@query("layout_partition", "SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, l_linestatus FROM lineitem")
def layout_partition(spark, sf):
    return _laid_out(spark, sf, partition_by=["l_returnflag", "", "l_linestatus"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_linestatus"
    )


@query("layout_cluster", "SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM lineitem")
def layout_cluster(spark, sf):
    return _laid_out(spark, sf, cluster_by="['l_shipdate', 'l_partkey']").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"
    )


@query("layout_zorder", "SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM lineitem")
def layout_zorder(spark, sf):
    return _laid_out(spark, sf, zorder_by=["l_partkey", "l_shipdate"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"
    )


@query("overwrite_table", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def overwrite(spark, sf):
    target = Target(scratch_path(spark, "overwrite"))
    suppliers = table(spark, sf, "supplier")
    overwrite_table(suppliers.select("s_suppkey", "s_name"), target)
    overwrite_table(suppliers.select("s_suppkey", "s_name", "s_acctbal"), target)
    return spark.read.parquet(target.path)
