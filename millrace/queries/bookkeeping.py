"""Queries for keyed table operators."""

from pyspark.sql import functions as F

from millrace.operators import tables as ops
from millrace.queries.registry import query, table
from millrace.session import scratch_path


@query(
    "latest_per_key",
    """SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
         SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
         FROM orders) WHERE rn = 1""",
)
def latest_per_key(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return ops.latest_per_key(orders, ["o_custkey"], "o_orderdate")


@query(
    "select_group",
    """SELECT event_id, event_type, user_id, 'group' AS chosen_by FROM events WHERE event_type = 'click'
       UNION ALL SELECT event_id, event_type, user_id, 'ids' FROM events WHERE user_id IN (1, 2, 3)""",
)
def select_group(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", "user_id")
    # a group wins over ids
    by_group = ops.select_group(events, "event_type", "user_id", group="click", ids=[1, 2, 3])
    by_ids = ops.select_group(events, "event_type", "user_id", ids=[1, 2, 3])
    return by_group.withColumn("chosen_by", F.lit("group")).unionAll(by_ids.withColumn("chosen_by", F.lit("ids")))


@query("duplicate_keys", "SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_keys(spark, sf):
    return ops.duplicate_keys(table(spark, sf, "events"), ["user_id", "event_type"])


@query(
    "join_map_key",
    """SELECT c_custkey, c_name, n_name FROM customer
       JOIN (SELECT * FROM nation WHERE n_regionkey <> 0) n ON c_nationkey = n_nationkey""",
)
def join_map_key(spark, sf):
    # nations of region 0 have no such entry: their customers drop out
    customers = table(spark, sf, "customer").withColumn("nation_key", F.col("c_nationkey").cast("string"))
    entry = F.create_map(F.lit("table"), F.col("n_nationkey").cast("string"))
    details = F.when(F.col("n_regionkey") != 0, entry).otherwise(F.create_map(F.lit("path"), F.col("n_name")))
    nations = table(spark, sf, "nation").select("n_name", details.alias("details"))
    return ops.join_map_key(customers, "nation_key", nations, "details", "table").select("c_custkey", "c_name", "n_name")


@query("distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_quantity FROM lineitem")
def distinct_rows(spark, sf):
    return ops.distinct_rows(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus", "l_quantity"])


@query("union_files", "SELECT event_id, event_type, value FROM events")
def union_files(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    kinds = ("coalesce(value < 10, false)", "NOT coalesce(value < 10, false)")
    paths = [scratch_path(spark, f"union-{i}") for i in range(len(kinds))]
    for path, kind in zip(paths, kinds):
        events.where(kind).write.json(path)
    return ops.union_by_position([spark.read.schema(events.schema).json(path) for path in paths])


@query("required_columns", "SELECT event_id, event_type, props FROM events")
def required_columns(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", "props")
    return ops.require_columns(events, ["event_id", "event_type", "props"])


@query(
    "count_check",
    """SELECT 'customer' AS table_name, '>=' AS rule, CAST(1 AS BIGINT) AS expected, count(*) AS actual, count(*) >= 1 AS passed FROM customer
       UNION ALL SELECT 'region', '=', 5, count(*), count(*) = 5 FROM region
       UNION ALL SELECT 'orders', '=', 7, count(*), count(*) = 7 FROM orders""",
)
def count_check(spark, sf):
    expected = {"customer": (">=", 1), "region": ("=", 5), "orders": ("=", 7)}
    return ops.count_check({name: table(spark, sf, name) for name in expected}, expected)


@query(
    "upsert_merge",
    """SELECT coalesce(t.c_custkey, s.c_custkey) AS c_custkey,
              CASE WHEN s.c_custkey IS NULL THEN t.c_name ELSE s.c_name END AS c_name,
              CASE WHEN s.c_custkey IS NULL THEN t.c_acctbal ELSE s.c_acctbal END AS c_acctbal,
              CASE WHEN t.c_custkey IS NULL THEN s.created_by ELSE t.created_by END AS created_by
       FROM (SELECT c_custkey, c_name, c_acctbal, 'first' AS created_by FROM customer WHERE c_mktsegment <> 'MACHINERY') t
       FULL JOIN (SELECT c_custkey, c_name || ' new' AS c_name, c_acctbal + 1 AS c_acctbal, 'second' AS created_by
                  FROM customer WHERE c_acctbal > 5000) s ON t.c_custkey = s.c_custkey""",
)
def upsert_merge(spark, sf):
    customers = table(spark, sf, "customer")
    target = customers.where("c_mktsegment <> 'MACHINERY'").selectExpr(
        "c_custkey", "c_name", "c_acctbal", "'first' AS created_by"
    )
    source = customers.where("c_acctbal > 5000").selectExpr(
        "c_custkey", "c_name || ' new' AS c_name", "c_acctbal + 1 AS c_acctbal", "'second' AS created_by", "1 AS extra"
    )
    return ops.upsert(target, source, ["c_custkey"], protected=["created_by"])
