"""Queries for projection, filter and reshaping."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import transforms as ops
from millrace.operators.tables import union_by_name
from millrace.queries.registry import query, table


@query(
    "select_exprs",
    """SELECT event_id, user_id, upper(event_type) AS kind, value * 2 AS twice,
              CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""",
)
def select_exprs(spark, sf):
    return ops.select_exprs(
        table(spark, sf, "events"),
        ["event_id", "user_id", "upper(event_type) AS kind", "value * 2 AS twice",
         "CAST(get_json_object(props, '$.k') AS INT) AS k"],
    )


@query(
    "where_list",
    "SELECT event_id, event_type, value FROM events WHERE value > 20 AND event_type IN ('click', 'view')",
)
def where_list(spark, sf):
    df = table(spark, sf, "events").select("event_id", "event_type", "value")
    return ops.where_all(df, ["value > 20", " ", "event_type IN ('click', 'view')"])


@query("where_unprojected", "SELECT event_id, user_id FROM events WHERE value > 50 AND event_type <> 'error'")
def where_unprojected(spark, sf):
    shaped = ops.select_exprs(table(spark, sf, "events"), ["event_id", "user_id"])
    return ops.where_all(shaped, ["value > 50", "event_type <> 'error'"])


@query(
    "custom_transform",
    """SELECT o_orderkey, o_totalprice, CASE WHEN o_totalprice >= 100000 THEN 'large' ELSE 'small' END AS size_class,
              'orders' AS spec_name FROM orders""",
)
def custom_transform(spark, sf):
    def classify(df, spec):
        size = F.when(F.col("o_totalprice") >= spec["limit"], "large").otherwise("small")
        return df.select("o_orderkey", "o_totalprice", size.alias("size_class"), F.lit(spec["name"]).alias("spec_name"))

    return ops.apply_transform(table(spark, sf, "orders"), classify, {"limit": 100000, "name": "orders"})


@query(
    "derived_columns",
    """SELECT c_custkey AS id, concat(c_name, '/', c_mktsegment) AS label,
              concat_ws('-', c_mktsegment, CAST(c_nationkey AS VARCHAR)) AS segment_nation,
              md5(c_name) AS name_hash FROM customer""",
)
def derived_columns(spark, sf):
    return ops.select_exprs(
        table(spark, sf, "customer"),
        ["c_custkey AS id", "concat(c_name, '/', c_mktsegment) AS label",
         "concat_ws('-', c_mktsegment, c_nationkey) AS segment_nation", "md5(c_name) AS name_hash"],
    )


@query("except_columns", "SELECT * EXCLUDE (props, value) FROM events")
def except_columns(spark, sf):
    return ops.drop_columns(table(spark, sf, "events"), ["props", "value"])


@query("keep_columns", "SELECT event_id, ts FROM events")
def keep_columns(spark, sf):
    return ops.keep_columns(table(spark, sf, "events"), ["event_id", "ts"])


@query(
    "audit_columns",
    """SELECT o_orderkey, 'v1' AS version, 'loader' AS "createdBy", 'loader' AS "updatedBy",
              true AS stamped FROM orders""",
)
def audit_columns(spark, sf):
    df = ops.audit_columns(table(spark, sf, "orders").select("o_orderkey"), "v1", "loader")
    return df.select(
        "o_orderkey", "version", "createdBy", "updatedBy",
        (F.col("createDate") == F.col("updateDate")).alias("stamped"),
    )


@query(
    "load_stamps",
    "SELECT p_partkey, 'daily' AS load_kind, true AS dated FROM part",
)
def load_stamps(spark, sf):
    df = ops.load_stamps(table(spark, sf, "part").select("p_partkey"), "load_date", load_kind="daily")
    return df.select("p_partkey", "load_kind", (F.col("load_date") >= F.lit("2020-01-01").cast("date")).alias("dated"))


@query(
    "rows_to_json_array",
    """SELECT l_orderkey, CAST(0 AS BIGINT) AS part,
              CAST(to_json(list({'l_linenumber': l_linenumber, 'l_partkey': l_partkey, 'l_suppkey': l_suppkey}
                   ORDER BY l_linenumber, l_partkey, l_suppkey)) AS VARCHAR) AS rows_json
       FROM lineitem GROUP BY l_orderkey""",
)
def rows_to_json_array(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return ops.rows_to_json_array(lines, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"])


@query(
    "map_drop_nulls",
    """SELECT event_id, '{"type":"' || event_type || '"' ||
              CASE WHEN value > 50 THEN ',"size":"large"' ELSE '' END || '}' AS facts FROM events""",
)
def map_drop_nulls(spark, sf):
    facts = F.create_map(
        F.lit("type"), F.col("event_type"),
        F.lit("size"), F.when(F.col("value") > 50, "large"),
        F.lit("note"), F.lit(None).cast("string"),
    )
    return table(spark, sf, "events").select("event_id", F.to_json(ops.drop_null_entries(facts)).alias("facts"))


@query(
    "add_missing_columns",
    """SELECT o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '1997-01-01' THEN NULL ELSE o_orderpriority END
              AS o_orderpriority, o_totalprice FROM orders""",
)
def add_missing_columns(spark, sf):
    orders = table(spark, sf, "orders")
    old = orders.where("coalesce(o_orderdate < TIMESTAMP_NTZ '1997-01-01', false)").select("o_orderkey", "o_totalprice")
    new = orders.where("NOT coalesce(o_orderdate < TIMESTAMP_NTZ '1997-01-01', false)").select("o_orderkey", "o_orderpriority", "o_totalprice")
    schema = T.StructType.fromDDL("o_orderkey long, o_orderpriority string, o_totalprice double")
    return union_by_name([ops.add_missing_columns(old, schema), new])
