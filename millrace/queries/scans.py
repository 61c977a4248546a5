"""Queries for sources."""

from pyspark.sql import functions as F

from millrace.functions.schemas import schema_from_ddl
from millrace.queries.registry import land, landing, named_table, query, table
from millrace.session import scratch_path
from millrace.sources import messages
from millrace.sources.files import file_scan
from millrace.sources.snapshots import numbered_snapshots, snapshot_versions
from millrace.sources.tables import path_scan, table_scan, table_snapshot
from millrace.operators.tables import union_by_position
from millrace.operators.transforms import select_exprs, where_all
from millrace.plans.flows import Runner
from millrace.specs import AppendFlow, Flow, SnapshotCdc, Source, Target
from millrace.streaming.snapshots import SnapshotStore

EVENTS_DDL = """event_id: bigint, ts: timestamp_ntz, user_id: bigint,
                event_type: string, value: double, props: string"""
PARQUET = {"cloudFiles.format": "parquet", "pathGlobFilter": "events.parquet"}


@query("file_stream_schema", "SELECT * FROM events")
def file_stream_schema(spark, sf):
    return land(file_scan(spark, sf, PARQUET, EVENTS_DDL), "stream-schema")


def _as_lines(spark, sf, label):
    """Events as JSON lines in the shared folder."""
    path = scratch_path(spark, label)
    table(spark, sf, "events").write.json(path)
    return path


@query("file_stream_inferred", "SELECT event_id, user_id, event_type, value, props FROM events")
def file_stream_inferred(spark, sf):
    path = _as_lines(spark, sf, "inferred")
    options = {"cloudFiles.format": "json", "cloudFiles.inferColumnTypes": "true"}
    return land(file_scan(spark, path, options), "stream-inferred").select(
        "event_id", "user_id", "event_type", "value", "props"
    )


# dirty lines: purchases carry a value that is no number, errors a field the schema lacks, and
# signups are cut short
DIRTY = """CASE event_type
    WHEN 'purchase' THEN concat('{"event_id":', event_id, ',"event_type":"purchase","value":"n/a"}')
    WHEN 'error' THEN concat('{"event_id":', event_id, ',"event_type":"error","value":1.5,"extra":"e', user_id, '"}')
    WHEN 'signup' THEN concat('event ', event_id, ' cut')
    ELSE concat('{"event_id":', event_id, ',"event_type":"', event_type, '","value":2.5}') END"""


@query(
    "rescued_json",
    """SELECT CASE WHEN event_type <> 'signup' THEN event_id END AS event_id,
              CASE WHEN event_type <> 'signup' THEN event_type END AS event_type,
              CASE event_type WHEN 'purchase' THEN NULL WHEN 'signup' THEN NULL WHEN 'error' THEN 1.5 ELSE 2.5 END::DOUBLE AS value,
              CASE event_type WHEN 'purchase' THEN '{"value":"n/a"}'
                              WHEN 'error' THEN '{"extra":"e' || user_id || '"}'
                              WHEN 'signup' THEN '{"_line":"event ' || event_id || ' cut"}' END AS _rescued_data
       FROM events""",
)
def rescued_json(spark, sf):
    path = scratch_path(spark, "dirty-json")
    table(spark, sf, "events").selectExpr(f"{DIRTY} AS value").write.text(path)
    options = {"cloudFiles.format": "json", "cloudFiles.rescuedDataColumn": "_rescued_data"}
    schema = "event_id bigint, event_type string, value double, _rescued_data string"
    return land(file_scan(spark, path, options, schema), "rescued-json")


@query(
    "rescued_csv",
    """SELECT event_id, event_type, CASE event_type WHEN 'purchase' THEN NULL ELSE value END AS value,
              CASE event_type WHEN 'purchase' THEN '{"value":"n/a"}'
                              WHEN 'error' THEN '{"_line":"' || event_id || ',error,' || '0.5' || ',extra"}' END AS _rescued_data
       FROM (SELECT event_id, event_type, CASE event_type WHEN 'error' THEN 0.5 ELSE 7.25 END::DOUBLE AS value FROM events)""",
)
def rescued_csv(spark, sf):
    path = scratch_path(spark, "dirty-csv")
    line = """CASE event_type WHEN 'purchase' THEN concat(event_id, ',purchase,n/a')
              WHEN 'error' THEN concat(event_id, ',error,0.5,extra')
              ELSE concat(event_id, ',', event_type, ',7.25') END AS value"""
    table(spark, sf, "events").selectExpr(line).write.text(path)
    options = {"cloudFiles.format": "csv", "cloudFiles.rescuedDataColumn": "_rescued_data"}
    schema = "event_id bigint, event_type string, value double"
    return land(file_scan(spark, path, options, schema), "rescued-csv")


@query("file_meta_select", "SELECT event_id, 'events.parquet' AS source_file, true AS sized FROM events")
def file_meta_select(spark, sf):
    request = {
        "select_metadata_cols": {"source_file": "_metadata.file_name", "source_size": "_metadata.file_size"}
    }
    landed = land(file_scan(spark, sf, PARQUET, EVENTS_DDL, metadata=request), "meta-select")
    if "_metadata" in landed.columns:
        raise AssertionError("the metadata struct must be gone")
    return landed.select("event_id", "source_file", (F.col("source_size") > 0).alias("sized"))


@query("file_meta_keep", "SELECT event_id, 'events.parquet' AS source_file FROM events")
def file_meta_keep(spark, sf):
    request = {"include_autoloader_metadata_column": "True"}
    landed = land(file_scan(spark, sf, PARQUET, EVENTS_DDL, metadata=request), "meta-keep")
    return landed.select("event_id", F.col("source_metadata.file_name").alias("source_file"))


@query("table_stream_scan", "SELECT * FROM orders")
def table_stream_scan(spark, sf):
    name = named_table(table(spark, sf, "orders"), "orders_stream")
    return land(table_scan(spark, name, {"maxFilesPerTrigger": "4"}), "table-stream")


@query("table_batch_scan", "SELECT * FROM supplier")
def table_batch_scan(spark, sf):
    return table_scan(spark, named_table(table(spark, sf, "supplier"), "supplier_batch"), streaming=False)


@query(
    "silver_source_scan",
    "SELECT o_orderkey, o_totalprice, 'stream' AS kind FROM orders UNION ALL SELECT o_orderkey, o_totalprice, 'batch' FROM orders",
)
def silver_source_scan(spark, sf):
    path = scratch_path(spark, "silver-source")
    table(spark, sf, "orders").write.parquet(path)
    streamed = land(path_scan(spark, path), "silver-stream")
    whole = path_scan(spark, path, streaming=False)
    return union_by_position(
        [df.select("o_orderkey", "o_totalprice", F.lit(kind).alias("kind")) for kind, df in (("stream", streamed), ("batch", whole))]
    )


def _messages(spark, sf):
    """Events as messages: the payload is their ``props`` text."""
    return table(spark, sf, "events").select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.col("props").cast("binary").alias("value"),
        F.lit("events").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


@query(
    "message_scan",
    'SELECT event_id AS "offset", \'events\' AS topic, CAST(user_id AS VARCHAR) AS key, props AS value FROM events',
)
def message_scan(spark, sf):
    frame = messages.message_frame(_messages(spark, sf))
    return frame.select("offset", "topic", F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


@query(
    "message_time_parts",
    """SELECT event_id AS "offset", CAST(CAST(ts AS DATE) AS VARCHAR) AS date, CAST(hour(ts) AS INTEGER) AS hour,
              CAST(minute(ts) AS INTEGER) AS minute FROM events""",
)
def message_time_parts(spark, sf):
    frame = messages.message_frame(_messages(spark, sf))
    return frame.select("offset", F.col("date").cast("string").alias("date"), "hour", "minute")


@query(
    "message_parse",
    """SELECT event_id AS "offset", CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, true AS parsed FROM events""",
)
def message_parse(spark, sf):
    frame = messages.message_frame(_messages(spark, sf), schema_from_ddl("k int"))
    return frame.select(
        "offset", F.col("parsed_records.k").alias("k"), F.col("parsed_records").isNotNull().alias("parsed")
    )


@query(
    "snapshot_versions",
    """SELECT 1 AS version, p_partkey, p_name, p_retailprice FROM part WHERE p_size <> 1
       UNION ALL SELECT 2, p_partkey, p_name, p_retailprice FROM part WHERE p_size <> 2
       UNION ALL SELECT 3, p_partkey, p_name, p_retailprice FROM part WHERE p_size <> 3""",
)
def snapshot_versions_query(spark, sf):
    prefix = scratch_path(spark, "snapshots") + "/LOAD_"
    part = table(spark, sf, "part")
    for v in (1, 2, 3):
        rows = part.where(F.col("p_size") != v).select("p_partkey", "p_name", "p_retailprice")
        rows.write.option("header", "true").csv(f"{prefix}{v}.csv")
    following = numbered_snapshots(
        spark, prefix, ".csv", options={"header": "true"}, schema="p_partkey bigint, p_name string, p_retailprice double"
    )
    return union_by_position(
        [df.select(F.lit(v).alias("version"), "*") for v, df in snapshot_versions(following)]
    )


@query(
    "snapshot_from_table",
    """SELECT c_custkey, c_name, c_acctbal, 1 AS "__START_AT", CAST(NULL AS INTEGER) AS "__END_AT" FROM customer""",
)
def snapshot_from_table(spark, sf):
    name = named_table(table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal"), "customer_snapshot")
    store = SnapshotStore(spark, scratch_path(spark, "table-snapshot"), SnapshotCdc(["c_custkey"], 2))
    for run in (1, 2):
        # the second run finds the table unchanged
        store.apply(*table_snapshot(spark, name, run))
    return store.table()


ORDERS_DDL = """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
                o_orderdate timestamp_ntz, o_orderpriority string"""


@query("append_flow_source", "SELECT * FROM orders")
def append_flow_source(spark, sf):
    orders = table(spark, sf, "orders")
    done, opened = scratch_path(spark, "orders-f"), scratch_path(spark, "orders-o")
    orders.where("o_orderstatus = 'F'").write.parquet(done)
    orders.where("o_orderstatus = 'O'").write.json(opened)
    pending = named_table(orders.where("NOT coalesce(o_orderstatus IN ('F', 'O'), false)"), "orders_p")
    flow = Flow(
        "orders",
        Source("files", {"path": done}, {"cloudFiles.format": "parquet"}, ORDERS_DDL),
        Target(scratch_path(spark, "orders-all")),
        append_flows=[
            AppendFlow("opened", Source("files", {"path": opened}, {"cloudFiles.format": "json"}, ORDERS_DDL)),
            AppendFlow("pending", Source("table", {"table": pending})),
        ],
    )
    runner = Runner(spark, scratch_path(spark, "orders-progress"), [flow])
    runner.run(flow)
    return runner.table(flow)
