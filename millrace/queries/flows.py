"""Queries for whole flows."""

from pyspark.sql import functions as F

from millrace.operators import cdc
from millrace.operators.quality import expect_or_drop
from millrace.operators.tables import union_by_position
from millrace.operators.transforms import select_exprs, where_all
from millrace.plans.flows import Runner
from millrace.queries.registry import query, table
from millrace.queries.scans import EVENTS_DDL, ORDERS_DDL
from millrace.session import scratch_path
from millrace.specs import AppendFlow, Cdc, Flow, Rules, Source, Target


def _files(sf, name, ddl, **more):
    return Source("files", {"path": sf}, {"cloudFiles.format": "parquet", "pathGlobFilter": f"{name}.parquet"}, ddl, **more)


LATEST = """SELECT user_id, event_id, kind, value FROM (
    SELECT user_id, event_id, upper(event_type) AS kind, value,
           row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn
    FROM events WHERE event_type <> 'signup' AND value > 1) WHERE rn = 1 AND kind <> 'ERROR'"""


@query("silver_flow", LATEST)
def silver_flow(spark, sf):
    """Select, where, drop rule and SCD1 with deletes, as one plan."""
    shaped = select_exprs(
        table(spark, sf, "events"), ["user_id", "event_id", "upper(event_type) AS kind", "value", "ts"]
    )
    checked = expect_or_drop(where_all(shaped, ["kind <> 'SIGNUP'"]), {"sized": "value > 1"})
    settings = Cdc(["user_id"], "ts", 1, apply_as_deletes="kind = 'ERROR'", except_column_list=["ts"])
    return cdc.scd1(checked, settings)


@query("cdc_named_table", LATEST)
def cdc_named_table(spark, sf):
    """An SCD1 target read by its name, partitioned by a column that changes."""
    path = scratch_path(spark, "named")
    flow = Flow(
        "named",
        _files(sf, "events", EVENTS_DDL),
        Target(path, "named_" + path[-12:], partition_by=["kind"], comment="latest events"),
        layer="silver",
        select_exp=["user_id", "event_id", "upper(event_type) AS kind", "value", "ts"],
        where=["kind <> 'SIGNUP'", "value > 1"],
        cdc=Cdc(["user_id"], "ts", 1, apply_as_deletes="kind = 'ERROR'", except_column_list=["ts"]),
    )
    Runner(spark, scratch_path(spark, "named-progress"), [flow], buckets=4).run(flow)
    return spark.table(flow.target.name).select("user_id", "event_id", "kind", "value")


@query(
    "cdc_append_flow",
    f"""{LATEST} UNION ALL
        SELECT o_custkey AS user_id, o_orderkey AS event_id, 'ORDER' AS kind, CAST(o_totalprice AS DOUBLE) AS value FROM orders""",
)
def cdc_append_flow(spark, sf):
    """An SCD1 target to which a second source appends its rows as they are; run twice, which changes nothing."""
    orders = scratch_path(spark, "append-orders")
    table(spark, sf, "orders").selectExpr(
        "o_custkey AS user_id", "o_orderkey AS event_id", "'ORDER' AS kind", "CAST(o_totalprice AS double) AS value"
    ).write.parquet(orders)
    ddl = "user_id bigint, event_id bigint, kind string, value double"
    flow = Flow(
        "latest",
        _files(sf, "events", EVENTS_DDL),
        Target(scratch_path(spark, "append-target")),
        layer="silver",
        select_exp=["user_id", "event_id", "upper(event_type) AS kind", "value", "ts"],
        where=["kind <> 'SIGNUP'", "value > 1"],
        cdc=Cdc(["user_id"], "ts", 1, apply_as_deletes="kind = 'ERROR'", except_column_list=["ts"]),
        append_flows=[AppendFlow("orders", Source("files", {"path": orders}, {"cloudFiles.format": "parquet"}, ddl))],
    )
    runner = Runner(spark, scratch_path(spark, "append-progress"), [flow], buckets=4)
    runner.run(flow)
    runner.run(flow)
    return runner.table(flow)


def _bronze(spark, sf):
    return Flow(
        "bronze_events",
        _files(sf, "events", EVENTS_DDL, metadata={"select_metadata_cols": {"source_file": "_metadata.file_name"}}),
        Target(scratch_path(spark, "bronze")),
        group="events",
        rules=Rules.from_levels(
            {
                "expect": {"large": "value > 100"},
                "expect_or_drop": {"sized": "value > 1"},
                "expect_or_fail": {"keyed": "event_id IS NOT NULL"},
                "expect_or_quarantine": {"tiny": "value <= 1"},
            }
        ),
        quarantine=Target(scratch_path(spark, "bronze-quarantine")),
    )


@query(
    "bronze_flow",
    """SELECT event_id, event_type, value, 'events.parquet' AS source_file,
              CASE WHEN value > 1 THEN 'main' ELSE 'quarantine' END AS went_to FROM events""",
)
def bronze_flow(spark, sf):
    flow = _bronze(spark, sf)
    runner = Runner(spark, scratch_path(spark, "bronze-progress"), [flow])
    runner.run(flow)
    return union_by_position(
        [
            df.select("event_id", "event_type", "value", "source_file", F.lit(where).alias("went_to"))
            for where, df in (("main", runner.table(flow)), ("quarantine", runner.quarantine_table(flow)))
        ]
    )


@query("bronze_silver", LATEST)
def bronze_silver(spark, sf):
    bronze = _bronze(spark, sf)
    silver = Flow(
        "silver_events",
        Source("flow", {"flow": bronze.id}),
        Target(scratch_path(spark, "silver")),
        group="events",
        layer="silver",
        select_exp=["user_id", "event_id", "upper(event_type) AS kind", "value", "ts"],
        where=["kind <> 'SIGNUP'"],
        cdc=Cdc(["user_id"], "ts", 1, apply_as_deletes="kind = 'ERROR'", except_column_list=["ts"]),
    )
    runner = Runner(spark, scratch_path(spark, "chain-progress"), [bronze, silver], buckets=8)
    _raise_errors(runner.run_group("events"))
    return runner.table(silver)


def _raise_errors(runs):
    for run in runs.values():
        if run.error:
            raise run.error


GROUP_DDL = {
    "orders": ORDERS_DDL,
    "events": EVENTS_DDL,
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
}


@query(
    "run_group",
    " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n FROM {n}" for n in GROUP_DDL),
)
def run_group(spark, sf):
    flows = [
        Flow(f"load_{name}", _files(sf, name, ddl), Target(scratch_path(spark, f"load-{name}")), group="load")
        for name, ddl in GROUP_DDL.items()
    ]
    runner = Runner(spark, scratch_path(spark, "group-progress"), flows)
    _raise_errors(runner.run_group("load"))
    return union_by_position(
        [
            runner.table(f"load_{name}").agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n"))
            for name in GROUP_DDL
        ]
    )


@query("incremental_load", "SELECT * FROM orders")
def incremental_load(spark, sf):
    """Older orders first; the second run takes only the files that came since."""
    orders = table(spark, sf, "orders")
    path = scratch_path(spark, "incoming")
    flow = Flow(
        "incoming",
        Source("files", {"path": f"{path}/*"}, {"cloudFiles.format": "parquet"}, ORDERS_DDL),
        Target(scratch_path(spark, "incremental")),
    )
    runner = Runner(spark, scratch_path(spark, "incremental-progress"), [flow])
    orders.where("coalesce(o_orderdate < TIMESTAMP_NTZ '1997-01-01', false)").write.parquet(f"{path}/initial")
    runner.run(flow)
    orders.where("NOT coalesce(o_orderdate < TIMESTAMP_NTZ '1997-01-01', false)").write.parquet(f"{path}/later")
    runner.run(flow)
    return runner.table(flow)
