"""Queries for snapshot series. Snapshot v of ``part`` lacks the parts of size v, and names and
prices of some parts change with v."""

from pyspark.sql import functions as F

from millrace.operators import snapshot as ops
from millrace.operators.transforms import select_exprs, where_all
from millrace.queries.registry import named_table, query, table
from millrace.session import scratch_path
from millrace.sources.tables import table_scan
from millrace.specs import SnapshotCdc
from millrace.streaming.snapshots import SnapshotStore


def snapshot(spark, sf, v):
    named = F.when(F.col("p_brand") == f"Brand#{v}", F.concat("p_name", F.lit(f" v{v}"))).otherwise(F.col("p_name"))
    priced = F.when(F.col("p_type") == "ECONOMY", F.col("p_retailprice") + v).otherwise(F.col("p_retailprice"))
    return table(spark, sf, "part").where(F.col("p_size") != v).select(
        "p_partkey", named.alias("name"), priced.alias("price")
    )


def series(spark, sf, last=3):
    return [(v, snapshot(spark, sf, v)) for v in range(1, last + 1)]


def snapshot_sql(v):
    return f"""SELECT {v} AS v, p_partkey, CASE WHEN p_brand = 'Brand#{v}' THEN p_name || ' v{v}' ELSE p_name END AS name,
                 CASE WHEN p_type = 'ECONOMY' THEN p_retailprice + {v} ELSE p_retailprice END AS price
               FROM part WHERE p_size <> {v}"""


def history_sql(tracked=("name", "price"), last=3):
    """SQL for snapshot SCD2: gaps and changes open a segment."""
    everything = " UNION ALL ".join(snapshot_sql(v) for v in range(1, last + 1))
    changed = " OR ".join(f"{c} IS DISTINCT FROM lag({c}) OVER w" for c in tracked)
    return f"""
      WITH s AS ({everything}),
      b AS (SELECT *, CASE WHEN lag(v) OVER w IS NULL OR lag(v) OVER w <> v - 1 OR {changed} THEN 1 ELSE 0 END AS opens
            FROM s WINDOW w AS (PARTITION BY p_partkey ORDER BY v)),
      g AS (SELECT *, sum(opens) OVER (PARTITION BY p_partkey ORDER BY v) AS seg FROM b)
      SELECT p_partkey, arg_max(name, v) AS name, arg_max(price, v) AS price, CAST(min(v) AS INTEGER) AS "__START_AT",
             CAST(CASE WHEN max(v) < {last} THEN max(v) + 1 END AS INTEGER) AS "__END_AT"
      FROM g GROUP BY p_partkey, seg"""


BOTH = SnapshotCdc(["p_partkey"], 2)


@query("snap_scd1", f"SELECT p_partkey, name, price FROM ({snapshot_sql(3)})")
def snap_scd1(spark, sf):
    store = SnapshotStore(spark, scratch_path(spark, "snap-scd1"), SnapshotCdc(["p_partkey"], 1), buckets=8)
    store.apply_all(series(spark, sf))
    return store.table()


@query("snap_scd2", history_sql())
def snap_scd2(spark, sf):
    return ops.snapshots_scd2(series(spark, sf), BOTH)


@query("snap_scd2_store", history_sql())
def snap_scd2_store(spark, sf):
    store = SnapshotStore(spark, scratch_path(spark, "snap-scd2"), BOTH, buckets=8)
    store.apply_all(series(spark, sf))
    return store.table()


@query(
    "snap_diff",
    f"""SELECT coalesce(a.p_partkey, b.p_partkey) AS p_partkey,
               CASE WHEN a.p_partkey IS NULL THEN 'I' WHEN b.p_partkey IS NULL THEN 'D'
                    WHEN a.name IS DISTINCT FROM b.name OR a.price IS DISTINCT FROM b.price THEN 'U' ELSE 'N' END AS change
        FROM ({snapshot_sql(1)}) a FULL JOIN ({snapshot_sql(2)}) b ON a.p_partkey = b.p_partkey""",
)
def snap_diff(spark, sf):
    return ops.diff(snapshot(spark, sf, 1), snapshot(spark, sf, 2), BOTH)


@query("snap_track_list", history_sql(["name"]))
def snap_track_list(spark, sf):
    return ops.snapshots_scd2(series(spark, sf), SnapshotCdc(["p_partkey"], 2, track_history_column_list=["name"]))


@query("snap_track_except", history_sql(["price"]))
def snap_track_except(spark, sf):
    settings = SnapshotCdc(["p_partkey"], 2, track_history_except_column_list=["name"])
    return ops.snapshots_scd2(series(spark, sf), settings)


@query("snap_multi_version", history_sql(last=5))
def snap_multi_version(spark, sf):
    return ops.snapshots_scd2(series(spark, sf, 5), BOTH)


@query(
    "snap_silver",
    f"""SELECT p_partkey, name, price, 1 AS "__START_AT", CAST(NULL AS INTEGER) AS "__END_AT"
        FROM ({history_sql()}) WHERE "__END_AT" IS NULL""",
)
def snap_silver(spark, sf):
    bronze = named_table(ops.snapshots_scd2(series(spark, sf), BOTH), "snap_bronze")
    shaped = where_all(
        select_exprs(table_scan(spark, bronze, streaming=False), ["p_partkey", "name", "price"]), ["__END_AT IS NULL"]
    )
    store = SnapshotStore(spark, scratch_path(spark, "snap-silver"), BOTH, buckets=8)
    store.apply(1, shaped)
    return store.table()


@query(
    "snap_reinsert",
    f"""SELECT p_partkey, count(*) AS spans, min("__START_AT") AS first_seen, count(*) FILTER (WHERE "__END_AT" IS NULL) AS open_spans
        FROM ({history_sql(last=4)}) GROUP BY p_partkey HAVING bool_or("__END_AT" IS NOT NULL)""",
)
def snap_reinsert(spark, sf):
    history = ops.snapshots_scd2(series(spark, sf, 4), BOTH)
    return (
        history.groupBy("p_partkey")
        .agg(
            F.count(F.lit(1)).alias("spans"),
            F.min("__START_AT").alias("first_seen"),
            F.count_if(F.col("__END_AT").isNull()).alias("open_spans"),
            F.bool_or(F.col("__END_AT").isNotNull()).alias("closed"),
        )
        .where("closed")
        .drop("closed")
    )
