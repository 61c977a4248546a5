"""Queries for change data capture. Key ``user_id``, sequence ``ts``, delete = an error event."""

from pyspark.sql import functions as F

from millrace.functions.schemas import scd2_schema
from millrace.operators import cdc as ops
from millrace.queries.registry import landing, query, table
from millrace.session import scratch_path
from millrace.specs import Cdc
from millrace.streaming.scd import open_store
from millrace.streaming.targets import run_available, run_once

DELETE = "event_type = 'error'"
DROPPED = ["event_type", "ts", "props"]


def _last(where="true", keys="user_id", order="ts DESC", source="events"):
    return f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn
               FROM {source} WHERE {where}) WHERE rn = 1"""


def _history(tracked, values, key="user_id", seq="ts", deletes="event_type = 'error'", source="events", order=None):
    """SQL for SCD2: boundary events, segments numbered by a running sum, one row per segment."""
    order = order or seq
    changed = " OR ".join(f"{c} IS DISTINCT FROM lag({c}) OVER w" for c in tracked)
    picked = ", ".join(f"(arg_max({{'v': {v}}}, rn)).v AS {v}" for v in values)
    return f"""
      WITH f AS (SELECT *, coalesce({deletes}, false) AS d,
                        row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn FROM {source}),
      b AS (SELECT *, CASE WHEN lag(rn) OVER w IS NULL OR lag(d) OVER w OR d OR {changed} THEN 1 ELSE 0 END AS opens
            FROM f WINDOW w AS (PARTITION BY {key} ORDER BY rn)),
      g AS (SELECT *, sum(opens) OVER (PARTITION BY {key} ORDER BY rn) AS seg FROM b),
      s AS (SELECT {key}, seg, bool_or(d) AS d, {picked}, min({seq}) AS st FROM g GROUP BY {key}, seg),
      e AS (SELECT *, lead(st) OVER (PARTITION BY {key} ORDER BY seg) AS en FROM s)
      SELECT {key}, {', '.join(values)}, st AS "__START_AT", en AS "__END_AT" FROM e WHERE NOT d"""


@query("cdc_scd1", f"SELECT user_id, event_id, event_type, value FROM ({_last()})")
def cdc_scd1(spark, sf):
    return ops.scd1(table(spark, sf, "events"), Cdc(["user_id"], "ts", 1, except_column_list=["ts", "props"]))


@query(
    "cdc_scd1_delete",
    f"SELECT user_id, event_id, value FROM ({_last()}) WHERE event_type <> 'error'",
)
def cdc_scd1_delete(spark, sf):
    return ops.scd1(
        table(spark, sf, "events"),
        Cdc(["user_id"], "ts", 1, apply_as_deletes=DELETE, except_column_list=DROPPED),
    )


# a truncate is an event of unusually high value; the last of them clears all that came before
TRUNCATE = "value > 200"


@query(
    "cdc_scd1_truncate",
    f"""SELECT user_id, event_id, value FROM ({_last(
        "NOT value > 200 AND ts > coalesce((SELECT max(ts) FROM events WHERE value > 200), TIMESTAMP '1900-01-01')")})
        WHERE event_type <> 'error'""",
)
def cdc_scd1_truncate(spark, sf):
    return ops.scd1(
        table(spark, sf, "events"),
        Cdc(["user_id"], "ts", 1, apply_as_deletes=DELETE, apply_as_truncates=TRUNCATE, except_column_list=DROPPED),
    )


@query("cdc_scd2", _history(["event_id", "event_type", "value", "props"], ["event_id", "event_type", "value", "props"], deletes="false"))
def cdc_scd2(spark, sf):
    return ops.scd2(table(spark, sf, "events"), Cdc(["user_id"], "ts", 2, except_column_list=["ts"]))


@query("cdc_scd2_delete", _history(["event_id", "value"], ["event_id", "value"]))
def cdc_scd2_delete(spark, sf):
    return ops.scd2(
        table(spark, sf, "events"),
        Cdc(["user_id"], "ts", 2, apply_as_deletes=DELETE, except_column_list=DROPPED),
    )


TRACKED = Cdc(["user_id"], "ts", 2, apply_as_deletes=DELETE, except_column_list=["ts", "props"],
              track_history_column_list=["event_type"])


@query("cdc_track_list", _history(["event_type"], ["event_id", "event_type", "value"]))
def cdc_track_list(spark, sf):
    return ops.scd2(table(spark, sf, "events"), TRACKED)


@query("cdc_track_except", _history(["event_type"], ["event_id", "event_type", "value"]))
def cdc_track_except(spark, sf):
    settings = Cdc(["user_id"], "ts", 2, apply_as_deletes=DELETE, except_column_list=["ts", "props"],
                   track_history_except_column_list=["event_id", "value"])
    return ops.scd2(table(spark, sf, "events"), settings)


# updates that leave columns NULL: no value for small ones, no props for views
SPARSE = """SELECT event_id, ts, user_id, event_type, CASE WHEN value > 15 THEN value END AS value,
                   CASE WHEN event_type <> 'view' THEN props END AS props FROM events"""


def _sparse(spark, sf):
    value = F.when(F.col("value") > 15, F.col("value"))
    props = F.when(F.col("event_type") != "view", F.col("props"))
    return table(spark, sf, "events").withColumns({"value": value, "props": props})


def _filled_last(value, props):
    return f"""
      WITH f AS ({SPARSE}),
      g AS (SELECT *, max(CASE WHEN event_type = 'error' THEN ts END) OVER (PARTITION BY user_id) AS gone FROM f),
      k AS (SELECT user_id, arg_max(event_id, ts) AS event_id, arg_max(event_type, ts) AS event_type,
                   {value} AS value, {props} AS props FROM g GROUP BY user_id)
      SELECT user_id, event_id, value, props FROM k WHERE event_type <> 'error'"""


ALIVE = "ts > coalesce(gone, TIMESTAMP '1900-01-01')"


def _kept(c):
    return f"arg_max({c}, ts) FILTER (WHERE {c} IS NOT NULL AND {ALIVE})"


def _as_is(c):
    return f"(arg_max({{'v': {c}}}, ts)).v"


IGNORE = dict(keys=["user_id"], sequence_by="ts", apply_as_deletes=DELETE, except_column_list=["ts", "event_type"])


@query("cdc_ignore_nulls", _filled_last(_kept("value"), _kept("props")))
def cdc_ignore_nulls(spark, sf):
    return ops.scd1(_sparse(spark, sf), Cdc(**IGNORE, ignore_null_updates=True))


@query("cdc_ignore_nulls_list", _filled_last(_kept("value"), _as_is("props")))
def cdc_ignore_nulls_list(spark, sf):
    return ops.scd1(_sparse(spark, sf), Cdc(**IGNORE, ignore_null_updates_column_list=["value"]))


@query("cdc_ignore_nulls_except", _filled_last(_as_is("value"), _kept("props")))
def cdc_ignore_nulls_except(spark, sf):
    return ops.scd1(_sparse(spark, sf), Cdc(**IGNORE, ignore_null_updates_except_column_list=["value", "event_id"]))


FILLED = f"""(WITH f AS ({SPARSE}),
  g AS (SELECT *, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts) AS life FROM f)
  SELECT event_id, ts, user_id, event_type,
         last_value(CASE WHEN event_type <> 'error' THEN value END IGNORE NULLS) OVER w AS value,
         last_value(CASE WHEN event_type <> 'error' THEN props END IGNORE NULLS) OVER w AS props
  FROM g WINDOW w AS (PARTITION BY user_id, life ORDER BY ts ROWS UNBOUNDED PRECEDING))"""


@query(
    "cdc_ignore_nulls_scd2",
    _history(["value", "props"], ["event_id", "value", "props"], source=FILLED),
)
def cdc_ignore_nulls_scd2(spark, sf):
    settings = Cdc(**IGNORE, scd_type=2, ignore_null_updates=True, track_history_column_list=["value", "props"])
    return ops.scd2(_sparse(spark, sf), settings)


@query("cdc_column_list", f"SELECT user_id, event_id, value FROM ({_last()})")
def cdc_column_list(spark, sf):
    return ops.scd1(table(spark, sf, "events"), Cdc(["user_id"], "ts", 1, column_list=["event_id", "value"]))


@query("cdc_except_columns", f"SELECT user_id, event_id, event_type, value FROM ({_last()})")
def cdc_except_columns(spark, sf):
    return ops.scd1(table(spark, sf, "events"), Cdc(["user_id"], "ts", 1, except_column_list=["ts", "props"]))


@query(
    "cdc_where",
    f"SELECT user_id, event_id, event_type, value FROM ({_last('value > 20')})",
)
def cdc_where(spark, sf):
    settings = Cdc(["user_id"], "ts", 1, where="value > 20", except_column_list=["ts", "props"])
    return ops.scd1(table(spark, sf, "events"), settings)


@query(
    "cdc_multi_sequence",
    _history(["event_type"], ["event_id", "event_type", "value"], order="ts, event_id"),
)
def cdc_multi_sequence(spark, sf):
    settings = Cdc(["user_id"], "ts, event_id", 2, apply_as_deletes=DELETE,
                   except_column_list=["ts", "props"], track_history_column_list=["event_type"])
    return ops.scd2(table(spark, sf, "events"), settings)


@query(
    "cdc_multi_key",
    f"SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM ({_last(keys='l_orderkey, l_linenumber', order='l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC', source='lineitem')})",
)
def cdc_multi_key(spark, sf):
    settings = Cdc(["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"], 1,
                   column_list=["l_partkey", "l_quantity"])
    return ops.scd1(table(spark, sf, "lineitem"), settings)


def _run_feed(spark, feed, settings, label, slices=4):
    """Feed whole ``feed`` in ``slices`` batches drawn by row hash, so most events come late."""
    store = open_store(spark, scratch_path(spark, label), settings, feed.schema, buckets=8)
    part = F.pmod(F.xxhash64("event_id"), F.lit(slices))
    for i in range(slices):
        store.apply(feed.where(part == i), i)
    return store.table()


# all clicks and views go to one key, so that it holds 40 % of the rows
SKEWED = """(SELECT CASE WHEN event_type IN ('click', 'view') THEN -1 ELSE user_id END AS user_id,
                    event_id, ts, event_type, value, value > 20 AS is_large FROM events)"""


@query("cdc_hot_key", _history(["is_large"], ["event_id", "value", "is_large"], source=SKEWED))
def cdc_hot_key(spark, sf):
    """SCD2 where one key holds a large share of the rows, cut into slices of about 500 rows."""
    key = F.when(F.col("event_type").isin("click", "view"), -1).otherwise(F.col("user_id"))
    feed = table(spark, sf, "events").withColumns({"user_id": key, "is_large": F.col("value") > 20})
    settings = Cdc(["user_id"], "ts", 2, apply_as_deletes=DELETE, column_list=["event_id", "value", "is_large"],
                   track_history_column_list=["is_large"])
    return ops.scd2(feed, settings, split_rows=500)


@query("cdc_out_of_order", _history(["event_type"], ["event_id", "event_type", "value"]))
def cdc_out_of_order(spark, sf):
    return _run_feed(spark, table(spark, sf, "events"), TRACKED, "out-of-order")


@query(
    "cdc_scd1_incremental",
    f"SELECT user_id, event_id, value FROM ({_last()}) WHERE event_type <> 'error'",
)
def cdc_scd1_incremental(spark, sf):
    settings = Cdc(["user_id"], "ts", 1, apply_as_deletes=DELETE, except_column_list=DROPPED)
    return _run_feed(spark, table(spark, sf, "events"), settings, "scd1-incremental")


@query(
    "cdc_once",
    f"SELECT user_id, event_id, value FROM ({_last()}) WHERE event_type <> 'error'",
)
def cdc_once(spark, sf):
    schema = table(spark, sf, "events").schema
    settings = Cdc(["user_id"], "ts", 1, apply_as_deletes=DELETE, except_column_list=DROPPED, once=True)
    store = open_store(spark, scratch_path(spark, "once"), settings, schema, buckets=8)
    progress = scratch_path(spark, "once-progress")

    def backfill():
        return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)

    for _ in range(2):
        run_once(spark, backfill, store.apply, progress)
    return store.table()


@query(
    "cdc_scd2_stream",
    _history(["event_type"], ["event_id", "event_type", "value"]),
)
def cdc_scd2_stream(spark, sf):
    schema = table(spark, sf, "events").schema
    store = open_store(spark, scratch_path(spark, "scd2-stream"), TRACKED, schema, buckets=8)
    feed = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    run_available(feed, store.apply, scratch_path(spark, "scd2-stream-progress"))
    return store.table()


@query("cdc_scd2_schema", _history(["event_type"], ["event_id", "event_type", "value"]))
def cdc_scd2_schema(spark, sf):
    events = table(spark, sf, "events")
    target = landing(spark, "scd2-schema")
    target.create(scd2_schema(events.schema, TRACKED))
    target.write_batch(ops.scd2(events, TRACKED), 0)
    return target.table()


@query(
    "scd2_current",
    f"""SELECT user_id, event_id, event_type, value FROM ({_history(["event_type"], ["event_id", "event_type", "value"])})
        WHERE "__END_AT" IS NULL""",
)
def scd2_current(spark, sf):
    return ops.current(ops.scd2(table(spark, sf, "events"), TRACKED)).drop("__START_AT", "__END_AT")


@query(
    "scd2_as_of",
    f"""SELECT user_id, event_id, event_type, value FROM ({_history(["event_type"], ["event_id", "event_type", "value"])})
        WHERE "__START_AT" <= TIMESTAMP '2024-01-15' AND ("__END_AT" IS NULL OR "__END_AT" > TIMESTAMP '2024-01-15')""",
)
def scd2_as_of(spark, sf):
    history = ops.scd2(table(spark, sf, "events"), TRACKED)
    return ops.as_of(history, F.expr("TIMESTAMP_NTZ '2024-01-15'")).drop("__START_AT", "__END_AT")
