"""Queries for data quality rules."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from millrace.operators import cdc, quality as ops
from millrace.queries.registry import query, table
from millrace.specs import Cdc, Rules

# one rule gives NULL for some rows: NULL counts as not holding
GOOD = {"sized": "value > 10", "no_error": "nullif(event_type, 'view') <> 'error'"}
BAD = {"tiny": "value < 5", "error": "event_type = 'error'"}


@query("dq_expect", "SELECT event_id, event_type, value FROM events")
def dq_expect(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    return ops.expect(events, GOOD, Observation("dq_expect"))


@query(
    "dq_expect_counts",
    """SELECT 'rows_seen' AS metric, count(*) AS n FROM events
       UNION ALL SELECT 'sized', count(*) FILTER (WHERE NOT coalesce(value > 10, false)) FROM events
       UNION ALL SELECT 'no_error',
              count(*) FILTER (WHERE NOT coalesce(nullif(event_type, 'view') <> 'error', false)) FROM events""",
)
def dq_expect_counts(spark, sf):
    watch = Observation("dq_expect_counts")
    ops.expect(table(spark, sf, "events"), GOOD, watch).write.format("noop").mode("overwrite").save()
    return spark.createDataFrame(list(watch.get.items()), "metric string, n long")


@query(
    "dq_drop",
    """SELECT event_id, event_type, value FROM events
       WHERE coalesce(value > 10, false) AND coalesce(nullif(event_type, 'view') <> 'error', false)""",
)
def dq_drop(spark, sf):
    return ops.expect_or_drop(table(spark, sf, "events").select("event_id", "event_type", "value"), GOOD)


@query("dq_fail", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def dq_fail(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return ops.expect_or_fail(lines, {"keyed": "l_orderkey IS NOT NULL", "positive": "l_quantity > 0"})


@query("dq_quarantine", "SELECT event_id, event_type, value FROM events WHERE value < 5 AND event_type = 'error'")
def dq_quarantine(spark, sf):
    return ops.quarantined(table(spark, sf, "events").select("event_id", "event_type", "value"), BAD)


@query(
    "dq_split",
    """SELECT event_id, CASE WHEN coalesce(value > 10, false)
                AND coalesce(nullif(event_type, 'view') <> 'error', false) THEN 'main' ELSE 'quarantine' END AS went_to
       FROM events""",
)
def dq_split(spark, sf):
    good, bad = ops.split(table(spark, sf, "events"), GOOD)
    return good.select("event_id", F.lit("main").alias("went_to")).unionAll(
        bad.select("event_id", F.lit("quarantine").alias("went_to"))
    )


@query(
    "dq_stack",
    "SELECT event_id, event_type, value FROM events WHERE value > 10 AND event_type <> 'error'",
)
def dq_stack(spark, sf):
    rules = Rules.from_levels(
        {
            "expect_all": {"replaced": "false"},
            "expect": {"large": "value > 100"},
            "expect_or_fail": {"keyed": "event_id IS NOT NULL"},
            "expect_or_drop": {"sized": "value > 10", "no_error": "event_type <> 'error'"},
        }
    )
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    return ops.apply_rules(events, rules, Observation("dq_stack"))


@query(
    "dq_on_cdc",
    """SELECT user_id, event_id, value FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events
         WHERE value > 10) WHERE rn = 1 AND event_type <> 'error'""",
)
def dq_on_cdc(spark, sf):
    feed = ops.apply_rules(table(spark, sf, "events"), Rules(drop={"sized": "value > 10"}, fail={"keyed": "user_id >= 0"}))
    settings = Cdc(["user_id"], "ts", 1, apply_as_deletes="event_type = 'error'", column_list=["event_id", "value"])
    return cdc.apply_changes(feed, settings)


@query(
    "dq_report",
    """SELECT level, rule, (SELECT count(*) FROM documents) AS rows_seen, rows_failed FROM (
         SELECT 'warn' AS level, 'long_enough' AS rule, count(*) FILTER (WHERE NOT coalesce(n_chars >= 200, false)) AS rows_failed FROM documents
         UNION ALL SELECT 'fail', 'has_text', count(*) FILTER (WHERE NOT coalesce(text IS NOT NULL, false)) FROM documents
         UNION ALL SELECT 'drop', 'known_lang', count(*) FILTER (WHERE NOT coalesce(nullif(lang, 'de') IN ('en', 'fr'), false)) FROM documents
         UNION ALL SELECT 'quarantine', 'short', count(*) FILTER (WHERE NOT coalesce(length(text) < 50, false)) FROM documents)""",
)
def dq_report(spark, sf):
    rules = Rules(
        warn={"long_enough": "n_chars >= 200"},
        fail={"has_text": "text IS NOT NULL"},
        drop={"known_lang": "nullif(lang, 'de') IN ('en', 'fr')"},
        quarantine={"short": "length(text) < 50"},
    )
    return ops.report(table(spark, sf, "documents"), rules)
