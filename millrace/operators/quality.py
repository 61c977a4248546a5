"""Data quality rules: warn, drop, fail, quarantine.

A rule is a SQL boolean that describes a good row (a matching row for quarantine rules). NULL
counts as not holding. Every level is a filter or an observed metric on the one pass over the
data; none adds a shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from millrace.functions.columns import fail_unless, holds
from millrace.specs import Rules


def all_hold(rules: Mapping[str, str]) -> Column:
    """True where every rule holds."""
    return reduce(lambda a, b: a & b, [holds(sql) for sql in rules.values()], F.lit(True))


def violation_counts(rules: Mapping[str, str]) -> list[Column]:
    """Rows seen, and rows breaking each rule, as aggregates named after the rules."""
    return [
        F.count(F.lit(1)).alias("rows_seen"),
        *[F.count_if(~holds(sql)).alias(name) for name, sql in rules.items()],
    ]


def expect(df: DataFrame, rules: Mapping[str, str], observation: Observation | str) -> DataFrame:
    """Keep all rows and count violations.

    Pass an ``Observation`` for batch data, a name for streams; a stream reports the counts per
    batch in ``recentProgress[*].observedMetrics[name]``.
    """
    return df.observe(observation, *violation_counts(rules)) if rules else df


def expect_or_drop(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Keep rows for which all rules hold."""
    return df.where(all_hold(rules)) if rules else df


def expect_or_fail(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Abort the job at the first row that breaks a rule; the message names the rule."""
    for name, sql in rules.items():
        df = df.where(fail_unless(holds(sql), f"rule {name} failed: {sql}"))
    return df


def quarantined(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Rows matching all quarantine rules. They also stay in the main table."""
    return df.where(all_hold(rules))


def split(df: DataFrame, rules: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """(good, bad): rows for which all rules hold, and the others. Every row is in one of them."""
    good = all_hold(rules)
    return df.where(good), df.where(~good)


def apply_rules(df: DataFrame, rules: Rules, observation: Observation | str | None = None) -> DataFrame:
    """The main table's rows: warn, then fail, then drop."""
    if rules.warn and observation is not None:
        df = expect(df, rules.warn, observation)
    df = expect_or_drop(expect_or_fail(df, rules.fail), rules.drop)
    return split(df, rules.quarantine)[0] if rules.split and rules.quarantine else df


def quarantine_rows(df: DataFrame, rules: Rules) -> DataFrame:
    """The quarantine table's rows, from the same input as the main table."""
    return split(df, rules.quarantine)[1] if rules.split else quarantined(df, rules.quarantine)


def report(df: DataFrame, rules: Rules) -> DataFrame:
    """Level, rule, rows seen, rows failed: one pass, one row per rule."""
    listed = rules.by_level()
    counts = [F.count_if(~holds(sql)).alias(f"__f{i}") for i, (_, _, sql) in enumerate(listed)]
    lines = [
        F.struct(
            F.lit(level).alias("level"),
            F.lit(name).alias("rule"),
            F.col("__seen").alias("rows_seen"),
            F.col(f"__f{i}").alias("rows_failed"),
        )
        for i, (level, name, _) in enumerate(listed)
    ]
    return df.agg(F.count(F.lit(1)).alias("__seen"), *counts).select(F.inline(F.array(*lines)))
