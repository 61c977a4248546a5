"""The query registry and helpers the queries share."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.session import scratch_path
from millrace.specs import Target
from millrace.streaming.targets import AppendTable, append_stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str):
    """Register ``f(spark, sf_dir)`` under a name, with its SQL."""

    def register(function):
        if name in QUERIES:
            raise ValueError(f"query {name} exists")
        QUERIES[name] = function
        ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def landing(spark: SparkSession, label: str, **layout) -> AppendTable:
    """A fresh append table in the shared folder."""
    return AppendTable(spark, Target(scratch_path(spark, label), **layout))


def land(stream: DataFrame, label: str) -> DataFrame:
    """Run a stream to its end into a fresh table and read that."""
    spark = stream.sparkSession
    target = landing(spark, label)
    append_stream(stream, target, scratch_path(spark, f"{label}-progress"))
    return target.table()


def named_table(df: DataFrame, label: str) -> str:
    """Save a frame as an external table in the shared folder; gives its name."""
    name = f"{label}_{uuid.uuid4().hex[:12]}"
    df.write.option("path", scratch_path(df.sparkSession, label)).format("parquet").saveAsTable(name)
    return name
