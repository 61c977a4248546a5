"""Table scans, as a stream of appended rows or whole."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def table_name(catalog: str | None, database: str | None, table: str) -> str:
    return ".".join(part for part in (catalog, database, table) if part)


def table_scan(
    spark: SparkSession, name: str, options: Mapping[str, str] | None = None, streaming: bool = True
) -> DataFrame:
    """A table by name: appended rows as a stream, or its whole content now."""
    reader = spark.readStream if streaming else spark.read
    return reader.options(**(options or {})).table(name)


def path_scan(
    spark: SparkSession,
    path: str,
    options: Mapping[str, str] | None = None,
    schema=None,
    streaming: bool = True,
) -> DataFrame:
    """A parquet table by its folder. A stream needs a schema; it is taken from the files."""
    options = dict(options or {})
    if not streaming:
        reader = spark.read.options(**options)
        return (reader.schema(schema) if schema is not None else reader).parquet(path)
    schema = schema if schema is not None else spark.read.options(**options).parquet(path).schema
    return spark.readStream.options(**options).schema(schema).parquet(path)


def table_snapshot(
    spark: SparkSession, name: str, version, options: Mapping[str, str] | None = None
) -> tuple[object, DataFrame]:
    """The table's current content as the snapshot of that version."""
    return version, table_scan(spark, name, options, streaming=False)
