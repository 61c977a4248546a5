"""Schemas from DDL text, from a callable, and the schema of an SCD type 2 target."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from millrace.specs import Cdc


def schema_from_ddl(text: str) -> T.StructType:
    """DDL text, in the ``name type`` or the ``name: type`` spelling."""
    return T.StructType.fromDDL(re.sub(r"\s+", " ", text).strip().rstrip(","))


def schema_from_file(spark: SparkSession, path: str) -> T.StructType:
    """DDL text kept in one small file."""
    return schema_from_ddl(spark.read.text(path, wholetext=True).first()["value"])


def resolve_schema(
    spark: SparkSession,
    schema: T.StructType | str | Callable | None,
    path: str | None = None,
) -> T.StructType | None:
    """A ``StructType``, DDL text, ``file:``-free path to a ``.ddl`` file, or ``f(path, spark)``."""
    if schema is None or isinstance(schema, T.StructType):
        return schema
    if callable(schema):
        return schema(path, spark)
    if schema.strip().lower().endswith(".ddl"):
        return schema_from_file(spark, schema.strip())
    return schema_from_ddl(schema)


def scd2_schema(schema: T.StructType, cdc: Cdc) -> T.StructType:
    """Feed schema less the dropped columns, plus the validity columns.

    They take the type of the sequence column; of the first one if there are several.
    """
    names = [f.name for f in schema.fields]
    kept = set(cdc.target_columns(names))
    sequence = cdc.sequence_columns(names)
    result = T.StructType([f for f in schema.fields if f.name in kept])
    if cdc.scd_type == 2 and sequence:
        sequence_type = schema[sequence[0]].dataType
        result = result.add("__START_AT", sequence_type).add("__END_AT", sequence_type)
    return result
