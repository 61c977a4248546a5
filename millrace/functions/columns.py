"""Column helpers shared by the operators. All of them stay inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def holds(sql: str) -> Column:
    """A SQL boolean in which NULL counts as false."""
    return F.coalesce(F.expr(sql), F.lit(False))


def fail_unless(condition: Column, message: str) -> Column:
    """True where the condition holds, an error elsewhere.

    Use it inside a filter: as an unused projected column it would be pruned and never run.
    """
    return F.when(condition, F.lit(True)).otherwise(F.raise_error(F.lit(message)).cast("boolean"))


def is_orderable(data_type: T.DataType) -> bool:
    """Whether values of the type can be compared by ``max`` and ``orderBy``."""
    if isinstance(data_type, (T.MapType, T.VariantType)):
        return False
    if isinstance(data_type, T.ArrayType):
        return is_orderable(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return all(is_orderable(f.dataType) for f in data_type.fields)
    return True


def orderable_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    types = {f.name: f.dataType for f in df.schema.fields}
    return [c for c in columns if is_orderable(types[c])]


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on keys where NULL equals NULL; the keys of ``right`` do not appear twice."""
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    condition = None
    for k in keys:
        same = left[k].eqNullSafe(renamed[f"__r_{k}"])
        condition = same if condition is None else condition & same
    joined = left.join(renamed, condition, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"__r_{k}" for k in keys])


def with_rank(df: DataFrame, name: str, value: Column, bounds: Column, places: int) -> DataFrame:
    """Add how many of the ascending ``bounds`` are at or below ``value``: 0 if either is NULL.

    A binary search over up to ``places`` - 1 bounds (a power of two), one plain column per step;
    unlike a lambda over the array, all of it is compiled.
    """
    df = df.withColumn(name, F.lit(0))
    step = places // 2
    while step:
        reached = F.get(bounds, F.col(name) + F.lit(step - 1)) <= value
        df = df.withColumn(name, F.when(reached, F.col(name) + step).otherwise(F.col(name)))
        step //= 2
    return df
