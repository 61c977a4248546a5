"""Projection, filter and small reshaping operators."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import null_safe_join, orderable_columns


def select_exprs(df: DataFrame, expressions: Sequence[str] | None) -> DataFrame:
    """A list of SQL expressions; no list keeps all columns."""
    return df.selectExpr(*expressions) if expressions else df


def where_all(df: DataFrame, clauses: Sequence[str] | None) -> DataFrame:
    """Each clause in turn; blank ones count as absent.

    Apply it after ``select_exprs``: a clause may still name a column that was not projected.
    """
    for clause in clauses or ():
        if clause and clause.strip():
            df = df.where(clause)
    return df


def apply_transform(df: DataFrame, function: Callable | None, spec=None) -> DataFrame:
    """A user function ``f(df, spec) -> df``."""
    return df.transform(lambda d: function(d, spec)) if function else df


def fan_out(
    df: DataFrame, branches: Mapping[str, tuple[Sequence[str] | None, Sequence[str] | None]]
) -> dict[str, DataFrame]:
    """One input to many outputs, each with its own select and where lists."""
    return {
        name: where_all(select_exprs(df, select), where) for name, (select, where) in branches.items()
    }


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def keep_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def audit_columns(df: DataFrame, version: str, author: str) -> DataFrame:
    """Version, creation and update stamps."""
    now = F.current_timestamp()
    return df.withColumns(
        {
            "version": F.lit(version),
            "createDate": now,
            "createdBy": F.lit(author),
            "updateDate": now,
            "updatedBy": F.lit(author),
        }
    )


def load_stamps(df: DataFrame, date_column: str, **literals) -> DataFrame:
    """The processing date and literal parameters as columns."""
    return df.withColumns(
        {date_column: F.current_date(), **{name: F.lit(value) for name, value in literals.items()}}
    )


def drop_null_entries(column: Column | str) -> Column:
    """A map without the entries whose value is NULL (top level only)."""
    return F.map_filter(column, lambda _, value: value.isNotNull())


def rows_to_json_array(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    parts: int = 1,
    output: str = "rows_json",
) -> DataFrame:
    """The rows of each key as one JSON array text, ordered by ``order_by``.

    One array is one cell. Where keys have more rows than fit, name the number of parts: every key's rows are
    spread over them by row hash, whatever their number, so the result depends on the data alone. Parts without rows are
    left out; equal rows share a part.
    """
    keys, order_by = list(keys), list(order_by)
    if parts < 1:
        raise ValueError("parts must be at least 1")
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    hashed = F.xxhash64(*[F.col(c) for c in orderable_columns(df, df.columns)])
    parted = df.withColumn("part", F.pmod(hashed, F.lit(parts)).cast("long") if parts > 1 else F.lit(0).cast("long"))
    array = F.sort_array(F.collect_list(F.struct(*order_by, *rest)))
    return parted.groupBy(*keys, "part").agg(F.to_json(array).alias(output))


def add_missing_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of the schema that the data lacks, as typed NULLs; schema order first."""
    have = set(df.columns)
    known = [f.name for f in schema.fields]
    return df.select(
        *[
            F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ],
        *[c for c in df.columns if c not in known],
    )
