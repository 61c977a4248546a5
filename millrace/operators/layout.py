"""File layout of targets: hive partitions, clustering, z-order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, DataFrameWriter
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import orderable_columns, with_rank
from millrace.specs import Target

CODE_BITS = 62
MOST_CUT_BITS = 12  # cut points are literals of the plan


def _row_hash(df: DataFrame) -> Column:
    return F.xxhash64(*[F.col(c) for c in orderable_columns(df, df.columns)])


def clustered(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Range partitions sorted by the columns.

    The row hash breaks ties between partitions, so a value that holds a large share of the rows
    spans several files instead of one task.
    """
    return df.repartitionByRange(*columns, _row_hash(df)).sortWithinPartitions(*columns)


def _as_number(df: DataFrame, name: str) -> Column | None:
    """A number in the order of the column, for numbers, dates and timestamps."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_micros(F.col(name).cast("timestamp")).cast("double")
    return F.col(name).cast("double") if isinstance(kind, (T.NumericType, T.BooleanType)) else None


def _cuts_of_values(df: DataFrame, name: str, places: int) -> list:
    """At most ``places`` - 1 values that part the column's rows into about equal ranges: the first value of each range
    partition but the first."""
    column = df.select(F.col(name).alias("c")).where("c IS NOT NULL")
    first = column.repartitionByRange(places, "c").groupBy(F.spark_partition_id().alias("p")).agg(F.min("c").alias("c"))
    return sorted(row.c for row in first.collect())[1:]


def ranked(df: DataFrame, columns: Sequence[str], bits: int) -> DataFrame:
    """Add ``__z0``, ``__z1``, ...: the quantile bucket (0 .. 2^bits - 1) each column's value is in.

    Runs one job over the numeric columns for the cut points, and one for each other column, which is compared by
    its whole values; 2^bits - 1 cuts each at most.
    """
    places = 1 << bits
    fractions = F.array(*[F.lit(i / places) for i in range(1, places)])
    numbers = {c: n for c in columns if (n := _as_number(df, c)) is not None}
    found = df.agg(*[F.percentile_approx(n, fractions, F.lit(max(1000, 4 * places))) for n in numbers.values()]).first() if numbers else ()
    cuts = dict(zip(numbers, found))
    for i, c in enumerate(columns):
        if c in numbers:
            bounds = F.array(*[F.lit(float(v)) for v in cuts[c] or ()]).cast("array<double>")
            df = with_rank(df, f"__z{i}", numbers[c], bounds, places)
        else:
            kind = df.schema[c].dataType.simpleString()
            bounds = F.array(*[F.lit(v) for v in _cuts_of_values(df, c, places)]).cast(f"array<{kind}>")
            df = with_rank(df, f"__z{i}", F.col(c), bounds, places)
    return df


def interleave(ranks: Sequence[Column], bits: int) -> Column:
    """The bits of the ranks, highest first and in turns, as one number."""
    code = F.lit(0).cast("long")
    for bit in reversed(range(bits)):
        for rank in ranks:
            taken = F.shiftright(rank, bit).bitwiseAND(F.lit(1)).cast("long")
            code = (code * 2) + taken
    return code


def zorder_bits(columns: int, files: int) -> int:
    """Bits per column: enough that each column alone could part the rows into four times as many ranges as there are
    files, as far as the bits of all columns fit into one number."""
    if columns > CODE_BITS:
        raise ValueError(f"z-order takes at most {CODE_BITS} columns, not {columns}")
    return min(CODE_BITS // columns, MOST_CUT_BITS, max(4, (max(files, 1) - 1).bit_length() + 2))


def zordered(df: DataFrame, columns: Sequence[str], bits: int | None = None, first: Sequence[str] = ()) -> DataFrame:
    """Range partitions along the interleaved bits of the columns, so that each file covers a
    narrow range of all of them; along the columns ``first`` before them.
    """
    if bits is None:
        bits = zorder_bits(len(columns), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    if len(columns) * bits > CODE_BITS:
        raise ValueError(f"{len(columns)} columns of {bits} bits do not fit into {CODE_BITS} bits")
    ranks = [F.col(f"__z{i}") for i in range(len(columns))]
    coded = ranked(df, columns, bits).withColumn("__z", interleave(ranks, bits))
    return (
        coded.repartitionByRange(*first, "__z", _row_hash(df))
        .sortWithinPartitions(*first, "__z")
        .drop("__z", *[f"__z{i}" for i in range(len(columns))])
    )


def arranged(df: DataFrame, target: Target, first: Sequence[str] = ()) -> DataFrame:
    """Rows in the order the target's layout asks for, within the values of the columns ``first``.

    Hive partitions get a rebalance: few files per partition value, while adaptive execution
    splits a value that is too large for one task.
    """
    if target.zorder_by:
        return zordered(df, target.zorder_by, first=first)
    if target.cluster_by:
        return clustered(df, [*first, *target.cluster_by])
    if target.partition_by or first:
        return df.hint("rebalance", *[F.col(c) for c in (*first, *target.partition_by)])
    return df


def writer(df: DataFrame, target: Target, first: Sequence[str] = ()) -> DataFrameWriter:
    """A writer in the target's layout, whose partition columns come after the columns ``first``."""
    out = arranged(df, target, first).write.format("parquet")
    parts = [*first, *target.partition_by]
    return out.partitionBy(*parts) if parts else out
