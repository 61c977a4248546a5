"""Relational operators on keyed tables: latest version, guards, upsert, validation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import fail_unless, orderable_columns


def latest_per_key(
    df: DataFrame, keys: Sequence[str], version: str, numeric: bool = False
) -> DataFrame:
    """The row with the highest version per key.

    Versions compare as they are; text versions compare as text, so ``v9`` beats ``v10``. With
    ``numeric`` their runs of digits compare as numbers, one after the other, so ``v1.10`` beats ``v1.9``;
    numbers may be of any length. An aggregate, not a window: it combines before
    the shuffle, so a key with very many versions costs no more than others. Equal versions are
    told apart by the remaining columns.
    """
    others = [c for c in df.columns if c not in keys and c != version]
    rank = F.col(version)
    if numeric:
        runs = F.regexp_extract_all(rank.cast("string"), F.lit("0*([0-9]+)"), F.lit(1))
        # of two numbers without leading zeros the longer is greater
        rank = F.transform(runs, lambda digits: F.struct(F.length(digits).alias("n"), digits.alias("d")))
    ties = orderable_columns(df, [version, *others])
    order = F.struct(rank.alias("__rank"), *ties) if numeric else F.struct(*ties)
    row = F.struct(version, *others)
    # one struct serves as value and as order where every column can be compared
    whole = len(ties) == len(others) + 1
    best = F.max(order) if whole else F.max_by(row, order)
    found = df.groupBy(*keys).agg(best.alias("__row"))
    return found.select(*[c if c in keys else F.col("__row")[c].alias(c) for c in df.columns])


def select_group(
    df: DataFrame,
    group_column: str,
    id_column: str,
    group=None,
    ids: Sequence | None = None,
) -> DataFrame:
    """Rows of a group if one is given, else rows with one of the ids, else all rows."""
    if group is not None:
        return df.where(F.col(group_column) == F.lit(group))
    return df.where(F.col(id_column).isin(*ids)) if ids else df


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same rows; the job fails if a key occurs twice.

    Looks at the row before in the order of the keys. A following join on them needs the same shuffle and the same sort.
    """
    again = F.lag(F.lit(True)).over(Window.partitionBy(*keys).orderBy(*keys))
    marked = df.withColumn("__again", again)
    return marked.where(fail_unless(F.col("__again").isNull(), f"duplicate key in {list(keys)}")).drop("__again")


def join_map_key(left: DataFrame, column: str, right: DataFrame, map_column: str, key: str) -> DataFrame:
    """Inner join of a column with one entry of a map; rows without a partner go.

    No side is forced to broadcast: the planner does it when the size it measures allows.
    """
    # try_element_at: a map without the entry is a row without a partner, not an error
    return left.join(right, left[column] == F.try_element_at(right[map_column], F.lit(key)), "inner")


def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.select(*columns).dropDuplicates() if columns else df.dropDuplicates()


def union_by_position(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, frames)


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; a column missing in one input is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same rows; the job fails where a column is NULL or empty text."""

    def filled(name: str) -> Column:
        return F.col(name).isNotNull() & (F.trim(F.col(name).cast("string")) != "")

    for name in columns:
        df = df.where(fail_unless(F.coalesce(filled(name), F.lit(False)), f"{name} is empty"))
    return df


def count_check(tables: Mapping[str, DataFrame], expected: Mapping[str, tuple[str, int]]) -> DataFrame:
    """Rows per table against an expected count; ``expected`` gives (``=`` or ``>=``, n)."""
    lines = []
    for name, df in tables.items():
        rule, wanted = expected[name]
        count = F.count(F.lit(1))
        passed = count >= wanted if rule == ">=" else count == wanted
        lines.append(
            df.agg(
                F.lit(name).alias("table_name"),
                F.lit(rule).alias("rule"),
                F.lit(wanted).cast("long").alias("expected"),
                count.alias("actual"),
                passed.alias("passed"),
            )
        )
    return union_by_position(lines)


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], protected: Sequence[str] = ()
) -> DataFrame:
    """Target after a keyed merge: matched rows take the source's values except in protected
    columns, unmatched source rows are inserted. The result has the target's columns only.

    A key that occurs twice in the source is an error, as in SQL MERGE.
    """
    columns = target.columns
    missing = [c for c in columns if c not in source.columns]
    if missing:
        raise ValueError(f"source lacks target columns {missing}")
    source = require_unique(source.select(*columns), keys)
    old = target.select(*keys, F.struct(*columns).alias("__old"))
    new = source.select(*keys, F.struct(*columns).alias("__new"))
    joined = old.join(new, list(keys), "full_outer")

    def merged(name: str) -> Column:
        sides = (F.col("__old"), F.col("__new")) if name in protected else (F.col("__new"), F.col("__old"))
        return F.when(sides[0].isNotNull(), sides[0][name]).otherwise(sides[1][name]).alias(name)

    return joined.select(*[merged(c) for c in columns])


def merge_into(source: DataFrame, table: str, keys: Sequence[str], protected: Sequence[str] = ()) -> None:
    """The same merge by the catalog's own MERGE, for table formats that have one."""
    condition = reduce(
        lambda a, b: a & b, [F.col(f"source.{k}") == F.col(f"{table}.{k}") for k in keys]
    )
    assignments = {c: F.col(f"source.{c}") for c in source.columns if c not in protected}
    (
        source.alias("source")
        .mergeInto(table, condition)
        .whenMatched()
        .update(assignments)
        .whenNotMatched()
        .insertAll()
        .merge()
    )
