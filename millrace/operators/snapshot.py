"""A series of full snapshots to an SCD table.

A key names one row of a snapshot; a snapshot where it is NULL or names two rows is refused. So no
key is hot, and a full outer join on the keys is balanced. Before a join the check groups by the
keys (combining before its shuffle), and the join uses that same partitioning.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.columns import fail_unless
from millrace.operators.cdc import END_AT, START_AT
from millrace.operators.tables import require_unique
from millrace.specs import SnapshotCdc


def checked(snapshot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The snapshot; the job fails if a key is NULL or occurs twice."""
    for k in keys:
        snapshot = snapshot.where(fail_unless(F.col(k).isNotNull(), f"NULL key {k} in a snapshot"))
    return require_unique(snapshot, keys)


def _sides(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key with the old and the new row as structs, NULL where there is none."""
    new = checked(new, keys)
    left = old.select(*keys, F.struct(*old.columns).alias("__old"))
    right = new.select(*keys, F.struct(*new.columns).alias("__new"))
    return left.join(right, list(keys), "full_outer")


def _same(tracked: Sequence[str]) -> Column:
    """Both sides exist and agree in the tracked columns, NULL equal to NULL."""
    agree = reduce(
        lambda a, b: a & b,
        [F.col("__old")[c].eqNullSafe(F.col("__new")[c]) for c in tracked],
        F.lit(True),
    )
    return F.col("__old").isNotNull() & F.col("__new").isNotNull() & agree


def diff(old: DataFrame, new: DataFrame, cdc: SnapshotCdc) -> DataFrame:
    """Keys with ``change``: I inserted, U updated, D deleted, N none."""
    tracked = cdc.tracked_columns(new.columns)
    change = (
        F.when(F.col("__old").isNull(), "I")
        .when(F.col("__new").isNull(), "D")
        .when(_same(tracked), "N")
        .otherwise("U")
    )
    return _sides(checked(old, cdc.keys), new, cdc.keys).select(*cdc.keys, change.alias("change"))


def snapshot_scd1(snapshot: DataFrame, cdc: SnapshotCdc) -> DataFrame:
    """SCD1 after a snapshot: keys not in it go, the others are as in it. No join is needed."""
    return checked(snapshot, cdc.keys)


def first_scd2(snapshot: DataFrame, version, cdc: SnapshotCdc) -> DataFrame:
    """The SCD2 table after its first snapshot."""
    snapshot = checked(snapshot, cdc.keys)
    start = version if isinstance(version, Column) else F.lit(version)
    return snapshot.select("*", start.alias(START_AT), F.lit(None).cast(_type_of(snapshot, start)).alias(END_AT))


def _type_of(df: DataFrame, column: Column):
    return df.select(column.alias("v")).schema["v"].dataType


def step_scd2(open_rows: DataFrame, snapshot: DataFrame, version, cdc: SnapshotCdc) -> DataFrame:
    """Open rows and the next snapshot to the rows that replace the open ones.

    Changed: the old row closes at the version, a new one opens. Missing: closes. New: opens.
    Unchanged in the tracked columns: stays open with the snapshot's values. One join; each key
    gives one or two rows.
    """
    columns = snapshot.columns
    tracked = cdc.tracked_columns(columns)
    at_type = open_rows.schema[START_AT].dataType
    at = (version if isinstance(version, Column) else F.lit(version)).cast(at_type)
    nothing = F.lit(None).cast(at_type)

    def row(side: str, start: Column, end: Column) -> Column:
        return F.struct(
            *[F.col(side)[c].alias(c) for c in columns], start.alias(START_AT), end.alias(END_AT)
        )

    old_start = F.col("__old")[START_AT]
    kept = row("__new", old_start, nothing)
    closed = F.when(F.col("__old").isNotNull(), row("__old", old_start, at))
    opened = F.when(F.col("__new").isNotNull(), row("__new", at, nothing))
    rows = F.when(_same(tracked), F.array(kept)).otherwise(F.array_compact(F.array(closed, opened)))
    return _sides(open_rows, snapshot, cdc.keys).select(F.inline(rows))


def snapshot_scd2(table: DataFrame, snapshot: DataFrame, version, cdc: SnapshotCdc) -> DataFrame:
    """The SCD2 table after one more snapshot; closed rows pass through. The table is read twice, so write it out between
    snapshots, or take several at once with ``snapshots_scd2``."""
    closed = table.where(F.col(END_AT).isNotNull())
    stepped = step_scd2(table.where(F.col(END_AT).isNull()), snapshot, version, cdc)
    return closed.unionByName(stepped)


def snapshots_scd2(snapshots: Iterable[tuple[object, DataFrame]], cdc: SnapshotCdc) -> DataFrame:
    """The SCD2 table of several snapshots in one pass: (version, snapshot) in rising order.

    One shuffle for all of them. A key has one row per snapshot at most, so the windows are
    small. A gap in the versions of a key closes its row; a key that comes back opens a new one.
    """
    listed = list(snapshots)
    versions = [v for v, _ in listed]
    if versions != sorted(set(versions)):
        raise ValueError(f"snapshot versions must rise: {versions}")
    columns = listed[0][1].columns
    tracked = cdc.tracked_columns(columns)
    rows = reduce(
        DataFrame.unionByName,
        [df.select(*columns, F.lit(rank).alias("__rank")) for rank, (_, df) in enumerate(listed)],
    )
    for k in cdc.keys:
        rows = rows.where(fail_unless(F.col(k).isNotNull(), f"NULL key {k} in a snapshot"))
    window = W.partitionBy(*cdc.keys).orderBy("__rank")
    # looked up column by column: a struct would be computed and carried before the shuffle
    before = {f"__p{i}": c for i, c in enumerate(["__rank", *tracked])}
    rows = rows.withColumns({name: F.lag(c).over(window) for name, c in before.items()})
    twice = F.coalesce(F.col("__p0") == F.col("__rank"), F.lit(False))
    rows = rows.where(fail_unless(~twice, f"duplicate key in {cdc.keys}"))
    opens = F.col("__p0").isNull() | (F.col("__p0") != F.col("__rank") - 1)
    for i, c in enumerate(tracked):
        opens |= ~F.col(f"__p{i + 1}").eqNullSafe(F.col(c))
    rows = rows.withColumn("__opens", opens).drop(*before)
    running = window.rowsBetween(W.unboundedPreceding, W.currentRow)
    begun = F.when(F.col("__opens"), F.col("__rank"))
    rows = rows.withColumns(
        {"__from": F.last(begun, ignorenulls=True).over(running), "__next": F.lead("__opens").over(window)}
    )
    at = F.array(*[F.lit(v) for v in versions])
    return rows.where(F.coalesce(F.col("__next"), F.lit(True))).select(
        *columns,
        F.get(at, F.col("__from")).alias(START_AT),
        F.get(at, F.col("__rank") + 1).alias(END_AT),
    )


def snapshot_table(snapshots: Iterable[tuple[object, DataFrame]], cdc: SnapshotCdc) -> DataFrame:
    """The SCD table of a series of snapshots, of the type the settings name."""
    if cdc.scd_type == 2:
        return snapshots_scd2(snapshots, cdc)
    *_, (_, newest) = snapshots
    return snapshot_scd1(newest, cdc)
