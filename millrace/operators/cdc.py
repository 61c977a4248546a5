"""Change feed to SCD table.

Contract:

1. Order is ``sequence_by`` (a struct if there are several columns), never arrival. A NULL
   sequence is an error. Of several events of a key with one sequence value the one that is
   greatest in (is a delete, target columns) counts and the others do not exist.
2. ``where`` filters the feed, then rules, then CDC, then the keep or drop list.
3. SCD1: the latest event per key; a key whose latest event is a delete is absent. A truncate
   event clears what has a smaller or equal sequence.
4. SCD2: a version opens at the first event, after a delete, and where tracked columns change;
   equal consecutive events share one version. Untracked columns show the version's last event.
   ``__START_AT`` is the version's first sequence, ``__END_AT`` the next version's or the
   delete's, NULL while open.
5. Where nulls are ignored, a NULL in an update keeps the last value since the last delete.

SCD1 is one aggregation that combines before its shuffle, also with ignored nulls, so hot keys
cost nothing extra. Its partial form can be merged in any order and any number of times, which is
what the streaming runner stores. SCD2 is one shuffle and one sort; see ``hotkeys`` for hot keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import fail_unless, holds, orderable_columns
from millrace.operators.hotkeys import HOT_KEY_ROWS, KeyOrder, order_by_key
from millrace.specs import Cdc, SpecError, clean_columns

SEQ = "__seq"
DEL = "__del"
TRUNC = "__trunc"
FROM = "__from"
LAST = "__last"
GONE = "__gone"
START = "__start"
END = "__end"
TOP = "__top"
START_AT = "__START_AT"
END_AT = "__END_AT"


def _sequence_parts(columns: Sequence[str], cdc: Cdc) -> list[Column]:
    names = cdc.sequence_columns(columns)
    if names:
        return [F.col(n) for n in names]
    if isinstance(cdc.sequence_by, str):
        return [F.expr(cdc.sequence_by)]
    return [F.expr(e) for e in clean_columns(cdc.sequence_by)]


def is_composite(columns: Sequence[str], cdc: Cdc) -> bool:
    return len(_sequence_parts(columns, cdc)) > 1


def prepare(feed: DataFrame, cdc: Cdc) -> DataFrame:
    """The feed after ``where``, with its sequence, delete and truncate marks."""
    missing = [k for k in cdc.keys if k not in feed.columns]
    if missing:
        raise SpecError(f"keys {missing} are not in the feed")
    rows = feed.where(cdc.where) if cdc.where else feed
    parts = _sequence_parts(feed.columns, cdc)
    sequence = F.struct(*[p.alias(f"s{i}") for i, p in enumerate(parts)]) if len(parts) > 1 else parts[0]
    for part in parts:
        rows = rows.where(fail_unless(part.isNotNull(), "NULL in sequence_by"))
    return rows.withColumns(
        {
            SEQ: sequence,
            DEL: holds(cdc.apply_as_deletes) if cdc.apply_as_deletes else F.lit(False),
            TRUNC: holds(cdc.apply_as_truncates) if cdc.apply_as_truncates else F.lit(False),
        }
    )


def held_columns(columns: Sequence[str], cdc: Cdc) -> list[str]:
    """What has to be shuffled and stored of an event beside its marks: the keys and the target
    columns, less the sequence columns, which can be had from the sequence itself.
    """
    again = set(cdc.sequence_columns(columns)) - set(cdc.keys)
    target = cdc.target_columns(columns)
    return [c for c in target if c not in again]


def _restore(columns: Sequence[str], cdc: Cdc, sequence: Column) -> dict[str, Column]:
    """The target's sequence columns, taken from the sequence of the event shown."""
    names = cdc.sequence_columns(columns)
    parts = [sequence] if len(names) == 1 else [sequence[f"s{i}"] for i in range(len(names))]
    held = set(held_columns(columns, cdc))
    return {n: p for n, p in zip(names, parts) if n in cdc.target_columns(columns) and n not in held}


def _greatest(rows: DataFrame, fields: Sequence[str]) -> Column:
    """Aggregate: the struct of ``fields`` that is greatest, comparing in their order."""
    comparable = orderable_columns(rows, fields)
    if len(comparable) == len(fields):
        return F.max(F.struct(*fields))
    return F.max_by(F.struct(*fields), F.struct(*comparable))


# --- SCD type 1 ---------------------------------------------------------------------------


def scd1_winners(rows: DataFrame, cdc: Cdc, columns: Sequence[str]) -> DataFrame:
    """Of events with equal key and sequence the one that counts: the greatest in (is a delete, target columns).

    Merges like ``scd1_partial``: winners of winners are winners. Needed where nulls are ignored, as a value of an
    event that lost its tie must not be kept, and which event loses may show in a later batch only.
    """
    events = rows.where(~F.col(TRUNC))
    values = [c for c in held_columns(columns, cdc) if c not in cdc.keys]
    best = events.groupBy(*cdc.keys, SEQ).agg(_greatest(rows, [DEL, *values]).alias("__w"))
    return best.select(*cdc.keys, SEQ, "__w.*").withColumn(TRUNC, F.lit(False))


def scd1_partial(rows: DataFrame, cdc: Cdc, columns: Sequence[str]) -> DataFrame:
    """One row per key: the latest event and, where nulls are ignored, the latest non-NULL value
    per column with its sequence, and the latest delete. Rows must come from ``prepare``, and where nulls are
    ignored from ``scd1_winners``; ``columns`` are the feed's.
    """
    events = rows.where(~F.col(TRUNC))
    values = [c for c in held_columns(columns, cdc) if c not in cdc.keys]
    aggregates = [_greatest(rows, [SEQ, DEL, *values]).alias(LAST)]
    if cdc.ignores_nulls():
        aggregates.append(F.max(F.when(F.col(DEL), F.col(SEQ))).alias(GONE))
        for c in _null_ignoring(columns, cdc):
            given = F.when(F.col(c).isNotNull() & ~F.col(DEL), F.struct(F.col(SEQ), F.col(c).alias("v")))
            best = F.max(given) if orderable_columns(rows, [c]) else F.max_by(given, given[SEQ])
            aggregates.append(best.alias(f"__v_{c}"))
    return events.groupBy(*cdc.keys).agg(*aggregates)


def _null_ignoring(columns: Sequence[str], cdc: Cdc) -> list[str]:
    held = set(held_columns(columns, cdc))
    return [c for c in cdc.null_ignoring_columns(columns) if c in held]


def scd1_merge(states: DataFrame, cdc: Cdc) -> DataFrame:
    """Partial rows of the same keys into one; associative, commutative, idempotent."""

    def best(name: str) -> Column:
        if orderable_columns(states, [name]):
            return F.max(name).alias(name)
        return F.max_by(name, F.col(name)[SEQ]).alias(name)

    return states.groupBy(*cdc.keys).agg(*[best(c) for c in states.columns if c not in cdc.keys])


def truncate_bound(rows: DataFrame) -> DataFrame:
    """One row: the greatest truncate sequence, or NULL."""
    return rows.where(TRUNC).agg(F.max(SEQ).alias("bound"))


def scd1_finish(state: DataFrame, cdc: Cdc, columns: Sequence[str], bound: Column | None = None) -> DataFrame:
    """The table from merged partial rows. ``columns`` are the feed's, in feed order."""
    last = F.col(LAST)
    live = state.where(~last[DEL])
    if bound is not None:
        live = live.where(bound.isNull() | (last[SEQ] > bound))
    keeping = set(_null_ignoring(columns, cdc))
    restored = _restore(columns, cdc, last[SEQ])

    def value(c: str) -> Column:
        if c in cdc.keys:
            return F.col(c)
        if c in restored:
            return restored[c].alias(c)
        if c not in keeping:
            return last[c].alias(c)
        kept = F.col(f"__v_{c}")
        alive = F.col(GONE).isNull() | (kept[SEQ] > F.col(GONE))
        if bound is not None:
            alive &= bound.isNull() | (kept[SEQ] > bound)
        return F.when(alive, kept["v"]).alias(c)

    return live.select(*[value(c) for c in cdc.target_columns(columns)])


def scd1(feed: DataFrame, cdc: Cdc) -> DataFrame:
    """The current state per key: C1-C3 and C8-C15 in one aggregation, two where nulls are ignored."""
    rows = prepare(feed, cdc)
    bound = truncate_bound(rows).scalar() if cdc.apply_as_truncates else None
    if cdc.ignores_nulls():
        rows = scd1_winners(rows, cdc, feed.columns)
    return scd1_finish(scd1_partial(rows, cdc, feed.columns), cdc, feed.columns, bound)


# --- SCD type 2 ---------------------------------------------------------------------------


def _one_event_per_sequence(rows: DataFrame, keyed: KeyOrder) -> DataFrame:
    """Of rows with equal key and sequence keep the last in order."""
    following = F.lead(SEQ).over(keyed.window())
    superseded = F.coalesce(following == F.col(SEQ), F.lit(False))
    return rows.withColumn("__super", superseded).where("NOT __super").drop("__super")


_SLICES_BEFORE = (-(2**31), -1)


def _last_before(name: str):
    """Rolled over the slices of a key: the last value found in earlier slices."""
    return lambda along: F.last(name, ignorenulls=True).over(along.rowsBetween(*_SLICES_BEFORE))


def _fill_nulls(rows: DataFrame, keyed: KeyOrder, columns: Sequence[str]) -> DataFrame:
    """Each NULL takes the last value since the last delete of its key."""
    if not columns:
        return rows
    running = keyed.running()
    given = {
        c: F.when(F.col(c).isNotNull() & ~F.col(DEL), F.struct(F.col(SEQ).alias("at"), F.col(c).alias("v")))
        for c in columns
    }
    gone = F.when(F.col(DEL), F.col(SEQ))
    marks = {f"__h_{c}": F.last(g, ignorenulls=True).over(running) for c, g in given.items()}
    rows = rows.withColumns({**marks, "__g": F.last(gone, ignorenulls=True).over(running)})
    if keyed.sliced:
        summaries = {f"__c_{c}": F.max_by(g, F.when(g.isNotNull(), F.col(SEQ))) for c, g in given.items()}
        summaries["__cg"] = F.max(gone)
        rows = keyed.from_other_slices(rows, summaries, {name: _last_before(name) for name in summaries})
        merged = {f"__h_{c}": F.coalesce(F.col(f"__h_{c}"), F.col(f"__c_{c}")) for c in columns}
        rows = rows.withColumns({**merged, "__g": F.coalesce(F.col("__g"), F.col("__cg"))})
        rows = rows.drop("__cg", *[f"__c_{c}" for c in columns])

    def filled(c: str) -> Column:
        kept = F.col(f"__h_{c}")
        alive = F.col("__g").isNull() | (kept["at"] > F.col("__g"))
        return F.when(F.col(c).isNull() & alive, kept["v"]).otherwise(F.col(c))

    return rows.withColumns({c: filled(c) for c in columns}).drop(
        "__g", *[f"__h_{c}" for c in columns]
    )


def scd2_spans(
    rows: DataFrame, cdc: Cdc, columns: Sequence[str], split_rows: int | None = HOT_KEY_ROWS
) -> DataFrame:
    """The last row of every version and every delete, with START, END and TOP sequences.

    ``rows`` come from ``prepare`` and have the held columns of the feed's ``columns``; a row with
    FROM set stands for a stored version that began there. TOP is the sequence of the version's
    last event.
    """
    if FROM not in rows.columns:
        rows = rows.withColumn(FROM, F.lit(None).cast(rows.schema[SEQ].dataType))
    keys = cdc.keys
    held = held_columns(columns, cdc)
    tie = [c for c in orderable_columns(rows, held) if c not in keys]

    def collapse(hot: DataFrame) -> DataFrame:
        rest = [c for c in hot.columns if c not in (*keys, SEQ)]
        best = F.max_by(F.struct(*rest), F.struct(DEL, *tie)).alias("__r")
        return hot.groupBy(*keys, SEQ).agg(best).select(*keys, SEQ, "__r.*")

    rows = rows.select(*held, SEQ, DEL, FROM)
    parts = order_by_key(rows, keys, [SEQ, DEL, *tie], split_rows, collapse)
    return reduce(DataFrame.unionByName, [_spans(part, keyed, cdc, columns) for part, keyed in parts])


def _spans(rows: DataFrame, keyed: KeyOrder, cdc: Cdc, columns: Sequence[str]) -> DataFrame:
    held = held_columns(columns, cdc)
    rows = _one_event_per_sequence(rows, keyed)
    rows = _fill_nulls(rows, keyed, _null_ignoring(columns, cdc))

    # a version opens where the row before is missing, a delete, or different. The columns are
    # looked up one by one: a struct of them would be a second copy of each row in the window
    tracked = [c for c in cdc.tracked_columns(columns) if c in set(held)]
    window = keyed.window()
    before = {f"__p{i}": c for i, c in enumerate([SEQ, DEL, *tracked])}
    rows = rows.withColumns({name: F.lag(c).over(window) for name, c in before.items()})
    if keyed.sliced:
        rows = keyed.from_other_slices(
            rows,
            {"__tail": F.max_by(F.struct(*before.values()), F.col(SEQ))},
            {"__cp": lambda along: F.lag("__tail").over(along)},
        )
        first = F.col("__p0").isNull()
        rows = rows.withColumns(
            {name: F.when(first, F.col("__cp")[c]).otherwise(F.col(name)) for name, c in before.items()}
        ).drop("__cp")
    changed = F.col("__p0").isNull() | F.col("__p1") | F.col(DEL)
    for i, c in enumerate(tracked):
        changed |= ~F.col(f"__p{i + 2}").eqNullSafe(F.col(c))
    rows = rows.withColumn("__opens", changed).drop(*before)

    # a version ends where the next row opens one
    begin = F.when(F.col("__opens"), F.coalesce(F.col(FROM), F.col(SEQ)))
    rows = rows.withColumns(
        {
            START: F.last(begin, ignorenulls=True).over(keyed.running()),
            END: F.lead(SEQ).over(window),
            "__next": F.lead("__opens").over(window),
        }
    )
    if keyed.sliced:
        rows = keyed.from_other_slices(
            rows,
            {"__mark": F.max(begin), "__head": F.min_by(F.struct(SEQ, "__opens"), F.col(SEQ))},
            {"__cs": _last_before("__mark"), "__cn": lambda along: F.lead("__head").over(along)},
        )
        rows = rows.withColumns(
            {
                START: F.coalesce(START, "__cs"),
                "__next": F.when(F.col(END).isNull(), F.col("__cn")["__opens"]).otherwise(F.col("__next")),
                END: F.coalesce(F.col(END), F.col("__cn")[SEQ]),
            }
        )
    ends = rows.where(F.col(END).isNull() | F.col("__next"))
    return ends.select(*held, DEL, START, END, F.col(SEQ).alias(TOP))


def scd2_finish(spans: DataFrame, cdc: Cdc, columns: Sequence[str]) -> DataFrame:
    """The table from spans: deletes out, target columns in feed order, validity columns named."""
    composite = is_composite(columns, cdc)
    restored = _restore(columns, cdc, F.col(TOP))

    def point(name: str) -> Column:
        return F.col(name)["s0"] if composite else F.col(name)

    return spans.where(~F.col(DEL)).select(
        *[restored[c].alias(c) if c in restored else F.col(c) for c in cdc.target_columns(columns)],
        point(START).alias(START_AT),
        point(END).alias(END_AT),
    )


def scd2(feed: DataFrame, cdc: Cdc, split_rows: int | None = HOT_KEY_ROWS) -> DataFrame:
    """The history per key: C4-C15. Looks for hot keys first, which runs one small job."""
    return scd2_finish(scd2_spans(prepare(feed, cdc), cdc, feed.columns, split_rows), cdc, feed.columns)


def apply_changes(feed: DataFrame, cdc: Cdc, split_rows: int | None = HOT_KEY_ROWS) -> DataFrame:
    """The SCD table of a whole feed, of the type the settings name."""
    return scd1(feed, cdc) if cdc.scd_type == 1 else scd2(feed, cdc, split_rows)


def current(table: DataFrame) -> DataFrame:
    """Open versions of an SCD2 table."""
    return table.where(F.col(END_AT).isNull())


def as_of(table: DataFrame, at) -> DataFrame:
    """Versions of an SCD2 table valid at a point of its sequence."""
    moment = at if isinstance(at, Column) else F.lit(at)
    return table.where(
        (F.col(START_AT) <= moment) & (F.col(END_AT).isNull() | (moment < F.col(END_AT)))
    )
