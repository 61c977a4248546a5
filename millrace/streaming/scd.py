"""SCD tables kept batch by batch, equal to recomputing them from the whole feed.

SCD1 stores the partial aggregate of each key (tombstones included) in hash buckets; a batch is
reduced to one row per key and appended to the buckets it touches; readers merge. Merging commutes, so late and
repeated events need no special care. A bucket is merged and written anew when what was appended to it
reaches a share of its base, so what is written follows the batches. Where nulls are ignored it stores one row per key and sequence,
as a later event may win a tie against one whose values are kept.

SCD2 stores the last event of each key (*open*), closed versions and the event log. All three are only appended to: of the
open rows of a key that of the newest version counts, and a bucket of them is merged and written anew when what was appended
reaches a share of its base. A batch whose events of a key are all newer than the key's last event needs only that last event.
For other keys the log is replayed from the version the oldest new event falls into. The pointer holds the least and
greatest sequence of each bucket of each version of the log, so the replay opens only what reaches back that far; files are
sorted by key and sequence. The closed versions from there on are retracted by a small record instead of being
rewritten; readers apply all retractions of a key in one pass over its versions. What is written follows the batch, and
for late events the part of the history they change.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import null_safe_join, orderable_columns
from millrace.operators import cdc as ops
from millrace.operators.hotkeys import HOT_KEY_ROWS
from millrace.session import empty_frame, materialise
from millrace.specs import Cdc
from millrace.streaming.store import BUCKET, DEFAULT_BUCKETS, VERSION, VersionedStore, bucket_of, check_columns


class Scd1Store(VersionedStore):
    """An SCD1 table. ``schema`` is the feed's."""

    def __init__(
        self, spark: SparkSession, root: str, cdc: Cdc, schema: T.StructType, buckets: int = DEFAULT_BUCKETS
    ):
        super().__init__(spark, root, buckets)
        check_columns(schema.names)
        self.cdc = cdc
        self.schema = schema
        empty = ops.prepare(empty_frame(spark, schema), cdc)
        # where nulls are ignored, the event of each sequence that counts is kept, else one row per key
        self.reduce = ops.scd1_winners if cdc.ignores_nulls() else ops.scd1_partial
        self.state_schema = self.reduce(empty, cdc, schema.names).schema
        self.bound_schema = ops.truncate_bound(empty).schema

    # parts["state"]["by_bucket"]: bucket -> [[version, rows], ...], the base first, then what was appended to it

    def _state(self, pointer: dict, buckets: Sequence[int] | None = None) -> DataFrame:
        """Rows of the buckets, of which several may be of one key."""
        held = pointer["parts"].get("state", {"by_bucket": {}})["by_bucket"]
        paths = [
            f"__v={v}/{BUCKET}={b}"
            for b, versions in held.items()
            for v, _ in versions
            if buckets is None or int(b) in set(buckets)
        ]
        return self.read("state", self.state_schema, paths, f"{BUCKET} int").drop("__v")

    def _rows_of(self, version: int, buckets: Sequence[int]) -> dict[int, int]:
        paths = [f"__v={version}/{BUCKET}={b}" for b in buckets]
        rows = self.read("state", self.state_schema, paths, f"{BUCKET} int")
        return {r[BUCKET]: r["count"] for r in rows.groupBy(BUCKET).count().collect()}

    def _bound(self, pointer: dict) -> DataFrame:
        held = pointer["parts"].get("bound", {"by_version": {}})["by_version"]
        paths = [f"{self.root}/bound/__v={v}" for v in held]
        if not paths:
            return empty_frame(self.spark, self.bound_schema)
        return self.spark.read.schema(self.bound_schema).parquet(*paths)

    def apply(self, batch: DataFrame, batch_id: int, flow: str = "main") -> bool:
        """Take one batch; False if it was taken before."""
        pointer = self.pointer()
        if self.done(pointer, flow, batch_id):
            return False
        following = self.advance(pointer, flow, batch_id)
        version = following["version"]
        rows = ops.prepare(batch, self.cdc)
        partial = self.reduce(rows, self.cdc, self.schema.names)
        partial = partial.withColumn(BUCKET, bucket_of(self.cdc.keys, self.buckets))
        partial = partial.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            counts = {r[BUCKET]: r["count"] for r in partial.groupBy(BUCKET).count().collect()}
            if counts:
                held = following["parts"].setdefault("state", {"by_bucket": {}})["by_bucket"]
                due = [b for b, n in counts.items() if self.due(held.get(str(b), []), n)]
                added = partial.where(~F.col(BUCKET).isin(due)) if due else partial
                if due:
                    both = partial.where(F.col(BUCKET).isin(due)).unionByName(self._state(pointer, due)).drop(BUCKET)
                    merged = self._merge(both).withColumn(BUCKET, bucket_of(self.cdc.keys, self.buckets))
                    added = added.unionByName(merged)
                self.write(added, version, [BUCKET], "state")
                anew = self._rows_of(version, due) if due else {}
                for b, n in counts.items():
                    held[str(b)] = [[version, anew[b]]] if b in anew else [*held.get(str(b), []), [version, n]]
            if self.cdc.apply_as_truncates:
                bounds = self._bound(pointer).unionByName(ops.truncate_bound(rows))
                newest = bounds.agg(F.max("bound").alias("bound"))
                newest.write.mode("overwrite").parquet(f"{self.root}/bound/__v={version}")
                following["parts"]["bound"] = {"by_version": {str(version): []}}
        finally:
            partial.unpersist()
        self.commit(following)
        return True

    def touched_since(self, version: int) -> list[int] | None:
        """The buckets that changed after a version; None for all, where a truncate came."""
        parts = self.pointer()["parts"]
        if any(int(v) > version for v in parts.get("bound", {"by_version": {}})["by_version"]) and self.cdc.apply_as_truncates:
            return None
        held = parts.get("state", {"by_bucket": {}})["by_bucket"]
        return sorted({int(b) for b, versions in held.items() if any(v > version for v, _ in versions)} | self.appended_since(version))

    def table(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """The table as it is now, or some of its buckets, with the rows that were appended."""
        pointer = self.pointer()
        return self.with_appended(self.merged(pointer, buckets), pointer, buckets)

    def merged(self, pointer: dict, buckets: Sequence[int] | None = None) -> DataFrame:
        """What the change feed makes of the table."""
        bound = None
        if self.cdc.apply_as_truncates and "bound" in pointer["parts"]:
            bound = self._bound(pointer).agg(F.max("bound").alias("bound")).scalar()
        return ops.scd1_finish(self._per_key(self._whole(pointer, buckets)), self.cdc, self.schema.names, bound)

    def _whole(self, pointer: dict, buckets: Sequence[int] | None = None) -> DataFrame:
        """The state with one row per key (and sequence, where nulls are ignored): merged if a bucket has more than its base."""
        state = self._state(pointer, buckets).drop(BUCKET)
        held = pointer["parts"].get("state", {"by_bucket": {}})["by_bucket"]
        return self._merge(state) if any(len(versions) > 1 for versions in held.values()) else state

    def _merge(self, states: DataFrame) -> DataFrame:
        if self.cdc.ignores_nulls():
            return ops.scd1_winners(states, self.cdc, self.schema.names)
        return ops.scd1_merge(states, self.cdc)

    def _per_key(self, state: DataFrame) -> DataFrame:
        return ops.scd1_partial(state, self.cdc, self.schema.names) if self.cdc.ignores_nulls() else state

    def expire_tombstones(self, horizon_sql: str) -> None:
        """Forget deleted keys whose last sequence satisfies the predicate on ``seq``.

        An event older than such a delete that still arrives later would bring the key back, so
        choose a horizon beyond which no event is late.
        """
        pointer = self.pointer()
        following = self.advance(pointer)
        old = self._whole(pointer).withColumn(BUCKET, bucket_of(self.cdc.keys, self.buckets))
        gone = F.col(ops.LAST)[ops.DEL] & F.col("__expired")
        marked = self._per_key(old).withColumn("seq", F.col(ops.LAST)[ops.SEQ]).withColumn("__expired", F.expr(horizon_sql))
        expired = marked.where(F.coalesce(gone, F.lit(False))).select(*self.cdc.keys)
        kept = null_safe_join(old, expired, self.cdc.keys, "left_anti")
        self.write(kept, following["version"], [BUCKET], "state")
        written = self.written(following["version"], [BUCKET], "state")
        rows = self._rows_of(following["version"], [int(r[BUCKET]) for r in written])
        following["parts"]["state"] = {"by_bucket": {str(b): [[following["version"], n]] for b, n in rows.items()}}
        self.commit(following)


PART = "__part"
#: Closed versions of a key are dealt to so many tasks when retractions are applied; its retractions go to each.
RETRACT_SLICES = 16


def standing(closed: DataFrame, retractions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``closed`` whose start lies before the from of every retraction of their key with a greater version.

    A running minimum along the versions of a key, the greatest first, instead of a comparison of all with all; the versions of
    one key are dealt to ``RETRACT_SLICES`` tasks.
    """
    columns = [c for c in closed.columns if c != VERSION]
    slices = F.explode(F.sequence(F.lit(0), F.lit(RETRACT_SLICES - 1)))
    least = "__least"
    rows = closed.withColumns(
        {"__slice": F.pmod(F.xxhash64(ops.START), F.lit(RETRACT_SLICES)).cast("int"), "__takes": F.lit(False)}
    ).unionByName(
        retractions.select(*keys, ops.FROM, VERSION).withColumns({"__slice": slices, "__takes": F.lit(True)}),
        allowMissingColumns=True,
    )
    # rows of a version come before its retractions, which do not concern them
    order = W.partitionBy(*keys, "__slice").orderBy(F.col(VERSION).desc(), "__takes")
    marked = rows.withColumn(least, F.min(ops.FROM).over(order.rowsBetween(W.unboundedPreceding, W.currentRow)))
    return marked.where(~F.col("__takes") & (F.col(least).isNull() | (F.col(ops.START) < F.col(least)))).select(*columns)


#: Whole-number measures of a sequence that keep its order, for the zone maps in the pointer.
_ZONES = {
    "date": "unix_date({0})",
    "timestamp": "unix_micros({0})",
    "timestamp_ntz": "unix_date(cast({0} AS date)) * 86400000000L + hour({0}) * 3600000000L + minute({0}) * 60000000L"
    " + cast(extract(SECOND FROM {0}) * 1000000 AS bigint)",
    **{kind: "cast({0} AS bigint)" for kind in ("tinyint", "smallint", "int", "bigint")},
    "string": "{0}",
}


def zone(column: str, rows: DataFrame) -> Column:
    """A value of the column that JSON can hold and that keeps its order (of a struct: its first field), or NULL."""
    kind, text = rows.schema[column].dataType, f"`{column}`"
    while isinstance(kind, T.StructType):
        text, kind = f"{text}.`{kind.names[0]}`", kind.fields[0].dataType
    found = _ZONES.get("string" if isinstance(kind, T.StringType) else kind.simpleString())
    return F.expr(found.format(text)) if found else F.lit(None).cast("bigint")


class Scd2Store(VersionedStore):
    """An SCD2 table. ``schema`` is the feed's."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        cdc: Cdc,
        schema: T.StructType,
        buckets: int = DEFAULT_BUCKETS,
        split_rows: int | None = HOT_KEY_ROWS,
    ):
        super().__init__(spark, root, buckets)
        check_columns(schema.names)
        self.cdc = cdc
        self.schema = schema
        self.columns = schema.names
        self.split_rows = split_rows
        prepared = ops.prepare(empty_frame(spark, schema), cdc).schema
        sequence = prepared[ops.SEQ].dataType
        self.held = ops.held_columns(self.columns, cdc)
        fields = [schema[c] for c in self.held]
        self.event_schema = T.StructType([*fields, prepared[ops.SEQ], prepared[ops.DEL]])
        self.span_schema = T.StructType(
            [
                *fields,
                prepared[ops.DEL],
                *[T.StructField(n, sequence) for n in (ops.START, ops.END, ops.TOP)],
            ]
        )

    # reading ------------------------------------------------------------------------------

    def _open(self, pointer: dict, buckets: Sequence[int] | None = None) -> DataFrame:
        """The last event of each key: of the rows of a key that of the newest version."""
        held = pointer["parts"].get("open", {"by_bucket": {}})["by_bucket"]
        wanted = {b: versions for b, versions in held.items() if buckets is None or int(b) in set(buckets)}
        paths = [f"__v={v}/{PART}=open/{BUCKET}={b}" for b, versions in wanted.items() for v, _ in versions]
        rows = self.read("spans", self.span_schema, paths, f"{PART} string, {BUCKET} int").drop(PART)
        if all(len(versions) == 1 for versions in wanted.values()):
            return rows.drop(VERSION)
        rest = [c for c in rows.columns if c not in (*self.cdc.keys, VERSION)]
        newest = rows.groupBy(*self.cdc.keys).agg(F.max_by(F.struct(*rest), VERSION).alias("__r"))
        return newest.select(*self.cdc.keys, "__r.*").select(*[c for c in rows.columns if c != VERSION])

    def _appended(
        self, pointer: dict, part: str, folder: str, schema: T.StructType, buckets=None, prefix: str = ""
    ) -> DataFrame:
        held = pointer["parts"].get(part, {"by_version": {}})["by_version"]
        if buckets is None:
            paths = [f"__v={v}/{prefix}".rstrip("/") for v in held]
        else:
            paths = [f"__v={v}/{prefix}{BUCKET}={b}" for v, bs in held.items() for b in bs if b in set(buckets)]
        ddl = f"{PART} string, {BUCKET} int" if prefix else f"{BUCKET} int"
        return self.read(folder, schema, paths, ddl).drop(PART)

    def _closed(self, pointer: dict, buckets: Sequence[int] | None = None) -> DataFrame:
        """Closed versions that no later retraction covers."""
        rows = self._appended(pointer, "closed", "spans", self.span_schema, buckets, f"{PART}=closed/")
        if not pointer["parts"].get("retract", {"by_version": {}})["by_version"]:
            return rows.drop(VERSION)
        taken = self._appended(pointer, "retract", "spans", self.span_schema, buckets, f"{PART}=retract/")
        return standing(rows, taken.withColumnRenamed(ops.START, ops.FROM), self.cdc.keys)

    def log_folders(self, pointer: dict, reach: dict[int, object]) -> list[tuple[str, int]]:
        """(folder, rows) of the log that may hold events of a bucket from a point of the sequence on; None is the beginning."""
        held = pointer["parts"].get("log", {"by_version": {}})["by_version"]
        return [
            (f"{VERSION}={v}/{BUCKET}={b}", rows)
            for v, buckets in held.items()
            for b, (_, high, rows) in buckets.items()
            if int(b) in reach and (reach[int(b)] is None or high is None or high >= reach[int(b)])
        ]

    def _log(self, paths: Sequence[str]) -> DataFrame:
        return self.read("log", self.event_schema, paths, f"{BUCKET} int").drop(VERSION)

    def spans(self, pointer: dict, buckets: Sequence[int] | None = None) -> DataFrame:
        return self._closed(pointer, buckets).unionByName(self._open(pointer, buckets)).drop(BUCKET)

    def touched_since(self, version: int) -> list[int]:
        """The buckets that changed after a version: every batch leaves open rows in those."""
        held = self.pointer()["parts"].get("open", {"by_bucket": {}})["by_bucket"]
        return sorted({int(b) for b, versions in held.items() if any(v > version for v, _ in versions)} | self.appended_since(version))

    def table(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """The table as it is now, or some of its buckets, with the rows that were appended."""
        pointer = self.pointer()
        return self.with_appended(self.merged(pointer, buckets), pointer, buckets)

    def merged(self, pointer: dict, buckets: Sequence[int] | None = None) -> DataFrame:
        """What the change feed makes of the table."""
        return ops.scd2_finish(self.spans(pointer, buckets), self.cdc, self.columns)

    # writing ------------------------------------------------------------------------------

    def apply(self, batch: DataFrame, batch_id: int, flow: str = "main") -> bool:
        """Take one batch; False if it was taken before."""
        pointer = self.pointer()
        if self.done(pointer, flow, batch_id):
            return False
        following = self.advance(pointer, flow, batch_id)
        version = following["version"]
        keys = self.cdc.keys
        rows = ops.prepare(batch, self.cdc).select(*self.held, ops.SEQ, ops.DEL)
        rows = rows.withColumn(BUCKET, bucket_of(keys, self.buckets))
        # the log first: what follows reads the batch from there
        self.write(rows, version, [BUCKET], "log", sort=[*orderable_columns(rows, keys), ops.SEQ])
        touched = sorted(int(r[BUCKET]) for r in self.written(version, [BUCKET], "log"))
        if touched:
            self._apply_rows(pointer, following, touched, version)
        self.commit(following)
        return True

    def _apply_rows(self, pointer, following, touched, version) -> None:
        keys = self.cdc.keys
        rows = self._log([f"{VERSION}={version}/{BUCKET}={b}" for b in touched])
        heads = self._open(pointer, touched)
        # one row per key of the batch, combined before the shuffle
        lows = rows.groupBy(*keys, BUCKET).agg(
            F.min(ops.SEQ).alias("__lo"), F.max(ops.SEQ).alias("__hi"), F.count(F.lit(1)).alias("__n")
        )
        known = null_safe_join(lows, heads.drop(BUCKET), keys, "left")
        known = known.persist(StorageLevel.MEMORY_AND_DISK)
        replay = None
        try:
            is_late = F.col(ops.TOP).isNotNull() & (F.col("__lo") <= F.col(ops.TOP))
            measured = self._measure(known, is_late)
            events, count = rows, sum(m["rows"] + m["keys"] for m in measured)
            seeds = known.where(F.col(ops.TOP).isNotNull() & ~is_late)
            seeds = seeds.select(
                *self.held,
                F.col(ops.TOP).alias(ops.SEQ),
                ops.DEL,
                F.when(~F.col(ops.DEL), F.col(ops.START)).alias(ops.FROM),
            )
            late_buckets = [m[BUCKET] for m in measured if m["late"]]
            if late_buckets:
                late = known.where(is_late).select(*keys, BUCKET, "__lo", F.col(ops.START).alias("__open_start"))
                replay = self._replay_points(pointer, late, late_buckets).persist(StorageLevel.MEMORY_AND_DISK)
                folders = self.log_folders(pointer, self._reach(replay, late_buckets))
                count += sum(n for _, n in folders)
                past = null_safe_join(
                    self._log([path for path, _ in folders]).drop(BUCKET), replay.select(*keys, ops.FROM), keys, "inner"
                ).where(F.col(ops.SEQ) >= F.col(ops.FROM))
                events = events.unionByName(past.drop(ops.FROM), allowMissingColumns=True)
            no_start = F.lit(None).cast(self.event_schema[ops.SEQ].dataType)
            work = events.drop(BUCKET).withColumn(ops.FROM, no_start).unionByName(seeds)
            # so few rows hold no hot key; else it is looked for, and what was joined with the log is kept for that
            split = self.split_rows if self.split_rows is not None and count > self.split_rows else None
            if split is not None:
                work = materialise(work, "scd2-work")
            spans = ops.scd2_spans(work, self.cdc, self.columns, split)
            is_open = F.col(ops.END).isNull()
            spans = spans.where(is_open | ~F.col(ops.DEL)).withColumns(
                {
                    PART: F.when(is_open, "open").otherwise("closed"),
                    BUCKET: bucket_of(keys, self.buckets),
                }
            )
            held = following["parts"].setdefault("open", {"by_bucket": {}})["by_bucket"]
            due = [m[BUCKET] for m in measured if self.due(held.get(str(m[BUCKET]), []), m["keys"])]
            if replay is not None:
                # a retraction is stored as a row of its own part that starts where its key's history is made anew
                taken = replay.select(*keys, BUCKET, F.col(ops.FROM).alias(ops.START)).withColumn(PART, F.lit("retract"))
                spans = spans.unionByName(taken, allowMissingColumns=True)
            if due:
                resting = null_safe_join(heads.where(F.col(BUCKET).isin(due)), known.select(*keys), keys, "left_anti")
                count += sum(n for b in due for _, n in held[str(b)])
                spans = spans.unionByName(resting.withColumn(PART, F.lit("open")))
            self.write(spans, version, [PART, BUCKET], "spans", rows=count)
            anew = self._open_rows(version, due) if due else {}
            for m in measured:  # every key of the batch has an open row
                b = m[BUCKET]
                held[str(b)] = [[version, anew[b]]] if b in anew else [*held.get(str(b), []), [version, m["keys"]]]
            log = following["parts"].setdefault("log", {"by_version": {}})["by_version"]
            log[str(version)] = {str(m[BUCKET]): [m["low"], m["high"], m["rows"]] for m in measured}
            written = self.written(version, [PART, BUCKET], "spans")
            for part in ("closed", "retract"):
                self._note(following, part, version, [int(r[BUCKET]) for r in written if r[PART] == part])
        finally:
            known.unpersist()
            if replay is not None:
                replay.unpersist()

    def _measure(self, known: DataFrame, is_late: Column) -> list[dict]:
        """Per bucket of a batch its keys, rows, late keys, and least and greatest sequence: a row per bucket."""
        measured = known.groupBy(BUCKET).agg(
            F.count(F.lit(1)).alias("keys"),
            F.sum("__n").alias("rows"),
            F.count_if(is_late).alias("late"),
            F.min(zone("__lo", known)).alias("low"),
            F.max(zone("__hi", known)).alias("high"),
        )
        return [r.asDict() for r in measured.collect()]

    def _reach(self, replay: DataFrame, buckets: Sequence[int]) -> dict[int, object]:
        """Per bucket the least sequence that a replay begins at."""
        low = replay.groupBy(BUCKET).agg(F.min(zone(ops.FROM, replay)).alias("low")).collect()
        return {**dict.fromkeys(buckets), **{r[BUCKET]: r["low"] for r in low}}

    def _open_rows(self, version: int, buckets: Sequence[int]) -> dict[int, int]:
        paths = [f"{VERSION}={version}/{PART}=open/{BUCKET}={b}" for b in buckets]
        rows = self.read("spans", self.span_schema, paths, f"{PART} string, {BUCKET} int")
        return {r[BUCKET]: r["count"] for r in rows.groupBy(BUCKET).count().collect()}

    def _replay_points(self, pointer, late: DataFrame, buckets: Sequence[int]) -> DataFrame:
        """Per late key the sequence from which its history is made anew: the start of the
        version its oldest new event falls into. Where nulls are ignored a value may come from
        further back, so the whole history of the key is replayed.
        """
        keys = self.cdc.keys
        if self.cdc.ignores_nulls():
            log = self._log([path for path, _ in self.log_folders(pointer, dict.fromkeys(buckets))])
            first = log.groupBy(*keys).agg(F.min(ops.SEQ).alias("__first"))
            points = null_safe_join(late, first, keys, "left")
            return points.select(*keys, BUCKET, F.least("__first", "__lo").alias(ops.FROM))
        starts = self._closed(pointer, buckets).select(*keys, ops.START)
        before = (
            null_safe_join(starts, late.select(*keys, "__lo"), keys, "inner")
            .where(F.col(ops.START) < F.col("__lo"))
            .groupBy(*keys)
            .agg(F.max(ops.START).alias("__before"))
        )
        points = null_safe_join(late, before, keys, "left")
        # the open version, if it began before the new event, is the later of the two
        begun = F.when(F.col("__open_start") < F.col("__lo"), F.col("__open_start"))
        return points.select(
            *keys, BUCKET, F.coalesce(begun, F.col("__before"), F.col("__lo")).alias(ops.FROM)
        )

    @staticmethod
    def _note(following: dict, part: str, version: int, buckets: list[int]) -> None:
        if buckets:
            held = following["parts"].setdefault(part, {"by_version": {}})["by_version"]
            held[str(version)] = sorted(buckets)

    def compact(self) -> None:
        """Rewrite closed versions and the log as one version each; retractions are used up."""
        pointer = self.pointer()
        following = self.advance(pointer)
        version = following["version"]
        held = pointer["parts"].get("log", {"by_version": {}})["by_version"]
        paths = [f"{VERSION}={v}/{BUCKET}={b}" for v, buckets in held.items() for b in buckets]
        self.write(self._closed(pointer).withColumn(PART, F.lit("closed")), version, [PART, BUCKET], "spans")
        log = self._log(paths)
        self.write(log, version, [BUCKET], "log", sort=[*orderable_columns(log, self.cdc.keys), ops.SEQ])
        for part in ("closed", "log", "retract"):
            following["parts"].pop(part, None)
        closed = [int(r[BUCKET]) for r in self.written(version, [PART, BUCKET], "spans")]
        self._note(following, "closed", version, closed)
        zones: dict[str, list] = {}
        for buckets in held.values():
            for b, (low, high, rows) in buckets.items():
                had = zones.setdefault(b, [low, high, 0])
                zones[b] = [
                    None if None in (had[0], low) else min(had[0], low), None if None in (had[1], high) else max(had[1], high), had[2] + rows,
                ]
        if zones:
            following["parts"]["log"] = {"by_version": {str(version): zones}}
        self.commit(following)


def open_store(
    spark: SparkSession, root: str, cdc: Cdc, schema: T.StructType, buckets: int = DEFAULT_BUCKETS
) -> Scd1Store | Scd2Store:
    """The store of the type the settings name."""
    kind = Scd1Store if cdc.scd_type == 1 else Scd2Store
    return kind(spark, root, cdc, schema, buckets)
