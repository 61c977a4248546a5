"""Ordered per-key work that does not pin a hot key to one task.

A window partitioned by a key sorts all rows of that key in one task. When one key holds a large
share of the rows that task never ends. Here such keys are found first (from a sample of the key
columns), and their rows are cut along the sequence into slices of roughly equal size.
Windows then run per (key, slice); what a slice needs to know of its neighbours is aggregated per
slice, rolled along the few slices of the key, and joined back. Cut points come from a hash
sample, so they only affect balance: results are exact wherever the cuts fall.

All other keys keep the plain plan of one shuffle; without any hot key that is the whole plan.

The cuts of hot keys are sent to every executor, after their bytes were counted. Where they are too many, or a key needs more slices
than a row can look up, no row is joined with its key: all rows are dealt by ranges of key and sequence, and the slices of a
key are the ranges that it spans.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.columns import null_safe_join, with_rank
from millrace.session import materialise

SLICE = "__slice"
CUTS = "__cuts"
# A number that stands for a hot key: never NULL, so joins and windows share one partitioning.
HOT = "__hot"

# A key above about this many rows is cut; one task sorts this many rows of a few hundred bytes well.
HOT_KEY_ROWS = 2_000_000
# Most slices per key, a power of two; with the sample below it bounds the cut arrays.
MAX_SLICES = 4096
SAMPLES_PER_SLICE = 16
# How often a key at the threshold shows in the sample that looks for hot keys.
SAMPLED_ROWS = 200
# The cut table is sent to every executor up to this many keys, cuts and bytes of text.
BROADCAST_KEYS = 10_000
BROADCAST_CUTS = 1_000_000
BROADCAST_BYTES = 32 << 20


@dataclass(frozen=True)
class KeyOrder:
    """How rows are grouped and ordered: by their key columns, or by hot key and slice."""

    keys: tuple[str, ...]
    order: tuple[str, ...]
    sliced: bool = False

    @property
    def group(self) -> list[str]:
        return [HOT, SLICE] if self.sliced else list(self.keys)

    def window(self) -> WindowSpec:
        return W.partitionBy(*self.group).orderBy(*self.order)

    def running(self) -> WindowSpec:
        return self.window().rowsBetween(W.unboundedPreceding, W.currentRow)

    def from_other_slices(
        self,
        rows: DataFrame,
        summaries: Mapping[str, Column],
        rolled: Mapping[str, Callable[[WindowSpec], Column]],
    ) -> DataFrame:
        """Add to each row what the other slices of its key say.

        ``summaries`` aggregate one slice, combining before the shuffle; ``rolled`` turn them into
        columns by a window over the slices of a key (at most ``MAX_SLICES`` rows). The result, one
        row per slice, is written out first: the planner then knows its size when it chooses the
        join, and slices are not worked out again.
        """
        per_slice = rows.groupBy(*self.group).agg(*[c.alias(name) for name, c in summaries.items()])
        along = W.partitionBy(HOT).orderBy(SLICE)
        carry = per_slice.select(*self.group, *[f(along).alias(name) for name, f in rolled.items()])
        return rows.join(materialise(carry, "slices"), self.group, "left")


def large_keys(rows: DataFrame, keys: Sequence[str], threshold: int) -> DataFrame | None:
    """Keys with more than about ``threshold`` rows and their row count (``__n``, an estimate), or
    None. Runs a job.

    Counting every key would shuffle as many rows as there are keys. A row sample in which a key
    at the threshold still shows ``SAMPLED_ROWS`` times finds the same keys from a scan of the key
    columns alone. The result has at most about (rows / threshold) rows.
    """
    fraction = min(1.0, SAMPLED_ROWS / threshold)
    seen = rows.select(*keys)
    if fraction < 1.0:
        seen = seen.sample(fraction, seed=1)
    counted = (
        seen.groupBy(*keys)
        .agg((F.count(F.lit(1)) / fraction).cast("long").alias("__n"))
        .where(F.col("__n") > (threshold if fraction == 1.0 else threshold // 2))
        .persist()
    )
    try:
        if counted.count() == 0:
            return None
        # the sample must not be drawn again: what follows has to see one set of keys
        return materialise(counted, "large-keys")
    finally:
        counted.unpersist()


def find_hot_keys(rows: DataFrame, keys: Sequence[str], sequence: str, threshold: int) -> DataFrame | None:
    """Large keys with their cut points, at most MAX_SLICES - 1 each, or None. Runs jobs."""
    hot = large_keys(rows, keys, threshold)
    if hot is None:
        return None
    slices = F.least(F.lit(MAX_SLICES), F.ceil(F.col("__n") / threshold)).cast("int")
    numbers = hot.select(*keys, "__n")
    hot = hot.withColumns(
        {"__k": slices, "__mod": F.greatest(F.lit(1), F.floor(F.col("__n") / (slices * SAMPLES_PER_SLICE)))}
    )
    values = rows.select(*keys, F.col(sequence).alias("__at"))
    sampled = null_safe_join(values, hot, keys, "inner").where(
        F.pmod(F.xxhash64("__at"), F.col("__mod")) == 0
    )
    # collect_set holds at most about MAX_SLICES * SAMPLES_PER_SLICE values of one key
    ranked = sampled.groupBy(*keys, "__k").agg(F.sort_array(F.collect_set("__at")).alias("__s"))
    picked = F.transform(
        F.sequence(F.lit(1), F.greatest(F.col("__k") - 1, F.lit(1))),
        lambda i: F.get("__s", F.floor(i * F.size("__s") / F.col("__k")).cast("int")),
    )
    cuts = ranked.select(*keys, F.array_distinct(F.array_compact(picked)).alias(CUTS))
    # a key of few distinct values may have no sample: it stays hot, without cuts
    numbered = null_safe_join(numbers, cuts, keys, "left")
    return materialise(numbered.withColumn(HOT, F.monotonically_increasing_id()), "hot-cuts")


def slice_by_range(rows: DataFrame, keys: Sequence[str], sequence: str, slices: int) -> DataFrame:
    """All rows with ``HOT`` (the key as a struct, never NULL) and ``SLICE``, the range of key and sequence they fall into; rows with
    equal key and sequence fall into one. No task holds more than about its share of the rows."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) + int(slices)
    dealt = rows.repartitionByRange(parts, *keys, sequence)
    return dealt.withColumns({SLICE: F.spark_partition_id(), HOT: F.struct(*keys)})


def order_by_key(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    threshold: int | None = HOT_KEY_ROWS,
    collapse: Callable[[DataFrame], DataFrame] | None = None,
) -> list[tuple[DataFrame, KeyOrder]]:
    """Rows ready for windows per key, with the grouping to use: all of them, or those of the
    other keys and those of the hot ones.

    The first column of ``order`` is the sequence along which hot keys are cut; equal values stay
    in one slice, so ``collapse`` may first reduce the rows of hot keys that share a value. With
    ``threshold`` None no key is looked at; use it where the rows per key are known to be few.
    """
    plain = KeyOrder(tuple(keys), tuple(order))
    hot = find_hot_keys(rows, keys, order[0], threshold) if threshold is not None else None
    if hot is None:
        return [(rows, plain)]
    size = hot.agg(
        F.count(F.lit(1)).alias("keys"),
        F.coalesce(F.sum(F.size(CUTS)), F.lit(0)).alias("cuts"),
        F.sum(F.length(F.to_json(F.struct(*keys, CUTS)))).alias("bytes"),
        F.ceil(F.max("__n") / threshold).alias("slices"),
        F.ceil(F.sum("__n") / threshold).alias("all_slices"),
    ).first()
    small = size["keys"] <= BROADCAST_KEYS and size["cuts"] <= BROADCAST_CUTS and size["bytes"] <= BROADCAST_BYTES
    if not small or size["slices"] > MAX_SLICES:
        sliced = slice_by_range(rows, keys, order[0], size["all_slices"])
        if collapse is not None:
            sliced = collapse(sliced)
        return [(materialise(sliced, "hot-rows"), KeyOrder(tuple(keys), tuple(order), sliced=True))]
    side = F.broadcast(hot.drop("__n"))
    others = null_safe_join(rows, side.select(*keys), keys, "left_anti")
    held = null_safe_join(rows, side, keys, "inner")
    # ranked right behind the join, so that no row carries the cuts into a shuffle
    sliced = with_rank(held, SLICE, F.col(order[0]), F.col(CUTS), MAX_SLICES).drop(CUTS)
    if collapse is not None:
        sliced = collapse(sliced)
    # read several times below: once per summary of its slices, and for the result
    sliced = materialise(sliced, "hot-rows")
    return [(others, plain), (sliced, KeyOrder(tuple(keys), tuple(order), sliced=True))]
