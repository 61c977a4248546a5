"""SimHash near duplicates through a Gray-order hierarchical index.

Fingerprints. ASCII capitals become small letters; words are runs of anything but the six ASCII spaces; shingles are three
words (the whole sequence if there are fewer), repeats included, joined by a space. A bit of the fingerprint is 1 if it is
set in more than half of the shingles' XXH64 (seed 42). A text without words has fingerprint zero.

Candidates. Two fingerprints that differ in at most ``distance`` bits agree wholly in at least ``BLOCKS - distance`` of
``BLOCKS`` blocks of bits. So distinct fingerprints are dealt out once for each choice of that many blocks, by the bits there,
and every linked pair meets in some group. A group of more than ``most`` fingerprints is sorted by Gray rank on Spark and cut into runs of
half as many. A run's agreed bits stand for it in the same tree as below, which finds the pairs of runs that may hold linked fingerprints;
each such pair is a group of its own. So no group grows with the input, however many fingerprints lie close together, and what is done
does not depend on how dense they are: there is one round.

Index. A task sorts the fingerprints of its groups by Gray rank and builds a tree over each group: a node covers a run of the
order, and holds the bits on which all below it agree, as a mask and their pattern. The group is joined with itself by walking
pairs of nodes from the top: the differences that a pair's agreed bits accumulate bound the distance of all pairs below,
so whole groups are pruned at once. Pairs of nodes that are connected already are pruned as well.
What leaves a task is a forest that connects what is linked, at most a row per fingerprint and group, never all pairs.

Components. The forests are joined into components by hooking each label to the smallest beside it and halving
paths, with a written table after each round. ``keep_first`` reads its input twice, so that must be a stable table.

Defined results: NULL and empty texts have fingerprint zero and are linked like any other. Equal fingerprints are linked.
Repeated rows each get a row. A NULL doc_id is never the smallest; a component of such rows alone has NULL. Extra columns
are not returned by ``components`` and pass through ``keep_first``, which keeps of equal smallest rows one.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import fresh_name, map_batches, table
from millrace.session import materialise

SHINGLE = 3
SEED = 42
DISTANCE = 3
BLOCKS = 4
MOST = 1 << 14
FAN = 8


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = min(shingle, len(words)) - 1
    hashes = [xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts[: len(words) - last].tolist(), ends[last:].tolist())]
    bits = np.zeros(64, np.int64)
    for begin in range(0, len(hashes), 1 << 14):
        part = np.array(hashes[begin : begin + (1 << 14)], "<u8")
        bits += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and fingerprint (the 64 bits as a signed long) of every row."""

    def read(batches):
        for batch in batches:
            codes = np.array([fingerprint(t) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(codes)], names=["doc_id", "fingerprint"])

    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`"))
    return map_batches(rows, read, "doc_id long, fingerprint long")


# ---- dealing out ------------------------------------------------------------------------------------------------


def split_bits(free: int, blocks: int = BLOCKS) -> list[int]:
    """Masks that part the set bits of ``free`` into blocks of nearly equal size, high bits first."""
    places = [i for i in range(63, -1, -1) if free >> i & 1]
    cuts = [len(places) * k // blocks for k in range(blocks + 1)]
    return [sum(1 << p for p in places[a:b]) for a, b in zip(cuts, cuts[1:])]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _shared_masks(fixed: int, distance: int, blocks: int) -> list[int]:
    """The fixed bits with each choice of blocks of the other bits that a linked pair may wholly share."""
    parts = split_bits(~fixed & (1 << 64) - 1, blocks)
    return [fixed | sum(chosen) for chosen in combinations(parts, blocks - distance)]


def groups(codes: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS, most: int = MOST) -> DataFrame:
    """code, mask, key: every pair of distinct codes within the distance shares a (mask, key), and no group has more than ``most`` codes."""
    if most < 1 << blocks:
        raise ValueError("a group must hold as many codes as one bit per block can make")
    masks = F.array(*[F.lit(_signed(m)).cast("long") for m in _shared_masks(0, distance, blocks)])
    dealt = codes.select("code", F.explode(masks).alias("mask")).withColumn("key", F.col("code").bitwiseAND(F.col("mask")))
    sizes = dealt.groupBy("mask", "key").agg(F.count("*").alias("n")).where(F.col("n") > most)
    large = materialise(sizes.select("mask", "key"), "simhash-large")
    if large.isEmpty():
        return dealt
    small = dealt.join(large, ["mask", "key"], "left_anti").select("code", "mask", "key")
    return small.unionByName(run_pairs(dealt.join(large, ["mask", "key"], "left_semi"), distance, most))


def run_pairs(dealt: DataFrame, distance: int, most: int) -> DataFrame:
    """code, mask, key of large groups, where mask and key are the numbers of two runs of a group (below zero, so that they are no bits)."""
    rank = F.col("code")
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    ordered = dealt.select("code", "mask", "key", rank.alias("rank"))
    ordered = ordered.repartitionByRange("mask", "key", "rank").sortWithinPartitions("mask", "key", "rank").drop("rank")
    half = most // 2

    def cut(batches):
        run, held, last = (TaskContext.get().partitionId() + 1) << 32, 0, None
        for batch in batches:
            mask, key = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            runs = np.empty(batch.num_rows, np.int64)
            edges = np.flatnonzero((mask[1:] != mask[:-1]) | (key[1:] != key[:-1])) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
                if a == b:
                    continue
                if (mask[a], key[a]) != last:
                    run, held, last = run + 1, 0, (mask[a], key[a])
                number = held + np.arange(b - a)
                runs[a:b] = run + number // half
                run, held = run + (held + b - a) // half, (held + b - a) % half
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(-runs)], names=["code", "mask", "key", "run"])

    runs = materialise(map_batches(ordered, cut, "code long, mask long, key long, run long"), "simhash-runs")
    agreed = runs.groupBy("mask", "key", "run").agg(F.bit_and("code").alias("all"), F.bit_or("code").alias("any"))
    # a row per run: a group is here a small part of itself
    pairs = agreed.groupBy("mask", "key").applyInArrow(lambda rows: _near_runs(rows, distance), "run long, a long, b long")
    return runs.select("run", "code").join(pairs, "run").select("code", F.col("a").alias("mask"), F.col("b").alias("key"))


def _near_runs(rows: pa.Table, distance: int) -> pa.Table:
    """The pairs (a, b) of runs of a group whose agreed bits differ in at most ``distance`` places, a row for each of both; a run is
    paired with itself as well."""
    run = rows.column("run").to_numpy()
    low, high = (rows.column(c).to_numpy().view(np.uint64) for c in ("all", "any"))
    mask, pattern = ~(low ^ high), low
    order = np.argsort(gray_rank(pattern), kind="stable")
    run = run[order]
    a, b = near_pairs(build_levels(pattern[order], np.array([0, len(run)]), mask[order]), distance)
    first, second = np.minimum(run[a], run[b]), np.maximum(run[a], run[b])
    apart = first != second
    return pa.table(
        {
            "run": np.concatenate((first, second[apart])),
            "a": np.concatenate((first, first[apart])),
            "b": np.concatenate((second, second[apart])),
        }
    )


# ---- the index --------------------------------------------------------------------------------------------------


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in the order in which neighbours differ in one bit."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class Forest:
    """Disjoint sets of positions, joined in bulk; a root is the smallest position of its set."""

    def __init__(self, size: int):
        self.root = np.arange(size)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        root = self.root
        while len(a):
            a, b = root[a], root[b]
            apart = a != b
            if not apart.any():
                break
            a, b = a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while True:
                above = root[root]
                if (above == root).all():
                    break
                root[:] = above


class Level:
    """Nodes over runs of the order: first and last position, agreed bits, and where their children begin."""

    def __init__(self, starts: np.ndarray, ends: np.ndarray, mask: np.ndarray, pattern: np.ndarray, child: np.ndarray, children: np.ndarray):
        self.starts, self.ends, self.mask, self.pattern, self.child, self.children = starts, ends, mask, pattern, child, children


def build_levels(codes: np.ndarray, bounds: np.ndarray, full: np.ndarray | None = None) -> list[Level]:
    """Levels from the codes up to one node per group; ``bounds`` are the group edges over the sorted codes, ``full`` the bits that count
    of each code (all, if not given)."""
    size = len(codes)
    if full is None:
        full = np.full(size, np.uint64(0xFFFFFFFFFFFFFFFF))
    places = np.arange(size)
    levels = [Level(places, places + 1, full, codes, places, np.zeros(size, np.int64))]
    counts = np.diff(bounds)
    while (counts > 1).any():
        below = levels[-1]
        edges = np.concatenate(([0], np.cumsum(counts)))
        made = (counts + FAN - 1) // FAN
        first = np.repeat(edges[:-1], made) + FAN * (np.arange(made.sum()) - np.repeat(np.cumsum(made) - made, made))
        last = np.minimum(first + FAN, np.repeat(edges[1:], made))
        low = np.bitwise_and.reduceat(below.pattern | ~below.mask, first)  # ones that all have
        high = np.bitwise_or.reduceat(below.pattern & below.mask, first)  # ones that any has
        agreed = np.bitwise_and.reduceat(below.mask, first) & ~(low ^ high)
        levels.append(Level(below.starts[first], below.ends[last - 1], agreed, high & agreed, first, last - first))
        counts = made
    return levels


def _children(level: Level, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of children of pairs of nodes, each unordered pair once."""
    na, nb = level.children[a], level.children[b]
    total = na * nb
    pair = np.repeat(np.arange(len(a)), total)
    place = np.arange(total.sum()) - np.repeat(np.cumsum(total) - total, total)
    left, right = level.child[a][pair] + place // nb[pair], level.child[b][pair] + place % nb[pair]
    once = left <= right
    return left[once], right[once]


def near_pairs(levels: list[Level], distance: int, chunk: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
    """The unordered pairs of leaves (a leaf with itself included) whose agreed bits differ in at most ``distance`` places."""
    top = levels[-1]
    found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
    stack = [(len(levels) - 1, np.arange(len(top.starts)), np.arange(len(top.starts)))]
    while stack:
        height, a, b = stack.pop()
        if len(a) > chunk:
            stack.extend((height, a[k : k + chunk], b[k : k + chunk]) for k in range(0, len(a), chunk))
            continue
        level = levels[height]
        near = np.bitwise_count((level.pattern[a] ^ level.pattern[b]) & level.mask[a] & level.mask[b]) <= distance
        a, b = a[near], b[near]
        if height == 0:
            found.append((a, b))
        elif len(a):
            stack.append((height - 1, *_children(level, a, b)))
    return tuple(np.concatenate(c) for c in zip(*found))


def link_groups(codes: np.ndarray, bounds: np.ndarray, distance: int, chunk: int = 1 << 18) -> np.ndarray:
    """For codes sorted by Gray rank within groups: the smallest position each is connected to within its group."""
    forest = Forest(len(codes))
    if len(codes) < 2:
        return forest.root
    inner = np.ones(len(codes) - 1, bool)
    inner[bounds[1:-1] - 1] = False
    beside = np.flatnonzero(inner & (np.bitwise_count(codes[1:] ^ codes[:-1]) <= distance))
    forest.join(beside, beside + 1)
    levels = build_levels(codes, bounds)
    top = levels[-1]
    stack = [(len(levels) - 1, np.arange(len(top.starts)), np.arange(len(top.starts)))]
    while stack:
        height, a, b = stack.pop()
        if len(a) > chunk:
            stack.extend((height, a[k : k + chunk], b[k : k + chunk]) for k in range(0, len(a), chunk))
            continue
        level = levels[height]
        near = np.bitwise_count((level.pattern[a] ^ level.pattern[b]) & level.mask[a] & level.mask[b]) <= distance
        a, b = a[near], b[near]
        if height == 0:
            apart = a != b
            forest.join(a[apart], b[apart])
            continue
        # pairs of nodes that lie in one component need no further look
        root = forest.root
        low = np.minimum.reduceat(root, level.starts)
        high = np.maximum.reduceat(root, level.starts)
        open_pairs = (low[a] != low[b]) | (low[a] != high[a]) | (low[b] != high[b])
        a, b = a[open_pairs], b[open_pairs]
        if not len(a):
            continue
        stack.append((height - 1, *_children(level, a, b)))
    return forest.root


def _link_task(batches, distance: int, rows_at_once: int):
    """Forests of whole groups, read in order of (mask, key)."""

    def forests(code, mask, key):
        order = np.lexsort((gray_rank(code), key, mask))
        code, mask, key = code[order], mask[order], key[order]
        bounds = np.concatenate(([0], np.flatnonzero((mask[1:] != mask[:-1]) | (key[1:] != key[:-1])) + 1, [len(code)]))
        root = link_groups(code, bounds, distance)
        linked = np.flatnonzero(root != np.arange(len(code)))
        pairs = np.unique(np.stack([code[linked].view(np.int64), code[root[linked]].view(np.int64)], axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[:, 0])), pa.array(np.ascontiguousarray(pairs[:, 1]))], names=["a", "b"])

    held: list[list[np.ndarray]] = []
    size = 0
    for batch in batches:
        held.append([batch.column(i).to_numpy().astype(np.int64) for i in range(3)])
        size += batch.num_rows
        if size >= rows_at_once:
            code, mask, key = (np.concatenate(c) for c in zip(*held))
            # the last group may go on in the next batch
            others = np.flatnonzero((mask != mask[-1]) | (key != key[-1]))
            cut = int(others[-1]) + 1 if len(others) else 0
            if cut:
                yield forests(code[:cut].view(np.uint64), mask[:cut], key[:cut])
            held, size = [[code[cut:], mask[cut:], key[cut:]]], len(code) - cut
    if size:
        code, mask, key = (np.concatenate(c) for c in zip(*held))
        yield forests(code.view(np.uint64), mask, key)


def links(codes: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS, most: int = MOST, rows_at_once: int = 1 << 17) -> DataFrame:
    """a, b: pairs of distinct codes that connect exactly what chains of pairs within the distance connect."""
    dealt = groups(codes, distance, blocks, most).repartition("mask", "key").sortWithinPartitions("mask", "key")
    return map_batches(dealt, lambda batches: _link_task(batches, distance, rows_at_once), "a long, b long")


# ---- components -------------------------------------------------------------------------------------------------


def connect(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node that each node of an edge is connected to.

    Every round takes each label to the smallest label beside it and then to that one's own label; edges within a label
    are dropped, so the work shrinks with what is still apart.
    """
    edges = materialise(edges.distinct(), "edges")
    labels = materialise(
        edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().withColumn("root", F.col("node")), "labels"
    )
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy(F.col("a").alias("root")).agg(F.min("b").alias("near"))
        least = least.select("root", F.least("root", "near").alias("to"))
        above = least.select(F.col("root").alias("to"), F.col("to").alias("top"))
        hooks = materialise(
            least.join(above, "to", "left").select("root", F.coalesce("top", "to").alias("to")), "hooks"
        )
        labels = materialise(
            labels.join(hooks, "root", "left").select("node", F.coalesce("to", "root").alias("root")), "labels"
        )
        left = hooks.select(F.col("root").alias("a"), F.col("to").alias("x"))
        right = hooks.select(F.col("root").alias("b"), F.col("to").alias("y"))
        edges = materialise(
            edges.join(left, "a").join(right, "b").where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(),
            "edges",
        )
    return labels


def components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", distance: int = DISTANCE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id."""
    rows = materialise(fingerprints(docs, doc_id, text), "fingerprints")
    classes = materialise(
        rows.groupBy(F.col("fingerprint").alias("code")).agg(F.min("doc_id").alias("first")), "codes"
    )
    roots = connect(links(classes.select("code"), distance)).withColumnRenamed("node", "code")
    rooted = classes.join(roots, "code", "left").withColumn("root", F.coalesce("root", "code"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(smallest, "root").select(F.col("code").alias("fingerprint"), "component_id")
    return rows.join(named, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_first(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """One document of each component, the one with the smallest id (of equal ids, one row)."""
    row = fresh_name("row", docs.columns)
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    kept = materialise(
        components(numbered.select(F.col(row).alias("doc_id"), "text"), distance=distance).select("doc_id", "component_id"), "members"
    )
    ids = numbered.select(F.col(row).alias("doc_id"), F.col("doc_id").alias("id"))
    order = F.struct(F.col("id").isNull(), "id", "doc_id")
    first = kept.join(ids, "doc_id").groupBy("component_id").agg(F.min(order).alias("o")).select(F.col("o.doc_id").alias(row))
    return numbered.join(first, row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


def op2_simhash(spark, sf_dir):
    return components(table(spark, sf_dir, "documents"))
