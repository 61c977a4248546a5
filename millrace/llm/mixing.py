"""Mixing sources to target weights: hierarchical budgets over a tree of domain, language and source.

A token budget is handed down from the root. A node splits what it gets among its children by their weights; a child can take at most what
it holds (its tokens times the number of epochs allowed, summed over those of its leaves that have weight all the way). What a child cannot take goes to its siblings,
again by weight, and only a subtree that is full as a whole passes a shortage on, so siblings come before ancestors. As a child's limit is known from
its leaves, one pass from the root settles it: at each node the children that are full are those with the least
limit per weight, which a running sum over the sorted children finds.

A leaf with budget b takes its documents in seeded order, epoch after epoch, each epoch in an order of its own: whole epochs first, then the
longest prefix of the next whose tokens fit into the rest. Orders follow the hash of seed, epoch, id and text. The prefix is found in
two steps: documents are counted into buckets by the first digits of their hash, running sums over buckets find the one where the
budget ends, and only in that one are documents sorted. A leaf gets buckets in proportion to its documents, so neither step
meets a large group, however large a leaf.

Defined results: NULL and empty texts have no tokens; they are taken with every epoch that starts and lies within the prefix. NULL domains, languages and
sources are nodes of their own. In the query, a source that does not end in a number (empty, say) falls into one of the four domains by its CRC-32. A child without weight gets ``default_weight``; weights that are zero or less give nothing. Of rows
with equal id and text, which have one place in the order, the prefix takes all or none. An empty table gives no rows. Extra columns pass through.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import fresh_name, table
from millrace.session import materialise

PER_BUCKET = 2_000
SEED = 7

#: The query's tree: the domain of a source is its number by four, which its last two digits give, however many there are; a source without
#: a number at its end has one by its checksum.
DOMAIN_SQL = (
    "concat('d', CAST(coalesce(try_cast(right(regexp_extract(source, '([0-9]+)$', 1), 2) AS INT), crc32(CAST(source AS BINARY))) % 4 AS STRING))"
)
WEIGHTS = {
    ("d0",): 0.4, ("d1",): 0.3, ("d2",): 0.2, ("d3",): 0.1,
    ("*", "en"): 0.4, ("*", "de"): 0.3, ("*", "fr"): 0.2, ("*", "es"): 0.1,
}
EPOCHS = 2
SHARE = 0.8  # budget as a share of all tokens


def tokens_of(text: Column) -> Column:
    """Number of runs of anything but the six ASCII spaces."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def weight_of(level: int, levels: list[str], weights: dict[tuple[str, ...], float], default: float) -> Column:
    """The weight of the node at a level: by its whole path, else by the path with ``*`` for what is above, else the default."""
    chosen = F.lit(default)
    for exact in (False, True):
        for path, weight in weights.items():
            if len(path) != level + 1 or (path[:-1] == ("*",) * level and level > 0) == exact:
                continue
            fits = [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(levels, path) if v != "*"]
            chosen = F.when(reduce(lambda a, b: a & b, fits), F.lit(float(weight))).otherwise(chosen)
    return chosen


def budgets(leaves: DataFrame, levels: list[str], weights: dict, total: float, epochs: int, default: float = 1.0) -> DataFrame:
    """The leaves (levels, tokens) with the column ``budget``: tokens that each is to give of a total."""
    frame = leaves.withColumn("limit", (F.col("tokens") * epochs).cast("double")).withColumn("budget", F.lit(float(total)))
    alive = [weight_of(level, levels, weights, default) > 0 for level in range(len(levels))]
    for level in range(len(levels)):
        path = levels[: level + 1]
        parents = levels[:level]
        # what lies below a node without weight can take nothing
        reached = reduce(lambda a, b: a & b, alive[level + 1 :], F.lit(True))
        nodes = frame.groupBy(*path).agg(F.sum(F.when(reached, F.col("limit")).otherwise(0.0)).alias("room"), F.max("budget").alias("given"))
        weight = F.greatest(weight_of(level, levels, weights, default), F.lit(0.0))
        nodes = nodes.withColumn("weight", F.when(F.col("room") > 0, weight).otherwise(0.0))
        # children with the least room per weight are full as long as the level of what is left reaches their room
        order = Window.partitionBy(*parents).orderBy(F.when(F.col("weight") > 0, F.try_divide("room", "weight")).otherwise(float("inf")), *path)
        before = order.rowsBetween(Window.unboundedPreceding, -1)
        after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
        nodes = nodes.withColumn("left", F.col("given") - F.coalesce(F.sum("room").over(before), F.lit(0.0)))
        nodes = nodes.withColumn("rate", F.try_divide("left", F.sum("weight").over(after)))
        full = (F.col("weight") > 0) & (F.col("room") <= F.col("rate") * F.col("weight"))
        level_rate = F.min(F.when(~full & (F.col("weight") > 0), F.struct(F.try_divide("room", "weight"), *path, "rate"))).over(Window.partitionBy(*parents))["rate"]
        share = F.when(F.col("weight") <= 0, 0.0).when(full, F.col("room")).otherwise(F.least("room", F.col("weight") * level_rate))
        nodes = nodes.select(*path, F.greatest(share, F.lit(0.0)).alias("budget"))
        same = reduce(lambda a, b: a & b, [F.col(f"l.{c}").eqNullSafe(F.col(f"n.{c}")) for c in path])
        frame = frame.drop("budget").alias("l").join(nodes.alias("n"), same).select("l.*", "n.budget")
    return frame


def mix(
    docs: DataFrame,
    levels: dict[str, Column],
    weights: dict,
    share: float = SHARE,
    epochs: int = EPOCHS,
    seed: int = SEED,
    doc_id: str = "doc_id",
    text: str = "text",
    per_bucket: int = PER_BUCKET,
) -> tuple[DataFrame, dict[str, str]]:
    """A row per document and epoch that it is taken in, with the columns of ``docs`` and those named in the mapping
    that comes with it: levels, tokens, epoch (from 0) and leaf_budget."""
    taken = list(docs.columns)
    names = {}
    for wanted in [*levels, "tokens", "epoch", "leaf_budget"]:
        names[wanted] = fresh_name(wanted, taken)
        taken.append(names[wanted])
    row = fresh_name("row", taken)
    lv = [f"level{i}" for i in range(len(levels))]
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    small = materialise(
        numbered.select(
            F.col(row).alias("row"), *[c.alias(n) for c, n in zip(levels.values(), lv)], tokens_of(F.col(f"`{text}`")).alias("tokens"),
            F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).alias("id"), F.md5(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")).alias("body"),
        ),
        "mix-rows",
    )
    leaves = small.groupBy(*lv).agg(F.sum("tokens").cast("double").alias("tokens"), F.count("*").alias("n"))
    whole = small.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("t")).collect()[0].t
    plan = budgets(leaves, lv, weights, min(share, epochs) * whole, epochs)
    full = F.least(F.floor(F.col("budget") / F.greatest("tokens", F.lit(1.0)) + 1e-9), F.lit(epochs)).cast("int")
    plan = materialise(
        plan.select(
            *[F.col(c).alias(f"p_{c}") for c in lv], "budget", F.col("tokens").alias("leaf_tokens"), full.alias("whole"),
            F.greatest(F.lit(1), F.ceil(F.col("n") / per_bucket)).alias("buckets"),
        ).withColumn("rest", F.floor(F.col("budget") - F.col("whole") * F.col("leaf_tokens") + 1e-6).cast("long")),
        "mix-plan",
    )
    leaf = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"p_{c}")) for c in lv])
    placed = small.join(plan, leaf)
    last = F.md5(F.concat_ws("/", F.lit(str(seed)), F.col("whole").cast("string"), F.col("id"), F.col("body")).cast("binary"))
    head = F.conv(F.substring("place", 1, 8), 16, 10).cast("double") / float(1 << 32)
    placed = placed.withColumn("place", last).withColumn("bucket", F.floor(head * F.col("buckets")).cast("long"))
    # running sums over the buckets of a leaf, and within the bucket in which the budget ends
    counted = placed.where("rest > 0 AND whole < " + str(int(epochs))).groupBy(*lv, "rest", "bucket").agg(F.sum("tokens").alias("t"))
    running = counted.withColumn("before", F.coalesce(F.sum("t").over(Window.partitionBy(*lv).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    state = running.select(
        *[F.col(c).alias(f"b_{c}") for c in lv], F.col("bucket").alias("b_bucket"), "before",
        F.when(F.col("before") + F.col("t") <= F.col("rest"), "all").when(F.col("before") > F.col("rest"), "none").otherwise("cut").alias("state"),
    )
    in_bucket = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"b_{c}")) for c in lv]) & (F.col("bucket") == F.col("b_bucket"))
    marked = placed.join(state, in_bucket, "left")
    inside = Window.partitionBy(*lv, "bucket").orderBy("place").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    cut = marked.where("state = 'cut'").withColumn("sum", F.sum("tokens").over(inside)).select("row", "whole", "budget", "tokens", *lv, (F.col("before") + F.col("sum") <= F.col("rest")).alias("more"))
    easy = marked.where("state IS NULL OR state <> 'cut'").select("row", "whole", "budget", "tokens", *lv, F.coalesce(F.col("state") == "all", F.lit(False)).alias("more"))
    times = F.col("whole") + F.col("more").cast("int")
    chosen = cut.unionByName(easy).where(times > 0)
    out = chosen.select(
        F.col("row").alias(row), *[F.col(n).alias(names[w]) for w, n in zip(levels, lv)], F.col("tokens").alias(names["tokens"]),
        F.explode(F.sequence(F.lit(0), times - 1)).alias(names["epoch"]), F.col("budget").alias(names["leaf_budget"]),
    )
    return numbered.join(out, row).drop(row), names


def op7_levels() -> dict[str, Column]:
    return {"domain": F.expr(DOMAIN_SQL), "language": F.col("lang"), "origin": F.col("source")}


def mix_documents(docs: DataFrame) -> DataFrame:
    """The documents chosen, once per epoch, with the columns of ``docs``."""
    mixed, _ = mix(docs, op7_levels(), WEIGHTS)
    return mixed.select(*[F.col(f"`{c}`") for c in docs.columns])


def op7_mixing(spark, sf_dir):
    mixed, n = mix(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"), op7_levels(), WEIGHTS)
    return mixed.select("doc_id", n["domain"], "lang", "source", n["tokens"], n["epoch"], F.round(n["leaf_budget"], 3).alias("leaf_budget"))
