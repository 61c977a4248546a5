"""Benchmark decontamination with a generalised suffix automaton of the test items.

All items go into one automaton over words. Training text is streamed through it word by word; the
state gives the longest suffix read so far that occurs in some item. A word is hit if it lies in an
occurrence of a window: ``window`` consecutive words of an item, or a whole shorter item.

Items are dealt by hash to blocks of about ``block_words`` words. Each block's automaton is built by a task and put into the shared
folder; nothing of the items passes through the driver. The documents are scanned once per block, by workers that hold that block's
automaton alone, so memory is bounded whatever the number of items; a benchmark of one block, as most are, takes one scan.
With more blocks the spans of a document are joined by its row number, so documents must come from a stable table.

Defined results: a NULL or empty text has no words, no hits and is not contaminated. Items without
words (NULL, empty, punctuation only) never occur. Rows with the same item id count as one item; an
item whose id is NULL still marks words and counts as one item, listed as ``null``. Repeated
documents each get their own row. Extra columns pass through whatever their names.
"""

from __future__ import annotations

import pickle
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import filesystem, fresh_name, map_batches, per_worker, publish
from millrace.session import materialise, scratch_path

# ASCII capitals become small, other ASCII but digits and small letters become spaces, bytes of
# other characters stay
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(WORD_BYTES).split() if text else []


class Automaton:
    """The automaton of some items, with the items of every window and every short item."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.step: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        coded = []
        for name, words in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
            coded.append((name, ids))
            last = 0
            for w in ids:
                last = self._extend(last, w)
        self.shortest = min([window, *(len(ids) for _, ids in coded if ids)])
        self._label(coded)

    def _new(self, length: int, step: dict[int, int], link: int) -> int:
        self.length.append(length)
        self.step.append(step)
        self.link.append(link)
        return len(self.link) - 1

    def _split(self, state: int, word: int, target: int) -> int:
        """A copy of ``target`` for the strings that are one longer than those of ``state``."""
        copy = self._new(self.length[state] + 1, dict(self.step[target]), self.link[target])
        self.link[target] = copy
        while state >= 0 and self.step[state].get(word) == target:
            self.step[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: int) -> int:
        known = self.step[last].get(word)
        if known is not None:  # another item has this prefix of the item already
            return known if self.length[known] == self.length[last] + 1 else self._split(last, word, known)
        new = self._new(self.length[last] + 1, {}, 0)
        state = last
        while state >= 0 and word not in self.step[state]:
            self.step[state][word] = new
            state = self.link[state]
        if state >= 0:
            target = self.step[state][word]
            exact = self.length[target] == self.length[state] + 1
            self.link[new] = target if exact else self._split(state, word, target)
        return new

    def _label(self, coded: list[tuple[str, list[int]]]) -> None:
        count = len(self.link)
        by_length = sorted(range(1, count), key=self.length.__getitem__)
        # the state that holds the suffix of `window` words of a state's strings
        self.whole = [-1] * count
        for state in by_length:
            above = self.link[state]
            if self.length[state] >= self.window:
                self.whole[state] = state if self.length[above] < self.window else self.whole[above]
        self.items_of: dict[int, set[str]] = {}
        short: dict[int, set[tuple[int, str]]] = {}
        for name, ids in coded:
            state = 0
            for at, w in enumerate(ids):
                state = self.step[state][w]
                if at + 1 >= self.window:
                    self.items_of.setdefault(self.whole[state], set()).add(name)
            if 0 < len(ids) < self.window:
                short.setdefault(state, set()).add((len(ids), name))
        # short items that are suffixes of a state's strings
        self.short: dict[int, list[tuple[int, str]]] = {}
        for state in by_length:
            found = self.short.get(self.link[state], []) + sorted(short.get(state, ()))
            if found:
                self.short[state] = found

    def spans(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Word spans (start, end) that windows cover, merged and in order, and the items they are of."""
        codes = np.fromiter(map(self.vocabulary.get, words, repeat(-1)), np.int64, len(words))
        edges = np.flatnonzero(np.diff(np.concatenate(([False], codes >= 0, [False])).astype(np.int8)))
        found: list[tuple[int, int]] = []
        names: set[str] = set()
        seen: set[int] = set()
        step, link, length, whole, short, window = (
            self.step, self.link, self.length, self.whole, self.short, self.window,
        )
        for begin, end in edges.reshape(-1, 2)[np.diff(edges.reshape(-1, 2), axis=1)[:, 0] >= self.shortest].tolist():
            state = matched = 0
            for at, w in enumerate(codes[begin:end].tolist(), begin + 1):
                while state and w not in step[state]:
                    state = link[state]
                    matched = length[state]
                state = step[state].get(w, 0)
                matched = matched + 1 if state else 0
                reach = 0
                if matched >= window:
                    reach = window
                    if whole[state] not in seen:
                        seen.add(whole[state])
                        names |= self.items_of[whole[state]]
                for size, name in short.get(state, ()):
                    if size <= matched:
                        reach = max(reach, size)
                        names.add(name)
                if reach:
                    while found and found[-1][0] >= at - reach:
                        found.pop()
                    if found and found[-1][1] >= at - reach:
                        found[-1] = (found[-1][0], at)
                    else:
                        found.append((at - reach, at))
        return found, names


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged


def write_automata(items: DataFrame, item_id: str, item_text: str, window: int, block_words: int) -> list[str]:
    """Build the automata of all blocks in tasks; gives the paths of their files."""
    spark = items.sparkSession
    folder = scratch_path(spark, "automata")
    rows = items.select(F.col(f"`{item_id}`").cast("string").alias("id"), F.col(f"`{item_text}`").alias("text"))

    def count(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([sum(len(words_of(t)) for t in batch.column(0).to_pylist())], pa.int64())})

    total = map_batches(rows.select("text"), count, "n long").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
    if not total:
        return []
    blocks = -(-total // block_words)

    def build(group: pa.Table) -> pa.Table:
        block = group.column("block")[0].as_py()
        named = [("null" if i is None else i, words_of(t)) for i, t in zip(group.column("id").to_pylist(), group.column("text").to_pylist())]
        named = sorted((i, w) for i, w in named if w)
        if not named:
            return pa.table({"block": pa.array([], pa.int64())})
        data = cloudpickle.dumps(Automaton(named, window))
        publish(folder, f"block-{block}", TaskContext.get().taskAttemptId(), lambda out: out.write(data))
        return pa.table({"block": pa.array([block], pa.int64())})

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)).cast("long"))
    made = dealt.groupBy("block").applyInArrow(build, "block long").collect()  # a number per block
    return [f"{folder}/block-{row.block}" for row in sorted(made)]


def _automaton(path: str) -> Automaton:
    """The automaton of a file; a worker keeps the last one."""
    kept = per_worker("automaton", dict)
    if path not in kept:
        kept.clear()
        files, place = filesystem(path)
        with files.open_input_stream(place, compression=None) as source:
            kept[path] = pickle.loads(source.read())
    return kept[path]


FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)
FOUND_ARROW = pa.struct(
    [
        ("n_words", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
        ("items", pa.list_(pa.string())),
    ]
)


def match_items(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 13,
    block_words: int = 250_000,
) -> tuple[DataFrame, str]:
    """``docs`` with one struct column more (n_words, spans of hit words, ids of the items), and its name."""
    name = fresh_name("found", docs.columns)
    paths = write_automata(items, item_id, item_text, window, block_words)
    if len(paths) <= 1:
        return _scan(docs, text, paths, name), name
    # a scan per block; the first gives a row for every document, the others for those with hits
    row = fresh_name("row", [*docs.columns, name])
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    texts = numbered.select(F.col(row).alias("row"), F.col(f"`{text}`").alias("text"))
    parts = []
    for number, path in enumerate(paths):
        part = _scan(texts, "text", [path], "found").drop("text")
        parts.append(materialise(part.where(F.size("found.spans") > 0) if number else part, "hit-spans"))
    found = reduce(DataFrame.unionByName, parts).groupBy("row").agg(F.collect_list("found").alias("all"))

    def merge(batches):
        for batch in batches:
            merged = []
            for every in batch.column(1).to_pylist():
                spans = merge_spans([(s["start"], s["end"]) for f in every for s in f["spans"]])
                names = sorted({n for f in every for n in f["items"]})
                merged.append({"n_words": every[0]["n_words"], "spans": [{"start": a, "end": b} for a, b in spans], "items": names})
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(merged, FOUND_ARROW)], names=["row", "found"])

    merged = map_batches(found.select("row", "all"), merge, T.StructType([T.StructField("row", T.LongType()), T.StructField("found", FOUND)]))
    merged = merged.select(F.col("row").alias(row), F.col("found").alias(name))
    return numbered.join(merged, row).select(*[F.col(f"`{c}`") for c in docs.columns], name), name


def _scan(docs: DataFrame, text: str, paths: list[str], name: str) -> DataFrame:
    """``docs`` with the struct of what the automaton finds, if there is one."""
    text_at = docs.columns.index(text)

    def scan(batches):
        machine = _automaton(paths[0]) if paths else None
        for batch in batches:
            rows = []
            for value in batch.column(text_at).to_pylist():
                words = words_of(value)
                spans, names = machine.spans(words) if machine else ([], set())
                rows.append({"n_words": len(words), "spans": [{"start": a, "end": b} for a, b in spans], "items": sorted(names)})
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, FOUND_ARROW)], names=[*batch.schema.names, name])

    return map_batches(docs, scan, T.StructType([*docs.schema.fields, T.StructField(name, FOUND)]))


def hit_words(found) -> F.Column:
    return F.aggregate(
        found["spans"], F.lit(0).cast("long"), lambda total, s: total + (s["end"] - s["start"]).cast("long")
    )


def is_contaminated(found, max_span: int = 0, max_share: float = 0.05):
    """Whether a span has more than ``max_span`` words and the hit words reach ``max_share`` of all."""
    longest = F.coalesce(F.array_max(F.transform(found["spans"], lambda s: s["end"] - s["start"])), F.lit(0))
    return (longest > max_span) & (hit_words(found) >= max_share * found["n_words"])


def digest(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", window: int = 13) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256, contaminated."""
    matched, name = match_items(docs.select(doc_id, "text"), items, window=window)
    found = F.col(name)
    hits = hit_words(found)
    return matched.select(
        F.col(doc_id),
        found["n_words"].alias("n_words"),
        hits.alias("n_hit"),
        F.size(found["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(found["items"], ",").cast("binary"), 256).alias("items_sha256"),
        ((hits > 0) & (20 * hits >= found["n_words"])).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = 13) -> DataFrame:
    """The documents that are not contaminated, with their columns and texts as they were."""
    matched, name = match_items(docs, items, window=window)
    found = F.col(name)
    hits = hit_words(found)
    return matched.where(~((hits > 0) & (20 * hits >= found["n_words"]))).select(*[F.col(f"`{c}`") for c in docs.columns])


def remove_spans(docs: DataFrame, items: DataFrame, max_span: int = 12, max_share: float = 1.0, window: int = 13) -> DataFrame:
    """Cut from each text the hit spans of more than ``max_span`` words, and drop the documents of
    which ``max_share`` or more is hit. A span reaches from its first word to the end of its last."""
    matched, name = match_items(docs, items, window=window)
    text_at, found_at = docs.columns.index("text"), len(docs.columns)

    def cut(batches):
        for batch in batches:
            out = []
            for text, found in zip(batch.column(text_at).to_pylist(), batch.column(found_at).to_pylist()):
                long = [s for s in found["spans"] if s["end"] - s["start"] > max_span]
                out.append(_without(text, long) if long else text)
            columns = [*batch.columns[:found_at]]
            columns[text_at] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:found_at])

    found = F.col(name)
    hits = hit_words(found)
    kept = matched.where(~((hits > 0) & (hits >= max_share * found["n_words"])))
    return map_batches(kept, cut, docs.schema)


def _without(text: str, spans: list[dict]) -> str:
    raw = text.encode("utf-8", "replace")
    clean = raw.translate(WORD_BYTES)
    starts, ends, at = [], [], 0
    for word in clean.split():
        at = clean.index(word, at)
        starts.append(at)
        at += len(word)
        ends.append(at)
    pieces, last = [], 0
    for span in spans:
        pieces.append(raw[last : starts[span["start"]]])
        last = ends[span["end"] - 1]
    return b"".join([*pieces, raw[last:]]).decode("utf-8", "replace")


def op9_decontaminate(spark, sf_dir):
    from millrace.llm.common import table

    return digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP9_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
windows AS (SELECT DISTINCT item_id, least(13, len(w)) AS k, array_to_string(w[p : p + least(13, len(w)) - 1], ' ') AS g
            FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS p FROM b WHERE len(w) > 0)),
grams AS (SELECT doc_id, k, p, array_to_string(w[p : p + k - 1], ' ') AS g
          FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p
                FROM d, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k)),
hits AS (SELECT doc_id, item_id, p, windows.k AS k FROM grams JOIN windows USING (g) WHERE grams.k = windows.k),
covered AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS pos FROM hits) GROUP BY 1),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)"""
