"""Periodic runs of words by recompression.

A run is a longest stretch of a text that repeats itself with a smallest period, at least twice and over at least
``LEAST`` words; consecutive words a period apart are equal.

Grammar. The words of many documents lie in one array, with a mark of its own before, between and behind documents. Levels are made from it
in turns: block compression joins each longest repetition of one symbol, and pair compression parts the symbols in two halves by a hash
and joins each symbol of one half with a following one of the other. What is joined depends on the symbols alone, so equal
stretches become equal symbols but at their edges. Symbols that stand once in their document need no name in common, so
only the others are sorted; levels end when all symbols differ.

Extension. How far two places agree, to the right or to the left, is asked of the grammar for all pairs at once: they climb while their
symbols agree, step over what is left of a block, and walk down from the first difference, with a bounded number of steps a level.

Candidates. A run of period p holds two neighbours of the grid of all multiples of p that agree over it, so the places x and x + p for
x = 0, p, 2p, ... are asked, for all p up to half of the words: the harmonic sum of the number of words. Pairs without three equal words
beside them cannot reach the least length and are passed over. A stretch that is found under several periods counts with the smallest.

Defined results: a NULL text has no words. Texts of any length are read whole, documents of more words than ``WORDS`` alone in an array.
Repeated rows each get a row; rows with a NULL id are read like any other. An empty table gives no rows. Other columns are not returned.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_batches, table

LEAST = 12
WORDS = 300_000  # of the documents that share an array
PAIRS = 1 << 21  # candidates that are looked at together
MIX = np.uint64(0x9E3779B97F4A7C15)
MORE = np.uint64(0xBF58476D1CE4E5B9)


class Grammar:
    """Levels of symbols; a symbol of a level covers a run of symbols of the one below."""

    def __init__(self, symbols: np.ndarray, cautious: np.ndarray):
        """``symbols`` below their number, equal where words are; ``cautious`` marks those that stand more than once."""
        self.symbols, self.first, self.parent, self.block = [symbols], [np.empty(0, np.int64)], [], [False]
        repeated, seed = cautious, 0
        while repeated.any():
            symbols, size = self.symbols[-1], len(self.symbols[-1])
            same = symbols[1:] == symbols[:-1]
            if same.any():
                first = np.flatnonzero(np.concatenate(([True], ~same)))
                lengths = np.diff(np.append(first, size))
                repeated = self._push(first, lengths, symbols[first] * (size + 1) + lengths, repeated[first], True)
                continue_with, size = self.symbols[-1], len(first)
                symbols = continue_with
                if not repeated.any():
                    break
            joins = np.zeros(0, bool)
            while not joins.any():  # a hash may put all in one half
                seed += 1
                mixed = (symbols.astype(np.uint64) + np.uint64(seed)) * MIX
                half = (((mixed ^ (mixed >> np.uint64(29))) * MORE) >> np.uint64(63)).astype(bool)
                one, other = half[:-1] & ~half[1:], ~half[:-1] & half[1:]
                joins = one if one.sum() >= other.sum() else other
            begins = np.ones(size, bool)
            begins[1:][joins] = False
            first = np.flatnonzero(begins)
            lengths = np.diff(np.append(first, size))
            paired = lengths == 2
            second = np.minimum(first + 1, size - 1)
            key = symbols[first] * (size + 1) + np.where(paired, symbols[second] + 1, 0)
            repeated = self._push(first, lengths, key, repeated[first] & (~paired | repeated[second]), False)

    def _push(self, first, lengths, key, may_repeat, block) -> np.ndarray:
        """Add a level; equal keys get equal symbols. Returns which of them repeat."""
        names, place, counts = np.unique(key[may_repeat], return_inverse=True, return_counts=True)
        symbols = np.empty(len(first), np.int64)
        symbols[may_repeat] = place
        symbols[~may_repeat] = len(names) + np.arange(len(first) - len(place))
        repeated = np.zeros(len(first), bool)
        repeated[may_repeat] = counts[place] > 1
        self.parent.append(np.repeat(np.arange(len(first)), lengths))
        self.first.append(np.append(first, first[-1] + lengths[-1]))
        self.symbols.append(symbols)
        self.block.append(block)
        return repeated

    def extend(self, left: np.ndarray, right: np.ndarray, forward: bool) -> np.ndarray:
        """How many symbols from two places on are equal, the places included, to the right or to the left."""
        way = 1 if forward else -1
        pools: list[list[tuple]] = [[] for _ in self.symbols]
        query, i, j = np.arange(len(left)), left, right
        for level, symbols in enumerate(self.symbols):
            equal = symbols[i] == symbols[j]
            pools[level].append((query[~equal], i[~equal], j[~equal]))
            query, i, j = query[equal], i[equal], j[equal]
            if not len(query):
                break
            first, parent = self.first[level + 1], self.parent[level]
            pi, pj = parent[i], parent[j]
            if forward:
                rest_i, rest_j = first[pi + 1] - i, first[pj + 1] - j
                whole = (first[pi] == i) & (first[pj] == j)
            else:
                rest_i, rest_j = i - first[pi] + 1, j - first[pj] + 1
                whole = (first[pi + 1] == i + 1) & (first[pj + 1] == j + 1)
            apart = ~whole & (rest_i != rest_j)
            if apart.any():  # one block goes on where the other has ended
                step = way * np.minimum(rest_i, rest_j)[apart]
                pools[level].append((query[apart], i[apart] + step, j[apart] + step))
            beyond = np.where(whole, 0, way)
            query, i, j = query[~apart], (pi + beyond)[~apart], (pj + beyond)[~apart]
        for level in range(len(self.symbols) - 1, 0, -1):
            if not pools[level]:
                continue
            query, i, j = (np.concatenate(c) for c in zip(*pools[level]))
            first, below = self.first[level], self.symbols[level - 1]
            ci, cj = (first[i], first[j]) if forward else (first[i + 1] - 1, first[j + 1] - 1)
            step = (below[ci] == below[cj]).astype(np.int64)
            if self.block[level]:
                step *= np.minimum(first[i + 1] - first[i], first[j + 1] - first[j])
            pools[level - 1].append((query, ci + way * step, cj + way * step))
        out = np.zeros(len(left), np.int64)
        for query, i, _ in pools[0]:
            out[query] = np.abs(i - left[query])
        return out


def _ranges(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... up to each length, in a row."""
    return np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def find_runs(words: np.ndarray, edges: np.ndarray, least: int = LEAST, pairs: int = PAIRS) -> tuple[np.ndarray, ...]:
    """Document, start, length and period of every run, in that order; ``edges`` part the word numbers into documents."""
    sizes = np.diff(edges)
    documents = len(sizes)
    document = np.repeat(np.arange(documents), sizes)
    # marks that stand once lie around every document
    place = np.arange(len(words)) + document + 1
    total = len(words) + documents + 1
    names, number, counts = np.unique(document * (int(words.max(initial=0)) + 1) + words, return_inverse=True, return_counts=True)
    symbols = np.full(total, -1, np.int64)
    symbols[place] = number
    marks = np.flatnonzero(symbols < 0)
    symbols[marks] = len(names) + np.arange(len(marks))
    cautious = np.zeros(total, bool)
    cautious[place] = counts[number] > 1
    # three words as one number, which equal triples have in common
    padded = np.append(symbols, [-1, -2]).astype(np.uint64)
    after = (padded[:-2] * MIX + padded[1:-1]) * MORE + padded[2:]
    after ^= after >> np.uint64(31)
    before = np.concatenate((~np.arange(3, dtype=np.uint64), after[:-3]))[:total]
    inner = after[place]
    order = np.sort(inner)
    again = order[1:][order[1:] == order[:-1]]
    if not len(again):
        return (np.empty(0, np.int64),) * 4
    busy = np.unique(document[np.isin(inner, again)])
    busy = busy[sizes[busy] >= max(least, 2)]
    # all periods of all documents, and their grids
    half = sizes[busy] // 2
    owner, period = np.repeat(busy, half), _ranges(half) + 1
    grid = (sizes[owner] - 1) // period
    ends = np.cumsum(grid)
    start = edges[:-1] + np.arange(documents) + 1
    grammar, found, at = None, [], 0
    while at < len(grid):
        done = ends[at] - grid[at]
        stop = max(at + 1, int(np.searchsorted(ends, done + pairs, "right")))
        count = grid[at:stop]
        p = np.repeat(period[at:stop], count)
        x = np.repeat(start[owner[at:stop]], count) + _ranges(count) * p
        near = (after[x] == after[x + p]) | (before[x] == before[x + p])
        x, p = x[near], p[near]
        if len(x):
            grammar = grammar or Grammar(symbols, cautious)
            right = grammar.extend(x, x + p, True)
            left = grammar.extend(x - 1, x + p - 1, False)
            long = (left + right >= p) & (left + right + p >= least)
            found.append(np.stack([x[long] - left[long], (left + right + p)[long], p[long]]))
        at = stop
    if not found:
        return (np.empty(0, np.int64),) * 4
    start_at, length, p = np.concatenate(found, axis=1)
    order = np.lexsort((p, length, start_at))
    start_at, length, p = start_at[order], length[order], p[order]
    new = np.concatenate(([True], (start_at[1:] != start_at[:-1]) | (length[1:] != length[:-1])))[: len(p)]
    start_at, length, p = start_at[new], length[new], p[new]
    order = np.lexsort((p, start_at))
    start_at, length, p = start_at[order], length[order], p[order]
    document = np.searchsorted(start, start_at, "right") - 1
    return document, start_at - start[document], length, p


def _collapse(words: list[bytes], starts: np.ndarray, lengths: np.ndarray, periods: np.ndarray) -> bytes:
    """The words that no run holds after its first period, joined by a space."""
    if not len(starts):
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, starts + periods, 1)
    np.add.at(change, starts + lengths, -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()])


def periodic_runs(docs: DataFrame, change: Callable | None = None, least: int = LEAST) -> DataFrame:
    """Per document: doc_id, runs (start, length, period; by start, then period) and its collapsed text. ``change(words, doc_id)`` may give
    other words to look at."""

    def read(batches):
        for batch in batches:
            held, size = [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = (text or b"").split()  # bytes are split at ASCII white space only
                if held and size + len(words) > WORDS:
                    yield solve(held)
                    held, size = [], 0
                held.append((doc_id, change(words, doc_id) if change else words))
                size += len(words)
            if held:
                yield solve(held)

    def solve(held) -> pa.RecordBatch:
        numbers: defaultdict[bytes, int] = defaultdict()
        numbers.default_factory = numbers.__len__
        ids = [np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)) for _, words in held]
        edges = np.cumsum([0, *map(len, ids)])
        document, start, length, period = find_runs(np.concatenate(ids), edges, least)
        cuts = np.searchsorted(document, np.arange(len(held) + 1))
        texts = [
            _collapse(words, start[a:b], length[a:b], period[a:b]) for (_, words), a, b in zip(held, cuts[:-1].tolist(), cuts[1:].tolist())
        ]
        runs = pa.StructArray.from_arrays([pa.array(start), pa.array(length), pa.array(period)], names=["start", "length", "period"])
        return pa.RecordBatch.from_arrays(
            [
                pa.array([i for i, _ in held], pa.int64()),
                pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), runs),
                pa.array(texts, pa.binary()).cast(pa.string()),
            ],
            names=["doc_id", "runs", "collapsed"],
        )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return map_batches(rows, read, "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words of the query: in a tenth of the documents, by checksum of the id, the words from a place on repeat themselves."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    turn = words[a : a + p]
    return words[:a] + (turn * ((n - a) // p + 1))[: n - a]


def digest(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_runs, the longest run (start, length, period, exponent_milli), runs_sha256, collapsed_sha256."""
    rows = periodic_runs(docs, planted)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("s"), (-r.period).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start.cast("string"), r.length.cast("string"), r.period.cast("string")))
    return rows.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.p")).alias("period"),
        F.expr("1000 * best.length div -best.p").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda t: F.concat(t, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )


def op12_periodic(spark, sf_dir):
    return digest(table(spark, sf_dir, "documents"))
