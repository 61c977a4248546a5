"""Source divergence audit: how far the sources of a language lie apart in their words, by chunk factorization.

Terms are runs of ASCII letters and non-ASCII characters, with A-Z made small. White space never lies inside a term, so a text is
first cut at white space into chunks, and a chunk, however often it occurs, is cut into terms once.

1. Documents are read in blocks of one language and about ``BLOCK_WORDS`` chunks. A block counts the chunks of each document, and
   gives its distinct chunks with their posting lists (document and count), a row of arrays for each bucket of the chunk's checksum.
2. The chunks of a bucket, from all blocks, come together. Each distinct one is cut into terms, and its terms go back to
   every block that has it.
3. A block joins terms and posting lists: per term the distinct documents that hold it (in however many chunks) and the occurrences per
   source, a row of arrays for each bucket of the term's checksum.
4. The terms of a bucket come together. Those of at least ``LEAST_DOCS`` documents of the language are kept, with their counts per source.
5. Every group and language gives each kept term the smoothed share ``p = 1 + floor(SCALE * (count + SMOOTH) / (N + SMOOTH * V))``,
   in decimals, so nothing is rounded. Part ``pair``: the sum over all kept terms of ``abs(p - q)`` for all pairs of sources of a language. Terms
   are dealt to tasks in buckets, each of which holds the terms as rows and the sources as columns and adds up whole columns; sources beyond
   ``SOURCES`` are dealt to several tasks as well. Part ``term``: the ``TOP`` kept terms with ``p`` furthest above the language's own.

A chunk or term, however frequent, is one entry per block wherever it is shuffled. There are ``BUCKETS_A_TASK`` buckets for each task that
reads documents, so a bucket holds what a part of a task found, at every size; a block is bounded by itself.

Defined results: NULL text, language and source count as empty. Every (language, source) that occurs is a group, also without a
term; with no kept term all its pairs have value 0. Repeated rows and ids count as documents of their own, as the id is not looked at. An
empty table gives no rows. Extra columns are not read. A text of any length is one document; a chunk of any length is one chunk. The
table of documents is read twice, for texts and for groups.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import map_batches, table
from millrace.session import materialise, scratch_path

BLOCK_WORDS = 2_000_000
BLOCK_DOCS = 32_767  # so that a document of a block is a small integer
MOST_COUNT = 127  # of one posting; a greater count takes several
BUCKETS_A_TASK = 4
LEAST_DOCS = 30
SMOOTH = 5
SCALE = 1_000_000_000
TOP = 50
SOURCES = 512  # columns that one task adds up
BUCKET_ROWS = 20_000  # (term, source) rows of a bucket of pairs, about
CELLS = 1 << 20  # of a matrix that is held at once
TERM = re.compile(rb"[a-z\x80-\xff]+")  # in UTF-8 every byte of a non-ASCII character is above 0x7f

BLOCK_ROWS = """block long, bucket int, lang string, chunks array<binary>, lengths array<int>, docs array<smallint>, counts array<tinyint>,
    names array<string>, sources array<smallint>"""
TERM_ROWS = "block long, bucket int, sizes array<int>, terms array<string>, times array<int>"
COUNT_ROWS = """lang string, bucket int, terms array<string>, dfs array<smallint>, lengths array<smallint>, sources array<smallint>, counts array<int>,
    names array<string>"""


def _text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def _bucket(values: list[bytes], buckets: int) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, values), np.int64, len(values)) % buckets


def _edges(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(lengths)))


def _lists(values: pa.Array, edges: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), values)


def _int_lists(values: np.ndarray, edges: np.ndarray, kind=np.int32) -> pa.ListArray:
    return _lists(pa.array(values.astype(kind)), edges)


def _flat(rows: pa.Table, column: str) -> pa.Array:
    return rows.column(column).combine_chunks().flatten()


def _numbers(rows: pa.Table, column: str) -> np.ndarray:
    return _flat(rows, column).to_numpy(zero_copy_only=False).astype(np.int64)


def _list_lengths(rows: pa.Table, column: str) -> np.ndarray:
    return np.diff(rows.column(column).combine_chunks().offsets.to_numpy())


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its length, in a row."""
    return np.arange(lengths.sum()) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)


def _sums(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, ascending, and the sum of the values of each."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(values[order], first) if len(first) else np.empty(0, np.int64)


def _distinct(keys: np.ndarray) -> np.ndarray:
    keys = np.sort(keys)
    return keys[np.concatenate(([True], keys[1:] != keys[:-1]))] if len(keys) else keys


# ---- 1: chunks of documents -------------------------------------------------------------------------------------


class Block:
    """Documents of one language; chunks are numbered as they come."""

    def __init__(self):
        self.numbers: defaultdict[bytes, int] = defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        self.words = 0
        self.ids: list[np.ndarray] = []
        self.names: dict[str, int] = {}
        self.sources: list[int] = []  # of each document

    def add(self, words: list[bytes], source: str) -> None:
        self.ids.append(np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words)))
        self.sources.append(self.names.setdefault(source, len(self.names)))
        self.words += len(words)

    def rows(self, block: int, lang: str, buckets: int) -> pa.RecordBatch:
        """A row per bucket: chunks, the lengths of their posting lists, and the lists. The first has the names of the sources and the
        source of each document."""
        chunks = list(self.numbers)
        bucket = _bucket(chunks, buckets)
        order = np.argsort(bucket, kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        docs = np.repeat(np.arange(len(self.ids)), [len(i) for i in self.ids])
        keys = place[np.concatenate(self.ids)] * len(self.ids) + docs
        keys.sort()
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        counts = np.diff(np.append(first, len(keys)))
        times = -(-counts // MOST_COUNT)
        held = np.repeat(keys[first], times)
        parts = np.full(len(held), MOST_COUNT)
        parts[np.cumsum(times) - 1] = counts - MOST_COUNT * (times - 1)
        lengths = np.bincount(held // len(self.ids), minlength=len(chunks))
        bucket = bucket[order]
        used, begin = np.unique(bucket, return_index=True)
        of_chunks = np.append(begin, len(chunks))
        of_postings = _edges(lengths)[of_chunks]
        rest = [None] * (len(used) - 1)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(used), block, np.int64)),
                pa.array(used.astype(np.int32)),
                pa.array([lang] * len(used), pa.string()),
                _lists(pa.array([chunks[i] for i in order.tolist()], pa.binary()), of_chunks),
                _int_lists(lengths, of_chunks),
                _int_lists(held % len(self.ids), of_postings, np.int16),
                _int_lists(parts, of_postings, np.int8),
                pa.array([list(self.names), *rest], pa.list_(pa.string())),
                pa.array([self.sources, *rest], pa.list_(pa.int16())),
            ],
            names=["block", "bucket", "lang", "chunks", "lengths", "docs", "counts", "names", "sources"],
        )


def chunk_blocks(docs: DataFrame, buckets: int, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of all blocks (``BLOCK_ROWS``)."""

    def read(batches):
        number = TaskContext.get().partitionId() << 32
        blocks: dict[str, Block] = {}
        words = documents = 0
        for batch in batches:
            for text, lang, source in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if not (chunks := text.split()):  # bytes are split at ASCII white space only
                    continue
                blocks.setdefault(lang, Block()).add(chunks, source)
                words, documents = words + len(chunks), documents + 1
                if words >= block_words or documents == BLOCK_DOCS:
                    for n, own in blocks.items():
                        yield own.rows(number, n, buckets)
                        number += 1
                    blocks, words, documents = {}, 0, 0
        for n, own in blocks.items():
            yield own.rows(number, n, buckets)
            number += 1

    rows = docs.select(_text("text").cast("binary").alias("text"), _text("lang").alias("lang"), _text("source").alias("source"))
    return map_batches(rows, read, BLOCK_ROWS)


# ---- 2: terms of chunks -----------------------------------------------------------------------------------------


def _cut_bucket(rows: pa.Table) -> pa.Table:
    """For each block's row of a bucket the number of terms of each chunk, the terms, and how often each stands in its chunk."""
    coded = _flat(rows, "chunks").dictionary_encode()
    found = [TERM.findall(c.lower()) for c in coded.dictionary.to_pylist()]  # each distinct chunk once
    counted = {i: Counter(f) for i, f in enumerate(found) if len(f) > 1}
    found = [list(counted[i]) if i in counted else f for i, f in enumerate(found)]
    times = list(chain.from_iterable(counted[i].values() if i in counted else [1] * len(f) for i, f in enumerate(found)))
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    terms = pa.array(list(chain.from_iterable(found)), pa.binary()).cast(pa.string())
    # back to the rows
    chunk = coded.indices.to_numpy()
    per_row = _list_lengths(rows, "chunks")
    entry = _ranges(_edges(lengths)[:-1][chunk], lengths[chunk])
    edges = _edges(lengths[chunk])[_edges(per_row)]
    return pa.table(
        {
            "block": rows.column("block"),
            "bucket": rows.column("bucket"),
            "sizes": _int_lists(lengths[chunk], _edges(per_row)),
            "terms": _lists(terms.take(pa.array(entry)), edges),
            "times": _int_lists(np.array(times, np.int64)[entry], edges),
        }
    )


def chunk_terms(blocks: DataFrame) -> DataFrame:
    """The terms of the chunks of every block (``TERM_ROWS``)."""
    return blocks.select("block", "bucket", "chunks").groupBy("bucket").applyInArrow(_cut_bucket, TERM_ROWS)


# ---- 3: terms of blocks -----------------------------------------------------------------------------------------


def _join_block(rows: pa.Table, found: pa.Table, buckets: int) -> pa.Table:
    """Per term of a block the documents that hold it and its occurrences per source, in rows by bucket of the term."""
    rows, found = rows.sort_by("bucket"), found.sort_by("bucket")
    heads = rows.column("names").is_valid()
    names = pa.array(rows.filter(heads).column("names")[0].as_py(), pa.string())
    source_of = np.array(rows.filter(heads).column("sources")[0].as_py(), np.int64)
    size = len(source_of)
    # the posting list of every chunk, and the chunk of every term
    lengths = _numbers(rows, "lengths")
    starts = _edges(lengths)[:-1]
    owner = np.repeat(np.arange(len(lengths)), _numbers(found, "sizes"))
    coded = _flat(found, "terms").dictionary_encode()
    code, times = coded.indices.to_numpy().astype(np.int64), _numbers(found, "times")
    at = _ranges(starts[owner], lengths[owner])
    docs = _numbers(rows, "docs")[at]
    counts = _numbers(rows, "counts")[at] * np.repeat(times, lengths[owner])
    code = np.repeat(code, lengths[owner])
    # terms in the order of their buckets
    terms = coded.dictionary
    bucket = _bucket(terms.cast(pa.binary()).to_pylist(), buckets)
    order = np.argsort(bucket, kind="stable")
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    code, bucket = place[code], bucket[order]
    dfs = np.bincount(_distinct(code * size + docs) // size, minlength=len(terms))
    keys, sums = _sums(code * len(names) + source_of[docs], counts)
    per_term = np.bincount(keys // len(names), minlength=len(terms))
    used, begin = np.unique(bucket, return_index=True)
    of_terms = np.append(begin, len(terms))
    of_counts = _edges(per_term)[of_terms]
    return pa.table(
        {
            "lang": pa.array([rows.column("lang")[0].as_py()] * len(used), pa.string()),
            "bucket": pa.array(used.astype(np.int32)),
            "terms": _lists(terms.take(pa.array(order)), of_terms),
            "dfs": _int_lists(dfs, of_terms, np.int16),
            "lengths": _int_lists(per_term, of_terms, np.int16),
            "sources": _int_lists(keys % len(names), of_counts, np.int16),
            "counts": _int_lists(sums, of_counts),
            "names": pa.array([names.to_pylist()] * len(used), pa.list_(pa.string())),
        }
    )


def block_terms(blocks: DataFrame, terms: DataFrame, buckets: int) -> DataFrame:
    """The terms of every block (``COUNT_ROWS``)."""
    return (
        blocks.drop("chunks").groupBy("block")
        .cogroup(terms.groupBy("block"))
        .applyInArrow(lambda rows, found: _join_block(rows, found, buckets), COUNT_ROWS)
    )


# ---- 4: kept terms ----------------------------------------------------------------------------------------------


def _keep_terms(rows: pa.Table, least_docs: int) -> pa.Table:
    """Of one language and bucket the terms of enough documents, with their occurrences per source."""
    coded = _flat(rows, "terms").dictionary_encode()
    code = coded.indices.to_numpy().astype(np.int64)
    total = np.zeros(len(coded.dictionary), np.int64)
    np.add.at(total, code, _numbers(rows, "dfs"))
    names = _flat(rows, "names").dictionary_encode()
    # the sources of a row are places in its own names
    first = _edges(_list_lengths(rows, "names"))[:-1]
    source = names.indices.to_numpy()[np.repeat(first, _list_lengths(rows, "sources")) + _numbers(rows, "sources")]
    owner = np.repeat(code, _numbers(rows, "lengths"))
    kept = total[owner] >= least_docs
    keys = owner * max(len(names.dictionary), 1) + source
    keys, sums = _sums(keys[kept], _numbers(rows, "counts")[kept])
    return pa.table(
        {
            "lang": pa.array([rows.column("lang")[0].as_py()] * len(keys), pa.string()),
            "term": coded.dictionary.take(pa.array(keys // max(len(names.dictionary), 1))),
            "source": names.dictionary.take(pa.array(keys % max(len(names.dictionary), 1))),
            "n": pa.array(sums.astype(np.int64)),
        }
    )


def source_terms(docs: DataFrame, least_docs: int = LEAST_DOCS, block_words: int = BLOCK_WORDS, buckets: int | None = None) -> DataFrame:
    """lang, term, source, n: occurrences of each kept term in each group that has any."""
    buckets = buckets or BUCKETS_A_TASK * max(docs.rdd.getNumPartitions(), 2)  # plans the scan only
    path = scratch_path(docs.sparkSession, "divergence-chunks")
    chunk_blocks(docs, buckets, block_words).write.option("compression", "zstd").parquet(path)
    blocks = docs.sparkSession.read.schema(BLOCK_ROWS).parquet(path)
    found = block_terms(blocks, chunk_terms(blocks), buckets)
    return found.groupBy("lang", "bucket").applyInArrow(
        lambda rows: _keep_terms(rows, least_docs), "lang string, term string, source string, n long"
    )


# ---- shares and their differences -------------------------------------------------------------------------------


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + SMOOTH) / (total + SMOOTH * terms)), exactly; NULL where there are no terms."""
    above = (count + SMOOTH).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    below = F.nullif(total + SMOOTH * terms, F.lit(0)).cast("decimal(20,0)")
    return F.call_function("div", above, below) + 1


def _add_up(left: pa.Table, right: pa.Table) -> pa.Table:
    """Sums of absolute differences over the terms of one bucket, for the sources of one part against all."""
    langs, sources, base, own = (right.column(c).to_pylist() for c in ("lang", "source", "base", "own"))
    place = {s: i for i, s in enumerate(sources)}
    mine = [i for i, o in enumerate(own) if o]
    sums = np.zeros((len(mine), len(sources)), np.int64)
    if left.num_rows:
        rest = np.array([b or 0 for b in base], np.int64)
        code = left.column("term").combine_chunks().dictionary_encode()
        term = code.indices.to_numpy()
        order = np.argsort(term, kind="stable")
        term = term[order]
        column = np.array([place[s] for s in left.column("source").to_pylist()], np.int64)[order]
        value = left.column("p").to_numpy()[order]
        step = max(1, CELLS // len(sources))
        for first in range(0, len(code.dictionary), step):
            last = min(first + step, len(code.dictionary))
            a, b = np.searchsorted(term, [first, last])
            cells = np.repeat(rest[:, None], last - first, axis=1)  # a row per source
            cells[column[a:b], term[a:b] - first] = value[a:b]
            for k, i in enumerate(mine):
                sums[k] += np.abs(cells - cells[i]).sum(axis=1)
    pairs = [(k, i, j) for k, i in enumerate(mine) for j in range(len(sources)) if i != j]
    return pa.table(
        {
            "lang": pa.array([langs[0]] * len(pairs), pa.string()),
            "source": pa.array([sources[i] for _, i, _ in pairs], pa.string()),
            "item": pa.array([sources[j] for _, _, j in pairs], pa.string()),
            "value": pa.array([int(sums[k, j]) for k, _, j in pairs], pa.int64()),
        }
    )


def pair_sums(shares: DataFrame, groups: DataFrame, per_task: int = SOURCES, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """lang, source, item, value for each two sources of a language. ``shares`` has p for the terms that a group has,
    ``groups`` the share ``base`` of the others."""
    sizes = groups.groupBy("lang").agg(F.ceil(F.count("*") / per_task).alias("parts"))
    sizes = sizes.join(shares.groupBy("lang").agg(F.ceil(F.count("*") / bucket_rows).alias("buckets")), "lang", "left")
    sizes = sizes.select("lang", "parts", F.coalesce("buckets", F.lit(1)).alias("buckets"))

    def numbers(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))

    groups = groups.join(sizes, "lang")
    # by source as well: a language may have most of the rows
    terms = shares.join(groups.select("lang", "source", "parts", "buckets"), ["lang", "source"]).select(
        "lang", "term", "source", "p", F.pmod(F.xxhash64("term"), "buckets").alias("bucket"), numbers("parts").alias("part")
    )
    columns = groups.withColumn("bucket", numbers("buckets")).withColumn("part", numbers("parts")).select(
        "lang", "source", "base", "bucket", "part", (F.pmod(F.xxhash64("source"), "parts") == F.col("part")).alias("own")
    )
    key = ["lang", "bucket", "part"]
    added = terms.groupBy(*key).cogroup(columns.groupBy(*key)).applyInArrow(_add_up, "lang string, source string, item string, value long")
    return added.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP, block_words: int = BLOCK_WORDS) -> DataFrame:
    """lang, source, part, item, value, rank."""
    counts = materialise(source_terms(docs, least_docs, block_words), "divergence-counts")
    groups = docs.select(_text("lang").alias("lang"), _text("source").alias("source")).distinct()
    of_lang = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"))
    langs = of_lang.groupBy("lang").agg(F.sum("lang_n").alias("lang_total"), F.count("*").alias("v"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = groups.join(langs, "lang", "left").join(totals, ["lang", "source"], "left")
    groups = materialise(
        groups.select("lang", "source", "lang_total", "v", F.coalesce("total", F.lit(0)).alias("total"))
        .withColumn("base", share(F.lit(0), F.col("total"), F.col("v"))),
        "divergence-groups",
    )
    shares = counts.join(groups, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("total"), F.col("v")))
    pairs = pair_sums(shares.select("lang", "term", "source", "p"), groups.select("lang", "source", "base"))
    above = shares.join(of_lang, ["lang", "term"]).withColumn("q", share(F.col("lang_n"), F.col("lang_total"), F.col("v")))
    above = above.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")).alias("rank")
    head = ["lang", "source"]
    return pairs.select(*head, F.lit("pair").alias("part"), "item", "value", rank).unionByName(
        above.select(*head, F.lit("term").alias("part"), "item", "value", rank).where(F.col("rank") <= top)
    )


def op13_divergence(spark, sf_dir):
    return divergence(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
t AS (
  SELECT id, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM d),
kept AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT id) >= 30),
c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
totals AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (coalesce(totals.total, 0) + 5 * v.v) AS p
  FROM g JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term
  LEFT JOIN totals ON totals.lang = g.lang AND totals.source = g.source),
q AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n) + 5)) // (sum(sum(n)) OVER (PARTITION BY lang) + 5 * any_value(v.v)) AS q
  FROM c JOIN v USING (lang) GROUP BY lang, term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS other, sum(abs(x.p - y.p)) AS value
    FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL
  ) s ON s.lang = a.lang AND s.source = a.source AND s.other = b.source),
terms AS (SELECT p.lang, p.source, p.term AS item, p.p - q.q AS value FROM p JOIN q USING (lang, term) WHERE p.n > 0 AND p.p > q.q)
SELECT lang, source, 'pair' AS part, item, value::BIGINT AS value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank
FROM pairs
UNION ALL
SELECT * FROM (
  SELECT lang, source, 'term', item, value::BIGINT, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank FROM terms)
WHERE rank <= 50
"""
