"""Quality classifier: support vectors on n-gram indicators scaled by naive Bayes log-count ratios.

Features. A text is read as a string of character classes: small letter, capital, digit, white space, and every
other character as itself. Runs of the first four are cut to one. The n-grams of this string up to five, hashed to
``2 ** BITS`` numbers, are the indicators, with two more for a word that stands twice or three times in a row.

Weights. The log-count ratio of an indicator is that of its share in good and in bad documents, counted over all
labelled rows that may be learnt from. Indicators times ratios, at unit length, go to a linear classifier with
hinge loss, fitted by dual coordinate descent on at most ``FIT_ROWS`` of these rows (those with the smallest hash of
their id). A sigmoid fitted on a fifth of them, which the descent does not see, turns margins into scores.

Defined results: NULL and empty texts have the indicators of an empty text and get a score. Labels that are NULL or have
a NULL id are not used; a document with several labels counts as good if more than half are 1. With labels of one
class only, or none, every score is the share of good labels (0.5 without labels). Rows with equal texts get equal scores.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import Shared, fresh_name, in_train, map_batches, smallest_hashes, table
from millrace.session import materialise

BITS = 16
LONGEST = 5
FIT_ROWS = 8_000
THRESHOLD = 0.3
HELD_OUT = (5, 0)  # rows whose checksum of the id leaves remainder 0 by 5 are not learnt from

SMALL, CAPITAL, DIGIT, SPACE = 97, 65, 48, 32
CLASSES = bytes(
    SMALL if 97 <= b <= 122 or b >= 128 else CAPITAL if 65 <= b <= 90 else DIGIT if 48 <= b <= 57
    else SPACE if b in (9, 10, 11, 12, 13, 32) else b
    for b in range(256)
)


def indicators(text: str | None) -> np.ndarray:
    """The numbers of the indicators that are set, ascending."""
    raw = (text or "").encode("utf-8", "replace")
    classes = np.frombuffer(b" " + raw.translate(CLASSES) + b" ", np.uint8)
    runs = np.zeros(256, bool)
    runs[[SMALL, CAPITAL, DIGIT, SPACE]] = True
    kept = classes[np.concatenate(([True], (classes[1:] != classes[:-1]) | ~runs[classes[1:]]))].astype(np.uint32)
    marks = np.zeros(1 << BITS, bool)
    grams = kept
    for n in range(1, LONGEST + 1):
        if n > 1:
            grams = grams[:-1] * np.uint32(257) + kept[n - 1 :]
        marks[((grams + np.uint32(n * 7919)) * np.uint32(2654435761)) >> np.uint32(32 - BITS)] = True
    words = raw.lower().split()
    codes = np.fromiter(map(hash, words), np.int64, len(words))
    again = codes[1:] == codes[:-1]
    marks[0], marks[1] = again.any(), (again[1:] & again[:-1]).any()
    return np.flatnonzero(marks).astype(np.int32)


def with_indicators(docs: DataFrame, text: str = "text") -> tuple[DataFrame, str]:
    """``docs`` without the text and with an array column of indicators, and its name."""
    name = fresh_name("indicators", docs.columns)
    at = docs.columns.index(text)
    rest = [i for i in range(len(docs.columns)) if i != at]

    def read(batches):
        for batch in batches:
            found = [indicators(t) for t in batch.column(at).to_pylist()]
            ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
            values = pa.array(np.concatenate(found) if found else np.empty(0, np.int32))
            column = pa.ListArray.from_arrays(pa.array(ends), values)
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in rest], column], names=[*[batch.schema.names[i] for i in rest], name])

    fields = [docs.schema.fields[i] for i in rest]
    return map_batches(docs, read, T.StructType([*fields, T.StructField(name, T.ArrayType(T.IntegerType()))])), name


def one_label(labels: DataFrame, column: str) -> DataFrame:
    """A row per id: doc_id and y, 1 where more than half of its labels are 1."""
    return (
        labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull())
        .groupBy("doc_id")
        .agg((F.avg((F.col(column) == 1).cast("double")) > 0.5).cast("int").alias("y"))
    )


def descend(rows: list[np.ndarray], targets: np.ndarray, size: int, values: list[np.ndarray], cost: float = 1.0, epochs: int = 20) -> tuple[np.ndarray, float]:
    """Weights and intercept of the hinge-loss classifier, by coordinate descent on its dual.

    Row i has ``values[i]`` at the numbers ``rows[i]``; targets are 1 and -1. The intercept is a feature that is always 1.
    """
    weights, intercept = np.zeros(size), 0.0
    dual = np.zeros(len(rows))
    curvature = np.array([v @ v + 1.0 for v in values])
    random = np.random.default_rng(0)
    for _ in range(epochs):
        moved = 0.0
        for i in random.permutation(len(rows)):
            slope = targets[i] * (weights[rows[i]] @ values[i] + intercept) - 1.0
            new = min(max(dual[i] - slope / curvature[i], 0.0), cost)
            change = (new - dual[i]) * targets[i]
            if change:
                weights[rows[i]] += change * values[i]
                intercept += change
                dual[i] = new
                moved = max(moved, abs(change))
        if moved < 1e-3:
            break
    return weights, intercept


def fit_sigmoid(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the sigmoid of a margin, with targets held off 0 and 1 as for Platt scaling."""
    positive, negative = good.sum(), (~good).sum()
    target = np.where(good, (positive + 1) / (positive + 2), 1 / (negative + 2))
    slope, shift = 1.0, float(np.log((positive + 1) / (negative + 1)))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + shift, -500, 500)))
        error, weight = p - target, np.maximum(p * (1 - p), 1e-9)
        gradient = np.array([error @ margins, error.sum()])
        hessian = np.array([[weight @ margins**2, weight @ margins], [weight @ margins, weight.sum()]]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        step *= min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        slope, shift = slope - step[0], shift - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(slope), float(shift)


class Model:
    """Score of a set of indicators; ``weights`` holds classifier weight times ratio, ``ratio`` the ratios."""

    def __init__(self, ratio: np.ndarray, weights: np.ndarray, intercept: float, sigmoid: tuple[float, float]):
        self.ratio, self.weights, self.intercept, self.sigmoid = ratio, weights, intercept, sigmoid

    def margin(self, rows: np.ndarray) -> float:
        values = self.ratio[rows]
        return float(self.weights[rows] @ values / max(np.sqrt(values @ values), 1e-12) + self.intercept)

    def score(self, rows: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.sigmoid[0] * self.margin(rows) + self.sigmoid[1], -500, 500))))


def constant(share: float) -> Model:
    share = min(max(share, 1e-6), 1 - 1e-6)
    zero = np.zeros(1 << BITS)
    return Model(zero, zero, 0.0, (0.0, float(np.log(share / (1 - share)))))


def train(features: DataFrame, name: str, labels: DataFrame, column: str = "quality", fit_rows: int = FIT_ROWS) -> Model:
    """Fit on the rows of ``features`` (doc_id and the array ``name``) that have labels and may be learnt from."""
    learnt = materialise(
        features.select("doc_id", F.col(name).alias("f"))
        .where(in_train("doc_id", *HELD_OUT))
        .join(one_label(labels, column), "doc_id"),
        "quality-rows",
    )
    counts = {row.y: row.n for row in learnt.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return constant(next((float(y) for y in counts), 0.5))
    size = 1 << BITS
    ratio = np.zeros(size)
    sums = np.ones((2, size))
    for row in learnt.select("y", F.explode("f").alias("f")).groupBy("f").agg(F.sum("y").alias("good"), F.count("*").alias("all")).collect():
        sums[:, row.f] += (row.all - row.good, row.good)  # at most 2 ** BITS rows
    ratio = np.log(sums[1] / sums[1].sum()) - np.log(sums[0] / sums[0].sum())
    sample = smallest_hashes(learnt, "doc_id", fit_rows).collect()
    rows = [np.array(r.f, np.int32) for r in sample]
    good = np.array([r.y == 1 for r in sample])
    if good.all() or not good.any():
        return constant(counts.get(1, 0) / sum(counts.values()))
    values = [ratio[r] / max(np.sqrt(ratio[r] @ ratio[r]), 1e-12) for r in rows]
    # every fifth row of a class is left to the sigmoid
    place = np.empty(len(good), np.int64)
    for side in (good, ~good):
        place[side] = np.arange(side.sum())
    fit = np.flatnonzero(place % 5 != 4)
    weights, intercept = descend([rows[i] for i in fit], np.where(good[fit], 1.0, -1.0), size, [values[i] for i in fit])
    rest = np.flatnonzero(place % 5 == 4)
    if not good[rest].any() or good[rest].all():
        rest = np.arange(len(good))
    margins = np.array([weights[rows[i]] @ values[i] + intercept for i in rest])
    return Model(ratio, weights, intercept, fit_sigmoid(margins, good[rest]))


def score_indicators(features: DataFrame, name: str, model: Model, out: str) -> DataFrame:
    """The columns of ``features`` with the score ``out`` in place of the indicators."""
    at = features.columns.index(name)
    sent = Shared(features.sparkSession, model)

    def score(batches):
        for batch in batches:
            column = batch.column(at)
            ends, numbers = column.offsets.to_numpy(), column.values.to_numpy()
            scores = [sent.value.score(numbers[a:b]) for a, b in zip(ends[:-1], ends[1:])]
            columns = [*batch.columns]
            columns[at] = pa.array(scores, pa.float64())
            yield pa.RecordBatch.from_arrays(columns, names=[out if i == at else n for i, n in enumerate(batch.schema.names)])

    fields = [T.StructField(out, T.DoubleType()) if f.name == name else f for f in features.schema.fields]
    return map_batches(features, score, T.StructType(fields))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted. The texts are read once."""
    features, name = with_indicators(docs.select("doc_id", "text"))
    features = materialise(features, "quality-indicators")
    scored = score_indicators(features, name, train(features, name, labels), "score")
    return scored.select(
        "doc_id",
        F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % HELD_OUT[0] == HELD_OUT[1], F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score at least ``threshold``, with their columns."""
    features, name = with_indicators(docs.select("doc_id", "text"))
    model = train(materialise(features, "quality-indicators"), name, labels)
    sent = Shared(docs.sparkSession, model)
    at = docs.columns.index("text")

    def keep(batches):
        for batch in batches:
            good = [sent.value.score(indicators(t)) >= threshold for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(good, pa.bool_()))

    return map_batches(docs, keep, docs.schema)


def op5_quality(spark, sf_dir):
    return digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
