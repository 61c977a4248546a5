import random
import zlib

import numpy as np
import pytest

from millrace.llm import quality

LABELS = "doc_id long, quality int, toxic int, score double"


def corpus(count, seed=1):
    rnd = random.Random(seed)
    words = "the of and to in is that for it as was with be by on".split()
    docs, labels = [], []
    for i in range(count):
        text = " ".join(rnd.choices(words, k=rnd.randint(5, 60))) + "."
        good = rnd.random() < 0.7
        if not good:
            kind = i % 3
            text = text.upper().replace(" ", "!! ") if kind == 0 else text.replace(" ", "### ") if kind == 1 else " ".join(w + " " + w + " " + w for w in text.split())
        docs.append((i, text))
        if i % 2:
            labels.append((i, int(good), 0, 1.0))
    return docs, labels


def test_held_out_accuracy(spark, documents):
    docs, labels = corpus(900)
    odd = [(2000, None), (2001, ""), (None, "the of and"), (5, docs[5][1])]
    bad = [(5, None, 0, 1.0), (None, 1, 0, 1.0), (1, 1 - labels[0][1], 0, 1.0), (1, labels[0][1], 0, 1.0), (1, labels[0][1], 0, 1.0)]
    frame = documents(docs + odd).withColumnRenamed("lang", "score").withColumnRenamed("source", "indicators")
    got = quality.digest(frame, spark.createDataFrame(labels + bad, LABELS)).collect()
    assert len(got) == 904
    by = {r.doc_id: r for r in got}
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert by[2000].score == by[2001].score and len({r.score for r in got if r.doc_id == 5}) == 1
    rest = [(by[i].predicted, y) for i, y, *_ in labels if by[i].held_out]
    assert len(rest) > 60 and sum(p == y for p, y in rest) >= 0.95 * len(rest)
    kept = quality.keep_good(frame, spark.createDataFrame(labels + bad, LABELS))
    assert kept.columns == frame.columns and kept.count() == sum(r.predicted for r in got)


@pytest.mark.parametrize("labels,score", [([], 0.5), ([(1, 1, 0, 0.0), (2, 1, 0, 0.0), (3, 1, 0, 0.0)], 1.0)])
def test_labels_of_one_class(spark, documents, labels, score):
    got = quality.digest(documents([(1, "a"), (2, "b"), (3, None)]), spark.createDataFrame(labels, LABELS)).collect()
    assert all(abs(r.score - score) < 1e-5 for r in got)
    assert quality.digest(documents([]), spark.createDataFrame(labels, LABELS)).count() == 0


def test_descent_reaches_the_optimum():
    random = np.random.default_rng(3)
    x = random.normal(size=(60, 4))
    y = np.where(x @ [1.0, -2, 0.5, 0] + 0.3 * random.normal(size=60) > 0, 1.0, -1.0)
    every = [np.arange(4)] * 60
    weights, shift = quality.descend(every, y, 4, list(x), cost=0.5, epochs=3000)

    def loss(w, b):
        return 0.5 * (w @ w + b * b) + 0.5 * np.maximum(0, 1 - y * (x @ w + b)).sum()

    best = loss(weights, shift)
    for _ in range(300):
        assert loss(weights + 0.02 * random.normal(size=4), shift + 0.02 * random.normal()) >= best - 1e-3


def test_indicators():
    assert quality.indicators(None).tolist() == quality.indicators("").tolist()
    assert not {0, 1} & set(quality.indicators("a b a b").tolist()) - set(quality.indicators("x y z w").tolist())
    assert 0 in quality.indicators("a a b") and 1 in quality.indicators("A a a")
    assert quality.indicators("Abc def 12").tolist() == quality.indicators("Xy z 345").tolist()


def test_very_long_texts(spark, documents):
    docs, labels = corpus(300)
    long = "the of and to in is that for it as was with be by on. " * 20_000
    got = {r.doc_id: r for r in quality.digest(documents([*docs, (5000, long), (5001, long.upper().replace(" ", "!! "))]), spark.createDataFrame([(*x,) for x in labels], LABELS)).collect()}
    assert got[5000].predicted == 1 and got[5001].score < got[5000].score
