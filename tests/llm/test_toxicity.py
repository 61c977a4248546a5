import random
import zlib

import numpy as np

from millrace.llm import toxicity

LABELS = "doc_id long, quality int, toxic int"


def corpus(count, seed=2):
    rnd = random.Random(seed)
    words = [a + b for a in "the of and to in is that for".split() for b in ("", "ing", "er", "ly", "ed")]
    docs, labels = [], []
    for i in range(count):
        text = rnd.choices(words, k=rnd.randint(1, 90))
        toxic = rnd.random() < 0.3
        if toxic:
            text.insert(rnd.randint(0, len(text)), rnd.choice(["Idiot", "MORON", "scum!", "trash,"]))
        docs.append((i, " ".join(text)))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def test_held_out_accuracy(spark, documents):
    docs, labels = corpus(600)
    odd = [(2000, None), (2001, ""), (2002, "?! ..."), (None, "idiot"), (2003, "of the " * 30_000 + "idiot"), (2004, "of the " * 30_000)]
    frame = documents(docs + odd).withColumnRenamed("lang", "score")
    got = toxicity.digest(frame, spark.createDataFrame([*labels, (3, 1, None), (None, 1, 1)], LABELS)).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 606 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    rest = [(by[i].predicted, y) for i, _, y in labels if by[i].held_out]
    assert len(rest) > 100 and sum(p == y for p, y in rest) >= 0.95 * len(rest)
    assert [by[i].predicted for i in (2000, 2001, 2002, 2003, 2004)] == [0, 0, 0, 1, 0]


def test_labels_of_one_class(spark, documents):
    docs = documents([(1, "a"), (2, None)])
    assert all(r.score < 0.01 for r in toxicity.digest(docs, spark.createDataFrame([], LABELS)).collect())
    assert all(r.predicted for r in toxicity.digest(docs, spark.createDataFrame([(1, 1, 1), (2, 0, 1)], LABELS)).collect())
    assert toxicity.digest(documents([]), spark.createDataFrame([], LABELS)).count() == 0


def test_gradients():
    words, flat, bounds = toxicity.number(["a bb ccc a", "ddd ee", "f " * 40])
    net = toxicity.Network(np.random.default_rng(1).normal(size=1 << toxicity.SHARE_BITS), seed=5)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    starts, ends, _ = toxicity.windows(bounds)
    ids, target = toxicity.window_ids(flat, starts, ends), np.array([1.0, 0, 1, 0])[: len(starts)]
    assert len(starts) == 4
    _, slopes = net.gradients(words, ids, target)
    random = np.random.default_rng(2)
    for name, slope in slopes.items():
        busy = np.argwhere(np.abs(slope) > 1e-4)
        for at in busy[random.permutation(len(busy))[:4]]:
            at, kept = tuple(at), net.p[name][tuple(at)]
            sides = []
            for shift in (1e-2, -1e-2):
                net.p[name][at] = kept + shift
                sides.append(net.gradients(words, ids, target)[0])
            net.p[name][at] = kept
            assert abs((sides[0] - sides[1]) / 2e-2 - slope[at]) < 2e-3 + 0.05 * abs(slope[at]), name


def test_windows_cover_all_words():
    for size in (0, 1, 31, 32, 33, 48, 49, 100):
        starts, ends, first = toxicity.windows(np.array([5, 5 + size]))
        assert first.tolist() == [0] and starts[0] == 5 and ends[-1] == 5 + size and all(ends - starts <= 32)
        assert {i for a, b in zip(starts, ends) for i in range(a, b)} == set(range(5, 5 + size))


def test_rows_that_cannot_be_trained_on_are_replaced(spark, documents, monkeypatch):
    docs, labels = corpus(400)
    long = [(10_000 + i, "of the " * 4000) for i in range(150)]  # more than the sample, all clean and too long
    gone = [(20_000 + i, 1, i % 2) for i in range(300)]  # labels without a document
    monkeypatch.setattr(toxicity, "TOXIC_ROWS", 60)
    monkeypatch.setattr(toxicity, "CLEAN_ROWS", 120)
    seen = []
    monkeypatch.setattr(toxicity, "train", lambda texts, toxic: seen.append(toxic) or toxicity.constant(0.5))
    frame = spark.createDataFrame([*labels, *[(i, 1, 0) for i, _ in long], *gone], LABELS)
    toxicity.fit(documents(docs + long + [(30_000, None)]), frame)
    assert seen[0].sum() == 60 and (~seen[0]).sum() == 120
