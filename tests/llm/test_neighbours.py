import numpy as np

from millrace.llm import neighbours

ROWS = "vec_id long, embedding array<float>, label int, leaf string"


def brute(rows, queries, k=10):
    ids = np.array([r[0] for r in rows])
    vectors = np.array([r[1] for r in rows], np.float32).astype(float)
    out = {}
    for q in queries:
        far = np.sqrt(((vectors - vectors[np.flatnonzero(ids == q)[0]]) ** 2).sum(1))
        far[ids == q] = np.inf
        order = np.lexsort((ids, far))[:k]
        out[q] = [(int(ids[i]), float(far[i])) for i in order if np.isfinite(far[i])]
    return out


def found(spark, rows):
    index = neighbours.Index(spark.createDataFrame([(*r, 1, "x") for r in rows], ROWS))
    got = {}
    for r in sorted(index.search(index.rows.where("vec_id % 100 = 0")).collect(), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return got


def test_recall_and_hot_vectors(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SLICE", 200)
    monkeypatch.setattr(neighbours, "QUERY_SLICE", 3)
    random = np.random.default_rng(0)
    vectors = random.normal(size=(1800, 16)) + 3 * random.normal(size=(20, 16))[random.integers(20, size=1800)]
    vectors[::3] = vectors[0]  # a third are equal
    rows = [(i, vectors[i].tolist()) for i in range(1800)]
    got, want = found(spark, rows), brute(rows, range(0, 1800, 100))
    assert set(got) == set(want)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)
    for q in (0, 300, 600):  # ties go to the smaller id
        assert got[q] == want[q]
    exact = {(q, i): s for q in want for i, s in brute(rows, [q], 1800)[q]}
    assert all(abs(s - exact[q, i]) < 1e-9 for q in got for i, s in got[q])


def test_rows_that_take_no_part(spark):
    good = [(i, [float(i + 1), 1.0]) for i in (0, 1, 2, 100)]
    bad = [(200, None), (300, []), (400, [0.0, 0.0]), (500, [1.0, None]), (600, [float("nan"), 1.0]), (700, [float("inf"), 1.0]), (None, [1.0, 1.0]), (800, [1.0, 2.0, 3.0])]
    assert found(spark, good + bad) == brute(good, [0, 100])


def test_few_or_no_rows(spark):
    assert found(spark, []) == {} and found(spark, [(100, [1.0])]) == {}
    assert found(spark, [(100, [1.0]), (1, [3.0])]) == {100: [(1, 2.0)]}


def test_leaves_are_listed_once_each():
    tree = neighbours.Tree(np.random.default_rng(1).normal(size=(900, 5)))
    assert len(tree.leaves) > 10 and sorted(tree.visits(np.zeros(5))) == tree.leaves


def test_repeated_ids_and_columns_named_like_inner_ones(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [2.0, 0.0]), (1, [3.0, 0.0]), (100, [2.5, 0.0])]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], ROWS).selectExpr("*", "1 AS vector", "2 AS slice", "3 AS part", "4 AS query_id", "5 AS rank", "6 AS score")
    index = neighbours.Index(frame)
    got = sorted((r.query_id, r.vec_id, r.score) for r in index.search(index.rows.where("vec_id = 100")).collect())
    assert got == [(100, 0, 1.5), (100, 0, 1.5), (100, 1, 0.5), (100, 1, 0.5)]
