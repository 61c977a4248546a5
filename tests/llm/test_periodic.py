import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import periodic


def plain_runs(words, least=12):
    found = {}
    for p in range(1, len(words) // 2 + 1):
        i = 0
        while i + p < len(words):
            k = i
            while k + p < len(words) and words[k] == words[k + p]:
                k += 1
            if k > i and k + p - i >= max(least, 2 * p):
                found.setdefault((i, k + p - i), p)
            i = max(k, i + 1)
    return sorted((s, n, p) for (s, n), p in found.items())


def some_words(choose):
    size = choose.randint(0, 90)
    unit = [choose.randint(0, choose.choice([1, 1, 4])) for _ in range(choose.randint(1, 9))]
    fibonacci = [[0], [0, 1]]
    while len(fibonacci[-1]) < size:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    return choose.choice(
        [
            [choose.randint(0, 1) for _ in range(size)],
            [choose.randint(0, 2) for _ in range(size)],
            [choose.randint(0, 50) for _ in range(size)],
            [0] * size,
            [3, 4] + (unit * 90)[:size] + [5, 0],
            (((unit * 5)[: choose.randint(1, 15)] + [9]) * 90)[:size],
            fibonacci[-1][:size],
        ]
    )


def test_runs_of_many_documents():
    choose = random.Random(5)
    for _ in range(150):
        docs = [some_words(choose) for _ in range(choose.randint(1, 12))]
        words = np.array([w for d in docs for w in d], np.int64)
        got = periodic.find_runs(words, np.cumsum([0, *map(len, docs)]), pairs=choose.choice([50, 1000, 1 << 20]))
        assert list(zip(*(c.tolist() for c in got))) == [(k, s, n, p) for k, d in enumerate(docs) for s, n, p in sorted(plain_runs(d), key=lambda r: (r[0], r[2]))]


@pytest.mark.parametrize("size", [1, 2, 7, 300])
def test_extension_in_both_directions(size):
    choose = np.random.default_rng(size)
    for _ in range(20):
        words = np.concatenate(([100], choose.integers(0, 2, size), [101]))
        grammar = periodic.Grammar(words, np.bincount(words, minlength=102)[words] > 1)
        i, j = choose.integers(0, len(words), 200), choose.integers(0, len(words), 200)
        i, j = i[i != j], j[i != j]
        for way in (1, -1):
            got = grammar.extend(i, j, way == 1)
            for a, b, n in zip(i.tolist(), j.tolist(), got.tolist()):
                want = 0
                while words[a + way * want] == words[b + way * want]:
                    want += 1
                assert n == want


def plain_digest(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = sorted(plain_runs(words), key=lambda r: (r[0], r[2]))
    dropped = {i for s, n, p in runs for i in range(s + p, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha("".join(f"{s},{n},{p}\n" for s, n, p in runs)),
        sha(" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


def test_query_rows(documents):
    choose = random.Random(7)
    rows = [(i, " ".join(choose.choice("abcde") for _ in range(choose.randint(0, 200)))) for i in range(150)]
    rows += [(None, "x " * 40), (1001, None), (1002, ""), (1003, " \n\t\x0b\x0c\r "), (1004, "\xa0 x\x1cy  " * 30), (1005, "é " * 20_000), (7, "a b " * 9), (7, "a b " * 9)]
    docs = documents(rows).withColumn("runs", F.lit("clash")).withColumn("start", F.lit(1))
    got = periodic.digest(docs).select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    assert {t for _, t in got.dtypes} == {"bigint", "string"}
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows if i) > 5
    want = sorted(str(plain_digest(*r)) for r in rows if r[0] != 1005)
    assert sorted(str(tuple(r)) for r in got.where("doc_id IS NULL OR doc_id <> 1005").collect()) == want
    (long,) = got.where("doc_id = 1005").collect()
    assert (long.n_runs, long.length) == (1, 20_000)


def test_spans_and_texts(documents):
    (row,) = periodic.periodic_runs(documents([(1, "start " + "a b c " * 5 + "end")])).collect()
    assert [tuple(r) for r in row.runs] == [(1, 15, 3)] and row.collapsed == "start a b c end"
    assert periodic.digest(documents([])).count() == 0
