import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.llm import divergence


def plain(rows, least_docs, top=50):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found, df = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(low))
        found[lang or "", source or ""].update(terms)
        df[lang or ""].update(set(terms))
    out = []
    for lang in {g for g, _ in found}:
        kept = [t for t, n in df[lang].items() if n >= least_docs]
        groups = {s: c for (g, s), c in found.items() if g == lang}

        def shares(count):
            total = sum(count[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 1_000_000_000 * (count[t] + 5) // total for t in kept}

        p = {s: shares(c) for s, c in groups.items()}
        q = shares(sum(groups.values(), Counter()))
        for s in groups:
            parts = {
                "pair": [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in groups if o != s],
                "term": [(t, p[s][t] - q[t]) for t in kept if groups[s][t] and p[s][t] > q[t]],
            }
            for part, items in parts.items():
                items.sort(key=lambda i: (-i[1], i[0].encode()))
                out += [(lang, s, part, i, v, r) for r, (i, v) in enumerate(items, 1) if part == "pair" or r <= top]
    return sorted(out)


def some_rows(size, seed=0):
    choose = random.Random(seed)
    words = ["the", "The,", "THE", "of", "(of)", "o-f", "été", "ÉTÉ", "naïve,naïve", "x1y", "123", "--", "日本", "a|a|a|b", "don't"] + [f"w{chr(97 + i)}" for i in range(26)]
    text = lambda: "".join(choose.choice(words) + choose.choice([" ", "\n", "  ", "\t", "\x0b", "\xa0"]) for _ in range(choose.randint(0, 30)))
    return [(i, text(), choose.choice(["en", "en", "de"]), choose.choice(["s0", "s0", "s1", "s2", "é"])) for i in range(size)]


@pytest.mark.parametrize("block_words, least_docs", [(1_000_000, 30), (50, 3), (1, 40)])
def test_against_plain(documents, block_words, least_docs):
    rows = some_rows(120) + [
        (None, "the of", None, None), (1, None, "en", "empty"), (1, "", None, "s1"), (1, "the " * 3000, "en", "s0"), (1, "the " * 3000, "en", "s0"),
        (2, "zz" * 5000, "", ""), (3, "a|" * 3000, "en", "s1"), (4, "1 2 3", "fr", "s1"), (4, "4", "fr", "s2"),
    ]
    docs = documents(rows).withColumn("n", F.lit("clash")).withColumn("term", F.lit(1)).repartition(3)
    got = divergence.divergence(docs, least_docs, block_words=block_words)
    assert sorted(map(tuple, got.collect())) == plain(rows, least_docs)


def test_sources_and_terms_dealt_to_many_tasks(spark):
    choose = random.Random(1)
    sources, terms = [f"s{i}" for i in range(9)], [f"t{i}" for i in range(40)]
    base = {s: choose.randint(1, 9) for s in sources}
    shares = {(s, t): choose.randint(1, 10**9) for s in sources for t in terms if choose.random() < 0.4}
    left = spark.createDataFrame([("en", t, s, p) for (s, t), p in shares.items()], "lang string, term string, source string, p long")
    right = spark.createDataFrame([("en", s, b) for s, b in base.items()] + [("xx", "a", None), ("xx", "b", None)], "lang string, source string, base long")
    got = {(r.lang, r.source, r.item): r.value for r in divergence.pair_sums(left, right, per_task=2, bucket_rows=7).collect()}
    # terms that no source has are no kept terms
    seen = {t for _, t in shares}
    value = lambda s, t: shares.get((s, t), base[s])
    want = {("en", a, b): sum(abs(value(a, t) - value(b, t)) for t in seen) for a in sources for b in sources if a != b}
    assert got == {**want, ("xx", "a", "b"): 0, ("xx", "b", "a"): 0}


def test_no_rows(documents):
    assert divergence.divergence(documents([])).count() == 0
