import random

import numpy as np
import pytest
from pyspark.sql import functions as F
import xxhash

from millrace.llm import simhash


def slow_fingerprint(text):
    small = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in small + " ":
        if c in " \t\n\x0b\x0c\r":
            words, word = words + [word] if word else words, ""
        else:
            word += c
    if not words:
        return 0
    shingles = [words[i : i + 3] for i in range(len(words) - 2)] or [words]
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(codes, distance=3):
    root = {c: c for c in codes}

    def find(c):
        while root[c] != c:
            c = root[c]
        return c

    for a in codes:
        for b in codes:
            if (a ^ b).bit_count() <= distance:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {c: find(c) for c in codes}


def near_codes(count, seed, flips=4, centres=3):
    rnd = random.Random(seed)
    middle = [rnd.getrandbits(64) for _ in range(centres)]
    out = set()
    while len(out) < count:
        code = rnd.choice(middle)
        for _ in range(rnd.randint(0, flips)):
            code ^= 1 << rnd.randrange(64)
        out.add(code if rnd.random() < 0.9 else rnd.getrandbits(64))
    return sorted(out)


@pytest.mark.parametrize("text", [None, "", " \n", "one", "Two Words", "Ein ZWEI drei\x0bvier", "a b c a b c a b c", "ÄÖ É  x y z w"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def test_fingerprint_of_long_text():
    words = [random.Random(5).choice("abcdefgh") * 3 for _ in range(40_000)]
    assert simhash.fingerprint(" ".join(words)) == slow_fingerprint(" ".join(words[:40_000]))


@pytest.mark.parametrize("seed", range(6))
def test_index_links_what_all_pairs_link(seed):
    codes = np.array(near_codes(400, seed, flips=2 + seed), np.uint64)
    codes = codes[np.argsort(simhash.gray_rank(codes))]
    root = simhash.link_groups(codes, np.array([0, len(codes)]), 3, chunk=512)
    want = slow_components([int(c) for c in codes])
    got = {int(c): int(codes[r]) for c, r in zip(codes, root)}
    sets = lambda m: sorted(sorted(c for c in m if m[c] == r) for r in set(m.values()))
    assert sets(got) == sets(want)


def test_links_stay_within_their_group():
    codes = np.array([1, 3, 1, 3, 7], np.uint64)
    root = simhash.link_groups(codes, np.array([0, 2, 5]), 3)
    assert root.tolist() == [0, 0, 2, 2, 2]


def test_large_groups_are_dealt_again_without_losing_links(spark):
    codes = near_codes(600, 11, flips=5, centres=2)
    frame = spark.createDataFrame([(c - (1 << 64) if c >> 63 else c,) for c in codes], "code long")
    grouped = simhash.groups(frame, most=32).collect()
    sizes = {}
    for row in grouped:
        sizes[row.mask, row.key] = sizes.get((row.mask, row.key), 0) + 1
    assert max(sizes.values()) <= 32
    roots = {r.node & (1 << 64) - 1: r.root & (1 << 64) - 1 for r in simhash.connect(simhash.links(frame, most=32)).collect()}
    want = slow_components(codes)
    sets = lambda m: sorted(sorted(c for c in codes if m.get(c, c) == r) for r in {m.get(c, c) for c in codes})
    assert sets(roots) == sets(want)


def test_a_small_bound_is_refused(spark):
    with pytest.raises(ValueError):
        simhash.groups(spark.createDataFrame([(1,)], "code long"), most=8)


def test_components_against_all_pairs(spark, documents):
    rnd = random.Random(3)
    base = [" ".join(rnd.choices("alpha beta gamma delta eps zeta eta theta".split(), k=120)) for _ in range(20)]
    rows = [(i, t) for i, t in enumerate(base)] + [(100 + i, t.upper()) for i, t in enumerate(base[:7])]
    rows += [(200 + i, t + " tail") for i, t in enumerate(base)] + [(300, None), (301, ""), (302, "   "), (303, "one two"), (None, base[0]), (5, base[5])]
    got = simhash.components(documents(rows)).collect()
    prints = [slow_fingerprint(t) for _, t in rows]
    roots = slow_components(sorted(set(prints)))
    least = {}
    for (i, _), p in zip(rows, prints):
        if i is not None:
            least[roots[p]] = min(i, least.get(roots[p], i))
    want = sorted((str(i), f"{p:016x}", least[roots[p]]) for (i, _), p in zip(rows, prints))
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in got) == want


def test_keep_first(spark, documents):
    text = "the quick brown fox jumps over the lazy dog again and again"
    rows = [(3, text), (2, text.upper()), (2, text), (9, "something else entirely here"), (None, text), (None, "only null has this one"), (7, None), (8, "")]
    kept = simhash.keep_first(documents(rows).withColumn("row", F.col("n_chars")))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "row"]
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "7", "9", "None"]


def test_no_rows(documents):
    assert simhash.components(documents([])).count() == 0
    assert simhash.keep_first(documents([])).count() == 0
