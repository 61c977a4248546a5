import collections
import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from millrace.llm import mixing

WEIGHTS = {("a",): 3.0, ("b",): 1.0, ("*", "en"): 2.0, ("a", "fr"): 5.0, ("*", "xx"): 0.0}
def levels():
    return {"top": F.col("source"), "lang_": F.col("lang")}


def weight(path):
    if len(path) == 1:
        return WEIGHTS.get(path, 1.0)
    return WEIGHTS.get(path, WEIGHTS.get(("*", path[1]), 1.0))


def fill(budget, rooms):
    """{path: room} -> {path: share}, full children taken out until none is full."""
    out, left = dict.fromkeys(rooms, 0.0), {p for p, room in rooms.items() if weight(p) > 0 and room > 0}
    while left and budget > 1e-9:
        rate = budget / sum(map(weight, left))
        full = {p for p in left if rooms[p] <= rate * weight(p)}
        if not full:
            return out | {p: rate * weight(p) for p in left}
        out |= {p: rooms[p] for p in full}
        budget -= sum(rooms[p] for p in full)
        left -= full
    return out


def slow(rows, share, epochs, seed):
    tokens = [len((r[1] or "").encode().split()) for r in rows]
    leaves = collections.defaultdict(list)
    for r, t in zip(rows, tokens):
        leaves[r[3], r[2]].append((r, t))
    room = {leaf: epochs * sum(t for _, t in members) for leaf, members in leaves.items()}
    tops = {(top,): sum(n for leaf, n in room.items() if leaf[0] == top and weight(leaf) > 0) for top, _ in leaves}
    chosen = collections.Counter()
    for (top,), budget in fill(min(share, epochs) * sum(tokens), tops).items():
        for leaf, given in fill(budget, {leaf: n for leaf, n in room.items() if leaf[0] == top}).items():
            total = room[leaf] // epochs
            whole = min(int(given / max(total, 1) + 1e-9), epochs)
            rest = int(given - whole * total + 1e-6)
            for r, _ in leaves[leaf]:
                for epoch in range(whole):
                    chosen[r[0], epoch] += 1
            if whole == epochs or rest <= 0:
                continue
            place = lambda r: hashlib.md5(f"{seed}/{whole}/{'' if r[0] is None else r[0]}/{hashlib.md5((r[1] or '').encode()).hexdigest()}".encode()).hexdigest()  # noqa: B023, E731
            groups = collections.defaultdict(list)
            for r, t in leaves[leaf]:
                groups[place(r)].append((r, t))
            done = 0
            for _, members in sorted(groups.items()):
                done += sum(t for _, t in members)
                if done > rest:
                    break
                for r, _ in members:
                    chosen[r[0], whole] += 1
    return chosen


def corpus(seed):
    rnd = random.Random(seed)
    rows = [(i, " ".join(["w"] * rnd.randint(0, 30)), rnd.choice(["en", "fr", "xx", None]), "a" if rnd.random() < 0.4 else rnd.choice(["b", "c", None])) for i in range(300)]
    return rows + [(1000, None, "en", "a"), (1001, "", "fr", "b"), (None, "w w", "en", "c"), (5, rows[5][1], rows[5][2], rows[5][3]), (1002, "w " * 5_000, "de", "c")]


@pytest.mark.parametrize("seed,share,epochs,per_bucket", [(1, 0.5, 2, 7), (2, 1.3, 3, 50), (3, 9.0, 2, 2000)])
def test_against_a_plain_version(documents, seed, share, epochs, per_bucket):
    rows = corpus(seed)
    frame = documents(rows).withColumn("epoch", F.lit("own")).withColumn("tokens", F.lit(-1))
    mixed, names = mixing.mix(frame, levels(), WEIGHTS, share, epochs, 11, per_bucket=per_bucket)
    assert mixed.columns[: len(frame.columns)] == frame.columns and names["epoch"] == "_epoch"
    got = collections.Counter((r.doc_id, r[names["epoch"]]) for r in mixed.collect())
    assert got == slow(rows, share, epochs, 11)


def test_no_rows(documents):
    assert mixing.mix_documents(documents([])).count() == 0
    assert mixing.mix_documents(documents([(1, "a b", "en", "src3")])).columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_sources_without_a_small_number(documents):
    sources = ["", "web", "src" + "9" * 29 + "7", "9" * 30, "src3", "7src", "src2147483650", "src٣", None]
    docs = documents([(i, "w w w", "en", s) for i, s in enumerate(sources)])
    got = {r.source: r.domain for r in docs.select("source", mixing.op7_levels()["domain"].alias("domain")).collect()}
    by_sum = lambda s: f"d{zlib.crc32(s.encode()) % 4}"
    assert got == {
        "": by_sum(""), "web": by_sum("web"), sources[2]: f"d{int(sources[2][3:]) % 4}", "9" * 30: f"d{int('9' * 30) % 4}", "src3": "d3", "7src": by_sum("7src"),
        "src2147483650": "d2", "src٣": by_sum("src٣"), None: None,
    }
    chosen = mixing.mix_documents(docs)
    assert chosen.columns == docs.columns and 0 < chosen.count() <= 2 * len(sources)


def test_a_node_has_no_room_below_weightless_children(spark):
    leaves = spark.createDataFrame(
        [("a", "en", "1", 500.0), ("a", "xx", "1", 500.0), ("b", "en", "1", 400.0), ("b", "en", "2", 600.0), ("c", "en", "off", 900.0)],
        "top string, lang_ string, leaf string, tokens double",
    )
    weights = {("*", "xx"): 0.0, ("*", "*", "off"): 0.0}
    got = {(r.top, r.lang_, r.leaf): r.budget for r in mixing.budgets(leaves, ["top", "lang_", "leaf"], weights, 1400.0, 1).collect()}
    assert sum(got.values()) == pytest.approx(1400)  # 1500 could be given
    assert got["a", "en", "1"] == pytest.approx(500) and got["a", "xx", "1"] == got["c", "en", "off"] == 0
    assert got["b", "en", "1"] == pytest.approx(400) and got["b", "en", "2"] == pytest.approx(500)
