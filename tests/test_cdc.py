"""SCD operators against the row-at-a-time models, incl. hot keys, ties, NULLs and any order."""

import random

import pytest

import brute
from millrace.operators import cdc as ops
from millrace.specs import Cdc, SpecError

SCHEMA = "k long, seq long, a string, b long, op string"


def random_feed(seed, rows=400, hot=0.4, ties=True):
    rnd = random.Random(seed)
    feed = []
    for i in range(rows):
        feed.append(
            {
                "k": 7 if rnd.random() < hot else rnd.randrange(12),
                "seq": rnd.randrange(rows // 2 if ties else 10**9),
                "a": rnd.choice(["x", "y", None]),
                "b": rnd.choice([1, 2, None]),
                "op": "D" if rnd.random() < 0.1 else "U",
            }
        )
    return feed


def frame(spark, feed):
    return spark.createDataFrame([tuple(r.values()) for r in feed], SCHEMA)


def is_delete(row):
    return row["op"] == "D"


def spans(df):
    return sorted(
        ((r.k, r["__START_AT"], r["__END_AT"], r.seq, r.a, r.b) for r in df.collect()), key=repr
    )


def model(feed, tracked, keep=()):
    return sorted(
        (
            (v["row"]["k"], v["start"], v["end"], v["row"]["seq"], v["row"]["a"], v["row"]["b"])
            for v in brute.scd2(feed, "k", "seq", is_delete, tracked, keep)
        ),
        key=repr,
    )


@pytest.mark.parametrize("split_rows", [None, 1000, 25])
@pytest.mark.parametrize("tracked", [None, ["a"], ["b"]])
@pytest.mark.parametrize("nulls", [False, True])
def test_scd2_matches_model(spark, split_rows, tracked, nulls):
    feed = random_feed(3)
    cdc = Cdc(["k"], "seq", 2, apply_as_deletes="op = 'D'", except_column_list=["op"],
              track_history_column_list=tracked, ignore_null_updates=nulls)
    got = ops.scd2(frame(spark, feed), cdc, split_rows)
    assert spans(got) == model(feed, tracked or ["a", "b"], ["a", "b"] if nulls else [])


def test_hot_key_is_cut_into_slices(spark):
    from millrace.operators.hotkeys import order_by_key

    feed = frame(spark, random_feed(5, rows=2000, ties=False))
    rows = ops.prepare(feed, Cdc(["k"], "seq", 2))
    (others, plain), (sliced, keyed) = order_by_key(rows, ["k"], ["__seq"], 100)
    assert keyed.sliced and not plain.sliced
    assert others.where("k = 7").count() == 0 and others.count() + sliced.count() == feed.count()
    sizes = {r["__slice"]: r["count"] for r in sliced.where("k = 7").groupBy("__slice").count().collect()}
    assert len(sizes) >= 5 and max(sizes.values()) < 400
    # slices follow the sequence
    ends = sorted(
        sliced.where("k = 7").groupBy("__slice").agg({"__seq": "min", "seq": "max"}).collect(),
        key=lambda r: r["__slice"],
    )
    assert all(a["max(seq)"] < b["min(__seq)"] for a, b in zip(ends, ends[1:]))


@pytest.mark.parametrize("limit", ["BROADCAST_KEYS", "BROADCAST_CUTS", "BROADCAST_BYTES", "MAX_SLICES"])
@pytest.mark.parametrize("nulls", [False, True])
def test_hot_keys_beyond_the_broadcast_are_cut_by_ranges(spark, monkeypatch, limit, nulls):
    from millrace.operators import hotkeys

    monkeypatch.setattr(hotkeys, limit, 1)
    feed = random_feed(5, rows=1500, ties=True)
    feed += [{"k": None, "seq": 10_000 + i, "a": str(i // 50), "b": None, "op": "U"} for i in range(300)]
    cdc = Cdc(["k"], "seq", 2, apply_as_deletes="op = 'D'", except_column_list=["op"], ignore_null_updates=nulls)
    rows = ops.prepare(frame(spark, feed), cdc)
    ((sliced, keyed),) = hotkeys.order_by_key(rows, ["k"], ["__seq"], 60)
    sizes = [r["count"] for r in sliced.groupBy(*keyed.group).count().collect()]
    assert keyed.sliced and sum(sizes) == len(feed) and max(sizes) < 200
    assert spans(ops.scd2(frame(spark, feed), cdc, 60)) == model(feed, ["a", "b"], ["a", "b"] if nulls else [])


def test_one_value_of_a_hot_key_repeated(spark):
    feed = [{"k": 7, "seq": 5, "a": "x", "b": i % 3, "op": "U"} for i in range(300)]
    feed += [{"k": 7, "seq": 6, "a": "z", "b": 1, "op": "U"}]
    cdc = Cdc(["k"], "seq", 2, except_column_list=["op"])
    assert spans(ops.scd2(frame(spark, feed), cdc, 20)) == model(feed, ["a", "b"])


def test_null_hot_key(spark):
    feed = [{"k": None, "seq": i, "a": str(i // 10), "b": 1, "op": "U"} for i in range(200)]
    cdc = Cdc(["k"], "seq", 2, except_column_list=["op"], track_history_column_list=["a"])
    got = spans(ops.scd2(frame(spark, feed), cdc, 20))
    assert got == model(feed, ["a"]) and len(got) == 20


@pytest.mark.parametrize("nulls", [False, True])
def test_scd1_matches_model(spark, nulls):
    feed = random_feed(11, ties=True)
    cdc = Cdc(["k"], "seq", 1, apply_as_deletes="op = 'D'", except_column_list=["op"], ignore_null_updates=nulls)
    got = {r.k: (r.seq, r.a, r.b) for r in ops.scd1(frame(spark, feed), cdc).collect()}
    want = brute.scd1(feed, "k", "seq", is_delete, ["a", "b"] if nulls else [])
    assert got == {k: (r["seq"], r["a"], r["b"]) for k, r in want.items()}


def test_a_value_that_lost_its_tie_is_not_kept(spark):
    events = [(1, 1, "p", 5, "U"), (1, 2, "z", None, "U"), (1, 2, "x", 9, "U")]
    feed = spark.createDataFrame(events, SCHEMA)
    one = Cdc(["k"], "seq", 1, except_column_list=["op"], ignore_null_updates=True)
    two = Cdc(["k"], "seq", 2, except_column_list=["op"], ignore_null_updates=True)
    assert ops.scd1(feed, one).first().b == ops.current(ops.scd2(feed, two)).first().b == 5


@pytest.mark.parametrize("nulls", [False, True])
def test_truncate_clears_older_keys(spark, nulls):
    feed = random_feed(13, ties=True)
    bound = sorted(r["seq"] for r in feed)[len(feed) * 3 // 4]
    marked = [dict(r, op="T") if r["seq"] == bound else r for r in feed]
    cdc = Cdc(["k"], "seq", 1, apply_as_deletes="op = 'D'", apply_as_truncates="op = 'T'",
              except_column_list=["op"], ignore_null_updates=nulls)
    got = {r.k: (r.seq, r.a, r.b) for r in ops.scd1(frame(spark, marked), cdc).collect()}
    rest = [r for r in marked if r["op"] != "T"]
    want = brute.scd1(rest, "k", "seq", is_delete, ["a", "b"] if nulls else [], bound)
    assert got == {k: (r["seq"], r["a"], r["b"]) for k, r in want.items()}
    assert 0 < len(got) <= 12


@pytest.mark.parametrize("nulls", [False, True])
def test_partial_states_merge_in_any_split(spark, nulls):
    feed = random_feed(17, ties=True)
    cdc = Cdc(["k"], "seq", 1, apply_as_deletes="op = 'D'", ignore_null_updates=nulls)
    whole = ops.scd1(frame(spark, feed), cdc)
    random.Random(1).shuffle(feed)
    reduce = ops.scd1_winners if nulls else ops.scd1_partial
    parts = [reduce(ops.prepare(frame(spark, feed[i::3]), cdc), cdc, whole.columns) for i in range(3)]
    # the second part twice: a replay must not matter
    every = parts[1].unionByName(parts[0]).unionByName(parts[2]).unionByName(parts[1])
    if nulls:
        merged = ops.scd1_partial(ops.scd1_winners(every, cdc, whole.columns), cdc, whole.columns)
    else:
        merged = ops.scd1_merge(every, cdc)
    again = ops.scd1_finish(merged, cdc, whole.columns)
    assert sorted(map(repr, again.collect())) == sorted(map(repr, whole.collect()))


def test_current_of_scd2_is_scd1(spark):
    feed = frame(spark, random_feed(19))
    two = Cdc(["k"], "seq", 2, apply_as_deletes="op = 'D'")
    one = Cdc(["k"], "seq", 1, apply_as_deletes="op = 'D'")
    left = ops.current(ops.scd2(feed, two)).drop("__START_AT", "__END_AT")
    assert sorted(map(repr, left.collect())) == sorted(map(repr, ops.scd1(feed, one).collect()))


def test_intervals_do_not_overlap(spark):
    cdc = Cdc(["k"], "seq", 2, apply_as_deletes="op = 'D'")
    rows = ops.scd2(frame(spark, random_feed(23)), cdc, 30).collect()
    by_key = {}
    for r in rows:
        by_key.setdefault(r.k, []).append((r["__START_AT"], r["__END_AT"]))
    for pairs in by_key.values():
        pairs.sort()
        assert all(a[1] is not None and a[1] <= b[0] for a, b in zip(pairs, pairs[1:]))
        assert all(e is None or s < e for s, e in pairs)


def test_null_sequence_is_an_error(spark):
    feed = spark.createDataFrame([(1, None, "x", 1, "U")], SCHEMA)
    with pytest.raises(Exception, match="NULL in sequence_by"):
        ops.scd1(feed, Cdc(["k"], "seq")).collect()


def test_composite_sequence(spark):
    rows = [(1, 1, "x", 2, "U"), (1, 1, "y", 1, "U"), (1, 0, "z", 9, "U")]
    feed = spark.createDataFrame(rows, SCHEMA)
    cdc = Cdc(["k"], "seq, b", 2, track_history_column_list=["a"])
    got = sorted((r["__START_AT"], str(r["__END_AT"]), r.a) for r in ops.scd2(feed, cdc).collect())
    assert got == [(0, "1", "z"), (1, "1", "y"), (1, "None", "x")]


def test_sequence_expression(spark):
    feed = spark.createDataFrame(
        [(1, "03-01-2022", "old"), (1, "02-15-2023", "new")], "k long, day string, a string"
    )
    by_text = ops.scd1(feed, Cdc(["k"], "day")).first()["a"]
    by_time = ops.scd1(feed, Cdc(["k"], "to_timestamp(day, 'MM-dd-yyyy')")).first()["a"]
    assert (by_text, by_time) == ("old", "new")


def test_settings_are_checked():
    for bad in (
        dict(keys=[], sequence_by="s"),
        dict(keys=["k"], sequence_by=""),
        dict(keys=["k"], sequence_by="s", scd_type=3),
        dict(keys=["k"], sequence_by="s", scd_type=2, apply_as_truncates="x"),
        dict(keys=["k"], sequence_by="s", column_list=["a"], except_column_list=["b"]),
        dict(keys=["k"], sequence_by="s", scd_type=1, track_history_column_list=["a"]),
    ):
        with pytest.raises(SpecError):
            Cdc(**bad)
    with pytest.raises(SpecError, match="missing"):
        Cdc.from_dict({"keys": ["k"]})
    with pytest.raises(SpecError, match="unknown"):
        Cdc.from_dict({"keys": ["k"], "sequence_by": "s", "nope": 1})
