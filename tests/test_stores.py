"""Incremental = recompute, whatever the order and the batches; replays change nothing."""

import random

import pytest

from millrace.operators import cdc as ops
from millrace.operators import snapshot as snap
from millrace.specs import Cdc, SnapshotCdc
from millrace.streaming.scd import Scd1Store, Scd2Store, standing
from millrace.streaming.snapshots import SnapshotStore
from test_cdc import frame, random_feed


def rows(df):
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


def batches(feed, shuffled, count=4):
    feed = sorted(feed, key=lambda r: r["seq"])
    if shuffled:
        random.Random(2).shuffle(feed)
    size = -(-len(feed) // count)
    return [feed[i : i + size] for i in range(0, len(feed), size)]


@pytest.mark.parametrize("shuffled", [False, True])
@pytest.mark.parametrize("nulls", [False, True])
def test_scd2_store(spark, tmp_path, shuffled, nulls):
    feed = random_feed(29, rows=240, ties=shuffled)
    cdc = Cdc(["k"], "seq", 2, apply_as_deletes="op = 'D'", except_column_list=["op"],
              track_history_column_list=["a"], ignore_null_updates=nulls)
    whole = frame(spark, feed)
    store = Scd2Store(spark, str(tmp_path / "t"), cdc, whole.schema, buckets=3, split_rows=30 if nulls else None)
    seen = []
    for i, batch in enumerate(batches(feed, shuffled)):
        store.apply(frame(spark, batch), i)
        store.apply(frame(spark, batch), i)
        seen += batch
        if i in (1, 3):
            assert rows(store.table()) == rows(ops.scd2(frame(spark, seen), cdc, None))
    retracted = "retract" in store.pointer()["parts"]
    assert retracted == shuffled
    before = rows(store.table())
    store.compact()
    assert rows(store.table()) == before
    assert store.vacuum(["spans", "log", "retract"])
    assert rows(store.table()) == before


def test_scd2_batch_that_dies_leaves_no_trace(spark, tmp_path, monkeypatch):
    feed = random_feed(31, rows=120)
    cdc = Cdc(["k"], "seq", 2, apply_as_deletes="op = 'D'")
    first, second = batches(feed, True, 2)
    store = Scd2Store(spark, str(tmp_path / "t"), cdc, frame(spark, feed).schema, buckets=2, split_rows=None)
    store.apply(frame(spark, first), 0)
    before = rows(store.table())
    monkeypatch.setattr(store, "commit", lambda pointer: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        store.apply(frame(spark, second), 1)
    assert rows(store.table()) == before
    monkeypatch.undo()
    store.apply(frame(spark, second), 1)
    assert rows(store.table()) == rows(ops.scd2(frame(spark, feed), cdc, None))


@pytest.mark.parametrize("nulls", [False, True])
def test_scd1_store_with_truncate(spark, tmp_path, nulls):
    feed = random_feed(37, rows=240, ties=True)
    middle = sorted(r["seq"] for r in feed)[120]
    feed = [dict(r, op="T") if r["seq"] == middle else r for r in feed]
    cdc = Cdc(["k"], "seq", 1, apply_as_deletes="op = 'D'", apply_as_truncates="op = 'T'", ignore_null_updates=nulls)
    store = Scd1Store(spark, str(tmp_path / "t"), cdc, frame(spark, feed).schema, buckets=3)
    for i, batch in enumerate(batches(feed, True)):
        store.apply(frame(spark, batch), i)
        store.apply(frame(spark, batch), i)
    assert rows(store.table()) == rows(ops.scd1(frame(spark, feed), cdc))
    store.expire_tombstones("true")
    assert rows(store.table()) == rows(ops.scd1(frame(spark, feed), cdc))


def snapshots(spark, count=5):
    rnd = random.Random(41)
    for version in range(1, count + 1):
        data = [(k, rnd.choice(["x", "y"]), rnd.randrange(3)) for k in range(30) if rnd.random() < 0.7]
        yield version, spark.createDataFrame(data, "k long, a string, b long")


@pytest.mark.parametrize("tracked", [None, ["a"]])
@pytest.mark.parametrize("kind", [1, 2])
def test_snapshot_store_is_the_one_pass_result(spark, tmp_path, kind, tracked):
    cdc = SnapshotCdc(["k"], kind, track_history_column_list=tracked)
    series = list(snapshots(spark))
    store = SnapshotStore(spark, str(tmp_path / "t"), cdc)
    store.apply_all(series[:3])
    store.apply_all(series)
    assert store.latest() == 5
    assert rows(store.table()) == rows(snap.snapshot_table(series, cdc))


def test_reinserted_key_keeps_its_old_interval(spark):
    def frame_of(*keys):
        return spark.createDataFrame([(k, "v") for k in keys], "k long, a string")

    cdc = SnapshotCdc(["k"], 2)
    got = snap.snapshots_scd2([(1, frame_of(1, 2)), (2, frame_of(1)), (3, frame_of(1, 2))], cdc)
    spans = sorted((r.k, r["__START_AT"], str(r["__END_AT"])) for r in got.collect())
    assert spans == [(1, 1, "None"), (2, 1, "2"), (2, 3, "None")]


def test_snapshot_diff(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k long, a string")
    new = spark.createDataFrame([(2, "c"), (3, None), (4, "d")], "k long, a string")
    got = {r.k: r.change for r in snap.diff(old, new, SnapshotCdc(["k"])).collect()}
    assert got == {1: "D", 2: "U", 3: "N", 4: "I"}


def test_scd1_writes_follow_the_batch(spark, tmp_path):
    cdc = Cdc(["k"], "seq", 1)
    many = spark.range(20_000).selectExpr("id AS k", "1L AS seq", "'x' AS a")
    store = Scd1Store(spark, str(tmp_path / "t"), cdc, many.schema, buckets=8)
    store.apply(many, 0)

    def written(version):
        return spark.read.parquet(f"{tmp_path}/t/state/__v={version}").count()

    assert written(1) == 20_000
    for i in range(1, 4):
        store.apply(spark.range(300).selectExpr("id * 17 AS k", f"{i + 1}L AS seq", f"'y{i}' AS a"), i)
        assert written(i + 1) == 300
    got = {r.k: r.a for r in store.table().collect()}
    assert len(got) == 20_000 and got[17] == "y3" and got[18] == "x"
    store.apply(spark.range(10_000).selectExpr("id AS k", "9L AS seq", "'z' AS a"), 4)
    assert written(5) == 20_000  # the appended rows reach half of the base: written anew
    assert all(len(versions) == 1 for versions in store.pointer()["parts"]["state"]["by_bucket"].values())
    assert len(store.vacuum(["state"])) == 4
    assert {r.k: r.a for r in store.table().collect()} == {**got, **dict.fromkeys(range(10_000), "z")}


def test_the_plan_of_many_snapshots_has_no_join(spark):
    plan = snap.snapshots_scd2(list(snapshots(spark, 6)), SnapshotCdc(["k"], 2))._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("Window") <= 8


def test_scd2_writes_follow_the_batch(spark, tmp_path):
    cdc = Cdc(["k"], "seq", 2)
    many = spark.range(100_000).selectExpr("id AS k", "1L AS seq", "'x' AS a")
    store = Scd2Store(spark, str(tmp_path / "t"), cdc, many.schema, buckets=8)
    store.apply(many, 0)

    def written(version):
        return sum(spark.read.parquet(f"{tmp_path}/t/{part}/__v={version}").count() for part in ("spans", "log"))

    for i in range(1, 4):
        store.apply(spark.range(300).selectExpr("id * 17 AS k", f"{i * 10}L AS seq", f"'y{i}' AS a"), i)
        assert written(i + 1) == 900  # the log, the closed version and the open one
    # late for all 300 keys: their history from the version it falls into, a retraction each, and no key else
    store.apply(spark.range(300).selectExpr("id * 17 AS k", "25L AS seq", "'late' AS a"), 4)
    assert written(5) < 3_000
    spans = store.table().where("k = 34").orderBy("__START_AT")
    assert [(r.a, r["__START_AT"], r["__END_AT"]) for r in spans.collect()] == [
        ("x", 1, 10), ("y1", 10, 20), ("y2", 20, 25), ("late", 25, 30), ("y3", 30, None),
    ]
    assert store.table().count() == 100_000 + 300 * 4
    store.apply(spark.range(60_000).selectExpr("id AS k", "99L AS seq", "'z' AS a"), 5)
    assert all(len(versions) == 1 for versions in store.pointer()["parts"]["open"]["by_bucket"].values())
    assert store.table().where("__END_AT IS NULL").count() == 100_000


@pytest.mark.parametrize("kind", ["bigint", "timestamp", "timestamp_ntz", "date", "string", "struct", "decimal(9,2)"])
def test_a_late_event_opens_only_what_reaches_back_to_it(spark, tmp_path, monkeypatch, kind):
    at = {
        "bigint": "n", "timestamp": "timestamp_seconds(n * 1000)", "timestamp_ntz": "cast(timestamp_seconds(n * 1000) AS timestamp_ntz)",
        "date": "date_from_unix_date(cast(n AS int))", "string": "lpad(cast(n AS string), 9, '0')", "struct": "n", "decimal(9,2)": "cast(n AS decimal(9,2))",
    }[kind]
    cdc = Cdc(["k"], ["seq", "m"] if kind == "struct" else "seq", 2)

    def batch(first, count, key="id % 7"):
        return spark.range(first, first + count).selectExpr("id AS n", f"{key} AS k").selectExpr("k", f"{at} AS seq", "n AS m", "cast(n AS string) AS a")

    seen = batch(0, 1)
    store = Scd2Store(spark, str(tmp_path / "t"), cdc, seen.schema, buckets=1)
    for i in range(12):
        part = batch(i * 20, 20)
        store.apply(part, i)
        seen = part if i == 0 else seen.unionByName(part)
    opened = []
    log = store._log
    monkeypatch.setattr(store, "_log", lambda paths: opened.append(list(paths)) or log(paths))
    late = batch(221, 1, "5L")  # into the version from 215 to 222
    store.apply(late, 12)
    replayed = opened[-1]
    assert len(replayed) == (12 if kind.startswith("decimal") else 2)  # of twelve versions; a decimal has no zones
    assert rows(store.table()) == rows(ops.scd2(seen.unionByName(late), cdc, None))


def test_retractions_of_a_hot_key_take_one_pass(spark):
    rnd = random.Random(3)
    versions = [(1, start, rnd.randint(1, 1000)) for start in range(10_000)] + [(None, 5, 1), (2, 5, 9)]
    taken = [(1, rnd.randint(0, 12_000), rnd.randint(1, 1000)) for _ in range(1000)] + [(None, 4, 2), (2, 4, 9)]
    closed = spark.createDataFrame([(k, s, v, "x") for k, s, v in versions], "k long, __start long, __v int, a string")
    gone = spark.createDataFrame(taken, "k long, __from long, __v int")
    got = standing(closed, gone, ["k"])
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()
    want = [(k, s) for k, s, v in versions if not any(k == tk and s >= f and rv > v for tk, f, rv in taken)]
    assert sorted(map(str, [(r.k, r["__start"]) for r in got.collect()])) == sorted(map(str, want))
    assert got.columns == ["k", "__start", "a"]


@pytest.mark.parametrize("kind", [1, 2])
def test_snapshot_writes_follow_the_changes(spark, tmp_path, kind):
    cdc = SnapshotCdc(["k"], kind)
    store = SnapshotStore(spark, str(tmp_path / "t"), cdc, buckets=8)

    def taken(changed, first=0, last=10_000):
        odd = "CASE WHEN k % 100 = 3 THEN array(NULL, k) ELSE array(k, NULL) END"
        return spark.range(first, last).selectExpr("id AS k").selectExpr("k", f"IF(k < {changed}, NULL, 'a') AS x", f"IF(k < {changed}, 'a', NULL) AS y", f"{odd} AS z")

    def written(version):
        return spark.read.parquet(f"{tmp_path}/t/rows/__v={version}").count()

    versions = [taken(0), taken(100), taken(100, 20), taken(100, 20), taken(130, 20, 10_050), taken(9_000, 20)]
    seen = []
    for i, snapshot in enumerate(versions, 1):
        store.apply(i, snapshot)
        seen.append((i, snapshot))
        assert rows(store.table()) == rows(snap.snapshot_table(seen, cdc))
    assert written(1) == 10_000 and written(2) <= 200 and written(3) <= 40 and written(5) <= 110
    assert not list((tmp_path / "t" / "rows" / "__v=4").rglob("*.parquet"))
    assert all(len(v) == 1 for v in store.pointer()["parts"]["open"]["by_bucket"].values())  # the last one was merged in
    store.apply(7, taken(0, 0, 0))
    assert store.table().where("__END_AT IS NULL" if kind == 2 else "true").count() == 0
    store.apply(8, taken(5, 0, 10))
    assert rows(store.table()) == rows(snap.snapshot_table([*seen, (7, taken(0, 0, 0)), (8, taken(5, 0, 10))], cdc))


def test_snapshot_fingerprints_tell_nulls_apart(spark):
    from millrace.streaming.snapshots import fingerprint

    df = spark.sql("""SELECT * FROM VALUES (1, NULL, array(1, NULL), named_struct('a', 1, 'b', NULL)), (NULL, 1, array(1, NULL), named_struct('a', 1, 'b', NULL)),
        (1, NULL, array(NULL, 1), named_struct('a', 1, 'b', NULL)), (1, NULL, array(1, NULL), named_struct('a', NULL, 'b', 1)), (1, NULL, NULL, named_struct('a', 1, 'b', NULL)),
        (1, NULL, array(), named_struct('a', 1, 'b', NULL)) AS t(x, y, z, s)""")
    assert df.select(fingerprint(df, df.columns).alias("p")).distinct().count() == 6
