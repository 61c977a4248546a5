"""Named tables of keyed targets: only changed buckets are written, and readers always find the table."""

import threading

import pytest

from millrace.plans import flows
from millrace.plans.flows import Runner
from millrace.specs import Cdc, Flow, SnapshotCdc, Source, Target
from millrace.streaming.published import PublishedTable
from millrace.streaming import targets
from millrace.streaming.store import BUCKET, Batch
from millrace.streaming.targets import AppendTable, run_available

DDL = "id bigint, at bigint, g string"


def made(spark, tmp_path, name, cdc, buckets=8, **target):
    place = str(tmp_path / "in")
    source = Source("files", {"path": place}, {"cloudFiles.format": "parquet"}, schema=DDL)
    flow = Flow("f", source, Target(str(tmp_path / "t"), name, **target), layer="silver", cdc=cdc)
    runner = Runner(spark, str(tmp_path / "progress"), [flow], buckets=buckets)

    def add(first, last, at, g="concat('g', id % 3)"):
        spark.range(first, last).selectExpr("id", f"{at}L AS at", f"{g} AS g").write.mode("append").parquet(place)

    return flow, runner, add


def same(spark, runner, flow):
    want = runner.table(flow)
    got = spark.table(flow.target.name).select(*want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("layout", [{}, {"partition_by": ["g"]}, {"cluster_by": ["g"]}, {"zorder_by": ["at", "id"]}])
@pytest.mark.parametrize("scd", [1, 2])
def test_a_run_writes_the_buckets_of_its_keys(spark, tmp_path, monkeypatch, scd, layout):
    flow, runner, add = made(spark, tmp_path, f"published_{scd}_{'_'.join(layout) or 'plain'}", Cdc(["id"], "at", scd), 64, **layout)
    written = []
    publish = flows.PublishedTable.publish
    monkeypatch.setattr(flows.PublishedTable, "publish", lambda *a: written.append(publish(*a)))
    add(0, 5000, 1)
    runner.run(flow)
    assert written.pop() == list(range(64))
    same(spark, runner, flow)
    files = {f for f in spark.table(flow.target.name).inputFiles()}
    add(0, 10, 2, "CASE WHEN id = 3 THEN NULL ELSE 'it''s \\\\ / new' END")
    runner.run(flow)
    changed = {r[BUCKET] for r in spark.table(flow.target.name).where("id < 10").select(BUCKET).distinct().collect()}
    assert set(written.pop()) == changed and len(changed) <= 10
    kept = {f for f in files if int(f.split(f"{BUCKET}=")[1].split("/")[0]) not in changed}
    assert kept <= set(spark.table(flow.target.name).inputFiles()) and kept
    same(spark, runner, flow)
    runner.run(flow)
    assert not written
    add(0, 1, 3, "'x'")
    runner.run(flow)
    same(spark, runner, flow)
    live = set(spark.table(flow.target.name).inputFiles())
    there = list((tmp_path / "t-named").rglob("*.parquet"))
    assert len(there) < 2 * len(live)  # what was replaced twice is gone


def test_readers_always_find_the_table(spark, tmp_path):
    flow, runner, add = made(spark, tmp_path, "published_read", Cdc(["id"], "at"), 4, partition_by=["g"])
    add(0, 40, 1, "'g'")
    runner.run(flow)
    failed, counts, stop = [], [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                counts.append(spark.table("published_read").count())
            except Exception as error:  # noqa: BLE001 - any failure counts
                failed.append(error)

    thread = threading.Thread(target=read)
    thread.start()
    for at in (2, 3, 4):
        add(0, 40, at, "'g'")
        runner.run(flow)
    stop.set()
    thread.join()
    assert not failed and set(counts) == {40}


def test_a_publication_that_dies_is_made_again(spark, tmp_path, monkeypatch):
    flow, runner, add = made(spark, tmp_path, "published_dies", Cdc(["id"], "at"), 4, partition_by=["g"])
    add(0, 20, 1)
    runner.run(flow)
    add(0, 20, 2, "'new'")
    clear = PublishedTable._clear
    monkeypatch.setattr(PublishedTable, "_clear", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        runner.run(flow)
    monkeypatch.setattr(PublishedTable, "_clear", clear)
    add(3, 4, 3, "'newer'")
    runner.run(flow)
    same(spark, runner, flow)


def test_columns_may_be_new_and_texts_hold_quotes(spark, tmp_path):
    cdc = Cdc(["id"], "at")
    flow, runner, add = made(spark, tmp_path, "published_wide", cdc, 2, properties={"it's": "a \\ b'c"}, comment="it's \\ here")
    add(0, 5, 1)
    runner.run(flow)
    assert spark.catalog.getTable("published_wide").description == "it's \\ here"
    assert {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES published_wide").collect()}["it's"] == "a \\ b'c"


def test_snapshot_targets_are_switched_whole(spark, tmp_path):
    name, place = "published_snap", str(tmp_path / "in")
    flow = Flow("f", Source("snapshot", {"path": place}), Target(str(tmp_path / "t"), name), snapshot=SnapshotCdc(["id"], 2))
    runner = Runner(spark, str(tmp_path / "progress"), [flow])
    for i in (1, 2):
        spark.range(i, 6).selectExpr("id", f"id * {i} AS v").write.mode("overwrite").parquet(place)
        runner.run(flow)
        same(spark, runner, flow)


def test_append_tables_are_packed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(targets, "PACK_FAN", 3)
    table = AppendTable(spark, Target(str(tmp_path / "t")))

    def put(n, flow="main", series="c0ffee-1"):
        rows = spark.range(n, n + 1, 1, 1).selectExpr("id", f"'{flow}' AS f")
        return table.write_batch(rows, Batch(n, series), flow)

    def stream(name, source=table):
        out, progress = str(tmp_path / name), str(tmp_path / f"{name}-progress")
        run_available(source.stream(progress=progress), lambda df, i: df.write.mode("append").parquet(out), progress)
        return sorted((r.f, r.id) for r in spark.read.parquet(out).collect())

    def rows():
        return sorted((r.f, r.id) for r in table.table().collect())

    want = []
    for n in range(200):
        assert put(n)
        want.append(("main", n))
        if n % 40 == 5:
            put(n, "other", "")
            want.append(("other", n))
        if n == 60:
            assert stream("old") == sorted(want)
        if n == 185:  # behind the last vacuum
            stream("old")
        if n % 20 == 19:
            table.compact(15)
            assert rows() == sorted(want)
        if n == 185:
            before = {str(p) for p in (tmp_path / "t").rglob("*.parquet")}
            assert len(table.vacuum()) > 150 and len({str(p) for p in (tmp_path / "t").rglob("*.parquet")}) < len(before) / 4
    assert rows() == sorted(want)
    assert len(table.table().inputFiles()) < 30
    assert put(150) is False and rows() == sorted(want)  # a replay
    assert put(199) and rows() == sorted(want)
    assert stream("old") == stream("new") == sorted(want)
    put(200)
    table.compact(1)
    want.append(("main", 200))
    assert rows() == stream("old") == stream("new") == sorted(want)
    # a lost checkpoint: another series, whose numbers say nothing about the packed ones
    assert put(3, series="beef")
    assert rows() == sorted([*want, ("main", 3)])


def test_packs_keep_the_layout_and_named_tables_their_folders(spark, tmp_path):
    table = AppendTable(spark, Target(str(tmp_path / "t"), partition_by=["g"]))
    for n in range(6):
        table.write_batch(spark.range(5).selectExpr("id", "concat('g', id % 2) AS g"), n)
    assert table.compact(3)
    assert table.table().count() == 30 and table.table().where("g = 'g1'").count() == 12
    assert {p.name for p in (tmp_path / "t.packs").rglob("g=*")} == {"g=g0", "g=g1"}
    with pytest.raises(ValueError):
        AppendTable(spark, Target(str(tmp_path / "t"), "named_append")).vacuum()


def test_a_state_is_never_between_two_files(spark, tmp_path, monkeypatch):
    from millrace.streaming import store

    folder = str(tmp_path / "state")
    assert store.read_state(spark, folder) is None
    state = {"n": 0}
    for n in range(5):
        store.write_state(spark, folder, {**state, "n": n})
        state = store.read_state(spark, folder)
        assert state["n"] == n
        # the slot that is written next may be missing or gone
        (tmp_path / "state" / f"slot-{(state['serial'] + 1) % 2}.json").unlink(missing_ok=True)
        assert store.read_state(spark, folder)["n"] == n


def test_buckets_that_lose_all_rows_are_published(spark, tmp_path):
    name, place = "published_emptied", str(tmp_path / "in")
    flow = Flow("f", Source("snapshot", {"path": place}), Target(str(tmp_path / "t"), name), snapshot=SnapshotCdc(["id"], 1))
    runner = Runner(spark, str(tmp_path / "progress"), [flow], buckets=8)
    for first, last in ((0, 100), (0, 3), (0, 0), (5, 9)):
        spark.range(first, last).selectExpr("id", "id * 2 AS v").write.mode("overwrite").parquet(place)
        runner.run(flow)
        assert runner.table(flow).count() == last - first
        same(spark, runner, flow)
