"""Whole flows: runs, reruns, failures, one-off flows, groups."""

import pytest

from millrace.plans.flows import Runner
from millrace.sources.snapshots import numbered_snapshots
from millrace.specs import AppendFlow, Cdc, Flow, Rules, Sink, SnapshotCdc, Source, SpecError, Target

DDL = "id long, op string, at long, x string"


class Folder:
    """A folder that gets a new JSON file per call."""

    def __init__(self, spark, path):
        self.spark, self.path, self.count = spark, path, 0
        path.mkdir()

    def add(self, *rows):
        self.count += 1
        names = DDL.replace(" long", "").replace(" string", "").split(", ")
        import json

        text = "\n".join(json.dumps(dict(zip(names, r))) for r in rows)
        (self.path / f"{self.count}.json").write_text(text + "\n")


@pytest.fixture
def incoming(spark, tmp_path):
    return Folder(spark, tmp_path / "incoming")


def source(folder):
    return Source("files", {"path": str(folder.path)}, {"cloudFiles.format": "json"}, DDL)


def ids(df):
    return sorted(r.id for r in df.collect())


def test_second_run_takes_only_new_files(spark, tmp_path, incoming):
    flow = Flow("f", source(incoming), Target(str(tmp_path / "t")))
    runner = Runner(spark, str(tmp_path / "progress"), [flow])
    incoming.add((1, "I", 1, "a"), (2, "I", 1, "b"))
    assert runner.run(flow).batches == {"main": 1}
    incoming.add((3, "I", 2, "c"))
    runner.run(flow)
    assert runner.run(flow).batches == {"main": 0}
    assert ids(runner.table(flow)) == [1, 2, 3]


def test_rules_quarantine_sinks_and_observed_counts(spark, tmp_path, incoming):
    flow = Flow(
        "f", source(incoming), Target(str(tmp_path / "t")),
        rules=Rules(warn={"known": "x <> 'b'"}, drop={"positive": "id > 0"}, quarantine={"bad": "id <= 0"}),
        quarantine=Target(str(tmp_path / "q")),
        sinks=[Sink("Out", "delta", {"path": str(tmp_path / "sink")}, ["id"], "id > 1")],
    )
    runner = Runner(spark, str(tmp_path / "progress"), [flow])
    incoming.add((1, "I", 1, "a"), (2, "I", 1, "b"), (-1, "I", 1, "c"))
    run = runner.run(flow)
    assert run.violations() == {"rows_seen": 3, "known": 1}
    assert ids(runner.table(flow)) == [1, 2]
    assert ids(runner.quarantine_table(flow)) == [-1]
    # sinks are fed from the input view, before the rules
    assert ids(spark.read.parquet(str(tmp_path / "sink"))) == [2]


def test_a_failed_rule_leaves_the_table_as_it_was(spark, tmp_path, incoming):
    flow = Flow("f", source(incoming), Target(str(tmp_path / "t")),
                cdc=Cdc(["id"], "at", 2, apply_as_deletes="op = 'D'"), rules=Rules(fail={"positive": "id > 0"}))
    runner = Runner(spark, str(tmp_path / "progress"), [flow], buckets=2)
    incoming.add((1, "I", 1, "a"))
    runner.run(flow)
    incoming.add((2, "I", 2, "b"), (-1, "I", 2, "c"))
    with pytest.raises(Exception, match="rule positive failed"):
        runner.run(flow)
    assert ids(runner.table(flow)) == [1]


def test_cdc_flow_with_rules_counts_and_late_events(spark, tmp_path, incoming):
    flow = Flow("f", source(incoming), Target(str(tmp_path / "t")), rules=Rules(warn={"known": "x <> 'b'"}),
                cdc=Cdc(["id"], "at", 1, apply_as_deletes="op = 'D'", except_column_list=["op"]))
    runner = Runner(spark, str(tmp_path / "progress"), [flow], buckets=2)
    incoming.add((1, "I", 5, "b"), (2, "D", 9, None))
    assert runner.run(flow).violations() == {"rows_seen": 2, "known": 2}
    incoming.add((1, "U", 3, "old"), (2, "U", 4, "dead"))
    runner.run(flow)
    assert [tuple(r) for r in runner.table(flow).collect()] == [(1, 5, "b")]


def test_once_flows_run_once(spark, tmp_path, incoming):
    extra = Folder(spark, tmp_path / "extra")
    flow = Flow("f", source(incoming), Target(str(tmp_path / "t")), append_flows=[AppendFlow("backfill", source(extra), once=True)])
    runner = Runner(spark, str(tmp_path / "progress"), [flow])
    incoming.add((1, "I", 1, "a"))
    extra.add((10, "I", 1, "z"))
    runner.run(flow)
    extra.add((11, "I", 1, "z"))
    incoming.add((2, "I", 1, "a"))
    assert runner.run(flow).batches == {"main": 1, "backfill": 0}
    assert ids(runner.table(flow)) == [1, 2, 10]


def test_silver_reads_bronze_and_named_table(spark, tmp_path, incoming):
    spark.sql("CREATE DATABASE IF NOT EXISTS lake")
    bronze = Flow("bronze", source(incoming),
                  Target(str(tmp_path / "b"), name="lake.bronze_t", properties={"team": "x"}, comment="it's bronze", partition_by="op"))
    silver = Flow("silver", Source("flow", {"flow": "bronze"}), Target(str(tmp_path / "s")), layer="silver",
                  select_exp=["id", "upper(x) AS x"], where=["op = 'I'"])
    runner = Runner(spark, str(tmp_path / "progress"), [silver, bronze])
    incoming.add((1, "I", 1, "a"), (2, "U", 1, "b"))
    runs = runner.run_group()
    assert not any(r.error for r in runs.values())
    assert [tuple(r) for r in runner.table("silver").collect()] == [(1, "A")]
    assert ids(spark.table("lake.bronze_t")) == [1, 2]
    incoming.add((3, "I", 1, "c"))
    runner.run_group()
    assert ids(spark.table("lake.bronze_t")) == [1, 2, 3] and ids(runner.table("silver")) == [1, 3]
    assert spark.catalog.getTable("lake.bronze_t").description == "it's bronze"
    assert bronze.view_name() == "lake_bronze_t_bronze_inputview"


def test_a_failed_flow_holds_back_only_its_readers(spark, tmp_path, incoming):
    incoming.add((1, "I", 1, "a"))
    bad = Flow("bad", source(incoming), Target(str(tmp_path / "bad")), rules=Rules(fail={"no": "id > 5"}))
    reader = Flow("reader", Source("flow", {"flow": "bad"}), Target(str(tmp_path / "r")))
    other = Flow("other", source(incoming), Target(str(tmp_path / "o")))
    runner = Runner(spark, str(tmp_path / "progress"), [bad, reader, other])
    runs = runner.run_group()
    assert "rule no failed" in str(runs["bad"].error)
    assert "not run" in str(runs["reader"].error)
    assert runs["other"].error is None and ids(runner.table("other")) == [1]


def test_snapshot_flow_with_quarantine(spark, tmp_path):
    for v, rows in ((1, "1,a\n2,b\n0,c\n"), (2, "1,a2\n")):
        (tmp_path / f"LOAD_{v}.csv").write_text("id,x\n" + rows)
    following = numbered_snapshots(spark, str(tmp_path / "LOAD_"), ".csv", options={"header": "true"}, schema="id long, x string")
    flow = Flow("snap", Source("snapshot"), Target(str(tmp_path / "t")), snapshot=SnapshotCdc(["id"], 2), next_snapshot=following,
                rules=Rules(drop={"pos": "id > 0"}, quarantine={"zero": "id = 0"}), quarantine=Target(str(tmp_path / "q")))
    runner = Runner(spark, str(tmp_path / "progress"), [flow])
    assert runner.run(flow).batches == {"snapshots": 2}
    assert runner.run(flow).batches == {"snapshots": 0}
    got = sorted((r.id, r.x, r["__START_AT"], str(r["__END_AT"])) for r in runner.table(flow).collect())
    assert got == [(1, "a", 1, "2"), (1, "a2", 2, "None"), (2, "b", 1, "2")]
    assert ids(runner.quarantine_table(flow)) == [0]


def test_replayed_append_batch_is_in_the_table_once(spark, tmp_path):
    from millrace.streaming.targets import AppendTable

    table = AppendTable(spark, Target(str(tmp_path / "t")))
    df = spark.range(5)
    table.write_batch(df, 0)
    table.write_batch(df, 0)
    table.write_batch(spark.range(5, 7).selectExpr("id", "'n' AS note"), 0, "other")
    assert ids(table.table()) == [0, 1, 2, 3, 4, 5, 6]
    assert table.table().where("note = 'n'").count() == 2


def test_catalog_helpers(spark, tmp_path):
    from millrace.streaming import targets

    targets.create_database(spark, "helpers", "for tests")
    path = str(tmp_path / "reg")
    spark.range(3).write.parquet(path)
    targets.register_path(spark, "helpers.t", path)
    assert targets.table_location(spark, "helpers.t").endswith("/reg")
    targets.deregister(spark, "helpers.t")
    assert not spark.catalog.tableExists("helpers.t") and spark.read.parquet(path).count() == 3
    targets.drop_database(spark, "helpers")


def test_specs_are_checked(tmp_path):
    with pytest.raises(SpecError, match="path or tablename"):
        Sink("s", "delta", {"mode": "x"})
    with pytest.raises(SpecError, match="format"):
        Sink("s", "ftp", {})
    with pytest.raises(SpecError, match="exclude"):
        Flow("f", Source("table"), Target("/t"), cdc=Cdc(["k"], "s"), snapshot=SnapshotCdc(["k"]))
    with pytest.raises(SpecError, match="two flows"):
        Runner(None, "/p", [Flow("f", Source("table"), Target("/t"))] * 2)


def spec(tmp_path, name, **more):
    return {
        "id": name, "group": "g", "source": {"format": "files", "details": {"path": "/in"}},
        "target": {"path": str(tmp_path / name)}, **more,
    }


def test_spec_table(spark, tmp_path):
    from millrace.plans.catalog import load_flows, merge_specs, spec_rows

    cdc = {"keys": ["id"], "sequence_by": "at", "scd_type": "2"}
    first = spec_rows(
        spark,
        [
            spec(tmp_path, "a", cdc=cdc, rules={"expect_or_drop": {"r": "id > 0"}}),
            spec(tmp_path, "b", sinks=[{"name": "S", "format": "delta", "options": {"path": "/s"}}],
                 append_flows=[{"name": "x", "source": {"format": "table", "details": {"table": "t"}}}]),
        ],
        "v1",
        "me",
    )
    flows = {f.id: f for f in load_flows(first, group="g")}
    assert flows["a"].cdc.scd_type == 2 and flows["a"].rules.drop == {"r": "id > 0"}
    assert flows["b"].sinks[0].name == "s" and flows["b"].append_flows[0].source.format == "table"
    second = spec_rows(spark, [spec(tmp_path, "b", where=["id > 1"])], "v2", "you")
    merged = merge_specs(first, second)
    assert merged.count() == 2
    row = merged.where("id = 'b'").first()
    assert (row.version, row.createdBy, row.updatedBy) == ("v2", "me", "you")
    both = first.unionByName(second)
    assert {f.id: f.where for f in load_flows(both, ids=["b"])} == {"b": ["id > 1"]}
    with pytest.raises(Exception, match="duplicate key"):
        spec_rows(spark, [spec(tmp_path, "a"), spec(tmp_path, "a")], "v1", "me").collect()
    with pytest.raises(SpecError, match="missing"):
        spec_rows(spark, [{"id": "x", "target": {"path": "/t"}}], "v1", "me")


def test_snapshot_of_a_flow_and_publish(spark, tmp_path, incoming):
    bronze = Flow("bronze", source(incoming), Target(str(tmp_path / "b")),
                  cdc=Cdc(["id"], "at", 1, apply_as_deletes="op = 'D'", except_column_list=["op"]))
    silver = Flow("silver", Source("snapshot", {"flow": "bronze"}), Target(str(tmp_path / "s")), layer="silver",
                  select_exp=["id", "x"], snapshot=SnapshotCdc(["id"], 2))
    runner = Runner(spark, str(tmp_path / "progress"), [bronze, silver], buckets=2)
    incoming.add((1, "I", 1, "a"), (2, "I", 1, "b"))
    assert not any(r.error for r in runner.run_group().values())
    incoming.add((1, "U", 2, "c"), (2, "D", 2, None))
    assert not any(r.error for r in runner.run_group().values())
    got = sorted((r.id, r.x, r["__START_AT"], str(r["__END_AT"])) for r in runner.table("silver").collect())
    assert got == [(1, "a", 1, "2"), (1, "c", 2, "None"), (2, "b", 1, "2")]
    runner.publish("bronze", Target(str(tmp_path / "out"), name="published_t", partition_by="x"))
    assert ids(spark.table("published_t")) == [1]
    streamed = Flow("bad", Source("flow", {"flow": "bronze"}), Target(str(tmp_path / "bad")))
    with pytest.raises(SpecError, match="rewrites rows"):
        runner.run(streamed)


def test_a_started_flow_takes_files_as_they_come(spark, tmp_path, incoming):
    flow = Flow("live", source(incoming), Target(str(tmp_path / "t")),
                cdc=Cdc(["id"], "at", 2, apply_as_deletes="op = 'D'", except_column_list=["op"]))
    runner = Runner(spark, str(tmp_path / "progress"), [flow], buckets=2)
    incoming.add((1, "I", 1, "a"))
    query = runner.start(flow, "1 second")
    try:
        query.processAllAvailable()
        incoming.add((1, "U", 2, "b"))
        query.processAllAvailable()
    finally:
        query.stop()
    incoming.add((1, "D", 3, None))
    runner.run(flow)
    got = sorted((r.x, r["__START_AT"], r["__END_AT"]) for r in runner.table(flow).collect())
    assert got == [("a", 1, 2), ("b", 2, 3)]


@pytest.mark.parametrize("kind", ["scd1", "scd2", "snapshot"])
def test_append_flows_beside_a_keyed_target(spark, tmp_path, incoming, kind):
    more = Folder(spark, tmp_path / "more")
    name = f"appended_{kind}"
    columns = "id long, x string"
    extra = Source("files", {"path": str(more.path)}, {"cloudFiles.format": "json"}, columns)
    settings = dict(cdc=Cdc(["id"], "at", kind[-1], except_column_list=["op", "at"])) if kind != "snapshot" else dict(snapshot=SnapshotCdc(["id"]))
    main = source(incoming) if kind != "snapshot" else Source("snapshot", {"path": str(tmp_path / "snap")})
    flow = Flow("f", main, Target(str(tmp_path / "t"), name), layer="silver", append_flows=[AppendFlow("late", extra)], **settings)
    runner = Runner(spark, str(tmp_path / "progress"), [flow], buckets=2)

    def feed(*rows):
        if kind == "snapshot":
            spark.createDataFrame([(r[0], r[3]) for r in rows], "id long, x string").write.mode("overwrite").parquet(str(tmp_path / "snap"))
        else:
            incoming.add(*rows)

    def got(df):
        return sorted(((r.id, r.x) for r in df.collect()), key=str)

    feed((1, "I", 1, "a"), (2, "I", 1, "b"))
    more.add((1, "", 0, "again"), (9, "", 0, "nine"))
    runner.run(flow)
    want = [(1, "a"), (1, "again"), (2, "b"), (9, "nine")]
    assert got(runner.table(flow)) == got(spark.table(name)) == want
    more.add((1, "", 0, "again"))
    runner.run(flow)
    assert got(runner.table(flow)) == got(spark.table(name)) == sorted([*want, (1, "again")], key=str)
    assert runner.run(flow).batches["late"] == 0
    feed((1, "I", 5, "c"), (2, "I", 5, "b"))
    runner.run(flow)
    now = got(runner.table(flow))
    assert (1, "c") in now and now.count((1, "again")) == 2 and (9, "nine") in now and got(spark.table(name)) == now


def test_append_flow_with_other_columns_is_refused(spark, tmp_path, incoming):
    more = Folder(spark, tmp_path / "more")
    extra = Source("files", {"path": str(more.path)}, {"cloudFiles.format": "json"}, "id long, y string")
    flow = Flow("f", source(incoming), Target(str(tmp_path / "t")), cdc=Cdc(["id"], "at"), append_flows=[AppendFlow("late", extra)])
    runner = Runner(spark, str(tmp_path / "progress"), [flow])
    incoming.add((1, "I", 1, "a"))
    more.add((1, "", 0, "again"))
    with pytest.raises(Exception, match="are not in"):
        runner.run(flow)
