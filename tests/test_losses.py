"""Rows that must not get lost: named sinks, lost checkpoints, columns with the store's names, changed types."""

import pytest
from pyspark.sql import functions as F

from millrace.plans.flows import Runner
from millrace.session import scratch_path, shared_folder
from millrace.sources.files import file_scan
from millrace.specs import AppendFlow, Cdc, Flow, Sink, SnapshotCdc, Source, SpecError, Target
from millrace.streaming.scd import Scd1Store, Scd2Store
from millrace.streaming.snapshots import SnapshotStore
from millrace.streaming.store import Batch
from millrace.streaming.targets import AppendTable, write_sink


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_a_named_sink_keeps_every_batch(spark, tmp_path):
    for place in ({}, {"path": str(tmp_path / "files")}):
        name = f"kept_{len(place)}"
        sink = Sink("out", "delta", {"tableName": name, **place})
        for i in range(3):
            rows = spark.range(10 * i, 10 * i + 10).withColumn("b", F.lit(f"x{i}"))
            write_sink(rows if i % 2 else rows.select("b", "id"), sink, i)
        write_sink(spark.range(20, 25).withColumn("b", F.lit("again")), sink, 2)
        assert ids(spark.table(name)) == list(range(25))
        assert {r.b for r in spark.table(name).collect()} == {"x0", "x1", "again"}
        with pytest.raises(ValueError):
            write_sink(spark.range(3).select("id", F.lit(1).alias("b")), sink, 3)


@pytest.mark.parametrize("scd", [None, 1, 2])
def test_a_lost_checkpoint_loses_no_row(spark, tmp_path, scd):
    feed = tmp_path / "in"
    flow = Flow(
        "f", Source("files", {"path": str(feed)}, {"cloudFiles.format": "parquet"}, schema="id bigint, at bigint"),
        Target(str(tmp_path / "t")), layer="silver", cdc=Cdc(["id"], "at", scd) if scd else None,
    )
    spark.createDataFrame([(1, 1)], "id bigint, at bigint").write.mode("append").parquet(str(feed))
    Runner(spark, str(tmp_path / "progress"), [flow], buckets=2).run(flow)
    spark.createDataFrame([(2, 1)], "id bigint, at bigint").write.mode("append").parquet(str(feed))
    runner = Runner(spark, str(tmp_path / "progress-new"), [flow], buckets=2)
    runner.run(flow)
    assert set(ids(runner.table(flow))) == {1, 2}


def test_batches_of_another_series_are_new(spark, tmp_path):
    store = Scd1Store(spark, str(tmp_path / "t"), Cdc(["id"], "at"), spark.sql("SELECT 1L id, 1L at").schema, buckets=2)
    assert store.apply(spark.sql("SELECT 1L id, 1L at"), Batch(0, "a"))
    assert not store.apply(spark.sql("SELECT 1L id, 1L at"), Batch(0, "a"))
    assert store.apply(spark.sql("SELECT 2L id, 1L at"), Batch(0, "b"))
    assert ids(store.table()) == [1, 2]


def test_a_column_named_v_is_kept(spark, tmp_path):
    feed = spark.sql("SELECT 1L id, 'x' v, 5L at, 2 part")
    for kind, number in ((Scd1Store, 1), (Scd2Store, 2)):
        store = kind(spark, str(tmp_path / f"s{number}"), Cdc(["id"], "at", number), feed.schema, buckets=2)
        store.apply(feed, 0)
        store.apply(spark.sql("SELECT 1L id, 'y' v, 6L at, 3 part"), 1)
        assert {(r.v, r.part) for r in store.table().collect()} >= {("y", 3)}
    for number in (1, 2):
        store = SnapshotStore(spark, str(tmp_path / f"n{number}"), SnapshotCdc(["id"], number))
        store.apply(1, feed)
        store.apply(2, spark.sql("SELECT 1L id, 'y' v, 6L at, 3 part"))
        assert "v" in store.table().columns and store.table().count() == number


def test_columns_with_the_stores_names_are_refused(spark, tmp_path):
    feed = spark.sql("SELECT 1L id, 5L at, 2 AS __bucket")
    with pytest.raises(ValueError):
        Scd2Store(spark, str(tmp_path / "a"), Cdc(["id"], "at", 2), feed.schema)
    with pytest.raises(ValueError):
        SnapshotStore(spark, str(tmp_path / "b"), SnapshotCdc(["id"])).apply(1, feed)
    with pytest.raises(ValueError):
        AppendTable(spark, Target(str(tmp_path / "c"))).write_batch(feed, 0)


def test_a_changed_type_is_refused_before_it_is_written(spark, tmp_path):
    table = AppendTable(spark, Target(str(tmp_path / "t")))
    table.write_batch(spark.sql("SELECT 1L id, 1 x"), 0)
    with pytest.raises(ValueError):
        AppendTable(spark, Target(str(tmp_path / "t"))).write_batch(spark.sql("SELECT 2L id, 'a' x"), 1)
    assert ids(table.table()) == [1]


def test_a_declared_schema_as_text_is_read(spark, tmp_path):
    table = AppendTable(spark, Target(str(tmp_path / "t"), schema="id long, note string"))
    table.write_batch(spark.sql("SELECT 1L id"), 0)
    assert table.table().columns == ["id", "note"]


@pytest.mark.parametrize(
    "settings",
    [{"column_list": ["vv"]}, {"except_column_list": ["vv"]}, {"ignore_null_updates_column_list": ["vv"]}, {"ignore_null_updates_except_column_list": ["vv"]}],
)
def test_unknown_names_are_refused(settings):
    cdc = Cdc(["id"], "at", 1, **settings)
    with pytest.raises(SpecError):
        cdc.null_ignoring_columns(["id", "at", "v"])


@pytest.mark.parametrize("settings", [{"track_history_column_list": ["vv"]}, {"track_history_except_column_list": ["vv"]}])
def test_unknown_tracked_names_are_refused(settings):
    with pytest.raises(SpecError):
        SnapshotCdc(["id"], 2, **settings).tracked_columns(["id", "v"])
    with pytest.raises(SpecError):
        Cdc(["id"], "at", 2, **settings).tracked_columns(["id", "at", "v"])


def test_flows_into_one_table_take_turns(spark, tmp_path):
    flows = []
    for i in range(4):
        place = str(tmp_path / f"in{i}")
        spark.createDataFrame([(10 + i, 1)], "id bigint, at bigint").write.parquet(place)
        source = Source("files", {"path": place}, {"cloudFiles.format": "parquet"}, schema="id bigint, at bigint")
        flows.append(Flow(f"f{i}", source, Target(str(tmp_path / "t")), layer="silver", cdc=Cdc(["id"], "at", flow_name=f"f{i}")))
    runner = Runner(spark, str(tmp_path / "progress"), flows, buckets=2)
    assert not any(run.error for run in runner.run_group().values())
    assert ids(runner.table(flows[0])) == [10, 11, 12, 13]


def test_a_flows_settings_stay_its_own(spark, tmp_path):
    place = str(tmp_path / "in")
    spark.range(3).write.parquet(place)
    source = Source("files", {"path": place}, {"cloudFiles.format": "parquet"}, schema="id bigint")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    extra = AppendFlow("more", source, conf={"spark.sql.shuffle.partitions": "3"})
    flow = Flow("f", source, Target(str(tmp_path / "t")), append_flows=[extra])
    runner = Runner(spark, str(tmp_path / "progress"), [flow])
    seen = []
    read = Runner.read
    runner_read = lambda self, *a, **k: (seen.append((self.spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.shuffle.partitions"))), read(self, *a, **k))[1]
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(Runner, "read", runner_read)
        runner.run(flow)
    assert ("3", before) in seen and all(outer == before for _, outer in seen)
    assert ids(runner.table(flow)) == [0, 0, 1, 1, 2, 2]


def test_scratch_lies_in_the_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(shared_folder(spark))


def test_rescue_reads_times_as_the_reader_does(spark, tmp_path):
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "a.json").write_text('{"id":1,"t":"03-25-2024"}\n{"id":2,"t":"2024-03-25"}\n')
    options = {"cloudFiles.format": "json", "cloudFiles.rescuedDataColumn": "_r", "timestampFormat": "MM-dd-yyyy"}
    got = {r.id: (r.t and r.t.day, r["_r"]) for r in file_scan(spark, str(tmp_path / "j"), options, "id long, t timestamp", streaming=False).collect()}
    assert got == {1: (25, None), 2: (None, '{"t":"2024-03-25"}')}
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "a.csv").write_text("1,03-25-2024,25/03/24\n2,2024-03-25,x\n")
    options = {"cloudFiles.format": "csv", "cloudFiles.rescuedDataColumn": "_r", "timestampFormat": "MM-dd-yyyy", "dateFormat": "dd/MM/yy"}
    rows = file_scan(spark, str(tmp_path / "c"), options, "id long, t timestamp, d date", streaming=False).collect()
    got = {r.id: (r.t and r.t.day, r.d and r.d.month, r["_r"]) for r in rows}
    assert got == {1: (25, 3, None), 2: (None, None, '{"t":"2024-03-25","d":"x"}')}


def test_rescue_looks_into_nested_values(spark, tmp_path):
    (tmp_path / "j").mkdir()
    lines = ['{"id":1,"s":{"a":1,"b":{"c":"x"}},"l":[{"n":1}]}', '{"id":2,"s":{"a":"no","b":{"c":"x"}}}', '{"id":3,"s":{"a":1,"b":{"c":"x","z":9}}}',
             '{"id":4,"l":[{"n":1},{"n":"no"}]}', '{"id":5,"l":[{"n":1,"m":2}]}', '{"id":6,"s":{"a":null}}', '{"id":7,"k":[1,"x"]}', '{"id":8,"k":[1,null]}']
    (tmp_path / "j" / "a.json").write_text("\n".join(lines))
    options = {"cloudFiles.format": "json", "cloudFiles.rescuedDataColumn": "_r"}
    schema = "id long, s struct<a: int, b: struct<c: string>>, l array<struct<n: int>>, k array<int>"
    found = {r.id: r["_r"] for r in file_scan(spark, str(tmp_path / "j"), options, schema, streaming=False).collect()}
    assert {i for i, text in found.items() if text is None} == {1, 6, 8}
    assert '"no"' in found[2].replace("\\", "") and '"z":9' in found[3].replace("\\", "") and '"m":2' in found[5].replace("\\", "")


def test_an_inferred_schema_is_kept(spark, tmp_path):
    place = tmp_path / "in"
    place.mkdir()
    (place / "a.json").write_text('{"id":1,"v":5}\n')
    source = Source("files", {"path": str(place)}, {"cloudFiles.format": "json", "cloudFiles.inferColumnTypes": "true"})
    flow = Flow("f", source, Target(str(tmp_path / "t")))
    runner = Runner(spark, str(tmp_path / "progress"), [flow])
    runner.run(flow)
    (place / "b.json").write_text('{"id":2,"v":"text","w":1}\n')
    runner.run(flow)
    assert {r.id: r.v for r in runner.table(flow).collect() if r.id is not None}[1] == 5
    assert runner.table(flow).columns == ["id", "v"] and runner.table(flow).count() == 2


@pytest.mark.parametrize("scd", [1, 2])
def test_cdc_targets_are_named_tables(spark, tmp_path, scd):
    place, name = str(tmp_path / "in"), f"named_scd{scd}"
    source = Source("files", {"path": place}, {"cloudFiles.format": "parquet"}, schema="id bigint, at bigint, g string")
    target = Target(str(tmp_path / "t"), name, partition_by=["g"], properties={"team": "x"})
    flow = Flow("f", source, target, layer="silver", cdc=Cdc(["id"], "at", scd))
    runner = Runner(spark, str(tmp_path / "progress"), [flow], buckets=2)
    for at in (1, 2, 3):
        spark.range(5).selectExpr("id", f"{at}L AS at", f"concat('g', id % 2, '-{at}') AS g").write.mode("append").parquet(place)
        runner.run(flow)
        got, want = spark.table(name), runner.table(flow)
        assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == spark.table(name).select("__bucket", "g").distinct().count()
    facts = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    assert facts["Comment"] == f"silver table {name}" and "team=x" in facts["Table Properties"]
    assert len([p for p in (tmp_path / "t-named").iterdir() if "=" in p.name and not p.name.startswith(".")]) == 2
