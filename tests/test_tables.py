import pytest
from pyspark.sql import functions as F

from millrace.operators import layout, tables, transforms
from millrace.specs import SpecError, Target, check_cluster_columns, clean_columns


def test_versions_as_text_and_as_number(spark):
    df = spark.createDataFrame([(1, "v9", "a"), (1, "v10", "b")], "k long, version string, x string")
    assert tables.latest_per_key(df, ["k"], "version").first().x == "a"
    assert tables.latest_per_key(df, ["k"], "version", numeric=True).first().x == "b"


def test_latest_with_a_map_column(spark):
    df = spark.createDataFrame([(1, 1, {"a": 1}), (1, 2, {"b": 2})], "k long, v int, m map<string,int>")
    assert tables.latest_per_key(df, ["k"], "v").first().m == {"b": 2}


def test_group_wins_over_ids(spark):
    df = spark.createDataFrame([("north", 4), ("north", 8), ("north", 9), ("south", 15), (None, 16)], "g string, id int")

    def chosen(**by):
        return sorted(r.id for r in tables.select_group(df, "g", "id", **by).collect())

    assert chosen(group="north", ids=[15]) == [4, 8, 9]
    assert chosen(ids=[15, 16, 99]) == [15, 16]
    assert chosen(group="west", ids=[4]) == [] and chosen() == chosen(ids=[]) == [4, 8, 9, 15, 16]


def test_upsert_sorts_each_side_once(spark):
    old = spark.range(50).selectExpr("id AS k", "'a' AS x").hint("merge")
    new = spark.range(30).selectExpr("id * 2 AS k", "'b' AS x")
    plan = tables.upsert(old, new, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.count("Sort [") <= 2 and plan.count("Exchange hashpartitioning") <= 2


def test_upsert(spark):
    old = spark.createDataFrame([(1, "a", "me"), (2, "b", "me")], "k long, x string, createdBy string")
    new = spark.createDataFrame([(2, "c", "you"), (3, None, "you")], "k long, x string, createdBy string")
    got = {r.k: (r.x, r.createdBy) for r in tables.upsert(old, new, ["k"], ["createdBy"]).collect()}
    assert got == {1: ("a", "me"), 2: ("c", "me"), 3: (None, "you")}
    with pytest.raises(Exception, match="duplicate key"):
        tables.upsert(old, new.union(new), ["k"]).collect()


def test_required_columns(spark):
    df = spark.createDataFrame([(1, " ")], "k long, x string")
    assert tables.require_columns(df, ["k"]).count() == 1
    with pytest.raises(Exception, match="x is empty"):
        tables.require_columns(df, ["x"]).count()


def test_json_arrays_depend_on_the_rows_alone(spark):
    df = spark.range(3000).selectExpr("id % 2 AS k", "id AS x").union(spark.createDataFrame([(2, 5000)], "k long, x long"))
    for parts in (1, 4):
        made = [sorted(map(tuple, transforms.rows_to_json_array(df.repartition(n), ["k"], ["x"], parts).collect())) for n in (3, 8, 31)]
        assert made[0] == made[1] == made[2] and len(made[0]) == 2 * parts + 1
        out = spark.createDataFrame(made[0], "k long, part long, rows_json string")
        back = out.select("k", F.explode(F.from_json("rows_json", "array<struct<x:long>>")).alias("r"))
        assert sorted(map(tuple, back.select("k", "r.x").collect())) == sorted(map(tuple, df.collect()))


def test_numeric_versions_compare_run_by_run(spark):
    for low, high in (("v1.9", "v1.10"), ("v9", "v10"), ("1.2", "1.2.1"), ("r007", "r8"), ("9" * 45, "1" + "0" * 45), ("none", "v0")):
        df = spark.createDataFrame([(1, low), (1, high)], "k int, v string")
        assert tables.latest_per_key(df, ["k"], "v", numeric=True).first().v == high


def test_zorder_by_text_narrows_every_file(spark, tmp_path):
    df = spark.range(4000).selectExpr("concat('Customer#', lpad(cast(id * 7919 % 4000 AS string), 9, '0')) AS name", "cast(cast(id AS string) AS binary) AS raw", "id")
    path = str(tmp_path / "z")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        layout.writer(df, Target(path, zorder_by=["name"])).save(path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spans = spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.min("name").alias("low"), F.max("name").alias("high")).collect()
    assert len(spans) >= 4
    assert all(int(r.high[9:]) - int(r.low[9:]) < 2000 for r in spans)
    assert layout.zordered(df, ["raw", "id"]).count() == 4000
    with pytest.raises(ValueError):
        layout.zorder_bits(63, 8)
    with pytest.raises(ValueError):
        layout.zordered(df, ["name", "id"], bits=40)


def test_partition_lists_are_cleaned():
    assert clean_columns(["", "year", " month ", "", "day"]) == ["year", "month", "day"]
    assert clean_columns("a, b,") == ["a", "b"]
    assert clean_columns(", ,a") == ["a"]
    assert clean_columns([""]) == clean_columns("") == clean_columns(None) == []


def test_cluster_columns_are_checked():
    assert check_cluster_columns("['id', \"email\"]") == ["id", "email"]
    for bad in ("id", "[id", [" id"], [""], [1], ["i'd"]):
        with pytest.raises(SpecError):
            check_cluster_columns(bad)
    with pytest.raises(SpecError):
        Target("/t", cluster_by=["a"], zorder_by=["b"])


def test_zorder_files_cover_narrow_ranges_of_both_columns(spark, tmp_path):
    df = spark.range(20000).selectExpr("id", "pmod(hash(id), 1000) AS a", "pmod(hash(id, 7), 1000) AS b")
    path = str(tmp_path / "z")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        layout.writer(df, Target(path, zorder_by=["a", "b"])).save(path)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spans = (
        spark.read.parquet(path)
        .groupBy(F.input_file_name())
        .agg((F.max("a") - F.min("a")).alias("a"), (F.max("b") - F.min("b")).alias("b"))
    )
    mean = spans.agg(F.avg("a"), F.avg("b")).first()
    assert spark.read.parquet(path).count() == 20000
    assert mean[0] < 600 and mean[1] < 600


def test_one_value_does_not_make_one_file(spark):
    df = spark.range(10000).selectExpr("id", "0 AS same")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = layout.clustered(df, ["same"]).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) > 1


def test_hive_partitions(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.range(100).selectExpr("id", "cast(id % 3 AS string) AS part")
    layout.writer(df, Target(path, partition_by="part, ")).save(path)
    assert spark.read.parquet(path).where("part = 1").count() == 33
