import json

import pytest

from millrace.functions.schemas import resolve_schema, schema_from_ddl, scd2_schema
from millrace.sources import messages
from millrace.sources.files import file_scan, split_options
from millrace.sources.snapshots import numbered_snapshots, snapshot_versions
from millrace.specs import Cdc


def write(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)
    return str(folder)


def test_ddl_spellings(spark, tmp_path):
    assert schema_from_ddl("a int,\n b: string,") == schema_from_ddl("a: int, b string")
    path = write(tmp_path / "ddl", "t.ddl", "a int,\n  b string\n")
    assert resolve_schema(spark, f"{path}/t.ddl").names == ["a", "b"]
    assert resolve_schema(spark, lambda p, s: schema_from_ddl("c int"), "x").names == ["c"]
    assert resolve_schema(spark, None) is None


def test_scd2_schema():
    schema = schema_from_ddl("berth int, ship string, tons double, kind string, moored date")
    cdc = Cdc(["berth"], "moored", "2", except_column_list=["kind", "moored"])
    got = scd2_schema(schema, cdc)
    assert [(f.name, f.dataType.simpleString()) for f in got.fields] == [
        ("berth", "int"), ("ship", "string"), ("tons", "double"), ("__START_AT", "date"), ("__END_AT", "date")
    ]
    assert scd2_schema(schema, Cdc(["berth"], "moored", "1")).names == schema.names


def test_options_of_the_incremental_source():
    options = {"cloudFiles.format": "csv", "header": "true", "cloudFiles.rescuedDataColumn": "_r", "cloudFiles.inferColumnTypes": "True"}
    assert split_options(options) == ("csv", {"header": "true"}, "_r", True)


def test_json_rescue(spark, tmp_path):
    lines = ['{"id":1,"x":"a"}', '{"id":"no","x":"a"}', '{"id":2,"x":"a","y":{"z":[1]}}', "not json", '{"id":null,"x":null}', ""]
    path = write(tmp_path / "j", "a.json", "\n".join(lines))
    options = {"cloudFiles.format": "json", "cloudFiles.rescuedDataColumn": "_rescued_data"}
    df = file_scan(spark, path, options, "id long, x string", streaming=False)
    got = [(r.id, r.x, r["_rescued_data"] and json.loads(r["_rescued_data"])) for r in df.collect()]
    assert got == [
        (1, "a", None),
        (None, "a", {"id": "no"}),
        (2, "a", {"y": '{"z":[1]}'}),
        (None, None, {"_line": "not json"}),
        (None, None, None),
    ]


def test_csv_rescue(spark, tmp_path):
    path = write(tmp_path / "c", "a.csv", "id,x\n1,a\nno,b\n3,c,extra\n,d\n")
    options = {"cloudFiles.format": "csv", "header": "true", "cloudFiles.rescuedDataColumn": "_rescued_data"}
    df = file_scan(spark, path, options, "id int, x string", streaming=False)
    got = [(r.id, r.x, r["_rescued_data"] and json.loads(r["_rescued_data"])) for r in df.collect()]
    assert got == [(1, "a", None), (None, "b", {"id": "no"}), (3, "c", {"_line": "3,c,extra"}), (None, "d", None)]


def test_metadata_columns(spark, tmp_path):
    path = write(tmp_path / "m", "a.json", '{"id":1}')

    def columns(**request):
        return file_scan(spark, path, {"cloudFiles.format": "json"}, "id long", False, metadata=request).columns

    chosen = {"input_file_name": "_metadata.file_name", "input_file_path": "_metadata.file_path"}
    assert columns(select_metadata_cols=chosen) == ["id", "input_file_name", "input_file_path"]
    assert columns(include_autoloader_metadata_column="True") == ["id", "source_metadata"]
    assert columns(include_autoloader_metadata_column="False") == ["id"]
    assert columns(include_autoloader_metadata_column="True", autoloader_metadata_col_name="meta",
                   select_metadata_cols=chosen) == ["id", "meta", "input_file_name", "input_file_path"]


def test_metadata_with_rescue(spark, tmp_path):
    path = write(tmp_path / "mr", "a.json", '{"id":1}')
    options = {"cloudFiles.format": "json", "cloudFiles.rescuedDataColumn": "_r"}
    df = file_scan(spark, path, options, "id long", False, metadata={"select_metadata_cols": {"f": "_metadata.file_name"}})
    assert [tuple(r) for r in df.collect()] == [(1, None, "a.json")]


def test_kafka_options():
    base = {"kafka.bootstrap.servers": "b:1", "subscribe": "t"}
    assert messages.kafka_options(base, {"startingOffsets": "earliest", "subscribe": "mine"}) == {
        "kafka.bootstrap.servers": "b:1", "subscribe": "mine", "startingOffsets": "earliest"
    }
    with pytest.raises(messages.MessageConfigError, match="broker"):
        messages.kafka_options({"subscribe": "t"})
    with pytest.raises(messages.MessageConfigError, match="topic"):
        messages.kafka_options({"kafka.bootstrap.servers": "b:1"})
    secret = {"kafka_source_servers_secrets_scope_name": "s", "kafka_source_servers_secrets_scope_key": "k", "subscribe": "t"}
    assert messages.kafka_options(secret, secrets=lambda s, k: f"{s}/{k}")["kafka.bootstrap.servers"] == "s/k"
    ssl = {**base, "kafka.ssl.truststore.location": "/t", "kafka.ssl.keystore.location": "/k"}
    with pytest.raises(messages.MessageConfigError, match="SSL"):
        messages.kafka_options(ssl, secrets=lambda s, k: "x")
    ssl |= {f"kafka.ssl.{store}.secrets.{part}": f"{store}-{part}" for store in ("truststore", "keystore") for part in ("scope", "key")}
    full = messages.kafka_options(ssl, secrets=lambda s, k: f"{s}/{k}")
    assert full["kafka.ssl.keystore.password"] == "keystore-scope/keystore-key"
    assert full["kafka.ssl.truststore.password"] == "truststore-scope/truststore-key"


def test_eventhub_options():
    details = {"eventhub.namespace": "ns", "eventhub.port": "9093", "eventhub.name": "hub",
               "eventhub.accessKeyName": "reader", "eventhub.secretsScopeName": "scope"}
    asked = []
    got = messages.eventhub_options(details, {"failOnDataLoss": "false"}, lambda s, k: asked.append((s, k)) or "KEY")
    assert asked == [("scope", "reader")]
    assert got["kafka.bootstrap.servers"] == "ns.servicebus.windows.net:9093"
    assert got["subscribe"] == "hub" and got["failOnDataLoss"] == "false"
    assert got["kafka.sasl.mechanism"] == "PLAIN" and got["kafka.security.protocol"] == "SASL_SSL"
    assert "SharedAccessKeyName=reader;SharedAccessKey=KEY" in got["kafka.sasl.jaas.config"]
    sink = messages.message_sink_options("eventhub", details, lambda s, k: "KEY")
    assert sink["topic"] == "hub" and not any(k.startswith("eventhub.") for k in sink)


def test_kafka_sink_options():
    options = {"kafka_sink_servers_secret_scope_name": "s", "kafka_sink_servers_secret_scope_key": "k", "topic": "t"}
    got = messages.message_sink_options("kafka", options, lambda s, k: f"{s}/{k}")
    assert got == {"topic": "t", "kafka.bootstrap.servers": "s/k"}


def test_malformed_payload_is_a_struct_of_nulls(spark):
    df = spark.sql("SELECT cast(v AS binary) AS value, timestamp'2024-01-02 03:04:05' AS timestamp FROM VALUES ('{\"a\":1}'), ('oops'), (NULL) t(v)")
    rows = messages.message_frame(df, schema_from_ddl("a int")).collect()
    assert [r.parsed_records and r.parsed_records.asDict() for r in rows] == [{"a": 1}, {"a": None}, None]
    assert (str(rows[0].date), rows[0].hour, rows[0].minute) == ("2024-01-02", 3, 4)
    assert "parsed_records" not in messages.message_frame(df).columns


def test_numbered_snapshots(spark, tmp_path):
    for v in (1, 2):
        write(tmp_path / "s", f"LOAD_{v}.csv", f"k,x\n{v},a\n")
    following = numbered_snapshots(spark, str(tmp_path / "s" / "LOAD_"), ".csv", options={"header": "true"})
    assert [(v, df.first().k) for v, df in snapshot_versions(following)] == [(1, "1"), (2, "2")]
    assert [v for v, _ in snapshot_versions(following, latest=1)] == [2]
    with pytest.raises(ValueError, match="does not follow"):
        list(snapshot_versions(lambda latest: (None, 1)))


RECORDS = [{"a": 1, "b": {"c": "x", "d": [1, 2]}, "t": "2024-01-02"}, {"a": None, "b": None}, {}, {"a": 7, "b": {"c": None}, "s": "é \n ]"}]
RECORD_SCHEMA = "a bigint, b struct<c: string, d: array<int>>, t date, s string"


def _put(path, name, text, encoding="utf-8"):
    path.mkdir(exist_ok=True)
    (path / name).write_bytes(text.encode(encoding))


@pytest.mark.parametrize("key, value", [("multiLine", True), ("MULTILINE", "true"), ("multiline", "True")])
@pytest.mark.parametrize("streaming", [False, True])
def test_multi_line_rescue_is_the_plain_reader_on_clean_files(spark, tmp_path, key, value, streaming):
    _put(tmp_path / "in", "a.json", json.dumps(RECORDS, indent=2, ensure_ascii=False))
    _put(tmp_path / "in", "b.json", json.dumps(RECORDS[0], indent=1))
    _put(tmp_path / "in", "c.json", " [\n] ")
    _put(tmp_path / "in", "d.json", " \n ")
    options = {"cloudFiles.format": "json", "cloudFiles.rescuedDataColumn": "_r", key: value}
    df = file_scan(spark, str(tmp_path / "in"), options, RECORD_SCHEMA, streaming)
    if streaming:
        df.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
        df = spark.read.parquet(str(tmp_path / "out"))
    plain = spark.read.schema(RECORD_SCHEMA).option("multiLine", "true").json(str(tmp_path / "in"))
    got = sorted(map(str, df.drop("_r").collect()))
    assert got == sorted(map(str, plain.collect())) and len(got) == len(RECORDS) + 1
    assert df.where("_r IS NOT NULL").count() == 0


def test_multi_line_rescue_of_dirty_files(spark, tmp_path):
    _put(tmp_path / "in", "a.json", '[\n {"a": "x",\n "b": {"c": "y", "z": 1}},\n {"a": 1, "new": [1,\n 2]}, 5,\n {"a": 3}\n]')
    _put(tmp_path / "in", "b.json", '[{"a": 1},\n {"a"')
    request = {"include_autoloader_metadata_column": "true"}
    options = {"cloudFiles.format": "json", "cloudFiles.rescuedDataColumn": "_r", "multiLine": "true"}
    df = file_scan(spark, str(tmp_path / "in"), options, RECORD_SCHEMA, False, metadata=request)
    got = sorted(((r.a, r.b and r.b.c, json.loads(r["_r"]) if r["_r"] else None, r.source_metadata.file_name) for r in df.collect()), key=str)
    assert got == sorted(
        [
            (None, "y", {"a": "x", "b": '{"c":"y","z":1}'}, "a.json"),
            (1, None, {"new": "[1,2]"}, "a.json"),
            (None, None, {"_line": "5"}, "a.json"),
            (3, None, None, "a.json"),
            (None, None, {"_line": '[{"a": 1},\n {"a"'}, "b.json"),
        ],
        key=str,
    )


def test_encoding_and_line_separator_hold_in_rescue(spark, tmp_path):
    _put(tmp_path / "wide", "a.json", json.dumps(RECORDS, ensure_ascii=False), "utf-16")
    options = {"cloudFiles.format": "json", "cloudFiles.rescuedDataColumn": "_r", "encoding": "UTF-16", "multiLine": "true"}
    df = file_scan(spark, str(tmp_path / "wide"), options, RECORD_SCHEMA, False)
    assert sorted(str(r.s) for r in df.collect()) == ["None", "None", "None", "é \n ]"] and df.where("_r IS NOT NULL").count() == 0
    with pytest.raises(ValueError):
        file_scan(spark, str(tmp_path / "wide"), {**options, "multiLine": "false"}, RECORD_SCHEMA, False)
    _put(tmp_path / "bars", "a.json", '{"a": 1}|{"a": "n\\nn"}|{"a": 3}')
    options = {"cloudFiles.format": "json", "cloudFiles.rescuedDataColumn": "_r", "lineSep": "|"}
    got = [(r.a, r["_r"]) for r in file_scan(spark, str(tmp_path / "bars"), options, RECORD_SCHEMA, False).collect()]
    assert got == [(1, None), (None, json.dumps({"a": "n\nn"}, separators=(",", ":"))), (3, None)]


def test_a_corrupt_record_column_of_the_schema_stays(spark, tmp_path):
    _put(tmp_path / "in", "a.json", '{"a": 1}\n{"a": "x"}\n{"a"')
    options = {"cloudFiles.format": "json", "cloudFiles.rescuedDataColumn": "_r", "columnNameOfCorruptRecord": "bad"}
    got = [tuple(r) for r in file_scan(spark, str(tmp_path / "in"), options, "a bigint, bad string", False).collect()]
    assert got == [(1, None, None), (None, '{"a": "x"}', '{"a":"x"}'), (None, '{"a"', json.dumps({"_line": '{"a"'}, separators=(",", ":")))]
