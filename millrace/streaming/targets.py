"""Append targets, sinks and the trigger that drives a flow until its input is used up."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from millrace.operators.layout import writer
from millrace.operators.transforms import select_exprs, where_all
from millrace.session import empty_frame, write_text
from millrace.sources.messages import Secrets, message_payload, message_sink_options
from millrace.functions.schemas import resolve_schema
from millrace.specs import Sink, Target
from millrace.streaming.store import (
    Batch,
    check_columns,
    folders_below,
    read_small,
    read_state,
    refuse_other_types,
    remove_path,
    series_of,
    write_small,
    write_state,
)

FLOW = "__flow"
BATCH = "__batch"


def sql_text(text: object) -> str:
    """A string literal."""
    return "'" + str(text).replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_name(name: str) -> str:
    """A quoted column name."""
    return "`" + name.replace("`", "``") + "`"


def _path_missing(error: AnalysisException) -> bool:
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def batch_folder(batch_id) -> str:
    """The folder name of a batch: its number, after its checkpoint's id if that is known."""
    series = series_of(batch_id)
    return f"{series}-{int(batch_id)}" if series else str(batch_id)


#: Batches that are not packed yet, from which on ``compact`` packs them, and packs of a size that it makes into one.
PACK_AFTER, PACK_FAN = 64, 8


class AppendTable:
    """A parquet table that several flows append to.

    Every batch of a flow owns one folder, ``__flow=<flow>/__batch=<id>``, which a replay
    overwrites; so each row is in the table once, and flows never touch each other's files.

    ``compact`` copies the folders of old batches into *packs*, few files beside the table, and a small file (the manifest, of which the last two are kept) says which packs
    there are and up to which batch of each flow they reach. Readers take the packs and the folders of later batches, and a
    replay of a packed batch is skipped. Streams go on reading folders, so none sees a row again; ``vacuum`` deletes the packed
    folders once no stream lags behind, and a stream that starts later reads the packs of that time first.
    """

    def __init__(self, spark: SparkSession, target: Target):
        self.spark = spark
        self.target = target
        self.root = target.path.rstrip("/")
        self.declared = resolve_schema(spark, target.schema)
        self._fields: list[T.StructField] = []

    def create(self, schema: T.StructType) -> None:
        """An empty typed table, before any flow has run."""
        self._remember(schema)
        empty = empty_frame(self.spark, schema).coalesce(1)
        empty.write.mode("overwrite").parquet(f"{self.root}/{FLOW}=created/{BATCH}=0")
        self.register()

    def register(self) -> None:
        """Name the folder in the catalog, with properties and comment."""
        if not self.target.name:
            return
        columns = [f"{sql_name(f.name)} {f.dataType.simpleString()}" for f in self.schema().fields]
        columns += [f"{FLOW} string", f"{BATCH} string"]
        parts = ", ".join([FLOW, BATCH, *map(sql_name, self.target.partition_by)])
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.target.name} ({', '.join(columns)}) USING parquet "
            f"PARTITIONED BY ({parts}) LOCATION {sql_text(self.root)}"
        )
        set_table_facts(self.spark, self.target.name, self.target.properties, self.target.comment)
        self.spark.catalog.recoverPartitions(self.target.name)

    def write_batch(self, df: DataFrame, batch_id, flow: str = "main") -> bool:
        """Write a batch; False if it is in a pack already."""
        check_columns(df.columns)
        if int(batch_id) <= self._manifest()["upto"].get(flow, {}).get(series_of(batch_id), -1):
            return False
        self._remember(df.schema)
        path = f"{self.root}/{FLOW}={flow}/{BATCH}={batch_folder(batch_id)}"
        writer(df, self.target).mode("overwrite").save(path)
        return True

    def _stored(self) -> list[T.StructField]:
        """Columns as written, kept beside the table: no footers are read for them, and the
        type of a partition column is not guessed from its folder names."""
        try:
            lines = self.spark.read.text(f"{self.root}.schema").collect()
        except AnalysisException as error:
            if not _path_missing(error):
                raise
            lines = []
        schemas = [T.StructType.fromJson(json.loads(line["value"])) for line in lines]
        found: dict[str, T.StructField] = {}
        for schema in sorted(schemas, key=len, reverse=True):
            for field in schema.fields:
                found.setdefault(field.name, T.StructField(field.name, field.dataType, True))
        return list(found.values())

    def _remember(self, schema: T.StructType) -> None:
        """Note columns that are new to the table; most batches add none. A column whose type differs from the
        table's is refused before anything is written, as the table could not be read afterwards."""
        if not self._fields:
            self._fields = self._stored()
        have = {f.name: f.dataType for f in [*self._fields, *(self.declared.fields if self.declared else [])]}
        refuse_other_types(schema, have, self.root)
        new = {f.name for f in schema.fields} - {f.name for f in self._fields}
        if new:
            self._fields = self._stored()
            if {f.name for f in schema.fields} - {f.name for f in self._fields}:
                write_text(self.spark, schema.json(), f"{self.root}.schema", "append")
                self._fields = self._stored()

    def exists(self) -> bool:
        return bool(self._stored())

    def schema(self) -> T.StructType:
        """The table's own columns."""
        fields = self.declared.fields if self.declared else self._stored()
        if not fields:
            raise ValueError(f"nothing was written to {self.root} yet")
        return T.StructType(fields)

    def _full_schema(self) -> T.StructType:
        own = T.StructType.fromDDL(f"{FLOW} string, {BATCH} string")
        return T.StructType([*self.schema().fields, *own.fields])

    def table(self) -> DataFrame:
        manifest = self._manifest()
        packs = [*manifest["bases"], *(p["at"] for p in manifest["packs"])]
        rows = self.spark.read.schema(self._full_schema()).parquet(self.root)
        if not packs:
            return rows.drop(FLOW, BATCH)
        return rows.where(~_reached(manifest["upto"])).drop(FLOW, BATCH).unionByName(self._read_packs(packs))

    def stream(self, options: dict | None = None, progress: str | None = None) -> DataFrame:
        """Rows as they are appended. Where packed folders were deleted, the rows that a stream of its own ``progress`` starts with come
        from the packs of its first start, which is noted there."""
        manifest = self._manifest()
        began = {"bases": manifest["bases"], "gone": manifest["gone"]}
        if progress is not None:
            kept = read_small(self.spark, f"{progress}-packs.json")
            began = json.loads(kept) if kept else began
            if not kept:
                write_small(self.spark, f"{progress}-packs.json", json.dumps(began))

        def reader():
            return self.spark.readStream.options(**(options or {}))

        rows = reader().schema(self._full_schema()).parquet(self.root)
        if not began["bases"]:
            return rows.drop(FLOW, BATCH)
        out = rows.where(~_reached(began["gone"])).drop(FLOW, BATCH)
        for at in began["bases"]:
            out = out.unionByName(reader().schema(self.schema()).parquet(self._pack(at)))
        return out

    # packs

    def _manifest(self) -> dict:
        """``packs`` (with their level), ``bases`` (packs whose folders are gone), ``upto`` and ``gone`` (the last batch that packs and
        bases hold, by flow and series), ``old`` (packs that were made into one)."""
        found = read_state(self.spark, f"{self.root}.packs/list")
        return found or {"packs": [], "bases": [], "upto": {}, "gone": {}, "old": []}

    def _keep(self, manifest: dict) -> None:
        write_state(self.spark, f"{self.root}.packs/list", manifest)

    def _pack(self, at: str) -> str:
        return f"{self.root}.packs/at={at}"

    def _read_packs(self, packs: Sequence[str]) -> DataFrame:
        return self.spark.read.schema(self.schema()).parquet(*[self._pack(at) for at in packs])

    def _folders(self) -> list[tuple[str, str, int, str]]:
        """(flow, series, number, folder) of every batch that has a folder."""
        found = []
        for flow, batch in folders_below(self.spark, self.root, 2):
            series, _, number = unquote(batch.split("=", 1)[1]).rpartition("-")
            if number.isdigit() and flow != f"{FLOW}=created":
                found.append((unquote(flow.split("=", 1)[1]), series, int(number), f"{self.root}/{flow}/{batch}"))
        return found

    def compact(self, least: int = PACK_AFTER) -> bool:
        """Pack the batches that are not packed yet, if there are ``least`` of them; the newest of a flow may be written
        again and stays as it is. Run by the writer, between batches."""
        manifest = self._manifest()
        upto = manifest["upto"]
        newest: dict[tuple[str, str], int] = {}
        for flow, series, number, _ in (folders := self._folders()):
            newest[flow, series] = max(number, newest.get((flow, series), -1))
        taken = [f for f in folders if upto.get(f[0], {}).get(f[1], -1) < f[2] < newest[f[0], f[1]]]
        if len(taken) < least:
            return False
        rows = self.spark.read.schema(self._full_schema()).option("basePath", self.root).parquet(*[f[3] for f in taken])
        manifest["packs"].append({"at": self._write_pack(rows.drop(FLOW, BATCH)), "level": 0})
        for flow, series, number, _ in taken:
            held = upto.setdefault(flow, {})
            held[series] = max(number, held.get(series, -1))
        gone, manifest["old"] = manifest["old"], []
        level = 0
        while len(same := [p["at"] for p in manifest["packs"] if p["level"] == level]) >= PACK_FAN:
            whole = {"at": self._write_pack(self._read_packs(same)), "level": level + 1}
            manifest["packs"] = [p for p in manifest["packs"] if p["level"] != level] + [whole]
            manifest["old"] += same
            level += 1
        self._keep(manifest)
        for at in gone:  # replaced by the compaction before this one
            remove_path(self.spark, self._pack(at))
        return True

    def _write_pack(self, rows: DataFrame) -> str:
        at = uuid.uuid4().hex
        if not (self.target.partition_by or self.target.cluster_by or self.target.zorder_by):
            rows = rows.hint("rebalance")  # files of the size that adaptive execution aims at
        writer(rows, self.target).save(self._pack(at))
        return at

    def vacuum(self) -> list[str]:
        """Delete the folders of packed batches; run it when no stream of the table still has to read them. Gives the folders."""
        if self.target.name:
            raise ValueError(f"{self.target.name} reads the folders of its batches; they cannot be deleted")
        manifest = self._manifest()
        manifest["bases"] += [p["at"] for p in manifest["packs"]]
        manifest["packs"], manifest["gone"] = [], manifest["upto"]
        self._keep(manifest)
        gone = [path for flow, series, number, path in self._folders() if number <= manifest["gone"].get(flow, {}).get(series, -1)]
        for path in gone:
            remove_path(self.spark, path)
        return gone


def _reached(upto: dict[str, dict[str, int]]) -> Column:
    """Whether a folder's flow and batch are among those up to a batch of each series."""
    reached = F.lit(False)
    for flow, series in upto.items():
        for name, number in series.items():
            before = f"{name}-" if name else ""
            own = F.expr(f"try_cast(substring({BATCH}, {len(before) + 1}) AS bigint)") <= number
            reached = reached | ((F.col(FLOW) == flow) & F.col(BATCH).startswith(before) & F.coalesce(own, F.lit(False)))
    return reached


def set_table_facts(spark: SparkSession, name: str, properties: dict[str, str], comment: str | None) -> None:
    if properties:
        pairs = ", ".join(f"{sql_text(k)} = {sql_text(v)}" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")
    if comment:
        spark.sql(f"COMMENT ON TABLE {name} IS {sql_text(comment)}")


# catalog helpers ----------------------------------------------------------------------------


def create_database(spark: SparkSession, database: str, comment: str = "") -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} COMMENT {sql_text(comment)}")


def drop_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def register_path(spark: SparkSession, name: str, path: str) -> None:
    """Name a parquet folder."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION {sql_text(path)}")


def deregister(spark: SparkSession, name: str) -> None:
    """Forget the name; an external table's files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def table_location(spark: SparkSession, name: str) -> str:
    facts = spark.sql(f"DESCRIBE EXTENDED {name}")
    return facts.where("col_name = 'Location'").first()["data_type"]


def overwrite_table(df: DataFrame, target: Target) -> None:
    """Replace the content of a folder; columns may be new."""
    writer(df, target).mode("overwrite").save(target.path)


# sinks --------------------------------------------------------------------------------------


def sink_rows(df: DataFrame, sink: Sink) -> DataFrame:
    """The rows a sink gets: its select list, then its where clause."""
    return where_all(select_exprs(df, sink.select_exp), [sink.where_clause] if sink.where_clause else None)


def message_rows(df: DataFrame, sink: Sink) -> DataFrame:
    """Rows of a message sink: ``value`` as it is, or all columns as JSON text."""
    rows = sink_rows(df, sink)
    return rows if "value" in rows.columns else message_payload(rows, sink.option("key"))


def write_sink(df: DataFrame, sink: Sink, batch_id, secrets: Secrets | None = None) -> None:
    """Write one batch to a sink. Table sinks own a folder or partition per batch, so a replay
    overwrites its own rows; a message sink gets a replayed batch again (at least once).
    """
    if sink.format in ("kafka", "eventhub"):
        options = message_sink_options(sink.format, sink.options, secrets)
        message_rows(df, sink).write.format("kafka").options(**options).save()
        return
    rows = sink_rows(df, sink)
    # with a name, a path says where the named table's files go
    name = sink.table_name()
    if not name:
        AppendTable(df.sparkSession, Target(sink.option("path"))).write_batch(rows, batch_id, sink.name)
        return
    write_named(rows, name, sink.option("path"), sink.name, batch_id)


def write_named(rows: DataFrame, name: str, path: str | None, flow: str, batch_id) -> None:
    """Put a batch into its own partition of a named table; columns go by name.

    The batch's folder is written first and then made known, so other batches' folders are not touched.
    """
    spark = rows.sparkSession
    check_columns(rows.columns)
    if not spark.catalog.tableExists(name):
        place = {"path": path} if path else {}
        empty = rows.limit(0).withColumns({FLOW: F.lit(""), BATCH: F.lit("")})
        empty.write.partitionBy(FLOW, BATCH).format("parquet").options(**place).saveAsTable(name)
    have = {f.name: f.dataType for f in spark.table(name).schema.fields if f.name not in (FLOW, BATCH)}
    if set(rows.columns) - set(have):
        raise ValueError(f"columns {sorted(set(rows.columns) - set(have))} are not in {name}")
    refuse_other_types(rows.schema, have, name)
    folder = batch_folder(batch_id)
    place = f"{table_location(spark, name).rstrip('/')}/{FLOW}={flow}/{BATCH}={folder}"
    rows.select(*[F.col(f"`{c}`") for c in have if c in rows.columns]).write.mode("overwrite").parquet(place)
    spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({FLOW} = {sql_text(flow)}, {BATCH} = {sql_text(folder)}) LOCATION {sql_text(place)}")
    spark.catalog.refreshTable(name)


# driving ------------------------------------------------------------------------------------


def batch_writer(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, name: str | None = None
) -> DataStreamWriter:
    """The stream's batches go to ``handle(batch, batch_id)``; the trigger is still open. Batch numbers carry the
    checkpoint's id (``Batch.series``): another checkpoint's batches are not taken for these.
    """
    series = ""

    def numbered(batch: DataFrame, batch_id: int) -> None:
        nonlocal series
        if not series:
            series = checkpoint_id(batch.sparkSession, checkpoint)
        handle(batch, Batch(batch_id, series))

    out = stream.writeStream.foreachBatch(numbered).option("checkpointLocation", checkpoint)
    return out.queryName(name) if name else out


def checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream's checkpoint was given when it was made."""
    text = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()["value"]
    return json.loads(text)["id"]


def run_available(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, name: str | None = None
) -> int:
    """Feed everything that is there to ``handle(batch, batch_id)``; gives the number of batches.

    The checkpoint remembers what was read, so the next run starts where this one ended.
    """
    count = 0

    def counted(batch: DataFrame, batch_id: int) -> None:
        nonlocal count
        handle(batch, batch_id)
        count += 1

    batch_writer(stream, counted, checkpoint, name).trigger(availableNow=True).start().awaitTermination()
    return count


def run_once(
    spark: SparkSession,
    stream: Callable[[], DataFrame],
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    name: str | None = None,
) -> int:
    """As ``run_available``, but never again once it went through: a mark beside the checkpoint."""
    mark = f"{checkpoint.rstrip('/')}-done"
    try:
        spark.read.text(mark).limit(1).collect()
        return 0
    except AnalysisException as error:
        if not _path_missing(error):
            raise
    count = run_available(stream(), handle, checkpoint, name)
    write_text(spark, "done", mark)
    return count


def append_stream(
    stream: DataFrame, table: AppendTable, checkpoint: str, flow: str = "main"
) -> int:
    """Append a stream to a table until its input is used up."""
    return run_available(stream, lambda batch, i: table.write_batch(batch, i, flow), checkpoint)


def fan_out_stream(
    stream: DataFrame, writes: Sequence[Callable[[DataFrame, int], None]], checkpoint: str
) -> int:
    """One read, many writes: every batch is held while all of them run."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            for write in writes:
                write(held, batch_id)
        finally:
            held.unpersist()

    return run_available(stream, handle, checkpoint)
