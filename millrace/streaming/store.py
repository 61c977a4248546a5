"""A table folder of immutable version folders and a pointer to those that count.

A batch writes its files under the next version number and switches the pointer last. Until then
readers see the old versions; a batch that dies half-way leaves files nobody points to, and its
replay overwrites them under the same number. The pointer also records the last batch of every
flow, so a batch that was committed is skipped when it comes again.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import empty_frame

DEFAULT_BUCKETS = 64
FEW_ROWS = 100_000
#: A bucket that later versions append to is written anew when what was appended reaches this share of its base, or this often.
APPENDED_SHARE, MOST_APPENDED = 0.5, 32
BUCKET = "__bucket"
VERSION = "__v"


class Batch(int):
    """A batch number that knows its series, the id of the checkpoint that counts. A checkpoint that was lost or
    renamed starts a new series, whose numbers say nothing about those of the old one."""

    series: str

    def __new__(cls, number: int, series: str = "") -> Batch:
        batch = super().__new__(cls, number)
        batch.series = series
        return batch


def series_of(batch_id) -> str:
    return getattr(batch_id, "series", "")


def check_columns(names: Sequence[str]) -> None:
    """Columns that begin with two underscores are the store's own."""
    own = [c for c in names if c.startswith("__") and c not in ("__START_AT", "__END_AT")]
    if own:
        raise ValueError(f"columns {own} cannot be stored: names beginning with __ are taken")


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it is on."""
    at, files = _filesystem(spark, path)
    files.delete(at, True)


def read_state(spark: SparkSession, folder: str) -> dict | None:
    """The newest state kept in a folder; None if there is none. Two slots are written in turns, so one is always whole."""
    slots = [read_small(spark, f"{folder}/slot-{i}.json") for i in (0, 1)]
    return max((json.loads(text) for text in slots if text is not None), key=lambda s: s["serial"], default=None)


def write_state(spark: SparkSession, folder: str, state: dict) -> None:
    """Keep the state that follows the one it was read with."""
    state = {**state, "serial": state.get("serial", 0) + 1}
    write_small(spark, f"{folder}/slot-{state['serial'] % 2}.json", json.dumps(state))


def _filesystem(spark: SparkSession, path: str):
    """(Hadoop path, its file system)."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def read_small(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, without a job; None if there is none."""
    at, files = _filesystem(spark, path)
    if not files.exists(at):
        return None
    stream = files.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """Put a small file in its place when it is whole, without a job."""
    at, files = _filesystem(spark, path)
    half, _ = _filesystem(spark, f"{path}.half")
    stream = files.create(half, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    files.delete(at, False)
    if not files.rename(half, at):
        raise OSError(f"cannot put {path} in its place")


def refuse_other_types(schema: T.StructType, have: dict[str, T.DataType], where: str) -> None:
    for found in schema.fields:
        kind = have.get(found.name)
        if kind is not None and kind.jsonValue() != found.dataType.jsonValue() and kind.simpleString() != found.dataType.simpleString():
            raise ValueError(f"{found.name} is {kind.simpleString()} in {where}, not {found.dataType.simpleString()}")


def folders_below(spark: SparkSession, root: str, depth: int) -> list[list[str]]:
    """Names of the nested partition folders below a folder, outermost first."""
    path, files = _filesystem(spark, root)
    if not files.exists(path):
        return []
    found = [([], path)]
    for _ in range(depth):
        found = [
            ([*names, status.getPath().getName()], status.getPath())
            for names, at in found
            for status in files.listStatus(at)
            if status.isDirectory() and "=" in status.getPath().getName()
        ]
    return [names for names, _ in found]


class VersionedStore:
    def __init__(self, spark: SparkSession, root: str, buckets: int = DEFAULT_BUCKETS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets

    # pointer ------------------------------------------------------------------------------

    def pointer(self) -> dict:
        """The newest pointer. Two slots are written in turns, so one is always whole."""
        slots = [read_small(self.spark, f"{self.root}/pointer/slot-{i}.json") for i in (0, 1)]
        found = [json.loads(text) for text in slots if text is not None]
        if not found:
            return {"version": 0, "flows": {}, "parts": {}, "buckets": self.buckets}
        newest = max(found, key=lambda p: p["version"])
        if newest["buckets"] != self.buckets:
            raise ValueError(f"{self.root} has {newest['buckets']} buckets, not {self.buckets}")
        return newest

    def commit(self, pointer: dict) -> None:
        write_small(self.spark, f"{self.root}/pointer/slot-{pointer['version'] % 2}.json", json.dumps(pointer))

    def done(self, pointer: dict, flow: str, batch_id: int) -> bool:
        series, last = pointer["flows"].get(flow, ("", -1))
        return series == series_of(batch_id) and last >= batch_id

    def advance(self, pointer: dict, flow: str | None = None, batch_id: int | None = None) -> dict:
        """The pointer's next version, as a copy."""
        following = json.loads(json.dumps(pointer))
        following["version"] += 1
        if flow is not None:
            following["flows"][flow] = [series_of(batch_id), int(batch_id)]
        return following

    # parts --------------------------------------------------------------------------------
    # parts: {part name: {"by_version": {version: [buckets]}}, or where a newer version's rows take the place of older
    # ones of the same key {"by_bucket": {bucket: [[version, rows], ...]}}, the base first}

    def write(
        self, df: DataFrame, version: int, partitions: Sequence[str], folder: str, sort: Sequence[str] = (), rows: int | None = None
    ) -> None:
        """Write one version folder. ``df`` is rebalanced so that a partition is few files, and
        one that is too large for a task is split; not if it is known to come from few ``rows``, which a shuffle
        before it left to few tasks. Files are sorted by ``sort``.
        """
        few = rows is not None and rows <= FEW_ROWS
        spread = df if few else df.hint("rebalance", *[F.col(p) for p in partitions])
        if sort:
            spread = spread.sortWithinPartitions(*partitions, *sort)
        spread.write.mode("overwrite").partitionBy(*partitions).parquet(f"{self.root}/{folder}/{VERSION}={version}")

    def written(self, version: int, partitions: Sequence[str], folder: str) -> list[dict]:
        """The partitions a version folder got, from the names of its folders."""
        found = []
        for path in folders_below(self.spark, f"{self.root}/{folder}/{VERSION}={version}", len(partitions)):
            found.append(dict(name.split("=", 1) for name in path))
        return found

    def read(
        self, folder: str, schema: T.StructType, paths: Sequence[str], partitions: str
    ) -> DataFrame:
        """The given folders below ``folder`` (such as ``__v=3/__bucket=1``), with their version
        as ``__v`` and the partition columns given as DDL."""
        full = T.StructType([*schema.fields, *T.StructType.fromDDL(partitions).fields])
        if not paths:
            return empty_frame(self.spark, full.add(VERSION, T.IntegerType()))
        base = f"{self.root}/{folder}"
        reader = self.spark.read.option("basePath", base)
        whole = T.StructType([*full.fields, T.StructField(VERSION, T.IntegerType())])
        return reader.schema(whole).parquet(*[f"{base}/{p}" for p in paths])

    # appended rows ------------------------------------------------------------------------
    # Rows that further flows append to a keyed table: kept as they come, beside what is merged by key, and read with it.

    def append(self, rows: DataFrame, batch_id: int, flow: str, keys: Sequence[str], schema: T.StructType) -> bool:
        """Take one batch of a flow that appends to the table of ``schema``; False if it was taken before. Columns that the
        batch lacks are NULL; others than the table's, or of other types, are refused."""
        flow = f"append:{flow}"
        pointer = self.pointer()
        if self.done(pointer, flow, batch_id):
            return False
        have = {f.name: f.dataType for f in schema.fields}
        unknown = [c for c in rows.columns if c not in have]
        if unknown:
            raise ValueError(f"columns {unknown} are not in {self.root}")
        refuse_other_types(rows.schema, have, self.root)
        following = self.advance(pointer, flow, batch_id)
        version = following["version"]
        given = set(rows.columns)
        whole = rows.select(*[F.col(f"`{n}`") if n in given else F.lit(None).cast(t).alias(n) for n, t in have.items()])
        self.write(whole.withColumn(BUCKET, bucket_of(keys, self.buckets)), version, [BUCKET], "appended")
        buckets = sorted(int(r[BUCKET]) for r in self.written(version, [BUCKET], "appended"))
        if buckets:
            held = following["parts"].setdefault("appended", {"by_version": {}})["by_version"]
            held[str(version)] = buckets
        self.commit(following)
        return True

    def with_appended(self, table: DataFrame, pointer: dict, buckets: Sequence[int] | None = None) -> DataFrame:
        """The table and the rows that were appended to it (in some buckets)."""
        held = pointer["parts"].get("appended", {"by_version": {}})["by_version"]
        paths = [f"{VERSION}={v}/{BUCKET}={b}" for v, bs in held.items() for b in bs if buckets is None or b in set(buckets)]
        if not paths:
            return table
        return table.unionByName(self.read("appended", table.schema, paths, f"{BUCKET} int").drop(VERSION, BUCKET))

    def appended_since(self, version: int) -> set[int]:
        held = self.pointer()["parts"].get("appended", {"by_version": {}})["by_version"]
        return {b for v, bs in held.items() if int(v) > version for b in bs}

    def vacuum(self, folders: Sequence[str]) -> list[str]:
        """Delete version folders that the current pointer does not name; returns them.

        Run it when no reader still uses an older pointer.
        """
        pointer = self.pointer()
        used = {int(v) for part in pointer["parts"].values() for v in self.versions_of(part)}
        gone = []
        for folder in folders:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{folder}")
            fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
            if not fs.exists(path):
                continue
            for status in fs.listStatus(path):
                name = status.getPath().getName()
                mark, _, number = name.partition("=")
                if mark == VERSION and int(number) not in used | {pointer["version"] + 1}:
                    remove_path(self.spark, status.getPath().toString())
                    gone.append(f"{folder}/{name}")
        return gone

    @staticmethod
    def versions_of(part: dict) -> set:
        """Versions a part refers to."""
        if "by_bucket" not in part:
            return set(part["by_version"])
        return {v for held in part["by_bucket"].values() for v in ([p[0] for p in held] if isinstance(held, list) else [held])}

    @staticmethod
    def due(versions: list, rows: int) -> bool:
        """Whether a bucket is to be written anew: what was appended has reached a share of its base, or is in many pieces."""
        if not versions:
            return False
        (_, base), *appended = versions
        return len(appended) + 1 >= MOST_APPENDED or rows + sum(n for _, n in appended) >= APPENDED_SHARE * base
