"""Helpers that several operators share."""

from __future__ import annotations

import pickle
import sys
import types
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_name(wanted: str, taken) -> str:
    """``wanted``, or with underscores in front until no column (of any case) has that name."""
    lower = {c.lower() for c in taken}
    while wanted.lower() in lower:
        wanted = f"_{wanted}"
    return wanted


def map_batches(df: DataFrame, function: Callable, schema: str | T.StructType) -> DataFrame:
    """``function(iterator of Arrow batches) -> iterator of Arrow batches`` over each partition."""
    return df.mapInArrow(function, schema)


def texts(batch: pa.RecordBatch, column: int) -> list[str | None]:
    return batch.column(column).to_pylist()


def in_train(column: str, parts: int, held: int):
    """Whether crc32 of the id as text leaves another remainder than ``held``; NULL ids are not trained on."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % parts != held, F.lit(False))


def smallest_hashes(rows: DataFrame, column: str, most: int) -> DataFrame:
    """At most ``most`` rows, those with the smallest hash of a column (ties by its value).

    A bound on the hash that leaves about half as many rows more is put first, so that a task hands on little more than its share
    of them, and not ``most`` rows by itself. Where the bound leaves too few, there is none.
    """
    place = F.xxhash64(column)
    total = rows.count()
    if total > 2 * most:
        below = rows.where(place < F.lit(int(-(2**63) + 2**64 * 1.5 * most / total)))
        if below.count() >= most:
            rows = below
    return rows.orderBy(place, column).limit(most)


def filesystem(folder: str):
    """(pyarrow filesystem, path) of a shared folder, local or remote."""
    from pyarrow import fs

    if folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder[5:].lstrip("/")
    return fs.FileSystem.from_uri(folder)


def publish(folder: str, name: str, attempt: int, write: Callable) -> None:
    """Write a file under a name of this attempt, then move it to its place: readers see whole files
    only, and a repeated task puts the same bytes in the same place."""
    files, root = filesystem(folder)
    files.create_dir(root, recursive=True)
    temporary = f"{root}/_{name}.{attempt}"
    with files.open_output_stream(temporary, compression=None) as out:
        write(out)
    files.move(temporary, f"{root}/{name}")


def per_worker(key, make: Callable):
    """What ``make()`` gives, made once and kept in this Python worker from task to task."""
    kept = vars(sys.modules.setdefault("millrace_worker", types.ModuleType("millrace_worker"))).setdefault("kept", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]


class Shared:
    """A broadcast value, pickled with the code of its classes, so that workers need not import this package. A
    worker unpacks it once and keeps the last few."""

    KEPT = 8

    def __init__(self, spark: SparkSession, value):
        self.key = uuid.uuid4().hex
        self.sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self):
        kept = per_worker("shared", dict)
        if self.key not in kept:
            while len(kept) >= self.KEPT:
                kept.pop(next(iter(kept)))
            kept[self.key] = pickle.loads(self.sent.value)
        return kept[self.key]
