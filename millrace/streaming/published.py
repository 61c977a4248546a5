"""A named table beside a keyed store, of which a run writes only the buckets that it changed.

The table is partitioned by the store's buckets and then by the target's partition columns. A publication writes the changed buckets
to a folder of its own, in the target's layout, and then switches each partition of them to its new place in the catalog; readers
find every other partition untouched, and the name is made anew only where a column has gone or changed its type. Files that were
replaced stay for one more publication, for those who still read them. What is where is kept in small files beside the folders, written last: a publication that dies
is made again by the next one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from millrace.operators.layout import writer
from millrace.specs import Target
from millrace.streaming.store import BUCKET, folders_below, read_state, remove_path, write_state
from millrace.streaming.targets import deregister, set_table_facts, sql_name, sql_text

PLACE = "at"
# Fixed value: the folder name of a NULL partition value.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


class PublishedTable:
    """``rows(buckets)`` gives the table's rows of some buckets, or of all where that is None, with ``BUCKET``."""

    def __init__(self, spark: SparkSession, root: str, target: Target, rows: Callable[[Sequence[int] | None], DataFrame]):
        self.spark, self.root, self.target, self.rows = spark, root.rstrip("/"), target, rows
        self.levels = [BUCKET, *target.partition_by]

    def _state(self) -> dict:
        return read_state(self.spark, f"{self.root}.state") or {"version": -1, "leaves": {}, "stale": []}

    def publish(self, version: int, touched: Callable[[int], Sequence[int] | None]) -> list[int]:
        """Bring the table to a version of the store; ``touched(version)`` names the buckets that changed since one, or None for all.
        Gives the buckets that were written."""
        state, name = self._state(), self.target.name
        schema = self.rows([]).drop(BUCKET).schema
        exists = self.spark.catalog.tableExists(name)
        whole = not exists or state["version"] < 0 or not self._fits(schema)
        buckets = None if whole else touched(state["version"])
        if buckets is not None and not buckets:
            return []
        place = f"{self.root}/{PLACE}={uuid.uuid4().hex}"
        writer(self.rows(buckets), self.target, [BUCKET]).mode("overwrite").save(place)
        written = self._leaves(place)
        if whole:
            deregister(self.spark, name)
            self._create(schema)
            state["leaves"] = {}
        if exists or whole:
            self._add_columns(schema)
        gone = {leaf for leaf in state["leaves"] if buckets is None or int(json.loads(leaf)[0]) in set(buckets)}
        self._switch(written, gone & set(state["leaves"]))
        leaves = {k: v for k, v in state["leaves"].items() if k not in gone} | written
        stale = self._clear(set(leaves.values()), set(state["stale"]))
        self.spark.catalog.refreshTable(name)
        set_table_facts(self.spark, name, self.target.properties, self.target.comment)
        write_state(self.spark, f"{self.root}.state", {**state, "version": version, "leaves": leaves, "stale": stale})
        return sorted({int(json.loads(leaf)[0]) for leaf in (*written, *gone)})

    def _leaves(self, place: str) -> dict[str, str]:
        """Partition values (as JSON) of the folders below a place, and where they are."""
        found = {}
        for names in folders_below(self.spark, place, len(self.levels)):
            values = [unquote(n.split("=", 1)[1]) for n in names]
            found[json.dumps([None if v == NULL_FOLDER else v for v in values])] = "/".join((place, *names))
        return found

    def _own_schema(self) -> dict[str, T.DataType]:
        return {f.name: f.dataType for f in self.spark.table(self.target.name).schema.fields}

    def _fits(self, schema: T.StructType) -> bool:
        """Whether the table has the levels and no column that is gone or of another type."""
        have = self._own_schema()
        new = {f.name: f.dataType for f in schema.fields}
        facts = [c.name for c in self.spark.catalog.listColumns(self.target.name) if c.isPartition]
        return sorted(facts) == sorted(self.levels) and all(n == BUCKET or (n in new and new[n].simpleString() == t.simpleString()) for n, t in have.items())

    def _create(self, schema: T.StructType) -> None:
        columns = [f"{sql_name(f.name)} {f.dataType.simpleString()}" for f in schema.fields]
        parts = ", ".join(map(sql_name, self.levels))
        self.spark.sql(
            f"CREATE TABLE {self.target.name} ({', '.join(columns)}, {BUCKET} int) USING parquet PARTITIONED BY ({parts}) LOCATION {sql_text(self.root)}"
        )

    def _add_columns(self, schema: T.StructType) -> None:
        new = [f for f in schema.fields if f.name not in self._own_schema()]
        if new:
            columns = ", ".join(f"{sql_name(f.name)} {f.dataType.simpleString()}" for f in new)
            self.spark.sql(f"ALTER TABLE {self.target.name} ADD COLUMNS ({columns})")

    def _spec(self, leaf: str) -> str:
        pairs = zip(self.levels, json.loads(leaf))
        return "PARTITION (" + ", ".join(f"{sql_name(n)} = {'NULL' if v is None else sql_text(v)}" for n, v in pairs) + ")"

    def _switch(self, written: dict[str, str], gone: set[str]) -> None:
        """Each partition of the changed buckets to its new place; those without rows go last."""
        name = self.target.name
        new = [f"{self._spec(leaf)} LOCATION {sql_text(place)}" for leaf, place in written.items() if leaf not in gone]
        if new:
            self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(new)}")
        for leaf in (*new_leaves(written, gone), *sorted(gone & set(written))):
            self.spark.sql(f"ALTER TABLE {name} {self._spec(leaf)} SET LOCATION {sql_text(written[leaf])}")
        old = [self._spec(leaf) for leaf in sorted(gone - set(written))]
        if old:
            self.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {', '.join(old)}")

    def _clear(self, live: set[str], stale: set[str]) -> list[str]:
        """Delete what was replaced before the last publication; gives what has been replaced since."""
        folders = {
            "/".join((self.root, *names)) for names in folders_below(self.spark, self.root, 1 + len(self.levels))
        }
        for folder in sorted(folders - live & stale):
            remove_path(self.spark, folder)
        kept = {f[len(self.root) + 1 :].split("/")[0] for f in folders - (folders - live & stale)}
        for (place,) in folders_below(self.spark, self.root, 1):
            if place not in kept:
                remove_path(self.spark, f"{self.root}/{place}")
        return sorted(folders - live - stale)


def new_leaves(written: dict[str, str], gone: set[str]) -> list[str]:
    """Partitions that a publication which died may have made already: set again, as ADD IF NOT EXISTS leaves them where they are."""
    return sorted(set(written) - gone)
