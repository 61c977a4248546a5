"""SCD tables kept from snapshots, one version after the other.

Open rows lie in hash buckets with a fingerprint of their columns. A new snapshot is first compared by key and fingerprint alone, which
reads only these of the open rows; the keys that differ are then joined in full width. What is written are their rows: closed
versions, and open rows that take the place of older ones of the same key (or say that the key is gone). Buckets without a difference
stay as they are; one whose appended rows reach a share of its base is merged and written anew. A snapshot is read twice.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import snapshot as ops
from millrace.operators.cdc import END_AT
from millrace.session import materialise
from millrace.specs import SnapshotCdc
from millrace.streaming.store import BUCKET, DEFAULT_BUCKETS, VERSION, VersionedStore, bucket_of, check_columns

PART = "__part"
GONE = "__gone"
PRINT = "__print"


def fingerprint(df: DataFrame, columns: Sequence[str]) -> Column:
    """128 bits that differ where a column does, NULLs and nested values included."""

    def plain(name: str) -> Column:
        nested = isinstance(df.schema[name].dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType))
        # a hash passes over NULLs, so nested values go as text and all others with a mark
        return F.to_json(F.array(F.col(name))) if nested else F.col(name)

    values = [plain(c) for c in columns]
    marks = [F.col(c).isNull() for c in columns]
    return F.struct(F.xxhash64(*values, *marks).alias("a"), F.xxhash64(F.lit(7), *marks, *values).alias("b"))


class SnapshotStore(VersionedStore):
    """The last version taken is in the pointer, so a version is taken once."""

    def __init__(self, spark: SparkSession, root: str, cdc: SnapshotCdc, buckets: int = DEFAULT_BUCKETS):
        super().__init__(spark, root, buckets)
        self.cdc = cdc

    def latest(self):
        return self.pointer().get("snapshot")

    # reading ------------------------------------------------------------------------------

    @staticmethod
    def _schema(pointer: dict) -> T.StructType:
        return T.StructType.fromJson(pointer["schema"])

    def _open(self, pointer: dict, buckets: Sequence[int] | None = None) -> DataFrame:
        """Open rows with ``PRINT`` and ``BUCKET``: of the rows of a key that of the newest version, if it is not gone."""
        held = pointer["parts"].get("open", {"by_bucket": {}})["by_bucket"]
        wanted = {b: versions for b, versions in held.items() if buckets is None or int(b) in set(buckets)}
        paths = [f"{VERSION}={v}/{PART}=open/{BUCKET}={b}" for b, versions in wanted.items() for v, _ in versions]
        stored = T.StructType([*self._schema(pointer).fields, T.StructField(PRINT, T.StructType.fromDDL("a long, b long")), T.StructField(GONE, T.BooleanType())])
        rows = self.read("rows", stored, paths, f"{PART} string, {BUCKET} int").drop(PART)
        if all(len(versions) == 1 for versions in wanted.values()):
            return rows.drop(VERSION, GONE)
        rest = [c for c in rows.columns if c not in (*self.cdc.keys, VERSION)]
        newest = rows.groupBy(*self.cdc.keys).agg(F.max_by(F.struct(*rest), VERSION).alias("__r"))
        return newest.select(*self.cdc.keys, "__r.*").where(f"NOT {GONE}").select(*[c for c in rows.columns if c not in (VERSION, GONE)])

    def _closed(self, pointer: dict, buckets: Sequence[int] | None = None) -> DataFrame:
        held = pointer["parts"].get("closed", {"by_version": {}})["by_version"]
        paths = [f"{VERSION}={v}/{PART}=closed/{BUCKET}={b}" for v, bs in held.items() for b in bs if buckets is None or b in set(buckets)]
        return self.read("rows", self._schema(pointer), paths, f"{PART} string, {BUCKET} int").drop(PART, VERSION)

    def touched_since(self, version: int) -> list[int]:
        """The buckets that changed after a version."""
        parts = self.pointer()["parts"]
        opened = {int(b) for b, vs in parts.get("open", {"by_bucket": {}})["by_bucket"].items() if any(v > version for v, _ in vs)}
        noted = [parts.get(part, {"by_version": {}})["by_version"] for part in ("closed", "emptied")]
        other = {b for held in noted for v, bs in held.items() if int(v) > version for b in bs}
        return sorted(opened | other | self.appended_since(version))

    def table(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """The table as it is now, or some of its buckets, with the rows that were appended."""
        pointer = self.pointer()
        return self.with_appended(self.merged(pointer, buckets), pointer, buckets)

    def merged(self, pointer: dict, buckets: Sequence[int] | None = None) -> DataFrame:
        """What the snapshots make of the table."""
        opened = self._open(pointer, buckets).select(*self._schema(pointer).names)
        if not pointer["parts"].get("closed", {"by_version": {}})["by_version"]:
            return opened
        return self._closed(pointer, buckets).select(*opened.columns).unionByName(opened)

    # writing ------------------------------------------------------------------------------

    def apply(self, version, snapshot: DataFrame) -> bool:
        """Take the next snapshot; False if it was taken before. Versions are numbers or text
        that rise."""
        pointer = self.pointer()
        latest = pointer.get("snapshot")
        if latest is not None and version <= latest:
            return False
        check_columns(snapshot.columns)
        following = self.advance(pointer)
        following["snapshot"] = version
        keys = self.cdc.keys
        snapshot = snapshot.withColumn(BUCKET, bucket_of(keys, self.buckets)).withColumn(PRINT, fingerprint(snapshot, snapshot.columns))
        plain = [c for c in snapshot.columns if c not in (BUCKET, PRINT)]
        whole = "schema" not in pointer or (self.cdc.scd_type == 1 and self._schema(pointer) != snapshot.select(*plain).schema)
        if whole:
            checked = ops.checked(snapshot, keys)
            rows = checked if self.cdc.scd_type == 1 else ops.first_scd2(checked, version, self.cdc)
            following["parts"] = {k: v for k, v in following["parts"].items() if k in ("appended", "emptied")}
            due, counts = [], {}
        else:
            differing = self._differing(pointer, snapshot)
            counts = {r[BUCKET]: r["n"] for r in differing.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n")).collect()}
            held = following["parts"].get("open", {"by_bucket": {}})["by_bucket"]
            due = [b for b, n in counts.items() if self.due(held.get(str(b), []), n)]
            rows = self._changes(pointer, snapshot, plain, differing, version, list(counts), due)
        is_open = F.col(END_AT).isNull() if self.cdc.scd_type == 2 else F.lit(True)
        rows = rows.withColumn(PART, F.when(is_open, "open").otherwise("closed"))
        if GONE not in rows.columns:
            rows = rows.withColumn(GONE, F.lit(False))
        if whole:
            following["schema"] = rows.drop(PART, BUCKET, PRINT, GONE).schema.jsonValue()
        now = following["version"]
        self.write(rows, now, [PART, BUCKET], "rows")
        written = [(r[PART], int(r[BUCKET])) for r in self.written(now, [PART, BUCKET], "rows")]
        opened = [b for part, b in written if part == "open"]
        # a differing key leaves one open row; what was merged is counted
        sizes = counts | self._open_rows(now, [b for b in opened if whole or b in set(due)])
        held = following["parts"].setdefault("open", {"by_bucket": {}})["by_bucket"]
        before = pointer["parts"].get("open", {"by_bucket": {}})["by_bucket"]
        for b in due:
            held.pop(str(b), None)  # merged into what was written now, if anything is left
        if emptied := [int(b) for b in before if int(b) not in set(opened) and b not in held]:
            following["parts"].setdefault("emptied", {"by_version": {}})["by_version"][str(now)] = emptied
        for b in opened:
            held[str(b)] = [*held.get(str(b), []), [now, sizes[b]]]
        if closed := [b for part, b in written if part == "closed"]:
            following["parts"].setdefault("closed", {"by_version": {}})["by_version"][str(now)] = closed
        self.commit(following)
        return True

    def _open_rows(self, version: int, buckets: Sequence[int]) -> dict[int, int]:
        if not buckets:
            return {}
        paths = [f"{VERSION}={version}/{PART}=open/{BUCKET}={b}" for b in buckets]
        rows = self.read("rows", T.StructType([]), paths, f"{PART} string, {BUCKET} int")
        return {r[BUCKET]: r["count"] for r in rows.groupBy(BUCKET).count().collect()}

    def _differing(self, pointer: dict, snapshot: DataFrame) -> DataFrame:
        """The keys that are new, gone, or have another fingerprint, with their bucket."""
        keys = self.cdc.keys
        new = ops.checked(snapshot.select(*keys, F.col(PRINT).alias("__new"), F.col(BUCKET).alias("__b")), keys)
        old = self._open(pointer).select(*keys, F.col(PRINT).alias("__old"), BUCKET)
        both = old.join(new, list(keys), "full_outer").where(~F.col("__old").eqNullSafe(F.col("__new")))
        return materialise(both.select(*keys, F.coalesce(BUCKET, "__b").alias(BUCKET)), "snapshot-differing")

    def _changes(self, pointer, snapshot, plain, differing, version, touched, due) -> DataFrame:
        """The rows that the differing keys get, and what else is in the buckets that are due."""
        keys = self.cdc.keys
        chosen = differing.select(*keys)
        opened = self._open(pointer, touched)
        old = opened.join(chosen, list(keys), "left_semi").drop(BUCKET, PRINT)
        new = snapshot.join(chosen, list(keys), "left_semi").select(*plain)
        if self.cdc.scd_type == 1:
            rows = new
        else:
            rows = ops.step_scd2(old, new, version, self.cdc)
        # a key that is gone leaves a mark among the open rows
        gone = old.join(new.select(*keys), list(keys), "left_anti")
        if self.cdc.scd_type == 2:
            gone = gone.withColumn(END_AT, F.lit(None).cast(gone.schema[END_AT].dataType))
        rows = rows.withColumn(GONE, F.lit(False)).unionByName(gone.select(*rows.columns).withColumn(GONE, F.lit(True)))
        rows = rows.withColumn(PRINT, fingerprint(rows, plain)).withColumn(BUCKET, bucket_of(keys, self.buckets))
        if due:
            marks = F.col(GONE) & F.col(BUCKET).isin(due)
            resting = self._open(pointer, due).join(chosen, list(keys), "left_anti")
            rows = rows.where(~marks).unionByName(resting.withColumn(GONE, F.lit(False)))
        return rows

    def apply_all(self, snapshots: Iterable[tuple[object, DataFrame]]) -> None:
        for version, snapshot in snapshots:
            self.apply(version, snapshot)
