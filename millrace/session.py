"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def build_session(app: str = "millrace", **conf: str) -> SparkSession:
    """A session with adaptive execution on; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.scheduler.mode", "FAIR")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Where it is not set, a master that runs all on this machine gets a folder here; any other is refused, as
    executors elsewhere would not see it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="millrace-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


#: Folders of the ``scratch`` blocks that are open in this process, the innermost last.
_open_scratch: list[str] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A folder for all scratch tables that are written within the block, deleted at its end, also where the block fails.

    What the library returns may still read its scratch tables, so write results to a place of your own within the block. The
    block holds for the whole process, threads and callbacks of streams included: open one at a time, or one within another.
    """
    folder = f"{shared_folder(spark)}/millrace/run-{uuid.uuid4().hex}"
    _open_scratch.append(folder)
    try:
        yield folder
    finally:
        _open_scratch.remove(folder)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, or that of the open ``scratch`` block; nothing is created yet."""
    base = _open_scratch[-1] if _open_scratch else f"{shared_folder(spark)}/millrace"
    return f"{base}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back.

    Cuts the lineage and survives the loss of executors; one job, unlike an eager checkpoint.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, known to the planner to be none: joins with it cost nothing."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def write_text(spark: SparkSession, text: str, path: str, mode: str = "overwrite") -> None:
    """One line of text as a folder with one file."""
    spark.range(1).coalesce(1).select(F.lit(text).alias("value")).write.mode(mode).text(path)
