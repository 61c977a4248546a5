"""Versioned snapshots: numbered files or folders, or a user's callback."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.errors import AnalysisException

NextSnapshot = Callable[[object], "tuple[DataFrame, object] | None"]


def numbered_snapshots(
    spark: SparkSession,
    prefix: str,
    suffix: str = "",
    file_format: str = "csv",
    options: Mapping[str, str] | None = None,
    schema=None,
) -> NextSnapshot:
    """A callback giving ``<prefix><n+1><suffix>`` after version n, None where that is absent."""

    def following(latest):
        version = (latest or 0) + 1
        reader = spark.read.format(file_format).options(**(options or {}))
        reader = reader.schema(schema) if schema is not None else reader
        try:
            return reader.load(f"{prefix}{version}{suffix}"), version
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    return following


def snapshot_versions(following: NextSnapshot, latest=None) -> Iterator[tuple[object, DataFrame]]:
    """Ask for the next snapshot until there is none: (version, DataFrame), versions rising."""
    while (found := following(latest)) is not None:
        df, version = found
        if latest is not None and not version > latest:
            raise ValueError(f"snapshot version {version!r} does not follow {latest!r}")
        latest = version
        yield version, df
