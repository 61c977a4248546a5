"""Flow specs kept in a table: one row per flow and version, the spec as JSON text."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from millrace.operators.tables import latest_per_key, require_unique, select_group, upsert
from millrace.operators.transforms import audit_columns
from millrace.specs import Flow

# Audit columns that keep their first value when a spec is replaced.
PROTECTED = ("createDate", "createdBy")


def spec_rows(
    spark: SparkSession, specs: Iterable[Mapping[str, Any]], version: str, author: str
) -> DataFrame:
    """Specs as rows with audit columns. Each is checked; an id that occurs twice is an error."""
    rows = []
    for spec in specs:
        flow = Flow.from_dict(spec)
        rows.append((flow.id, flow.group, flow.layer, json.dumps(dict(spec))))
    df = spark.createDataFrame(rows, "id string, `group` string, layer string, spec string")
    return audit_columns(require_unique(df, ["id"]), version, author)


def merge_specs(existing: DataFrame, new: DataFrame) -> DataFrame:
    """The spec table after new specs replaced those of the same id."""
    return upsert(existing, new, ["id"], PROTECTED)


def load_flows(
    specs: DataFrame,
    group: str | None = None,
    ids: Sequence[str] | None = None,
    layer: str | None = None,
    numeric_versions: bool = False,
) -> list[Flow]:
    """The latest version of the chosen specs; a group wins over ids."""
    chosen = specs.where(specs["layer"] == layer) if layer else specs
    chosen = select_group(chosen, "group", "id", group, ids)
    newest = latest_per_key(chosen, ["group", "id"], "version", numeric_versions)
    return [Flow.from_dict(json.loads(r["spec"])) for r in newest.select("spec").collect()]
