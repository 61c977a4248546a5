"""Specs: what a flow reads, how it is shaped and checked, and where it lands.

Specs are plain driver-side dataclasses. They describe DataFrames and hold no data.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import MISSING, dataclass, field, fields
from typing import Any


class SpecError(ValueError):
    """A spec is incomplete or contradicts itself."""


def _from_mapping(cls, values: Mapping[str, Any]):
    """Build a spec from a mapping; unknown or missing entries are errors, None means default."""
    known = {f.name: f for f in fields(cls)}
    unknown = sorted(set(values) - set(known))
    if unknown:
        raise SpecError(f"{cls.__name__}: unknown entries {unknown}")
    given = {k: v for k, v in values.items() if v is not None}
    missing = sorted(
        name
        for name, f in known.items()
        if f.default is MISSING and f.default_factory is MISSING and name not in given
    )
    if missing:
        raise SpecError(f"{cls.__name__}: missing entries {missing}")
    return cls(**given)


def clean_columns(columns: str | Sequence[str] | None) -> list[str]:
    """Column lists arrive as lists or comma strings, with blanks; give a clean list."""
    if not columns:
        return []
    parts = columns.split(",") if isinstance(columns, str) else columns
    return [p.strip() for p in parts if p and p.strip()]


def _scd_type(value: Any) -> int:
    text = str(value)
    if text not in ("1", "2"):
        raise SpecError(f"scd_type must be 1 or 2, not {value!r}")
    return int(text)


def _at_most_one(owner: str, **options: Any) -> None:
    given = [name for name, value in options.items() if value]
    if len(given) > 1:
        raise SpecError(f"{owner}: give only one of {given}")


def _known(owner: str, wanted, columns: Sequence[str]) -> set[str]:
    """The names of a list as a set; a name that is no column is an error, not an empty wish."""
    names = set(clean_columns(wanted))
    unknown = sorted(names - set(columns))
    if unknown:
        raise SpecError(f"{owner}: columns {unknown} are not in {sorted(columns)}")
    return names


@dataclass
class Cdc:
    """Change feed settings: how rows of a feed become an SCD table.

    ``sequence_by`` is a SQL expression, or several column names (list or comma string) that
    order lexicographically. A string date orders as text; wrap it in ``to_timestamp(...)``
    to order by time.
    """

    keys: Sequence[str]
    sequence_by: str | Sequence[str]
    scd_type: int | str = 1
    where: str | None = None
    apply_as_deletes: str | None = None
    apply_as_truncates: str | None = None
    column_list: Sequence[str] | None = None
    except_column_list: Sequence[str] | None = None
    track_history_column_list: Sequence[str] | None = None
    track_history_except_column_list: Sequence[str] | None = None
    ignore_null_updates: bool = False
    ignore_null_updates_column_list: Sequence[str] | None = None
    ignore_null_updates_except_column_list: Sequence[str] | None = None
    flow_name: str | None = None
    once: bool = False

    def __post_init__(self):
        self.keys = clean_columns(self.keys)
        self.scd_type = _scd_type(self.scd_type)
        if not self.keys:
            raise SpecError("Cdc: keys must not be empty")
        if not self.sequence_by:
            raise SpecError("Cdc: sequence_by must not be empty")
        _at_most_one("Cdc", column_list=self.column_list, except_column_list=self.except_column_list)
        _at_most_one(
            "Cdc",
            track_history_column_list=self.track_history_column_list,
            track_history_except_column_list=self.track_history_except_column_list,
        )
        _at_most_one(
            "Cdc",
            ignore_null_updates_column_list=self.ignore_null_updates_column_list,
            ignore_null_updates_except_column_list=self.ignore_null_updates_except_column_list,
        )
        if self.scd_type == 2 and self.apply_as_truncates:
            raise SpecError("Cdc: apply_as_truncates needs scd_type 1")
        if self.scd_type == 1 and (
            self.track_history_column_list or self.track_history_except_column_list
        ):
            raise SpecError("Cdc: track_history lists need scd_type 2")

    @classmethod
    def from_dict(cls, values: Mapping[str, Any]) -> Cdc:
        return _from_mapping(cls, values)

    def ignores_nulls(self) -> bool:
        return bool(
            self.ignore_null_updates
            or self.ignore_null_updates_column_list
            or self.ignore_null_updates_except_column_list
        )

    def target_columns(self, columns: Sequence[str]) -> list[str]:
        """Feed columns that reach the target, in feed order."""
        if self.column_list:
            keep = _known("Cdc", self.column_list, columns) | set(self.keys)
            return [c for c in columns if c in keep]
        drop = _known("Cdc", self.except_column_list, columns) - set(self.keys)
        return [c for c in columns if c not in drop]

    def sequence_columns(self, columns: Sequence[str]) -> list[str]:
        """The sequence columns when ``sequence_by`` names columns, else an empty list."""
        names = clean_columns(self.sequence_by)
        return names if names and set(names) <= set(columns) else []

    def tracked_columns(self, columns: Sequence[str]) -> list[str]:
        """Target columns whose change opens a version.

        By default all but the keys and the sequence columns: a repeated row that differs only
        in its sequence is no new version.
        """
        target = self.target_columns(columns)
        if self.track_history_column_list:
            wanted = set(clean_columns(self.track_history_column_list))
            unknown = wanted - set(target)
            if unknown:
                raise SpecError(f"Cdc: tracked columns {sorted(unknown)} are not in the target")
            return [c for c in target if c in wanted and c not in self.keys]
        skip = set(self.keys) | set(self.sequence_columns(columns))
        skip |= _known("Cdc", self.track_history_except_column_list, columns)
        return [c for c in target if c not in skip]

    def null_ignoring_columns(self, columns: Sequence[str]) -> list[str]:
        """Target columns in which a NULL update keeps the older value."""
        others = [c for c in self.target_columns(columns) if c not in self.keys]
        if self.ignore_null_updates_column_list:
            wanted = _known("Cdc", self.ignore_null_updates_column_list, columns)
            return [c for c in others if c in wanted]
        if self.ignore_null_updates_except_column_list:
            skip = _known("Cdc", self.ignore_null_updates_except_column_list, columns)
            return [c for c in others if c not in skip]
        return others if self.ignore_null_updates else []


@dataclass
class SnapshotCdc:
    """Settings for keeping an SCD table from a series of full snapshots."""

    keys: Sequence[str]
    scd_type: int | str = 1
    track_history_column_list: Sequence[str] | None = None
    track_history_except_column_list: Sequence[str] | None = None

    def __post_init__(self):
        self.keys = clean_columns(self.keys)
        self.scd_type = _scd_type(self.scd_type)
        if not self.keys:
            raise SpecError("SnapshotCdc: keys must not be empty")
        _at_most_one(
            "SnapshotCdc",
            track_history_column_list=self.track_history_column_list,
            track_history_except_column_list=self.track_history_except_column_list,
        )

    @classmethod
    def from_dict(cls, values: Mapping[str, Any]) -> SnapshotCdc:
        return _from_mapping(cls, values)

    def tracked_columns(self, columns: Sequence[str]) -> list[str]:
        others = [c for c in columns if c not in self.keys]
        if self.track_history_column_list:
            wanted = _known("SnapshotCdc", self.track_history_column_list, columns)
            return [c for c in others if c in wanted]
        skip = _known("SnapshotCdc", self.track_history_except_column_list, columns)
        return [c for c in others if c not in skip]


# The level names of a rules file.
WARN_LEVELS = ("expect", "expect_all")
DROP_LEVELS = ("expect_or_drop", "expect_all_or_drop")
FAIL_LEVELS = ("expect_or_fail", "expect_all_or_fail")
QUARANTINE_LEVELS = ("expect_or_quarantine",)


@dataclass
class Rules:
    """Named SQL booleans per level. ``split`` moves failing rows out of the main table."""

    warn: dict[str, str] = field(default_factory=dict)
    drop: dict[str, str] = field(default_factory=dict)
    fail: dict[str, str] = field(default_factory=dict)
    quarantine: dict[str, str] = field(default_factory=dict)
    split: bool = False

    @classmethod
    def from_levels(cls, levels: Mapping[str, Mapping[str, str]], split: bool = False) -> Rules:
        """From a level map. The short level name replaces the ``_all`` one when both occur."""
        known = (*WARN_LEVELS, *DROP_LEVELS, *FAIL_LEVELS, *QUARANTINE_LEVELS)
        unknown = sorted(set(levels) - set(known))
        if unknown:
            raise SpecError(f"Rules: unknown levels {unknown}")

        def pick(names):
            return dict(next((levels[n] for n in names if n in levels), {}))

        return cls(
            warn=pick(WARN_LEVELS),
            drop=pick(DROP_LEVELS),
            fail=pick(FAIL_LEVELS),
            quarantine=pick(QUARANTINE_LEVELS),
            split=split,
        )

    @classmethod
    def from_json(cls, text: str, split: bool = False) -> Rules:
        return cls.from_levels(json.loads(text), split=split)

    def by_level(self) -> list[tuple[str, str, str]]:
        """(level, rule name, SQL) in the order warn, fail, drop, quarantine."""
        return [
            (level, name, sql)
            for level, rules in (
                ("warn", self.warn),
                ("fail", self.fail),
                ("drop", self.drop),
                ("quarantine", self.quarantine),
            )
            for name, sql in rules.items()
        ]


@dataclass
class Source:
    """Where rows come from.

    ``format`` is ``files``, ``table``, ``path`` (a table by its folder), ``flow`` (what another
    flow appends), ``kafka``, ``eventhub`` or ``snapshot`` (a table, folder or flow read whole).
    ``details`` holds what that format needs.
    """

    format: str
    details: dict[str, Any] = field(default_factory=dict)
    options: dict[str, str] = field(default_factory=dict)
    schema: Any = None
    metadata: dict[str, Any] | None = None

    @classmethod
    def from_dict(cls, values: Mapping[str, Any]) -> Source:
        return _from_mapping(cls, values)


@dataclass
class Target:
    """A table kept in a folder, optionally registered under a name."""

    path: str
    name: str | None = None
    schema: Any = None
    partition_by: Sequence[str] | None = None
    cluster_by: Sequence[str] | None = None
    zorder_by: Sequence[str] | None = None
    properties: dict[str, str] = field(default_factory=dict)
    comment: str | None = None

    def __post_init__(self):
        self.partition_by = clean_columns(self.partition_by)
        if self.cluster_by and self.zorder_by:
            raise SpecError("Target: cluster_by and zorder_by exclude each other")
        self.cluster_by = check_cluster_columns(self.cluster_by)
        self.zorder_by = clean_columns(self.zorder_by)

    @classmethod
    def from_dict(cls, values: Mapping[str, Any]) -> Target:
        return _from_mapping(cls, values)


def check_cluster_columns(columns: str | Sequence[str] | None) -> list[str]:
    """Cluster columns as a list, or as text of a list such as ``["id", "email"]``."""
    if not columns:
        return []
    if isinstance(columns, str):
        text = columns.strip()
        if not (text.startswith("[") and text.endswith("]")):
            raise SpecError(f"cluster columns must be a list or text of a list, not {columns!r}")
        try:
            columns = json.loads(text.replace("'", '"'))
        except json.JSONDecodeError as error:
            raise SpecError(f"cluster columns cannot be read from {text!r}") from error
    for column in columns:
        if not isinstance(column, str):
            raise SpecError(f"cluster column {column!r} is not text")
        if not column.strip() or column != column.strip():
            raise SpecError(f"cluster column {column!r} has stray blanks")
        if column.count('"') % 2 or column.count("'") % 2:
            raise SpecError(f"cluster column {column!r} has an unbalanced quote")
    return list(columns)


@dataclass
class AppendFlow:
    """A further source that appends to the target of a flow."""

    name: str
    source: Source
    create_target: bool = False
    comment: str | None = None
    conf: dict[str, str] = field(default_factory=dict)
    once: bool = False

    @classmethod
    def from_dict(cls, values: Mapping[str, Any]) -> AppendFlow:
        return _from_mapping(cls, values)


# The sink formats a spec may name.
SINK_FORMATS = ("delta", "parquet", "kafka", "eventhub")


@dataclass
class Sink:
    """An external target fed from the input view, with its own projection and filter."""

    name: str
    format: str
    options: dict[str, str]
    select_exp: Sequence[str] | None = None
    where_clause: str | None = None

    def __post_init__(self):
        self.name = self.name.lower()
        self.format = self.format.lower()
        if self.format not in SINK_FORMATS:
            raise SpecError(f"Sink {self.name}: format {self.format!r} is not one of {SINK_FORMATS}")
        self.options = {k: v for k, v in dict(self.options).items() if v is not None}
        if self.format in ("delta", "parquet") and not (self.table_name() or self.option("path")):
            raise SpecError(f"Sink {self.name}: a table sink needs path or tablename")

    @classmethod
    def from_dict(cls, values: Mapping[str, Any]) -> Sink:
        return _from_mapping(cls, values)

    def option(self, key: str) -> str | None:
        """An option by name, whatever its case."""
        return next((v for k, v in self.options.items() if k.lower() == key.lower()), None)

    def table_name(self) -> str | None:
        return self.option("tablename")


@dataclass
class Flow:
    """One flow: source -> select -> where -> transform -> (snapshot | rules | CDC | append)."""

    id: str
    source: Source
    target: Target
    group: str = "default"
    layer: str = "bronze"
    select_exp: Sequence[str] | None = None
    where: Sequence[str] | None = None
    transform: Callable | None = None
    rules: Rules | None = None
    quarantine: Target | None = None
    cdc: Cdc | None = None
    snapshot: SnapshotCdc | None = None
    next_snapshot: Callable | None = None
    append_flows: Sequence[AppendFlow] = ()
    sinks: Sequence[Sink] = ()
    depends_on: Sequence[str] = ()

    def __post_init__(self):
        if self.layer not in ("bronze", "silver"):
            raise SpecError(f"Flow {self.id}: layer {self.layer!r} is not bronze or silver")
        if self.cdc and self.snapshot:
            raise SpecError(f"Flow {self.id}: cdc and snapshot exclude each other")

    @classmethod
    def from_dict(cls, values: Mapping[str, Any]) -> Flow:
        """A flow from nested mappings, such as a parsed JSON spec. ``rules`` is a level map, or
        the JSON text of one."""
        parts = {k: v for k, v in values.items() if v is not None}
        single = {"source": Source, "target": Target, "quarantine": Target, "cdc": Cdc, "snapshot": SnapshotCdc}
        for name, kind in single.items():
            if isinstance(parts.get(name), Mapping):
                parts[name] = kind.from_dict(parts[name])
        if "append_flows" in parts:
            parts["append_flows"] = [
                AppendFlow.from_dict({**flow, "source": Source.from_dict(flow["source"])})
                for flow in parts["append_flows"]
            ]
        if "sinks" in parts:
            parts["sinks"] = [Sink.from_dict(sink) for sink in parts["sinks"]]
        rules = parts.get("rules")
        if isinstance(rules, str):
            parts["rules"] = Rules.from_json(rules)
        elif isinstance(rules, Mapping):
            parts["rules"] = Rules.from_levels(rules)
        return _from_mapping(cls, parts)

    def view_name(self) -> str:
        """The name of the flow's input view: target name and layer, dots out, lower case."""
        name = (self.target.name or self.target.path.rstrip("/").rsplit("/", 1)[-1]).replace(".", "_")
        return f"{name}_{self.layer}_inputview".lower()
