"""Flows put together: read, shape, check, apply changes or append, feed sinks.

A flow runs until its input is used up and can be run again for what came since. The main target
is written first and quarantine and sinks after it, all from one read of the batch.
"""

from __future__ import annotations

import copy
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass, field, replace
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.schemas import resolve_schema
from millrace.operators import quality
from millrace.operators.transforms import apply_transform, select_exprs, where_all
from millrace.sources.files import file_scan
from millrace.sources.messages import Secrets, eventhub_options, kafka_options, message_scan
from millrace.sources.snapshots import snapshot_versions
from millrace.sources.tables import path_scan, table_name, table_scan
from millrace.specs import Flow, Source, SpecError, Target
from millrace.streaming.scd import Scd1Store, Scd2Store, open_store
from millrace.streaming.snapshots import SnapshotStore
from millrace.streaming.published import PublishedTable
from millrace.streaming.store import BUCKET, DEFAULT_BUCKETS, bucket_of
from millrace.streaming.targets import (
    AppendTable,
    batch_writer,
    deregister,
    overwrite_table,
    register_path,
    run_available,
    run_once,
    set_table_facts,
    write_sink,
)


@dataclass
class FlowRun:
    """What a run did: batches per source, and observed rule counts per batch."""

    flow: str
    batches: dict[str, int] = field(default_factory=dict)
    observed: list[dict] = field(default_factory=list)
    error: Exception | None = None

    def violations(self) -> dict[str, int]:
        totals: dict[str, int] = {}
        for counts in self.observed:
            for name, n in counts.items():
                totals[name] = totals.get(name, 0) + n
        return totals


class Runner:
    """Runs flows of one session. ``checkpoints`` is a folder of its own for stream progress."""

    def __init__(
        self,
        spark: SparkSession,
        checkpoints: str,
        flows: Iterable[Flow] = (),
        secrets: Secrets | None = None,
        buckets: int = DEFAULT_BUCKETS,
    ):
        self.spark = spark
        self.checkpoints = checkpoints.rstrip("/")
        self.flows: dict[str, Flow] = {}
        for flow in flows:
            if flow.id in self.flows:
                raise SpecError(f"two flows with the id {flow.id}")
            self.flows[flow.id] = flow
        self.secrets = secrets
        self.buckets = buckets

    # reading ------------------------------------------------------------------------------

    def read(self, source: Source, streaming: bool = True, progress: str | None = None) -> DataFrame:
        """A source's rows. An inferred schema is kept beside the progress, so that all runs read the same."""
        details, options = source.details, dict(source.options)
        kind = source.format
        if kind in ("files", "cloudFiles"):
            return file_scan(
                self.spark, details["path"], options, source.schema, streaming,
                details.get("format"), source.metadata, progress and f"{progress}-schema",
            )
        if "flow" in details:
            upstream = self.flows[details["flow"]]
            if kind == "snapshot" or not streaming:
                return self.table(upstream)
            if upstream.cdc or upstream.snapshot:
                raise SpecError(f"{upstream.id} rewrites rows; read it whole, as a snapshot source")
            return self.append_table(upstream).stream(options, progress)
        if kind in ("table", "delta", "snapshot", "path"):
            streaming = streaming and kind != "snapshot"
            if details.get("path"):
                schema = resolve_schema(self.spark, source.schema, details["path"])
                return path_scan(self.spark, details["path"], options, schema, streaming)
            name = table_name(details.get("catalog"), details.get("database"), details["table"])
            return table_scan(self.spark, name, options, streaming)
        if kind in ("kafka", "eventhub"):
            build = kafka_options if kind == "kafka" else eventhub_options
            schema = resolve_schema(self.spark, source.schema)
            return message_scan(self.spark, build(details, options, self.secrets), schema, streaming)
        raise SpecError(f"source format {kind!r} is not supported")

    def shape(self, df: DataFrame, flow: Flow) -> DataFrame:
        """Select, then where, then the flow's own transform."""
        return apply_transform(where_all(select_exprs(df, flow.select_exp), flow.where), flow.transform, flow)

    def input(self, flow: Flow, streaming: bool = True) -> DataFrame:
        """The flow's input view."""
        progress = None if flow.snapshot else self._checkpoint(flow)
        return self.shape(self.read(flow.source, streaming, progress), flow)

    # targets ------------------------------------------------------------------------------

    def _target(self, flow: Flow) -> Target:
        """The flow's target; a named one that has no comment says its layer."""
        target = flow.target
        if not target.name or target.comment:
            return target
        return replace(target, comment=f"{flow.layer} table {target.name}")

    def append_table(self, flow: Flow) -> AppendTable:
        return AppendTable(self.spark, self._target(flow))

    def table(self, flow: Flow | str) -> DataFrame:
        """The flow's target as it is now."""
        flow = self.flows[flow] if isinstance(flow, str) else flow
        if flow.snapshot or flow.cdc:
            return self._store(flow).table()
        return self.append_table(flow).table()

    def _store(self, flow: Flow) -> Scd1Store | Scd2Store | SnapshotStore:
        """The store of a keyed flow."""
        if flow.snapshot:
            return SnapshotStore(self.spark, flow.target.path, flow.snapshot, self.buckets)
        return open_store(self.spark, flow.target.path, flow.cdc, self.input(flow).schema, self.buckets)

    def publish(self, flow: Flow | str, target: Target) -> None:
        """Write the flow's table as it is now to a plain parquet folder in the target's layout,
        and name it if the target has a name."""
        overwrite_table(self.table(flow), target)
        if target.name:
            # named anew, as partitions of the former content may be gone
            deregister(self.spark, target.name)
            register_path(self.spark, target.name, target.path)
            set_table_facts(self.spark, target.name, target.properties, target.comment)
            if target.partition_by:
                self.spark.catalog.recoverPartitions(target.name)

    def quarantine_table(self, flow: Flow | str) -> DataFrame:
        flow = self.flows[flow] if isinstance(flow, str) else flow
        return AppendTable(self.spark, flow.quarantine).table()

    # running ------------------------------------------------------------------------------

    def _checkpoint(self, flow: Flow, source: str = "main") -> str:
        return f"{self.checkpoints}/{flow.id}/{source}"

    def _write(self, flow: Flow, run: FlowRun, rows: DataFrame, batch_id, put) -> None:
        """One batch: the main target by ``put``, then quarantine and sinks."""
        rules = flow.rules
        many = bool(flow.sinks) or bool(rules and rules.quarantine and flow.quarantine)
        held = rows.persist() if many else rows
        try:
            if rules:
                watch = Observation() if rules.warn else None
                written = put(quality.apply_rules(held, rules, watch), batch_id)
                # a batch that was committed before is skipped and observes nothing
                if watch is not None and written:
                    run.observed.append(dict(watch.get))
            else:
                put(held, batch_id)
            if rules and rules.quarantine and flow.quarantine:
                bad = quality.quarantine_rows(held, rules)
                AppendTable(self.spark, flow.quarantine).write_batch(bad, batch_id, flow.id)
            for sink in flow.sinks:
                write_sink(held, sink, batch_id, self.secrets)
        finally:
            if many:
                held.unpersist()

    def run(self, flow: Flow | str) -> FlowRun:
        flow = self.flows[flow] if isinstance(flow, str) else flow
        run = FlowRun(flow.id)
        if flow.snapshot:
            self._run_snapshots(flow, run)
        else:
            self._run_stream(flow, run)
        self._run_append_flows(flow, run)
        if not flow.cdc and not flow.snapshot and any(run.batches.values()):
            self.append_table(flow).compact()
        if not flow.target.name:
            return run
        if flow.cdc or flow.snapshot:
            if any(run.batches.values()):
                self._publish_named(flow)
        elif (table := self.append_table(flow)).exists():
            table.register()
        return run

    def _publish_named(self, flow: Flow) -> list[int]:
        """Bring the named table of a CDC or snapshot flow, in the target's layout, to what the store holds: only the buckets that
        changed are written. Gives them."""
        store = self._store(flow)
        keys = (flow.cdc or flow.snapshot).keys

        def rows(buckets):
            return store.table(buckets).withColumn(BUCKET, bucket_of(keys, self.buckets))

        root = f"{flow.target.path.rstrip('/')}-named"
        return PublishedTable(self.spark, root, self._target(flow), rows).publish(store.pointer()["version"], store.touched_since)

    def _handler(self, flow: Flow, run: FlowRun):
        """``handle(batch, batch_id)`` for the flow's main source."""
        if flow.cdc:
            store = self._store(flow)

            def put(rows, batch_id):
                return store.apply(rows, batch_id, flow.cdc.flow_name or flow.id)
        else:
            table = self.append_table(flow)

            def put(rows, batch_id):
                return table.write_batch(rows, batch_id, "main")

        def handle(batch, batch_id):
            self._write(flow, run, batch, batch_id, put)

        return handle

    def _run_stream(self, flow: Flow, run: FlowRun) -> None:
        handle = self._handler(flow, run)
        checkpoint = self._checkpoint(flow)
        if flow.cdc and flow.cdc.once:
            run.batches["main"] = run_once(self.spark, lambda: self.input(flow), handle, checkpoint)
        else:
            run.batches["main"] = run_available(self.input(flow), handle, checkpoint)

    def start(self, flow: Flow | str, interval: str = "1 minute") -> StreamingQuery:
        """Keep the flow's main source running, a batch per interval, with the progress that
        ``run`` uses too; stop it before the next ``run``. For feeds and append flows, not for
        snapshots or one-off flows.
        """
        flow = self.flows[flow] if isinstance(flow, str) else flow
        if flow.snapshot or (flow.cdc and flow.cdc.once):
            raise SpecError(f"Flow {flow.id} reads whole snapshots or runs once; use run")
        handle = self._handler(flow, FlowRun(flow.id))
        writer = batch_writer(self.input(flow), handle, self._checkpoint(flow), flow.id)
        return writer.trigger(processingTime=interval).start()

    def _run_snapshots(self, flow: Flow, run: FlowRun) -> None:
        """Snapshots from the callback if there is one, else the source's content now."""
        store = self._store(flow)
        latest = store.latest()
        if flow.next_snapshot:
            series = snapshot_versions(flow.next_snapshot, latest)
            series = ((v, self.shape(df, flow)) for v, df in series)
        else:
            series = [((latest or 0) + 1, self.input(flow, streaming=False))]
        count = 0
        for version, snapshot in series:
            self._write(flow, run, snapshot, version, lambda rows, v: store.apply(v, rows))
            count += 1
        run.batches["snapshots"] = count

    def _run_append_flows(self, flow: Flow, run: FlowRun) -> None:
        """Further sources appending to the flow's target, each with its own progress. A keyed target takes their rows as they
        are, beside those it merges."""
        if not flow.append_flows:
            return
        keyed = bool(flow.cdc or flow.snapshot)
        if keyed:
            store, schema = self._store(flow), self.table(flow).schema
            keys = (flow.cdc or flow.snapshot).keys
        else:
            table = self.append_table(flow)
        for extra in flow.append_flows:
            if extra.create_target and not keyed and not table.exists():
                table.create(resolve_schema(self.spark, flow.target.schema))
            reader = self._with_conf(extra.conf)

            def handle(batch, batch_id, name=extra.name):
                if keyed:
                    store.append(batch, batch_id, name, keys, schema)
                else:
                    table.write_batch(batch, batch_id, name)

            checkpoint = self._checkpoint(flow, extra.name)

            def stream(source=extra.source, reader=reader, checkpoint=checkpoint):
                return reader.read(source, progress=checkpoint)

            if extra.once:
                count = run_once(self.spark, stream, handle, checkpoint)
            else:
                count = run_available(stream(), handle, checkpoint)
            run.batches[extra.name] = count

    def _with_conf(self, conf: Mapping[str, str]) -> Runner:
        """This runner with a session of its own that has some settings more; other flows do not see them."""
        if not conf:
            return self
        session = self.spark.newSession()
        for key, value in self.spark.conf.getAll.items():
            if self.spark.conf.isModifiable(key):
                session.conf.set(key, value)
        for key, value in conf.items():
            session.conf.set(key, value)
        other = copy.copy(self)
        other.spark = session
        return other

    # groups -------------------------------------------------------------------------------

    def _upstream(self, flow: Flow) -> set[str]:
        needs = set(flow.depends_on)
        for source in [flow.source, *[extra.source for extra in flow.append_flows]]:
            if "flow" in source.details:
                needs.add(source.details["flow"])
        return needs

    def run_group(
        self, group: str | None = None, ids: Sequence[str] | None = None, workers: int = 8
    ) -> Mapping[str, FlowRun]:
        """All flows of a group (or with the ids, or all): flows that do not depend on each other
        run at the same time. A failed flow holds back only those that read from it; its error
        is in its run.
        """
        chosen = {
            f.id: f
            for f in self.flows.values()
            if (f.group == group if group is not None else not ids or f.id in ids)
        }
        order = TopologicalSorter({i: self._upstream(f) & set(chosen) for i, f in chosen.items()})
        # one writer per table: flows into one path take turns, those that others wait for first
        writers: dict[str, str] = {}
        for flow_id in TopologicalSorter({i: self._upstream(f) & set(chosen) for i, f in chosen.items()}).static_order():
            path = chosen[flow_id].target.path.rstrip("/")
            if path in writers:
                order.add(flow_id, writers[path])
            writers[path] = flow_id
        order.prepare()
        runs: dict[str, FlowRun] = {}

        def attempt(flow_id: str) -> FlowRun:
            self.spark.sparkContext.setLocalProperty("spark.scheduler.pool", flow_id)
            failed = [u for u in self._upstream(chosen[flow_id]) if u in runs and runs[u].error]
            if failed:
                return FlowRun(flow_id, error=RuntimeError(f"not run: {failed} failed"))
            try:
                return self.run(chosen[flow_id])
            except Exception as error:  # noqa: BLE001 - reported in the run
                return FlowRun(flow_id, error=error)

        with ThreadPoolExecutor(max_workers=workers) as pool:
            running = set()
            while order.is_active():
                running |= {pool.submit(attempt, flow_id) for flow_id in order.get_ready()}
                finished, running = wait(running, return_when=FIRST_COMPLETED)
                for run in (f.result() for f in finished):
                    runs[run.flow] = run
                    order.done(run.flow)
        return runs
