"""The life of a load: find the mark, extract, clean, align, apply, report."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from typing import Any, Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.clean import clean, quoted
from tidemark.functions.transforms import field_transforms
from tidemark.operators import hwm
from tidemark.operators.align import FAULTS, align, align_marked, good_rows, rejected
from tidemark.operators.chunks import chunk_bounds, chunks, sketch, sketched_bounds
from tidemark.sinks.store import Applied, TableStore, target_name
from tidemark.sources.connections import Connection, find_connection
from tidemark.sources.extract import extract, incr_type
from tidemark.sources.jdbc import guid_columns
from tidemark.spec import INCREMENTAL_MODES, Source, SpecError, Target, Task

log = logging.getLogger(__name__)

Hook = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class RunRecord:
    """One line of the run log."""

    task: str
    source: str
    target: str
    mode: str
    status: str
    rows_read: int
    rows_deleted: int
    rows_written: int
    seconds: float
    error: str = ""


class Sink(Protocol):
    """A target table: the parquet table store, or a database table."""

    @property
    def staging(self) -> TableStore: ...
    def shape(self) -> tuple[T.StructType, dict[str, Any]]: ...
    def stored_point(self, key: dict[str, str]) -> str | None: ...
    def reached(self, column: str) -> str | None: ...
    def load(self, source: DataFrame, mode: str, **options: Any) -> Applied: ...


def start_point(spark: SparkSession, sink: Sink, source: Source, key: dict[str, str], dtype: T.DataType) -> str | None:
    """Where an incremental run starts, as text: the larger of configured and stored mark, else the target's maximum.

    None on a first load into an empty table, which reads everything.
    """
    given, stored = source.incr_point.strip(), sink.stored_point(key)
    reached = None if given or stored else sink.reached(source.target_incr_field)  # a scan, so only where it decides
    names = ", ".join(f"{k} string" for k in hwm.KEY)
    own = tuple(key[k] for k in hwm.KEY)
    loads = spark.createDataFrame([(*own, given, source.incr_field)], f"{names}, incr_point string, src_incr_field string")
    control = spark.createDataFrame([(*own, stored)] if stored else [], f"{names}, incr_point string")
    target = spark.createDataFrame([(key["dst_schema_name"], key["dst_table_name"], reached)], "dst_schema_name string, dst_table_name string, target_point string")
    target = target.withColumn("target_point", F.col("target_point").cast(dtype))
    found = hwm.lookup(loads, control, target, dtype).select(hwm.point_text(F.col("point"), dtype).alias("point"), "origin").first()
    return None if found.origin == "default" else found.point


def _extract(
    spark: SparkSession,
    connections: Sequence[Connection],
    source: Source,
    mode: str,
    point: str | None,
    hook: Hook | None,
) -> DataFrame:
    """The extract with its values cleaned and the task's own transforms applied."""
    rows = extract(spark, find_connection(connections, source.connection), source, mode, point)
    rows = clean(guid_columns(rows, source.guids))
    rows = field_transforms(rows, source.transforms)
    return rows.transform(hook) if hook else rows


def load_source(
    spark: SparkSession,
    task: Task,
    source: Source,
    connections: Sequence[Connection],
    sink: Sink,
    hook: Hook | None = None,
    done: Callable[[Applied], None] = lambda applied: None,
) -> list[Applied]:
    """Apply one source of a task to its target: one commit, or one per chunk; ``done`` hears of each as it is made."""
    target, connection = task.target, find_connection(connections, source.connection)
    mode, point, options = target.mode, None, {"zone": target.timezone}
    if mode in INCREMENTAL_MODES and source.incr_field:
        key = hwm.identity(task.name, connection.database or connection.name, source, target)
        point = start_point(spark, sink, source, key, incr_type(spark, connection, source, source.incr_point or None))
        facts = {"sync_mode": mode, "src_incr_field": source.incr_field, "dst_pk": target.pk}
        options |= {"incr": source.target_incr_field, "key": key, "facts": facts}
        log.info("%s: %s from %s", target.table, source.incr_field, point)
    if mode == "merge":
        options |= {"pk": target.keys, "dedupe": target.dedupe_source}
    rows = _extract(spark, connections, source, mode, point, hook)
    if mode in INCREMENTAL_MODES and target.commit_batch_size > 0:
        return _load_chunks(sink, rows, source, target, options | {"after_chunk": done})
    applied = sink.load(rows, mode, **options)
    done(applied)
    return [applied]


def _load_chunks(sink: Sink, rows: DataFrame, source: Source, target: Target, options: dict[str, Any]) -> list[Applied]:
    return load_in_chunks(sink, rows, target.mode, source.batch_size * target.commit_batch_size, **options)


def load_in_chunks(sink: Sink, rows: DataFrame, mode: str, rows_per_chunk: int, *, incr: str, zone: str = "", **options: Any) -> list[Applied]:
    """One commit per chunk of about so many rows. The source is read once: its rows are kept while chunks are loaded.

    Bounds come from a sketch measured on that one write, so rows that change at the source meanwhile are neither missed
    nor doubled. Kept files are sorted by the incremental field, so a chunk reads few row groups of each; no shuffle is
    needed, and a value that many rows share fills no task.
    """
    schema, defaults = sink.shape()
    given = {c.lower() for c in rows.columns}
    wanted = T.StructType([f for f in schema.fields if f.name.lower() in given])
    # Columns that only the target has get their defaults when a chunk is loaded.
    aligned = align(rows, wanted, {}, zone) if len(wanted) == len(given) else align(rows, schema, defaults, zone)
    incr = target_name(aligned.schema, incr)
    staging, dtype = sink.staging, aligned.schema[incr].dataType
    with staging.lease():
        kept = staging.stage(aligned.sortWithinPartitions(quoted(incr)), also=sketch(F.col(quoted(incr)), dtype))
        rows = staging.read_part(kept.part, aligned.schema)
        bounds = sketched_bounds(kept.also, kept.part.rows, rows_per_chunk)
        if bounds is None:
            bounds = chunk_bounds(rows, incr, kept.part.rows, rows_per_chunk)
        done = load_chunks(sink, rows, mode, bounds, incr=incr, **options)
        staging.discard(kept.part)
    return done


def load_with_rejects(
    sink: TableStore, rows: DataFrame, mode: str, rejects: TableStore, max_share: float, *, zone: str = "", **options: Any
) -> Applied:
    """Load the rows whose values the target can hold, and keep the bad values of the others in ``rejects``.

    The source is read once, into a staged copy on which good and bad rows are counted. With a larger share of bad rows
    than ``max_share`` nothing is loaded and SpecError names the share. Rejects are committed before the rows, so no row is
    lost silently; a load that dies in between leaves rejects that the next run writes again.
    """
    schema, defaults = sink.shape()
    marked = align_marked(rows, schema, defaults, zone)
    with sink.lease():
        kept = sink.stage(marked, also={"bad": F.count_if(F.size(FAULTS) > 0)})
        bad = kept.also["bad"]
        if bad > max_share * kept.part.rows:
            sink.discard(kept.part)
            raise SpecError(f"{bad} of {kept.part.rows} rows hold bad values, more than a share of {max_share}")
        staged = sink.read_part(kept.part, marked.schema)
        if bad:
            rejects.load(rejected(staged), "append")
        done = sink.load(good_rows(staged), mode, **options)
        sink.discard(kept.part)
    return replace(done, read=kept.part.rows)


def load_chunks(
    sink: Sink,
    rows: DataFrame,
    mode: str,
    bounds: Sequence[str],
    *,
    incr: str,
    after_chunk: Callable[[Applied], None] | None = None,
    **options: Any,
) -> list[Applied]:
    """One commit per value range of ``incr``, ascending. Committed chunks stay when a later one fails."""
    done = []
    for chunk in chunks(rows, target_name(rows.schema, incr), bounds):
        done.append(sink.load(chunk, mode, incr=incr, **options))
        if after_chunk:
            after_chunk(done[-1])
    return done


def run_task(
    spark: SparkSession,
    task: Task,
    connections: Sequence[Connection],
    sink: Sink,
    hook: Hook | None = None,
) -> list[RunRecord]:
    """Run every source of a task into its target.

    ``full`` replaces the target once, with the union of all sources. Elsewhere sources run in order;
    ``continue`` records a failed one and goes on, ``abort`` raises; the error then carries the records so far, its own
    among them, as ``run_records``. A failed source counts what it had committed.
    """
    task.validate()
    records: list[RunRecord] = []

    def attempt(name: str, run: Callable[[Callable[[Applied], None]], object]) -> None:
        began, done, failure = time.monotonic(), [], None
        try:
            run(done.append)
        except Exception as e:
            log.warning("%s -> %s failed: %s", name, task.target.table, e)
            failure = e
        written, deleted = sum(a.inserted for a in done), sum(a.deleted for a in done)
        records.append(
            RunRecord(
                task=task.name,
                source=name,
                target=task.target.table,
                mode=task.target.mode,
                status="failed" if failure else "success",
                rows_read=sum(a.inserted if a.read is None else a.read for a in done),
                rows_deleted=deleted,
                rows_written=written,
                seconds=round(time.monotonic() - began, 3),
                error=f"{type(failure).__name__}: {failure}" if failure else "",
            )
        )
        if failure and task.error_policy == "abort":
            failure.run_records = records
            raise failure

    names = [s.table.strip() or "query" for s in task.sources]
    if task.target.mode == "full":
        def replace_all(done: Callable[[Applied], None]) -> None:
            extracts = [_extract(spark, connections, s, "full", None, hook) for s in task.sources]
            if len(extracts) > 1:
                schema, defaults = sink.shape()
                extracts = [align(e, schema, defaults, task.target.timezone) for e in extracts]
            done(sink.load(union_sources(extracts), "full", zone=task.target.timezone))

        attempt("+".join(names), replace_all)
        return records
    for name, source in zip(names, task.sources):
        attempt(name, lambda done, source=source: load_source(spark, task, source, connections, sink, hook, done))
    return records


def run_tasks(
    spark: SparkSession,
    tasks: Iterable[Task],
    connections: Sequence[Connection],
    sink_of: Callable[[Target], Sink],
) -> list[RunRecord]:
    return [record for task in tasks for record in run_task(spark, task, connections, sink_of(task.target))]


def run_log(spark: SparkSession, records: Sequence[RunRecord]) -> DataFrame:
    """Run records as rows, to show or to append to a run-log table."""
    schema = (
        "task string, source string, target string, mode string, status string, rows_read long, rows_deleted long, "
        "rows_written long, seconds double, error string"
    )
    names = schema.split(", ")
    return spark.createDataFrame([tuple(getattr(r, n.split()[0]) for n in names) for r in records], schema)


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """Several mapped sources as one extract."""
    return reduce(lambda a, b: a.unionByName(b), frames)
