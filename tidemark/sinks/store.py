"""A table as directories of parquet files plus one small commit file that names them.

Data is written to new directories first. Publishing the next commit file is the only commit: files, high-water
marks and stream progress become visible together, and a run that dies before it leaves the table as it was.

A merge rewrites nothing. Beside its rows it writes the keys that it found in the table, once each; a reader takes rows
with such a key out of the directories that are older than the merge. ``compact`` folds these key tables in. Neither the
commit files nor the driver hold anything that grows with the number of files or of rows.
"""

from __future__ import annotations

import json
import time
import uuid
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field, replace
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.clean import quoted
from tidemark.operators import hwm
from tidemark.operators.align import align
from tidemark.operators.matching import (
    BROADCAST_BYTES,
    HOT_SHARE,
    all_present,
    can_filter,
    key_bytes,
    key_counts,
    key_filter,
    key_hash,
    marked,
    match,
    usable_keys,
)
from tidemark.operators.modes import latest_per_key
from tidemark.sinks.files import CommitConflict, Folder, qualify
from tidemark.spec import INCREMENTAL_MODES, MODES, SpecError

FORMAT = 2  # of commit files
MARK_FIELDS = [*hwm.KEY, "incr_point", "sync_mode", "src_incr_field", "dst_pk"]
MARK_SCHEMA = ", ".join(f"{f} string" for f in MARK_FIELDS)
CONTROL_FIELDS = [*MARK_FIELDS, "cdt", "udt"]
LISTED = 50  # directories up to which their commits are a constant of the plan, not a table
ROWS_PER_FILE = 100_000  # fewer on average, from more tasks than run at once, are too many small files
RETRIES = 20  # of an append that another commit overtook
KEEP_SECONDS = 24 * 3600.0  # age from which directories that no commit names are garbage
LEASE_SECONDS = 30 * KEEP_SECONDS  # no load runs longer; older leases are void
_ORDERED = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.StringType)


@dataclass(frozen=True)
class Part:
    """One written directory, the commit that it came with, and how many rows were written to it."""

    directory: str
    rows: int
    version: int = 0


@dataclass(frozen=True)
class Deletion:
    """Keys that a merge took from all parts older than its commit: a directory with each key once.

    ``hot`` are hashes of the few keys that owned a large share of the table; known only where the keys are too many to
    be broadcast.
    """

    directory: str
    version: int
    pk: tuple[str, ...]
    rows: int
    key_size: int
    hot: tuple[int, ...] = ()


@dataclass(frozen=True)
class Snapshot:
    """What one commit file says. ``streams`` has the last batch of every run of every stream."""

    version: int
    schema: T.StructType
    rows: int = 0
    defaults: dict[str, Any] = field(default_factory=dict)
    parts: tuple[Part, ...] = ()
    marks: dict[str, dict[str, str]] = field(default_factory=dict)
    streams: dict[str, dict[str, int]] = field(default_factory=dict)
    deletions: tuple[Deletion, ...] = ()

    def to_json(self) -> str:
        return json.dumps({"format": FORMAT} | asdict(replace(self, schema=None)) | {"schema": self.schema.jsonValue()})

    @classmethod
    def from_json(cls, text: str) -> Snapshot:
        raw = json.loads(text)
        if raw.pop("format", 1) != FORMAT:
            raise SpecError("the table was written in another format")
        deletions = (Deletion(**d | {"pk": tuple(d["pk"]), "hot": tuple(d["hot"])}) for d in raw["deletions"])
        lists = {"parts": tuple(Part(**p) for p in raw["parts"]), "deletions": tuple(deletions)}
        return cls(**raw | lists | {"schema": T.StructType.fromJson(raw["schema"])})

    def directories(self) -> set[str]:
        return {x.directory for x in (*self.parts, *self.deletions)}


@dataclass(frozen=True)
class Staged:
    """Rows written but not yet part of the table, with what was measured while writing."""

    part: Part
    point: str | None = None
    key_size: int = 0
    low: Any = None
    high: Any = None
    also: dict[str, Any] = field(default_factory=dict)


@dataclass(frozen=True)
class Applied:
    """Outcome of one write."""

    version: int
    deleted: int = 0
    inserted: int = 0
    point: str | None = None
    read: int | None = None  # rows of the extract where a dedupe left fewer to insert


class TableStore:
    """One target table under ``root``.

    Of two writers the later commits on top of the earlier if it only adds rows, else it gets CommitConflict. Where the
    storage cannot create a file only if it is absent, commits are refused unless ``single_writer`` vouches for one.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        *,
        broadcast_bytes: int = BROADCAST_BYTES,
        single_writer: bool = False,
    ) -> None:
        self.spark = spark
        self.root = qualify(spark, root.rstrip("/"))
        self.broadcast_bytes = broadcast_bytes
        self._commits = Folder(f"{self.root}/commits", single_writer)
        self._data = Folder(f"{self.root}/data", single_writer)
        self._leases = Folder(f"{self.root}/leases", single_writer)

    @property
    def staging(self) -> TableStore:
        """Where rows can be kept before they are loaded."""
        return self

    # State

    def exists(self) -> bool:
        return bool(self._commits.names())

    def create(self, schema: T.StructType, defaults: dict[str, Any] | None = None) -> Snapshot:
        """An empty table. Columns become nullable, as files of other runs may lack values."""
        nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
        snapshot = Snapshot(0, nullable, defaults=defaults or {})
        self._publish(snapshot)
        return snapshot

    def snapshot(self) -> Snapshot:
        names = self._commits.names()
        if not names:
            raise SpecError(f"no table at {self.root}")
        return Snapshot.from_json(self._commits.read(names[-1]))

    def _publish(self, snapshot: Snapshot) -> None:
        self._commits.publish(f"{snapshot.version:012d}.json", snapshot.to_json())

    def _commit(self, before: Snapshot, **changes: Any) -> Snapshot:
        after = replace(before, version=before.version + 1, **changes)
        oldest = min((p.version for p in after.parts), default=after.version)
        after = replace(after, deletions=tuple(d for d in after.deletions if d.version > oldest))
        self._publish(after)
        return after

    # Reading

    def read(self, snapshot: Snapshot | None = None) -> DataFrame:
        snapshot = snapshot or self.snapshot()
        return self._rows(snapshot.parts, snapshot)

    def read_part(self, part: Part, schema: T.StructType) -> DataFrame:
        return self._scan([part], schema)

    def _scan(self, parts: Iterable[Part | Deletion], schema: T.StructType) -> DataFrame:
        paths = [f"{self.root}/data/{p.directory}" for p in parts]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _dated(self, parts: Sequence[Part | Deletion], schema: T.StructType, name: str) -> DataFrame:
        """Rows with the name and the commit of their directory. The directories are those of the commit file."""
        rows = self._scan(parts, schema).withColumn("__directory", directory_of())
        if len({p.version for p in parts}) == 1:
            return rows.withColumn(name, F.lit(parts[0].version).cast("long"))
        listed = [(p.directory, p.version) for p in parts]
        if len(listed) <= LISTED:
            known = F.create_map(*[F.lit(x) for pair in listed for x in pair])
            return rows.withColumn(name, F.element_at(known, F.col("__directory")).cast("long"))
        commits = self.spark.createDataFrame(listed, f"__directory string, {name} long")
        return rows.join(F.broadcast(commits), "__directory")

    def _taken_keys(self, deletions: Sequence[Deletion], pk: Sequence[str], schema: T.StructType) -> tuple[DataFrame, dict]:
        """The deleted keys with the commits that took them, and how to match them."""
        keys = self._dated(deletions, T.StructType([schema[k] for k in pk]), "__until").drop("__directory")
        size, limit = sum(d.key_size for d in deletions), self.broadcast_bytes
        if size <= limit:
            return keys, {"small": True}
        blocks = key_filter(keys, pk, limit) if can_filter(keys, pk, size, limit) else None
        if len(deletions) > 1:
            keys = keys.groupBy(*map(quoted, pk)).agg(F.max("__until").alias("__until"))
        return keys, {"hot": sorted({h for d in deletions for h in d.hot}), "blocks": blocks, "limit": limit}

    def _rows(
        self,
        parts: Sequence[Part],
        snapshot: Snapshot,
        how: str = "left_anti",
        only: Callable[[DataFrame], DataFrame] | None = None,
    ) -> DataFrame:
        """What is left of the parts; with ``left_semi`` the directory of each row that later merges took.

        ``only`` cuts the rows down before they meet the keys that later merges took.
        """
        schema, pending = snapshot.schema, snapshot.deletions
        cut_down = only or (lambda rows: rows)
        newest = max((d.version for d in pending), default=0)
        older = [p for p in parts if p.version < newest]
        rows = None
        if older:
            by_key = defaultdict(list)
            for d in pending:
                by_key[d.pk].append(d)
            rows = cut_down(self._dated(older, schema, "__since"))
            found = []
            for pk, deletions in by_key.items():
                keys, options = self._taken_keys(deletions, pk, schema)
                if only and "blocks" in options:  # few rows are left, which may be shuffled
                    options["blocks"] = None
                matched = match(rows, keys, pk, how, also="l.__since < r.__until", **options)
                found.append(matched)
                rows = matched if how == "left_anti" else match(rows, keys, pk, "left_anti", also="l.__since < r.__until", **options)
            if how == "left_semi":
                return _all_of([f.select("__directory") for f in found])
            rows = rows.select(*map(quoted, schema.names))
        untouched = [p for p in parts if p.version >= newest]
        plain = [cut_down(self._scan(untouched, schema))] if untouched or rows is None else []
        return _all_of([*([rows] if rows is not None else []), *plain])

    # Writing

    def stage(
        self,
        df: DataFrame,
        incr: str = "",
        pk: Sequence[str] = (),
        old_point: str | None = None,
        gather: bool = False,
        also: dict[str, Column] | None = None,
    ) -> Staged:
        """Write rows to a new directory, measuring them on the way; they are not shuffled for it.

        ``gather`` copies what many tasks wrote into many small files once more, into fewer: Spark packs small files when
        it reads them. ``also`` are aggregates of the caller, measured with the others.

        The measurements sit directly on the write, in its result stage, where Spark counts each task once.
        """
        first = pk[0] if pk and isinstance(df.schema[pk[0]].dataType, _ORDERED) else None
        nothing = F.max(F.lit(None).cast("string"))
        measures: list[Column] = [
            F.count(F.lit(1)).alias("rows"),
            (F.max(quoted(incr)) if incr else nothing).alias("top"),
            (key_bytes(df, pk) if pk else F.count(F.lit(None))).alias("key_size"),
            (hwm.point_text(F.min(quoted(first)), df.schema[first].dataType) if first else nothing).alias("low"),
            (hwm.point_text(F.max(quoted(first)), df.schema[first].dataType) if first else nothing).alias("high"),
        ]
        if incr:
            dtype = df.schema[incr].dataType
            top = F.greatest(F.max(quoted(incr)), hwm.typed_point(old_point, dtype))
            measures[1] = hwm.point_text(top, dtype).alias("top")
        measures += [c.alias(name) for name, c in (also or {}).items()]
        out = df
        if gather:
            measures.append(F.approx_count_distinct("__task").alias("tasks"))
            out = df.withColumn("__task", F.spark_partition_id())
        seen = Observation()
        part = Part(new_directory(), 0)
        out.observe(seen, *measures).drop("__task").write.mode("errorifexists").parquet(f"{self.root}/data/{part.directory}")
        got = seen.get
        if gather and got["tasks"] > max(self.spark.sparkContext.defaultParallelism, got["rows"] / ROWS_PER_FILE):
            scattered, part = part, Part(new_directory(), 0)
            self._scan([scattered], df.schema).write.mode("errorifexists").parquet(f"{self.root}/data/{part.directory}")
            self.discard(scattered)
        extra = {name: got[name] for name in also or {}}
        return Staged(replace(part, rows=got["rows"]), got["top"], got["key_size"], got["low"], got["high"], extra)

    def discard(self, part: Part | Deletion) -> None:
        """Remove a staged directory that no commit names."""
        self._data.remove_directory(part.directory)

    @contextmanager
    def lease(self) -> Iterator[None]:
        """While it is held, ``sweep`` leaves directories alone that were made since."""
        name = new_directory()
        self._leases.publish(name, "")
        try:
            yield
        finally:
            self._leases.remove(name)

    def _marked(
        self, before: Snapshot, key: dict[str, str] | None, facts: dict[str, str], point: str | None, dtype: T.DataType | None
    ) -> tuple[dict[str, dict[str, str]], str | None]:
        """The marks after a load that reached ``point``, and the point that its mark has then."""
        if not key:
            return before.marks, point
        name = mark_name(key)
        if not point:
            return before.marks, before.marks.get(name, {}).get("incr_point")
        update = self.spark.createDataFrame([tuple((key | facts | {"incr_point": point}).get(f, "") for f in MARK_FIELDS)], MARK_SCHEMA)
        now = F.localtimestamp()
        row = hwm.upsert(self._control(before, [name]), update, dtype, now).select(*[F.col(c).cast("string") for c in CONTROL_FIELDS]).first()
        return before.marks | {name: {f: row[f] or "" for f in CONTROL_FIELDS}}, row["incr_point"]

    def reached(self, column: str) -> str | None:
        """Largest value of a target column as text; None while the table is empty."""
        snapshot = self.snapshot()
        if not snapshot.parts:
            return None
        return hwm.compute(self.read(snapshot), target_name(snapshot.schema, column)).first().incr_point or None

    def shape(self) -> tuple[T.StructType, dict[str, Any]]:
        """Columns and defaults."""
        snapshot = self.snapshot()
        return snapshot.schema, snapshot.defaults

    def stored_point(self, key: dict[str, str]) -> str | None:
        return self.snapshot().marks.get(mark_name(key), {}).get("incr_point")

    def load(
        self,
        source: DataFrame,
        mode: str,
        *,
        pk: Sequence[str] = (),
        incr: str = "",
        key: dict[str, str] | None = None,
        facts: dict[str, str] | None = None,
        dedupe: bool = False,
        zone: str = "",
        stream: tuple[str, int] | tuple[str, int, str] | None = None,
    ) -> Applied:
        """Apply one extract in one of the four modes, as one commit.

        ``incr`` is the target's name of the incremental field, ``key`` the identity of its mark. ``stream`` names
        a stream, its batch and the run its checkpoint belongs to; a batch that the table has of that run changes
        nothing, whatever other runs have done since.
        """
        if mode not in MODES:
            raise SpecError(f"unsupported mode: {mode!r}")
        if mode == "merge" and not pk:
            raise SpecError("pk is required for merge mode")
        with self.lease():
            before = self.snapshot()
            if stream and self._has(before, stream):
                return Applied(before.version)
            rows = align(source, before.schema, before.defaults, zone)
            incremental = mode in INCREMENTAL_MODES
            incr = target_name(before.schema, incr) if incremental and incr else ""
            pk = [target_name(before.schema, k) for k in pk]
            counted = None
            if dedupe and incremental and pk and incr:
                counted = Observation()
                rows = latest_per_key(rows.observe(counted, F.count(F.lit(1)).alias("rows")), pk, incr)
            staged = self.stage(rows, incr, pk if mode == "merge" else (), gather=incremental)
            read = counted.get["rows"] if counted else None
            for attempt in range(RETRIES + 1):
                try:
                    done = self._apply(before, staged, mode, pk, incr, key if incr else None, facts or {}, stream)
                    return replace(done, point=done.point if incr else None, read=read if done.inserted else None)
                except CommitConflict:
                    if mode not in ("initial", "append") or attempt == RETRIES:
                        raise
                    before = self._newer(before)
                    if stream and self._has(before, stream):
                        return Applied(before.version)
        raise AssertionError

    def _newer(self, before: Snapshot) -> Snapshot:
        """The table that an append goes on from once another commit was first."""
        after = self.snapshot()
        if after.schema != before.schema:
            raise CommitConflict("the columns have changed")
        return after

    def _has(self, before: Snapshot, stream: tuple) -> bool:
        name, number, run = (*stream, "")[:3]
        return before.streams.get(name, {}).get(run, -1) >= number

    def _apply(
        self,
        before: Snapshot,
        staged: Staged,
        mode: str,
        pk: Sequence[str],
        incr: str,
        key: dict[str, str] | None,
        facts: dict[str, str],
        stream: tuple | None,
    ) -> Applied:
        streams = before.streams
        if stream:
            name, number, run = (*stream, "")[:3]
            streams = streams | {name: streams.get(name, {}) | {run: number}}
        if staged.part.rows == 0:
            self.discard(staged.part)
            return Applied(self._commit(before, streams=streams).version if stream else before.version)
        added = replace(staged.part, version=before.version + 1)
        kept, deletions, deleted = before.parts, before.deletions, 0
        if mode == "full":
            kept, deletions, deleted = (), (), before.rows
        elif mode == "merge" and (taken := self._take(before, staged, pk)):
            deletions, deleted = (*deletions, taken), taken.rows
        marks, point = self._marked(before, key, facts, staged.point, before.schema[incr].dataType if incr else None)
        total = before.rows - deleted + added.rows
        after = self._commit(before, rows=total, parts=(*kept, added), deletions=deletions, marks=marks, streams=streams)
        return Applied(after.version, deleted, added.rows, point)

    def _take(self, before: Snapshot, staged: Staged, pk: Sequence[str]) -> Deletion | None:
        """The keys of the table that were staged, written once each, with how many rows they take away.

        Reads the key columns alone, and of them only what lies within the range of the staged keys and, by a filter of
        bounded size, may be among them. Target rows are counted per key before they meet the staged keys, so a key that
        owns many rows on either side is one row.
        """
        if not before.parts:
            return None
        small, limit = staged.key_size <= self.broadcast_bytes, self.broadcast_bytes
        new = self.read_part(staged.part, before.schema)
        keys = usable_keys(new, pk, small)
        blocks = None if small or not can_filter(new, pk, staged.key_size, limit) else key_filter(new, pk, limit)
        in_reach = all_present(pk)
        if staged.low is not None:
            dtype, c = before.schema[pk[0]].dataType, F.col(quoted(pk[0]))
            in_reach &= (c >= hwm.typed_point(staged.low, dtype)) & (c <= hwm.typed_point(staged.high, dtype))

        def near(rows: DataFrame) -> DataFrame:
            rows = rows.where(in_reach)
            if small:
                return match(rows, keys, pk, "left_semi", small=True)
            return rows if blocks is None else marked(rows, blocks, pk, limit).where("__may").drop("__may")

        names = [quoted(k) for k in pk]
        rows = self._rows(before.parts, before, only=near).select(*names)
        count = F.count(F.lit(1)).alias("__rows")
        counts = rows.groupBy(*names).agg(count) if small else key_counts(rows, keys, pk)
        found = self.stage(counts, pk=pk, also={"taken": F.coalesce(F.sum("__rows"), F.lit(0))})
        if not found.part.rows:
            self.discard(found.part)
            return None
        hot: tuple[int, ...] = ()
        if found.key_size > self.broadcast_bytes:
            written = self._scan([found.part], counts.schema)
            large = written.where(F.col("__rows") > HOT_SHARE * before.rows).select(key_hash(written, pk).alias("h"))
            hot = tuple(sorted({r["h"] for r in large.collect()}))  # at most 1 / HOT_SHARE keys own so much
        return Deletion(found.part.directory, before.version + 1, tuple(pk), found.also["taken"], found.key_size, hot)

    def compact(self, rows_below: int = 1_000_000, fold_share: float = 0.1) -> Snapshot:
        """Maintenance, apart from loads: rewrite directories with few rows into one, and fold merges in.

        A directory that has lost more than ``fold_share`` of its rows to later merges is rewritten without them, so the
        work is in proportion to what was deleted; 0 folds everything. Key tables that concern no directory any more are
        dropped.
        """
        with self.lease():
            before = self.snapshot()
            lost: dict[str, int] = {}
            if before.deletions and before.parts:
                gone = self._rows(before.parts, before, "left_semi").groupBy("__directory").count()
                lost = {r["__directory"]: r["count"] for r in gone.collect()}  # a row for each part of the commit file
            small = [p for p in before.parts if p.rows - lost.get(p.directory, 0) < rows_below]
            worn = [p for p in before.parts if lost.get(p.directory, 0) > fold_share * p.rows]
            old = [p for p in before.parts if p in worn or (len(small) > 1 and p in small)]
            if not old and not before.deletions:
                return before
            version = before.version + 1
            kept = [p if p.directory in lost else replace(p, version=version) for p in before.parts if p not in old]
            if old:
                merged = self.stage(self._rows(old, before), gather=True).part
                kept += [replace(merged, version=version)] if merged.rows else []
            if tuple(kept) == before.parts:
                return before
            return self._commit(before, parts=tuple(kept))

    def expire(self, keep: int = 10) -> int:
        """Delete commits but the last ``keep``, and the directories that only those named. Gives their number.

        Directories that no commit ever named are left alone: a run may be about to publish them.
        """
        names = self._commits.names()
        old, kept = names[:-keep], names[-keep:]
        named = lambda which: set().union(*(Snapshot.from_json(self._commits.read(n)).directories() for n in which))
        gone = named(old) - named(kept)
        for directory in sorted(gone):
            self._data.remove_directory(directory)
        for name in old:
            self._commits.remove(name)
        return len(gone)

    def sweep(self, older_than: float = KEEP_SECONDS, lease_for: float = LEASE_SECONDS) -> int:
        """Delete directories that no commit names and that are older than so many seconds. Gives their number.

        What was made since a running load took its lease stays. A lease older than ``lease_for`` belongs to a load that
        died, and is removed.
        """
        now = time.time()
        for name in self._leases.names():
            if made_at(name) < now - lease_for:
                self._leases.remove(name)
        limit = min([now - older_than, *map(made_at, self._leases.names())])
        found = self._data.directories()  # before the commits: what is committed later is not in this list
        needed = set().union(*(Snapshot.from_json(self._commits.read(n)).directories() for n in self._commits.names()))
        gone = [d for d in found if d not in needed and made_at(d) < limit]
        for directory in gone:
            self._data.remove_directory(directory)
        return len(gone)

    def marks(self) -> DataFrame:
        """The high-water marks as a control table."""
        return self._control(self.snapshot())

    def _control(self, snapshot: Snapshot, names: Sequence[str] | None = None) -> DataFrame:
        marks = snapshot.marks
        kept = [marks[n] for n in (marks if names is None else names) if n in marks]
        rows = [tuple(mark.get(f) or (None if f in ("cdt", "udt") else "") for f in CONTROL_FIELDS) for mark in kept]
        schema = T.StructType([T.StructField(f, T.StringType()) for f in CONTROL_FIELDS])
        return self.spark.createDataFrame(rows, schema).withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("cdt", "udt")})


def mark_name(key: dict[str, str]) -> str:
    return json.dumps([key[k] for k in hwm.KEY])


def target_name(schema: T.StructType, name: str) -> str:
    """A column of the target, found ignoring case."""
    for column in schema.names:
        if column.lower() == name.strip().lower():
            return column
    raise SpecError(f"column {name!r} is not in the target")


def directory_of() -> Column:
    """The directory, by its name, that a row was read from."""
    return F.substring_index(F.substring_index(F.col("_metadata.file_path"), "/", -2), "/", 1)


def new_directory() -> str:
    """A new name that says when it was made."""
    return f"{int(time.time() * 1000):013d}-{uuid.uuid4().hex}"


def made_at(name: str) -> float:
    """When a directory or lease was made, in seconds; 0 for names without it."""
    stamp = name.split("-")[0]
    return int(stamp) / 1000 if stamp.isdigit() else 0.0


def _all_of(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionAll(f)
    return out
