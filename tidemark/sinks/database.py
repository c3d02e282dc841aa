"""Database target (PostgreSQL, Greenplum): Spark fills a staging table in parallel, one transaction applies it.

Tasks never write the live table. A task that is retried may write its rows twice, so the staging table's row
count is checked against the staged rows before anything is applied.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any, Protocol

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.operators.align import align
from tidemark.operators.hwm import KEY
from tidemark.operators.modes import latest_per_key
from tidemark.sinks.store import Applied, TableStore, target_name
from tidemark.sources.connections import Connection
from tidemark.sources.jdbc import OWN_OPTIONS
from tidemark.spec import INCREMENTAL_MODES, MODES, SpecError


class DbConnection(Protocol):
    """A Python database connection with autocommit off."""

    def cursor(self) -> Any: ...
    def commit(self) -> None: ...
    def rollback(self) -> None: ...


def check_sink(connection: Connection) -> None:
    if connection.kind not in ("postgres", "greenplum"):
        raise SpecError(f"unsupported target kind: {connection.kind}")


def create_staging_sql(staging: str, target: str) -> str:
    return f"CREATE TABLE {staging} (LIKE {target} INCLUDING DEFAULTS)"


def write_options(connection: Connection, staging: str, batch_size: int = 10_000) -> dict[str, str]:
    options = {k: v for k, v in connection.options.items() if k not in OWN_OPTIONS}
    # Text reaches uuid, json and similar columns untyped, for the database to read.
    return {"stringtype": "unspecified"} | options | {"dbtable": staging, "batchsize": str(batch_size), "truncate": "true"}


def fill_staging(df: DataFrame, connection: Connection, staging: str, batch_size: int = 10_000) -> None:
    """Parallel write; ``overwrite`` with truncate keeps the table's shape and drops rows of an earlier try."""
    check_sink(connection)
    df.write.format("jdbc").options(**write_options(connection, staging, batch_size)).mode("overwrite").save()


def delete_sql(target: str, staging: str, pk: Sequence[str]) -> str:
    same = " AND ".join(f"t.{k} = s.{k}" for k in pk)
    return f"DELETE FROM {target} t USING {staging} s WHERE {same}"


def apply_staging(
    db: DbConnection,
    target: str,
    staging: str,
    columns: Sequence[str],
    mode: str,
    *,
    expected_rows: int,
    pk: Sequence[str] = (),
    mark: dict[str, str] | None = None,
    mark_table: str = "high_water_marks",
    marker: str = "%s",
) -> Applied:
    """Delete, insert and mark in one transaction; nothing is changed unless all of it is.

    ``mark`` holds the key columns and the fields to store; its ``incr_point`` is already the larger of old and new.
    ``marker`` is the driver's parameter marker.
    """
    if mode not in MODES:
        raise SpecError(f"unsupported mode: {mode!r}")
    if mode == "merge" and not pk:
        raise SpecError("pk is required for merge mode")
    cursor = db.cursor()
    try:
        cursor.execute(f"SELECT count(*) FROM {staging}")
        found = cursor.fetchone()[0]
        if found != expected_rows:
            raise RuntimeError(f"{staging} holds {found} rows, expected {expected_rows}; fill it again")
        if not found:
            db.rollback()
            return Applied(0)
        deleted = 0
        if mode == "full":
            cursor.execute(f"TRUNCATE TABLE {target}")
        elif mode == "merge":
            cursor.execute(delete_sql(target, staging, pk))
            deleted = max(cursor.rowcount, 0)
        names = ", ".join(columns)
        cursor.execute(f"INSERT INTO {target} ({names}) SELECT {names} FROM {staging}")
        if mark and mode in INCREMENTAL_MODES:
            _store_mark(cursor, mark_table, mark, marker)
        db.commit()
    except BaseException:
        db.rollback()
        raise
    return Applied(0, deleted, found, (mark or {}).get("incr_point"))


def _store_mark(cursor: Any, table: str, mark: dict[str, str], marker: str) -> None:
    """Replace the row of this mark."""
    where = " AND ".join(f"{k} = {marker}" for k in KEY)
    cursor.execute(f"DELETE FROM {table} WHERE {where}", [mark[k] for k in KEY])
    places = ", ".join([marker] * len(mark))
    cursor.execute(f"INSERT INTO {table} ({', '.join(mark)}) VALUES ({places})", list(mark.values()))


class DatabaseTable:
    """One database table as a target of loads. ``work`` is a table store whose folder holds staged rows."""

    def __init__(
        self,
        connection: Connection,
        db: DbConnection,
        table: str,
        work: TableStore,
        *,
        schema: T.StructType | None = None,
        mark_table: str = "high_water_marks",
        marker: str = "%s",
        fill: Callable[[DataFrame, Connection, str], None] = fill_staging,
    ) -> None:
        check_sink(connection)
        self.connection, self.db, self.table, self.staging = connection, db, table, work
        self.mark_table, self.marker, self._fill, self._schema = mark_table, marker, fill, schema

    def shape(self) -> tuple[T.StructType, dict[str, Any]]:
        """Columns as the database reports them; defaults are the database's own."""
        if self._schema is None:
            options = self.connection.options | {"dbtable": f"(SELECT * FROM {self.table} WHERE 1=0) t"}
            self._schema = self.staging.spark.read.format("jdbc").options(**options).load().schema
        return self._schema, {}

    def stored_point(self, key: dict[str, str]) -> str | None:
        where = " AND ".join(f"{k} = {self.marker}" for k in KEY)
        return self._one(f"SELECT incr_point FROM {self.mark_table} WHERE {where}", [key[k] for k in KEY])

    def reached(self, column: str) -> str | None:
        return self._one(f"SELECT CAST(MAX({column}) AS TEXT) FROM {self.table}")

    def _one(self, sql: str, values: Sequence[str] = ()) -> str | None:
        cursor = self.db.cursor()
        cursor.execute(sql, values)
        row = cursor.fetchone()
        self.db.rollback()
        return (row[0] or None) if row else None

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
    ) -> Applied:
        """Apply one extract in one transaction.

        The rows are first written to ``work``, so they and their count stay the same however often tasks are
        retried. Target columns that the source lacks get the database's default.
        """
        schema, _ = self.shape()
        given = {c.lower() for c in source.columns}
        wanted = T.StructType([f for f in schema.fields if f.name.lower() in given])
        rows = align(source, wanted if len(wanted) == len(given) else schema, zone=zone)
        incr = target_name(rows.schema, incr) if incr and mode in INCREMENTAL_MODES else ""
        if dedupe and pk and incr:
            rows = latest_per_key(rows, [target_name(rows.schema, k) for k in pk], incr)
        old = self.stored_point(key) if incr and key else None
        staged = self.staging.stage(rows, incr, old_point=old, gather=mode in INCREMENTAL_MODES)
        if not staged.part.rows:
            self.staging.discard(staged.part)
            return Applied(0)
        name = f"{self.table}_staging_{staged.part.directory[-12:]}"
        self._run(create_staging_sql(name, self.table))
        try:
            self._fill(self.staging.read_part(staged.part, rows.schema), self.connection, name)
            mark = key | (facts or {}) | {"incr_point": staged.point} if key and staged.point else None
            return apply_staging(
                self.db,
                self.table,
                name,
                rows.columns,
                mode,
                expected_rows=staged.part.rows,
                pk=pk,
                mark=mark,
                mark_table=self.mark_table,
                marker=self.marker,
            )
        finally:
            self._run(f"DROP TABLE {name}")
            self.staging.discard(staged.part)

    def _run(self, statement: str) -> None:
        self.db.cursor().execute(statement)
        self.db.commit()
