"""Named places to read from: the catalog, a directory of parquet tables, or a database over JDBC."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tidemark.spec import SpecError, split_name

# Accepted spellings of the kinds of connection.
KINDS = {
    "catalog": "catalog",
    "parquet": "parquet",
    "mssql": "mssql",
    "sqlserver": "mssql",
    "postgres": "postgres",
    "postgresql": "postgres",
    "pg": "postgres",
    "greenplum": "greenplum",
    "gp": "greenplum",
}
JDBC_KINDS = ("mssql", "postgres", "greenplum")


@dataclass(frozen=True)
class Connection:
    """``location`` is the parquet directory; ``options`` are JDBC options; ``tables`` name query-visible files."""

    name: str
    kind: str = "catalog"
    id: str = ""
    database: str = ""
    location: str = ""
    options: dict[str, str] = field(default_factory=dict)
    tables: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        kind = KINDS.get(self.kind.strip().lower())
        if kind is None:
            raise SpecError(f"unsupported connection kind: {self.kind!r}")
        object.__setattr__(self, "kind", kind)

    @property
    def is_jdbc(self) -> bool:
        return self.kind in JDBC_KINDS

    def check_table(self, table: str) -> None:
        if split_name(table).database and self.kind != "mssql":
            raise SpecError(f"source table {table!r}: db.schema.table is only supported for mssql sources")

    def path_of(self, table: str) -> str:
        return f"{self.location.rstrip('/')}/{table.replace('.', '/')}.parquet"

    def relation(self, spark: SparkSession, table: str) -> DataFrame:
        """The table as a lazy DataFrame, all columns."""
        self.check_table(table)
        if self.kind == "parquet":
            return spark.read.parquet(self.path_of(table))
        return spark.table(table)

    def expose(self, spark: SparkSession, sql: str) -> None:
        """Make the tables a query names visible to it. Catalog tables already are."""
        for table in self.tables:
            if re.search(rf"\b{re.escape(table)}\b", sql, re.IGNORECASE):
                spark.read.parquet(self.path_of(table)).createOrReplaceTempView(table)


def find_connection(connections: Iterable[Connection], key: str) -> Connection:
    """By id first, then by name."""
    known = list(connections)
    for attribute in ("id", "name"):
        for connection in known:
            if key.strip() and getattr(connection, attribute).strip() == key.strip():
                return connection
    raise SpecError(f"connection not found: {key!r}")
