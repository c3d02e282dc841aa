"""Where queries and their oracle SQL are kept, and what they share."""

from __future__ import annotations

import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.sinks.files import scratch_root
from tidemark.sinks.store import TableStore
from tidemark.sources.connections import Connection
from tidemark.sources.extract import extract
from tidemark.spec import Source

Query = Callable[[SparkSession, str], DataFrame]

TABLES = tuple(
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
)
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        ORACLES[name] = sql
        return run

    return register


def tables(sf_dir: str) -> Connection:
    """The given tables as a connection; queries may name any of them."""
    return Connection("given", kind="parquet", database="given", location=sf_dir, tables=TABLES)


def rows_of(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Rows of a query over the given tables."""
    return extract(spark, tables(sf_dir), Source(sql=sql))


def new_folder(spark: SparkSession) -> str:
    """A fresh folder in the shared place the session names; a temporary one only where a local session names none."""
    local = spark.sparkContext.master.startswith("local[") and not spark.conf.get("spark.checkpoint.dir", None)
    return scratch_root(spark, tempfile.mkdtemp(prefix="tidemark-") if local else None)


def new_store(spark: SparkSession, like: DataFrame) -> TableStore:
    """An empty target table with the columns of ``like``."""
    store = TableStore(spark, new_folder(spark))
    store.create(like.schema)
    return store
