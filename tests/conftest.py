import os
import sys

import duckdb
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[*]")
        .appName("tidemark-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    from suite.registry import TABLES

    db = duckdb.connect()
    db.execute("SET timezone = 'UTC'")
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return db


def rows(df):
    """Rows in a fixed order, to compare two frames whatever order they come in."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def store(spark, tmp_path):
    from tidemark.sinks.store import TableStore

    made = []

    def make(schema, defaults=None, **options):
        table = TableStore(spark, str(tmp_path / f"table{len(made)}"), **options)
        table.create(spark.createDataFrame([], schema).schema, defaults)
        made.append(table)
        return table

    return make
