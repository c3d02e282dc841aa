"""Tables that a job writes in order to read them again, kept where every executor can reach them."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.sinks.files import Folder

CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_open: list[list[str]] = []  # for each phase that runs, the folders written in it


def folder(spark: SparkSession) -> str:
    """A new folder name under ``spark.checkpoint.dir``; under a temporary one only where a local session names none."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir is not set; it must name a folder that all nodes share")
        shared = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/llm-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, read back from Parquet: computed once, lineage cut, safe when executors are lost."""
    path = f"{folder(df.sparkSession)}/{name}"
    if _open:
        _open[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parts(spark: SparkSession, frames: Iterable[DataFrame], name: str) -> DataFrame:
    """Frames of the same columns, computed and written one after another; read back as one, with their number as ``part``."""
    path = f"{folder(spark)}/{name}"
    if _open:
        _open[-1].append(path)
    for i, df in enumerate(frames):
        df.write.parquet(f"{path}/part={i}")
    schema = T.StructType([*df.schema.fields, T.StructField("part", T.IntegerType())])
    return spark.read.schema(schema).parquet(path)


@contextmanager
def phase(spark: SparkSession) -> Iterator[Callable[[DataFrame | Iterable[DataFrame], str], DataFrame]]:
    """What is written inside is deleted at the end; the function that this gives writes tables, or parts, that outlive the phase.

    Shuffle files of a job that runs inside go when it ends, so frames that are used again have to be written.
    """
    before, made = spark.conf.get(CLEANED), []
    outer = _open[-1] if _open else None

    def keep(df: DataFrame | Iterable[DataFrame], name: str) -> DataFrame:
        at = len(_open[-1])  # of the innermost phase, which may be a later one
        out = written(df, name) if isinstance(df, DataFrame) else parts(spark, df, name)
        path = _open[-1].pop(at)
        if outer is not None:
            outer.append(path)
        return out

    _open.append(made)
    spark.conf.set(CLEANED, "true")
    try:
        yield keep
    finally:
        spark.conf.set(CLEANED, before)
        _open.pop()
        for path in made:
            root, name = path.rsplit("/", 1)
            Folder(root).remove_directory(name)
