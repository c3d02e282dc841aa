"""The few driver-side file operations a table store needs, on whatever file system the table lives on.

They touch commit files only, which are small; Spark reads and writes all data.
"""

from __future__ import annotations

import os
import uuid

from pyarrow import fs
from pyspark.sql import SparkSession


class CommitConflict(RuntimeError):
    """Another run published first; read the new state and try again."""


class Folder:
    """A directory of small immutable files, or of directories that Spark writes.

    A new file must appear whole, and only if its name is free. A local file system links it into place, HDFS renames it
    and fails when the name is taken. No other storage reached from here promises that, so publishing there is refused
    unless ``single_writer`` says that nobody else publishes.
    """

    def __init__(self, uri: str, single_writer: bool = False) -> None:
        self._fs, self._path = fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
        self._single_writer = single_writer

    def names(self) -> list[str]:
        found = self._fs.get_file_info(fs.FileSelector(self._path, allow_not_found=True))
        return sorted(f.base_name for f in found if f.is_file and not f.base_name.startswith("."))

    def read(self, name: str) -> str:
        with self._fs.open_input_stream(f"{self._path}/{name}") as f:
            return f.read().decode()

    def publish(self, name: str, text: str) -> None:
        """Make a whole file appear under a new name in one step; CommitConflict where the name is taken."""
        local, renames = isinstance(self._fs, fs.LocalFileSystem), self._fs.type_name == "hdfs"
        if not (local or renames or self._single_writer):
            raise CommitConflict(f"{self._fs.type_name} cannot create a file only if it is absent; pass single_writer for one writer")
        self._fs.create_dir(self._path, recursive=True)
        temporary, final = f"{self._path}/.{uuid.uuid4().hex}", f"{self._path}/{name}"
        with self._fs.open_output_stream(temporary) as f:
            f.write(text.encode())
        if local:
            try:
                os.link(temporary, final)  # fails when the name is taken
            except FileExistsError as e:
                raise CommitConflict(name) from e
            finally:
                os.unlink(temporary)
            return
        try:
            if self._fs.get_file_info(final).type != fs.FileType.NotFound:
                raise CommitConflict(name)
            self._fs.move(temporary, final)
        except OSError as e:
            if self._fs.get_file_info(final).type == fs.FileType.NotFound:
                raise
            raise CommitConflict(name) from e
        finally:
            if self._fs.get_file_info(temporary).type != fs.FileType.NotFound:
                self._fs.delete_file(temporary)

    def directories(self) -> list[str]:
        found = self._fs.get_file_info(fs.FileSelector(self._path, allow_not_found=True))
        return sorted(f.base_name for f in found if f.type == fs.FileType.Directory and not f.base_name.startswith("."))

    def remove(self, name: str) -> None:
        self._fs.delete_file(f"{self._path}/{name}")

    def remove_directory(self, name: str) -> None:
        self._fs.delete_dir(f"{self._path}/{name}")


_default_fs: dict[str, str] = {}


def qualify(spark: SparkSession, path: str) -> str:
    """The path with its file system, so that Spark and the driver mean the same place.

    Spark is asked once per application where a path without a scheme lies.
    """
    if "://" in path:
        return path
    application = spark.sparkContext.applicationId
    if application not in _default_fs:
        anchor = f"{path}/anchor-{uuid.uuid4().hex}"
        spark.range(0).write.parquet(anchor)
        uri = spark.read.schema("id long").parquet(anchor).inputFiles()[0]
        _default_fs[application] = uri[: uri.index(anchor)]
    return _default_fs[application] + path


def scratch_root(spark: SparkSession, fallback: str | None = None) -> str:
    """A new folder name under the shared folder the cluster names, or under ``fallback`` where it names none."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or fallback
    if not shared:
        raise ValueError("spark.checkpoint.dir is not set")
    return f"{shared.rstrip('/')}/tidemark-{uuid.uuid4().hex}"
