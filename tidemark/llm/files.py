"""Files of own formats in the shared folder: written by tasks, read back through Spark."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import new_folder


def files_folder(spark: SparkSession, label: str) -> str:
    """A new, empty folder that every executor can reach."""
    folder = new_folder(spark, label)
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    return folder


@contextmanager
def written(folder: str, name: str) -> Iterator[pa.NativeFile]:
    """A file that appears under its name only when complete, so that a repeated task replaces it whole.

    Until then its name begins with an underscore; Spark's readers pass over such files.
    """
    store, root = fs.FileSystem.from_uri(folder)
    temporary = f"{root}/_{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(temporary) as out:
        yield out
    store.move(temporary, f"{root}/{name}")


def whole_files(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """``(name, content)`` of the files; each is read as a whole, so writers bound their size."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return found.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
