"""What the operators share: tables, stored intermediate results, words, columns of an Arrow batch."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidemark.session import configure, new_folder

# Words are runs of anything but these ASCII blanks; bytes.split() cuts at exactly them.
BLANKS = " \t\n\x0b\x0c\r"


def prepared(spark: SparkSession) -> SparkSession:
    """Session settings, and Arrow batches small enough for long texts."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a result into the shared folder and read it from there: cuts the lineage, survives lost executors."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of a string column; a null counts as empty."""
    return [t or b"" for t in column.cast(pa.large_binary()).to_pylist()]


def longs(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A column of longs without nulls."""
    return np.asarray(column.to_numpy(zero_copy_only=False) if isinstance(column, pa.Array) else column.to_numpy())
