"""Small helpers shared by the operators: tables, scratch tables, scratch files."""

from __future__ import annotations

import posixpath

from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from landsales.session import new_work_dir


BATCH_ROWS = 1000          # rows of an Arrow batch: long texts make the default of 10,000 large
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _bound_batches(spark: SparkSession) -> None:
    if not 0 < int(spark.conf.get(_BATCH)) <= BATCH_ROWS:
        spark.conf.set(_BATCH, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    _bound_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below spark.checkpoint.dir and read it back: the lineage ends
    at files every executor can read, so a lost executor costs no recomputation."""
    spark = df.sparkSession
    _bound_batches(spark)
    path = new_work_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a shared folder, on the driver or in a task.

    ``s3a://`` is the Hadoop connector's name for the scheme pyarrow calls s3.
    """
    if uri.startswith("s3a://"):
        uri = "s3://" + uri[len("s3a://"):]
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def write_file(uri: str, parts) -> None:
    """Write byte strings to a new file; the folder is made if needed."""
    fs, path = filesystem(uri)
    fs.create_dir(posixpath.dirname(path), recursive=True)
    with fs.open_output_stream(path) as out:
        for part in parts:
            out.write(part)


def read_file(uri: str) -> bytes:
    fs, path = filesystem(uri)
    with fs.open_input_stream(path) as stream:
        return stream.read()


def unused(name: str, *frames: DataFrame) -> str:
    """``name``, with as many underscores before it as no column has yet (in any case of letters)."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def extended(df: DataFrame, **fields: T.DataType) -> T.StructType:
    """The schema of ``df`` with more columns at its end."""
    return T.StructType([*df.schema.fields, *(T.StructField(k, v) for k, v in fields.items())])
