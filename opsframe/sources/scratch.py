"""Where jobs put the tables they write and read back."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, which all executors share.

    Without that setting it is under ``spark.sql.warehouse.dir``, where tables
    are kept anyway, as the default file system resolves it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        path = spark._jvm.org.apache.hadoop.fs.Path(spark.conf.get("spark.sql.warehouse.dir"))
        store = path.getFileSystem(spark._jsc.hadoopConfiguration())
        base = store.makeQualified(path).toString()
    return f"{base.rstrip('/')}/opsframe/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The frame stored in the shared folder and read back.

    For a result that several branches of a job use: it is computed once, and
    losing an executor later does not compute it again.
    """
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder of ``shared_dir`` that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def read_parquet_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path``, or an empty one when nothing was written there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
