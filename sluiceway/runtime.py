"""Session facts the operators rely on: the shared scratch folder and tables settled in it.

Nothing here starts a session. Intermediate tables and checkpoints go to the folder the
cluster names in ``spark.checkpoint.dir``; only a local session without that setting gets
a temporary folder of its own.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from contextlib import contextmanager
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

def shared_dir(spark: SparkSession) -> str:
    """Root of the scratch folder that every executor can reach."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_dir()


@cache
def _local_dir() -> str:
    """Only for a local session without the setting; removed when the process ends."""
    folder = tempfile.mkdtemp(prefix="sluiceway-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def new_dir(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


# Spark's setting by which a finished execution's shuffle files go at once.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Executions that begin in here leave no shuffle files: for writes that nothing runs again.

    Otherwise the files of all rounds of a job stay on the executors' disks until the driver happens
    to collect its garbage.
    """
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_DROP_SHUFFLES)
        else:
            spark.conf.set(_DROP_SHUFFLES, before)


def settle(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: its size is known, and it outlives any executor.

    The table stands for the shuffles that made it, so their files are dropped.
    """
    path = new_dir(df.sparkSession, label)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle_counted(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """Write ``df`` as a table in the shared folder; return it as read back, and its rows.

    Cuts the lineage of iterative plans; the files outlive any executor. The rows are
    counted while they are written.
    """
    path, counted = new_dir(df.sparkSession, label), Observation()
    df.observe(counted, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), counted.get["rows"]


def metadata_frame(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A frame of catalog facts (never table data), held by the plan itself."""
    schema = T.StructType.fromDDL(ddl)
    columns = list(zip(*rows)) if rows else [[] for _ in schema.fields]
    arrow = to_arrow_schema(schema)
    arrays = [pa.array(list(c), type=f.type) for c, f in zip(columns, arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), schema)
