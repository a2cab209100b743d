"""Small driver-side lists as tables, and the shared work folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MARK = "airscan_helper"


def small_table(spark: SparkSession, rows: Iterable[Sequence], schema: pa.Schema) -> DataFrame:
    """A short list as a local relation, whose known size lets Spark choose the join by itself."""
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    arrays = [pa.array(column, field.type) for column, field in zip(columns, schema, strict=True)]
    return spark.createDataFrame(pa.table(arrays, schema=schema))


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder.

    Where that is not set, a master in this process gets one folder for the process, which goes when it ends.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="airscan-")
        atexit.register(shutil.rmtree, shared, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/airscan/{purpose}-{uuid.uuid4().hex}"


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table below the shared work folder and return the written copy."""
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def bounded(keys: DataFrame, most: int = 500_000) -> DataFrame:
    """A written table of keys, broadcast where it has at most ``most`` rows; else Spark joins by its key."""
    return F.broadcast(keys) if keys.count() <= most else keys


# -- columns a job adds -------------------------------------------------------


def helper(column: Column, name: str) -> Column:
    """A column that a job adds, marked so that it is told from an input column of the same name."""
    return column.alias(name, metadata={MARK: True})


def added(df: DataFrame) -> list[str]:
    """Names of the columns that jobs added to a table."""
    return [field.name for field in df.schema if (field.metadata or {}).get(MARK)]


def beside(df: DataFrame, *names: str) -> DataFrame:
    """Make room for added columns: input columns of those names, in any case, get ``_input`` appended."""
    ours, taken = set(added(df)), {name.lower() for name in names}
    moved = {name: f"{name}_input" for name in df.columns if name.lower() in taken and name not in ours}
    return df.withColumnsRenamed(moved) if moved else df
