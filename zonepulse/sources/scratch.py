"""Shared folder for intermediate tables, and the size check that guards broadcasts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"
WAREHOUSE_CONF = "spark.sql.warehouse.dir"
BROADCAST_ROWS = 500_000


def scratch_root(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, else one in the warehouse; executors share both."""
    named = spark.conf.get(CHECKPOINT_CONF, None)
    return named.rstrip("/") if named else f"{spark.conf.get(WAREHOUSE_CONF).rstrip('/')}/zonepulse_scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the scratch root; never reused, so no run can see another run's files.

    It lies in a folder of the application, which is removed when the driver ends.
    """
    own = f"{scratch_root(spark)}/zonepulse-{spark.sparkContext.applicationId}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(own)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(folder)
    store.deleteOnExit(folder)
    return f"{own}/{name}-{uuid.uuid4().hex}"


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """A count shows at most ``max_rows`` rows. One small job on a side that might be broadcast."""
    return df.count() <= max_rows


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the scratch folder, for a result of a large scan that is used twice.

    The table also cuts the lineage, so a lost executor does not cause the large scan again.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint when a count shows it is small.

    Above the limit the frame is returned as it is, and Spark joins it with a shuffle (AQE splits the
    partitions of hot keys).
    """
    return F.broadcast(df) if is_small(df, max_rows) else df
