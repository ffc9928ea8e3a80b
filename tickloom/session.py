"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and for ``bench.py``; on a cluster the caller brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tickloom")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own, since
    driver and tasks then share one disk. On a cluster a missing setting is an error:
    a machine-local folder would be gone with its executor.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not re.fullmatch(r"local(\[.*\])?", context.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
            folder = tempfile.mkdtemp(prefix="tickloom-")
        context.setCheckpointDir(folder)
    # Spark's own spelling, which names the file system.
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the scratch folder; nothing is ever overwritten there."""
    return f"{scratch_root(spark)}/tickloom/{label}-{uuid.uuid4().hex}"


def empty_frame(spark: SparkSession, schema: StructType) -> DataFrame:
    """A frame without rows that the optimizer knows to be empty.

    ``createDataFrame([])`` is an RDD of unknown size to it, which spoils join planning.
    """
    columns = [F.lit(None).cast(field.dataType).alias(field.name) for field in schema.fields]
    return spark.range(1).filter(F.lit(False)).select(*columns)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back.

    For frames that feed several outputs: the work behind them runs a single time and
    the written copy outlives any executor.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
