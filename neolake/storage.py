"""Tables written once to the folder that the cluster shares, for plans that read a step's rows more than once."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only on a local master without one (tests)."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="neolake-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet and read again: rows stay as they are, whatever is lost or computed anew later."""
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])  # any column name will do
    plain.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(plain.schema).parquet(path).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(df.columns)])


def spread(df: DataFrame, *keys: str, parts: int = 1) -> DataFrame:
    """``df`` dealt over all cores, by ``keys`` if given, into ``parts`` at least: few or small files make few tasks, however much a row costs."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * spark.sparkContext.defaultParallelism, parts), *[F.col(f"`{k}`") for k in keys])
