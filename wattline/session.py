"""Session helpers: a local session for tests/bench and the checkpoint folder."""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "wattline") -> SparkSession:
    """Local session for tests and the bench (UI off, AQE on, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("WATTLINE_DRIVER_MEM", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if os.environ.get("WATTLINE_EVENT_LOG"):
        builder = builder.config("spark.eventLog.enabled", "true") \
            .config("spark.eventLog.dir", os.environ["WATTLINE_EVENT_LOG"])
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Set only where it is unset and everything runs on this machine (tests,
    local bench); on a cluster the configured shared folder is used as is, and
    without one this is an error: executors see no folder of the driver's.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors share (master {master})")
        d = tempfile.mkdtemp(prefix="wattline-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", d)
        spark.sparkContext.setCheckpointDir(d)
    return d


def stored(rows: DataFrame, name: str) -> DataFrame:
    """A written copy, for rows that are read several times: what they are computed from is read once."""
    spark = rows.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def where_computed(rows: DataFrame, condition: Column) -> DataFrame:
    """The rows for which ``condition`` holds, for conditions on computed columns.

    A plain filter is pushed through every projection below it, and each time
    what its columns are computed of is written into the condition as a whole:
    for fields of a parse that is the text gate many times over. The condition
    goes through ``explode``, which no filter on its output passes.
    """
    return rows.select("*", F.explode(F.array(condition)).alias("_held")).where("_held").drop("_held")
