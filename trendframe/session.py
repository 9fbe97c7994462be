"""Session set-up for tests and benchmarks, and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str, cores: str = "8", memory: str = "8g", **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # The default keeps 100 compiled plan fragments; one forecast alone has about as many.
        .config("spark.sql.codegen.cache.maxEntries", "2000")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's shared ``spark.checkpoint.dir``, or the context's checkpoint folder.

    Only where neither is set and all executors are threads of this machine (a ``local`` master) is a temporary
    folder made, once per application, and its place set as ``spark.checkpoint.dir`` of the session.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="trendframe-")
        spark.sparkContext.setCheckpointDir(shared)
        shared = spark.sparkContext.getCheckpointDir()
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a new folder of the shared place and read again.

    Lineage ends there, several readers see the same rows, and a lost executor loses nothing.
    """
    folder = scratch_dir(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
