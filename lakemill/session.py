"""Session defaults and durable intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Period keys stay strings however digit-like they look.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def session(app: str = "lakemill", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or get) a session. Cluster sizing stays with the caller: pass it as conf."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@lru_cache(maxsize=1)
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="lakemill-")


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names in spark.checkpoint.dir.

    Only a local master may fall back to a temporary folder; on a cluster that would be a
    folder of one machine, so the missing setting is an error there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_folder()


_MADE: list[str] = []


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark)}/lakemill/{name}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def release(spark: SparkSession) -> int:
    """Delete what this process has written with `new_path` and `durable`; call it once the results
    that read it are no longer needed. Returns the number of paths."""
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    made = len(_MADE)
    while _MADE:
        path = path_of(_MADE.pop())
        path.getFileSystem(conf).delete(path, True)
    return made


def durable(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    For frames that several actions or several passes of one plan use: the expensive part
    runs once, lost executors cost a re-read instead of a re-run, and later readers still
    get column pruning and filter pushdown.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
