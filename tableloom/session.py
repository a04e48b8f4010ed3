"""Session helpers: settings, shared scratch folders and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableloom.functions.columns import column

#: A side is broadcast only when a bounded probe proves that it has no more rows and bytes.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 8 << 20


def build_session(cores: int | str = "*", app_name: str = "tableloom") -> SparkSession:
    """Local session for tests and the bench; a cluster brings its own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@lru_cache(maxsize=None)
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="/tmp/run-")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Without the setting the context's own checkpoint folder is taken. A folder of
    this machine stands in only in local mode; on a cluster executors would not
    see each other's files there, so that is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = _local_folder(context.applicationId)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """New, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The written files survive the loss of an executor, and every later use
    sees the same rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "stage")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keep_matching(
    df: DataFrame, name: str, keys: DataFrame, key: str, rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Rows of ``df`` whose column ``name`` occurs in column ``key`` of ``keys``.

    The distinct keys are broadcast only if a bounded probe proves that there
    are at most ``rows`` and that their texts have no more than 8 MB. Otherwise both
    sides are shuffled as they are: adaptive execution splits a hot key only when
    nothing, not even a distinct, stands between the shuffle and the join.
    """
    listed = keys.select(column(key).alias("_key"))
    distinct = listed.distinct()
    probe = distinct.limit(rows + 1).select(F.octet_length(F.col("_key").cast("string")).alias("n"))
    found, size = probe.agg(F.count(F.lit(1)), F.sum("n")).first()
    if found <= rows and (size or 0) <= BROADCAST_BYTES:
        listed = F.broadcast(distinct)
    return df.join(listed, column(name) == F.col("_key"), "left_semi")
