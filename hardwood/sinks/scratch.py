"""Tables written once and read back, in the shared folder that the session names.

A written table cuts lineage and survives the loss of executors. The folder is the session's
``spark.checkpoint.dir``. Only a local-mode session that names none (one process, as in tests) gets
a folder of its own, and a warning. ``release`` removes what an application has written.
"""

from __future__ import annotations

import logging
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

logger = logging.getLogger(__name__)

_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="hardwood-")
        logger.warning("spark.checkpoint.dir is unset; using %s", _local_folders[context.applicationId])
    return _local_folders[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder, used by this application only."""
    application = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/hardwood/{application}/{label}-{uuid.uuid4().hex}"


def keep(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and return the written table."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keep_counted(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """The written table, and its rows, counted while it was written."""
    written = Observation()
    kept = keep(df.observe(written, F.count(F.lit(1)).alias("rows")), label)
    return kept, written.get["rows"]


def release(spark: SparkSession) -> None:
    """Remove everything this application wrote here; frames read from it are then void."""
    folder = f"{shared_folder(spark)}/hardwood/{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
