"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a temporary folder where it is unset, which only a local session may do.

    Checkpoints go there as well.
    """
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="rooftop-")
        spark.conf.set("spark.checkpoint.dir", at)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


_roots: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for a scratch table in the shared folder; all of an application's are removed when its driver ends."""
    app = spark.sparkContext.applicationId
    if app not in _roots:
        _roots[app] = root = f"{shared_dir(spark)}/rooftop-{uuid.uuid4().hex}"
        atexit.register(remove, spark, root, True)
    return f"{_roots[app]}/{name}-{uuid.uuid4().hex[:12]}"


def remove(spark: SparkSession, at: str, at_exit: bool = False) -> None:
    """Deletes a path; when the driver ends the session may have ended before."""
    try:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:
        if not at_exit:
            raise


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes a frame as Parquet to the shared folder and reads it again: a cut in the lineage that outlives executors."""
    at = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(at)
    out = df.sparkSession.read.schema(df.schema).parquet(at)
    out.scratch = [at]
    return out
