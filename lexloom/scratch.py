"""Written tables between the steps of a job, in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_made: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only on a local master that names none."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="lexloom-")
        spark.sparkContext.setCheckpointDir(base)
        _made.append((spark, base))
    return base.rstrip("/")


def folder(spark: SparkSession, what: str) -> str:
    """A new folder.  It stays while the session runs, as results are lazy, and goes at its end."""
    path = f"{shared_dir(spark)}/lexloom-{what}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


def owned(spark: SparkSession, path: str) -> str:
    """path, which goes at the session's end too."""
    if (spark, path) not in _made:
        _made.append((spark, path))
    return path


def written(df: DataFrame, path: str) -> DataFrame:
    """df as a table there: it is computed once, and survives the loss of executors."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hadoop(spark: SparkSession, path: str):
    """A path and its file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> None:
    p, fs = hadoop(spark, path)
    fs.delete(p, True)


def publish(spark: SparkSession, draft: str, final: str) -> bool:
    """Renames draft to final in one step; False, and the draft goes, if another was first."""
    (a, fs), (b, _) = hadoop(spark, draft), hadoop(spark, final)
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(b.toUri() if b.toUri().getScheme() else fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        files.rename(a, b, gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
        return True
    except Exception:  # noqa: BLE001  the final name is taken, or the rename failed
        fs.delete(a, True)
        if fs.exists(b):
            return False
        raise


@atexit.register
def _clean() -> None:
    for spark, path in _made:
        try:
            if spark.sparkContext._jsc is not None:
                delete(spark, path)
        except Exception:  # noqa: BLE001  the session may be gone already
            return
