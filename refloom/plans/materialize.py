"""Cutting lineage with tables in the folder that all executors share.

A written table survives the loss of any executor, is columnar (small on disk) and carries sizes that the
planner can use, which is why iterations use it in place of a cached or locally checkpointed DataFrame.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}
_written: dict[str, set[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`; in local mode, where it may be unset, a temporary one.

    A cluster session without that setting is refused: a machine-local folder would lose rows there.
    """
    sc = spark.sparkContext
    conf = sc.getConf().get("spark.checkpoint.dir", None)
    if conf:
        return conf.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if sc.applicationId not in _own:
        _own[sc.applicationId] = tempfile.mkdtemp(prefix="refloom-")
        atexit.register(shutil.rmtree, _own[sc.applicationId], True)
    return _own[sc.applicationId]


def cut(df: DataFrame) -> DataFrame:
    """Write `df` as a table of the shared folder and read it back."""
    path = f"{shared_dir(df.sparkSession)}/refloom-{uuid.uuid4().hex}"
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._refloom_path = path  # type: ignore[attr-defined]
    _written.setdefault(df.sparkSession.sparkContext.applicationId, set()).add(path)
    return back


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    _written.get(spark.sparkContext.applicationId, set()).discard(path)


def drop(df: DataFrame | None) -> None:
    """Delete the table behind a DataFrame that `cut` returned; nothing may read it afterwards."""
    path = getattr(df, "_refloom_path", None)
    if path is not None:
        _delete(df.sparkSession, path)


def release(spark: SparkSession) -> int:
    """Delete every table this session has cut and not dropped, once their results are written; how many there were."""
    paths = list(_written.get(spark.sparkContext.applicationId, ()))
    for path in paths:
        _delete(spark, path)
    return len(paths)
