"""Written tables that cut lineage.

Row positions found by a range sort must not change when a lost executor makes
Spark recompute a stage, so they are written once and read back.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LOCAL: dict[str, str] = {}
_WRITTEN: set[str] = set()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``; where it is unset, a temp folder in local mode only."""
    context = spark.sparkContext
    root = spark.conf.get(_SETTING, None) or context.getCheckpointDir()
    if root:
        return root
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise RuntimeError(f"set {_SETTING} to a folder that every executor can reach")
    if context.master not in _LOCAL:  # paths below it begin with the application's id
        _LOCAL[context.master] = tempfile.mkdtemp(prefix="demandspark-")
    return _LOCAL[context.master]


def scratch_path(spark: SparkSession, label: str) -> str:
    """Fresh path below the scratch folder; never reused, so nothing is overwritten."""
    app = spark.sparkContext.applicationId
    return f"{scratch_root(spark).rstrip('/')}/{app}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet and return a scan of it (column pruning stays possible)."""
    return stored(df, label)[0]


def stored(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """As ``materialize``, with the path, so that ``delete`` can end the table's life."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    _WRITTEN.add(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def written() -> set[str]:
    """Paths of the tables that this process has written and not yet deleted."""
    return set(_WRITTEN)


def delete(spark: SparkSession, *paths: str) -> None:
    """Remove written tables that nothing reads any more, in whatever store they are."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(conf).delete(where, True)
        _WRITTEN.discard(path)


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """The session's setting ``name`` is ``value`` inside and as before after that."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def shuffles_freed(spark: SparkSession):
    """Jobs that run inside leave no shuffle files, which else stay until the driver collects its garbage."""
    return setting(spark, _FREED, "true")
