"""Shared folders for intermediate data: the place that `spark.checkpoint.dir` names."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_made: list[tuple[SparkSession, str]] = []
_tables: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name under `spark.checkpoint.dir`, deleted when the driver's Python ends.

    Where the setting is missing it is a folder in the warehouse, which driver and executors share in
    any deployment.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if not _made:
        atexit.register(drop_folders)
    _made.append((spark, path))
    return path


SHUFFLES_END = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_end(spark: SparkSession) -> Iterator[None]:
    """Statements inside delete the files of their shuffles when they end; what they wrote stays."""
    before = spark.conf.get(SHUFFLES_END, None)
    spark.conf.set(SHUFFLES_END, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLES_END) if before is None else spark.conf.set(SHUFFLES_END, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    with shuffles_end(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_written(df: DataFrame) -> None:
    """Delete the folder of a table that `written` gave and nothing reads any more."""
    names = {path.rsplit("/", 2)[-2] for path in df.inputFiles()}
    for spark, path in [m for m in _made if m[1].rsplit("/", 1)[1] in names]:
        _made.remove((spark, path))
        _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def bucketed(df: DataFrame, name: str, columns: list[str], buckets: int) -> DataFrame:
    """Write once to the shared folder, in buckets by `columns`: later groupings by them read a bucket in
    place and need no shuffle of this side. More buckets than Spark's limit become as many as it allows."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    buckets = max(1, min(buckets, int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))))
    table = path.rsplit("/", 1)[1].replace("-", "_")
    _tables.append((spark, table))
    (
        df.repartition(buckets, *columns).write.bucketBy(buckets, *columns).sortBy(*columns)
        .format("parquet").option("compression", "zstd").option("path", path).saveAsTable(table)
    )
    return spark.table(table)


def unused(df: DataFrame, *names: str) -> list[str]:
    """Column names like `names` that `df` doesn't have, whatever its columns are called."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def drop_folders() -> None:
    """Delete every folder that `shared_folder` has named in this process, and drop the tables over them."""
    while _tables:
        spark, table = _tables.pop()
        try:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        except Exception:  # the session has ended, and an in-memory catalog with it
            break
    while _made:
        spark, path = _made.pop()
        try:
            _delete(spark, path)
        except Exception:  # the session has ended: nothing left to delete with
            return
