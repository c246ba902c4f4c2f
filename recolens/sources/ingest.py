"""Ingest of files with a commit manifest: a retry writes nothing twice, and done files are skipped.

A batch is the set of source files that no manifest lists yet. Its number is a hash of their names,
sizes and times, so a run that is repeated after a failure works on the same batch and overwrites the
same folder. The manifest, written last, is the commit: readers take committed batches only, and what a
killed run has left is never seen.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

MANIFEST = "file string, length long, modified timestamp, rows long, check long, batch string"


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def manifest(spark: SparkSession, table: str) -> DataFrame:
    """Every committed source file, with the rows and the checksum of its batch."""
    path = f"{table}/_manifest"
    if not _exists(spark, path):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).option("recursiveFileLookup", True).parquet(path)


def source_files(spark: SparkSession, source: str, pattern: str = "*.parquet") -> DataFrame:
    """(file, length, modified) of all files under ``source``, without reading them."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(source)
    return files.select(F.col("path").alias("file"), "length", F.col("modificationTime").alias("modified"))


def ingest(
    spark: SparkSession, source: str, table: str, build: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    read: Callable[[list[str]], DataFrame] | None = None, before_commit: Callable[[], None] | None = None,
) -> str | None:
    """Append ``build`` of the new files under ``source`` to ``table``; the batch, None if there is none.

    A file counts as new until a manifest lists it with the same size and time. ``before_commit`` is
    called when the rows are written and the manifest is not.
    """
    new = source_files(spark, source).join(
        manifest(spark, table).select("file", "length", "modified"), ["file", "length", "modified"], "left_anti"
    )
    new = new.withColumn("mark", F.xxhash64("file", "length", "modified"))
    names = [r.file for r in new.select("file").orderBy("file").collect()]  # the list of files a reader holds anyway
    if not names:
        return None
    marks = new.agg(F.bit_xor("mark").alias("a"), F.bit_xor(F.xxhash64("mark")).alias("b")).first()
    batch = f"{marks.a & (2**64 - 1):016x}{marks.b & (2**64 - 1):016x}"
    rows = build(read(names) if read else spark.read.parquet(*names))
    rows.write.mode("overwrite").parquet(f"{table}/data/{batch}")
    written = spark.read.parquet(f"{table}/data/{batch}")
    check = written.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.bit_xor(F.xxhash64(*written.columns)), F.lit(0)).alias("check"))
    if before_commit:
        before_commit()
    commit = new.drop("mark").crossJoin(F.broadcast(check)).withColumn("batch", F.lit(batch))  # one row of sums
    commit.select("file", "length", "modified", "rows", "check", "batch").coalesce(1).write.mode("overwrite").parquet(
        f"{table}/_manifest/{batch}"
    )
    return batch


def read_committed(spark: SparkSession, table: str) -> DataFrame:
    """The rows of all committed batches."""
    batches = sorted(r.batch for r in manifest(spark, table).select("batch").distinct().collect())  # one per run
    if not batches:
        raise ValueError(f"nothing is committed in {table}")
    return spark.read.parquet(*[f"{table}/data/{b}" for b in batches])


def broken_batches(spark: SparkSession, table: str) -> list[str]:
    """Committed batches whose rows no longer give the manifest's number and checksum."""
    out = []
    for r in manifest(spark, table).select("batch", "rows", "check").distinct().collect():
        rows = spark.read.parquet(f"{table}/data/{r.batch}")
        now = rows.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64(*rows.columns)), F.lit(0))).first()
        if tuple(now) != (r.rows, r.check):
            out.append(r.batch)
    return out
