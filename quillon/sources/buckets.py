"""A keyed table in hash buckets, of which a change rewrites only those it touches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.scratch import Scratch

BUCKET = "_bucket"


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def write_buckets(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """A new table of one row a key; a bucket is a folder."""
    df.withColumn(BUCKET, bucket_of(key, buckets)).repartition(buckets, BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(path)


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(BUCKET)


def upsert(changes: DataFrame, path: str, key: str, buckets: int, gone: str | None = None) -> int:
    """Put the rows of ``changes`` in place of those of equal keys and add the new ones; returns the number of buckets rewritten.

    ``changes`` have the table's columns and one row a key; where the column
    ``gone`` is true the key goes.  Only the buckets that hold a changed key are
    read and written; a bucket that becomes empty goes too.  The merged rows are
    written to the shared folder before any bucket is replaced.
    """
    spark = changes.sparkSession
    scratch = Scratch(spark)
    new = scratch.save(changes.withColumn(BUCKET, bucket_of(key, buckets)))
    touched = [r[0] for r in new.select(BUCKET).distinct().collect()]  # at most ``buckets`` numbers
    if not touched:
        scratch.remove()
        return 0
    table = spark.read.parquet(path)
    old = table.where(F.col(BUCKET).isin(touched))
    kept = old.join(new.select(key), key, "left_anti").select(*table.columns)
    put = new if gone is None else new.where(~F.coalesce(F.col(gone), F.lit(False)))
    merged = scratch.save(kept.unionByName(put.select(*table.columns)))
    merged.repartition(len(touched), BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)
    filled = {r[0] for r in merged.select(BUCKET).distinct().collect()}
    for b in set(touched) - filled:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{BUCKET}={b}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    scratch.remove()
    return len(touched)
