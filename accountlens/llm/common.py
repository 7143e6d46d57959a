"""Helpers shared by the corpus operators: tables, column names, row keys and distributed ranks."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: The columns of the documents table; every pipeline stage but the last returns them.
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: Rows of one ranking bucket: a bucket is the unit that one window group sorts.
RANK_BUCKET_ROWS = 8192


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per application, so that Python tasks can import it wherever they run.

    The archive is written for Spark's own file distribution, which copies it to every executor.
    """
    sc = spark.sparkContext
    if ship_package.__dict__.get("to") == sc.applicationId:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="accountlens-"), "accountlens.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    path = os.path.join(folder, f)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(archive)
    ship_package.to = sc.applicationId


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, base: str) -> str:
    """``base``, lengthened until no column of ``df`` has that name (case is ignored)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def stratum(column: Column) -> Column:
    """A never-null text key that tells null apart from every value."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit("null"))


def shuffle_key(seed: int, column: Column) -> Column:
    """A seeded, uniform text key; MD5 so that any SQL engine can repeat it."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(column.cast("string"), F.lit("null"))))


def hex_fraction_bucket(key: Column, buckets: int) -> Column:
    """The bucket 0..buckets-1 of a uniform hexadecimal key; order of buckets is order of keys."""
    return F.shiftright(F.conv(F.substring(key, 1, 8), 16, 10).cast("bigint") * F.lit(buckets).cast("bigint"), 32)


def ranked(rows: DataFrame, stratum_col: str, key_col: str, tie_cols: list[str], rank_col: str, size_col: str,
           total: int, bucket_rows: int = RANK_BUCKET_ROWS) -> DataFrame:
    """Append the 0-based rank of each row in its stratum by (key, ties) and the size of the stratum.

    No stratum is sorted in one piece: rows are dealt to (stratum, key range) buckets of about ``bucket_rows`` rows,
    counts of the buckets give every bucket its offset, and only buckets are sorted. The key must be a uniform
    hexadecimal text. ``total`` (rows in all) sets the number of key ranges, so buckets stay small at any size.
    """
    bucket, offset, total_col = (free_name(rows, n) for n in ("__bucket", "__offset", "__total"))
    buckets = max(1, -(-total // bucket_rows))
    dealt = rows.withColumn(bucket, hex_fraction_bucket(F.col(key_col), buckets))
    counts = dealt.groupBy(stratum_col, bucket).agg(F.count(F.lit(1)).alias(size_col))
    by = Window.partitionBy(stratum_col)
    offsets = counts.select(
        stratum_col, bucket,
        (F.sum(size_col).over(by.orderBy(bucket).rowsBetween(Window.unboundedPreceding, 0)) - F.col(size_col))
        .alias(offset),
        F.sum(size_col).over(by).alias(total_col))
    within = Window.partitionBy(stratum_col, bucket).orderBy(key_col, *tie_cols)
    return (dealt.join(offsets, [stratum_col, bucket])
            .withColumn(rank_col, F.col(offset) + F.row_number().over(within) - 1)
            .withColumn(size_col, F.col(total_col))
            .drop(bucket, offset, total_col))


def running_offsets(counts: DataFrame, order_col: str, count_col: str, offset_col: str, fan: int = 1024) -> DataFrame:
    """Append the sum of ``count_col`` over all smaller ``order_col`` (an integer, one row each), in two levels.

    Groups of ``fan`` consecutive keys are summed first, so no task sees more than every ``fan``-th key.
    """
    group, before = free_name(counts, "__group"), free_name(counts, "__before")
    grouped = counts.withColumn(group, F.floor(F.col(order_col) / fan))
    totals = grouped.groupBy(group).agg(F.sum(count_col).alias(before))
    up_to = Window.orderBy(group).rowsBetween(Window.unboundedPreceding, 0)
    starts = totals.select(group, (F.sum(before).over(up_to) - F.col(before)).alias(before))
    inside = Window.partitionBy(group).orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    return (grouped.join(starts, group)
            .withColumn(offset_col, F.col(before) + F.sum(count_col).over(inside) - F.col(count_col))
            .drop(group, before))
