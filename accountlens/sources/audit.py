"""Ingestion audit (AUD1, AUD2, SNK3)."""

from __future__ import annotations

import datetime as _dt
import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AUDIT_SCHEMA = "timestamp string, filename string, data_type string, row_count bigint, checksum string"


#: Files up to this size are read as one value; larger ones are streamed. The digest is the same.
WHOLE_FILE_BYTES = 64 << 20
BLOCK_BYTES = 8 << 20


def _streamed(files: DataFrame) -> DataFrame:
    """path, checksum, length: each file read block by block by one task, so memory does not grow with the file."""
    block = BLOCK_BYTES

    def digests(batches):
        import hashlib

        import pandas as pd
        from pyarrow import fs

        for pdf in batches:
            found = []
            for path in pdf["path"]:
                local = path.startswith("file:")
                store, name = (fs.LocalFileSystem(), "/" + path[5:].lstrip("/")) if local else fs.FileSystem.from_uri(path)
                digest = hashlib.md5()
                with store.open_input_stream(name, compression=None) as stream:
                    while chunk := stream.read(block):
                        digest.update(chunk)
                found.append(digest.hexdigest())
            yield pd.DataFrame({"path": pdf["path"], "checksum": found, "length": pdf["length"]})

    return files.repartition(F.col("path")).mapInPandas(digests, "path string, checksum string, length long")


def file_checksums(spark: SparkSession, path: str, whole_file_bytes: int = WHOLE_FILE_BYTES) -> DataFrame:
    """AUD2: MD5 of the bytes of every file under ``path`` (path, checksum, length), computed on executors.

    Files over ``whole_file_bytes`` are streamed by Arrow's file systems (local, HDFS, S3, GCS), of any size.
    Spark's scans skip files of no bytes, so those have no row; ``checksum`` of such a file is the MD5 of no bytes.
    """
    files = spark.read.format("binaryFile").load(path)
    whole = (files.where(F.col("length") <= whole_file_bytes)
             .select("path", F.md5(F.col("content")).alias("checksum"), "length"))
    return whole.unionByName(_streamed(files.where(F.col("length") > whole_file_bytes).select("path", "length")))


def checksum(spark: SparkSession, path: str) -> str:
    """One digest for ``path``: the file's MD5, or for a directory one over its files' digests.

    Files are dealt to 256 buckets by their digest; a bucket's digest is that of its sorted file digests, and the
    directory's that of the bucket digests in order, so at most 256 rows reach the driver.
    """
    buckets = (file_checksums(spark, path).groupBy(F.substring("checksum", 1, 2).alias("bucket"))
               .agg(F.count(F.lit(1)).alias("n"), F.min("checksum").alias("least"),
                    F.md5(F.array_join(F.array_sort(F.collect_list("checksum")), "").cast("binary")).alias("digest"))
               .orderBy("bucket").collect())
    if sum(r["n"] for r in buckets) == 1:
        return buckets[0]["least"]
    return hashlib.md5("".join(r["digest"] for r in buckets).encode()).hexdigest()


class AuditLog:
    """AUD1: one entry per load (timestamp, filename, data_type, row_count, checksum)."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.entries: list[tuple] = []

    def log(self, filename: str, path: str, row_count: int, data_type: str) -> None:
        self.entries.append((_dt.datetime.now().isoformat(), filename, data_type, int(row_count),
                             checksum(self.spark, path)))

    def to_dataframe(self) -> DataFrame:
        return self.spark.createDataFrame(self.entries, AUDIT_SCHEMA)

    def save(self, out_dir: str) -> str:
        """SNK3: append this run's entries to the ``ingestion_log`` table."""
        path = f"{out_dir.rstrip('/')}/ingestion_log"
        self.to_dataframe().coalesce(1).write.mode("append").option("header", True).options(quote='"', escape='"').csv(path)
        return path
