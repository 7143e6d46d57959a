"""File sources and sinks (SRC1-SRC6, SNK1-SNK3), cleaning (CLN1-CLN2) and union (UNI1).

Paths go through the Hadoop file system of the session, so object stores,
directories and globs work the same as local files. Input splits replace the
reference's manual chunking.
"""

from __future__ import annotations

import datetime as _dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accountlens import constants as C
from accountlens.sources.csvsplits import borders, read_records

SUPPORTED_FORMATS = {".csv": "csv", ".parquet": "parquet"}


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when the path (or glob) matches at least one file or directory (Hadoop file system)."""
    p, fs = _fs_path(spark, path)
    matches = fs.globStatus(p)
    return matches is not None and len(matches) > 0


def detect_format(path: str, fmt: str | None = None) -> str:
    """SRC3: the format from ``fmt`` or the lower-cased suffix; unsupported suffixes raise."""
    if fmt:
        return fmt
    suffix = os.path.splitext(path.rstrip("/"))[1].lower()
    if suffix == ".xlsx":
        raise ValueError("unsupported format: .xlsx (export the sheet to CSV or Parquet)")
    if suffix not in SUPPORTED_FORMATS:
        raise ValueError(f"unsupported format: {suffix or '(none)'}")
    return SUPPORTED_FORMATS[suffix]


def normalize_nulls(df: DataFrame, tokens=C.NULL_TOKENS) -> DataFrame:
    """Turn the usual null spellings of CSV text ('NA', 'null', ...) into nulls."""
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not strings:
        return df
    toks = list(tokens)
    return df.withColumns({c: F.when(~F.col(c).isin(toks), F.col(c)) for c in strings})


#: Cells are quoted with double quotes and a quote in a cell is doubled, as pandas and spreadsheets write them.
CSV_QUOTING = {"quote": '"', "escape": '"'}


def load_file(spark: SparkSession, path: str, fmt: str | None = None, schema=None, multi_line: bool = False) -> DataFrame:
    """SRC1 / SRC2 / SRC3: scan a CSV (header, every column as text unless ``schema``) or Parquet source.

    Quoted cells may hold line breaks. Lines with a quote are looked at first: if no record has a line break, Spark's CSV scan
    reads the source; else its splits are cut into records by their borders (``csvsplits``), by as many tasks. Both give
    the same rows. A quote that is never closed raises. ``multi_line``: Spark's own reader of such files, one task a file.
    """
    kind = detect_format(path, fmt)
    if not path_exists(spark, path):
        raise FileNotFoundError(f"source file not found: {path}")
    if kind == "csv":
        reader = (spark.read.option("header", True).option("mode", "PERMISSIVE").options(**CSV_QUOTING)
                  .option("multiLine", multi_line))
        if schema is not None:
            reader = reader.schema(schema)
        else:
            reader = reader.option("inferSchema", False)
        if not multi_line:
            found, broken = borders(spark, path)
            if broken:
                columns = schema if schema is not None else reader.option("multiLine", True).csv(path).schema
                if isinstance(columns, str):
                    columns = spark.createDataFrame([], columns).schema
                return normalize_nulls(read_records(spark, path, found, columns, CSV_QUOTING))
        return normalize_nulls(reader.csv(path))
    if kind == "parquet":
        return spark.read.parquet(path)
    raise ValueError(f"unsupported format: {kind}")


def normalize_column_names(df: DataFrame) -> DataFrame:
    """CLN1: strip, lower-case, spaces to underscores; two columns mapping to one name raise."""
    names = [c.strip().lower().replace(" ", "_") for c in df.columns]
    if len(set(names)) != len(names):
        dup = sorted({n for n in names if names.count(n) > 1})
        raise ValueError(f"column names collide after cleaning: {dup}")
    return df.toDF(*names)


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """CLN2: drop rows equal in every column (null equals null)."""
    return df.dropDuplicates()


def basic_clean(df: DataFrame) -> DataFrame:
    return drop_exact_duplicates(normalize_column_names(df))


def union_frames(frames) -> DataFrame:
    """UNI1: bag union by column name; columns missing on one side become null."""
    frames = list(frames)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def load_bulk(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """SRC6: bulk CSV load with basic cleaning; dedupe is global (not per chunk)."""
    if detect_format(path) != "csv":
        raise ValueError("bulk load reads CSV only")
    return basic_clean(load_file(spark, path, "csv", schema))


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by=None, single_file: bool = False) -> str:
    writer_df = df.coalesce(1) if single_file else df
    w = writer_df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        (w.option("header", True).options(**CSV_QUOTING).option("ignoreLeadingWhiteSpace", False)
         .option("ignoreTrailingWhiteSpace", False).csv(path))
    elif fmt == "parquet":
        w.parquet(path)
    else:
        raise ValueError(f"unsupported sink format {fmt}")
    return path


def write_segmented(df: DataFrame, out_dir: str, run_date=None, fmt: str = "parquet",
                    drop_pii: bool = False) -> str:
    """SNK1: ``employers_segmented_YYYYMMDD`` (overwritten per run date); optionally without PII columns."""
    run_date = run_date or _dt.date.today()
    if drop_pii:
        df = df.drop(*[c for c in C.EMPLOYER_PII_COLUMNS if c in df.columns])
    path = f"{out_dir.rstrip('/')}/employers_segmented_{run_date:%Y%m%d}"
    return write_table(df, path, fmt)


def write_profiles(df: DataFrame, out_dir: str, fmt: str = "csv") -> str:
    """SNK2: ``segment_profiles`` (at most 4 rows, written as one file)."""
    return write_table(df, f"{out_dir.rstrip('/')}/segment_profiles", fmt, single_file=True)
