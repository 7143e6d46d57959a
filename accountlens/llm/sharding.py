"""Sharding by proportional stratified interleaving, in DataFrame functions only.

Rows of each source are put in a seeded random order; the row of rank r among the n rows of its source gets the
fraction (2r + 1) / 2n. Sorted by that fraction the sources interleave in proportion, and the sorted sequence is cut
into shards of equal row counts, so that each shard holds the mixture of the whole.

Neither order is made in one task: ranks come from (source, key range) buckets and positions from fraction buckets
whose offsets follow from the source sizes alone (see ``_bucket_offsets``), so rows are shuffled twice, whatever
the number of sources or the share of the largest one.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from accountlens.llm.common import RANK_BUCKET_ROWS, free_name, ranked, running_offsets, shuffle_key, stratum, table
from accountlens.session import materialize, scratch_path

SEED = 20
SHARDS = 16
#: Files up to which their offsets are broadcast (a path and an integer a row).
BROADCAST_FILES = 200_000


def _bucket_offsets(sizes: DataFrame, size_col: str, buckets: int) -> DataFrame:
    """Rows before each fraction bucket, from the source sizes alone: columns ``bucket`` and ``before``.

    Rank r of n lies in bucket ((2r+1) * B) div 2n, so the first rank at or beyond bucket b is
    (2nb + B - 1) div 2B. A source of at most B rows lists its ranks, a larger one the buckets and their counts.
    """
    listed = sizes.select(
        F.col(size_col).alias("n"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.least(F.col(size_col), F.lit(buckets)) - 1)).alias("i"))
    counts = listed.select(
        F.expr(f"if(n <= {buckets}, ((2 * i + 1) * {buckets}) div (2 * n), i)").alias("bucket"),
        F.expr(f"if(n <= {buckets}, 1L, (2 * n * (i + 1) + {buckets - 1}) div {2 * buckets}"
               f" - (2 * n * i + {buckets - 1}) div {2 * buckets})").alias("rows"))
    per_bucket = counts.groupBy("bucket").agg(F.sum("rows").alias("rows"))
    return running_offsets(per_bucket, "bucket", "rows", "before").select("bucket", "before")


def assign_shards(rows: DataFrame, shards: int = SHARDS, seed: int = SEED, id_col: str = "doc_id",
                  source_col: str = "source", bucket_rows: int = RANK_BUCKET_ROWS) -> DataFrame:
    """Append ``shard`` (0..shards-1) and ``slot`` (0, 1, ... in each shard) to every row.

    Shard sizes differ by one row at most. All columns are kept; input columns called shard or slot are replaced.
    A null source is a stratum of its own. Rows with one id share a seeded key and are ordered by a hash of all
    their columns; fully equal rows are interchangeable. An empty table gives an empty result.
    """
    total = rows.count()
    buckets = max(1, -(-total // bucket_rows))
    rows = rows.drop("shard", "slot")
    names = {n: free_name(rows, n) for n in ("__stratum", "__key", "__tie", "__rank", "__size", "__fraction", "__part", "__before",
                                             "__position")}
    before, at = names["__before"], names["__position"]
    part, fraction = names["__part"], names["__fraction"]
    strata = rows.select(stratum(F.col(source_col)).alias("stratum")).groupBy("stratum").agg(F.count(F.lit(1)).alias("n"))
    keyed = (rows.withColumn(names["__tie"], F.xxhash64(*rows.columns))
             .withColumn(names["__stratum"], stratum(F.col(source_col)))
             .withColumn(names["__key"], shuffle_key(seed, F.col(id_col))))
    placed = ranked(keyed, names["__stratum"], names["__key"], [names["__tie"]], names["__rank"], names["__size"], total,
                    bucket_rows)
    placed = (placed
              .withColumn(part, F.expr(f"((2 * `{names['__rank']}` + 1) * {buckets}) div (2 * `{names['__size']}`)"))
              .withColumn(fraction, (2 * F.col(names["__rank"]) + 1).cast("double") / (2 * F.col(names["__size"]))))
    starts = _bucket_offsets(strata, "n", buckets).select(F.col("bucket").alias(part), F.col("before").alias(before))
    order = Window.partitionBy(part).orderBy(fraction, names["__key"], names["__stratum"], names["__tie"])
    position = F.col(before) + F.row_number().over(order) - 1
    return (placed.join(starts, part)
            .withColumn(at, position)
            .withColumn("shard", F.expr(f"(`{at}` * {shards}) div {max(total, 1)}").cast("int"))
            .withColumn("slot", F.col(at) - F.expr(f"(shard * {total}L + {shards - 1}) div {shards}"))
            .drop(*names.values()))


def deal(rows: DataFrame, position_col: str, shards: int = SHARDS) -> DataFrame:
    """Append ``shard`` and ``slot`` to rows that have an order: the row at position p (0, 1, ... without gaps) gets
    shard p % shards and slot p div shards, so that the order is that by (slot, shard), every shard is in it, and shard
    sizes differ by one row at most. Input columns called shard or slot are replaced; the position is dropped."""
    position = free_name(rows, "__position")
    return (rows.withColumnRenamed(position_col, position).drop("shard", "slot")
            .withColumn("shard", F.expr(f"`{position}` % {shards}").cast("int"))
            .withColumn("slot", F.expr(f"`{position}` div {shards}")).drop(position))


def _written(rows: DataFrame) -> DataFrame:
    path = scratch_path(rows.sparkSession, "row-order")
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def _file_offsets(files: DataFrame) -> DataFrame:
    """``path`` and ``before``, the rows of all earlier files: by the number that Spark's writer gave (others first), then by
    path. ``files``: path, name, size."""
    numbered = files.withColumn("number", F.coalesce(F.regexp_extract("name", "^part-([0-9]+)", 1).try_cast("long"), F.lit(-1)))
    starts = running_offsets(numbered.groupBy("number").agg(F.sum("size").alias("rows")), "number", "rows", "start")
    up_to = Window.partitionBy("number").orderBy(F.length("path"), "path").rowsBetween(Window.unboundedPreceding, 0)
    inside = numbered.withColumn("inside", F.sum("size").over(up_to) - F.col("size"))
    return inside.join(starts.select("number", "start"), "number").select("path", (F.col("start") + F.col("inside")).alias("before"))


def in_file_order(rows: DataFrame, position_col: str) -> DataFrame:
    """Append the place of every row, 0, 1, ... without gaps, in the order of the Parquet files that ``rows`` was read from:
    by the number in the file's name, then by the row's index in the file.

    A reader may return files and their splits in any order, so both are taken from the file metadata of each row.
    If some rows of the files are left out or repeated, the rest is written in their order first; rows that come from no
    Parquet file are written as they stand. An empty table gives an empty result.
    """
    path, name, index, before = (free_name(rows, n) for n in ("__path", "__name", "__index", "__before"))
    try:
        file = rows.metadataColumn("_metadata")
        placed = rows.select("*", file["file_path"].alias(path), file["file_name"].alias(name), file["row_index"].alias(index))
    except AnalysisException:
        return in_file_order(_written(rows), position_col)
    files = materialize(placed.groupBy(F.col(path).alias("path"), F.col(name).alias("name"))
                        .agg((F.max(index) + 1).alias("size"), F.count(F.lit(1)).alias("rows"), F.sum(index).alias("indexes")))
    whole = (F.col("rows") == F.col("size")) & (2 * F.col("indexes") == F.col("size") * (F.col("size") - 1))
    all_whole, count = files.agg(F.bool_and(whole), F.count(F.lit(1))).first()
    starts = _file_offsets(files).select(F.col("path").alias(path), F.col("before").alias(before))
    placed = (placed.join(F.broadcast(starts) if count <= BROADCAST_FILES else starts, path)
              .withColumn(position_col, F.col(before) + F.col(index)).drop(path, name, index, before))
    if all_whole is False:
        ordered = placed.repartitionByRange(position_col).sortWithinPartitions(position_col).drop(position_col)
        return in_file_order(_written(ordered), position_col)
    return placed


def sharded_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op2: every document's shard and slot, law ``rows``."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"))
    return assign_shards(docs).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "source")


#: CRC-32 of a text in plain SQL: the 256-entry table by its rule, then one fold over the bytes.
CRC32_SQL = """crc_steps AS (
  SELECT range AS i, 0 AS k, range AS v FROM range(256)
  UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM crc_steps WHERE k < 8
), crc_table AS (SELECT list(v ORDER BY i) AS t FROM crc_steps WHERE k = 8)"""


def crc32_sql(hex_text: str) -> str:
    """SQL for the CRC-32 of the bytes whose hexadecimal form is ``hex_text``; needs ``t`` of crc_table in scope."""
    codes = f"list_transform(range(1, length({hex_text}) + 1, 2), lambda p: ('0x' || substr({hex_text}, p, 2))::BIGINT)"
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), "
            "lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1]::BIGINT)), 4294967295)")


ORACLE_SQL = f"""WITH RECURSIVE {CRC32_SQL},
d AS (SELECT doc_id, source, md5('{SEED}:' || doc_id) AS k, coalesce(hex(encode(text)), '') AS h,
             coalesce(strlen(text), 0) + 1 AS size FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY k) - 1 AS r,
             count(*) OVER (PARTITION BY source) AS n FROM d),
p AS (SELECT *, row_number() OVER (ORDER BY (2 * r + 1)::DOUBLE / (2 * n), k) - 1 AS pos, count(*) OVER () AS total FROM r),
s AS (SELECT *, (pos * {SHARDS}) // total AS shard FROM p)
SELECT doc_id, size::BIGINT AS size, {crc32_sql('h')} AS text_crc32, 'rows' AS law, shard::INTEGER AS shard,
       (row_number() OVER (PARTITION BY shard ORDER BY pos) - 1)::BIGINT AS slot, NULL::INTEGER AS grown_shard, source
FROM s, crc_table"""
