"""Incremental interaction ingest (EXT4): daily batches append only unseen interaction ids.

Batch form: the existing table is scanned for its id column only and semi-joined
with the (small) incoming batch, so the history is never shuffled in full: AQE
broadcasts the incoming ids when their measured size allows it, else both sides
shuffle on the id. The incoming batch is then anti-joined with the few ids found.

Streaming form: a file-source ``readStream``, stateful removal of rows delivered
again within a span of time, and ``foreachBatch`` running the same dedupe against
the whole target, with an ``availableNow`` trigger; the checkpoint remembers
processed files and the state, the dedupe makes a re-delivered batch a no-op.

``keyindex.IndexedFact`` is the target whose files are indexed by their keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accountlens.session import materialize


def free_name(df: DataFrame, base: str) -> str:
    """``base``, lengthened until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def keyless_rows(incoming: DataFrame, key: str = "interaction_id") -> DataFrame:
    """Rows without a key: they cannot be told apart from re-delivered ones and belong in quarantine."""
    return incoming.where(F.col(key).isNull())


def new_rows(incoming: DataFrame, existing: DataFrame | None, key: str = "interaction_id") -> DataFrame:
    """Rows of ``incoming`` whose key is neither null nor in ``existing``, one for each key.

    Of different rows with one key the least is taken, compared column by column in the order of the batch
    (nulls first), so the choice does not depend on how the batch is partitioned.
    """
    others = [c for c in incoming.columns if c != key]
    keyed = incoming.where(F.col(key).isNotNull())
    batch = keyed.groupBy(key).agg(F.min(F.struct(*others)).alias("row")) if others else keyed.distinct()
    if others:
        batch = batch.select(key, "row.*").select(*incoming.columns)
    if existing is None:
        return batch
    batch = materialize(batch)  # used twice below: the incoming rows are read and compared once
    seen = existing.select(key).join(batch.select(key), key, "left_semi").distinct()
    return batch.join(seen, key, "left_anti")


def table_exists(spark: SparkSession, path: str) -> bool:
    from accountlens.sources.files import path_exists
    return path_exists(spark, path.rstrip("/") + "/_SUCCESS") or path_exists(spark, path.rstrip("/") + "/*.parquet")


def quarantine(spark: SparkSession, rows: DataFrame, path: str) -> None:
    rows = rows.distinct()
    if table_exists(spark, path):
        rows = rows.exceptAll(spark.read.parquet(path).select(*rows.columns))
    rows = materialize(rows)
    if not rows.isEmpty():
        rows.write.mode("append").parquet(path)


def append_new(spark: SparkSession, incoming: DataFrame, target_path: str, key: str = "interaction_id",
               partition_by=None) -> int:
    """Append the unseen rows of ``incoming`` to the parquet table at ``target_path``; returns the count appended.

    Rows without a key go to ``<target_path>_quarantine``, the same row once however often it is delivered.
    """
    quarantine(spark, keyless_rows(incoming, key), target_path.rstrip("/") + "_quarantine")
    existing = spark.read.parquet(target_path) if table_exists(spark, target_path) else None
    fresh = new_rows(incoming, existing, key)
    # materialise once so the count and the write agree even if the target changes meanwhile
    fresh = materialize(fresh)
    n = fresh.count()
    if n:
        w = fresh.write.mode("append")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(target_path)
    return n


def stream_ingest(spark: SparkSession, source_dir: str, schema, target_path: str, checkpoint: str | None = None,
                  key: str = "interaction_id", fmt: str = "parquet", redelivery: str = "1 day",
                  files_per_batch: int | None = None, indexed: bool = False):
    """Process every file that arrived in ``source_dir`` since the last run, then stop (``availableNow``).

    Rows that are delivered again within ``redelivery`` of their first arrival are dropped by the stream's state: it holds a
    key and a row hash for each row of that span, and survives a restart in the checkpoint. Arrival is the time of the
    micro-batch, so rows that come late or out of order by their own dates are never too late. Behind it, every batch
    is compared with the whole target, which drops what is delivered again after any time, and settles different rows of one
    key. ``indexed``: the target is an ``IndexedFact`` by month, of which only files that may hold the keys are read.
    """
    # beside the target, so that a restarted session finds the offsets again
    ckpt = checkpoint or target_path.rstrip("/") + "_checkpoint"
    stream = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        stream = stream.option("header", True)
    if files_per_batch:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)
    src = stream.load(source_dir)
    columns = src.columns
    arrived, content = free_name(src, "__arrived"), free_name(src, "__row")
    once = (src.withColumn(arrived, F.current_timestamp()).withColumn(content, F.xxhash64(*columns))
            .withWatermark(arrived, redelivery).dropDuplicatesWithinWatermark([key, content]).select(*columns))

    def handle(batch_df: DataFrame, batch_id: int) -> None:
        session = batch_df.sparkSession
        batch_df = materialize(batch_df)  # several actions follow: files are read and the state is stepped once
        if indexed:
            from accountlens.streaming.keyindex import IndexedFact
            IndexedFact(session, target_path, key).append(batch_df)
        else:
            append_new(session, batch_df, target_path, key)

    q = (once.writeStream.foreachBatch(handle).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
