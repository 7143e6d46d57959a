"""A fact table by month whose files are indexed by their keys (EXT4): a batch is compared only with files that may hold its keys.

Beside the table lies one small table with a row for each of its files: the number of rows and the least and greatest key. A
batch's keys are marked against these intervals on executors, and only files in whose interval some key falls are opened,
for their key column alone. Keys that grow with time (numbers, ULIDs, dated ids) thus meet the files of their days, and late
or repeated ones the few old files that may hold them; no key is ever assumed to be new. Keys without order fall into most intervals:
then a batch of few keys is pushed to the scan as a list, where Parquet's bloom filters, written for the key column, skip row
groups, and any other batch reads the key column of all files, as without an index.

The index follows the table: files that it does not name, whoever wrote them, are indexed before the next comparison, and
rows of files that are gone are ignored. So a run that fails between writing the table and the index loses nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import unquote

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accountlens.session import materialize
from accountlens.streaming.incremental import keyless_rows, new_rows, quarantine, table_exists

#: Distinct keys up to which a batch is pushed to the scan as a list (they are counted first; beyond, the result is the same).
LISTED_KEYS = 1000
IN_LIMIT = "spark.sql.parquet.pushdown.inFilterThreshold"


class IndexedFact:
    """The fact at ``path``, partitioned by ``month`` (year * 100 + month of ``date_col``, null for a null date)."""

    def __init__(self, spark: SparkSession, path: str, key: str = "interaction_id", date_col: str = "interaction_date",
                 month_col: str = "month"):
        self.spark, self.path, self.key, self.date_col, self.month_col = spark, path.rstrip("/"), key, date_col, month_col
        self.index_path = self.path + "_keys"

    def read(self) -> DataFrame | None:
        return self.spark.read.parquet(self.path) if table_exists(self.spark, self.path) else None

    def _files(self, paths: list[str]) -> DataFrame:
        return self.spark.read.option("basePath", self.path).parquet(*[unquote(p) for p in paths])

    def index(self) -> pd.DataFrame:
        """path, keys, least and most of every file that the table has; new files are indexed first.

        The driver holds a row a file, as Spark's own list of the table's files does. Files go by month folder and name,
        which no two of them share; the store's address may be spelt in several ways.
        """
        columns = ["file", "keys", "least", "most"]
        table = self.read()
        there = {"/".join(p.split("/")[-2:]): p for p in (table.inputFiles() if table is not None else [])}
        if not there:
            return pd.DataFrame(columns=[*columns, "path"])
        known = (self.spark.read.parquet(self.index_path).select(*columns).toPandas().drop_duplicates("file")
                 if table_exists(self.spark, self.index_path) else pd.DataFrame(columns=columns))
        known = known[known["file"].isin(there)]
        missing = sorted(set(there) - set(known["file"]))
        if missing:
            name = F.regexp_extract("_metadata.file_path", "([^/]+/[^/]+)$", 1)
            added = (self._files([there[f] for f in missing]).groupBy(name.alias("file"))
                     .agg(F.count(self.key).alias("keys"), F.min(self.key).alias("least"), F.max(self.key).alias("most"))
                     .coalesce(1))
            added = materialize(added)
            added.write.mode("append").parquet(self.index_path)
            known = pd.concat([known, added.toPandas()]) if len(known) else added.toPandas()
        return known.assign(path=known["file"].map(there)).reset_index(drop=True)

    def files_with(self, batch: DataFrame) -> list[str]:
        """Files in whose interval of keys at least one key of the batch falls."""
        index = self.index()
        index = index[index["keys"] > 0]
        if index.empty:
            return []
        least, most, key = index["least"].to_numpy(), index["most"].to_numpy(), self.key

        def hit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            found = np.zeros(len(least), dtype=bool)
            for pdf in batches:
                keys = np.sort(pdf[key].to_numpy())
                at = np.searchsorted(keys, least)
                inside = at < len(keys)
                found[inside] |= keys[at[inside]] <= most[inside]
            yield pd.DataFrame({"file": np.flatnonzero(found)})

        keys = batch.select(key).where(F.col(key).isNotNull())
        files = [r["file"] for r in keys.mapInPandas(hit, "file long").distinct().collect()]
        return index["path"].iloc[sorted(files)].tolist()

    def _seen(self, batch: DataFrame) -> DataFrame | None:
        """The keys of the batch that the table has; None if no file may hold any."""
        files = self.files_with(batch)
        if not files:
            return None
        keys, own = self._files(files).select(self.key), batch.select(self.key)
        listed = [r[0] for r in own.limit(LISTED_KEYS + 1).collect()]
        if len(listed) > LISTED_KEYS:
            return keys.join(own, self.key, "left_semi").distinct()
        before = self.spark.conf.get(IN_LIMIT)
        self.spark.conf.set(IN_LIMIT, str(LISTED_KEYS))
        try:
            return materialize(keys.where(F.col(self.key).isin(listed)).distinct())
        finally:
            self.spark.conf.set(IN_LIMIT, before)

    def new(self, incoming: DataFrame) -> DataFrame:
        """Rows of ``incoming`` whose key is neither null nor in the table, one for each key (see ``new_rows``)."""
        batch = materialize(new_rows(incoming, None, self.key))
        seen = self._seen(batch)
        return batch if seen is None else batch.join(seen, self.key, "left_anti")

    def append(self, incoming: DataFrame) -> int:
        """Append the rows whose key is new; returns their number. Rows without a key go to ``<path>_quarantine``, once each.

        The same batch delivered again changes nothing. An empty batch writes nothing.
        """
        if self.month_col in incoming.columns:
            raise ValueError(f"the column {self.month_col} is made by the table")
        quarantine(self.spark, keyless_rows(incoming, self.key), self.path + "_quarantine")
        date = F.col(self.date_col)
        fresh = materialize(self.new(incoming).withColumn(self.month_col, F.year(date) * 100 + F.month(date)))
        n = fresh.count()
        if n:
            # ranges of (month, key): even tasks whatever the months, and files of narrow intervals
            (fresh.repartitionByRange(self.month_col, self.key).sortWithinPartitions(self.month_col, self.key)
             .write.mode("append")
             .option(f"parquet.bloom.filter.enabled#{self.key}", "true")
             .option(f"parquet.bloom.filter.expected.ndv#{self.key}", str(min(n, 10_000_000)))
             .partitionBy(self.month_col).parquet(self.path))
            self.index()
        return n
