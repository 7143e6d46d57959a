"""The fact whose files are indexed by their keys, and the stream in front of it (EXT4)."""

from __future__ import annotations

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from accountlens.streaming.incremental import append_new, stream_ingest
from accountlens.streaming.keyindex import IndexedFact

SCHEMA = "interaction_id string, interaction_date date, note string"
START = dt.date(2024, 1, 1)


def rows(spark, days, per_day=20, note="x", key=lambda day, i: f"{day:%Y%m%d}-{i:04d}"):
    """Dated ids, in an order that has nothing to do with the dates."""
    out = [(key(START + dt.timedelta(days=d), i), START + dt.timedelta(days=d), note) for d in days for i in range(per_day)]
    random.Random(1).shuffle(out)
    return spark.createDataFrame(out, SCHEMA)


def keys(df):
    return sorted(r[0] for r in df.select("interaction_id").collect())


def test_a_day_opens_few_files_and_loses_no_old_key(spark, tmpdir_path):
    fact = IndexedFact(spark, os.path.join(tmpdir_path, "a fact"))  # a blank in the path is encoded in the files' names
    for start in (0, 120):
        assert fact.append(rows(spark, range(start, start + 120))) == 2400
    files = len(fact.read().inputFiles())
    assert files >= 8 and len(fact.index()) == files == spark.read.parquet(fact.index_path).count()
    day = rows(spark, [240], note="y").unionByName(rows(spark, [45], per_day=25, note="late"))  # five of them are new
    opened = fact.files_with(day)
    assert 1 <= len(opened) <= files / 8
    full = day.join(fact.read().select("interaction_id"), "interaction_id", "left_anti")
    assert keys(fact.new(day)) == keys(full) and full.count() == 25
    scanned = fact._files(opened).select("interaction_id")
    assert sorted(scanned.inputFiles()) == sorted(opened)
    assert fact.append(day) == 25 and fact.append(day) == 0
    table = fact.read()
    assert table.count() == 4800 + 25 == table.select("interaction_id").distinct().count()
    assert table.where("note = 'late'").count() == 5
    assert {r["month"] for r in table.where("note = 'late'").collect()} == {202402}


def test_keys_without_order_equal_the_full_comparison(spark, tmpdir_path):
    fact = IndexedFact(spark, os.path.join(tmpdir_path, "fact"))
    import hashlib

    def scrambled(day, i):
        return hashlib.md5(f"{day}{i}".encode()).hexdigest()

    fact.append(rows(spark, range(90), key=scrambled))
    few = rows(spark, [10, 200], per_day=3, key=scrambled)
    many = rows(spark, range(60, 130), per_day=30, key=scrambled)
    for batch in (few, many):
        expected = batch.join(fact.read().select("interaction_id"), "interaction_id", "left_anti")
        assert keys(fact.new(batch)) == keys(expected) and 0 < expected.count() < batch.count()


def test_files_of_others_and_files_that_are_gone(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "fact")
    fact = IndexedFact(spark, path)
    fact.append(rows(spark, [0]))
    # written past the index, as by a run that failed before indexing
    rows(spark, [1]).withColumn("month", F.lit(202401)).write.mode("append").partitionBy("month").parquet(path)
    assert fact.append(rows(spark, [0, 1, 2])) == 20
    gone = fact.read().inputFiles()[0]
    os.remove(gone.removeprefix("file://"))
    left = fact.read().count()
    assert fact.append(rows(spark, [0, 1, 2])) == 60 - left
    assert keys(fact.read()) == keys(rows(spark, [0, 1, 2]))


def test_null_keys_null_dates_empty_batches_and_other_types(spark, tmpdir_path):
    fact = IndexedFact(spark, os.path.join(tmpdir_path, "fact"))
    odd = spark.createDataFrame([(None, START, "no key"), (None, START, "no key"), ("k1", None, "no date"), ("k1", None, "no date"),
                                 ("k2", START, None)], SCHEMA)
    assert fact.append(odd) == 2 and fact.append(odd) == 0 and fact.append(odd.limit(0)) == 0
    table = {r["interaction_id"]: r["month"] for r in fact.read().collect()}
    assert table == {"k1": None, "k2": 202401}
    assert spark.read.parquet(fact.path + "_quarantine").count() == 1
    with pytest.raises(ValueError, match="month"):
        fact.append(odd.withColumn("month", F.lit(1)))
    numbers = IndexedFact(spark, os.path.join(tmpdir_path, "numbers"))
    longs = rows(spark, range(3)).withColumn("interaction_id", F.monotonically_increasing_id())
    assert numbers.append(longs) == 60 and numbers.append(longs.withColumn("interaction_id", F.col("interaction_id") + 1)) > 0
    assert numbers.files_with(spark.createDataFrame([(-5,)], "interaction_id long")) == []


def test_a_listed_batch_is_pushed_to_the_scan(spark, tmpdir_path):
    fact = IndexedFact(spark, os.path.join(tmpdir_path, "fact"))
    fact.append(rows(spark, range(60)))
    before = spark.conf.get("spark.sql.parquet.pushdown.inFilterThreshold")
    wanted = [f"{START:%Y%m%d}-{i:04d}" for i in range(0, 20, 2)]
    plan = fact.read().where(F.col("interaction_id").isin(wanted))._jdf.queryExecution().executedPlan().toString()
    assert "In(interaction_id" in plan
    assert fact.append(rows(spark, [0], per_day=40)) == 20
    assert spark.conf.get("spark.sql.parquet.pushdown.inFilterThreshold") == before
    import pyarrow.parquet as pq
    column = pq.ParquetFile(fact.read().inputFiles()[0].removeprefix("file://")).metadata.row_group(0).column(0)
    assert column.path_in_schema == "interaction_id" and column.statistics.has_min_max


@pytest.mark.parametrize("indexed", [False, True])
def test_stream_of_repeated_late_and_unordered_rows(spark, tmpdir_path, indexed):
    src, target = os.path.join(tmpdir_path, "in"), os.path.join(tmpdir_path, "fact")
    for days in ([5, 6], [6, 1], [0, 5]):  # rows again, and days out of order
        rows(spark, days).coalesce(1).write.mode("append").parquet(src)
    q = stream_ingest(spark, src, SCHEMA, target, files_per_batch=1, indexed=indexed)
    held = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert max(held) == 80  # each row once in the state
    assert len([p for p in q.recentProgress if p["numInputRows"]]) == 3
    # after a restart: the state knows the rows, and so does the table
    rows(spark, [1, 7]).coalesce(1).write.mode("append").parquet(src)
    q = stream_ingest(spark, src, SCHEMA, target, indexed=indexed)
    assert q.recentProgress[-1]["numInputRows"] in (0, 40)
    rows(spark, [0], note="another row of a known key").coalesce(1).write.mode("append").parquet(src)
    stream_ingest(spark, src, SCHEMA, target, indexed=indexed)
    stream_ingest(spark, src, SCHEMA, target, indexed=indexed)
    table = spark.read.parquet(target)
    assert keys(table) == keys(rows(spark, [0, 1, 5, 6, 7])) and table.where("note <> 'x'").isEmpty()


def test_a_lost_state_repeats_nothing(spark, tmpdir_path):
    """A new checkpoint delivers every file again: the comparison with the table still drops all of it."""
    src, target = os.path.join(tmpdir_path, "in"), os.path.join(tmpdir_path, "fact")
    rows(spark, [0, 1]).coalesce(1).write.parquet(src)
    stream_ingest(spark, src, SCHEMA, target, os.path.join(tmpdir_path, "one"))
    stream_ingest(spark, src, SCHEMA, target, os.path.join(tmpdir_path, "two"))
    assert spark.read.parquet(target).count() == 40


def test_null_keys_in_a_stream(spark, tmpdir_path):
    src, target = os.path.join(tmpdir_path, "in"), os.path.join(tmpdir_path, "fact")
    odd = spark.createDataFrame([(None, START, "a"), (None, START, "a"), (None, START, "b"), ("k", START, "c")], SCHEMA)
    odd.coalesce(1).write.parquet(src)
    stream_ingest(spark, src, SCHEMA, target)
    assert keys(spark.read.parquet(target)) == ["k"] and spark.read.parquet(target + "_quarantine").count() == 2
    assert append_new(spark, odd, target) == 0
