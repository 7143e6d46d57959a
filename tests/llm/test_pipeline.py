"""The pipeline and the registered queries on given tables."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from accountlens.llm import catalog, mixing, quality_rules, simhash, toxicity
from accountlens.llm.common import DOCUMENT_COLUMNS

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered_once():
    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11)) and "pipeline" in entry.queries()
    assert set(catalog.ORACLE) <= set(catalog.QUERIES)


def slow_pipeline(docs, items):
    """The kept ids after each stage but the last two, by brute force."""
    kept = [d for d in docs if not sum(
        1 << i for i, (_, c) in enumerate(quality_rules.RULES)
        if eval(c, {}, dict(zip(quality_rules.MEASURES, quality_rules.measure(d[1])))))]
    by_quality = {d[0] for d in kept}
    prints = {d[0]: simhash.fingerprint(d[1]) for d in kept}
    head = {}
    for i in sorted(prints):
        group, todo = {i}, [i]
        while todo:
            a = todo.pop()
            near = {b for b in prints if b not in group and (prints[a] ^ prints[b]).bit_count() <= 3}
            group |= near
            todo += near
        head[i] = min(group)
    first = {i for i in prints if head[i] == i}
    clean = set()
    for i, text in docs:
        if i in first:
            words = (text or "").lower().split()
            leak = False
            for item in items:
                other = item.lower().split()
                for s in range(len(other) - 12):
                    for p in range(-12, len(words)):
                        leak = leak or sum(0 <= p + k < len(words) and words[p + k] == other[s + k] for k in range(13)) >= 11
            if not leak:
                clean.add(i)
    return by_quality, first, clean


def test_pipeline_like_brute_force(spark, tmp_path):
    rng = random.Random(31)
    word = lambda: "".join(rng.choice("abcdefghijk") for _ in range(4))
    items = [" ".join(word() for _ in range(16)) for _ in range(3)]
    docs = []
    for i in range(70):
        words = [word() for _ in range(rng.randint(15, 60))]
        if i % 7 == 0:
            words[5:5] = items[i % 3].split()
        if i % 11 == 0 and docs:
            docs.append((i, rng.choice(docs)[1]))
            continue
        docs.append((i, " ".join(words)))
    docs += [(70, None), (71, "")]
    table = spark.createDataFrame(docs, "doc_id long, text string").select(
        "doc_id", "text", F.lit("en").alias("lang"), F.concat(F.lit("s"), F.col("doc_id") % 3).alias("source"),
        F.length("text").cast("long").alias("n_chars"))
    table.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    given, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, given, str(tmp_path))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == list(DOCUMENT_COLUMNS)
        out.write.parquet(f"{tmp_path}/stage{k}")
        given = spark.read.parquet(f"{tmp_path}/stage{k}")
        seen.append({r["doc_id"] for r in given.collect()})
        assert given.count() == len(seen[-1])
    expected = slow_pipeline(docs, items)
    assert seen[:3] == list(expected)
    assert seen[3] <= seen[2] and seen[4] == seen[3]
    final = corpus_pipeline.run(spark, str(tmp_path))
    assert {r["doc_id"] for r in final.collect()} == seen[4]


def test_a_clean_text_is_not_dropped_for_its_length(spark):
    text = " ".join(f"word{i}" for i in range(1_000_001))
    given = spark.createDataFrame([(1, text, "en", "a", len(text)), (2, "too short", "en", "a", 9)],
                                  "doc_id long, text string, lang string, source string, n_chars long")
    assert [r["doc_id"] for r in corpus_pipeline.quality(spark, given, "").select("doc_id").collect()] == [1]
    failed = quality_rules.with_ledger(given.where("doc_id = 1"), "ledger").select("ledger.fail_bits").first()[0]
    assert failed == quality_rules.BIT["too_long"]


def test_mix_and_shards_keep_every_row_in_the_order_of_the_schedule(spark, tmp_path):
    rng = random.Random(5)
    sizes = {"hot": 6_000, "b": 2_500, "c": 1_400, None: 1}  # a source of one row ends phase 0 early
    rows = [(i, f"t{i}", "en", s, 1) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    rows += rows[:40] + [(None, "x", "en", "hot", 1)] * 3
    rng.shuffle(rows)
    given = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(7)
    corpus_pipeline.mix(spark, given, "").write.parquet(f"{tmp_path}/mixed")
    mixed = spark.read.parquet(f"{tmp_path}/mixed")
    bag = lambda df: sorted(map(repr, df.select(*given.columns).collect()))
    assert bag(mixed) == bag(given)
    files = [r[0] for r in mixed.select("_metadata.file_name").distinct().orderBy("file_name").collect()]
    assert len(files) == 2
    filed = [r["source"] for f in files for r in spark.read.parquet(f"{tmp_path}/mixed/{f}").coalesce(1).collect()]
    out = corpus_pipeline.shard(spark, mixed, "")
    assert bag(out) == bag(given)
    dealt = sorted(out.collect(), key=lambda r: (r["slot"], r["shard"]))
    assert [(r["slot"], r["shard"]) for r in dealt] == [divmod(p, 16) for p in range(len(rows))]
    assert [r["source"] for r in dealt] == filed
    # brute force: the schedule's blocks, one after the other, from the sizes alone
    have = {s: sum(r[3] == s for r in rows) for s in sizes}
    name = {s: "null" if s is None else f"={s}" for s in sizes}
    back = {v: k for k, v in name.items()}
    expected = []
    for k, j, _ in mixing.schedule({name[s]: -(-n // 64) for s, n in have.items()}, {name[s]: n ** 0.7 for s, n in have.items()}):
        expected += [back[k]] * min(64, have[back[k]] - 64 * j)
    assert filed == expected


def test_shards_follow_the_order_that_the_mix_wrote(spark, tmp_path):
    """The last stage deals out what it is given, so another mix gives other shards."""
    given = spark.range(0, 4_000, numPartitions=1).select(
        ((F.col("id") * 1_367 + 5) % 4_000).alias("doc_id"), F.lit("t").alias("text"), F.lit("en").alias("lang"),
        F.concat(F.lit("s"), F.col("id") % 3).alias("source"), F.lit(1).cast("long").alias("n_chars"))
    order = [(i * 1_367 + 5) % 4_000 for i in range(4_000)]
    dealt = lambda df: [r["doc_id"] for r in sorted(df.collect(), key=lambda r: (r["slot"], r["shard"]))]
    places = lambda df: sorted((r["slot"], r["shard"]) for r in df.collect())
    # files of unequal sizes, several of one task, more than one digit long
    (given.withColumn("part", F.floor(F.sqrt(F.monotonically_increasing_id())).cast("int"))
     .repartitionById(64, F.col("part")).drop("part").write.option("maxRecordsPerFile", 37).parquet(f"{tmp_path}/mixed"))
    mixed = spark.read.parquet(f"{tmp_path}/mixed")
    assert len(mixed.inputFiles()) > 100
    out = corpus_pipeline.shard(spark, mixed, "")
    assert dealt(out) == order and places(out) == [divmod(p, 16) for p in range(4_000)]
    # some rows left out, rows twice, rows of no file
    some = corpus_pipeline.shard(spark, mixed.where("doc_id % 3 > 0"), "")
    assert dealt(some) == [i for i in order if i % 3] and places(some) == [divmod(p, 16) for p in range(len(dealt(some)))]
    twice = corpus_pipeline.shard(spark, mixed.withColumn("k", F.explode(F.array(F.lit(1), F.lit(2)))).drop("k"), "")
    assert dealt(twice) == [i for i in order for _ in range(2)] and places(twice) == [divmod(p, 16) for p in range(8_000)]
    made = corpus_pipeline.shard(spark, spark.createDataFrame([(i, "t", "en", "a", 1) for i in order], given.schema), "")
    assert dealt(made) == order


def test_stages_take_an_empty_table_and_extra_columns(spark, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long, phase int, "
                                      "slot int, __key string, words string")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, empty, str(tmp_path))
        assert out.count() == 0 and (k == 4 or out.columns == empty.columns)


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.1"])
def test_toxicity_on_held_out_labels(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = toxicity.training_rows(docs, labels)
    model = toxicity.fit([t for _, t, _ in rows], [y for _, _, y in rows])
    judged = toxicity.score_documents(docs.join(labels.select("doc_id"), "doc_id", "left_semi").repartition(8), model)
    got = judged.where("held_out").join(labels, "doc_id").select("toxic", "score").collect()
    bad, clean = ([r["score"] for r in got if r["toxic"] == y] for y in (1, 0))
    wins = sum((x > y) + (x == y) / 2 for x in bad for y in clean)
    # measured here: area 0.95, recall 0.78, false positives 0.005; insults outside English are rare and word-like
    assert wins >= 0.93 * len(bad) * len(clean)
    assert sum(x >= 0.7 for x in bad) >= 0.7 * len(bad)
    assert sum(x >= 0.7 for x in clean) <= 0.01 * len(clean)


def test_default_weights_follow_the_sizes(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes = mixing.source_sizes(docs, limit=3)
    assert len(sizes) == 4 and sum(sizes.values()) == docs.count() and mixing.POOL in sizes
