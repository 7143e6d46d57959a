"""Benchmark decontamination by spaced-seed hashing, in DataFrame functions only.

A document leaks an item if some 13 consecutive words of the item stand at 13 consecutive places of the document with
at least 11 words equal (lower-cased words between white space). Of an item of 5 to 12 words all must stand there, one after
another; shorter ones are ordinary phrases and leak nothing. Two fixed masks of 6 out of 8 word positions find
the places: whichever 2 of 13 words are substituted, one of the masks fits somewhere between them, so no leak is
missed. The hashes of the masked words of all benchmark places are joined with those of all document places, and
every hit is verified on the spot against the words around it, before anything is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from accountlens.llm.common import free_name, stratum, table

#: Word positions that a seed looks at. Lossless for WINDOW words with WINDOW - LEAST substitutions.
MASKS = ((0, 1, 2, 4, 6, 7), (0, 1, 4, 5, 6, 7))
SPAN = 8
WINDOW = 13
LEAST = 11
#: Words of the shortest item that can leak, and of the unmasked seed that finds items shorter than a window.
SHORTEST = 5
#: Benchmark places (a hash, at most 18 word hashes and three numbers, under 250 bytes each) up to which their table
#: is broadcast; it is counted first. Beyond it the hashes meet in a shuffled join, with the same result.
BROADCAST_PLACES = 400_000


def _word_hashes(text: Column) -> Column:
    words = F.array_remove(F.split(F.lower(text), "[\\x20\\x09-\\x0D]+"), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _seeds(words: Column, at: Column) -> Column:
    """The hashes of all masks at 0-based word ``at``."""
    return F.array(*[F.xxhash64(F.lit(m), *[F.get(words, at + p) for p in mask]) for m, mask in enumerate(MASKS)])


def _places(rows: DataFrame) -> DataFrame:
    """One row for each word position at which a seed fits; ``words`` and the other columns stay."""
    fits = F.when(F.size("words") >= SPAN, F.sequence(F.lit(0), F.size("words") - SPAN))
    return rows.withColumn("at", F.explode(fits))


def benchmark_places(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """seed, item_id, and the word hashes around each place: ``around``, of which ``lead`` stand before the place."""
    rows = items.select(F.col(id_col).alias("item_id"), _word_hashes(F.col(text_col)).alias("words"))
    places = _places(rows.where(F.size("words") >= WINDOW)).select(
        "item_id", "words", "at", F.greatest(F.col("at") - (WINDOW - SPAN), F.lit(0)).alias("begin"))
    # equal surroundings, as of a word that an item repeats, are compared once
    return places.select(
        "item_id", (F.col("at") - F.col("begin")).alias("lead"),
        F.slice("words", F.col("begin") + 1, F.col("at") + WINDOW - F.col("begin")).alias("around"),
        F.explode(_seeds(F.col("words"), F.col("at"))).alias("seed")).distinct()


def _run(words: Column, at: Column) -> Column:
    """The hash of the ``SHORTEST`` words from 0-based word ``at``."""
    return F.xxhash64(F.lit(len(MASKS)), *[F.get(words, at + p) for p in range(SHORTEST)])


def _found_places(rows: DataFrame, seeds: DataFrame, known: DataFrame, broadcast: bool) -> DataFrame:
    """``seeds`` (row, words, at, seed) joined with ``known`` on the seed. Beyond the broadcast the words stay behind: only row,
    place and seed are shuffled, and the words are fetched for the rows with a hit."""
    if broadcast:
        return seeds.join(F.broadcast(known), "seed")
    return seeds.drop("words").join(known, "seed").join(rows.dropDuplicates(["row"]), "row")


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, item_id, overlap (most equal words of a window, at least 11 of 13, or all of a short item), first_word and
    last_word (0-based, of all leaking windows) for every document and item that leaks into it. Windows lie inside the text.

    Documents without a leak have no row. Null or blank texts, and items of fewer than 5 words, leak nothing.
    Rows that share an id are judged together. Other columns are not looked at. An empty table gives no rows.
    """
    known = benchmark_places(items)
    short = items.select("item_id", _word_hashes(F.col("text")).alias("item"))
    short = short.where(F.size("item").between(SHORTEST, WINDOW - 1)).distinct()
    few, any_short = known.count() <= BROADCAST_PLACES, short.count()
    # a row is known by its id and text: equal rows are one, and different texts of one id stay apart
    row = F.struct(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text"))
    rows = docs.select(row.alias("row"), _word_hashes(F.col(text_col)).alias("words"))
    seeds = _places(rows).select("row", "words", "at", F.explode(_seeds(F.col("words"), F.col("at"))).alias("seed"))
    # the windows around a hit are rows, and the comparison is spelled out, so that it stays in generated code
    hits = _found_places(rows, seeds, known, few).select(
        "row", "item_id", "words", "around", (F.col("at") - F.col("lead")).alias("begin"),
        F.explode(F.sequence(F.lit(0), F.size("around") - WINDOW)).alias("skip")).where(
        "begin + skip >= 0 AND begin + skip + %d <= size(words)" % WINDOW)
    same = lambda k: F.get("words", F.col("begin") + F.col("skip") + k).eqNullSafe(F.get("around", F.col("skip") + k))
    overlap = sum((same(k).cast("int") for k in range(1, WINDOW)), same(0).cast("int"))
    found = hits.select("row", "item_id", (F.col("begin") + F.col("skip")).alias("start"), overlap.alias("overlap"),
                        F.lit(WINDOW).alias("length")).where(F.col("overlap") >= LEAST)
    if any_short:
        runs = rows.withColumn("at", F.explode(F.when(F.size("words") >= SHORTEST,
                                                      F.sequence(F.lit(0), F.size("words") - SHORTEST))))
        runs = runs.select("row", "words", "at", _run(F.col("words"), F.col("at")).alias("seed"))
        started = short.withColumn("seed", _run(F.col("item"), F.lit(0)))
        whole = _found_places(rows, runs, started, any_short <= BROADCAST_PLACES).where(
            F.slice("words", F.col("at") + 1, F.size("item")) == F.col("item"))
        found = found.unionByName(whole.select("row", "item_id", F.col("at").alias("start"), F.size("item").alias("overlap"),
                                               F.size("item").alias("length")))
    return found.groupBy(F.col("row.doc_id").alias("doc_id"), "item_id").agg(
        F.max("overlap").alias("overlap"), F.min("start").alias("first_word"),
        F.max(F.col("start") + F.col("length") - 1).alias("last_word"))


def remove_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that leak an item; all columns stay. A null id does not matter: rows are told apart
    by id and text, and equal texts are judged alike."""
    key, digest = free_name(docs, "__key"), free_name(docs, "__digest")
    keyed = docs.withColumn(key, stratum(F.col(id_col))).withColumn(digest, F.xxhash64(text_col))
    named = keyed.select(F.struct(key, digest).alias("row"), F.col(text_col).alias("words"))
    leaking = leaks(named, items, "row", "words").select(F.col("doc_id")[key].alias(key), F.col("doc_id")[digest].alias(digest))
    return keyed.join(leaking.distinct(), [key, digest], "left_anti").select(*docs.columns)


def leaked_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op5: every document and benchmark item that leaks into it."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE_SQL = f"""WITH dw AS (
  SELECT doc_id, len(ws) AS n, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS p
  FROM (SELECT doc_id, regexp_extract_all(lower(text), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents)
), bw AS (
  SELECT item_id, len(ws) AS m, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS q
  FROM (SELECT item_id, regexp_extract_all(lower(text), '[^\\x20\\x09-\\x0D]+') AS ws FROM benchmark)
), lines AS (
  SELECT doc_id, item_id, n, m, p - q AS d, list(q) AS qs FROM dw JOIN bw USING (w) WHERE m >= {SHORTEST}
  GROUP BY ALL HAVING count(*) >= least(m, {LEAST})
), windows AS (
  SELECT doc_id, item_id, n, d + s AS start, least(m, {WINDOW}) AS size,
         len(list_filter(qs, lambda q: q >= s AND q < s + {WINDOW})) AS overlap
  FROM (SELECT *, unnest(range(0, greatest(m - {WINDOW}, 0) + 1)) AS s FROM lines)
)
SELECT doc_id, item_id, max(overlap)::INTEGER AS overlap, min(start)::INTEGER AS first_word,
       max(start + size - 1)::INTEGER AS last_word
FROM windows WHERE start >= 0 AND start + size <= n AND overlap >= if(size < {WINDOW}, size, {LEAST})
GROUP BY doc_id, item_id"""
