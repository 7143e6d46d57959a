"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints within 3 bits have a common variant: one flips at most 1 bit, the other at most 2, to meet there.
Flipping 2 of 64 bits gives 2,016 variants, so two things keep the emission small without losing a link.

* Parity: fingerprints at an odd distance have bit counts of different parity. Only those with an odd count emit
  the 2-bit variants; those with an even count emit themselves and their 1-bit variants. At an even centre all who
  meet are within 2 bits of each other. At an odd centre the even ones are within 2 bits of each other and within 3
  of every odd one. So all who meet are one group (at an odd centre: if an even one is among them), which links to
  its least member: no pair is listed, and a centre has at most 2,081 members by construction.
* Sieves: before that, fingerprints that share no variant of a part of their bits with another are put aside. Of
  two halves one differs by at most 1 bit; of three pairs of thirds one differs by at most 2. The parts are
  ball-hashed by the same rule at half that radius.

Work is done on distinct fingerprints; equal ones are one class from the start.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from accountlens.llm.common import free_name, ship_package, stratum, table
from accountlens.llm.components import components
from accountlens.session import materialize

SHINGLE = 3
RADIUS = 3
SEED = 42
#: Hashes turned into bits at once; bounds the memory that one long text takes.
CHUNK = 1 << 16
LOW_HALF = (1 << 32) - 1
THIRDS = ((1 << 21) - 1, ((1 << 21) - 1) << 21, ((1 << 22) - 1) << 42)


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """The unsigned 64-bit SimHash of all shingles of the text, repeats included; 0 for a text without a word."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z, only ASCII white space
    if not words:
        return 0
    joined, h = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    width = min(width, len(words))
    stops = ends[width - 1:].tolist()
    starts = [0, *(ends[:len(words) - width] + 1).tolist()]
    ones = np.zeros(64, np.int64)
    for i in range(0, len(stops), CHUNK):
        hashes = np.fromiter((h(joined[a:b], SEED) for a, b in zip(starts[i:i + CHUNK], stops[i:i + CHUNK])), np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(stops), bitorder="little").view("<u8")[0])


def _fingerprint_batches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series(np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64))


def _fingerprints(docs: DataFrame, text_col: str) -> Column:
    ship_package(docs.sparkSession)
    return F.pandas_udf(_fingerprint_batches, "long")(F.col(text_col))


def _one(bit):
    """The long with only that bit (a column) set."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), bit)


def _flipped(value, bit):
    """The value with that bit flipped; bit -1 flips none."""
    return F.when(bit < 0, value).otherwise(value.bitwiseXOR(_one(bit)))


def _odd(value):
    return F.bit_count(value) % 2 == 1


def _half_variants(prints: DataFrame) -> DataFrame:
    """Each half with at most 1 bit flipped in all: odd halves emit all neighbours, even ones only themselves."""
    halves = prints.select("fp", F.explode(F.array(
        F.struct(F.lit(0).cast("long").alias("part"), F.col("fp").bitwiseAND(F.lit(LOW_HALF)).alias("value")),
        F.struct(F.lit(1 << 32).alias("part"), F.shiftrightunsigned("fp", 32).alias("value")))).alias("h"))
    halves = halves.select("fp", "h.*")
    flips = halves.select("fp", "part", "value", F.explode(
        F.when(_odd(F.col("value")), F.sequence(F.lit(-1), F.lit(31))).otherwise(F.array(F.lit(-1)))).alias("bit"))
    return flips.select((F.col("part") + _flipped(F.col("value"), F.col("bit"))).alias("variant"), "fp")


def _third_variants(prints: DataFrame) -> DataFrame:
    """Each pair of thirds (the other third zeroed) with at most 1 bit flipped."""
    full = sum(THIRDS)
    kept = F.explode(F.array(*[F.lit((full ^ t) - (1 << 64) if (full ^ t) >> 63 else full ^ t) for t in THIRDS]))
    flips = prints.select("fp", kept.alias("kept")).select(
        "fp", "kept", F.explode(F.sequence(F.lit(-1), F.lit(63))).alias("bit"))
    one = _one(F.greatest(F.col("bit"), F.lit(0)))
    flips = flips.where((F.col("bit") < 0) | (F.col("kept").bitwiseAND(one) != 0))
    return flips.select(_flipped(F.col("fp").bitwiseAND(F.col("kept")), F.col("bit")).alias("variant"), "fp")


def _sieve(variants: DataFrame) -> DataFrame:
    """Fingerprints of which another one shares a variant."""
    shared = variants.groupBy("variant").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("lo < hi")
    return variants.join(shared.select("variant"), "variant", "left_semi").select("fp").distinct()


def _ball(prints: DataFrame) -> DataFrame:
    """Columns centre, fp, even: every fingerprint at every centre within its half of the radius."""
    bit = lambda a, b: F.explode(F.sequence(a, b))
    near = prints.withColumn("even", ~_odd(F.col("fp")))
    ones = near.select("fp", "even", bit(F.when(F.col("even"), F.lit(-1)).otherwise(F.lit(0)), F.lit(63)).alias("i"))
    first = near.where("not even").select("fp", "even", bit(F.lit(0), F.lit(62)).alias("i"))
    twos = first.select("fp", "even", "i", bit(F.col("i") + 1, F.lit(63)).alias("j"))
    return (ones.select(_flipped(F.col("fp"), F.col("i")).alias("centre"), "fp", "even")
            .unionByName(twos.select(_flipped(_flipped(F.col("fp"), F.col("i")), F.col("j")).alias("centre"),
                                     "fp", "even")))


def links(prints: DataFrame) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp) whose components are those of all links within 3 bits."""
    prints = materialize(_sieve(_half_variants(prints)))
    prints = materialize(_sieve(_third_variants(prints)))
    at = Window.partitionBy("centre")
    met = _ball(prints).select("centre", "fp", F.count(F.lit(1)).over(at).alias("n"),
                               F.max("even").over(at).alias("bridged"), F.min("fp").over(at).alias("head"))
    return met.where((F.col("n") > 1) & (F.col("bridged") | ~_odd(F.col("centre"))) & (F.col("fp") != F.col("head"))
                     ).select(F.col("fp").alias("a"), F.col("head").alias("b")).distinct()


def _components(prints: DataFrame, least: Column, name: str) -> DataFrame:
    """Columns fp and ``name``: the least of ``least`` over the component of the fingerprint."""
    classes = materialize(prints.groupBy("fp").agg(F.min(least).alias(name)))
    found = components(links(classes.select("fp")))
    linked = found.join(classes, F.col("node") == F.col("fp")).select("fp", "root", name)
    shared = linked.groupBy("root").agg(F.min(name).alias("shared"))
    linked = linked.join(shared, "root").select("fp", "shared")
    return classes.join(linked, "fp", "left").select("fp", F.coalesce("shared", name).alias(name))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (signed long) and component_id (least doc_id reachable over links of at most 3 bits) of every row.

    A null or blank text has fingerprint 0. Rows with a null id take part; they do not name a component unless all
    of it is null. Repeated rows stay. Other columns are not looked at. An empty table gives an empty result.
    """
    prints = materialize(docs.select(F.col(id_col).alias("doc_id"), _fingerprints(docs, text_col).alias("fp")))
    return prints.join(_components(prints, F.col("doc_id"), "component_id"), "fp").select("doc_id", "fp", "component_id")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the one with the least id (null last), then the least text hash."""
    key, digest = free_name(docs, "__key"), free_name(docs, "__digest")
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest")
    prints = materialize(docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("digest"),
                                     _fingerprints(docs, text_col).alias("fp")))
    kept = _components(prints, row, "kept").select(
        stratum(F.col("kept.doc_id")).alias(key), F.col("kept.digest").alias(digest)).distinct()
    keyed = docs.withColumn(key, stratum(F.col(id_col))).withColumn(digest, F.xxhash64(text_col))
    return keyed.join(kept, [key, digest], "left_semi").dropDuplicates([key, digest]).select(*docs.columns)


def linked_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op7: fingerprint and component of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
