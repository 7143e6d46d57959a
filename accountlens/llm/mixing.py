"""Mixing sources to target weights by Pfair scheduling.

Rows of each source, in seeded random order, are cut into blocks, and every block gets a slot. Source i with weight
w_i and b_i blocks has the fluid share min(b_i, w_i v) at level v; all sources together fill T(v) = sum of these
slots. Block j of source i is released at slot floor(T(j / w_i)) and due before slot ceil(T((j + 1) / w_i)). No more
windows lie between two slots than there are slots, so serving the released block with the earliest deadline meets
every deadline on one line of slots, which keeps each source within less than one block of its fluid share at every
prefix. Weights are taken as they are: T is computed in whole numbers from the exact value of each weight, so the bound
holds at any number of rows. Until the first source runs out (phase 0) the shares are the target weights; after that
(a new phase) those of the remaining sources. The driver keeps one entry a block; Spark joins the rows to them.
"""

from __future__ import annotations

import heapq
import math
from array import array
from bisect import bisect_left
from collections.abc import Iterator, Mapping
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accountlens.llm.common import RANK_BUCKET_ROWS, free_name, ranked, shuffle_key, stratum, table

SEED = 8
#: Rows of a block, slots of a period of rounded shares, and the exponent that flattens source sizes to weights.
BLOCK_ROWS = 64
RESOLUTION = 1000
TEMPERATURE = 0.7
#: Blocks up to which the schedule is broadcast (three integers and a key a row).
BROADCAST_ROWS = 200_000
POOL = "pool"


def shares(weights: Mapping[str, float], resolution: int = RESOLUTION) -> dict[str, int]:
    """Whole-number shares, at least 1 each, in proportion to positive weights."""
    total = sum(weights.values())
    return {k: max(1, round(resolution * w / total)) for k, w in sorted(weights.items())}


def period(share: Mapping[str, int]) -> list[str]:
    """The source served in each slot of one period of whole-number shares."""
    return [k for k, _, _ in schedule(share, share)]


def _fluid(blocks: list[int], weights: list[float]) -> tuple[list[int], list[float], list[int], list[int], list[int]]:
    """The weights as whole numbers in the same proportion, and T(v) as the least of its linear pieces: the levels where
    they end, their values at 0, their slopes, and the slots filled where they end."""
    exact = [Fraction(w) for w in weights]
    scale = math.lcm(*(w.denominator for w in exact))
    whole = [int(w * scale) for w in exact]
    ends: dict[Fraction, list[int]] = {}
    for b, w in zip(blocks, whole):
        end = ends.setdefault(Fraction(b, w), [0, 0])
        end[0] += b
        end[1] += w
    levels, bases, slopes, filled, base, slope = [], [], [], [], 0, sum(whole)
    for v in sorted(ends):
        levels.append(float(v * max(whole)))
        bases.append(base)
        slopes.append(slope)
        filled.append(base + slope * v.numerator // v.denominator)
        base += ends[v][0]
        slope -= ends[v][1]
    return whole, levels, bases, slopes, filled


def schedule(blocks: Mapping[str, int], weights: Mapping[str, float]) -> Iterator[tuple[str, int, int]]:
    """(source, block, phase) of every slot in order: earliest deadline first among released blocks. ``blocks``: blocks of
    each source; ``weights``: positive numbers."""
    names = sorted(k for k, n in blocks.items() if n)
    if not names:
        return
    have = [blocks[k] for k in names]
    whole, levels, bases, slopes, filled = _fluid(have, [weights[k] for k in names])
    most, last = max(whole), len(levels) - 1

    def reached(i: int, j: int) -> tuple[int, int]:
        """floor and ceil of T(j / w_i)"""
        w = whole[i]
        at = bisect_left(levels, j * most / w)
        # T is concave, so it is the least of its pieces; the neighbours make up for the rounded levels
        pieces = [(bases[k] * w + slopes[k] * j) for k in range(max(at - 1, 0), min(at + 1, last) + 1)]
        low, over = divmod(min(pieces), w)
        return low, low + (over > 0)

    waiting = [(0, i, 0) for i in range(len(names))]
    ready: list[tuple[int, int, int, int]] = []
    phase = 0
    for t in range(sum(have)):
        while waiting and waiting[0][0] <= t:
            _, i, j = heapq.heappop(waiting)
            free, due = reached(i, j + 1)
            heapq.heappush(ready, (due, i, j, free))
        while phase < last and filled[phase] <= t:
            phase += 1
        _, i, j, free = heapq.heappop(ready)
        yield names[i], j, phase
        if j + 1 < have[i]:
            heapq.heappush(waiting, (free, i, j + 1))


def _timetable(spark: SparkSession, sizes: Mapping[str, int], weights: Mapping[str, float], block_rows: int,
               source_name: str, block_name: str, before_name: str) -> DataFrame:
    """One row a block: source, block, phase, slot, and the rows of all earlier slots."""
    blocks = {k: -(-n // block_rows) for k, n in sizes.items()}
    number = {k: i for i, k in enumerate(sizes)}
    source, block, phases, before, rows = array("i"), array("q"), array("i"), array("q"), 0
    for k, j, phase in schedule(blocks, weights):
        source.append(number[k])
        block.append(j)
        phases.append(phase)
        before.append(rows)
        rows += min(block_rows, sizes[k] - j * block_rows)
    count = len(block)
    columns = {source_name: pa.array(list(sizes), pa.string()).take(pa.array(source, pa.int32())),
               block_name: pa.array(block, pa.int64()), "phase": pa.array(phases, pa.int32()),
               "slot": pa.array(range(count), pa.int64()), before_name: pa.array(before, pa.int64())}
    types = f"`{source_name}` string, `{block_name}` long, phase int, slot long, `{before_name}` long"
    if not count:
        return spark.createDataFrame([], types)
    times = spark.createDataFrame(pa.table(columns), types)
    return F.broadcast(times) if count <= BROADCAST_ROWS else times


def source_sizes(rows: DataFrame, source_col: str = "source", limit: int | None = None) -> dict[str, int]:
    """Rows of each source; with a limit, rows beyond the ``limit`` largest sources count as the source ``pool``."""
    sizes = rows.groupBy(stratum(F.col(source_col)).alias("stratum")).agg(F.count(F.lit(1)).alias("n"))
    if limit is None:
        return {r["stratum"]: r["n"] for r in sizes.collect()}
    top = {r["stratum"]: r["n"] for r in sizes.orderBy(F.desc("n"), "stratum").limit(limit).collect()}
    rest = (sizes.agg(F.sum("n")).first()[0] or 0) - sum(top.values())
    return top | ({POOL: rest} if rest else {})


def temperature_weights(sizes: Mapping[str, int], exponent: float = TEMPERATURE) -> dict[str, float]:
    """Target weights in proportion to size ** exponent (1: as they are, 0: all equal)."""
    return {k: n ** exponent for k, n in sizes.items()}


def mix(rows: DataFrame, weights: Mapping[str, float] | None = None, block_rows: int = BLOCK_ROWS,
        seed: int = SEED, id_col: str = "doc_id", source_col: str = "source",
        bucket_rows: int = RANK_BUCKET_ROWS, position_col: str | None = None) -> DataFrame:
    """Append ``phase``, ``slot`` (of the row's block, over all sources) and ``in_block`` (its place in the block), and
    under the name ``position_col``, if given, the row's place in the order by (slot, in_block): 0, 1, ... without gaps.

    Sorted by (slot, in_block), the rows of phase 0 keep every source within less than one block of its target
    weight; later phases do so among the sources that are left. ``weights`` maps sources (None for null) to positive
    numbers; a source that it does not name is part of one pooled source with the smallest named weight. Without
    weights, ``temperature_weights`` of the source sizes hold, however many sources there are. No row is dropped or
    repeated. All columns are kept; input columns with one of the names are replaced. An empty table gives an
    empty result.
    """
    added = ["phase", "slot", "in_block"] + ([position_col] if position_col else [])
    rows = rows.drop(*added)
    named = stratum(F.col(source_col))
    if weights is None:
        sizes = source_sizes(rows, source_col)
        target = temperature_weights(sizes)
    else:
        target = {"null" if k is None else f"={k}": w for k, w in weights.items()}
        named = F.when(named.isin(*target), named).otherwise(F.lit(POOL))
        pooled = rows.groupBy(named.alias("stratum"))
        sizes = {r["stratum"]: r["n"] for r in pooled.agg(F.count(F.lit(1)).alias("n")).collect()}  # <= len(weights) + 1
        target.setdefault(POOL, min(target.values()))
    names = {n: free_name(rows, n) for n in ("__source", "__key", "__tie", "__rank", "__size", "__block", "__before")}
    source, block, before = names["__source"], names["__block"], names["__before"]
    keyed = (rows.withColumn(names["__tie"], F.xxhash64(*rows.columns))
             .withColumn(source, named)
             .withColumn(names["__key"], shuffle_key(seed, F.col(id_col))))
    placed = ranked(keyed, source, names["__key"], [names["__tie"]], names["__rank"], names["__size"],
                    sum(sizes.values()), bucket_rows)
    placed = (placed.withColumn(block, F.expr(f"`{names['__rank']}` div {block_rows}"))
              .withColumn("in_block", F.expr(f"`{names['__rank']}` % {block_rows}").cast("int")))
    times = _timetable(rows.sparkSession, sizes, target, block_rows, source, block, before)
    placed = placed.join(times, [source, block])
    if position_col:
        placed = placed.withColumn(position_col, F.col(before) + F.col("in_block"))
    return placed.select(*rows.columns, *added)


def mixed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op8: the place of every document in the mix."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mix(docs)
