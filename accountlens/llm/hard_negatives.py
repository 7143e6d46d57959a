"""Hard negatives by exact top-k search with segment summary bounds.

Every vector is stored with the mean and the deviation of its segments, at several levels from coarse to fine. Over one
segment of m components, the inner product of x and y is m * mean(x) * mean(y) plus that of their deviations, which by the
Cauchy-Schwarz inequality is at most dev(x) * dev(y) in size. So the means' products plus or minus the deviation products, summed over the
segments, bound the score from both sides. A tile of anchors and rows is bounded by its coarsest segments first; pairs
that cannot enter an anchor's best list are struck out, the tile shrinks to the anchors and rows that are left, and the
next finer level bounds those. Only what is left after the finest level is scored exactly, in whole numbers.

Anchors are searched in waves of a fixed number of bytes, each broadcast to all tasks; a task walks over its blocks of rows and
keeps a best list for each anchor of the wave, so no pair is ever written. Rows and summaries are packed once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from accountlens.llm.common import running_offsets, ship_package, table
from accountlens.llm.vector_codes import usable
from accountlens.session import scratch_path

SCALE = 256
ANCHOR_EVERY = 50
POSITIVES = 5
NEGATIVES = 3
#: A negative scores from LOW to HIGH hundredths of its positive.
LOW, HIGH = 50, 95
#: Segments of a vector at each level.
LEVELS = (1, 4, 16)
#: Rows of a block, anchors of a tile, and bytes of the vectors (8 a component) of the anchors of one wave.
BLOCK_ROWS, TILE_ANCHORS, WAVE_BYTES = 2048, 256, 16 << 20
#: Stands for a null id in order and ties: after all others.
NO_ID = np.iinfo(np.int64).max
#: Widens the bounds by this share of the product of the norms: far more than float rounding, far less than a prune.
SLACK = 1e-9


class Vectors(NamedTuple):
    """Rows in whole numbers: ids, group numbers, place (block and position), components and segment summaries."""

    ids: np.ndarray
    labels: np.ndarray
    block: np.ndarray
    at: np.ndarray
    x: np.ndarray
    levels: list[tuple[np.ndarray, np.ndarray]]

    def take(self, rows: np.ndarray) -> Vectors:
        return Vectors(self.ids[rows], self.labels[rows], self.block[rows], self.at[rows], self.x[rows],
                       [(m[rows], d[rows]) for m, d in self.levels])


def summaries(x: np.ndarray, levels: Sequence[int] = LEVELS) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each level: means times the root of the length, and deviations (root of summed squares) with a column for the slack."""
    out, dim = [], x.shape[1]
    norm = np.sqrt(np.einsum("nd,nd->n", x, x))[:, None] * SLACK ** 0.5
    for segments in levels:
        edges = np.unique(np.linspace(0, dim, min(segments, max(dim, 1)) + 1).astype(int))
        if dim == 0:
            out.append((np.zeros((len(x), 0)), norm))
            continue
        length = np.diff(edges).astype(np.float64)
        mean = np.add.reduceat(x, edges[:-1], axis=1) / length
        rest = x - np.repeat(mean, np.diff(edges), axis=1)
        deviation = np.sqrt(np.add.reduceat(rest * rest, edges[:-1], axis=1))
        out.append((mean * np.sqrt(length), np.hstack([deviation, norm])))
    return out


class Best:
    """For each anchor and score interval, the ``k`` best (score, id) seen so far; higher scores, then smaller ids first."""

    def __init__(self, low: np.ndarray, high: np.ndarray, k: int):
        self.low, self.high, self.k = low, high, k  # anchors x intervals
        self.score = np.full((*low.shape, k), -np.inf)
        self.id = np.full((*low.shape, k), NO_ID)

    def needed(self) -> tuple[np.ndarray, np.ndarray]:
        """The least and greatest score of each anchor that could still enter a list."""
        open_ = self.low <= self.high
        least = np.where(open_, np.maximum(self.low, self.score[:, :, -1]), np.inf)
        return least.min(axis=1), np.where(open_, self.high, -np.inf).max(axis=1)

    def add(self, anchors: np.ndarray, scores: np.ndarray, ids: np.ndarray, alive: np.ndarray) -> None:
        """Enter a tile of exact scores (anchors x rows) where ``alive``."""
        for p in range(self.low.shape[1]):
            floor, cap = np.maximum(self.low[anchors, p], self.score[anchors, p, -1]), self.high[anchors, p]
            fits = alive & (scores >= floor[:, None]) & (scores <= cap[:, None])
            if fits.shape[1] > 4 * self.k and np.count_nonzero(fits) > 8 * self.k * len(anchors):
                kth = np.partition(np.where(fits, scores, -np.inf), -self.k, axis=1)[:, -self.k]
                fits &= scores >= kth[:, None]
            row, column = np.nonzero(fits)
            if not len(row):
                continue
            touched = np.unique(row)
            old = anchors[touched]
            a = np.concatenate([row, np.repeat(touched, self.k)])
            s = np.concatenate([scores[row, column], self.score[old, p].ravel()])
            i = np.concatenate([ids[column], self.id[old, p].ravel()])
            order = np.lexsort((i, -s, a))
            a, s, i = a[order], s[order], i[order]
            rank = np.arange(len(a)) - np.searchsorted(a, a)
            top = rank < self.k
            self.score[anchors[a[top]], p, rank[top]] = s[top]
            self.id[anchors[a[top]], p, rank[top]] = i[top]


def search(anchors: Vectors, rows: Vectors, best: Best, same_label: bool, struck: list[int] | None = None) -> None:
    """Enter into ``best`` the rows with the anchor's label (or, if not ``same_label``, all others); an anchor's own row is no candidate.

    ``struck`` gets the pairs of other and equal label met, and those left after each level.
    """
    labels = np.unique(rows.labels)
    chosen = np.flatnonzero(np.isin(anchors.labels, labels)) if same_label else np.arange(len(anchors.ids))
    for start in range(0, len(chosen), TILE_ANCHORS):
        a = chosen[start:start + TILE_ANCHORS]
        r = np.arange(len(rows.ids))
        alive = (anchors.labels[a][:, None] == rows.labels[None, :]) == same_label
        if same_label:
            alive &= (anchors.block[a][:, None] != rows.block[None, :]) | (anchors.at[a][:, None] != rows.at[None, :])
        counted = [int(alive.sum())]
        least, most = best.needed()
        for (am, ad), (rm, rd) in zip(anchors.levels, rows.levels):
            keep_a, keep_r = alive.any(axis=1), alive.any(axis=0)
            a, r, alive = a[keep_a], r[keep_r], alive[np.ix_(keep_a, keep_r)]
            if not len(a):
                break
            middle, spread = am[a] @ rm[r].T, ad[a] @ rd[r].T
            alive &= (middle + spread >= least[a][:, None]) & (middle - spread <= most[a][:, None])
            counted.append(int(alive.sum()))
        if len(a) and alive.any():
            best.add(a, anchors.x[a] @ rows.x[r].T, rows.ids[r], alive)
        if struck is not None:
            for level, n in enumerate(counted + [0] * (len(anchors.levels) + 1 - len(counted))):
                struck[level] += n


def _vectors(row: pa.RecordBatch, dim: int, levels: Sequence[int]) -> Vectors:
    """The vectors of one stored block (a batch of one row)."""
    def flat(name: str) -> np.ndarray:
        return row.column(name).flatten().fill_null(NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)

    ids = flat("ids")
    x = np.frombuffer(row.column("cells")[0].as_py(), dtype="<i4").astype(np.float64).reshape(len(ids), dim)
    summary = np.frombuffer(row.column("summary")[0].as_py(), dtype="<f8").reshape(len(ids), -1)
    out, start = [], 0
    for segments in levels:
        n = min(segments, dim)
        out.append((summary[:, start:start + n], summary[:, start + n:start + 2 * n + 1]))
        start += 2 * n + 1
    return Vectors(ids, flat("labels"), np.full(len(ids), row.column("block")[0].as_py()), flat("at"), x, out)


def _stacked(pieces: list[Vectors]) -> Vectors:
    """The pieces as one, ordered by label so that tiles have few labels."""
    joined = Vectors(*[np.concatenate([getattr(p, f) for p in pieces]) for f in ("ids", "labels", "block", "at", "x")],
                     [tuple(np.concatenate(z) for z in zip(*level)) for level in zip(*[p.levels for p in pieces])])
    return joined.take(np.argsort(joined.labels, kind="stable"))


def _block(block: int, ids: pa.Array, labels: pa.Array, at: np.ndarray, x: np.ndarray, summary: np.ndarray) -> pa.RecordBatch:
    whole = [pa.ListArray.from_arrays([0, len(ids)], values) for values in (ids, labels, pa.array(at, pa.int64()))]
    return pa.RecordBatch.from_arrays(
        [pa.array([block], pa.int64()), pa.array([len(ids)], pa.int64()), *whole,
         pa.array([x.astype("<i4").tobytes()], pa.binary()), pa.array([summary.astype("<f8").tobytes()], pa.binary())],
        ["block", "n", "ids", "labels", "at", "cells", "summary"])


BLOCK_SCHEMA = "block long, n long, ids array<long>, labels array<long>, at array<long>, cells binary, summary binary"
FOUND_SCHEMA = "anchor int, interval int, anchor_id long, positive_id long, positive_score long, score long, id long"


class HardNegatives:
    """Rows packed for the search of hard negatives.

    ``rows``: a table with a long id, a vector and a label. Rows with a null label, a null vector, or a null or non-finite
    component take no part. Labels are compared by their 64-bit hash. ``anchor``: which rows are anchors (null: not). A null id
    ranks after all others, and so does 2**63 - 1, which is given back as null. Rows that repeat an id, or all of a row,
    are rows of their own; an anchor's own row alone is no partner of it. All vectors must have one length, with components
    so small that scores stay below 2**52, else this raises. Other columns are ignored, whatever their names.
    """

    def __init__(self, rows: DataFrame, id_col: str, vector_col: str, label_col: str, anchor: Column, scale: int = SCALE,
                 block_rows: int = BLOCK_ROWS, levels: Sequence[int] = LEVELS, wave_bytes: int = WAVE_BYTES):
        self.spark, self.levels = rows.sparkSession, tuple(levels)
        ship_package(self.spark)
        used = rows.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(label_col).alias("label"),
                           F.coalesce(anchor, F.lit(False)).alias("anchor"),
                           F.col(vector_col).cast("array<double>").alias("v"), F.col(label_col).isNotNull().alias("labelled"))
        used = used.where(F.col("labelled") & usable(F.col("v"))).drop("labelled")
        first = used.select(F.size("v").alias("n")).limit(1).collect()
        self.dim = dim = int(first[0]["n"]) if first else 0

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block, limit = TaskContext.get().partitionId() << 32, 2.0 ** 26 / max(dim, 1) ** 0.5
            for batch in batches:
                for start in range(0, batch.num_rows, block_rows):
                    piece = batch.slice(start, block_rows)
                    vectors, is_anchor = piece.column("v"), piece.column("anchor").to_numpy(zero_copy_only=False)
                    if set(np.unique(vectors.value_lengths().to_numpy())) != {dim}:
                        raise ValueError(f"vectors of different lengths: {dim} and others")
                    x = np.floor(vectors.flatten().to_numpy(zero_copy_only=False) * scale).reshape(piece.num_rows, dim)
                    if x.size and np.abs(x).max() > limit:
                        raise ValueError(f"components beyond {limit / scale:g} are out of range")
                    summary = np.hstack([np.hstack(level) for level in summaries(x, levels)])
                    ids, labels, at = piece.column("id"), piece.column("label"), np.arange(piece.num_rows)
                    yield _block(block, ids, labels, at, x, summary)
                    if is_anchor.any():  # the anchors once more, in a block of their own, marked by a negative number
                        chosen = np.flatnonzero(is_anchor)
                        yield _block(-1 - block, ids.take(chosen), labels.take(chosen), chosen, x[chosen], summary[chosen])
                    block += 1

        path = scratch_path(self.spark, "negative-blocks")
        (used.sortWithinPartitions("label").mapInArrow(pack, BLOCK_SCHEMA)
         .withColumn("anchors", F.col("block") < 0).write.partitionBy("anchors").parquet(path))
        stored = self.spark.read.schema(BLOCK_SCHEMA + ", anchors boolean").parquet(path)
        self.blocks = stored.where(~F.col("anchors")).drop("anchors")
        # whole blocks of anchors, in waves of about wave_bytes
        own = stored.where("anchors").select((-1 - F.col("block")).alias("block"), *BLOCK_SCHEMA_REST)
        starts = running_offsets(own.select("block", "n"), "block", "n", "before").select("block", "before")
        per_wave = max(1, wave_bytes // (8 * max(dim, 1)))
        path = scratch_path(self.spark, "negative-anchors")
        (own.join(starts, "block").withColumn("wave", F.expr(f"before div {per_wave}")).drop("before")
         .write.partitionBy("wave").parquet(path))
        self.anchors = self.spark.read.schema(BLOCK_SCHEMA + ", wave long").parquet(path)
        self.waves = self.anchors.agg(F.coalesce(F.max("wave") + 1, F.lit(0))).first()[0]

    def _search(self, wave: Vectors, low: np.ndarray, high: np.ndarray, k: int, same_label: bool,
                positives: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
        """The best rows of each anchor and interval: first of each task, then of all."""
        sent = self.spark.sparkContext.broadcast((wave, low, high, positives))
        dim, levels = self.dim, self.levels

        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            anchors, lows, highs, partners = sent.value
            best = Best(lows, highs, k)
            for batch in batches:
                for i in range(batch.num_rows):
                    search(anchors, _vectors(batch.slice(i, 1), dim, levels), best, same_label)
            anchor, interval, place = np.nonzero(best.score > -np.inf)
            partner, partner_score = partners if partners else (np.full(low.shape, NO_ID), np.zeros(low.shape))
            columns = [(anchor, pa.int32()), (interval, pa.int32()), (anchors.ids[anchor], pa.int64()),
                       (partner[anchor, interval], pa.int64()), (partner_score[anchor, interval].astype(np.int64), pa.int64()),
                       (best.score[anchor, interval, place].astype(np.int64), pa.int64()),
                       (best.id[anchor, interval, place], pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns],
                                             [c.split()[0] for c in FOUND_SCHEMA.split(", ")])

        found = self.blocks.mapInArrow(find, FOUND_SCHEMA)
        order = Window.partitionBy("anchor", "interval").orderBy(F.desc("score"), "id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    def mine(self, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
        """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

        An anchor's positives are its first ``positives`` other rows of its label; for each, its negatives are the first
        ``negatives`` rows of another label with low * positive_score <= 100 * negative_score <= high * positive_score.
        Higher scores come first, ties by the smaller id. Fewer, or none, are given where there are no more. An empty
        table, or one without anchors, gives an empty result.
        """
        path = scratch_path(self.spark, "negatives")
        for number in range(self.waves):
            rows = self.anchors.where(F.col("wave") == number).drop("wave").toArrow()
            batches = [b.slice(i, 1) for b in rows.to_batches() for i in range(b.num_rows)]
            if not batches:
                continue
            wave = _stacked([_vectors(b, self.dim, self.levels) for b in batches])
            everything = np.full((len(wave.ids), 1), np.inf)
            near = self._search(wave, -everything, everything, positives, True).select("anchor", "rank", "score", "id").toArrow()
            anchor, place = near["anchor"].to_numpy(), near["rank"].to_numpy() - 1
            partner = np.full((len(wave.ids), positives), NO_ID)
            score = np.full((len(wave.ids), positives), np.nan)
            partner[anchor, place], score[anchor, place] = near["id"].to_numpy(), near["score"].to_numpy()
            # scores are whole numbers; without a positive the interval is empty
            known = ~np.isnan(score)
            least = np.where(known, np.ceil(low * np.where(known, score, 0) / 100), 1)
            most = np.where(known, np.floor(high * np.where(known, score, 0) / 100), 0)
            found = self._search(wave, least, most, negatives, False, (partner, np.where(known, score, 0)))
            found.select(_id("anchor_id"), _id("positive_id"), "rank", _id("id").alias("negative_id"), "positive_score",
                         F.col("score").alias("negative_score")).write.parquet(f"{path}/wave={number}")
        if not self.waves:
            return self.spark.createDataFrame([], NEGATIVE_SCHEMA)
        return self.spark.read.schema(NEGATIVE_SCHEMA + ", wave int").parquet(path).drop("wave")


BLOCK_SCHEMA_REST = [c.split()[0] for c in BLOCK_SCHEMA.split(", ")[1:]]
NEGATIVE_SCHEMA = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")


def _id(name: str) -> Column:
    return F.when(F.col(name) != NO_ID, F.col(name)).alias(name)


def mined_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op13: hard negatives of every anchor and positive; the label of each seventh row is moved by one first."""
    rows = table(spark, sf_dir, "embeddings").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return HardNegatives(rows, "vec_id", "embedding", "label", F.col("vec_id") % ANCHOR_EVERY == 0).mine()


ORACLE_SQL = f"""WITH r AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (
  SELECT a.n AS anchor, a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, b.n AS other_n,
         list_dot_product(a.v, b.v)::BIGINT AS score
  FROM r a, r b WHERE a.vec_id % {ANCHOR_EVERY} = 0 AND a.n <> b.n),
p AS (
  SELECT anchor, anchor_id, other AS positive_id, other_n, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other, other_n) <= {POSITIVES})
SELECT p.anchor_id, positive_id,
       (row_number() OVER (PARTITION BY anchor, p.other_n ORDER BY score DESC, other))::INTEGER AS rank,
       other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor)
WHERE NOT same AND {LOW} * positive_score <= 100 * score AND 100 * score <= {HIGH} * positive_score
QUALIFY rank <= {NEGATIVES}"""
