"""Product codes of vectors, with the nearest codebook entry found by slice-and-intersect bitmasks.

A vector is cut into equal parts and every part is replaced by the index of the nearest entry of that part's codebook.
For each coordinate of a part the entries are sorted, and for every place in that order a mask of 64-bit words holds the
entries before it (``Slices``). The distance to one guessed entry is the initial radius: the nearest entry differs by no
more than that in any coordinate, so in each coordinate a range of the sorted entries remains. The range's mask is the
difference of two prefix masks; the masks of all coordinates ANDed leave the candidates, which always hold the nearest
entry and all that tie with it. Only candidates are measured, in whole numbers, so the result is exact.

Vectors are packed once, as whole numbers, into blocks of a written table. Each round of the codebook fit is one pass
over the blocks: tasks add up counts and sums of each entry, Spark adds those, and only they reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from accountlens.llm.common import free_name, ship_package, table
from accountlens.session import materialize, scratch_path

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
#: Vectors of one block.
BLOCK_ROWS = 4096
#: Distinct groups up to which their sums are broadcast (a key and a number each); they are counted first.
BROADCAST_GROUPS = 100_000


def usable(vector: Column) -> Column:
    """True for a vector that is not null and has only finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite, F.lit(False))


def whole_numbers(values: np.ndarray, dim: int, scale: int, part: int) -> np.ndarray:
    """floor(scale * x) of a flat array of components, one row a vector. Raises if the squared distance of two such
    parts could pass 64 bits."""
    cells = np.floor(values.astype(np.float64) * scale)
    if len(cells) and np.abs(cells).max() > 2.0 ** 30 / max(1, part) ** 0.5:
        raise ValueError(f"components beyond {2.0 ** 30 / max(1, part) ** 0.5 / scale:g} are out of range")
    return cells.astype(np.int32).reshape(-1, max(dim, 1))


class Slices:
    """The sorted coordinates of a codebook (entries x coordinates, whole numbers) and their prefix entry masks."""

    def __init__(self, book: np.ndarray):
        self.book = np.asarray(book, dtype=np.int64)
        entries, self.dim = self.book.shape
        order = np.argsort(self.book, axis=0, kind="stable")
        self.sorted = np.ascontiguousarray(np.take_along_axis(self.book, order, axis=0).T)
        number = np.arange(entries)
        self.word, self.bit = number // 64, (number % 64).astype(np.uint64)
        own = np.zeros((entries, self.word[-1] + 1), dtype=np.uint64)
        own[number, self.word] = np.uint64(1) << self.bit
        # entries have a bit each, so a running sum is a running OR
        self.prefix = np.zeros((self.dim, entries + 1, own.shape[1]), dtype=np.uint64)
        for j in range(self.dim):
            self.prefix[j, 1:] = np.cumsum(own[order[:, j]], axis=0, dtype=np.uint64)
        #: the coordinate in which the entries lie widest apart gives the guess
        self.wide = int(np.argmax(self.sorted[:, -1] - self.sorted[:, 0])) if self.dim else 0
        self.by_wide = order[:, self.wide] if self.dim else number

    def candidates(self, x: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Masks (rows x words) of the entries that differ from x by at most the row's radius in every coordinate."""
        masks = np.broadcast_to(self.prefix[0, -1], (len(x), self.prefix.shape[2])).copy() if self.dim else np.full(
            (len(x), int(self.word[-1]) + 1), ~np.uint64(0))
        for j in range(self.dim):
            low = np.searchsorted(self.sorted[j], x[:, j] - radius, side="left")
            high = np.searchsorted(self.sorted[j], x[:, j] + radius, side="right")
            masks &= self.prefix[j, high] ^ self.prefix[j, low]
        return masks

    def _distance(self, x: np.ndarray, entry: np.ndarray) -> np.ndarray:
        apart = x - self.book[entry]
        return np.einsum("nd,nd->n", apart, apart)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The index of the nearest entry of each row, ties to the lower index, and the squared distance."""
        x = np.asarray(x, dtype=np.int64)
        if not len(x):
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        guess = np.zeros(len(x), dtype=np.int64)
        if self.dim:
            at = np.searchsorted(self.sorted[self.wide], x[:, self.wide])
            guess = self.by_wide[np.minimum(at, len(self.book) - 1)]
        radius = np.floor(np.sqrt(self._distance(x, guess).astype(np.float64))).astype(np.int64) + 1
        masks = self.candidates(x, radius)
        row, entry = np.nonzero((masks[:, self.word] >> self.bit) & np.uint64(1))
        distance = self._distance(x[row], entry)
        least = np.minimum.reduceat(distance, np.searchsorted(row, np.arange(len(x))))
        best = np.flatnonzero(distance == least[row])
        _, first = np.unique(row[best], return_index=True)  # a row's candidates come by rising index
        return entry[best[first]], least


def _split(cells: bytes, dim: int, parts: int) -> Iterator[np.ndarray]:
    """The parts of the vectors of one block."""
    matrix = np.frombuffer(cells, dtype="<i4").reshape(-1, dim).astype(np.int64)
    step = dim // parts
    for p in range(parts):
        yield matrix[:, p * step:(p + 1) * step]


class CodedVectors:
    """Vectors packed into blocks, and codebooks fitted to them.

    ``rows``: a table with a vector column; ``keep``: the columns that the codes come with, the first being the id by
    which the starting entries are taken (least first, nulls last, equal ids by their vectors). Rows whose vector is
    null or has a null or non-finite component are left out. All other vectors must have one length, a multiple of ``parts``, else this
    raises. With fewer rows than ``entries`` the codebooks are smaller; an empty table has none.
    """

    def __init__(self, rows: DataFrame, vector_col: str, keep: Sequence[str], parts: int = PARTS, entries: int = ENTRIES,
                 rounds: int = ROUNDS, scale: int = SCALE, block_rows: int = BLOCK_ROWS):
        spark = rows.sparkSession
        ship_package(spark)
        self.parts, self.keep, self.types = parts, list(keep), [rows.schema[c].dataType for c in keep]
        kept = rows.where(usable(F.col(vector_col))).select(
            *[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)],
            F.col(vector_col).cast("array<double>").alias("v"))
        seeds = [r["v"] for r in kept.orderBy(F.col("c0").asc_nulls_last(), "v").limit(entries).collect()]
        self.dim = len(seeds[0]) if seeds else 0
        if self.dim % parts:
            raise ValueError(f"vectors of {self.dim} components cannot be cut into {parts} equal parts")
        dim, step = self.dim, self.dim // parts
        columns = [f"c{i}" for i in range(len(keep))]

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start in range(0, batch.num_rows, block_rows):
                    piece = batch.slice(start, block_rows)
                    vectors = piece.column("v")
                    if set(np.unique(vectors.value_lengths().to_numpy())) != {dim}:
                        raise ValueError(f"vectors of different lengths: {dim} and others")
                    cells = whole_numbers(vectors.flatten().to_numpy(zero_copy_only=False), dim, scale, step)
                    held = [pa.ListArray.from_arrays([0, piece.num_rows], piece.column(c)) for c in columns]
                    yield pa.RecordBatch.from_arrays(
                        [*held, pa.array([cells.astype("<i4").tobytes()], pa.binary())], [*columns, "cells"])

        path = scratch_path(spark, "vector-blocks")
        schema = ", ".join([*[f"{c} array<{t.simpleString()}>" for c, t in zip(columns, self.types)], "cells binary"])
        kept.mapInArrow(pack, schema).write.parquet(path)
        self.blocks = spark.read.parquet(path)
        self.books = []
        if seeds:
            start = whole_numbers(np.array(seeds, dtype=np.float64).ravel(), dim, scale, step).astype(np.int64)
            self.books = [start[:, p * step:(p + 1) * step] for p in range(parts)]
            for _ in range(rounds):
                self.books = self._moved()

    def _moved(self) -> list[np.ndarray]:
        """The codebooks after one round: every entry at the floored mean of its parts; unused entries stay."""
        dim, parts, slices = self.dim, self.parts, [Slices(b) for b in self.books]

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            step, entries = dim // parts, len(slices[0].book)
            total = np.zeros((parts, entries, step + 1), dtype=np.int64)
            for batch in batches:
                for cells in batch.column("cells"):
                    for p, x in enumerate(_split(cells.as_py(), dim, parts)):
                        entry, _ = slices[p].nearest(x)
                        order = np.argsort(entry, kind="stable")
                        used, first = np.unique(entry[order], return_index=True)
                        total[p, used, 0] += np.diff(np.append(first, len(order)))
                        total[p, used, 1:] += np.add.reduceat(x[order], first, axis=0)
            p, entry, place = np.nonzero(np.broadcast_to(total[:, :, :1] > 0, total.shape))
            yield pa.RecordBatch.from_arrays(
                [pa.array(p, pa.int32()), pa.array(entry, pa.int32()), pa.array(place, pa.int32()),
                 pa.array(total[p, entry, place], pa.int64())], ["part", "entry", "place", "n"])

        partial = self.blocks.select("cells").mapInArrow(sums, "part int, entry int, place int, n long")
        added = {(r["part"], r["entry"], r["place"]): int(r["n"]) for r in partial.groupBy("part", "entry", "place").agg(
            F.sum(F.col("n").cast("decimal(38,0)")).alias("n")).collect()}
        books = [b.copy() for b in self.books]
        for (p, entry, place), n in added.items():
            if place:
                books[p][entry, place - 1] = n // added[p, entry, 0]
        return books

    def codes(self, code_col: str = "code", error_col: str = "error") -> DataFrame:
        """The kept columns, the code (two hexadecimal digits a part) and the squared distances summed over the parts."""
        dim, parts, slices, held = self.dim, self.parts, [Slices(b) for b in self.books], len(self.keep)
        digits = np.array([f"{i:02x}" for i in range(max([1, *(len(b) for b in self.books)]))])

        def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    columns = [batch.column(c).slice(i, 1).flatten() for c in range(held)]
                    n = len(columns[0])
                    code, error = np.full(n, "", dtype="U1"), np.zeros(n, dtype=np.int64)
                    for p, x in enumerate(_split(batch.column(held)[i].as_py(), dim, parts) if dim else ()):
                        entry, distance = slices[p].nearest(x)
                        code = np.char.add(code, digits[entry])
                        error += distance
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(code, pa.string()), pa.array(error, pa.int64())],
                                                     [*[f"c{c}" for c in range(held)], "code", "error"])

        schema = ", ".join([*[f"c{i} {t.simpleString()}" for i, t in enumerate(self.types)], "code string", "error long"])
        return self.blocks.mapInArrow(coded, schema).toDF(*self.keep, code_col, error_col)

    def digest(self) -> str:
        """SHA-256 of all entries' decimal components by part, entry and place, joined by commas."""
        return hashlib.sha256(",".join(str(x) for b in self.books for x in b.ravel().tolist()).encode()).hexdigest()


def with_group_sum(rows: DataFrame, group_col: str, value_col: str, sum_col: str) -> DataFrame:
    """Append the sum of a column over the rows of equal group, nulls being a group of their own."""
    key, other = free_name(rows, "__group"), free_name(rows, "__value")
    sums = materialize(rows.groupBy(F.col(group_col).alias(key)).agg(F.sum(value_col).alias(other)))
    few = sums.count() <= BROADCAST_GROUPS
    joined = rows.join(F.broadcast(sums) if few else sums, F.col(group_col).eqNullSafe(F.col(key)))
    return joined.withColumn(sum_col, F.col(other)).select(*[c for c in rows.columns if c != sum_col], sum_col)


def coded_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op11: code, error, error of the label and digest of the codebooks for every usable vector."""
    vectors = CodedVectors(table(spark, sf_dir, "embeddings"), "embedding", ["vec_id", "label"])
    coded = with_group_sum(materialize(vectors.codes()), "label", "error", "label_error")
    return coded.select("vec_id", "code", "error", "label_error", F.lit(vectors.digest()).alias("codebooks_sha256"), "label")


def _oracle() -> str:
    steps = [f"""kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cut AS MATERIALIZED (
  SELECT vec_id, p AS part, v[p * (len(v) // {PARTS}) + 1 : (p + 1) * (len(v) // {PARTS})] AS v
  FROM kept, (SELECT unnest(range({PARTS})) AS p)),
book0 AS MATERIALIZED (
  SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, v FROM cut
  WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT {ENTRIES}))"""]
    nearest = """near{r} AS MATERIALIZED (
  SELECT vec_id, part, any_value(v) AS v, min(d * 65536 + entry) % 65536 AS entry, min(d) AS d
  FROM (SELECT vec_id, part, entry, c.v AS v,
               list_sum(list_transform(range(1, len(c.v) + 1), lambda i: (c.v[i] - b.v[i]) * (c.v[i] - b.v[i]))) AS d
        FROM cut c JOIN book{r} b USING (part)) GROUP BY vec_id, part)"""
    for r in range(ROUNDS):
        steps.append(nearest.format(r=r))
        steps.append(f"""book{r + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.v, b.v) AS v FROM book{r} b LEFT JOIN (
    SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v
    FROM (SELECT part, entry, i, sum(v[i])::BIGINT AS s, count(*) AS n
          FROM (SELECT part, entry, v, unnest(range(1, len(v) + 1)) AS i FROM near{r}) GROUP BY part, entry, i)
    GROUP BY part, entry) m USING (part, entry))""")
    steps.append(nearest.format(r=ROUNDS))
    steps.append(f"""coded AS (
  SELECT vec_id, string_agg(printf('%02x', entry::INTEGER), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
  FROM near{ROUNDS} GROUP BY vec_id),
digest AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS h FROM book{ROUNDS})""")
    return "WITH " + ",\n".join(steps) + """
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256, label
FROM coded JOIN kept USING (vec_id), digest"""


ORACLE_SQL = _oracle()
