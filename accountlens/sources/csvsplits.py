"""CSV files whose quoted cells hold line breaks, read in splits by many tasks.

A task that starts in the middle of a file cannot tell a line break in a cell from the end of a record. So every split is read
twice. First, each task finds how its lines change the state "inside a quoted cell" for both states it may start in (most lines
have no quote and change nothing); these two-state functions, one row a split, are composed in the order of the file, which gives
every split its true state at the start. Then each task cuts its lines into records. What lies before the first record
start belongs to a record that began in an earlier split, its owner: the pieces of the few records that cross a border are
joined by a ``groupBy`` on the owner.

Quotes are read as pandas and spreadsheets do: a cell is quoted if its first character is a quote, a quote in it is doubled, and
a quote in an unquoted cell is an ordinary character. Lines end by LF or CRLF. A quote that is never closed raises.
"""

from __future__ import annotations

import re
import sys
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# the per-split functions run in Python workers: ship this module's code with them (by value)
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: One cell that ends in its line, with the comma behind it, from the start of a cell.
_CELL = re.compile(r'(?:"(?:[^"]|"")*+"[^,]*|[^",][^,]*|)(?:,|\Z)')
#: What is left of a quoted cell that began in an earlier line.
_REST = re.compile(r'(?:[^"]|"")*+"[^,]*(?:,|\Z)')


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a quoted cell is open at the end of the line."""
    if '"' not in line:
        return inside
    at, size = 0, len(line)
    if inside:
        match = _REST.match(line)
        if not match:
            return True
        at = match.end()
    while at < size:
        match = _CELL.match(line, at)
        if not match:
            return True
        at = match.end()
    return False


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """file, start of the split, and the lines in the order of the file within each split."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], list[str]]]:
    """The lines of a task by split; a split may come in several pieces, one after another."""
    for batch in batches:
        files, starts, values = (batch.column(i) for i in range(3))
        if not batch.num_rows:
            continue
        changes = [0, *(i for i in range(1, batch.num_rows) if starts[i] != starts[i - 1] or files[i] != files[i - 1])
                   ] if files[0] != files[-1] or starts[0] != starts[-1] else [0]
        for at, end in zip(changes, [*changes[1:], batch.num_rows]):
            yield (files[at].as_py(), starts[at].as_py()), values.slice(at, end - at).to_pylist()


class Borders:
    """For any split: whether it starts inside a quoted cell, and in which split the record that is open there began."""

    def __init__(self, functions: list[tuple[str, int, bool, bool, bool]]):
        """file, start, state at the end if it starts outside, if it starts inside, and whether some line closes the
        cell that is open at the start, of every split that has a quote."""
        self.after: dict[str, tuple[list[int], list[bool], list[int | None]]] = {}
        for file, start, closed, opened, closes in sorted(functions):
            starts, states, owners = self.after.setdefault(file, ([], [], []))
            inside, owner = (states[-1], owners[-1]) if states else (False, None)
            starts.append(start)
            states.append(opened if inside else closed)
            owners.append(owner if inside and not closes else start)

    def before(self, file: str, start: int) -> tuple[bool, int | None]:
        starts, states, owners = self.after.get(file, ([], [], []))
        at = bisect_left(starts, start) - 1
        return (True, owners[at]) if at >= 0 and states[at] else (False, None)

    def unclosed(self) -> list[str]:
        return [file for file, (_, states, _) in self.after.items() if states[-1]]


def borders(spark: SparkSession, path: str) -> tuple[Borders, bool]:
    """The borders of all splits, and whether any record has a line break. Raises if a quoted cell is never closed."""
    def functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int], list[bool]] = {}
        for split, lines in _runs(batches):
            state = found.setdefault(split, [False, True, False, False])
            for line in lines:
                line = line.removesuffix("\r")
                state[0] = ends_inside(line, state[0])
                state[1] = ends_inside(line, state[1])
                state[2] |= not state[1]
                state[3] |= state[0]
        rows = [(*split, *state) for split, state in found.items()]
        columns = list(zip(*rows)) if rows else [()] * 6
        types = [pa.string(), pa.int64(), *[pa.bool_()] * 4]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                         ["file", "start", "closed", "opened", "closes", "broken"])

    quoted = _lines(spark, path).where(F.col("value").contains('"'))
    found = quoted.mapInArrow(functions, "file string, start long, closed boolean, opened boolean, closes boolean, "
                                         "broken boolean").collect()
    out = Borders([tuple(r)[:5] for r in found])
    if out.unclosed():
        raise ValueError(f"a quoted cell is never closed in {out.unclosed()[0]}")
    return out, any(r["broken"] for r in found)


PIECE_SCHEMA = "record string, file string, owner long, start long, header boolean"


def records(spark: SparkSession, path: str, found: Borders) -> DataFrame:
    """Column record: the text of every record but each file's first, without its line end; blank ones are left out."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        split, inside, owner, header, pieces = None, False, None, False, []

        def end_record(crosses: bool) -> None:
            nonlocal owner, header
            text = "\n".join(pieces)
            if owner is not None or crosses:  # a piece of a record that crosses a border
                out.append((text, split[0], split[1] if owner is None else owner, split[1], header and owner is None))
            elif text.strip():
                if not header:
                    out.append((text.removesuffix("\r"), None, None, None, False))
                header = False
            owner = None
            pieces.clear()

        def written() -> pa.RecordBatch:
            columns = list(zip(*out)) if out else [()] * 5
            out.clear()
            types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                              [c.split()[0] for c in PIECE_SCHEMA.split(", ")])

        for key, lines in _runs(batches):
            if key != split:
                if pieces:
                    end_record(True)
                split, header = key, key[1] == 0
                inside, owner = found.before(*key)
            for line in lines:
                pieces.append(line)
                inside = ends_inside(line.removesuffix("\r"), inside)
                if not inside:
                    end_record(False)
            yield written()
        if pieces:
            end_record(True)
        yield written()

    pieces = _lines(spark, path).mapInArrow(cut, PIECE_SCHEMA)
    whole = pieces.where("file IS NULL").select("record")
    crossing = (pieces.where("file IS NOT NULL").groupBy("file", "owner")
                .agg(F.max("header").alias("header"),
                     F.array_sort(F.collect_list(F.struct("start", "record"))).alias("pieces")).where("NOT header")
                .select(F.array_join(F.transform("pieces", lambda p: p["record"]), "\n").alias("record")))
    return whole.unionByName(crossing.select(F.regexp_replace("record", "\r\\z", "").alias("record")))


def read_records(spark: SparkSession, path: str, found: Borders, schema: T.StructType, options: dict) -> DataFrame:
    """The records parsed by Spark's own CSV expression."""
    row = F.from_csv("record", _ddl(schema), {**options, "multiLine": "true", "mode": "PERMISSIVE"})
    return records(spark, path, found).select(row.alias("row")).select("row.*")


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
