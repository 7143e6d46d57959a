"""CSV with line breaks in cells, read in many splits, against pandas and a character-by-character reader."""

from __future__ import annotations

import csv
import io
import os
import random

import pandas as pd
import pytest

from accountlens.sources import csvsplits
from accountlens.sources.files import load_bulk, load_file
from accountlens.sources.loaders import DataLoader


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def same_as_pandas(spark, path, **options):
    got = load_file(spark, path, **options)
    expected = pd.read_csv(path, dtype=str, keep_default_na=False)
    assert got.columns == list(expected.columns)
    mine = sorted(tuple("" if x is None else x for x in r) for r in got.collect())
    theirs = sorted(tuple(r) for r in expected.itertuples(index=False))
    assert mine == theirs
    return got


def text_of(rng):
    out = rng.choice(["plain", "a,b", 'say "x"', '"', '""', "two\nlines", 'q"\n"r', "\n", "x\n\n\ny", "ünï\ncode", "a\r\nb", "", " ", "l\n" * 400,
                      'open"quote', "tail,\n"])
    return out + rng.choice(["", "", " z"])


@pytest.mark.parametrize("seed,line_end", [(1, "\n"), (2, "\r\n"), (3, "\n")])
def test_random_tables_equal_pandas_in_many_splits(spark, tmpdir_path, small_splits, seed, line_end):
    rng = random.Random(seed)
    path = os.path.join(tmpdir_path, "t.csv")
    rows = [[str(i), text_of(rng), text_of(rng), "end"] for i in range(400)]
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, lineterminator=line_end)
        w.writerows([["id", "first", "second one", "last"], *rows])
    found, broken = csvsplits.borders(spark, path)
    assert broken and os.path.getsize(path) > 20_000
    assert csvsplits._lines(spark, path).rdd.getNumPartitions() >= 8
    got = load_file(spark, path).collect()
    assert sorted((tuple("" if x is None else x for x in r) for r in got), key=lambda r: int(r[0])) == [tuple(r) for r in rows]


def test_quotes_in_unquoted_cells_are_ordinary(spark, tmpdir_path, small_splits):
    path = os.path.join(tmpdir_path, "t.csv")
    lines = ["id,size,note", '1,5" pipe,"a', 'b"', '2,3" and 4" pipes,x', '3,"7"" pipe",y', '4,,""'] + [f'{i},{i}" pipe,plain' for i in range(5, 400)]
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    got = same_as_pandas(spark, path)
    assert {r["id"]: r["note"] for r in got.collect()}["1"] == "a\nb"


@pytest.mark.parametrize("line,inside,ends", [
    ("a,b", False, False), ("a,b", True, True), ('a,"b', False, True), ('b",c', True, False), ('"a""', False, True), ('"a"""', False, False),
    ('""', False, False), ('a""b,c"', False, False), ('x"y', True, False), ('x"y,"z', True, True), ('""', True, True), ('"', True, False),
    ('"', False, True), (',"",""', False, False), ('"a"b"c,d', False, False), ("", True, True), ("", False, False), ('",', True, False)])
def test_state_of_a_line(line, inside, ends):
    assert csvsplits.ends_inside(line, inside) is ends


def test_state_of_a_line_equals_the_csv_module():
    rng = random.Random(4)
    for _ in range(3000):
        line = "".join(rng.choice('ab,"",') for _ in range(rng.randint(0, 12)))
        # with a mark on the next line: if the cell is open, the mark is part of it
        rows = list(csv.reader(io.StringIO(line + "\n\x01\n\"\n"), strict=False))
        assert csvsplits.ends_inside(line, False) == (not any(r == ["\x01"] for r in rows)), line


def test_documents_come_back_equal_from_one_file(spark, tmpdir_path):
    docs = pd.read_parquet("/root/testdata/sf0.01/documents.parquet")[["doc_id", "text", "lang", "source"]]
    path = os.path.join(tmpdir_path, "documents.csv")
    docs.to_csv(path, index=False)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        assert csvsplits._lines(spark, path).rdd.getNumPartitions() > 10
        got = sorted((int(r["doc_id"]), r["text"] or "", r["lang"] or "", r["source"] or "") for r in load_file(spark, path).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    expected = pd.read_csv(path, dtype=str, keep_default_na=False)
    assert got == sorted((int(a), b, c, d) for a, b, c, d in expected.itertuples(index=False))
    assert sum("\n" in r[1] for r in got) > 100


def test_several_files_a_schema_and_a_header_of_two_lines(spark, tmpdir_path, small_splits):
    folder = os.path.join(tmpdir_path, "many.csv")
    os.makedirs(folder)
    for n in range(3):
        with open(os.path.join(folder, f"part{n}.csv"), "w", encoding="utf-8") as f:
            f.write("id,note\n" + "".join(f'{n * 100 + i},"note\n{i}"\n' for i in range(100)) + "\n\n")
    got = load_file(spark, folder, schema="id long, note string")
    assert sorted((r["id"], r["note"]) for r in got.collect()) == [(i, f"note\n{i % 100}") for i in range(300)]
    path = os.path.join(tmpdir_path, "header.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write('id,"a\nb"\n1,"x\ny"\n')
    got = load_file(spark, path)
    assert got.columns == ["id", "a\nb"] and got.collect() == [("1", "x\ny")]


def test_a_quote_that_is_never_closed_raises(spark, tmpdir_path, small_splits):
    path = os.path.join(tmpdir_path, "t.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write("id,note\n1,ok\n2,\"never closed\n" + "3,x\n" * 2000)
    with pytest.raises(ValueError, match="never closed"):
        load_file(spark, path)


def test_files_without_line_breaks_in_cells_keep_the_plain_scan(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "t.csv")
    pd.DataFrame({"id": range(50), "note": ['a,"b"'] * 50}).to_csv(path, index=False)
    plan = load_file(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan csv" in plan and "MapInArrow" not in plan
    assert load_file(spark, path).count() == 50


def test_loaders_and_bulk_load_read_line_breaks(spark, tmpdir_path):
    frame = pd.DataFrame({"employer_id": [f"e{i}" for i in range(30)], "company_name": [f"Firm\n{i}, \"Ltd\"" for i in range(30)],
                          "company_size": "small", "status": "Active", "sector": "tech", "revenue_potential": 5.0,
                          "last_contact_date": "2025-01-01", "frequency_12m": 1})
    frame.to_csv(os.path.join(tmpdir_path, "employers.csv"), index=False)
    loader = DataLoader(spark, tmpdir_path, salt="s")
    assert loader.load_employers().count() == 30 and loader.audit.entries[0][3] == 30
    got = load_bulk(spark, os.path.join(tmpdir_path, "employers.csv"))
    assert sorted(r["company_name"] for r in got.collect()) == sorted(frame["company_name"])
