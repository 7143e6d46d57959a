"""Sources, cleaning, loaders and audit (SRC*, CLN*, UNI1, AUD*, SNK*)."""

import hashlib
import os

import pytest

from accountlens.operators.contracts import ContractError
from accountlens.sources import files
from accountlens.sources.audit import checksum, file_checksums
from accountlens.sources.loaders import DataLoader


def write_text(path, text):
    with open(path, "w") as fh:
        fh.write(text)
    return path


@pytest.fixture
def raw_dir(tmpdir_path):
    emp = ["employer_id,company_name,company_size,status,sector,revenue_potential,last_contact_date,frequency_12m,"
           "contact_name,contact_email,vat_number"]
    for i in range(20):
        emp.append(f"EMP{i:03d},Company {i},small,Active,tech,20000.0,2025-01-01,5,Name {i},c{i}@x.be,BE{i:010d}")
    write_text(os.path.join(tmpdir_path, "employers.csv"), "\n".join(emp) + "\n")
    inter = ["interaction_id,employer_id,interaction_date,interaction_type,outcome,follow_up_required,consultant_id"]
    for i in range(30):
        inter.append(f"INT{i:04d},EMP{i % 20:03d},2025-03-01,call,positive,{'true' if i % 2 else 'false'},CONS001")
    write_text(os.path.join(tmpdir_path, "interactions.csv"), "\n".join(inter) + "\n")
    return tmpdir_path


def test_load_employers_pseudonymises(spark, raw_dir):
    loader = DataLoader(spark, raw_dir, salt="s")
    df = loader.load_employers()
    rows = df.collect()
    assert len(rows) == 20
    assert all(r["company_name"].startswith("anon_") and r["contact_email"].startswith("anon_") for r in rows)
    assert dict(df.dtypes)["revenue_potential"] == "double" and dict(df.dtypes)["frequency_12m"] == "bigint"


def test_load_interactions_and_audit(spark, raw_dir):
    loader = DataLoader(spark, raw_dir, salt="s")
    loader.load_employers()
    assert loader.load_interactions().count() == 30
    audit = loader.audit.to_dataframe().orderBy("filename").collect()
    assert [a["filename"] for a in audit] == ["employers.csv", "interactions.csv"]
    assert [a["row_count"] for a in audit] == [20, 30]
    with open(os.path.join(raw_dir, "employers.csv"), "rb") as fh:
        assert audit[0]["checksum"] == hashlib.md5(fh.read()).hexdigest()
    path = loader.audit.save(os.path.join(raw_dir, "out"))
    assert spark.read.option("header", True).csv(path).count() == 2


def test_missing_file_and_bad_formats(spark, raw_dir):
    with pytest.raises(FileNotFoundError):
        files.load_file(spark, os.path.join(raw_dir, "nope.csv"))
    with pytest.raises(ValueError):
        files.load_file(spark, os.path.join(raw_dir, "data.json"))
    with pytest.raises(ValueError, match="xlsx"):
        files.load_file(spark, os.path.join(raw_dir, "data.xlsx"))


def test_suffix_case_insensitive(spark, raw_dir):
    os.rename(os.path.join(raw_dir, "employers.csv"), os.path.join(raw_dir, "EMPLOYERS.CSV"))
    assert files.load_file(spark, os.path.join(raw_dir, "EMPLOYERS.CSV")).count() == 20


def test_contract_violation_raises(spark, raw_dir):
    path = os.path.join(raw_dir, "bad.csv")
    write_text(path, "employer_id,company_size,status,sector,revenue_potential,last_contact_date,frequency_12m\n"
                     "E1,giant,Active,tech,-5,2025-01-01,2.5\nE1,small,Active,tech,10,2025-01-01,1\n")
    with pytest.raises(ContractError) as err:
        DataLoader(spark, raw_dir).load_employers("bad.csv")
    msg = str(err.value)
    assert "company_size: isin" in msg and "employer_id: unique" in msg and "greater_than(0)" in msg
    assert "coerce_long" in msg


def test_null_tokens_and_float_integers(spark, raw_dir):
    path = os.path.join(raw_dir, "tok.csv")
    write_text(path, "employer_id,company_size,status,sector,revenue_potential,last_contact_date,frequency_12m\n"
                     "E1,small,Active,NA,null,,5.0\nE2,small,Active,tech,10,2025-01-01,NA\n")
    df = DataLoader(spark, raw_dir).load_employers("tok.csv").orderBy("employer_id").collect()
    assert df[0]["sector"] is None and df[0]["revenue_potential"] is None and df[0]["last_contact_date"] is None
    assert df[0]["frequency_12m"] == 5 and df[1]["frequency_12m"] is None


def test_bulk_load(spark, raw_dir):
    path = os.path.join(raw_dir, "dups.csv")
    write_text(path, "Employer Id, Company Size \nE1,small\nE1,small\nE2,large\n")
    df = files.load_bulk(spark, path)
    assert df.columns == ["employer_id", "company_size"] and df.count() == 2
    assert files.load_bulk(spark, os.path.join(raw_dir, "employers.csv")).count() == 20


def test_column_cleaning(spark):
    df = spark.createDataFrame([(1, 2)], ["Column One", "Column Two"])
    assert files.normalize_column_names(df).columns == ["column_one", "column_two"]
    with pytest.raises(ValueError):
        files.normalize_column_names(spark.createDataFrame([(1, 2)], ["A b", "a_b"]))


def test_union_by_name(spark):
    a = spark.createDataFrame([(1, "x")], ["id", "v"])
    b = spark.createDataFrame([(2, 3.0)], ["id", "w"])
    rows = files.union_frames([a, b, a]).orderBy("id").collect()
    assert len(rows) == 3 and rows[2]["v"] is None


def test_checksums(spark, raw_dir):
    p = os.path.join(raw_dir, "interactions.csv")
    with open(p, "rb") as fh:
        assert checksum(spark, p) == hashlib.md5(fh.read()).hexdigest()
    assert file_checksums(spark, os.path.join(raw_dir, "*.csv")).count() == 2


def test_streamed_digests_equal_whole_ones(spark, raw_dir):
    write_text(os.path.join(raw_dir, "empty.csv"), "")
    write_text(os.path.join(raw_dir, "two words.csv"), "a" * 100_000)
    pattern = os.path.join(raw_dir, "*.csv")
    whole = {r["path"]: (r["checksum"], r["length"]) for r in file_checksums(spark, pattern).collect()}
    streamed = {r["path"]: (r["checksum"], r["length"]) for r in file_checksums(spark, pattern, whole_file_bytes=-1).collect()}
    assert whole == streamed and len(whole) == 3          # Spark's scans skip the empty file
    assert checksum(spark, os.path.join(raw_dir, "empty.csv")) == hashlib.md5(b"").hexdigest()
    assert hashlib.md5(b"a" * 100_000).hexdigest() in {c for c, _ in streamed.values()}


def test_directory_digest_ignores_file_order_and_sees_changes(spark, tmpdir_path):
    def folder(name, texts):
        os.makedirs(os.path.join(tmpdir_path, name))
        for i, t in enumerate(texts):
            write_text(os.path.join(tmpdir_path, name, f"part-{i}.csv"), t)
        return checksum(spark, os.path.join(tmpdir_path, name))
    first = folder("a", ["x\n", "y\n", "z\n"])
    assert folder("b", ["z\n", "x\n", "y\n"]) == first and folder("c", ["x\n", "y\n", "zz\n"]) != first


def test_sinks(spark, raw_dir):
    import datetime as dt
    df = spark.createDataFrame([("E1", "Acme", "Champions")], ["employer_id", "company_name", "segment_name"])
    p = files.write_segmented(df, os.path.join(raw_dir, "out"), dt.date(2025, 6, 1), drop_pii=True)
    assert p.endswith("employers_segmented_20250601")
    assert spark.read.parquet(p).columns == ["employer_id", "segment_name"]
    p2 = files.write_profiles(df.select("segment_name"), os.path.join(raw_dir, "out"))
    assert spark.read.option("header", True).csv(p2).count() == 1
