"""Pseudonymisation (PII1-PII5)."""

import hashlib

import pytest

from accountlens.operators.privacy import Pseudonymizer, redact_column, resolve_salt

SALT = "test-salt-fixed"


@pytest.fixture
def employer_df(spark):
    return spark.createDataFrame(
        [("EMP001", "Acme NV", "BE0123456789", "jan@acme.be", "Jan Janssens", "tech"),
         ("EMP002", "Beta BV", "BE0987654321", "piet@beta.be", "Piet Peeters", "retail")],
        ["employer_id", "company_name", "vat_number", "contact_email", "contact_name", "sector"])


def expected(value, salt=SALT):
    return "anon_" + hashlib.sha256(f"{salt}:{value}".encode()).hexdigest()[:16]


def test_pii_columns_get_prefix(employer_df):
    out = Pseudonymizer(SALT).pseudonymize_employers(employer_df).collect()
    for r in out:
        for c in ("company_name", "vat_number", "contact_email", "contact_name"):
            assert r[c].startswith("anon_") and len(r[c]) == 5 + 16


def test_matches_python_digest(employer_df):
    out = Pseudonymizer(SALT).pseudonymize_employers(employer_df).orderBy("employer_id").collect()
    assert out[0]["company_name"] == expected("Acme NV")
    assert out[1]["contact_email"] == expected("piet@beta.be")


def test_non_pii_untouched(employer_df):
    out = Pseudonymizer(SALT).pseudonymize_employers(employer_df).orderBy("employer_id").collect()
    assert [r["employer_id"] for r in out] == ["EMP001", "EMP002"]
    assert [r["sector"] for r in out] == ["tech", "retail"]


def test_stamp_columns(employer_df):
    out = Pseudonymizer(SALT).pseudonymize_employers(employer_df, processed_at="2025-01-01T00:00:00").collect()
    assert {r["gdpr_processed_at"] for r in out} == {"2025-01-01T00:00:00"}
    assert all(r["gdpr_pseudonymized"] is True for r in out)


def test_one_stamp_per_run(employer_df):
    out = Pseudonymizer(SALT).pseudonymize_employers(employer_df).select("gdpr_processed_at").distinct().count()
    assert out == 1


def test_deterministic_and_salt_sensitive(employer_df):
    a = Pseudonymizer(SALT).pseudonymize_employers(employer_df).orderBy("employer_id").collect()
    b = Pseudonymizer(SALT).pseudonymize_employers(employer_df).orderBy("employer_id").collect()
    c = Pseudonymizer("other-salt").pseudonymize_employers(employer_df).orderBy("employer_id").collect()
    assert [r["company_name"] for r in a] == [r["company_name"] for r in b]
    assert [r["company_name"] for r in a] != [r["company_name"] for r in c]


def test_missing_pii_columns_ok(spark):
    df = spark.createDataFrame([("E1", "tech")], ["employer_id", "sector"])
    out = Pseudonymizer(SALT).pseudonymize_employers(df)
    assert set(out.columns) == {"employer_id", "sector", "gdpr_processed_at", "gdpr_pseudonymized"}


def test_null_stays_null(spark):
    df = spark.createDataFrame([("E1", None)], "employer_id string, company_name string")
    assert Pseudonymizer(SALT).pseudonymize_employers(df).first()["company_name"] is None


def test_interactions(spark):
    df = spark.createDataFrame([("INT1", "a@b.be", "A B", "0470")],
                               ["interaction_id", "contact_email", "contact_name", "phone_number"])
    out = Pseudonymizer(SALT).pseudonymize_interactions(df)
    r = out.first()
    assert r["interaction_id"] == "INT1"
    assert r["contact_email"] == expected("a@b.be") and r["phone_number"] == expected("0470")
    assert "gdpr_processed_at" not in out.columns


def test_redact_column(spark):
    df = spark.createDataFrame([(1, 2)], ["a", "b"])
    assert redact_column(df, "a").columns == ["b"]
    assert redact_column(df, "zz").columns == ["a", "b"]


def test_salt_policy(monkeypatch):
    assert resolve_salt("given") == "given"
    monkeypatch.setenv("GDPR_SALT", "from-env")
    assert resolve_salt(None) == "from-env"
    assert resolve_salt("") == "from-env"
    monkeypatch.delenv("GDPR_SALT")
    a, b = resolve_salt(None), resolve_salt(None)
    assert len(a) == 64 and a != b


def test_salt_hidden_from_plan(spark, employer_df):
    out = Pseudonymizer("very-secret-salt-123").pseudonymize_employers(employer_df)
    plan = out._jdf.queryExecution().toString()
    assert "very-secret-salt-123" not in plan
