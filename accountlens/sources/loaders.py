"""Table loaders (SRC4, SRC5): scan -> contract -> pseudonymise -> audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from accountlens.operators.contracts import EMPLOYER_CONTRACT, INTERACTION_CONTRACT, ContractError, violations, coerced
from accountlens.operators.privacy import Pseudonymizer
from accountlens.session import materialize
from accountlens.sources.audit import AuditLog
from accountlens.sources.files import load_file


class DataLoader:
    """Loads the employer and interaction sources of one run."""

    def __init__(self, spark: SparkSession, raw_dir: str, salt: str | None = None,
                 processed_at: str | None = None):
        self.spark = spark
        self.raw_dir = raw_dir.rstrip("/")
        self.pseudonymizer = Pseudonymizer(salt)
        self.processed_at = processed_at
        self.audit = AuditLog(spark)

    def _checked(self, df: DataFrame, contract, pseudonymize) -> tuple[DataFrame, int]:
        """Contract check in raise mode; the audit row count comes from the same aggregation.

        The source is pseudonymised as it is parsed and only then checkpointed (no contract column is
        personal data), so the text is parsed once and no direct identifier is ever written.
        """
        df = materialize(pseudonymize(df))
        rows = violations(df, contract, with_row_count=True).collect()
        n = next(r["failed_rows"] for r in rows if r["check_name"] == "row_count")
        rows = [r for r in rows if r["check_name"] != "row_count"]
        bad = [r for r in rows if r["failed_rows"] is None or r["failed_rows"] > 0]
        if bad:
            lines = [f"{r['column_name']}: {r['check_name']} ({r['failed_rows'] if r['failed_rows'] is not None else 'missing'})"
                     for r in bad]
            raise ContractError(f"contract '{contract.name}' failed:\n  " + "\n  ".join(lines))
        return coerced(df, contract), int(n)

    def load_employers(self, filename: str = "employers.csv") -> DataFrame:
        """SRC4: scan, contract CON1, pseudonymise PII1, audit."""
        path = f"{self.raw_dir}/{filename}"
        out, n = self._checked(load_file(self.spark, path), EMPLOYER_CONTRACT,
                              lambda d: self.pseudonymizer.pseudonymize_employers(d, self.processed_at))
        self.audit.log(filename, path, n, "employers")
        return out

    def load_interactions(self, filename: str = "interactions.csv") -> DataFrame:
        """SRC5: scan, contract CON2, pseudonymise PII2 (documented PII policy), audit."""
        path = f"{self.raw_dir}/{filename}"
        out, n = self._checked(load_file(self.spark, path), INTERACTION_CONTRACT,
                              self.pseudonymizer.pseudonymize_interactions)
        self.audit.log(filename, path, n, "interactions")
        return out
