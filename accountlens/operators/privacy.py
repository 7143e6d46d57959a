"""Pseudonymisation of personal data (PII1-PII5) with native hash expressions.

The pseudonym is ``'anon_' + first 16 hex chars of SHA-256(salt + ':' + value)``:
a salted hash cut to 64 bits (not an HMAC). Collisions become likely only near
5e9 distinct values (birthday bound). Joins across runs need a fixed salt.
"""

from __future__ import annotations

import datetime as _dt
import os
import re
import secrets

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accountlens import constants as C
from accountlens.functions.expressions import pseudonym

SALT_ENV = "GDPR_SALT"


def resolve_salt(salt: str | None = None) -> str:
    """PII5: explicit salt, else the ``GDPR_SALT`` environment variable, else a random 64-hex salt."""
    return salt or os.environ.get(SALT_ENV) or secrets.token_hex(32)


class Pseudonymizer:
    """Replaces direct identifiers by salted-hash pseudonyms; the salt is never logged."""

    def __init__(self, salt: str | None = None):
        self._salt = resolve_salt(salt)

    def _hide_salt(self, spark: SparkSession) -> None:
        # the salt is a literal in the plan: redact it from plan strings and logs
        pattern = re.escape(self._salt)
        current = spark.conf.get("spark.sql.redaction.string.regex", None)
        if not current or pattern not in current:
            spark.conf.set("spark.sql.redaction.string.regex",
                           f"{current}|{pattern}" if current else pattern)

    def hash_column(self, col):
        """PII3: null stays null. The salt is hidden from plan strings of the active session."""
        if spark := SparkSession.getActiveSession():
            self._hide_salt(spark)
        return pseudonym(F.col(col) if isinstance(col, str) else col, self._salt)

    def _hash_present(self, df: DataFrame, columns) -> DataFrame:
        present = [c for c in columns if c in df.columns]
        if not present:
            return df
        self._hide_salt(df.sparkSession)
        return df.withColumns({c: self.hash_column(c) for c in present})

    def pseudonymize_employers(self, df: DataFrame, processed_at: str | None = None) -> DataFrame:
        """PII1: hash employer PII columns, stamp one processing time for the whole run."""
        stamp = processed_at or _dt.datetime.now().isoformat()
        out = self._hash_present(df, C.EMPLOYER_PII_COLUMNS)
        return out.withColumns({"gdpr_processed_at": F.lit(stamp), "gdpr_pseudonymized": F.lit(True)})

    def pseudonymize_interactions(self, df: DataFrame) -> DataFrame:
        """PII2: hash interaction PII columns; no stamp columns."""
        return self._hash_present(df, C.INTERACTION_PII_COLUMNS)

    @staticmethod
    def redact_column(df: DataFrame, column: str) -> DataFrame:
        """PII4: drop the column when present, otherwise a no-op."""
        return df.drop(column) if column in df.columns else df


def redact_column(df: DataFrame, column: str) -> DataFrame:
    return Pseudonymizer.redact_column(df, column)
