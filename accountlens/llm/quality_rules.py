"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document; the ledger keeps the measurements and one long whose bit i tells that rule
i failed. Policies are masks over those bits, with versions, so a changed policy or an ablation never reads a text
again: a document is kept if (bits & mask) = 0, and what each rule alone rejects is counted from the distinct bit
patterns, of which there are at most 2 ** len(RULES).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from accountlens.llm.common import free_name, ship_package, table

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stutter", "n_upper")
SYMBOLS = "#*$%&|<>"
WINDOW = 8

#: Rule i sets bit i: a name and the SQL condition, over the measurements, under which a document fails.
RULES = (
    ("too_short", "n_words < 20"),
    ("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    ("too_long", "n_words > 1000000"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 15 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("duplicate_lines", "100 * n_dup_lines > 50 * n_lines"),
    ("stutter", "100 * n_stutter > 40 * n_words"),
    ("upper_case", "2 * n_upper > word_chars"),
)
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}
BASE = BIT["too_short"] | BIT["repeated_windows"]

#: Policies by version: the rules that reject.
POLICIES = {
    "base": BASE,
    "v1": BASE | BIT["symbols"] | BIT["duplicate_lines"],
    "v2": sum(BIT.values()),
    "v3": sum(BIT.values()) - BIT["too_long"],  # length alone says nothing against a text
}
CURRENT = "v3"
#: The policy of the pipeline.
PIPELINE = CURRENT


def _repeat_words(ids: np.ndarray) -> int:
    """Words inside an 8-word window that occurs at least twice; windows are compared exactly, by ranks of pairs of
    ranks (windows of 2, 4, then 8 words)."""
    if len(ids) <= WINDOW:
        return 0
    for step in (1, 2, 4):
        pairs = ids[:-step].astype(np.int64) * (int(ids.max()) + 1) + ids[step:]
        ids = np.unique(pairs, return_inverse=True)[1]
    starts = np.flatnonzero(np.bincount(ids)[ids] > 1)
    if not len(starts):
        return 0
    edge = np.zeros(len(ids) + WINDOW, np.int64)
    edge[starts] += 1
    edge[starts + WINDOW] -= 1
    return int((np.cumsum(edge) > 0).sum())


def measure(text: str | None) -> tuple[int, ...]:
    """The measurements of one text, in the order of MEASURES; null counts as empty."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes split at exactly space and \\t \\n \\v \\f \\r
    n = len(words)
    codes: dict[bytes, int] = {}
    ids = np.fromiter((codes.setdefault(w, len(codes)) for w in words), np.int64, n)
    seen, n_lines, n_dup = set(), 0, 0
    for line in raw.split(b"\n"):
        if line.strip():
            n_lines += 1
            n_dup += line in seen
            seen.add(line)
    spaces = sum(text.count(c) for c in " \t\n\x0b\f\r")
    octets = np.frombuffer(raw, np.uint8)
    upper = int(((octets >= 65) & (octets <= 90)).sum())
    return (n, len(text) - spaces, sum(text.count(c) for c in SYMBOLS), n_dup, _repeat_words(ids), n_lines,
            int((ids[1:] == ids[:-1]).sum()), upper)


def _measures(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        yield pd.DataFrame([measure(t) for t in texts], columns=list(MEASURES), dtype="int64")


def with_ledger(docs: DataFrame, column: str, text_col: str = "text") -> DataFrame:
    """Append the struct ``column``: the measurements and ``fail_bits``. Only the text goes to Python and back.

    A null text counts as empty (0 words: too short). Repeated rows get equal ledgers; other columns stay, whatever their names.
    """
    ship_package(docs.sparkSession)
    held = free_name(docs, "__measures__")
    raw = F.col(held)
    bits = sum((F.when(F.expr(_of(condition, held)), F.lit(1 << i)).otherwise(F.lit(0))
                for i, (_, condition) in enumerate(RULES)), F.lit(0)).cast("long")
    measures = F.pandas_udf(_measures, ", ".join(f"{m} long" for m in MEASURES))
    measured = docs.withColumn(held, measures(F.col(text_col)))
    return measured.withColumn(column, F.struct(*[raw[m].alias(m) for m in MEASURES], bits.alias("fail_bits"))).drop(held)


def _of(condition: str, struct: str) -> str:
    for m in MEASURES:
        condition = condition.replace(m, f"{struct}.{m}")
    return condition


def passes(bits: Column, policy: str = CURRENT) -> Column:
    return bits.bitwiseAND(F.lit(POLICIES[policy])) == 0


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, every measurement and ``fail_bits``.

    A null text counts as empty (0 words: too short). Repeated rows stay. An empty table gives an empty ledger.
    Columns other than id and text are not looked at, so their names do not matter.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return with_ledger(docs, "ledger").select("doc_id", "ledger.*")


def filter_documents(docs: DataFrame, policy: str = CURRENT, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the policy keeps, with all their columns and nothing else.

    A null or empty text is too short and goes. Repeated rows stay or go together. An empty table gives an empty result.
    """
    column = free_name(docs, "__ledger")
    return with_ledger(docs, column, text_col).where(passes(F.col(column)["fail_bits"], policy)).select(*docs.columns)


def ablations(rows: DataFrame, policies: dict[str, int] | None = None) -> DataFrame:
    """From a ledger: per policy version and rule, how many documents the rule fails, how many it alone rejects, and
    how many the policy keeps with and without it. Patterns of bits are counted first; the texts are not read."""
    patterns = rows.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    listed = F.array(*[F.struct(F.lit(v).alias("policy"), F.lit(mask).cast("long").alias("mask"), F.lit(name).alias("rule"),
                                F.lit(bit).cast("long").alias("bit"))
                       for v, mask in (policies or POLICIES).items() for name, bit in BIT.items() if mask & bit])
    cases = patterns.select("fail_bits", "n", F.explode(listed).alias("c")).select("fail_bits", "n", "c.*")
    failed = F.col("fail_bits").bitwiseAND(F.col("mask"))
    count = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0))
    return cases.groupBy("policy", "rule").agg(
        count(failed.bitwiseAND(F.col("bit")) != 0).alias("fails"),
        count(failed == F.col("bit")).alias("rejects_alone"),
        count(failed == 0).alias("kept"),
        count(failed.bitwiseAND(F.bitwise_not(F.col("bit"))) == 0).alias("kept_without"))


def rejected_alone_by(bits: Column, policy: str = CURRENT) -> Column:
    """The rule without which the policy would keep the document; null if there is none or more than one is needed."""
    failed = bits.bitwiseAND(F.lit(POLICIES[policy]))
    return F.coalesce(*[F.when(failed == bit, F.lit(name)) for name, bit in BIT.items()])


def judged_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op3: measurements, the base rules' outcome, the current policy's verdict and the rule that alone decides it."""
    rows = ledger(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       (~passes(F.col("fail_bits"), "base")).alias("base_failed"),
                       passes(F.col("fail_bits")).alias("kept"),
                       "fail_bits", "n_lines", "n_stutter", "n_upper",
                       rejected_alone_by(F.col("fail_bits")).alias("rejected_alone_by"))


ORACLE_SQL = r"""WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM t WHERE len(ws) >= 8)
), twice AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM windows) WHERE c > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest(range(8)) AS k) GROUP BY doc_id
), lines AS (
  SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT line) AS dup
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM t)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), m AS (
  SELECT t.doc_id, len(ws) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(lines.dup, 0) AS n_dup_lines,
         coalesce(covered.n, 0) AS n_repeat_words, coalesce(lines.n, 0) AS n_lines,
         len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) AS n_stutter,
         length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper
  FROM t LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)
), b AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    (CASE WHEN n_words < 20 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END)
    + (CASE WHEN n_words > 1000000 THEN 4 ELSE 0 END) + (CASE WHEN word_chars < 2 * n_words THEN 8 ELSE 0 END)
    + (CASE WHEN word_chars > 15 * n_words THEN 16 ELSE 0 END) + (CASE WHEN 10 * n_symbols > n_words THEN 32 ELSE 0 END)
    + (CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 64 ELSE 0 END)
    + (CASE WHEN 100 * n_stutter > 40 * n_words THEN 128 ELSE 0 END)
    + (CASE WHEN 2 * n_upper > word_chars THEN 256 ELSE 0 END) AS fail_bits
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, fail_bits & POLICY = 0 AS kept,
       fail_bits::BIGINT AS fail_bits, n_lines, n_stutter, n_upper, CASE fail_bits & POLICY RULES END AS rejected_alone_by
FROM b""".replace("POLICY", str(POLICIES[CURRENT])).replace("RULES", " ".join(f"WHEN {b} THEN '{n}'" for n, b in BIT.items()))
