"""Chat formatting by multi-party perspective rotation, in DataFrame functions only.

For every participant of a conversation the whole dialogue is rendered once with that speaker as the assistant and
all others as named users; system turns stay system turns and are nobody's perspective. Character spans mark what is
trained on: the text and end mark of the assistant's own turns. A dialogue is rendered in pieces of at most 1,024
turn numbers, so that a conversation without end is never gathered in one group; a usual one is one piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from accountlens.llm.common import stratum, table

SYSTEM, UNKNOWN = "system", "unknown"
PIECE_TURNS = 1024
END = "<|end|>\n"


def rotations(turns: DataFrame, piece_turns: int = PIECE_TURNS) -> DataFrame:
    """conv_id, participant, piece, starts_at (characters in earlier pieces), n_turns, rendered, and ``spans`` (array
    of start and end, characters of ``rendered``, end exclusive) for every participant and piece.

    Turns are ordered by turn (null first), then speaker, then text. The same turn delivered twice (all four
    columns equal) is one turn. A null text is empty, a null role is the speaker ``unknown``, rows with a null
    conv_id are one conversation. ``<|`` in names and texts becomes ``< |``, so that no text can forge a mark. A
    conversation of system turns alone has no perspective. Other columns are not looked at. Empty in, empty out.
    """
    clean = lambda c: F.replace(c, F.lit("<|"), F.lit("< |"))
    said = turns.select(
        "conv_id", stratum(F.col("conv_id")).alias("conv"), "turn",
        clean(F.coalesce("role", F.lit(UNKNOWN))).alias("speaker"),
        clean(F.coalesce("text", F.lit(""))).alias("text")).distinct()
    people = said.where(F.col("speaker") != SYSTEM).select("conv", F.col("speaker").alias("participant")).distinct()
    own = F.col("speaker") == F.col("participant")
    head = (F.when(own, F.lit("<|assistant|>\n")).when(F.col("speaker") == SYSTEM, F.lit("<|system|>\n"))
            .otherwise(F.concat(F.lit("<|user name="), "speaker", F.lit("|>\n"))))
    parts = (said.join(people, "conv")
             .withColumn("piece", F.coalesce(F.floor(F.col("turn") / piece_turns), F.lit(-1)).cast("long"))
             .withColumn("head", head).withColumn("own", own))
    group = ["conv", "participant", "piece"]
    size = F.length("head") + F.length("text") + len(END)
    so_far = Window.partitionBy(*group).orderBy("turn", "speaker", "text")
    parts = (parts.withColumn("n", F.row_number().over(so_far))
             .withColumn("begin", F.sum(size).over(so_far.rowsBetween(Window.unboundedPreceding, 0)) - size))
    begin = (F.col("begin") + F.length("head")).alias("start")
    end = (F.col("begin") + size).alias("end")
    pieces = parts.groupBy(*group).agg(
        F.first("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_turns"), F.sum(size).alias("chars"),
        F.array_join(F.transform(F.array_sort(F.collect_list(
            F.struct("n", F.concat("head", "text", F.lit(END)).alias("s")))), lambda x: x["s"]), "").alias("rendered"),
        F.array_sort(F.collect_list(F.when(F.col("own"), F.struct(begin, end)))).alias("spans"))
    earlier = Window.partitionBy("conv", "participant").orderBy("piece").rowsBetween(Window.unboundedPreceding, 0)
    return pieces.select("conv_id", "participant", "piece", (F.sum("chars").over(earlier) - F.col("chars")).alias("starts_at"),
                         "n_turns", "rendered", "spans")


def rotated_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op6: every conversation from every participant's perspective; spans as text."""
    shown = F.array_join(F.transform("spans", lambda s: F.concat(s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))), ",")
    return rotations(table(spark, sf_dir, "conversations")).withColumn("spans", shown)


ORACLE_SQL = f"""WITH said AS (
  SELECT DISTINCT conv_id, turn, replace(coalesce(role, 'unknown'), '<|', '< |') AS speaker,
         replace(coalesce(text, ''), '<|', '< |') AS text FROM conversations
), people AS (
  SELECT DISTINCT conv_id, speaker AS participant FROM said WHERE speaker <> 'system'
), parts AS (
  SELECT said.*, participant, coalesce(floor(turn / {PIECE_TURNS}), -1)::BIGINT AS piece,
    CASE WHEN speaker = participant THEN '<|assistant|>' WHEN speaker = 'system' THEN '<|system|>'
         ELSE '<|user name=' || speaker || '|>' END || chr(10) AS head
  FROM said JOIN people ON said.conv_id IS NOT DISTINCT FROM people.conv_id
), placed AS (
  SELECT *, length(head) + length(text) + 8 AS size,
    sum(length(head) + length(text) + 8) OVER (PARTITION BY conv_id, participant, piece ORDER BY turn NULLS FIRST, speaker, text
      ROWS UNBOUNDED PRECEDING) AS stop FROM parts
), pieces AS (
  SELECT conv_id, participant, piece, count(*) AS n_turns, sum(size) AS chars,
    string_agg(head || text || '<|end|>' || chr(10), '' ORDER BY stop) AS rendered,
    coalesce(string_agg((stop - size + length(head))::BIGINT || ':' || stop::BIGINT, ',' ORDER BY stop)
      FILTER (speaker = participant), '') AS spans
  FROM placed GROUP BY ALL
)
SELECT conv_id, participant, piece, (sum(chars) OVER (PARTITION BY conv_id, participant ORDER BY piece
  ROWS UNBOUNDED PRECEDING) - chars)::BIGINT AS starts_at, n_turns, rendered, spans FROM pieces"""
