"""Multi-party perspective rotation of dialogues, with DataFrame functions only.

Every participant of a conversation gets the dialogue from their own side: their turns are the assistant's and are
trained on, all others' turns are a user's with the speaker's name and are masked. Turns with the role ``system`` belong
to nobody and stay system turns. A rendering is kept as one row for each turn with its place in the whole text, so a
conversation of any length is never put together in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.durable import durable

SYSTEM = "system"


def rotate(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, perspective, seq, turn, speaker, rendered, target, start, end, mask_start, mask_end``.

    One row for each (conversation, participant, turn). ``rendered`` is the turn as it stands in the participant's
    dialogue, which is all of them joined in the order of ``seq``; ``start`` and ``end`` are its place there. ``target``
    tells whether it is trained on, and then ``mask_start`` to ``mask_end`` is the stretch that counts: the turn's text
    and its end mark (code points; -1 elsewhere).

    Turns go by number, then speaker, then text; repeated rows stay. Null texts are empty; a turn without a role is
    said by "unknown"; turns without a number come first; rows without a conversation are left out, as are
    conversations in which only ``system`` speaks.

    Places are sums over all earlier turns. They are added up by partition of a range-partitioned order first and then
    over the partitions, so a conversation that holds much of the table is spread over many tasks.
    """
    turns = df.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("unknown")).alias("speaker"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).where("conv_id is not null")
    participants = turns.where(F.col("speaker") != SYSTEM).select("conv_id", F.col("speaker").alias("perspective")).distinct()
    named = F.concat(F.lit("<|user name="), F.col("speaker"), F.lit("|>\n"))
    lead = F.when(F.col("speaker") == SYSTEM, F.lit("<|system|>\n")).when(F.col("speaker") == F.col("perspective"), F.lit("<|assistant|>\n")).otherwise(named)
    views = turns.join(participants, "conv_id").withColumns({"lead": lead, "target": F.col("speaker") == F.col("perspective")})
    views = views.withColumn("rendered", F.concat("lead", "text", F.lit("<|end|>\n")))

    keys = ["conv_id", "perspective", "turn", "speaker", "text"]
    at = F.monotonically_increasing_id()
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = views.repartitionByRange(parts, *keys, F.xxhash64(F.monotonically_increasing_id())).sortWithinPartitions(*keys)
    placed = durable(placed.withColumns({"part": F.shiftright(at, 33), "pos": at}))

    side = ["conv_id", "perspective"]
    inside = Window.partitionBy(*side, "part").orderBy("pos")
    length = F.length("rendered").cast("long")
    local = placed.withColumns({"nth": F.row_number().over(inside), "upto": F.sum(length).over(inside.rowsBetween(Window.unboundedPreceding, 0))})
    totals = placed.groupBy(*side, "part").agg(F.count(F.lit(1)).alias("n"), F.sum(length).alias("chars"))
    before = Window.partitionBy(*side).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(*side, "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"), F.coalesce(F.sum("chars").over(before), F.lit(0)).alias("c0"))
    whole = local.join(carried, [*side, "part"]).withColumns({"end": F.col("c0") + F.col("upto"), "start": F.col("c0") + F.col("upto") - length})
    return whole.select(
        *side,
        (F.col("n0") + F.col("nth") - 1).alias("seq"),
        "turn",
        "speaker",
        "rendered",
        "target",
        "start",
        "end",
        F.when(F.col("target"), F.col("start") + F.length("lead")).otherwise(-1).alias("mask_start"),
        F.when(F.col("target"), F.col("end") - 1).otherwise(-1).alias("mask_end"),
    )


ORACLE_SQL = """
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), participants AS (
    SELECT DISTINCT conv_id, speaker AS perspective FROM turns WHERE speaker <> 'system'
), views AS (
    SELECT *, CASE WHEN speaker = 'system' THEN '<|system|>' || chr(10) WHEN speaker = perspective THEN '<|assistant|>' || chr(10)
        ELSE '<|user name=' || speaker || '|>' || chr(10) END AS lead, speaker = perspective AS target
    FROM turns JOIN participants USING (conv_id)
), placed AS (
    SELECT *, lead || text || '<|end|>' || chr(10) AS rendered,
        row_number() OVER w - 1 AS seq, sum(length(lead || text || '<|end|>' || chr(10))) OVER w AS fin
    FROM views WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, text ROWS UNBOUNDED PRECEDING)
)
SELECT conv_id, perspective, seq, turn, speaker, rendered, target, (fin - length(rendered))::BIGINT AS start, fin::BIGINT AS "end",
    CASE WHEN target THEN (fin - length(rendered) + length(lead))::BIGINT ELSE -1 END AS mask_start, CASE WHEN target THEN (fin - 1)::BIGINT ELSE -1 END AS mask_end
FROM placed
"""
