"""Chat formatting: multi-party perspective rotation.

Every distinct speaker of a conversation is the assistant once; the others
become named users.  A rendered dialogue comes in segments of bounded length:
``text`` is the concatenation of the rendered messages, ``lengths`` their code
points and ``mask`` 1 for the messages of the perspective's speaker (the ones
to train on).  Joining the segments of one (conversation, speaker) in segment
order gives the whole dialogue.

A segment covers ``segment_turns`` turn numbers, so a conversation that holds a
third of all rows is spread over many groups.  Turns that hold more than
``segment_turns`` messages get segments of their own, split on the order key.

Defined results: messages are ordered by turn, then by md5(role, text) for
ties; exactly repeated rows are one message; a null role is the speaker
``unknown``, a null text is ''; rows without conversation id or turn belong to
no dialogue and each makes one of its own; ``<|`` in texts and names is
written ``< |`` so that content cannot forge a marker; an empty table gives no
rows.  Only built-in functions are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

SEGMENT_TURNS = 256
UNKNOWN = "unknown"


def rotate_perspectives(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                        text_col: str = "text", segment_turns: int = SEGMENT_TURNS) -> DataFrame:
    """Rows (conv_id, speaker, segment, sub, first_turn, n_messages, n_trained, text, lengths, mask)."""
    clean = lambda c, null: F.replace(F.coalesce(F.col(c).cast("string"), F.lit(null)), F.lit("<|"), F.lit("< |"))
    msgs = (conversations
            .select(F.col(id_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                    clean(role_col, UNKNOWN).alias("role"), clean(text_col, "").alias("text"))
            .distinct()
            .withColumn("key", F.md5(F.concat("role", F.lit("\x00"), "text")))
            .withColumn("loose", F.when(F.col("conv_id").isNull() | F.col("turn").isNull(), F.col("key"))))
    # turns with too many messages are split on the order key into parts of about segment_turns messages
    packed = (msgs.groupBy("conv_id", "turn").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > segment_turns)
              .select(F.col("conv_id").alias("c2"), F.col("turn").alias("t2"), F.ceil(F.col("n") / segment_turns).alias("parts")))
    msgs = (msgs.join(packed, (F.col("conv_id") == F.col("c2")) & (F.col("turn") == F.col("t2")), "left")
            .withColumn("segment", F.floor(F.col("turn") / segment_turns))
            .withColumn("own_turn", F.when(F.col("parts").isNotNull(), F.col("turn")))
            .withColumn("sub", F.when(F.col("parts").isNotNull(),
                                      F.shiftright(F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * F.col("parts"), 32))
                        .otherwise(F.lit(0).cast("long")))
            .drop("c2", "t2", "parts"))
    parts = (msgs.groupBy("conv_id", "loose", "segment", "own_turn", "sub")
             .agg(F.array_sort(F.collect_list(F.struct("turn", "key", "role", "text"))).alias("m")))
    speakers = (msgs.select(F.col("conv_id").alias("c3"), F.col("loose").alias("l3"), F.col("role").alias("speaker")).distinct())
    both = parts.join(speakers, F.col("conv_id").eqNullSafe(F.col("c3")) & F.col("loose").eqNullSafe(F.col("l3")))
    rendered = F.transform("m", lambda x: F.concat(
        F.when(x["role"] == F.col("speaker"), F.lit("<|assistant|>\n"))
        .otherwise(F.concat(F.lit("<|user name="), x["role"], F.lit("|>\n"))), x["text"], F.lit("<|end|>\n")))
    return (both.withColumn("r", rendered)
            .select("conv_id", "speaker", "segment", F.col("m")[0]["turn"].alias("first_turn"),
                    F.concat_ws(":", F.coalesce(F.col("own_turn").cast("string"), F.lit("")), F.col("sub").cast("string"), "loose").alias("sub"),
                    F.size("m").cast("long").alias("n_messages"),
                    F.size(F.filter("m", lambda x: x["role"] == F.col("speaker"))).cast("long").alias("n_trained"),
                    F.concat_ws("", "r").alias("text"),
                    F.transform("r", F.length).alias("lengths"),
                    F.transform("m", lambda x: F.when(x["role"] == F.col("speaker"), 1).otherwise(0)).alias("mask")))


def oracle(segment_turns: int = SEGMENT_TURNS) -> str:
    """DuckDB SQL of ``rotate_perspectives`` over the table conversations (lengths and mask comma-joined)."""
    order = "ORDER BY m.turn, m.key, m.role, m.text"
    own = "m.role = p.speaker"
    rendered = f"CASE WHEN {own} THEN '<|assistant|>\n' ELSE '<|user name=' || m.role || '|>\n' END || m.text || '<|end|>\n'".replace("\n", "' || chr(10) || '")
    return f"""WITH msgs AS (
  SELECT DISTINCT conv_id, turn, replace(coalesce(role, '{UNKNOWN}'), '<|', '< |') AS role, replace(coalesce(text, ''), '<|', '< |') AS text
  FROM conversations),
keyed AS (SELECT *, md5(role || chr(0) || text) AS key FROM msgs),
crowded AS (SELECT conv_id, turn, ceil(count(*) / {segment_turns})::BIGINT AS parts FROM keyed GROUP BY 1, 2 HAVING count(*) > {segment_turns}),
placed AS (
  SELECT k.*, CASE WHEN k.conv_id IS NULL OR k.turn IS NULL THEN k.key END AS loose, floor(k.turn / {segment_turns})::BIGINT AS segment,
    CASE WHEN c.parts IS NOT NULL THEN k.turn END AS own_turn,
    coalesce((('0x' || substr(k.key, 1, 8))::BIGINT * c.parts) >> 32, 0) AS sub
  FROM keyed k LEFT JOIN crowded c ON c.conv_id = k.conv_id AND c.turn = k.turn),
people AS (SELECT DISTINCT conv_id, loose, role AS speaker FROM placed)
SELECT m.conv_id, p.speaker, m.segment, concat_ws(':', coalesce(m.own_turn::VARCHAR, ''), m.sub::VARCHAR, m.loose) AS sub,
  min(m.turn) AS first_turn, count(*) AS n_messages, count(*) FILTER ({own}) AS n_trained,
  string_agg({rendered}, '' {order}) AS text, string_agg(length({rendered})::VARCHAR, ',' {order}) AS lengths,
  string_agg(CASE WHEN {own} THEN '1' ELSE '0' END, ',' {order}) AS mask
FROM placed m JOIN people p ON p.conv_id IS NOT DISTINCT FROM m.conv_id AND p.loose IS NOT DISTINCT FROM m.loose
GROUP BY m.conv_id, m.loose, p.speaker, m.segment, m.own_turn, m.sub"""
