"""Prefix-target expansion of conversations: one training example per assistant turn."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

OPEN, BODY, CLOSE = "<s>[INST] ", " [/INST]", "</s>"
#: Control strings of the template, and what stands for them inside of texts.
CONTROLS = {"<s>": "<\\s>", "</s>": "<\\/s>", "[INST]": "[\\INST]", "[/INST]": "[\\/INST]"}


def escape(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control, stand_in in CONTROLS.items():
        text = F.replace(text, F.lit(control), F.lit(stand_in))
    return text


def unescape(text: Column) -> Column:
    """Takes one backslash off in front of whatever it escapes."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def examples(conversations: DataFrame) -> DataFrame:
    """Every assistant turn with all turns before it as context.

    Result: conv_id, n_turns, upto (turns in the example), formatted, loss_start (from
    0) and loss_length in code points: the mask covers the last reply only. Turns after
    the last reply make one more example without any masked text, so that no turn is
    lost. A turn is ``<s>[INST] role [/INST]text</s>`` with control strings escaped.

    Turns are ordered by turn, role and text (nulls first); repeated rows are repeated
    turns. Null roles and texts are empty, and a null conv_id is a conversation too.
    """
    turns = conversations.select(
        "conv_id",
        F.struct(
            "turn",
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        ).alias("t"),
    )
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    marked = whole.select(
        "conv_id",
        F.size("t").alias("n_turns"),
        F.transform(
            "t",
            lambda t: F.struct(
                (t["role"] == "assistant").alias("reply"),
                F.concat(F.lit(OPEN), escape(t["role"]), F.lit(BODY)).alias("head"),
                escape(t["text"]).alias("body"),
            ),
        ).alias("t"),
    )
    ends = F.filter(
        F.sequence(F.lit(1), F.col("n_turns")),
        lambda k: F.element_at("t", k)["reply"] | (k == F.col("n_turns")),
    )
    one = marked.select("conv_id", "n_turns", "t", F.explode(ends).alias("upto"))
    last = F.element_at("t", F.col("upto"))
    return one.select(
        "conv_id",
        "n_turns",
        "upto",
        F.array_join(
            F.transform(
                F.slice("t", F.lit(1), F.col("upto")),
                lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE)),
            ),
            "",
        ).alias("formatted"),
        F.when(last["reply"], F.length(last["body"])).otherwise(0).alias("loss_length"),
    ).select(
        "conv_id",
        "n_turns",
        "upto",
        "formatted",
        (F.length("formatted") - len(CLOSE) - F.col("loss_length")).alias("loss_start"),
        "loss_length",
    )


def turns_of(formatted: Column) -> Column:
    """The (role, text) turns that a formatted example holds."""
    pieces = F.split(formatted, CLOSE, -1)

    def turn(piece: Column) -> Column:
        split = F.instr(piece, F.lit(BODY))
        return F.struct(
            unescape(F.substr(piece, F.lit(len(OPEN) + 1), split - len(OPEN) - 1)).alias("role"),
            unescape(F.substr(piece, split + len(BODY))).alias("text"),
        )

    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), turn)


def digest(conversations: DataFrame) -> DataFrame:
    """Per conversation, what its examples say when they are read back."""
    read = examples(conversations).select(
        "conv_id",
        F.struct(
            "upto",
            F.length("formatted").cast("long").alias("chars"),
            unescape(
                F.substr("formatted", F.col("loss_start") + 1, F.col("loss_length"))
            ).alias("loss"),
            F.when(F.col("upto") == F.col("n_turns"), turns_of(F.col("formatted"))).alias("turns"),
        ).alias("e"),
    )
    grouped = read.groupBy("conv_id").agg(F.sort_array(F.collect_list("e")).alias("e"))
    turns = F.element_at("e", -1)["turns"]
    said = F.array_join(
        F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    loss = F.array_join(F.transform("e", lambda e: e["loss"]), "")
    return grouped.select(
        "conv_id",
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.aggregate("e", F.lit(0).cast("long"), lambda a, e: a + e["chars"]).alias("formatted_chars"),
        F.size("e").cast("long").alias("n_examples"),
    )


def with_control_case(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """The table and conversation -1, whose texts consist of control strings."""
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    return conversations.select("conv_id", "turn", "role", "text").unionByName(extra)


ORACLE_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), t AS (
  SELECT *, row_number() OVER w AS nr, count(*) OVER (PARTITION BY conv_id) AS n,
    22 + length(replace(replace(replace(replace(replace(role, '\', '\\'), '<s>', '<\s>'),
      '</s>', '<\/s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]'))
    + length(replace(replace(replace(replace(replace(text, '\', '\\'), '<s>', '<\s>'),
      '</s>', '<\/s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]')) AS chars
  FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), s AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY nr ROWS UNBOUNDED PRECEDING) AS upto,
    role = 'assistant' OR nr = n AS example FROM t
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY nr)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY nr) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(upto) FILTER (example)::BIGINT AS formatted_chars,
  count(*) FILTER (example) AS n_examples
FROM s GROUP BY conv_id
"""
