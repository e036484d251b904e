r"""Chat formatting in plain relational steps: collect the turns, sort them, merge adjacent turns of a role, concatenate.

A message of the output is ``<|start|>role<|message|>text<|end|>``; adjacent turns of one role share a message, and
``<|turn|>`` stands between their texts. A backslash in a text or role is doubled, and a control string (:data:`CONTROL`) gets a
backslash after its first character. So no text can hold a mark, and reading ``\x`` as ``x`` gives the text back.

Turns are ordered by turn, role, text. The loss mask has one entry per turn, in order: pass over ``skip`` characters of
the output, learn ``learn``, pass over ``rest``; only texts of the role to learn are learned, without marks.

A conversation is one output row, so its turns meet in one task; there is no other grouping.

Defined results: a null text or role is empty; long texts are formatted whole, and as a conversation is one row, all of its texts together must stay
below the 2 GB of a string; a null conversation id is a conversation; equal turn numbers and repeated rows are turns of their own; other
columns of the input are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, MESSAGE, TURN, END = "<|start|>", "<|message|>", "<|turn|>", "<|end|>"
# What may not stand in a text as it is: the marks of this template and of other common ones (fixed values).
CONTROL = r"<\|[a-z_]+\|>", r"</?s>", r"\[/?INST\]", r"<</?SYS>>"
_AHEAD = r"([<\[])(?=\|[a-z_]+\|>|/?s>|/?INST\]|</?SYS>>)"


def escape(c: Column) -> Column:
    return F.regexp_replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), _AHEAD, r"$1\\")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def format_chats(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", learn: str = "assistant"
) -> DataFrame:
    """One row per conversation: ``conv``, ``formatted`` and ``loss_mask`` (array of skip, learn, rest)."""
    said = F.struct(
        F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    turns = df.select(F.col(conv).alias("_conv"), said.alias("_said")).groupBy("_conv").agg(F.array_sort(F.collect_list("_said")).alias("_turns"))

    def piece(t: Column, i: Column) -> Column:
        same = lambda j: F.get(F.col("_turns"), j)["role"] == t["role"]
        head = F.when(F.coalesce(same(i - 1), F.lit(False)), F.lit(TURN)).otherwise(F.concat(F.lit(START), escape(t["role"]), F.lit(MESSAGE)))
        tail = F.when(F.coalesce(same(i + 1), F.lit(False)), F.lit("")).otherwise(F.lit(END))
        return F.struct(head.alias("head"), escape(t["text"]).alias("body"), tail.alias("tail"), (t["role"] == learn).alias("learned"))

    pieces = turns.select("_conv", F.transform("_turns", piece).alias("_pieces"))

    def mask(p: Column) -> Column:
        body = F.length(p["body"])
        return F.struct(
            F.length(p["head"]).alias("skip"), F.when(p["learned"], body).otherwise(0).alias("learn"),
            (F.when(p["learned"], 0).otherwise(body) + F.length(p["tail"])).alias("rest"),
        )

    return pieces.select(
        F.col("_conv").alias(conv),
        F.array_join(F.transform("_pieces", lambda p: F.concat(p["head"], p["body"], p["tail"])), "").alias("formatted"),
        F.transform("_pieces", mask).alias("loss_mask"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of an output: array of role, text."""
    def turns(message: Column) -> Column:
        halves = F.split(message, r"<\|message\|>", 2)
        role = unescape(F.substr(halves[0], F.lit(len(START) + 1)))
        return F.transform(F.split(halves[1], r"<\|turn\|>"), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    messages = F.filter(F.split(formatted, r"<\|end\|>"), lambda m: m != "")
    return F.flatten(F.transform(messages, turns))


def read_loss(formatted: Column, mask: Column) -> Column:
    """All text under the loss mask, unescaped."""
    pieces = F.split(formatted, r"(?=<\|start\|>|<\|turn\|>)")
    learned = F.zip_with(pieces, mask, lambda p, m: F.when(m["learn"] > 0, p.substr(m["skip"] + 1, m["learn"])).otherwise(""))
    return unescape(F.array_join(learned, ""))


def _sql_escape(c: str) -> str:
    return rf"regexp_replace(replace({c}, '\', '\\'), '([<\[])(\|[a-z_]+\|>|/?s>|/?INST\]|</?SYS>>)', '\1\\\2', 'g')"


CHAT_SQL = rf"""
WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), r AS (
    SELECT *, coalesce(lag(role) OVER w = role, false) AS goes_on FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length({_sql_escape('text')}) + CASE WHEN goes_on THEN {len(TURN)}
                ELSE {len(START) + len(MESSAGE) + len(END)} + length({_sql_escape('role')}) END) AS BIGINT) AS formatted_chars
FROM r GROUP BY conv_id"""
