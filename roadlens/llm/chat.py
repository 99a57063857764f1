"""Chat formatting: every assistant turn becomes one training example."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<s>", "</s>"
# Strings that the chat template and its readers treat as marks.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]")


def escape(text: Column) -> Column:
    """Doubles backslashes and breaks every control string with one."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for mark in CONTROL:
        out = F.replace(out, F.lit(mark), F.lit(mark[0] + "\\" + mark[1:]))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\\n"))


def format_chat(turns: DataFrame, trainable: str = "assistant") -> DataFrame:
    """``turns(conv_id, turn, role, text)`` -> one row per example:
    ``conv_id, example, formatted, loss_start, loss_len``.

    A turn is written ``<s>role\\ntext</s>`` with role and text escaped. Each
    assistant turn gives an example that ends with it: all turns before are
    context, and only ``formatted[loss_start : loss_start + loss_len]`` (code
    points from 0), the reply's escaped text, is trained on. If the last turn
    is not the assistant's, one more example holds the whole conversation
    with an empty span, so no turn is lost.

    Turns are ordered by (turn, role, text), nulls first; null role and text
    are empty; repeated rows are repeated turns; rows without conv_id form
    one conversation; no rows give no rows; other columns are ignored.
    One shuffle by conv_id; an example holds all turns before it, so a
    conversation has to fit a row, as its digest and its prompts do."""
    t = turns.select(
        "conv_id",
        F.col("turn").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    conv = t.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("ts"))
    conv = conv.select(
        "conv_id",
        F.transform("ts", lambda x: F.struct(
            (x["role"] == trainable).alias("reply"),
            F.concat(F.lit(OPEN), _role(x["role"]), F.lit("\n")).alias("head"),
            escape(x["text"]).alias("body"),
        )).alias("ts"),
    )
    last = F.size("ts") - 1
    ends = F.filter(F.sequence(F.lit(0), last), lambda i: F.get("ts", i)["reply"] | (i == last))
    ex = conv.select("conv_id", "ts", F.posexplode(ends).alias("example", "end"))
    mark = F.get("ts", F.col("end"))
    context = F.array_join(
        F.transform(F.slice("ts", F.lit(1), F.col("end")), lambda x: F.concat(x["head"], x["body"], F.lit(CLOSE))), ""
    )
    ex = ex.select("conv_id", "example", F.concat(context, mark["head"]).alias("prompt"), mark["body"].alias("body"), mark["reply"].alias("reply"))
    return ex.select(
        "conv_id",
        "example",
        F.concat("prompt", "body", F.lit(CLOSE)).alias("formatted"),
        F.length("prompt").alias("loss_start"),
        F.when(F.col("reply"), F.length("body")).otherwise(0).alias("loss_len"),
    )


def read_back(examples: DataFrame) -> DataFrame:
    """Digests per conversation, read from the formatted text alone: the last
    example holds every turn, the loss spans hold the replies in order."""
    loss = unescape(F.substring(F.col("formatted"), F.col("loss_start") + 1, F.col("loss_len")))
    g = examples.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("whole"),
        F.sort_array(F.collect_list(F.struct("example", loss.alias("loss")))).alias("losses"),
        F.sum(F.length("formatted")).cast("long").alias("formatted_chars"),
    )
    # Close marks inside texts are escaped, so every one left ends a turn.
    parts = F.split(F.col("whole"), CLOSE)
    turns = F.slice(parts, 1, F.size(parts) - 1)
    pattern = r"(?s)^<s>((?:[^\\\n]|\\.)*)\n(.*)$"
    plain = F.transform(turns, lambda x: F.concat(
        unescape(F.regexp_extract(x, pattern, 1)), F.lit("\n"), unescape(F.regexp_extract(x, pattern, 2)), F.lit("\n")
    ))
    said = F.array_join(F.transform("losses", lambda x: x["loss"]), "")
    return g.select(
        "conv_id",
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(F.array_join(plain, ""), 256).alias("turns_sha256"),
        F.length(said).cast("long").alias("loss_chars"),
        F.sha2(said, 256).alias("loss_sha256"),
        "formatted_chars",
    )


_ESC = "replace(replace(replace(replace(replace({x}, '\\', '\\\\'), '<s>', '<\\s>'), '</s>', '<\\/s>'), '[INST]', '[\\INST]'), '[/INST]', '[\\/INST]')"
OP7_SQL = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), n AS (
  SELECT *, row_number() OVER w AS k, count(*) OVER (PARTITION BY conv_id) AS n,
    sum(8 + length(replace({_ESC.format(x="role")}, chr(10), '\\' || chr(10))) + length({_ESC.format(x="text")})) OVER (w ROWS UNBOUNDED PRECEDING) AS upto
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY k)) AS loss_sha256,
  sum(CASE WHEN role = 'assistant' OR k = n THEN upto ELSE 0 END)::BIGINT AS formatted_chars
FROM n GROUP BY conv_id
"""
