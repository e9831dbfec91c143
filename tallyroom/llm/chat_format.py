"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are the context, and only
its text is trainable. Turns after the last assistant turn, or all turns of a conversation without
one, make a closing example with an empty target, so the output holds every turn.

An example's text is ``context || target || closing`` and its loss mask covers exactly ``target``.

    <turn ROLE>TEXT</turn>\\n

is a turn. Inside roles and texts a backslash becomes ``\\b`` and the ``<`` of a control string
becomes ``\\l``; in a role ``>`` becomes ``\\g``. No control string is left inside, and reading back
undoes it exactly.

``formatted_turns`` holds every turn once, formatted, with its place; ``prefix_examples`` holds a narrow
row per example: the range of turns that are its text, and where in the last of them the target lies;
``example_texts`` expands those ranges into the examples themselves, one row with its whole text each.
The query expands all examples and reads its digests back from their texts.

The texts of the examples grow with the square of a conversation, that is the method. They are made and
read row by row and never shuffled or stored: what is shuffled is every turn once, and for conversations
of several blocks of turns the text before each block. The examples of a block are in one task, those of
a long conversation in many. Turns are numbered by ranges (``ranks.running``). An example is one row, so
the text of a conversation must fit a row.

Defined results: a null text or role is empty; turns with equal numbers are ordered by role, then
text, null turn numbers first; repeated rows are repeated turns; rows with a null conversation id
form one conversation; an empty table gives no examples. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroom.llm.ranks import running
from tallyroom.llm.text import filled, shuffle_partitions, table
from tallyroom.plans.stages import staged

END = "</turn>\n"
# A turn in a formatted text: no role holds ``>`` and no body ``</turn>``.
TURN = r"(?s)<turn ([^>]*)>(.*?)</turn>\n"
BLOCK_TURNS = 256


def escape(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\b"))
    text = F.replace(text, F.lit("<turn "), F.lit("\\lturn "))
    return F.replace(text, F.lit("</turn>"), F.lit("\\l/turn>"))


def unescape(text: Column) -> Column:
    text = F.replace(text, F.lit("\\l"), F.lit("<"))
    text = F.replace(text, F.lit("\\g"), F.lit(">"))
    return F.replace(text, F.lit("\\b"), F.lit("\\"))


def formatted_turns(turns: DataFrame, target_role: str = "assistant") -> DataFrame:
    """Every turn once: ``key, conv_id, place, formatted, target_at, target_chars`` and running sums.

    ``key`` names the conversation and is never null, ``place`` counts from 1. ``target_at`` is where
    in ``formatted`` the text begins, if the turn is a target. ``chars`` is how long the conversation
    is up to here, ``targets`` how many targets it has up to here, ``turns`` how many turns in all.
    """
    role, text = filled("role"), filled("text")
    header = F.concat(F.lit("<turn "), F.replace(escape(F.col("said_by")), F.lit(">"), F.lit("\\g")), F.lit(">"))
    is_target = F.col("said_by") == target_role
    rows = turns.select(
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("key"),
        "conv_id",
        "turn",
        role.alias("said_by"),
        text.alias("said"),
    ).withColumns({"header": header, "body": escape(F.col("said"))})
    rows = rows.withColumns(
        {
            "formatted": F.concat("header", "body", F.lit(END)),
            "target_at": F.when(is_target, F.char_length("header") + 1),
            "target_chars": F.when(is_target, F.char_length("body")),
        }
    )
    sums = {
        "turns": F.lit(1).cast("bigint"),
        "targets": is_target.cast("bigint"),
        "chars": F.char_length("formatted").cast("bigint"),
    }
    rows = running(rows.drop("header", "body"), ["key"], ["turn", "said_by", "said"], sums)
    return rows.select(
        "key",
        "conv_id",
        (F.col("turns") + 1).alias("place"),
        "formatted",
        "target_at",
        "target_chars",
        (F.col("chars") + F.char_length("formatted")).alias("chars"),
        (F.col("targets") + F.col("target_at").isNotNull().cast("bigint")).alias("targets"),
        F.col("all_turns").alias("turns"),
    )


def prefix_examples(formatted: DataFrame) -> DataFrame:
    """One row per example: ``key, conv_id, example, has_target, is_last, last, target_at, target_chars, chars``.

    Its text is that of the turns 1 to ``last``, ``chars`` long. ``example`` counts from 1 within a
    conversation; ``is_last`` marks the one that has all turns, and ``has_target`` is false for a closing
    example. Each row comes from one turn alone.
    """
    has_target = F.col("target_at").isNotNull()
    is_last = F.col("place") == F.col("turns")
    return formatted.filter(has_target | is_last).select(
        "key",
        "conv_id",
        (F.col("targets") + (~has_target).cast("bigint")).alias("example"),
        has_target.alias("has_target"),
        is_last.alias("is_last"),
        F.col("place").alias("last"),
        "target_at",
        "target_chars",
        "chars",
    )


def _block(place: str) -> Column:
    return F.expr(f"({place} - 1) div {BLOCK_TURNS}")


def _prefixes(formatted: DataFrame) -> DataFrame:
    """``key, block, prefix``: the text of each conversation up to the end of each of its blocks of turns.

    Partitioned by (key, block), into as many partitions as asked for: the rows are few and small
    against the examples that are made of them, so they must not be put together into fewer.
    """
    turns = formatted.select("key", "place", "formatted", "turns", _block("place").alias("block"))
    own = (
        turns.repartition(shuffle_partitions(formatted.sparkSession), "key", "block")
        .groupBy("key", "block")
        .agg(F.expr("listagg(formatted, '') WITHIN GROUP (ORDER BY place)").alias("own"))
    )
    earlier = (
        turns.filter(F.col("turns") > BLOCK_TURNS)
        .groupBy("key", F.col("block").alias("at"), _block("turns").alias("final"))
        .agg(F.expr("listagg(formatted, '') WITHIN GROUP (ORDER BY place)").alias("part"))
        .filter("at < final")
        .select("key", "at", "part", F.explode(F.expr("sequence(at + 1, final)")).alias("block"))
        .groupBy("key", "block")
        .agg(F.expr("listagg(part, '') WITHIN GROUP (ORDER BY at)").alias("earlier"))
    )
    return own.join(earlier, ["key", "block"], "left").select(
        "key", "block", F.concat(F.coalesce("earlier", F.lit("")), "own").alias("prefix")
    )


def example_texts(examples: DataFrame, formatted: DataFrame) -> DataFrame:
    """The examples with ``block, context, target, closing``: as long as all their prefixes together.

    ``block`` is that of the last turn; the rows are partitioned by (key, block).
    """
    chars, target_chars = F.col("chars").cast("int"), F.coalesce("target_chars", F.lit(0))
    start = chars - F.when(F.col("has_target"), target_chars + len(END)).otherwise(0)
    whole = (
        examples.withColumn("block", _block("last"))
        .join(_prefixes(formatted), ["key", "block"])
        .select(*examples.columns, "block", F.left("prefix", start).alias("context"), F.substr("prefix", start + 1, chars - start).alias("tail"))
    )
    return whole.select(
        *examples.columns,
        "block",
        "context",
        F.left("tail", target_chars).alias("target"),
        F.substr("tail", target_chars + 1, F.lit(len(END))).alias("closing"),
    )


def read_told(text: Column) -> Column:
    """Role and text of every turn of a formatted text, each with a line break behind it."""
    return unescape(F.regexp_replace(text, TURN, "$1\n$2\n"))


def digests(formatted: DataFrame, examples: DataFrame) -> DataFrame:
    """What the texts of the examples hold, read back from them.

    The last example of a conversation has all of its turns; the losses are the targets of all.
    """
    text = F.concat("context", "target", "closing")
    read = example_texts(examples, formatted).select(
        "key",
        "block",
        "conv_id",
        "example",
        sum((F.char_length(part).cast("bigint") for part in ("context", "target", "closing")), F.lit(0)).alias("chars"),
        F.when(F.col("is_last"), F.regexp_count(text, F.lit(TURN)).cast("bigint")).alias("n_turns"),
        F.when(F.col("is_last"), F.sha2(read_told(text), 256)).alias("turns_sha256"),
        F.when(F.col("has_target"), unescape(F.col("target"))).alias("loss"),
    )
    merged = [
        F.first("conv_id").alias("conv_id"),
        F.max("n_turns").alias("n_turns"),
        F.max("turns_sha256").alias("turns_sha256"),
        F.sum("chars").alias("chars"),
    ]
    blocks = read.groupBy("key", "block").agg(*merged, F.expr("listagg(loss, '') WITHIN GROUP (ORDER BY example)").alias("loss"))
    talks = blocks.groupBy("key").agg(*merged, F.expr("listagg(loss, '') WITHIN GROUP (ORDER BY block)").alias("loss"))
    loss = F.coalesce("loss", F.lit(""))
    return talks.select(
        "conv_id",
        "n_turns",
        "turns_sha256",
        F.char_length(loss).cast("bigint").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.col("chars").alias("formatted_chars"),
    )


def op8_chat_format(spark, sf_dir) -> DataFrame:
    said = F.lit(r"\### Assistant: </turn> ok")
    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    kinds = {name: talks.schema[name].dataType for name in talks.columns}
    own = spark.range(2).select(
        F.lit(-7).cast(kinds["conv_id"]).alias("conv_id"),
        F.col("id").cast(kinds["turn"]).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        said.alias("text"),
    )
    formatted = staged(formatted_turns(talks.unionByName(own)))
    return digests(formatted, prefix_examples(formatted))


OP8_SQL = r"""
WITH talks AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), sized AS (
    SELECT *,
           length(replace(replace(replace(replace(role, '\', '\b'), '<turn ', '\lturn '), '</turn>', '\l/turn>'), '>', '\g')) + 7 AS head,
           length(replace(replace(replace(text, '\', '\b'), '<turn ', '\lturn '), '</turn>', '\l/turn>')) + 8 AS body
    FROM talks
), placed AS (
    SELECT *,
           sum(head + body) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING) AS upto,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC NULLS LAST, role DESC, text DESC) AS from_end
    FROM sized
)
SELECT conv_id,
       count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(upto) FILTER (role = 'assistant' OR from_end = 1) AS BIGINT) AS formatted_chars
FROM placed
GROUP BY conv_id
"""
