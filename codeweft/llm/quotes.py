"""Quotation linking: conversations in reply order, without what they quote.

A line's quote level is the number of ``>`` it starts with; lines of one level in a
row are a passage. A passage, and each line of it, is hashed in normal form (marks
off, lower case, white space as one space) and joined with the messages of the same
conversation that said the same themselves: as a whole, in a paragraph or in a line.
The original of a passage is the first such message, so each hash has one row per
conversation, and a phrase that is quoted all the time joins with that row alone.

A message replies to the original of its outermost passage. Roots of reply chains
are found by pointer jumping over (conversation, turn), in as many rounds as the
longest chain has binary digits. Ordered by root and turn, every reply follows what
it replies to.

All of it is built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codeweft.llm.common import keep
from codeweft.llm.quality import let

_MARKS = r"^(?:[ \t]*>)+"
_SAID = r"^\s*(?:On|Am|Le|El)\b.*(?:wrote|schrieb|a écrit|escribió).*:\s*$"


def _normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def _lines(text: Column) -> Column:
    """Level, words and number of each line; the line that introduces a quotation
    counts as quoted."""

    def line(x: Column) -> Column:
        marks = F.regexp_extract(x, _MARKS, 0)
        level = F.length(F.regexp_replace(marks, "[^>]", ""))
        return F.struct(level.alias("level"), F.regexp_replace(x, _MARKS + r" ?", "").alias("words"))

    parsed = F.transform(F.split(F.coalesce(text, F.lit("")), r"\r?\n", -1), line)

    def introduces(lines: Column) -> Column:
        return F.transform(
            lines,
            lambda x, i: F.struct(
                F.when(
                    (x["level"] == 0)
                    & F.rlike(x["words"], F.lit(_SAID))
                    & (F.coalesce(F.get(lines, i + 1)["level"], F.lit(0)) > 0),
                    -1,
                ).otherwise(x["level"]).alias("level"),
                x["words"].alias("words"),
            ),
        )

    return let(parsed, introduces)


def _passages(lines: Column) -> Column:
    """Runs of lines of one level, as level and lines; a run's start is found by
    looking back one line."""

    def cut(starts: Column) -> Column:
        return F.transform(
            starts,
            lambda at, i: F.slice(lines, at + 1, F.coalesce(F.get(starts, i + 1), F.size(lines)) - at),
        )

    starts = F.filter(
        F.sequence(F.lit(0), F.size(lines) - 1),
        lambda i: (i == 0) | (F.get(lines, i)["level"] != F.coalesce(F.get(lines, i - 1)["level"], F.lit(-9))),
    )
    runs = let(starts, cut)
    quoted = F.filter(runs, lambda run: run[0]["level"] > 0)
    return F.transform(quoted, lambda run: F.struct(run[0]["level"].alias("level"), F.transform(run, lambda x: x["words"]).alias("lines")))


def _hashes(lines: Column) -> Column:
    """Hashes of a text as a whole (0), of its paragraphs (1) and of its lines (2)."""
    whole = F.array_join(lines, "\n")
    return F.array_distinct(
        F.concat(_grain(F.array(whole), 0), _grain(F.split(whole, r"\n\s*\n", -1), 1), _grain(lines, 2))
    )


def _grain(items: Column, grain: int) -> Column:
    filled = F.filter(F.transform(items, _normal), lambda t: t != "")
    return F.transform(filled, lambda t: F.struct(F.lit(grain).alias("grain"), F.sha2(t, 256).alias("hash")))


def link_quotes(messages: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, reply_to, root, n_quotes, n_linked`` for every row
    of ``messages`` (conv_id, turn, role, text).

    ``text`` is without quotations. Null texts stay null and quote nothing. Rows
    without a conversation or a turn are not linked; their root is their own turn.
    Rows that repeat a turn each keep their text; as a place in a chain they are one,
    with the smallest turn that any of them replies to. A passage that no earlier
    message said is counted and left out like any other. Other columns are not read.
    """
    rows = messages.select("conv_id", "turn", "role", "text", _lines(F.col("text")).alias("lines"))
    rows = rows.withColumn("own", F.transform(F.filter("lines", lambda x: x["level"] == 0), lambda x: x["words"]))
    rows = rows.withColumn("passages", _passages(F.col("lines")))
    clean = F.regexp_replace(F.array_join("own", "\n"), r"^\s*\n|\s+$", "")
    rows = rows.withColumn(
        "clean", F.when(F.size("passages") == 0, F.col("text")).otherwise(clean)
    ).withColumn("passages", F.when(F.col("text").isNull(), F.array().cast(rows.schema["passages"].dataType)).otherwise(F.col("passages")))

    placed = rows.where("conv_id IS NOT NULL AND turn IS NOT NULL")
    quotes = keep(
        placed.where(F.size("passages") > 0)
        .select("conv_id", "turn", F.posexplode("passages").alias("passage", "p"))
        .select("conv_id", "turn", "passage", F.col("p.level").alias("level"), F.explode(_hashes(F.col("p.lines"))).alias("h"))
        .select("conv_id", "turn", "passage", "level", "h.grain", "h.hash")
        .distinct(),
        "quotes",
    )
    # What is quoted at all, so that nothing else is hashed into the join.
    asked = quotes.select("conv_id", "hash").distinct()
    said = placed.join(quotes.select("conv_id").distinct(), "conv_id", "left_semi")
    said = said.select("conv_id", "turn", F.explode(_hashes(F.col("own"))).alias("h")).select("conv_id", "turn", "h.grain", "h.hash")
    said = said.join(asked, ["conv_id", "hash"], "left_semi")
    said = said.groupBy("conv_id", "hash").agg(F.min("turn").alias("source"), F.min("grain").alias("whole"))
    found = quotes.join(said, ["conv_id", "hash"]).where("source < turn")
    found = found.groupBy("conv_id", "turn", "passage", "level").agg(F.min(F.struct("grain", "whole", "source")).alias("best"))
    found = found.select("conv_id", "turn", "level", F.col("best.source").alias("source"))
    linked = found.groupBy("conv_id", "turn").agg(
        F.min(F.struct("level", (-F.col("source")).alias("latest"))).alias("outer"), F.count("*").alias("n_linked")
    )
    linked = keep(linked.select("conv_id", "turn", (-F.col("outer.latest")).alias("reply_to"), "n_linked"), "linked")
    roots = _roots(linked.select("conv_id", "turn", "reply_to"))
    out = rows.select("conv_id", "turn", "role", F.col("clean").alias("text"), F.size("passages").cast("bigint").alias("n_quotes"))
    out = out.join(linked, ["conv_id", "turn"], "left").join(roots, ["conv_id", "turn"], "left")
    return out.select(
        "conv_id", "turn", "role", "text", "reply_to", F.coalesce("root", "turn").alias("root"), "n_quotes",
        F.coalesce("n_linked", F.lit(0)).cast("bigint").alias("n_linked"),
    )


def _roots(replies: DataFrame) -> DataFrame:
    """``conv_id, turn, root`` of all replies, by pointer jumping."""
    known = keep(replies.select("conv_id", "turn", F.col("reply_to").alias("root")), "roots")
    while True:
        above = known.select("conv_id", F.col("turn").alias("root"), F.col("root").alias("higher"))
        both = known.join(above, ["conv_id", "root"], "left")
        if both.where("higher IS NOT NULL").isEmpty():
            return known
        known = keep(both.select("conv_id", "turn", F.coalesce("higher", "root").alias("root")), "roots")
