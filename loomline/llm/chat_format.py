"""Chat formatting with a grammar round trip, in Spark SQL functions only.

Grammar of a formatted conversation:

    conversation := turn*
    turn         := "<|im_start|>" role "\\n" text "<|im_end|>" "\\n"

Neither role nor text has a control string in it: a turn ends at its first "<|im_end|>".

A conversation is rendered as it is, reparsed by the grammar and compared with its
source turns. Where they differ (a text or role holds control strings, or what
looks like an escape), its contents are escaped and it is rendered again: "<"
followed by k backslashes and "|" gets one backslash more, and a line feed inside a
role becomes "<|nl|>". That mapping is reversible and leaves no control string in
any content, so the second rendering parses back to its source. The parser always
undoes escapes, and the comparison is what decides whether any were needed.

Defined cases: a null text or role is empty; turns are ordered by (turn, role, text)
so ties have one order, null turns first; repeated rows are turns of their own; a
null conv_id is a conversation; only conv_id, turn, role and text are read, so other
columns can't clash, whatever their names; a text of any length is one row's, and a
conversation has to fit in a task; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END, LINE_FEED = "<|im_start|>", "<|im_end|>", "<|nl|>"


def escape(text: str) -> str:
    return rf"regexp_replace({text}, r'<(\\*)\|', r'<\\$1|')"


def unescape(text: str) -> str:
    return rf"regexp_replace({text}, r'<\\(\\*)\|', r'<$1|')"


def _render(turns: str, role: str, text: str) -> str:
    return rf"array_join(transform({turns}, t -> concat('{START}', {role}, '\n', {text}, '{END}\n')), '')"


def render_raw(turns: str) -> str:
    return _render(turns, "t.role", "t.text")


def render_escaped(turns: str) -> str:
    return _render(turns, rf"replace({escape('t.role')}, '\n', '{LINE_FEED}')", escape("t.text"))


def parse(rendered: str) -> str:
    """array<struct<role, text>> of a formatted conversation; null where it breaks the grammar."""
    pieces = rf"filter(split({rendered}, r'<\|im_start\|>', -1), (x, i) -> i > 0)"
    whole = rf"forall(p, x -> x rlike r'(?s)\A[^\n]*\n.*<\|im_end\|>\n\z' and instr(x, '{END}') = length(x) - {len(END)}) and substr({rendered}, 1, {len(START)}) = '{START}'"
    role = rf"replace(substring_index(x, '\n', 1), '{LINE_FEED}', '\n')"
    body = rf"substr(x, length(substring_index(x, '\n', 1)) + 2, length(x) - length(substring_index(x, '\n', 1)) - {len(END) + 2})"
    turns = rf"transform(p, x -> named_struct('role', {unescape(role)}, 'text', {unescape(body)}))"
    return rf"element_at(transform(array({pieces}), p -> if({whole}, {turns}, null)), 1)"


def format_chats(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row a conversation: conv, formatted string, recovered array<struct<role, text>>, escaped boolean.

    recovered is what the parser reads back from formatted; a conversation that
    can't be recovered raises an error, which the escape rules out.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    grouped = turns.groupBy(F.col(conv).alias("conv")).agg(
        F.sort_array(F.collect_list(F.struct(F.col(turn).alias("turn"), blank(role).alias("role"), blank(text).alias("text")))).alias("turns")
    )
    source = grouped.select("conv", F.expr("transform(turns, t -> named_struct('role', t.role, 'text', t.text))").alias("source"))
    raw = source.withColumn("raw", F.expr(render_raw("source")))
    tried = raw.withColumn("same", F.expr(f"coalesce({parse('raw')} = source, false)"))
    shown = tried.select("conv", "source", F.expr(f"if(same, raw, {render_escaped('source')})").alias("formatted"), (~F.col("same")).alias("escaped"))
    read = shown.withColumn("recovered", F.expr(parse("formatted")))
    checked = F.expr("if(recovered <=> source, recovered, cast(raise_error('a conversation does not parse back') as array<struct<role: string, text: string>>))")
    return read.select(F.col("conv").alias(conv), "formatted", checked.alias("recovered"), "escaped")


def digest(turns: Column) -> Column:
    joined = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return F.sha2(joined, 256)


def loss_text(turns: Column) -> Column:
    """What the loss mask covers: the assistant's texts, once each, in order."""
    said = F.filter(turns, lambda t: t["role"] == F.lit("assistant"))
    return F.array_join(F.transform(said, lambda t: t["text"]), "")
