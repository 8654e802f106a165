r"""Chat formatting with a grammar round trip (DataFrame functions only).

Template, one segment a turn: ``<|im_start|>role\ntext<|im_end|>\n``. The grammar is strict: a
turn's text holds no control string, and an escaped control string is one with backslashes after
its first character (``<\/s>``). The parser is deterministic: it cuts the text at ``<|im_start|>``,
takes the role up to the first line break and the text up to ``<|im_end|>``, and removes one
backslash from every escaped control string.

Round trip: each turn is rendered raw and parsed again; a turn whose parse differs from its source
(it holds control strings, or strings that look escaped) has one backslash added to each of them
and is parsed again. ``round_trip`` tells that the whole conversation, read back from the
finished text, equals its source. Turns without conflicts are left as they are.

A conversation becomes one text, so its turns meet in one row; rows shuffle once, by conversation.

Defined results: turns are ordered by turn, then role, then text (ties and repeated rows are all
kept); a null turn comes first; null text or role counts as empty; a null conversation id is a
conversation of its own; an empty table gives an empty result; other columns are never read.
Roles may hold any characters (``%`` and line breaks are percent-encoded in the header).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import text_of
from quarry.llm.quality import let

HEAD, TAIL = "<|im_start|>", "<|im_end|>\n"

# Control strings of public chat templates, none of which may stand in a text.
# Each pattern matches what follows the first character.
OPENING = r"[<\[]"
REST = (r"/?s>|/?INST\]|<SYS>>|</SYS>>|\|im_start\|>|\|im_end\|>|\|endoftext\|>|\|eot_id\|>"
        r"|\|start_header_id\|>|\|end_header_id\|>|\|begin_of_text\|>|/?bos>|/?eos>|/?pad>|/?unk>"
        r"|start_of_turn>|end_of_turn>|\|system\|>|\|user\|>|\|assistant\|>")
CONTROL = rf"{OPENING}(?:{REST})"
ANY_LEVEL = rf"({OPENING})(\\*)({REST})"
ESCAPED = rf"({OPENING})\\(\\*)({REST})"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, ANY_LEVEL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, r"$1$2$3")


def encode_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def decode_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def parse(formatted: Column) -> Column:
    """array<struct<role, text>>: what the grammar reads; a segment that breaks it gives nulls."""
    def turn(segment: Column) -> Column:
        return let(F.instr(segment, "\n"), lambda cut: let(
            F.substr(segment, cut + 1, F.length(segment) - cut - len(TAIL)), lambda body: F.when(
                (cut > 0) & F.endswith(segment, F.lit(TAIL)) & ~body.rlike(CONTROL),
                F.struct(decode_role(F.substr(segment, F.lit(1), cut - 1)).alias("role"),
                         unescape(body).alias("text")))))
    segments = F.split(formatted, r"<\|im_start\|>", -1)
    return F.when(F.startswith(formatted, F.lit(HEAD)),
                  F.transform(F.slice(segments, 2, F.greatest(F.size(segments) - 1, F.lit(0))), turn))


def render_turn(role: Column, body: Column) -> Column:
    return F.concat(F.lit(HEAD), encode_role(role), F.lit("\n"), body, F.lit(TAIL))


def escaped_until_identical(role: Column, text: Column) -> Column:
    """The body under which the turn, rendered alone, parses back to exactly itself."""
    reads_back = lambda body: let(
        parse(render_turn(role, body)),
        lambda got: F.coalesce(got == F.array(F.struct(role.alias("role"), text.alias("text"))),
                               F.lit(False)))
    return F.when(reads_back(text), text).otherwise(escape(text))


def format_conversations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text",
                         loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: id, formatted, loss_spans (array of start and length in code
    points, start from 0), turns (parsed from ``formatted``), round_trip."""
    turns = rows.select(F.col(conv_col).alias("id"), F.struct(
        F.col(turn_col).alias("turn"), text_of(role_col).alias("role"),
        text_of(text_col).alias("text")).alias("x"))
    grouped = turns.groupBy("id").agg(F.sort_array(F.collect_list("x")).alias("xs"))
    parts = grouped.select("id", F.transform("xs", lambda x: F.struct(
        x["role"].alias("role"), x["text"].alias("text"),
        F.concat(F.lit(HEAD), encode_role(x["role"]), F.lit("\n")).alias("head"),
        escaped_until_identical(x["role"], x["text"]).alias("body"))).alias("xs"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(
        "array<struct<start:int,length:int>>").alias("spans"))

    def step(state: Column, x: Column) -> Column:
        body = state["at"] + F.length(x["head"])
        span = F.struct(body.alias("start"), F.length(x["body"]).alias("length"))
        return F.struct(
            (body + F.length(x["body"]) + len(TAIL)).alias("at"),
            F.when(x["role"] == loss_role, F.array_append(state["spans"], span))
            .otherwise(state["spans"]).alias("spans"))

    done = parts.select(
        "id", "xs", F.array_join(F.transform("xs", lambda x: F.concat(
            x["head"], x["body"], F.lit(TAIL))), "").alias("formatted"),
        F.aggregate("xs", start, step)["spans"].alias("loss_spans"))
    return done.select(
        "id", "formatted", "loss_spans", parse(F.col("formatted")).alias("turns"),
        F.transform("xs", lambda x: F.struct(x["role"], x["text"])).alias("source")
    ).select("id", "formatted", "loss_spans", "turns",
             F.coalesce(F.col("turns") == F.col("source"), F.lit(False)).alias("round_trip"))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, read from the formatted text, unescaped."""
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.substr(formatted, s["start"] + 1, s["length"]))), "")
