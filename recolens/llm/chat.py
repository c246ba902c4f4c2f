"""Conversations as one training text each, checked by parsing the text back.

Grammar (`<s>`, `</s>` and the escape mark `&` are the only control strings):

    conversation = { turn }
    turn         = "<s>" role "|" form "\\n" content "</s>"
    form         = "0" (content as it is) | "1" (escaped)

A turn is first rendered as it is. The parser cuts the text at every `</s>`, reads `<s>`, the role up
to the last `|` of the first line, the form, and takes the rest as content. If parsing the rendered
turn does not give back this one turn, it is rendered again in form 1, in which `&` and `<` of role
and text are written `&amp;` and `&lt;` and line feeds and bars of the role `&#10;` and `&#124;`;
that form holds no control string, and parsing undoes it. The whole conversation is then parsed and
compared with its source turn by turn.

SQL expressions only. Turns are rendered, and their round trip is tested, before any shuffle; turns of
one conversation are put together by (conv_id, turn) ranges first, so that a conversation which holds
a large part of all rows reaches the last step as a few long pieces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from recolens.llm.quality import let

TRAINED_ROLE = "assistant"


def escape(value: str) -> str:
    return rf"replace(replace(replace(replace({value}, '&', '&amp;'), '<', '&lt;'), '|', '&#124;'), '\n', '&#10;')"


def unescape(value: str) -> str:
    return rf"replace(replace(replace(replace({value}, '&#10;', '\n'), '&#124;', '|'), '&lt;', '<'), '&amp;', '&')"


def escape_text(value: str) -> str:
    return f"replace(replace({value}, '&', '&amp;'), '<', '&lt;')"


def unescape_text(value: str) -> str:
    return f"replace(replace({value}, '&lt;', '<'), '&amp;', '&')"


PLAIN = r"concat('<s>', role, '|0\n', text, '</s>')"
ESCAPED = rf"concat('<s>', {escape('role')}, '|1\n', {escape_text('text')}, '</s>')"


def parse(rendered: str) -> str:
    """The turns (role, text, form, head) of a rendered text; `head` is the length before the content.

    A piece that is no turn gives a null role, so that it equals no source turn.
    """
    piece = (
        r"let_line -> if(startswith(p, '<s>') and let_line >= 6 and substr(p, let_line - 2, 1) = '|' "
        r"and substr(p, let_line - 1, 1) in ('0', '1'), "
        "if(substr(p, let_line - 1, 1) = '1', "
        f"struct({unescape('substr(p, 4, let_line - 6)')} as role, {unescape_text('substr(p, let_line + 1)')} as text, "
        "1 as form, let_line as head), "
        "struct(substr(p, 4, let_line - 6) as role, substr(p, let_line + 1) as text, 0 as form, let_line as head)), "
        "struct(cast(null as string) as role, p as text, 0 as form, 0 as head))"
    )
    turn = rf"transform(array(instr(p, '\n')), {piece})[0]"
    return let(
        f"split({rendered}, '</s>', -1)",
        "ps",
        # A text that does not end with </s> has one more piece, which parses as no turn.
        f"transform(filter(ps, (p, i) -> i < size(ps) - 1 or p <> ''), p -> {turn})",
    )


def rendered_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, rendered, form): the form is the first that survives the parser."""
    alone = let(parse("plain"), "t", "size(t) = 1 and t[0].role <=> role and t[0].text = text and t[0].form = 0")
    return (
        rows.withColumn("plain", F.expr(PLAIN))
        .withColumn("form", F.expr(f"if({alone}, 0, 1)"))
        .withColumn("rendered", F.expr(f"if(form = 0, plain, {ESCAPED})"))
        .drop("plain")
    )


def format_chats(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per conversation: conv_id, formatted, turns (as parsed from it), loss_mask, round_trip.

    `loss_mask` has one entry per turn, (skip, learn, rest) in code points: so many characters of the
    formatted text without loss, so many with it, so many without; assistant turns learn their content.
    `round_trip` tells whether the parsed turns equal the source. Null texts and roles are empty.
    Rows are taken by turn, ties by role and text; repeated rows are turns of their own; null turns
    come first. Rows without conv_id form one conversation with a null id. An empty table gives an
    empty result, other columns are ignored.
    """
    rows = rendered_turns(
        turns.select(
            F.col(conv).cast("long").alias("conv_id"),
            F.col(turn).cast("long").alias("turn"),
            F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        )
    )
    order = ["turn", "role", "text"]
    ordered = rows.repartitionByRange("conv_id", *order)
    joined = (
        ordered.groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(F.struct(*order, "rendered"))).alias("rs"))
        .select(
            "conv_id",
            F.expr("array_join(transform(rs, r -> r.rendered), '')").alias("formatted"),
            F.expr("transform(rs, r -> struct(r.role as role, r.text as text))").alias("source"),
        )
    )
    parsed = joined.select(
        "conv_id", "formatted", "source", F.expr(parse("formatted")).alias("parsed")
    )
    learns = f"t.role = '{TRAINED_ROLE}'"
    length = f"if(t.form = 1, char_length({escape_text('t.text')}), char_length(t.text))"
    return parsed.select(
        "conv_id",
        "formatted",
        F.expr("transform(parsed, t -> struct(t.role as role, t.text as text))").alias("turns"),
        F.expr(
            f"transform(parsed, t -> if({learns}, struct(t.head as skip, {length} as learn, 4 as rest), "
            f"struct(t.head + {length} + 4 as skip, 0 as learn, 0 as rest)))"
        ).alias("loss_mask"),
        F.expr("transform(parsed, t -> struct(t.role as role, t.text as text)) = source").alias("round_trip"),
    )


def digests(chats: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, round_trip."""
    said = r"array_join(transform(turns, t -> concat(t.role, '\n', t.text, '\n')), '')"
    learned = f"array_join(transform(filter(turns, t -> t.role = '{TRAINED_ROLE}'), t -> t.text), '')"

    def hexed(value: str) -> Column:
        return F.expr(f"sha2({value}, 256)")

    return chats.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        hexed(said).alias("turns_sha256"),
        F.expr(f"cast(char_length({learned}) as bigint)").alias("loss_chars"),
        hexed(learned).alias("loss_sha256"),
        F.expr("cast(char_length(formatted) as bigint)").alias("formatted_chars"),
        "round_trip",
    )
