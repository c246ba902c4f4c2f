"""Quality rules on whole documents as a short-circuit cascade, in SQL expressions only.

Each rule rejects a document. On a bounded sample the cost of a rule is the time of a job
that evaluates it, less the time of splitting the words; its selectivity is the share it
rejects of what the rules before it left. The next rule of the cascade is always the one with the most such
rejections per cost. The order changes the work, never the verdict: a document is kept if no rule rejects it.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from recolens.llm.store import unused, written

#: Rows of the sample on which cost and selectivity are estimated.
SAMPLE_ROWS = 2000

SPACES = r"'[\\x20\\x09-\\x0D]+'"
WORDS = f"array_remove(split(text, {SPACES}), '')"


def let(value: str, name: str, body: str) -> str:
    """`body` with `name` bound to `value`, evaluated once."""
    return f"transform(array({value}), {name} -> {body})[0]"


N_SYMBOLS = "(size(split(text, '[#*$%&|<>]', -1)) - 1)"
LINES = r"filter(split(text, '\n'), l -> l rlike '[^\\x20\\x09-\\x0D]')"
N_DUP_LINES = let(LINES, "ls", "size(ls) - size(array_distinct(ls))")
WORD_CHARS = "char_length(array_join(w, ''))"
# Three-word windows by hash; only texts in which two are equal go on to sort them with positions.
N_REPEAT_WORDS = let(
    "transform(slice(w, 1, greatest(size(w) - 2, 0)), (x, i) -> xxhash64(x, w[i + 1], w[i + 2]))",
    "hs",
    "if(size(array_distinct(hs)) = size(hs), 0, "
    + let(
        "sort_array(transform(hs, (x, i) -> struct(x as h, i as i)))",
        "s",
        let(
            "sort_array(transform(filter(s, (e, i) -> e.h <=> get(s, i - 1).h or e.h <=> get(s, i + 1).h), e -> e.i))",
            "p",
            "aggregate(zip_with(p, slice(p, 2, size(p)), (a, b) -> least(b - a, 3)), 0, (c, v) -> c + v)",
        ),
    )
    + ")",
)


@dataclass(frozen=True)
class Rule:
    """`rejects`: a condition on the column `text` and its words `w`."""

    name: str
    rejects: str


BASE_RULES = (
    Rule("few_words", "size(w) < 50"),
    Rule("repeated_words", f"100 * {N_REPEAT_WORDS} > 50 * size(w)"),
)
RULES = (
    Rule("symbols", f"10 * {N_SYMBOLS} > size(w)"),
    Rule("repeated_lines", let(LINES, "ls", "10 * (size(ls) - size(array_distinct(ls))) > 4 * size(ls)")),
    Rule("word_length", f"{WORD_CHARS} < 2 * size(w) or {WORD_CHARS} > 15 * size(w)"),
    Rule("capitals", rf"5 * (size(split(text, '\\p{{Lu}}', -1)) - 1) > 2 * {WORD_CHARS}"),
    Rule("no_letters", r"5 * size(filter(w, x -> not x rlike '\\p{L}')) > size(w)"),
    Rule("bullets", let(LINES, "ls", r"10 * size(filter(ls, l -> l rlike '^\\s*[-*•]')) > 9 * size(ls)")),
    Rule("ellipses", let(LINES, "ls", r"10 * size(filter(ls, l -> l rlike '(\\.\\.\\.|…)\\s*$')) > 3 * size(ls)")),
)


def texts_of(docs: DataFrame, doc: str, text: str) -> DataFrame:
    return docs.select(F.col(doc).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))


def verdict(rules: tuple[Rule, ...]) -> str:
    """The first rule of the cascade that rejects, null if none does."""
    cases = " ".join(f"when {r.rejects} then '{r.name}'" for r in rules)
    return let(WORDS, "w", f"case {cases} end") if rules else "cast(null as string)"


def learn_order(
    docs: DataFrame, rules: tuple[Rule, ...], rows: int = SAMPLE_ROWS, seed: int = 11, text: str = "text"
) -> tuple[Rule, ...]:
    """The rules by rejections per second, given the rules before, on a sample of about `rows` rows."""
    total = docs.count()
    if not total or len(rules) < 2:
        return rules
    sample = texts_of(docs, text, text).sample(min(1.0, rows / total), seed)
    sample = written(sample.select("text"), "sample")
    judged = " + ".join(f"if({rule.rejects}, {1 << i}L, 0L)" for i, rule in enumerate(rules))
    # At most one row for each row of the sample.
    found = sample.groupBy(F.expr(let(WORDS, "w", judged)).alias("by")).count().collect()

    def seconds(condition: str) -> float:
        best = float("inf")
        for _ in range(2):
            begun = time.perf_counter()
            sample.agg(F.count_if(F.expr(let(WORDS, "w", condition)))).first()
            best = min(best, time.perf_counter() - begun)
        return best

    idle = seconds("size(w) < 0")
    costs = [max(seconds(rule.rejects) - idle, 0.02 * idle) for rule in rules]
    return tuple(rules[i] for i in cascade_order({x.by: x["count"] for x in found}, costs, [rule.name for rule in rules]))


def cascade_order(found: dict[int, int], costs: list[float], names: list[str]) -> list[int]:
    """Places of the rules, the most rejections per cost among what is left first; ties by cost, then name.

    `found` counts documents by the set of rules that reject them, as bits."""
    order, seen = [], 0
    while len(order) < len(costs):
        rest = [i for i in range(len(costs)) if i not in order]

        def rank(i):
            hits = sum(n for by, n in found.items() if not by & seen and by >> i & 1)
            return -hits / costs[i], costs[i], names[i]

        order.append(min(rest, key=rank))
        seen |= 1 << order[-1]
    return order


def quality_report(docs: DataFrame, rules: tuple[Rule, ...] = RULES, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept) per row.

    Nulls are texts without words, which fail. Every row is judged by itself, repeated rows alike; an
    empty table gives an empty result; other columns are ignored. `kept` is false for rows that fail
    the two base rules or any rule of the cascade, which is not evaluated for rows that failed before.
    """
    rows = texts_of(docs, doc, text)
    rules = learn_order(rows, rules)
    counted = rows.select(
        "doc_id",
        "text",
        F.expr(
            let(
                WORDS,
                "w",
                f"named_struct('n_words', size(w), 'word_chars', {WORD_CHARS}, 'n_repeat_words', {N_REPEAT_WORDS}, "
                + "'rejected', if(size(w) < 50, 'few_words', case "
                + " ".join(f"when {r.rejects} then '{r.name}'" for r in rules)
                + " end))"
                if rules
                else "",
            )
        ).alias("m"),
        F.expr(N_SYMBOLS).alias("n_symbols"),
        F.expr(N_DUP_LINES).alias("n_dup_lines"),
    )
    failed = F.expr("m.n_words < 50 or 100 * m.n_repeat_words > 50 * m.n_words")
    return counted.select(
        "doc_id",
        F.col("m.n_words").cast("long").alias("n_words"),
        F.col("m.word_chars").cast("long").alias("word_chars"),
        F.col("n_symbols").cast("long").alias("n_symbols"),
        F.col("n_dup_lines").cast("long").alias("n_dup_lines"),
        F.col("m.n_repeat_words").cast("long").alias("n_repeat_words"),
        failed.alias("base_failed"),
        (~failed & F.col("m.rejected").isNull()).alias("kept"),
    )


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + RULES) -> DataFrame:
    """The rows of `docs` that no rule rejects, all columns kept, whatever their names."""
    rules = learn_order(docs, rules)
    (rejected,) = unused(docs, "_rejected")
    held = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # The rules read `text`; the column itself comes back as it was.
    judged = docs.withColumn(rejected, F.struct(F.col("text").alias("was")))
    judged = judged.withColumn("text", held).withColumn(
        rejected, F.struct(F.col(f"`{rejected}`.was").alias("was"), F.expr(verdict(rules)).alias("rule"))
    )
    return judged.where(F.col(f"`{rejected}`.rule").isNull()).select(
        *[F.col(f"`{rejected}`.was").alias(c) if c.lower() == "text" else F.col(f"`{c}`") for c in docs.columns]
    )
