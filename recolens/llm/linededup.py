"""Repeated runs of lines across documents, found by winnowing and deleted where they come later.

Lines without a word are not counted. From each line on, the shortest stretch of following lines with
at least `words` words is a window, and so is the shortest stretch of lines up to each line; two
neighbours that are long enough alone make a window together. A run of `words` words or more is the
union of the windows inside it: those that start at its lines, and at its tail those that end at them.
So a window whose content stands at any earlier place, in (doc_id, line) order, is deleted, and what is
deleted is every run that stands earlier, at whatever place. The smallest line hash in a window is its
fingerprint: two places that share a window share it, so windows whose fingerprint occurs at one place
only are left out before the rest meet by content.

Everything is SQL over arrays of at most `words` lines for each window. Hot passages meet
combining minima and joins that adaptive execution may split; no group of documents is gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from recolens.llm.quality import SPACES, let
from recolens.llm.store import unused, written

#: Shortest run, in words, that is deleted where it repeats.
WORDS = 50


def counted_lines(text: str = "_text") -> str:
    """Lines with a word: (position among all lines, two hashes, number of words)."""
    of_line = f"size(array_remove(split(l, {SPACES}), ''))"
    return (
        rf"filter(transform(split({text}, '\n'), (l, i) -> struct(i as pos, xxhash64(l) as h, xxhash64(l, 1L) as g, {of_line} as n)), "
        "e -> e.n > 0)"
    )


def windows_of(words: int) -> str:
    """The windows of `ls`: first and last line (indices from 1), 128-bit content, fingerprint and its line."""
    start = "named_struct('n', 0, 'c', 0, 'hash', {seed}L, 'more', {seed}L, 'least', cast(null as bigint), 'at', 0)"
    step = (
        f"if(a.n >= {words}, a, named_struct('n', a.n + e.n, 'c', a.c + 1, 'hash', xxhash64(a.hash, e.h), 'more', xxhash64(a.more, e.g), "
        "'least', least(a.least, e.h), 'at', if(a.least is null or e.h < a.least, a.c, a.at)))"
    )
    ahead = f"aggregate(slice(ls, k, {words}), {start.format(seed=0)}, (a, e) -> {step})"
    back = f"aggregate(reverse(slice(ls, greatest(k - {words - 1}, 1), least(k, {words}))), {start.format(seed=1)}, (a, e) -> {step})"
    window = "named_struct('k', {k}, 'to', {to}, 'content', {w}.hash, 'more', {w}.more, 'fingerprint', {w}.least, 'line', {line})"
    forward = window.format(k="x.k", to="x.k + x.w.c - 1", w="x.w", line="x.k + x.w.at")
    backward = window.format(k="x.k - x.w.c + 1", to="x.k", w="x.w", line="x.k - x.w.at")
    both = (
        "named_struct('k', k, 'to', k + 1, 'content', xxhash64(2L, ls[k - 1].h, ls[k].h), 'more', xxhash64(2L, ls[k - 1].g, ls[k].g), "
        "'fingerprint', least(ls[k - 1].h, ls[k].h), 'line', if(ls[k].h < ls[k - 1].h, k + 1, k))"
    )
    # A stretch that is shortest both ways is listed once, as a forward window.
    return (
        "concat("
        f"transform(filter(transform(sequence(1, size(ls)), k -> named_struct('k', k, 'w', {ahead})), x -> x.w.n >= {words}), "
        f"x -> {forward}), "
        f"transform(filter(transform(sequence(1, size(ls)), k -> named_struct('k', k, 'w', {back})), "
        f"x -> x.w.n - ls[x.k - 1].n >= {words}), x -> {backward}), "
        f"transform(filter(sequence(1, size(ls)), k -> k < size(ls) and ls[k - 1].n >= {words} and ls[k].n >= {words}), "
        f"k -> {both}))"
    )


def repeated_runs(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(_doc, _key, runs): the line ranges (from, to; positions among all lines, merged) to delete.

    `docs` has _doc, _key and _text.
    """
    lines = docs.select("_doc", "_key", F.expr(counted_lines()).alias("ls")).where("size(ls) > 0")
    found = (
        f"transform({windows_of(words)}, x -> named_struct('k', x.k, 'to', x.to, 'content', x.content, 'more', x.more, "
        "'fingerprint', x.fingerprint, 'line', x.line, 'a', ls[x.k - 1].pos, 'b', ls[x.to - 1].pos))"
    )
    # A few numbers for each window: written once, as three steps read them and making them is the work.
    windows = lines.select("_doc", "_key", F.explode(F.expr(let("ls", "ls", found))).alias("e")).select(
        "_doc", "_key", "e.k", "e.a", "e.b", "e.content", "e.more", "e.fingerprint", "e.line"
    )
    windows = written(windows, "windows")
    place, chosen = F.struct("_doc", "_key", "k"), F.struct("_doc", "_key", "line")
    shared = (
        windows.groupBy("fingerprint").agg(F.min(chosen).alias("lo"), F.max(chosen).alias("hi"))
        .where("lo < hi").select("fingerprint")
    )
    posted = windows.join(shared, "fingerprint").drop("fingerprint", "line")
    first = (
        posted.groupBy("content", "more").agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .where("first < last").drop("last")
    )
    later = (
        posted.join(first, ["content", "more"]).where(place > F.col("first"))
        .groupBy("_doc", "_key").agg(F.collect_set(F.struct("a", "b")).alias("rs"))
    )
    merged = (
        "aggregate(array_sort(rs), cast(array() as array<struct<a:int,b:int>>), (d, r) -> "
        "if(size(d) > 0 and element_at(d, -1).b >= r.a - 1, "
        "concat(slice(d, 1, size(d) - 1), array(named_struct('a', element_at(d, -1).a, "
        "'b', greatest(element_at(d, -1).b, r.b)))), concat(d, array(r))))"
    )
    return later.select("_doc", "_key", F.expr(merged).alias("runs"))


def line_dedup(docs: DataFrame, words: int = WORDS, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with repeated runs cut out of `text`, and the columns n_lines and n_removed.

    A run of at least `words` words that stands earlier, in the same document or one with a smaller
    doc_id, is deleted; lines without words inside it go too. Rows that agree in doc_id and text are
    one document and are treated alike. Null doc_ids come first; a null text stays null and an empty
    one empty. Lines are compared by 128 bits of hash. All columns of `docs` come back unchanged but
    `text`, whatever their names, except that own columns named n_lines and n_removed are replaced.
    """
    docs = docs.drop("n_lines", "n_removed")
    own, key, held, runs = unused(docs, "_doc", "_key", "_text", "_runs")
    rows = docs.withColumns(
        {
            own: F.coalesce(F.col(doc).cast("long"), F.lit(-(2**63))),
            held: F.coalesce(F.col(text).cast("string"), F.lit("")),
        }
    ).withColumn(key, F.xxhash64(held))
    found = repeated_runs(
        rows.select(F.col(own).alias("_doc"), F.col(key).alias("_key"), F.col(held).alias("_text")), words
    ).dropDuplicates(["_doc", "_key"])
    cut = rows.join(found.toDF(own, key, runs), [own, key], "left")
    rest = F.expr(
        rf"array_join(filter(split(`{held}`, '\n'), (l, i) -> not exists(`{runs}`, r -> i between r.a and r.b)), '\n')"
    )
    return cut.withColumns(
        {
            text: F.when(F.col(runs).isNull(), F.col(text)).otherwise(rest),
            "n_lines": F.when(F.col(held) == "", 0).otherwise(F.expr(rf"size(split(`{held}`, '\n'))")).cast("long"),
            "n_removed": F.expr(f"coalesce(aggregate(`{runs}`, 0L, (s, r) -> s + r.b - r.a + 1), 0L)"),
        }
    ).select(*[f"`{c}`" for c in docs.columns], "n_lines", "n_removed")
