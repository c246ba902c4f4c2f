"""Registered queries of this folder and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from recolens.llm import merkle, segment
from recolens.llm.chat import digests, format_chats
from recolens.llm.dac import read_documents, write_tokens
from recolens.llm.decontaminate import find_leaks
from recolens.llm.kneser_ney import held_out, score, train
from recolens.llm.licenses import scan_licenses
from recolens.llm.linededup import line_dedup
from recolens.llm.minhash import near_duplicates
from recolens.llm.pages import extract_pages
from recolens.llm.quality import quality_report
from recolens.llm.setjoin import jaccard_components
from recolens.llm.trie import prefix_trie, respliced, turn_rows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), size=4, percent=80)


WORDS = r"""list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '')"""

ORACLES["op1_minhash"] = f"""
WITH RECURSIVE w AS (SELECT doc_id, {WORDS} AS ws FROM documents),
s AS (SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
        ELSE list_distinct(list_transform(range(1, len(ws) - 2),
             lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] || ' ' || ws[i + 3])) END) AS sh FROM w),
z AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id
      GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN z x ON x.doc_id = a JOIN z y ON y.doc_id = b
      WHERE 100 * common >= 80 * (x.n + y.n - common)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT doc_id, coalesce(z.n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM c LEFT JOIN z USING (doc_id)"""


@query
def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality_report(table(spark, folder, "documents"))


ORACLES["op7_quality"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
        list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT doc_id, unnest(range(1, len(ws) - 1)) AS i,
        unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || chr(9) || ws[i + 1] || chr(9) || ws[i + 2])) AS s FROM w),
h AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1),
k AS (SELECT doc_id, least(3, lead(i, 1, i + 3) OVER (PARTITION BY doc_id ORDER BY i) - i) AS n FROM h),
r AS (SELECT doc_id, sum(n)::BIGINT AS n_repeat_words FROM k GROUP BY doc_id),
m AS (SELECT doc_id, text, ws, ls, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
        len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
        (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
      FROM w LEFT JOIN r USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR 10 * n_dup_lines > 4 * len(ls) OR word_chars < 2 * n_words
    OR word_chars > 15 * n_words OR 5 * len(regexp_extract_all(text, '\p{Lu}')) > 2 * word_chars
    OR 5 * len(list_filter(ws, lambda x: NOT regexp_matches(x, '\p{L}'))) > n_words
    OR 10 * len(list_filter(ls, lambda l: regexp_matches(l, '^\s*[-*•]'))) > 9 * len(ls)
    OR 10 * len(list_filter(ls, lambda l: regexp_matches(l, '(\.\.\.|…)\s*$'))) > 3 * len(ls)) AS kept
FROM b"""


@query
def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    out = line_dedup(table(spark, folder, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", "text")


@query
def op4_chat(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text"
    )
    said = "</s>[INST] ok [/INST]"
    own = spark.sql(
        f"select -7L as conv_id, t as turn, r as role, '{said}' as text from values (0L, 'user'), (1L, 'assistant') as v(t, r)"
    )
    return digests(format_chats(rows.unionAll(own)))


ORACLES["op4_chat"] = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
f AS (SELECT *, contains(text, '</s>') OR contains(role, '</s>') OR contains(role, chr(10)) AS esc FROM c),
g AS (SELECT *, CASE WHEN esc
    THEN length(replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '|', '&#124;'), chr(10), '&#10;'))
       + length(replace(replace(text, '&', '&amp;'), '<', '&lt;'))
    ELSE length(role) + length(text) END + 10 AS n FROM f)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(n)::BIGINT AS formatted_chars, true AS round_trip
FROM g GROUP BY conv_id"""


@query
def op5_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op6_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(table(spark, folder, "documents"))


@query
def op2_token_codes(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return read_documents(write_tokens(table(spark, folder, "documents"), path, end_id=1))


@query
def op8_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = train(docs.where(~held_out()), order=3)
    return score(docs, model).select(
        "doc_id", held_out().alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score", "score", "perplexity",
    )


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query
def op9_segmentations(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return segment.encode_samples(docs, piece_model())


@query
def op3_pages(spark: SparkSession, folder: str) -> DataFrame:
    return extract_pages(table(spark, folder, "pages"))


@query
def op12_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_components(table(spark, folder, "documents"), size=3, percent=90)


ORACLES["op12_jaccard_join"] = f"""
WITH RECURSIVE w AS (SELECT doc_id, {WORDS} AS ws FROM documents),
s AS (SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
        ELSE list_distinct(list_transform(range(1, len(ws) - 1),
             lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) END) AS sh FROM w),
z AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id
      GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN z x ON x.doc_id = a JOIN z y ON y.doc_id = b
      WHERE 100 * common >= 90 * (x.n + y.n - common)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT doc_id, coalesce(z.n, 0) AS n_shingles, component_id FROM c LEFT JOIN z USING (doc_id)"""


#: CRC-32 of a short ASCII text, bit by bit, in DuckDB.
CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split({0}, ''), lambda z: ord(z)::BIGINT)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
    lambda y, z: CASE WHEN y & 1 = 1 THEN xor(3988292384, y >> 1) ELSE y >> 1 END)))"""


@query
def op13_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    lowered = F.expr("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    leaf = merkle.leaf_of("doc_id", "source", "lang", "n_chars", "text")
    changed = merkle.leaf_of("doc_id", "source", "lang", "n_chars", lowered)
    rows = docs.select("doc_id", "lang", leaf.alias("leaf"), F.when(tampered, changed).otherwise(leaf).alias("held"))
    m = merkle.manifest(rows, "lang", ["doc_id"])
    return merkle.prove(m).select(
        F.col("doc_id").cast("long").alias("doc_id"), "leaf", "subroot", "root",
        merkle.proof_digest().alias("proof_sha256"), merkle.fold("held").alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.lit(m.root))


def _manifest_sql(levels: int = 11) -> str:
    """Both trees level by level, unrolled far beyond any table that DuckDB could hold."""
    leaf = "sha256(concat({}))"
    part = "coalesce(strlen({0}::VARCHAR) || ':' || {0}, '-')"

    def of(text: str) -> str:
        return leaf.format(", ".join(part.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)))

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    ctes = [
        f"d AS (SELECT doc_id, lang, {of('text')} AS h, {of(lower)} AS low, {CRC32.format('doc_id::VARCHAR')} % 3 = 0 AS hit FROM documents)",
        "p AS (SELECT *, CASE WHEN hit THEN low ELSE h END AS held, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h) - 1 AS pos FROM d)",
    ]

    def tree(name: str, key: str, first: str) -> str:
        ctes.append(f"{name}0 AS ({first})")
        for k in range(levels):
            # A level of one node is handed on as it is; `n` is the width of the level.
            ctes.append(
                f"{name}{k + 1} AS (SELECT {key} AS g, CASE WHEN n > 1 THEN pos // 8 ELSE pos END AS pos, "
                "CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE any_value(h) END AS h, "
                f"any_value(CASE WHEN n > 1 THEN (n + 7) // 8 ELSE 1 END) AS n FROM {name}{k} GROUP BY 1, 2)"
            )
        return f"{name}{levels}"

    def climb(name: str, start: str) -> str:
        """Doubles the columns proof and fold of `start` (x, g, pos, proof, fold) through the tree's levels."""
        last = start
        for k in range(levels):
            ctes.append(
                f"{name}c{k} AS (SELECT x, any_value(s.g) AS g, any_value(CASE WHEN t.n > 1 THEN s.pos // 8 ELSE s.pos END) AS pos, "
                "any_value(s.proof) || coalesce(string_agg(t.h, '' ORDER BY t.pos) FILTER (t.pos <> s.pos AND t.n > 1), '') AS proof, "
                "CASE WHEN any_value(t.n) > 1 THEN sha256(coalesce(string_agg(t.h, '' ORDER BY t.pos) FILTER (t.pos < s.pos), '') "
                "|| any_value(s.fold) || coalesce(string_agg(t.h, '' ORDER BY t.pos) FILTER (t.pos > s.pos), '')) ELSE any_value(s.fold) END AS fold "
                f"FROM {last} s JOIN {name}{k} t ON t.g IS NOT DISTINCT FROM s.g AND t.pos // 8 = s.pos // 8 GROUP BY x)"
            )
            last = f"{name}c{k}"
        return last

    top = tree("t", "g", "SELECT lang AS g, pos, h, count(*) OVER (PARTITION BY lang) AS n FROM p")
    ctes.append(f"r AS (SELECT g AS lang, h, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS pos FROM {top})")
    root = tree("u", "g", "SELECT 0 AS g, pos, h, count(*) OVER () AS n FROM r")
    ctes.append("q AS (SELECT *, row_number() OVER () AS x FROM p)")
    ctes.append("s0 AS (SELECT x, lang AS g, pos, '' AS proof, held AS fold FROM q)")
    up = climb("t", "s0")
    ctes.append(f"s1 AS (SELECT c.x, 0 AS g, r.pos, c.proof, c.fold FROM {up} c JOIN r ON r.lang IS NOT DISTINCT FROM c.g)")
    end = climb("u", "s1")
    return (
        "WITH " + ",\n".join(ctes) + f"\nSELECT doc_id, q.h AS leaf, r.h AS subroot, w.h AS root, sha256(e.proof) AS proof_sha256, "
        f"e.fold AS folded_root, e.fold = w.h AS verified FROM q JOIN {end} e USING (x) "
        f"JOIN r ON r.lang IS NOT DISTINCT FROM q.lang, {root} w"
    )


ORACLES["op13_manifest"] = _manifest_sql()


@query
def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    rows = turn_rows(table(spark, folder, "conversations"))
    conv = F.col("conv_id")
    heads = (F.crc32(conv.cast("string").cast("binary")) % 6).cast("int")
    rebuilt = respliced(rows, base=conv - conv % 100, heads=heads, most=5)
    return prefix_trie(rebuilt, rows.where("pos = 1").select("conv_id"))


ORACLES["op11_prefix_trie"] = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, role, sha256(text)) AS ts FROM c GROUP BY 1),
h AS (SELECT *, ({CRC32.format('conv_id::VARCHAR')} % 6)::INT AS h FROM o),
r AS (SELECT h.conv_id, list_concat(coalesce(b.ts[1:h.h], []), h.ts[h.h + 1:]) AS ts
      FROM h LEFT JOIN o b ON b.conv_id = h.conv_id - h.conv_id % 100),
p AS (SELECT conv_id, d, ts[1:d] AS k, d = len(ts) AS here FROM (SELECT *, unnest(range(len(ts) + 1)) AS d FROM r)),
n AS (SELECT d, k, min(conv_id) AS conv_id, count(*) AS n_convs,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (here), '')) AS ends_sha256,
        (count(*) - 1) * coalesce(length(k[d].text), 0) AS own FROM p GROUP BY d, k),
f AS (SELECT d - 1 AS d, k[1:d - 1] AS k, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN f USING (d, k)),
s AS (SELECT a AS d, k[1:a] AS k, count(*) FILTER (n_children = 0) AS n_leaves, sum(own)::BIGINT AS saved_tokens
      FROM (SELECT *, unnest(range(d + 1)) AS a FROM m) GROUP BY ALL)
SELECT m.conv_id, m.d AS depth, u.conv_id AS parent_conv_id, m.n_convs, m.n_children, n_leaves, saved_tokens, m.ends_sha256
FROM m JOIN s USING (d, k) LEFT JOIN n u ON u.d = m.d - 1 AND u.k = m.k[1:m.d - 1]"""
