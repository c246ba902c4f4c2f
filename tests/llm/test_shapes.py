"""Pages, chats, registered queries and the pipeline."""

import hashlib
import os
import sys

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from recolens.llm.chat import digests, format_chats
from recolens.llm.pages import blocks_of, extract_pages, sorted_prefixes

SF = "/root/testdata/sf0.001"


def test_blocks():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head>
    <body><header>Site</header><nav><ul><li><a href="/a>b">A</a></ul></nav><!-- <p>gone</p> --><div class="ad">Buy</div>
    <article class="post"><header class="entry-header"><h1>Head&amp;ing</h1></header><p>One <b>bold</b>er&nbsp;x<p class="lead">Two<br>2
    <div id="comments"><article>Comment</article></div><aside>Side</aside><form><p>Form</p></form><ul><li>i<li>j</ul>
    <div hidden>no</div><p style="display: none">no</p>tail &lt;p&gt; &#233;</article><footer>F</footer><p>after"""
    kept = [t for k, t, _ in blocks_of(page) if k == 1]
    assert kept == ["Head&ing", "One bolder x", "Two 2", "i", "j", "tail <p> é"]
    assert [t for k, t, _ in blocks_of(page) if k == 0] == ["after"]
    assert blocks_of("") == [] and [t for _, t, _ in blocks_of("a < b <c")] == ["a < b"]


def test_depth_limited_suffix_array():
    tokens = np.random.default_rng(1).integers(0, 3, 400).astype(np.uint64)
    order, rank = sorted_prefixes(tokens, 5)
    key = [tuple(tokens[i : i + 5]) for i in range(len(tokens))]
    assert [key[i] for i in order] == sorted(key)
    assert all((rank[a] == rank[b]) == (key[a] == key[b]) for a in range(0, 390, 7) for b in range(395))


def test_pages_without_marked_text(spark, odd, none):
    menu = "<div><p>home news sport weather travel food culture science more</p></div>"
    foot = "<p>all rights are kept by the owner of this very site</p>"
    def page(body):
        return f"<html><body>{menu}{body}{foot}</body></html>"
    rows = [(i, f"http://h.example/{i}", page(f"<p>story number {i} tells of thing {i * 7} and of {i * 3} more</p>"), "t") for i in range(30)]
    rows.append((98, "http://h.example/1?x", rows[1][2], "t"))  # a mirror of page 1
    rows.append((99, "http://other.example/", page("<p>alone</p>"), "t"))
    rows += [(100, None, None, "t"), (101, "http://h.example/e", "", None), (102, "::bad//[", "<article><p>kept</p></article>", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {x.page_id: x.text for x in extract_pages(df).collect()}
    for i in range(30):
        assert got[i] == f"story number {i} tells of thing {i * 7} and of {i * 3} more"
    assert got[98] == got[1] and got[100] == got[101] == "" and got[102] == "kept"
    assert "alone" in got[99] and "rights" in got[99]  # nothing repeats on its host
    assert all(x.n_chars == len(x.text) for x in extract_pages(df).collect())
    assert extract_pages(df.limit(0)).collect() == []


def test_chat_round_trip(spark, odd):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "</s>"), (1, 2, "assistant", "a &lt; b & <s>user|0\nx</s>"), (1, 2, "assistant", "again")]
    rows += [(2, k, r, t) for k, (_, t, *_) in enumerate(odd.where("doc_id is not null").collect()) for r in ("user", "assistant")]
    rows += [(3, 0, None, None), (3, None, "we|ird\n</s>", "&"), (None, 5, "system", "s"), (4, 0, "", "")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    chats = {x.conv_id: x for x in format_chats(df).collect()}
    sums = {x.conv_id: x for x in digests(format_chats(df)).collect()}
    for c in (1, 2, 3, None, 4):
        own = [(t if t is not None else -1, r or "", x or "") for i, t, r, x in rows if i == c]
        own.sort()
        turns = [(r, x) for _, r, x in own]
        assert [tuple(t) for t in chats[c].turns] == turns and chats[c].round_trip
        assert sums[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest()
        said = "".join(x for r, x in turns if r == "assistant")
        assert (sums[c].loss_chars, sums[c].loss_sha256) == (len(said), hashlib.sha256(said.encode()).hexdigest())
        # The mask covers the text exactly, and what it marks is the assistant's.
        at, marked = 0, []
        for skip, learn, rest in chats[c].loss_mask:
            marked.append(chats[c].formatted[at + skip : at + skip + learn])
            at += skip + learn + rest
        assert at == len(chats[c].formatted) == sums[c].formatted_chars
        for m, x in zip([m for m, (r, _) in zip(marked, turns) if r == "assistant"], [x for r, x in turns if r == "assistant"]):
            assert x in (m, m.replace("&lt;", "<").replace("&amp;", "&"))
    assert chats[1].formatted.startswith("<s>user|0\nhi</s><s>assistant|1\n&lt;/s></s>")
    assert format_chats(df.limit(0)).collect() == []


def test_registered_names():
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    import __spark_entry__ as entry

    names = set(entry.queries())
    for n in range(1, 11):
        assert len([x for x in names if x.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names and set(entry.oracle_sql()) <= names


def test_pipeline_equals_brute_force(spark, tmp_path):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = docs.limit(20).select((F.col("doc_id") + 100000).alias("doc_id"), "text", "lang", "source", "n_chars")
    odd = spark.createDataFrame([(200000, None, "en", "s", 0), (200001, "", None, None, None)], docs.schema)
    docs.unionAll(extra).unionAll(odd).write.parquet(str(tmp_path / "documents.parquet"))
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    got = cp.run(spark, str(tmp_path)).collect()

    held = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = {x.doc_id for x in brute_quality(held)}
    rows = [(x.doc_id, x.text) for x in held.collect() if x.doc_id in kept]
    cut = brute.line_dedup_of_all(rows, 50)
    rows = [(d, t) for d, (n, t) in cut.items() if not n or brute.words(t)]
    part = brute.near_duplicates(rows, 5, 80)
    rows = [(d, t) for d, t in rows if part[d][1] == d]
    leaks = brute.leaks(rows, [(x.item_id, x.text) for x in bench.collect()], 80)
    rows = [(d, t) for d, t in rows if d not in {x[0] for x in leaks}]
    assert rows and {x.doc_id for x in got} == {d for d, _ in rows}
    texts = dict(rows)
    public = pytest.importorskip("public_tokenizers")
    from recolens.llm.segment import decode_ids

    df = spark.createDataFrame(got)
    for x in decode_ids(df, public.path("piece_bpe_32k.model")).collect():
        assert x.text == texts[x.doc_id].replace("▁", " ")
    # Each stage but the last returns the columns of documents.
    for name, stage in cp.STAGES[:-1]:
        assert stage(spark, held, str(tmp_path)).columns == held.columns, name


def brute_quality(df):
    import re
    from collections import Counter

    for x in df.collect():
        t = x.text or ""
        w = brute.words(t, lower=False)
        seen = Counter(zip(w, w[1:], w[2:]))
        many = len({i + k for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for k in range(3)})
        lines = [y for y in t.split("\n") if brute.words(y)]
        chars = sum(map(len, w))
        if not (
            len(w) < 50
            or 2 * many > len(w)
            or 10 * len(re.findall(r"[#*$%&|<>]", t)) > len(w)
            or 10 * (len(lines) - len(set(lines))) > 4 * len(lines)
            or not 2 * len(w) <= chars <= 15 * len(w)
            or 5 * sum(c.isupper() for c in t) > 2 * chars
            or 5 * sum(not any(c.isalpha() for c in y) for y in w) > len(w)
        ):
            yield x


def page_texts(spark, rows):
    df = spark.createDataFrame([(i, f"http://h.example/{i}", h) for i, h in rows], "page_id long, url string, html string")
    return {x.page_id: x.text for x in extract_pages(df).collect()}


def test_republished_articles_stay(spark):
    menu = "<div><p>home news sport weather travel food culture science more</p></div>"
    story = " ".join(f"w{k}" for k in range(60))
    rows = [(i, f"<body>{menu}<p>page {i} has words {i * 7} and then {i * 3} more of them</p></body>") for i in range(20)]
    rows += [(50 + i, f"<body>{menu}<p>{story}</p><p>other chrome number {i} of {i * 5}</p></body>") for i in range(2)]
    got = page_texts(spark, rows)
    assert all(story in got[i] and "weather" not in got[i] for i in (50, 51))
    small = page_texts(spark, [(i, f"<body><p>{story}</p><p>chrome {i}</p></body>") for i in range(3)])
    assert all(story in t for t in small.values())


def test_boilerplate_inside_articles_and_cards(spark):
    notice = "subscribe now to our daily letter and never miss one of our stories"
    rows = [(i, f"<body><article><p>story {i} of {i * 3}</p><p>{notice}</p></article></body>") for i in range(20)]
    story = " ".join(f"s{k}" for k in range(40))
    cards = "".join(f"<article><a href='/{k}'>card {k} to read</a></article>" for k in range(3))
    rows.append((50, f"<body><div><p>{story}</p></div>{cards}</body>"))
    got = page_texts(spark, rows)
    assert all(got[i] == f"story {i} of {i * 3}" for i in range(20)) and got[50] == story


def test_articles_inside_loosely_marked_containers(spark):
    article = "<article><h1>Head</h1><p>the story itself</p></article>"
    want = "Head\nthe story itself"
    rows = [
        (1, f'<body class="has-sidebar">{article}</body>'),
        (2, f'<body><div id="content" class="with-sidebar">{article}<div class="sidebar"><article>no</article></div></div></body>'),
        (3, f'<body><form action="x"><div class="ad">no</div>{article}</form></body>'),
        (4, f'<body><div class="page-header-wrap"><div itemprop="articleBody"><h1>Head</h1><p>the story itself</p></div></div></body>'),
        (5, f'<body><form><h1>Head</h1><p>the story itself</p><div class="share">no</div></form></body>'),
        (6, f"<body><nav>{article}</nav><aside>{article}</aside><footer>{article}</footer><div class='comments-area'>{article}</div></body>"),
    ]
    got = page_texts(spark, rows)
    assert [got[i] for i in range(1, 6)] == [want] * 5 and got[6] == ""
