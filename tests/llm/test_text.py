"""Quality rules, line dedup, decontamination, licences."""

import random

import brute
import pytest
from recolens.llm.decontaminate import drop_leaks, find_leaks
from recolens.llm.licenses import TEMPLATES, scan_licenses
from recolens.llm.linededup import line_dedup
from recolens.llm.quality import BASE_RULES, RULES, Rule, cascade_order, keep_good, learn_order, quality_report


def test_quality_counts(spark, odd, none):
    from collections import Counter

    out = quality_report(odd).collect()
    assert len(out) == odd.count()
    texts = {d: t for d, t, *_ in odd.where("doc_id <> 3").collect()}
    for x in out:
        if x.doc_id in texts and x.doc_id != 3:
            w = brute.words(texts[x.doc_id], lower=False)
            seen = Counter(zip(w, w[1:], w[2:]))
            many = {i + k for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for k in range(3)}
            lines = [y for y in (texts[x.doc_id] or "").split("\n") if brute.words(y)]
            assert (x.n_words, x.word_chars, x.n_repeat_words) == (len(w), sum(map(len, w)), len(many))
            assert x.n_dup_lines == len(lines) - len(set(lines))
            assert x.base_failed == (len(w) < 50 or 2 * len(many) > len(w))
    assert quality_report(none).collect() == []


def test_order_changes_no_verdict(spark):
    r = random.Random(1)
    rows = [(i, " ".join(r.choice(["good", "words", "go", "###", "UP", "on"]) + str(r.randrange(60)) for _ in range(r.choice([20, 90])))) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    learned = learn_order(df, RULES)
    assert sorted(x.name for x in learned) == sorted(x.name for x in RULES)
    kept = {x.doc_id for x in keep_good(df).collect()}
    assert kept == {x.doc_id for x in quality_report(df, tuple(reversed(RULES))).where("kept").collect()}
    assert kept == {x.doc_id for x in keep_good(df, tuple(reversed(BASE_RULES + RULES))).collect()}


def test_cascade_order_counts_what_is_left():
    # a rejects 30 rows, b 20 of those and no other, c 5 others: b has nothing left to reject after a.
    assert cascade_order({0: 50, 0b001: 10, 0b011: 20, 0b100: 5}, [1.0, 1.0, 1.0], ["a", "b", "c"]) == [0, 2, 1]
    assert cascade_order({0b11: 7}, [5.0, 1.0], ["a", "b"]) == [1, 0]  # the same rows, at a lower cost


def test_cheap_rejecting_rule_is_first(spark):
    df = spark.createDataFrame([(i, "some words " * 200 + str(i)) for i in range(300)], "doc_id long, text string")
    slow = "size(filter(transform(w, x -> sha2(repeat(x, 20), 512)), x -> x like '0%')) >= 0"
    rules = (Rule("a_slow", slow), Rule("b_never", "size(w) < 0"), Rule("c_cheap", "size(w) > 100"))
    assert learn_order(df, rules)[0].name == "c_cheap"


def test_line_dedup_odd_rows(spark, odd, none):
    out = line_dedup(odd)
    assert out.count() == odd.count() and out.columns == [*odd.columns, "n_lines", "n_removed"]
    by = {}
    for x in out.collect():
        by.setdefault(x.doc_id, []).append(x)
    assert by[0][0].text is None and by[1][0].text == "" and by[90][0].text == ""
    assert [x.n_removed for x in by[7]] == [0, 0]  # equal rows are one document
    assert line_dedup(none).collect() == []


def test_leaks(spark, odd, none):
    r = random.Random(2)
    vocabulary = [f"v{i}" for i in range(3000)]
    items = [(i, " ".join(r.choice(vocabulary) for _ in range(n))) for i, n in enumerate([3, 5, 6, 20, 20, 60, 150])]
    items += [(50, None), (51, ""), (None, "lost"), (3, items[3][1])]
    docs, want = [], set()
    for d in range(40):
        words = [r.choice(vocabulary) for _ in range(r.choice([10, 300]))]
        if d % 2:
            i, t = r.choice(items[:7])
            at = r.randrange(len(words))
            own = t.split()
            if len(own) > 100 and d % 4 == 1:
                own[40] = "changed"
            words[at:at] = [own[0].upper() + ","] + own[1:]
            want.add((d, i))
        docs.append((d, " ".join(words)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = find_leaks(df, bench).collect()
    assert {(x.doc_id, x.item_id) for x in got} == want
    assert brute.leaks(docs, [x for x in items if x[0] is not None and x[1]], 80) == {
        (x.doc_id, x.item_id, x.start_word, round(x.similarity, 9)) for x in got
    }
    assert {x.doc_id for x in drop_leaks(df, bench).collect()} == {d for d, _ in docs} - {d for d, _ in want}
    assert find_leaks(odd, bench).count() == 0 and find_leaks(none, bench).count() == 0
    assert find_leaks(df, bench.limit(0)).count() == 0 and drop_leaks(odd, bench).count() == odd.count()


def test_licenses(spark, odd, none):
    rows = [
        (1, "prose here\nreleased under the mit license\nmore"),
        (2, "\n".join(TEMPLATES["Apache-2.0"].split(". "))),
        (3, "License of no kind. The MIT campus was released."),
        (4, TEMPLATES["GPL-3.0 short"] + "\n" + TEMPLATES["MIT"].replace("Software", "Program")),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = scan_licenses(df).collect()
    found = {(x.doc_id, x.license) for x in got}
    assert found == {(1, "MIT short"), (2, "Apache-2.0"), (4, "GPL-3.0 short"), (4, "MIT")}
    assert [(x.first_line, x.n_lines, x.dice) for x in got if x.doc_id == 1] == [(1, 1, 1.0)]
    best = brute.best_dice(rows, TEMPLATES, 80)
    assert {d: round(max(x.dice for x in got if x.doc_id == d), 9) for d in best} == best
    assert scan_licenses(odd).count() == 0 and scan_licenses(none).count() == 0


def test_every_licence_line_of_the_tables(spark):
    import re

    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    notice = re.compile(r"(?i)\blicen[cs]ed?\b|all rights reserved|public domain|permission is hereby|redistribution and use")
    rows = docs.where("lower(text) rlike 'licen[cs]e|all rights reserved|public domain|permission is hereby|redistribution and use'")
    want = {(x.doc_id, i) for x in rows.collect() for i, y in enumerate((x.text or "").split("\n")) if notice.search(y)}
    got = {(x.doc_id, x.first_line + k) for x in scan_licenses(docs).collect() for k in range(x.n_lines)}
    assert len(want) > 300 and want <= got


def test_license_names(spark):
    rows = [(i, TEMPLATES[n]) for i, n in enumerate(TEMPLATES)]
    rows.append((900, TEMPLATES["LGPL-3.0"].replace("version 3", "version 2.1")))
    rows.append((901, TEMPLATES["BSD-3-Clause"].split(" 3. Neither")[0]))
    got = scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    named = {i: n for i, n in enumerate(TEMPLATES)} | {900: "LGPL-2.1", 901: "BSD-2-Clause"}
    assert {(x.doc_id, x.license) for x in got} == set(named.items()) and all(x.dice == 1 for x in got)


def test_licenses_inside_lines(spark):
    r = random.Random(6)
    prose = [r.choice("the of in a license software any is under this work by for with and".split()) for _ in range(900)]
    before, after = " ".join(prose[:450]), " ".join(prose[450:])
    rows = [
        (1, "Copyright 2020 Jane Doe. Released under the MIT License."),
        (2, "This code is released under the MIT License by Jane Doe."),
        (3, f"{before} {TEMPLATES['MIT']} {after}"),
        (4, f"{before} zz {TEMPLATES['Apache-2.0'].replace('CONDITIONS', 'TERMS')} zz {after} zz All rights reserved. zz"),
        (5, "All rights reserved. " * 3 + "\n" + "all\nrights reserved"),
    ]
    got = scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((x.doc_id, x.license) for x in got) == [
        (1, "MIT short"), (2, "MIT short"), (3, "MIT"), (4, "Apache-2.0"), (4, "Proprietary short"), *[(5, "Proprietary short")] * 4,
    ]
    assert [(x.dice, x.n_words) for x in got if x.doc_id < 3] == [(1.0, 5)] * 2
    assert sorted((x.first_line, x.n_lines) for x in got if x.doc_id == 5) == [(0, 1)] * 3 + [(1, 2)]
    best = brute.best_dice_of_words(rows[:2] + rows[4:], TEMPLATES, 80)
    assert {d: round(max(x.dice for x in got if x.doc_id == d), 9) for d in best} == best


@pytest.mark.parametrize("least", [5, 9, 12])
def test_line_dedup_meets_all_earlier_places(spark, least):
    r = random.Random(least)
    lines = [" ".join(r.choice("abcdefgh") for _ in range(r.choice([0, 1, 2, 4, 15]))) for _ in range(7)]
    rows = [(i, "\n".join(r.choice(lines) for _ in range(r.randrange(1, 9)))) for i in range(70)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: (x.n_removed, x.text or "") for x in line_dedup(df, least).collect()}
    assert got == brute.line_dedup_of_all(rows, least)


def test_line_dedup_cuts_copies_of_edited_copies(spark):
    x, y, z = (" ".join(f"{c}{i}" for i in range(n)) for c, n in (("x", 60), ("y", 30), ("z", 20)))
    rows = [(1, x), (2, f"{x}\n{y}\n\n{z}"), (3, f"{x}\n{y}\n\n{z}"), (4, f"{z}\n{x}"), (5, f"{z}\n{x}"), (6, f"{x}\n\n{x}"), (7, f"{x}\n\n{x}")]
    got = {d.doc_id: (d.n_removed, d.text) for d in line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[2] == (1, f"{y}\n\n{z}") and got[3] == (4, "") and got[4] == (1, z) and got[5] == (2, "") and got[7] == (3, "")


def test_stages_keep_columns_whatever_their_names(spark):
    """Extra columns that the operators might use themselves come back with their values."""
    from recolens.llm.minhash import drop_near_duplicates

    r = random.Random(9)
    names = ["_text", "_doc", "_key", "runs", "_runs", "_gone", "_leak", "_rejected", "ls", "w", "rep", "component", "content"]
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [" ".join(f"w{r.randrange(10**6)}" for _ in range(80)) for _ in range(8)]
    texts += [texts[0], f"{texts[1]}\n{passage}", f"{texts[2]} more\n{passage}", "too short", None]
    rows = [(i, t, *[f"{c}{i}" for c in names]) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, ", ".join(["doc_id long", "text string", *[f"`{c}` string" for c in names]]))
    bench = spark.createDataFrame([(1, " ".join(texts[3].split()[10:40]))], "item_id long, text string")
    extra = {x.doc_id: tuple(x)[2:] for x in df.collect()}
    good, cut, once, clean = keep_good(df), line_dedup(df), drop_near_duplicates(df), drop_leaks(df, bench)
    for out, want in ((good, set(range(11))), (cut, set(range(13))), (once, set(range(13)) - {8}), (clean, set(range(13)) - {3})):
        got = out.collect()
        assert {x.doc_id for x in got} == want
        assert all(tuple(x[c] for c in names) == extra[x.doc_id] for x in got)
    assert {x.doc_id: x.text for x in good.collect()} == {i: texts[i] for i in range(11)}
    assert {x.doc_id for x in cut.where("n_removed > 0").collect()} == {8, 9, 10}
