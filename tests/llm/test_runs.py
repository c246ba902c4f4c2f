"""Words and their marks are given to the tokenizer once."""

import json
import random

import numpy as np
import pyarrow as pa
import pytest
from recolens.llm import dac


public = pytest.importorskip("public_tokenizers")


def test_marks_and_capitals_cost_the_library_nothing():
    path = public.path("word_bpe_49k.json")
    encoder, plain = dac.WordEncoder(path), dac.TextEncoder(path)
    texts = pa.array(["Alpha alpha. alpha! beta. beta! BETA ALPHA!"])
    assert encoder.encode(texts, 1)[0].tolist() == plain.encode(texts, 1)[0].tolist()
    assert len(encoder.keys) == 4  # alpha . ! beta


def test_runs_equal_the_library():
    path = public.path("word_bpe_49k.json")
    encoder, plain = dac.WordEncoder(path), dac.TextEncoder(path)
    r = random.Random(6)
    odd = ["W̊", "ẘ", "É", "≮", "a.̸", "×", "÷", "é", "É", "ß", "İ", "K", "Σ",
           "'s", "'LL", "'", "don't", "3", "x9", "…", ".", "!!", "***", "\x00", "\x1c", "\x85", " ", "漢", "\U0001f600", "the", "THE", "<|endoftext|>", "<|ENDOFTEXT|>", "</w>"]
    texts = ["".join(r.choice(odd) for _ in range(r.randrange(1, 6))) for _ in range(3000)]
    texts += [" ".join(texts[i : i + 7]) for i in range(0, 3000, 7)] + ["word" + "." * n for n in range(40)] + ["", None, "." * 40, "!a", "a\n!"]
    texts = pa.array(texts, pa.string())
    for _ in range(2):
        got, want = encoder.encode(texts, 1), plain.encode(texts, 1)
        size, least = np.diff(got[1]), np.diff(want[1])
        assert [texts[i].as_py() for i in np.flatnonzero(size != least)[:5]] == []
        assert got[1].tolist() == want[1].tolist() and got[0].tolist() == want[0].tolist()


def test_other_files_are_not_cut_into_runs(tmp_path):
    path = public.path("word_bpe_49k.json")
    assert dac.runs_stand_alone(path)
    for part, value in (("normalizer", None), ("pre_tokenizer", {"type": "Whitespace"})):
        with open(path, encoding="utf-8") as source:
            changed = json.load(source) | {part: value}
        (tmp_path / part).write_text(json.dumps(changed))
        assert not dac.runs_stand_alone(str(tmp_path / part))
