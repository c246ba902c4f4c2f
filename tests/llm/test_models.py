"""Token codes, language model, segmentations."""

import collections
import itertools
import math
import random
import zlib

import brute
import numpy as np
import pyarrow as pa
import pytest
from recolens.llm import dac, kneser_ney, segment
from recolens.llm.files import pack, pack_small, read_file, unpack, unpack_small, write_file
from recolens.llm.tokens import Words, mix

public = pytest.importorskip("public_tokenizers")


def test_words_and_packing():
    r = random.Random(3)
    texts = ["", None, "A b\tÉ\x0b", "x" * 100, *("".join(r.choice("aB \n\r\x0cé漢_") for _ in range(r.randrange(40))) for _ in range(200))]
    words = Words(pa.array(texts, pa.string()))
    want = [brute.words(t) for t in texts]
    assert np.diff(words.first).tolist() == [len(w) for w in want]
    flat = list(itertools.chain(*want))
    assert len(set(flat)) == len(set(words.hash.tolist())) == len(set(zip(flat, words.hash.tolist())))
    x = np.sort(np.random.default_rng(0).integers(0, 2**63, 999).astype(np.uint64))
    assert (unpack(pack(x), 999) == x).all() and (unpack_small(pack_small(x[::-1]), 999) == x[::-1]).all()
    assert len(unpack(pack(x[:0]), 0)) == 0


@pytest.mark.parametrize("top", [1, 200, 256, 70000, 2**32 - 1])
def test_codes_give_random_access(tmp_path, top):
    ids = np.random.default_rng(top).integers(0, top + 1, 5000).astype(np.uint32)
    ids[::7] %= 300
    path = write_file(str(tmp_path), "t", dac.encode_file([5, None], np.array([0, 100, 5000]), ids))
    f = dac.DacFile(read_file(path))
    assert (f.n_docs, f.n_tokens, f.valid.tolist()) == (2, 5000, [1, 0])
    assert [f.token(i) for i in range(0, 5000, 3)] == ids[::3].tolist()
    for a, b in ((0, 5000), (511, 513), (513, 4999), (7, 7), (4096, 4097)):
        assert (f.slice(a, b) == ids[a:b]).all()
    empty = dac.DacFile(read_file(write_file(str(tmp_path), "e", dac.encode_file([], np.array([0]), ids[:0]))))
    assert empty.n_tokens == 0 and len(empty.slice(0, 0)) == 0


def test_token_files(spark, odd, none):
    from tokenizers import Tokenizer

    path = public.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    files = dac.write_tokens(odd, path, 1)
    out = dac.read_documents(files).collect()
    rows = sorted(((d, t) for d, t, *_ in odd.collect()), key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or ""))
    at, want, every = 0, [], []
    for d, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        want.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
        every += ids
    assert sorted(map(tuple, out), key=lambda x: x[1]) == want
    asked = [0, 1, at // 2, at - 1]
    got = dac.read_tokens(files, spark.createDataFrame([(i,) for i in asked], "position long")).collect()
    assert dict(map(tuple, got)) == {i: every[i] for i in asked}
    assert dac.read_documents(dac.write_tokens(none, path, 1)).collect() == []


def test_language_model(spark, odd, none, monkeypatch):
    r = random.Random(8)
    rows = [(i, " ".join(r.choice("abcdefghij") * r.choice([1, 1, 2]) for _ in range(r.randrange(30)))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    trained = [d for d, _ in rows if zlib.crc32(str(d).encode()) % 10]
    want, n = brute.kneser_ney(rows, trained)
    monkeypatch.setattr(kneser_ney, "RANGE_TOKENS", 100)  # many ranges must change nothing
    model = kneser_ney.train(df.where(~kneser_ney.held_out()))
    assert model.tokens == n and len(model.pairs) > 2
    for x in kneser_ney.score(df, model).collect():
        tokens, known, base, score = want[x.doc_id]
        assert (x.n_tokens, x.n_known) == (tokens, known)
        assert abs(x.base_score - base) < 1e-5 and abs(x.score - score) < 1e-5
    # Every context's distribution over words, the end and one unknown word sums to 1.
    scorer = kneser_ney.Scorer(model)
    vocabulary = sorted({w for d, t in rows if d in trained for w in t.split()}) + ["unseen"]
    for context in ("a", "bb", "neverseen"):
        both = scorer.score(pa.array([f"{context} {w}" for w in vocabulary] + [context]))["score"]
        alone = scorer.score(pa.array([f"{context} {w} {w}" for w in vocabulary]))["score"]
        assert len(alone) == len(vocabulary) and np.isfinite(both).all()
        first = scorer.score(pa.array([context]))["score"][0]
        assert np.isfinite(first)
    assert kneser_ney.score(odd, model).count() == odd.count()
    assert kneser_ney.score(none, model).count() == 0
    untrained = kneser_ney.score(df, kneser_ney.train(none))
    assert untrained.where("n_known > 0 or abs(score) > 1e-9").count() == 0


@pytest.fixture(scope="module")
def known():
    return segment.Pieces(public.path("piece_bpe_32k.model"))


def every_path(known, text):
    """{ids: log-probability} by enumeration."""
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=public.path("piece_bpe_32k.model"))
    raw = " " + text.replace("▁", " ")
    weight = {
        t: (-math.log(2 - sp.get_score(i)), i)
        for i, t in enumerate(known.texts)
        if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))
    }
    out = {}

    def go(i, ids, total):
        if i == len(raw):
            out[tuple(ids)] = total
        for j in range(i + 1, min(len(raw), i + 16) + 1):
            t = raw[i:j].encode()
            if t in weight:
                go(j, ids + [weight[t][1]], total + weight[t][0])
            elif j == i + 1:
                go(j, ids + [int(known.byte_ids[b]) for b in t], total + known.byte_weight * len(t))

    go(0, [], 0.0)
    whole = math.log(sum(math.exp(x) for x in out.values()))
    return {k: x - whole for k, x in out.items()}


def test_samples_follow_the_distribution(known):
    text, n, k = "the ca", 20000, 3
    paths = every_path(known, text)
    sampler = segment.Sampler(known, pa.array([text] * n), mix(np.arange(n).astype(np.uint64)))
    drawn, threshold = sampler.samples(k)
    sets, weights = [[] for _ in range(n)], np.zeros(n)
    for docs, path, log_p, value in drawn:
        ids, ends = sampler.ids(path, docs)
        for d in docs:
            own = tuple(ids[ends[d] : ends[d + 1]].tolist())
            assert abs(paths[own] - log_p[d]) < 1e-9
            sets[d].append((own, value[d]))
            weights[d] += math.exp(log_p[d]) / -math.expm1(-math.exp(log_p[d] - threshold[d]))
    for s, t in zip(sets, threshold):
        assert len({x for x, _ in s}) == k and sorted((v for _, v in s), reverse=True) == [v for _, v in s] and s[-1][1] >= t
    first = collections.Counter(s[0][0] for s in sets)
    second = collections.Counter(s[1][0] for s in sets)
    p = {x: math.exp(v) for x, v in paths.items()}
    then = {x: sum(p[a] * p[x] / (1 - p[a]) for a in p if a != x) for x in p}
    assert max(abs(first[x] / n - p[x]) for x in p) < 0.015
    assert max(abs(second[x] / n - then[x]) for x in p) < 0.015
    assert abs(weights.mean() - 1) < 0.02  # inclusion scores make weights that sum to 1


def test_segmentations(spark, odd, none):
    from sentencepiece import SentencePieceProcessor

    model = public.path("piece_bpe_32k.model")
    sp = SentencePieceProcessor(model_file=model)
    out = segment.encode_samples(odd, model)
    rows = out.collect()
    texts = collections.defaultdict(set)
    for d, t, *_ in odd.collect():
        texts[d].add((t or "").replace("▁", " "))
    assert all(x.decoded and x.n_pieces == len(x.ids) for x in rows)
    assert {sp.decode(list(x.ids)) for x in rows if x.doc_id not in (None, 6)} <= set().union(*texts.values())
    for x in segment.decode_ids(out, model).collect():
        assert x.text in texts[x.doc_id]
    assert sorted(x.sample for x in rows if x.doc_id == 3) == [1, 1, 2, 2]
    assert [(x.sample, x.n_pieces, x.log_inclusion) for x in rows if x.doc_id == 1] == [(1, 0, 0.0)]
    again = segment.encode_samples(odd.repartition(7), model, with_ids=False).collect()
    assert sorted((x.doc_id or -1, x.sample, x.ids_crc32) for x in again) == sorted((x.doc_id or -1, x.sample, x.ids_crc32) for x in rows)
    assert segment.encode_samples(none, model).count() == 0


def test_registered_segmentations_hold_their_ids(spark, tmp_path):
    from recolens.llm.queries import op9_segmentations

    rows = [(1, "plain words"), (2, "a ▁mark"), (3, ""), (4, None), (5, "Ünïcode 漢字")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    out = op9_segmentations(spark, str(tmp_path))
    got = segment.decode_ids(out, public.path("piece_bpe_32k.model")).collect()
    assert {x.doc_id for x in got} == {1, 2, 3, 4, 5}
    for x in got:
        text = dict(rows)[x.doc_id] or ""
        assert zlib.crc32(np.array(x.ids, "<u4").tobytes()) == x.ids_crc32 and len(x.ids) == x.n_pieces
        assert x.text == text.replace("▁", " ") and x.restored == (x.text == text) and x.decoded


def test_trigram_model(spark, none, monkeypatch, tmp_path):
    from recolens.llm.queries import op8_lm_score

    r = random.Random(9)
    rows = [(i, " ".join(r.choice("abcdefghij") * r.choice([1, 1, 2]) for _ in range(r.randrange(40)))) for i in range(90)]
    rows += [(200, "unseen words here a b c"), (201, None), (202, "a " * 700)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    trained = [d for d, _ in rows if zlib.crc32(str(d).encode()) % 10]
    want = brute.kneser_ney_trigrams(rows, trained)
    pairs = brute.kneser_ney(rows, trained)[0]
    for many in (100, 10**6):
        monkeypatch.setattr(kneser_ney, "RANGE_TOKENS", many)
        got = {x.doc_id: x.score for x in op8_lm_score(spark, str(tmp_path)).collect()}
        assert got.keys() == want.keys() and all(abs(got[d] - want[d]) < 1e-5 for d in want)
    assert any(abs(want[d] - pairs[d][3]) > 0.1 for d in want)
    assert kneser_ney.train(none, order=3).tokens == 0


@pytest.mark.parametrize("name, alone", [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
def test_token_files_equal_the_library_for_any_pre_tokenizer(spark, odd, name, alone):
    import zlib

    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path(name)
    assert dac.words_stand_alone(path) == alone
    library = Tokenizer.from_file(path)
    rows = [(i, t) for i, (t,) in enumerate(odd.select("text").collect())]
    got = dac.read_documents(dac.write_tokens(spark.createDataFrame(rows, "doc_id long, text string"), path, 1))
    at = 0
    for (i, text), x in zip(rows, got.orderBy("doc_id").collect()):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        crc = zlib.crc32(b"".join(v.to_bytes(4, "little") for v in ids))
        assert (x.doc_id, x.start, x.n_tokens, x.ids_crc32) == (i, at, len(ids), crc)
        at += len(ids)


def test_word_cache_is_bounded(monkeypatch):
    import public_tokenizers
    import pyarrow as pa

    encoder = dac.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    monkeypatch.setattr(dac.WordEncoder, "CACHED", 3)
    for text in ("one two three four", "five two", "one two three four"):
        ids, starts = encoder.encode(pa.array([text, None, text]), 1)
        own = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == [*own, 1, 1, *own, 1] and starts.tolist() == [0, len(own) + 1, len(own) + 2, 2 * len(own) + 3]
        assert len(encoder.keys) <= 8


def test_words_that_hold_the_separator_are_encoded_alone():
    import public_tokenizers
    import pyarrow as pa

    encoder = dac.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    mark = encoder.between[0].decode()
    text = f"one a{mark}b two {mark} Éa {mark}{mark} x{mark}"
    ids, _ = encoder.encode(pa.array([text, "only plain words here"]), 1)
    own = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in (text, "only plain words here")]
    assert ids.tolist() == [*own[0], 1, *own[1], 1]
