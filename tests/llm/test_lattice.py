"""Which nodes of a lattice are looked up among the pieces."""

import math

import numpy as np
import pyarrow as pa
import pytest
from recolens.llm import segment


public = pytest.importorskip("public_tokenizers")


def test_only_starts_of_pieces_are_followed():
    known = segment.Pieces(public.path("piece_bpe_32k.model"))
    for length, kinds in known.kinds.items():
        assert (kinds > 0).sum() <= len(known.texts) < 1 << segment.KIND_BITS
        for i in known.tables.get(length, ((), ()))[1]:
            raw = np.frombuffer(known.texts[i], np.uint8).astype(np.uint64)
            hashes = np.cumsum((raw + np.uint64(1)) * segment.powers(segment.BASE, length), dtype=np.uint64)
            at = (hashes >> segment.KIND_SHIFT).astype(np.int64)
            assert known.kinds[length][at[-1]] & 2 and all(known.kinds[k + 1][at[k]] & 1 for k in range(length - 1))


def test_the_trie_spells_the_pieces():
    known = segment.Pieces(public.path("piece_bpe_32k.model"))
    state = np.ones(len(known.lattice_ids), np.int64)
    for k in range(known.longest):
        on = np.flatnonzero(known.size[known.lattice_ids] > k)
        assert (known.row[state[on]] >= 0).all()
        state[on] = known.step[known.row[state[on]] + known.code[known.flat[known.ends[known.lattice_ids[on]] + k]]]
    assert (known.id_of[state] == known.lattice_ids).all() and (known.id_of >= 0).sum() == len(known.lattice_ids)
    strange = np.setdiff1d(np.arange(256), known.flat)
    assert (known.step[known.row[1] + known.code[strange]] == 0).all()


@pytest.mark.parametrize("log_range", [0, 40, 600])
@pytest.mark.parametrize("text", ["thecat", "", "é漢🎉", "é漢" * 9 + "then" * 20 + "\x01" * 3])
def test_probabilities_of_edges(text, log_range, monkeypatch):
    monkeypatch.setattr(segment, "LOG_RANGE", log_range)
    known = segment.Pieces.of(public.path("piece_bpe_32k.model"))
    raw, starts = segment.normalised(pa.array([text + "x"]))
    t, data = segment.Lattices(known, raw, starts), raw.tobytes()
    ids = {known.texts[i]: i for i in known.lattice_ids}
    mass, want, after = {0: 0.0}, {}, {}
    for r in range(1, len(data) + 1):  # the text is one unit, its nodes are numbered by the bytes left
        rest = data[len(data) - r :]
        if rest[0] & 0xC0 == 0x80:
            continue
        own = {(k, ids[rest[:k]]): known.weight[ids[rest[:k]]] for k in range(1, r + 1) if rest[:k] in ids}
        first = next(k for k in range(1, 5) if k == r or rest[k] & 0xC0 != 0x80)
        if rest[:first] not in ids:
            own[first, -1] = first * known.byte_weight
        sums = [w + mass[r - k] for (k, _), w in own.items()]
        mass[r] = max(sums) + math.log(sum(math.exp(x - max(sums)) for x in sums))
        want |= {(r, k, i): math.exp(w + mass[r - k] - mass[r]) for (k, i), w in own.items()}
        after |= {(r, k, i): r - k for k, i in own}
    names = list(zip(t.node.tolist(), t.size.tolist(), t.id.tolist()))
    assert sorted(names) == sorted(want) and len(data) == len(raw)
    assert np.allclose(t.q, [want[x] for x in names], rtol=1e-9, atol=0)
    assert [-1 if f < 0 else int(t.node[f]) for f in t.after.tolist()] == [after[x] or -1 for x in names]


def test_a_process_reads_the_vocabulary_once(monkeypatch, tmp_path):
    import shutil

    read, init = [], segment.Pieces.__init__
    monkeypatch.setattr(segment.Pieces, "__init__", lambda self, file: (read.append(file), init(self, file))[1])
    file = str(shutil.copy(public.path("piece_bpe_32k.model"), tmp_path / "own.model"))
    assert segment.Pieces.of(file) is segment.Pieces.of(file) and read == [file]
    with open(file, "ab") as out:
        out.write(b"\x0a\x06\x0a\x04zzqq")  # one more piece
    assert len(segment.Pieces.of(file).texts) == len(segment.Pieces.of(public.path("piece_bpe_32k.model")).texts) + 1
    assert len(read) == 3
