import numpy as np
import pyarrow as pa

from runoff.llm import words as W
from tests.llm.helpers import words


def test_words_and_offsets_follow_the_byte_pattern(monkeypatch):
    texts = ["a b c", "", None, "  A\tb\x0bC d e F ", "xxxxx", "é Ä b c", "A b  c", "\x1c y", "é É"]
    for segment in (1 << 19, 4):
        monkeypatch.setattr(W, "SEGMENT", segment)
        got, known = {}, {}
        for i, h, cut in W.text_words(pa.array(texts)):
            for r in range(len(cut) - 1):
                got[i + r] = h[cut[r]:cut[r + 1]].tolist()
        for k, t in enumerate(texts):
            own = words(t)
            assert len(got.get(k, [])) == len(own)
            assert all(known.setdefault(w, x) == x for w, x in zip(own, got.get(k, [])))
        assert len(set(known.values())) == len(known)


def test_long_text_is_whole_and_equals_its_words(monkeypatch):
    monkeypatch.setattr(W, "SEGMENT", 1 << 10)
    own = [f"w{i}" for i in range(20_000)]
    (_, whole, cut), = list(W.text_words(pa.array([" ".join(own)])))
    single = np.concatenate([h for _, h, _ in W.text_words(pa.array(own))])
    assert cut.tolist() == [0, 20_000] and (whole == single).all()


def test_sliced_and_empty_columns():
    a = pa.array(["no", "yes yes", None, "last"])
    got = [(i, len(h), cut.tolist()) for i, h, cut in W.text_words(a.slice(1))]
    assert got == [(0, 3, [0, 2, 2, 3])]
    assert list(W.text_words(pa.array([], pa.string()))) == []
