from __future__ import annotations

import re

import numpy as np
import pyarrow as pa

from recspark.llm import text as T

TEXTS = ["Aa bb aa", None, "", "é été, Été!", "x" * 5000 + " y", "1-2-3\n4", "日本 語", "  ", "tail "]


def spans(texts, size=64):
    out = []
    for low, data, offsets in T.slices(pa.array(texts, pa.string()), size):
        w = T.words(data, offsets)
        out += [(low + r, bytes(T.FOLD[data[a:b]]).decode(), h) for a, b, r, h in zip(w.start, w.end, w.row, w.hash, strict=True)]
    return out


def test_words_are_those_of_the_pattern():
    expected = []
    for i, t in enumerate(TEXTS):
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        expected += [(i, w) for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)]
    assert [(r, w) for r, w, _ in spans(TEXTS)] == expected


def test_hash_depends_on_the_word_alone():
    seen = {}
    for size in (8, 64, 1 << 20):
        for _, w, h in spans(TEXTS, size):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_grams_stay_in_their_row():
    row = np.array([0, 0, 0, 1, 1, 2])
    assert T.within_row(row, 2).tolist() == [True, True, False, True, False]
    assert T.within_row(row, 7).tolist() == []
    h = np.arange(6, dtype=np.uint64)
    assert T.grams(h, 2)[0] == T.grams(h[:2], 2)[0]


def test_slices_of_a_sliced_column():
    column = pa.array(["a", "bb", None, "cc", "d"]).slice(1, 3)
    rows = [(low, bytes(data), offsets.tolist()) for low, data, offsets in T.slices(column, 3)]
    assert rows[0][0] == 0 and b"".join(r[1] for r in rows) == b"bbcc"
