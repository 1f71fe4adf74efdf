"""Vectorised words and window hashes against plain Python."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from likertlake.llm import words as W

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab Z9é\t\n- 𝒳", max_size=60)), max_size=8)


@settings(deadline=None, max_examples=60)
@given(TEXTS, st.integers(1, 4))
def test_words_and_windows(texts, k):
    data, offsets = W.column(pa.array(texts, pa.string()))
    for letters, pattern in ((W.NOT_BLANK, rb"[^\x20\x09-\x0D]+"), (W.ALNUM, rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")):
        seen = {}
        for i, part, at in W.slices(data, offsets, 40):
            w = W.split(part, at, letters)
            tables = W.powers()
            prefix = W.window_prefix(W.word_hashes(w, tables[0]), tables[1])
            hashes, fits = W.window_hashes(prefix, k, tables[1]), W.inside(w, k)
            for d in range(len(at) - 1):
                want = re.findall(pattern, (texts[i + d] or "").encode())
                own = range(w.first[d], w.first[d + 1])
                assert [bytes(part[w.starts[j] : w.ends[j]]) for j in own] == want
                for j in own:
                    assert (j < len(fits) and bool(fits[j])) == (j + k <= w.first[d + 1])
                    if j + k <= w.first[d + 1]:
                        window = tuple(want[j - w.first[d] : j - w.first[d] + k])
                        assert seen.setdefault(window, hashes[j]) == hashes[j]
        assert len(set(seen.values())) == len(seen)


def test_spread():
    assert W.spread(np.array([1, 2, 6]), 2, 8).tolist() == [False, True, True, True, False, False, True, True]
