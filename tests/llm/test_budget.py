"""The error budget of decontamination is spent whole."""

from __future__ import annotations

import random

import pytest
from test_llm import plain_distance

from meridian.llm import decontaminate


@pytest.mark.parametrize("size", [13, 26, 32, 38, 50, 80, 100, 116, 299])
def test_decontamination_spends_the_whole_budget(size):
    r = random.Random(size)
    item = "".join(r.choice("abcdefgh") for _ in range(size))
    k = size * 8 // 100
    texts = []
    for edits in (k, k + 1):
        t = list(item)
        for e in range(edits):
            t[(2 * e + 1) * size // (2 * edits)] = "z"
        texts.append("before " + "".join(t) + " after")
    matcher = decontaminate.Matcher([(7, item.encode())], decontaminate.RATE)
    assert [plain_distance(item, t) for t in texts] == [k, k + 1]
    assert matcher.match(texts) == [[(7, k)], []]


def test_decontamination_rates():
    item = "the quick brown fox jumps over the lazy dog again"
    changed = "the_qu1ck br0wn f0x jumps 0ver the 1azy d0g again".replace("_", "x")
    n = plain_distance(item, changed)
    assert n == 7 and decontaminate.Matcher([(1, item.encode())], 0.2).match([changed]) == [[(1, n)]]
    with pytest.raises(ValueError):
        decontaminate.Matcher([(1, item.encode())], 1.0)
