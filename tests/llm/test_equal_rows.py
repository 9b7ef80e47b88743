"""Rows that repeat a doc_id and text lose the same windows."""

from __future__ import annotations

import random

import pytest
from test_llm import docs, plain_repeats

from meridian.llm import suffix


@pytest.mark.parametrize("wide, local", [(512, 32), (1, 32), (512, 1)])
def test_suffix_equal_rows_behind_a_shared_passage(spark, wide, local):
    r = random.Random(4)
    word = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    rows = []
    for i in range(12):
        passage = word(r.randint(110, 400))
        rows += [(10 * i + 3, word(90) + passage + word(70)), *[(10 * i + 5, word(120) + passage + word(130))] * 2]
    single = list(dict.fromkeys(rows))
    want = {i: (gone, kept) for i, _, gone, _, kept in plain_repeats(single)}
    got = [(x.doc_id, (x.n_removed, bytes(x.kept))) for x in suffix.remove_repeats(docs(spark, rows), 100, 32, wide, local, block_bytes=3000).collect()]
    assert len(got) == len(rows) and all(want[i] == x for i, x in got)
    assert all(want[i][0] for i, _ in rows if i % 10 == 5)
