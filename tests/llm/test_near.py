"""Near copies against plain sets."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from meridian.llm import common, near


def plain_set(text):
    ws = (text or "").lower().split()
    return {tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set()


def plain_groups(rows):
    sets, parent = [plain_set(t) for _, t in rows], list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or len(a & b) * 5 >= len(a | b) * 4:
                parent[root(i)] = root(j)
    return [root(i) for i in range(len(rows))]


def edited(seed=1, groups=12):
    """Groups of texts with a few words replaced: similarities on both sides of 0.8, mostly over 4 fingerprint bits."""
    r, rows = random.Random(seed), []
    for g in range(groups):
        base = [f"w{r.randrange(3000)}" for _ in range(r.randint(60, 300))]
        for _ in range(5):
            t = list(base)
            for _ in range(r.randint(0, len(t) // 30)):
                t[r.randrange(len(t))] = f"x{r.randrange(3000)}"
            rows.append((len(rows) + 1, " ".join(t)))
    return rows


def frame(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return common.written(df.withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")}), "t")


@pytest.mark.parametrize("limit", [near.BUCKET_LIMIT, 2])
def test_near_copies(spark, limit):
    rows = [*edited(), (900, None), (901, " "), (902, "A b"), (903, "a  B")]
    got = {r.doc_id: r.component_id for r in near.near_copies(frame(spark, rows), bucket_limit=limit).collect()}
    least = {}
    for (i, _), c in zip(rows, plain_groups(rows)):
        least.setdefault(c, i)
    assert got == {i: least[c] for (i, _), c in zip(rows, plain_groups(rows))}
    assert near.near_copies(frame(spark, rows).limit(0)).count() == 0


def test_near_dedup_of_edited_copies(spark, sf):
    import corpus_pipeline as cp

    rows = edited(2)
    least = {}
    for (i, _), c in zip(rows, plain_groups(rows)):
        least.setdefault(c, i)
    kept = [r.doc_id for r in cp.near_dedup(spark, frame(spark, rows), sf).collect()]
    assert sorted(kept) == sorted(least.values())


def test_near_dedup_chooses_rows(spark, sf):
    import corpus_pipeline as cp

    a, b, c = (" ".join(f"{x}{i}" for i in range(80)) for x in "abc")
    rows = [(1, a), (1, b), (1, b), (2, b), (None, c), (None, c), (None, b), (3, a + " end")]
    for some in (rows, rows[::-1]):
        kept = cp.near_dedup(spark, frame(spark, some), sf).select("doc_id", "text").collect()
        assert sorted(map(repr, map(tuple, kept))) == sorted(map(repr, [(1, a), (1, b), (None, c)]))
