import random
import re

import numpy as np
import pytest

from snapmetrics.llm import jaccard as J
from snapmetrics.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def brute(rows, k, percent):
    sets = [shingles(t, k) for _, t in rows]
    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, (i, _) in enumerate(rows):
        for y in range(x):
            n = len(sets[x] & sets[y])
            if n and 100 * n >= percent * (len(sets[x]) + len(sets[y]) - n):
                a, b = root(i), root(rows[y][0])
                parent[max(a, b)] = min(a, b)
    return sorted((i, len(s), root(i)) for (i, _), s in zip(rows, sets))


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80)])
def test_odd_documents(odd_docs, odd_rows, k, percent):
    assert sorted(map(tuple, J.similar_sets(odd_docs, J.Similarity(k, percent)).collect())) == brute(odd_rows, k, percent)


def test_chains_and_groups_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(J, "BLOCK", 7)
    rng = random.Random(4)
    rows = []
    for g in range(4):
        w = [f"{g}w{rng.randrange(900)}" for _ in range(130)]
        for _ in range(30):
            w = list(w)
            w[rng.randrange(len(w))] = f"edit{rng.randrange(10**6)}"
            rows.append((len(rows) * 7 % 127, " ".join(w)))
            if rng.random() < 0.3:
                w = w[: rng.randrange(90, 131)]
    rows = list({i: (i, t) for i, t in rows}.values())
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert sorted(map(tuple, J.similar_sets(docs, J.Similarity(3, 90)).collect())) == brute(rows, 3, 90)


def test_an_unlike_leader_hides_no_link(spark):
    rng = random.Random(8)
    rows = []
    for _ in range(300):
        # Near copies of 11 and 10 shingles; a smaller id shares 8 of them, too
        # few to pass the bitmaps, and in some cases leads their only bucket.
        w = [f"w{rng.randrange(10**6)}" for _ in range(13)]
        for x in (w[:10] + [f"u{rng.randrange(10**6)}" for _ in range(3)], w, w[:-1]):
            rows.append((len(rows), " ".join(x)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert sorted(map(tuple, J.similar_sets(docs, J.Similarity(3, 90)).collect())) == brute(rows, 3, 90)


def test_unlike_long_texts_are_ruled_out_by_their_bitmaps(spark, monkeypatch):
    """300 unlike texts of 3,000 words and a few copies: no pair but links is
    compared set by set."""
    rng = random.Random(9)
    rows = [(i, " ".join(f"w{rng.randrange(400)}" for _ in range(3000))) for i in range(300)]
    for i in range(6):
        w = rows[i][1].split()
        w[::60] = ["x"] * len(w[::60])
        rows.append((300 + i, " ".join(w)))
    counts = {}
    stored = J.stored

    def counting(df, name):
        out = stored(df, name)
        counts[name] = counts.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(J, "stored", counting)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(map(tuple, J.similar_sets(docs, J.Similarity(5, 80)).collect()))
    want = sorted((i, len(shingles(t, 5)), i - 300 if i >= 300 else i) for i, t in rows)
    assert got == want
    assert counts["first-pairs"] + counts["late-pairs"] <= 12


@pytest.mark.parametrize("rounds", [1, 2])
def test_groups_that_link_do_not_make_all_their_pairs(spark, monkeypatch, rounds):
    """80 texts that all link, in buckets led by 30 texts that are a little too
    far from them: verified pairs grow with the texts, not with their square,
    and blocks that the rounds leave open are settled from their sets."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(10**6)}" for _ in range(150)]
    rows = []
    for i in range(110):
        w = list(base)
        for at in (10, 60, 110) if i < 30 else ():
            w[at + rng.randrange(30)] = f"edit{rng.randrange(10**6)}"
        w[-1] = f"end{i}"
        rows.append((i, " ".join(w)))
    counts = {}
    stored = J.stored

    def counting(df, name):
        out = stored(df, name)
        counts[name] = counts.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(J, "stored", counting)
    monkeypatch.setattr(J, "FOREST_ROUNDS", rounds, raising=False)
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert sorted(map(tuple, J.similar_sets(docs, J.Similarity(3, 90)).collect())) == brute(rows, 3, 90)
    assert counts["late-pairs"] <= 4 * len(rows)


def test_bitmaps_bound_the_difference_from_below():
    rng = np.random.default_rng(3)
    for a, b in ((100, 110), (250, 300), (900, 1100), (5000, 4100)):
        one, two = (np.unique(rng.integers(0, 1 << 52, n).astype(np.uint64)) for n in (a, b))
        two[: a // 2] = one[: a // 2]
        two = np.unique(two)
        row = np.repeat([0, 1], [len(one), len(two)])
        x, y = (np.frombuffer(m, ">u4") for m in J.bitmaps(row, np.concatenate([one, two]), 2))
        while len(x) > len(y):
            x = J.fold(x)
        while len(y) > len(x):
            y = J.fold(y)
        apart = len(np.setxor1d(one, two))
        assert int(np.bitwise_count(x ^ y).sum()) <= apart
        assert len(x) * 32 * 2 >= min(a, b)


def test_empty_table_and_rows_without_id(no_docs, nameless_docs):
    assert J.similar_sets(no_docs).count() == 0
    got = sorted(((r.doc_id, r.component_id) for r in J.similar_sets(nameless_docs).collect()), key=str)
    assert got == [(1, 1), (None, None), (None, None)]


def test_allocation_obeys_the_pigeonhole():
    for percent in (80, 90):
        for top in J.band_tops(percent, 5000):
            for sets in (1, 1000, 10**7):
                zero, one = J.allocate(top, percent, sets)
                assert zero >= 0 and zero + 2 * one == J.most_different(2 * top, percent) + 1
    # More sets make accidental agreement dearer, so deletions pay at last.
    assert J.allocate(200, 80, 10**9)[1] > J.allocate(200, 80, 10)[1]


def test_neighbouring_bands_hold_all_partners():
    for percent in (80, 90):
        tops = J.band_tops(percent, 3000)
        band = lambda n, tops=tops: next(i for i, t in enumerate(tops) if n <= t)
        for n in range(1, 2000):
            assert band(n * 100 // percent) - band(n) <= 1


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 40)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(60)] + [(500, 500)]
    group = {x: {x} for e in edges for x in e}
    for a, b in edges:
        both = group[a] | group[b]
        for x in both:
            group[x] = both
    want = {x: min(g) for x, g in group.items() if len(g) > 1}
    assert dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect())) == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
