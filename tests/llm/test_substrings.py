import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from snapmetrics.llm import substrings
from snapmetrics.llm.runindex import RunIndex
from snapmetrics.llm.substrings import dedup_substrings, phrases


def brute(rows, length=100):
    seen, out = set(), {}
    for i, t in sorted(dict(rows).items()):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if b[p : p + length] in seen:
                gone[p : p + length] = True
            seen.add(b[p : p + length])
        runs = int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum())
        out[i] = (i, len(b), int(gone.sum()), runs, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest())
    return sorted(out[i] for i, _ in rows)


def _rows(df):
    return sorted(map(tuple, df.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()))


def test_matches_brute_force(odd_docs, odd_rows):
    assert _rows(dedup_substrings(odd_docs)) == brute(odd_rows)


def test_edited_copies(spark):
    rng = random.Random(2)
    base = "".join(rng.choice("abcdefgh ") for _ in range(2500))
    rows = []
    for i in range(40):
        t = list(base)
        for _ in range(6):
            t[rng.randrange(len(t))] = "#"
        rows.append((i, "".join(t)[rng.randrange(300) :] + "tail" * rng.randrange(60)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert _rows(dedup_substrings(docs)) == brute(rows)


def test_a_wide_anchor_is_dealt_to_several_indexes(spark, monkeypatch):
    monkeypatch.setattr(substrings, "WIDE", 3)
    monkeypatch.setattr(substrings, "HELD", 5)
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("abcdefghij") for _ in range(n))
    shared = word(140)
    rows = [(i, word(90) + shared[: 100 + i] + word(90)) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert _rows(dedup_substrings(docs)) == brute(rows)


def test_a_hot_window_fills_no_index(spark, monkeypatch):
    monkeypatch.setattr(substrings, "WIDE", 20)
    monkeypatch.setattr(substrings, "BUCKET_BYTES", 1 << 10)
    index = substrings._index

    def checked(length):
        inner = index(length)

        def run(rows):
            size = sum(map(len, rows.column("body").to_pylist()))
            assert size < 10_000, f"an index of {size} bytes"
            return inner(rows)

        return run

    monkeypatch.setattr(substrings, "_index", checked)
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcdefghij") for _ in range(n))
    line, common = word(120), word(130)
    rows = [(i, word(90) + (line if i % 3 else common[: 100 + i % 30]) + word(90)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert _rows(dedup_substrings(docs)) == brute(rows)


def test_empty_table_and_rows_without_id(no_docs, nameless_docs):
    assert dedup_substrings(no_docs).count() == 0
    assert [r.n_removed for r in dedup_substrings(nameless_docs).collect()] == [0, 0, 0]


def test_run_index_repeats():
    rng = random.Random(3)
    for trial in range(60):
        strings = [bytes(rng.choice(b"ab\x00") for _ in range(rng.randint(1, 60))) for _ in range(rng.randint(1, 12))]
        if trial % 3 == 0:
            strings = [s + strings[0] for s in strings]
        starts = np.cumsum([0, *map(len, strings)])[:-1]
        length = rng.randint(3, 12)
        index = RunIndex(np.frombuffer(b"".join(strings), np.uint8), starts)
        want, seen = np.zeros(sum(map(len, strings)), bool), set()
        for s, a in zip(strings, starts):
            for p in range(len(s) - length + 1):
                want[a + p] = s[p : p + length] in seen
                seen.add(s[p : p + length])
        assert (index.repeats(length) == want).all()
        assert len(index.run_rows) <= len(want)


def test_matching_statistics_are_true_matches():
    rng = random.Random(5)
    strings = [bytes(rng.choice(b"abc") for _ in range(80)) for _ in range(6)]
    data, starts = np.frombuffer(b"".join(strings), np.uint8), np.arange(6) * 80
    index = RunIndex(data, starts)
    stats, order = index.statistics(), index.order
    for r in range(1, len(order)):
        p, q = int(order[r]), int(order[r - 1])
        a, b = data[p : p + index.rem[p]].tobytes(), data[q : q + index.rem[q]].tobytes()
        n = next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
        assert stats[p] == n


def test_equal_windows_share_anchors_across_parts():
    rng = np.random.default_rng(0)
    t = rng.integers(97, 99, 20_000).astype(np.uint8)
    t[9000:9500] = t[100:600]
    t[15_000:16_000] = 97
    anchors: dict[bytes, int] = {}
    starts = []
    for a, ends in substrings._parts(np.array([0, len(t)]), 100, 3000):
        _, s, e, anchor, *_ = phrases(t[a : a + ends[-1]], ends)
        for x, y, z in zip(s + a, e + a, anchor):
            for p in range(x, y - 99):
                starts.append(p)
                assert anchors.setdefault(t[p : p + 100].tobytes(), z) == z
    assert sorted(starts) == list(range(len(t) - 99))
