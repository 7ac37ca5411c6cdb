import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from snapmetrics.llm import superkmers
from snapmetrics.llm.arrays import words
from snapmetrics.llm.superkmers import dedup_windows, op11_super_kmers, packed_words

SF001 = "/root/testdata/sf0.001"


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(rows, window=20):
    seen, out = set(), {}
    for i, t in sorted(dict(rows).items()):
        w = split(t)
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            key = tuple(w[p : p + window])
            if key in seen:
                gone[p : p + window] = [True] * window
            seen.add(key)
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[i] = (i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return sorted(out[i] for i, _ in rows)


def _rows(df):
    return sorted(map(tuple, df.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256)).collect()))


def _passages(seed, n=60):
    """Documents around one passage, with repeats of their own and copies."""
    rng = random.Random(seed)
    word = lambda k: [rng.choice("abcdefgh") + str(rng.randint(0, 30)) for _ in range(k)]
    passage, rows = word(26), []
    for i in range(n):
        w = word(rng.randint(0, 60)) + passage[rng.randint(0, 3) :] + word(rng.randint(0, 60))
        if i % 7 == 0:
            w += w[: rng.randint(0, len(w))]
        rows.append((i * 13 % 101, "\n ".join(w)))
    return rows + [(500 + i, rows[i][1]) for i in range(8)]


def test_matches_brute_force(odd_docs, odd_rows):
    assert _rows(dedup_windows(odd_docs)) == brute(odd_rows)


def test_shared_passages(spark):
    rows = _passages(1)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute(rows)
    assert sum(r[2] for r in want) > 1000
    assert _rows(dedup_windows(docs)) == want


def test_large_buckets_are_dealt_in_parts(spark, monkeypatch):
    monkeypatch.setattr(superkmers, "BUCKET_BYTES", 400)
    monkeypatch.setattr(superkmers, "SORT_BYTES", 600)
    monkeypatch.setattr(superkmers, "BLOCK_BYTES", 2000)
    rows = _passages(2)
    # One partition holds several blocks; its parts are cut into pieces.
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert _rows(dedup_windows(docs)) == brute(rows)


def test_windows_that_share_a_hash_are_told_apart(monkeypatch):
    """With one hash for every window, bytes alone decide."""
    import pyarrow as pa

    texts = [b"a b c d", b"b c d e", b"a b c x"]
    rows = pa.table({"doc": [1, 2, 3], "s": [0, 0, 0], "packed": pa.array(texts, pa.binary())})
    one = lambda h, row, k: (at := superkmers.np.flatnonzero(row[: len(row) - k + 1] == row[k - 1 :]), np.zeros(len(at), np.uint64))
    monkeypatch.setattr(superkmers, "windows", one)
    got = pa.Table.from_batches(list(superkmers._first_windows(rows, np.ones(3, bool), 3)))
    gone = [(r["doc"], r["s"], r["e"]) for r in got.to_pylist() if r["kind"] == superkmers.COVERED]
    left = sorted((r["doc"], r["packed"]) for r in got.to_pylist() if r["kind"] == superkmers.AGAIN)
    assert gone == [(2, 0, 3), (3, 0, 3)]
    assert left == [(1, b"a b c"), (1, b"b c d"), (2, b"c d e"), (3, b"b c x")]


def test_packed_words_and_minimisers():
    texts = ["", " a  b\n", "c", "\t", "dd ee é "]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    off = np.cumsum([0, *(len(t.encode()) for t in texts)])
    data, row, h, start, end, base = packed_words(raw, off)
    assert data.tobytes().decode() == "a b c dd ee é "
    assert [data[a:b].tobytes().decode() for a, b in zip(start, end)] == ["a", "b", "c", "dd", "ee", "é"]
    assert row.tolist() == [1, 1, 2, 4, 4, 4] and base.tolist() == [0, 0, 2, 3, 3, 6]
    # Every window lies in exactly one super-k-mer, whose minimiser is its own.
    rng = random.Random(3)
    text = " ".join(rng.choice("abc") for _ in range(400)).encode()
    row, _, h = words(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    s, e, bucket, _ = superkmers.superkmers(h, row, 20, 3)
    assert (s[0], e[-1]) == (0, 400) and (s[1:] == e[:-1] - 19).all() and (e - s < 40).all()
    grams = superkmers.windows(h, row, 3)[1]
    for a, b, m in zip(s, e, bucket):
        for p in range(a, b - 19):
            window = grams[p : p + 18]
            high = window >> np.uint64(24)
            assert window[np.argmin(high)] == m


def test_parts_of_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(superkmers, "PART_WORDS", 50)
    rows = _passages(4, 12)
    got = {}
    for i, t in rows:
        raw = np.frombuffer(t.encode(), np.uint8)
        _, row, h, *_ = packed_words(raw, np.array([0, len(raw)]))
        s, e, *_ = superkmers.superkmers(h, row)
        got[i] = sorted(p for a, b in zip(s, e) for p in range(a, b - 19))
        assert got[i] == list(range(max(len(split(t)) - 19, 0)))


def test_rows_without_an_id_and_empty_table(nameless_docs, no_docs):
    got = dedup_windows(nameless_docs).select("doc_id", "n_words", "n_removed").collect()
    assert sorted(map(tuple, got), key=str) == [(1, 65, 0), (None, 65, 0), (None, 65, 0)]
    assert dedup_windows(no_docs).count() == 0


def test_query_on_the_given_table(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()])
    got = sorted(map(tuple, op11_super_kmers(spark, SF001).collect()))
    assert got == want and sum(r[2] for r in want) > 0
