import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from snapmetrics.llm.lines import FILTER_BITS, MOST_BITS, dedup_lines, filter_bits

SPACE = " \t\n\r\x0b\x0c"


def key(line):
    k = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACE))
    return k if len(k) >= 10 else None


def brute(rows):
    own = defaultdict(set)
    for i, t in rows:
        for x in (t or "").split("\n"):
            if key(x):
                own[key(x)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (key(x) and min(own[key(x)]) != i)]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out)


def _rows(df):
    return sorted(map(tuple, df.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256)).collect()))


def test_matches_brute_force(odd_docs, odd_rows):
    assert _rows(dedup_lines(odd_docs)) == brute(odd_rows)


def test_a_full_filter_loses_nothing(odd_docs, odd_rows):
    # 64 bits for both hashes: nearly every line is suspected.
    assert _rows(dedup_lines(odd_docs, bits=64, part=64)) == brute(odd_rows)


def test_rows_without_id_keep_all(nameless_docs):
    assert [r.n_dropped for r in dedup_lines(nameless_docs).collect()] == [0, 0, 0]


def test_carried_columns_and_empty_table(odd_docs, no_docs):
    got = dedup_lines(odd_docs, carry={"key": "__key", "source": "__source"})
    assert got.columns == ["doc_id", "n_lines", "n_dropped", "kept", "__key", "__source"]
    assert {r["__key"] for r in got.collect()} == {"clash"}
    assert dedup_lines(no_docs).count() == 0


def test_only_documents_that_lose_lines_are_shuffled(spark):
    shared = "a line that all of them share"
    rows = [(i, f"the own line of document {i}\n" + (shared if i % 10 == 0 else "")) for i in range(400)] + [(None, shared)]
    got = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("Union") and plan.count("Join") == 1
    assert sorted(r.doc_id for r in got.where("n_dropped > 0").collect()) == list(range(10, 400, 10))
    assert got.count() == 401


def test_filters_grow_with_the_input():
    assert filter_bits(0) == FILTER_BITS and filter_bits(10**12) == MOST_BITS
    assert FILTER_BITS < filter_bits(10_000_000) < MOST_BITS
