import re
from collections import Counter

import duckdb
from pyspark.sql import functions as F

from snapmetrics.llm.oracle import ORACLE_SQL
from snapmetrics.llm.rules import COUNTS, Rules, host_verdicts, judge, keep_good, measure

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(grams)
    covered = {i + j for i, g in enumerate(grams) if often[g] > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_counts_match_brute_force(odd_docs, odd_rows):
    got = sorted((r.doc_id, *(r[c] for c in COUNTS), r.base_failed) for r in judge(odd_docs).collect())
    want = []
    for i, t in odd_rows:
        c = brute(t)
        want.append((i, *c, c[0] < 10 or 100 * c[4] > 20 * c[0]))
    assert got == sorted(want)


def test_empty_table(no_docs):
    assert judge(no_docs).count() == 0 and keep_good(no_docs).count() == 0


def test_hosts_are_shrunk_and_bad_ones_judged_strictly(spark):
    good = " ".join(f"w{i}" for i in range(40))
    odd = good + " #" * 9
    rows = [(i, "no", f"bad{i % 2}") for i in range(60)] + [(100, good, "bad0"), (101, odd, "bad0"), (102, odd, "fine"), (103, good, None)]
    rows += [(200 + i, good, "fine") for i in range(80)] + [(400, "no", "lone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    hosts = {r.host: r for r in host_verdicts(measure(docs)).collect()}
    assert hosts["bad0"].bad and not hosts["fine"].bad
    assert 0 < hosts["lone"].shrunk["words"] < 1 and hosts["fine"].shrunk["words"] > 0
    assert hosts["bad0"].bad_rules == ["words"] and hosts["fine"].bad_rules == []
    kept = {r.doc_id: r.kept for r in judge(docs).collect()}
    assert kept[100] and not kept[101] and kept[102] and kept[103] and not kept[0]
    assert {r.doc_id for r in keep_good(docs).collect()} == {i for i, k in kept.items() if k}


def test_filter_keeps_columns(odd_docs, odd_rows):
    got = keep_good(odd_docs, Rules(host_limit=2.0))
    assert got.columns == odd_docs.columns
    fine = [i for i, t in odd_rows if (c := brute(t))[0] >= 10 and 100 * c[4] <= 20 * c[0]]
    assert sorted(r.doc_id for r in got.collect()) == sorted(fine)


def test_a_host_of_junk_changes_rows_of_the_given_table(spark, tmp_path):
    """Documents of symbols move to one host among others: its verdict drops
    those that the base rules let pass, and no other row changes."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    assert judge(docs).where("kept <> (not base_failed)").count() == 0
    counts = judge(docs).select("doc_id", "n_words", "n_symbols", "base_failed")
    junk = counts.where((F.col("n_symbols") * 10 > F.col("n_words")) & ~F.col("base_failed")).select("doc_id", F.lit("junk").alias("moved"))
    moved = docs.join(junk, "doc_id", "left").withColumn("source", F.when((F.col("moved") == "junk") | (F.col("doc_id") % 100 == 0), "junk").otherwise(F.col("source")))
    host = {r.host: r for r in host_verdicts(measure(moved)).collect()}
    assert host["junk"].bad_rules == ["symbols"] and [h for h, r in host.items() if r.bad] == ["junk"]
    changed = {r.doc_id for r in judge(moved).where("not kept and not base_failed").collect()}
    moved_ids = {r.doc_id for r in junk.collect()}
    assert len(moved_ids) > 100 and moved_ids <= changed
    # Rows of the host that came along keep their place unless a soft rule fails.
    assert len(changed - moved_ids) < 20
    kept = {r.doc_id for r in keep_good(moved).select("doc_id").collect()}
    assert not kept & changed and kept == {r.doc_id for r in judge(moved).where("kept").collect()}
    # The SQL comes to the same verdicts.
    moved.select("doc_id", "text", "source").write.parquet(f"{tmp_path}/moved")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/moved/*.parquet'")
    assert {i for i, k in con.execute(f"SELECT doc_id, kept FROM ({ORACLE_SQL['op9_host_rules']})").fetchall() if k} == kept


def test_rates_are_relative_to_the_corpus(spark):
    """Equal hosts are never bad, a small host is not judged by one failure,
    a host that surely stands out is."""
    good = " ".join(f"w{i}" for i in range(40))
    odd = good + " #" * 9
    rows = [(i, odd if i % 20 == 0 else good, f"h{i % 7}") for i in range(2800)]
    rows += [(5000, odd, "tiny")] + [(6000 + i, odd if i % 3 == 0 else good, "worse") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert {r.host for r in host_verdicts(measure(docs)).where("bad").collect()} == {"worse"}
    assert host_verdicts(measure(docs.where("source like 'h%'"))).where("bad").count() == 0
