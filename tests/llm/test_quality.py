import zlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from snapmetrics.llm import quality_fm as Q

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    got = Q.op6_quality(spark, SF).toPandas()
    assert list(got.columns) == ["doc_id", "held_out", "score", "predicted"]
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    both = pd.read_parquet(f"{SF}/labels.parquet").merge(got[got.held_out], on="doc_id")
    right = both.predicted == both.quality
    assert right.mean() > 0.97 and right[both.quality == 0].mean() > 0.9 and right[both.quality == 1].mean() > 0.95


def test_pairwise_identity():
    """The linear-time sum equals the sum over all pairs."""
    s = Q.Settings(buckets=16, bins=2, rank=3)
    rng = np.random.default_rng(0)
    n = s.buckets + Q.N_STATS * (s.bins + 1)
    m = Q.Machine(s, np.zeros((Q.N_STATS, s.bins)), 0.3, rng.normal(size=n), rng.normal(size=(n, 3)))
    r, f, x = np.array([0, 0, 0, 1, 1]), np.array([1, 4, 9, 4, 30]), rng.normal(size=5)
    z, _ = m.logits(2, r, f, x)
    for row in (0, 1):
        k = np.flatnonzero(r == row)
        pairs = sum(m.v[f[i]] @ m.v[f[j]] * x[i] * x[j] for i in k for j in k if i < j)
        assert np.isclose(z[row], m.w0 + (m.w[f[k]] * x[k]).sum() + pairs)


def test_odd_documents_and_labels(spark, odd_docs, odd_rows, no_docs):
    labels = spark.createDataFrame([(i, float(i % 2)) for i, _ in odd_rows[:30]], "doc_id long, label double")
    machine = Q.train(odd_docs, labels, Q.Settings(steps=20))
    got = Q.score(odd_docs, machine).collect()
    assert sorted(r.doc_id for r in got) == sorted(i for i, _ in odd_rows) and all(0 <= r.score <= 1 for r in got)
    again = Q.score(odd_docs, Q.train(odd_docs, labels, Q.Settings(steps=20))).collect()
    assert sorted(got) == sorted(again)
    assert Q.score(no_docs, machine).count() == 0
    none = Q.train(odd_docs, labels.where(F.lit(False)))
    assert {r.score for r in Q.score(odd_docs, none).collect()} == {0.5}


def test_metadata_decides_where_texts_are_alike(spark):
    """Numbers and text as metadata, null among them; extra features leave a
    machine without metadata as it was."""
    schema = "doc_id long, text string, size double, kind string"
    rows = [(i, f"the same words {i % 7}", (None if i % 4 == 0 else 1000.0 + i) if i % 2 == 0 else -3.0, "a" if i % 2 else None) for i in range(200)]
    docs = spark.createDataFrame(rows, schema)
    labels = spark.createDataFrame([(i, float(i % 2)) for i in range(150)], "doc_id long, label double")
    for names in (("size",), ("kind",), ("size", "kind")):
        machine = Q.train(docs, labels, Q.Settings(steps=60, metadata=names))
        got = {r.doc_id: r.score for r in Q.score(docs, machine).collect()}
        assert all((got[i] > 0.5) == (i % 2 == 1) for i in range(150, 200))
    plain = Q.train(docs, labels, Q.Settings(steps=60))
    assert len(plain.w) == plain.settings.buckets + Q.N_STATS * (plain.settings.bins + 1)


def test_repeated_and_null_labels(spark, tmp_path):
    """Repeated documents are scored each, repeated labels are averaged, null
    ones left out, documents without a label scored."""
    docs = [(i, f"some words {i % 5} of a text", "en", "s", 20 + i % 3) for i in range(40)] + [(3, "twice", None, None, None), (None, None, None, None, None)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, i % 2, None) for i in range(30)] + [(3, 0, 1), (4, None, 0), (None, 1, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = Q.op6_quality(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id is None, r.doc_id) for r in got if r.doc_id is not None) == sorted((False, d[0]) for d in docs if d[0] is not None)
    assert len(got) == len(docs) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)


def test_training_rows_are_bounded(odd_docs, spark):
    labels = spark.createDataFrame([(i, 1.0) for i in range(200)], "doc_id long, label double")
    seen = {}
    fit, Q.fit = Q.fit, lambda stats, rows, y, s: seen.update(n=len(y)) or fit(stats, rows, y, s)
    try:
        Q.train(odd_docs.unionByName(odd_docs).unionByName(odd_docs), labels, Q.Settings(train_rows=5, steps=2))
    finally:
        Q.fit = fit
    assert seen["n"] <= 5
