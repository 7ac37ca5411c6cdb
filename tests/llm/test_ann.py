import numpy as np
import pytest
from pyspark.sql import functions as F

from snapmetrics.llm import ann

IS_QUERY = "vec_id % 20 = 0"


def _recall(rows, got, k=20):
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    answers = {}
    for r in got:
        answers.setdefault(r.query_id, []).append(r)
    hits = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        score = x @ x[q]
        score[q] = -np.inf
        best = np.sort(score)[::-1][: min(k, len(ids) - 1)]
        mine = sorted(answers[ids[q]], key=lambda r: r.rank)
        assert [r.rank for r in mine] == list(range(1, len(mine) + 1)) and len(mine) == len(best)
        assert all((a.score, -a.vec_id) >= (b.score, -b.vec_id) for a, b in zip(mine, mine[1:]))
        place = {i: n for n, i in enumerate(ids)}
        assert all(np.isclose(r.score, score[place[r.vec_id]], rtol=1e-12) for r in mine)
        hits += sum(r.score >= best[-1] - 1e-9 for r in mine)
        total += len(best)
    return hits / total


@pytest.mark.parametrize("scaled", [False, True])
def test_recall_against_brute_force(spark, scaled):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 24)).astype(np.float32)
    if scaled:
        x *= rng.uniform(0.2, 3, size=(3000, 1)).astype(np.float32)
    x[:700] = x[0] + rng.normal(scale=0.01, size=(700, 24))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = ann.nearest(df, F.expr(IS_QUERY), g=ann.Graph(shard_rows=1000, block_rows=64)).collect()
    assert _recall(rows, got) >= 0.9


def test_repeated_ids_have_one_vector(spark):
    """The least vector of an id counts, in the index and as a query."""
    rows = [(0, [1.0, 5.0]), (0, [1.0, 0.0]), (1, [3.0, 9.0]), (1, [3.0, 1.0]), (1, [3.0, 1.0]), (2, [2.0, 2.0]), (20, [0.0, 1.0])]
    want = {(0, 1, 1, 3.0), (0, 2, 2, 2.0), (0, 3, 20, 0.0), (20, 1, 2, 2.0), (20, 2, 1, 1.0), (20, 3, 0, 0.0)}
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "vec_id long, embedding array<double>").repartition(3)
        assert {tuple(r) for r in ann.nearest(df, F.expr(IS_QUERY)).collect()} == want


def test_recall_and_points_visited():
    """The graph reaches nearly all of the nearest by a small part of its points."""
    rng = np.random.default_rng(3)
    x = ann._lifted(rng.normal(size=(6000, 16)))
    g = ann.Graph()
    graph, entry = ann.build(x, g)
    q = x[::30]
    found, _, visited = ann.beam_search(x, graph, entry, q, g.search_beam, g.expand)
    best = np.argsort(((q[:, None] - x[None]) ** 2).sum(axis=2), axis=1)[:, :20]
    recall = np.mean([len(set(f[:20]) & set(b)) / 20 for f, b in zip(found, best)])
    assert recall >= 0.95 and visited.mean() < 0.3 * len(x), (recall, visited.mean())


def test_few_rows_ties_and_bad_vectors(spark):
    same = [1.0, 2.0]
    rows = [(i, same, "c") for i in range(45)] + [(45, [0.0, 0.0], "c"), (46, None, "c"), (47, [float("nan"), 1.0], "c"),
            (48, [float("inf"), 1.0], "c"), (49, [1.0, None], "c"), (50, [1.0], "c"), (60, [], "c"), (None, same, "c"), (20, same, "c")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, shard string")
    got = sorted(ann.nearest(df, F.expr(IS_QUERY)).collect())
    assert {r.query_id for r in got} == {0, 20, 40} and {r.score for r in got} == {5.0}
    assert [r.vec_id for r in got if r.query_id == 20] == list(range(20))
    assert [r.vec_id for r in got if r.query_id == 0] == list(range(1, 21))
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [-1.0])], "vec_id long, embedding array<double>")
    assert [(r.rank, r.vec_id) for r in sorted(ann.nearest(few, F.expr(IS_QUERY)).collect())] == [(1, 1), (2, 2)]
    assert ann.nearest(few.where(F.lit(False)), F.expr(IS_QUERY)).count() == 0


def test_robust_pruning_keeps_diverse_edges():
    x = np.array([[0, 0], [1, 0], [1.05, 0], [0, 1], [0, 1.1], [-1, 0]], np.float32)
    kept = ann.prune(x, np.array([0]), np.array([[1, 2, 3, 4, 5, -1]]), 3, 1.1)
    assert set(kept[0].tolist()) == {1, 3, 5}
