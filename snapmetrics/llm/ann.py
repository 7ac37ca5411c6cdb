"""Nearest neighbours by a robust-pruned directed graph in each shard.

Vectors are dealt to shards of about ``Graph.shard_rows``.  In a shard,
points enter the graph in batches: greedy searches from a few spread entry points propose
neighbours, and relaxed distance pruning keeps a few diverse edges per point,
reverse edges included.  Queries are searched by beam in every shard, in
blocks, and scored exactly in double precision.  Largest inner products
become smallest distances by one extra coordinate that gives all points the
same length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapmetrics.llm.common import stored, table


@dataclass(frozen=True)
class Graph:
    #: Rows of a shard, about; this bounds a build task.
    shard_rows: int = 16384
    #: Queries that are searched at a time, about.
    block_rows: int = 1024
    degree: int = 48
    build_beam: int = 96
    search_beam: int = 96
    #: Relaxation of the pruning: a larger one keeps more edges.
    alpha: float = 1.1
    #: Points, spread over the shard, from which every search starts.
    entries: int = 32
    batch: int = 512
    expand: int = 4


def beam_search(x: np.ndarray, graph: np.ndarray, entry: np.ndarray, q: np.ndarray, beam: int, expand: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, squared distances) of each query's beam, nearest first; -1 and
    infinity where fewer points were reached; and how many points it visited."""
    m, rows = len(q), np.arange(len(q))[:, None]
    seen = np.zeros((m, len(x)), bool)
    seen[:, entry] = True
    ids = np.full((m, beam), -1)
    dist = np.full((m, beam), np.inf, np.float32)
    open_ = np.zeros((m, beam), bool)
    length = (x * x).sum(axis=1)
    own = (q * q).sum(axis=1)[:, None]
    first = length[entry] - 2 * (q @ x[entry].T) + own
    near = np.argsort(first, axis=1, kind="stable")[:, :beam]
    n = near.shape[1]
    ids[:, :n], dist[:, :n], open_[:, :n] = entry[near], np.take_along_axis(first, near, 1), True
    while open_.any():
        # The beam is sorted, so the first open places are the nearest.
        place = np.argsort(~open_, axis=1, kind="stable")[:, :expand]
        live = np.take_along_axis(open_, place, 1)
        open_[rows, place] = False
        near = graph[np.where(live, np.take_along_axis(ids, place, 1), 0)]
        near[~live] = -1
        near = near.reshape(m, -1)
        new = (near >= 0) & ~seen[rows, near]
        # Of a neighbour that two opened points share, one place counts.
        order = np.argsort(near, axis=1, kind="stable")
        ranked = np.take_along_axis(near, order, 1)
        twin = np.zeros_like(new)
        twin[rows, order[:, 1:]] = ranked[:, 1:] == ranked[:, :-1]
        new &= ~twin
        r, c = np.nonzero(new)
        seen[r, near[r, c]] = True
        d = np.full(near.shape, np.inf, np.float32)
        hit = near[r, c]
        d[r, c] = length[hit] - 2 * np.einsum("nd,nd->n", x[hit], q[r]) + own[r, 0]
        ids, dist, open_ = np.hstack([ids, near]), np.hstack([dist, d]), np.hstack([open_, new])
        best = np.argsort(dist, axis=1, kind="stable")[:, :beam]
        ids, dist, open_ = (np.take_along_axis(a, best, 1) for a in (ids, dist, open_))
        ids[np.isinf(dist)] = -1
        open_ &= ids >= 0
    return ids, dist, seen.sum(axis=1)


def prune(x: np.ndarray, points: np.ndarray, cand: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Robust pruning: of each point's candidates (-1: none), nearest first,
    keep one unless an already kept one is ``alpha`` times nearer to it than
    the point is."""
    cand = np.where(cand == points[:, None], -1, cand)
    c, p = x[cand], x[points]
    dist = ((c - p[:, None]) ** 2).sum(axis=2)
    dist[cand < 0] = np.inf
    order = np.argsort(dist, axis=1, kind="stable")
    cand, dist, c = np.take_along_axis(cand, order, 1), np.take_along_axis(dist, order, 1), np.take_along_axis(c, order[:, :, None], 1)
    length = (c * c).sum(axis=2)
    apart = length[:, :, None] + length[:, None] - 2 * (c @ c.transpose(0, 2, 1))
    alive, rows = np.isfinite(dist), np.arange(len(points))
    out = np.full((len(points), degree), -1)
    for k in range(degree):
        pick = alive.argmax(axis=1)
        some = alive[rows, pick]
        if not some.any():
            break
        out[some, k] = cand[rows, pick][some]
        alive &= (alpha * alpha * apart[rows, pick] > dist) | ~some[:, None]
        alive[rows, pick] = False
    return out


def entries(x: np.ndarray, count: int) -> np.ndarray:
    """The point nearest to the mean, then each time the one farthest from
    those chosen."""
    chosen = [int(((x - x.mean(axis=0)) ** 2).sum(axis=1).argmin())]
    far = np.full(len(x), np.inf)
    while len(chosen) < min(count, len(x)):
        far = np.minimum(far, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
        chosen.append(int(far.argmax()))
    return np.unique(chosen)


def build(x: np.ndarray, g: Graph) -> tuple[np.ndarray, np.ndarray]:
    """(neighbours of each point, entry points) for distinct points."""
    n = len(x)
    graph = np.full((n, g.degree), -1)
    entry = entries(x, g.entries)
    graph[entry] = prune(x, entry, np.tile(entry, (len(entry), 1)), g.degree, g.alpha)
    order = np.random.default_rng(n).permutation(n)
    order = np.concatenate([entry, order[~np.isin(order, entry)]])
    done = len(entry)
    while done < n:
        new = order[done : done + min(g.batch, max(1, done))]
        found, *_ = beam_search(x, graph, entry, x[new], g.build_beam, g.expand)
        graph[new] = prune(x, new, found, g.degree, g.alpha)
        source, target = np.repeat(new, g.degree), graph[new].ravel()
        source, target = source[target >= 0], target[target >= 0]
        # The nearest new sources of each target join its edges.
        near = ((x[source] - x[target]) ** 2).sum(axis=1)
        by = np.lexsort((near, target))
        source, target = source[by], target[by]
        first = np.flatnonzero(np.diff(target, prepend=-1))
        place = np.arange(len(target)) - np.repeat(first, np.diff(first, append=len(target)))
        hit = target[first]
        extra = np.full((len(hit), g.degree), -1)
        fits = place < g.degree
        extra[np.repeat(np.arange(len(hit)), np.diff(first, append=len(target)))[fits], place[fits]] = source[fits]
        for a in range(0, len(hit), g.batch):
            part = slice(a, a + g.batch)
            graph[hit[part]] = prune(x, hit[part], np.hstack([graph[hit[part]], extra[part]]), g.degree, g.alpha)
        done += len(new)
    return graph, entry


def _lifted(v: np.ndarray) -> np.ndarray:
    """Points of one length: scaled to at most 1, with the missing part as
    one more coordinate."""
    v = v.astype(np.float64)
    length = (v * v).sum(axis=1)
    most = length.max()
    return np.hstack([v / np.sqrt(most), np.sqrt(np.maximum(1 - length / most, 0))[:, None]]).astype(np.float32)


def _one_per_id(rows: pd.DataFrame) -> pd.DataFrame:
    """Rows by id; of an id's repeated rows the one with the least vector, so
    that shards and query blocks choose alike whatever order rows arrive in."""
    repeated = rows["vec_id"].duplicated(keep=False)
    if repeated.any():
        rows = rows.assign(least=rows["v"].map(tuple).where(repeated, None))
        few = rows[repeated].sort_values(["vec_id", "least"]).drop_duplicates("vec_id")
        rows = pd.concat([rows[~repeated], few]).drop(columns="least")
    return rows.sort_values("vec_id", kind="stable")


def _shard(g: Graph, dim: int, keep: int):
    """Rows of a shard to its packed graph.  Equal vectors are one point with
    its smallest ids, of which no answer needs more than ``keep``."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = _one_per_id(rows)
        v, ids = np.array(rows["v"].tolist()).reshape(-1, dim), rows["vec_id"].to_numpy()
        points, where = np.unique(v, axis=0, return_inverse=True)
        by = np.argsort(where.ravel(), kind="stable")
        ends = np.searchsorted(where.ravel()[by], np.arange(len(points) + 1))
        held = np.concatenate([ids[by[a:b]][:keep] for a, b in zip(ends, ends[1:])])
        counts = np.minimum(np.diff(ends), keep)
        graph, entry = build(_lifted(points), g)
        return pd.DataFrame({
            "shard": [rows["shard"].iloc[0]], "entry": [entry.astype(np.int64).tobytes()], "points": [points.tobytes()], "graph": [graph.astype(np.int32).tobytes()],
            "ids": [held.astype(np.int64).tobytes()], "counts": [counts.astype(np.int32).tobytes()],
        })

    return run


def _block(rows: pd.DataFrame) -> pd.DataFrame:
    rows = _one_per_id(rows)
    return pd.DataFrame({"block": [rows["block"].iloc[0]], "query_ids": [rows["vec_id"].to_numpy().astype(np.int64).tobytes()],
                         "queries": [np.array(rows["v"].tolist()).tobytes()]})


def _search(g: Graph, dim: int, kind: str, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                get = lambda name, t, r=r, batch=batch: np.frombuffer(batch.column(name)[r].as_buffer(), t)
                points, q = get("points", kind).reshape(-1, dim), get("queries", kind).reshape(-1, dim)
                graph = get("graph", np.int32).reshape(len(points), -1)
                ids, counts, qid = get("ids", np.int64), get("counts", np.int32), get("query_ids", np.int64)
                ends = np.concatenate([[0], np.cumsum(counts)])
                x, entry, out = _lifted(points), get("entry", np.int64), []
                qd = q.astype(np.float64)
                unit = np.hstack([qd / np.sqrt((qd * qd).sum(axis=1, keepdims=True)), np.zeros((len(q), 1))]).astype(np.float32)
                for a in range(0, len(q), g.batch):
                    found, *_ = beam_search(x, graph, entry, unit[a : a + g.batch], g.search_beam, g.expand)
                    row, col = np.nonzero(found >= 0)
                    point = found[row, col]
                    score = np.einsum("nd,nd->n", points[point].astype(np.float64), qd[a + row])
                    many = counts[point]
                    row, score = np.repeat(row, many), np.repeat(score, many)
                    at = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
                    vec = ids[np.repeat(ends[point], many) + at]
                    other = vec != qid[a + row]
                    row, score, vec = row[other], score[other], vec[other]
                    by = np.lexsort((vec, -score, row))
                    row, score, vec = row[by], score[by], vec[by]
                    rank = np.arange(len(row)) - np.searchsorted(row, row)
                    out.append((qid[a + row[rank < k]], vec[rank < k], score[rank < k]))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names=["query_id", "vec_id", "score"])

    return run


def usable(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v) of rows with an id whose vector has only finite components,
    not all zero."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    v = F.col("v")
    return rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v")).where(
        F.col("vec_id").isNotNull() & v.isNotNull() & ~F.exists(v, bad) & F.exists(v, lambda x: x != 0)
    )


def nearest(rows: DataFrame, is_query, k: int = 20, g: Graph = Graph(), **columns: str) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest rows of each row for
    which ``is_query`` (a condition on ``vec_id``) holds.

    An id is one row: of its repeated rows the one with the least vector, by
    component order, counts.  The most common vector length is that of the
    table (of equally common ones the greatest); vectors of another length,
    null ones and rows without an id take no part.  Extra columns are not
    read.  An empty table has no answers.
    """
    spark = rows.sparkSession
    good = usable(rows, **columns)
    sizes = good.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n"), F.count_if(is_query).alias("queries"))
    top = sizes.orderBy(F.col("n").desc(), F.col("dim").desc()).first()
    if top is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    kind = "<f4" if good.schema["v"].dataType.elementType.typeName() == "float" else "<f8"
    v = F.col("v") if kind == "<f4" else F.col("v").cast("array<double>")
    good = good.where(F.size("v") == top.dim).select("vec_id", v.alias("v"))
    shards, blocks = -(-top.n // g.shard_rows), -(-max(top.queries, 1) // g.block_rows)
    index = stored(
        good.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
        .groupBy("shard")
        .applyInPandas(_shard(g, top.dim, k + 1), "shard int, entry binary, points binary, graph binary, ids binary, counts binary"),
        "graph",
    )
    asked = (
        good.where(is_query)
        .withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
        .groupBy("block")
        .applyInPandas(_block, "block int, query_ids binary, queries binary")
    )
    pairs = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).join(index, "shard")
    found = pairs.mapInArrow(_search(g, top.dim, kind, k), "query_id long, vec_id long, score double")
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
