"""Quality classifier: a factorisation machine.

Features of a text: its hashed words, structure statistics in quantile bins,
and metadata columns, each hashed into a field of its own (numbers by quarter
octaves, so that near values share a feature).  The score is
``w0 + sum w_i x_i + 1/2 sum_f ((sum v_if x_i)^2 - sum v_if^2 x_i^2)``,
so all pairwise interactions cost one pass over the features.  The machine is
fitted on at most ``Settings.train_rows`` labelled rows, chosen by a hash of
their ids; every document is scored, whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from snapmetrics.llm.arrays import SPACE, counts_by_row, words
from snapmetrics.llm.common import keyed_text, table, text_chunks
from snapmetrics.llm.rules import text_counts


@dataclass(frozen=True)
class Settings:
    #: Bound of the labelled rows that the machine is fitted on.
    train_rows: int = 8000
    #: Word buckets, a power of two.
    buckets: int = 1 << 14
    bins: int = 10
    #: Columns of the documents that are features, and buckets of each.
    metadata: tuple[str, ...] = ()
    meta_buckets: int = 64
    rank: int = 4
    steps: int = 900
    batch: int = 128
    rate: float = 0.08
    decay: float = 2e-5
    seed: int = 11


_UPPER, _DIGIT, _MARK, _DOT = (np.zeros(256, bool) for _ in range(4))
_UPPER[65:91] = True
_DIGIT[48:58] = True
_MARK[[ord(c) for c in "!?|*#<>{}[]_=~^@$%&"]] = True
_DOT[[ord(c) for c in ".,;:"]] = True
N_STATS = 14


def statistics(raw: np.ndarray, off: np.ndarray, row: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Structure statistics of each row, rows by ``N_STATS``."""
    c = text_counts(raw, off)
    n = np.maximum(c["n_words"], 1)
    size = np.maximum(np.diff(off), 1)
    lines = counts_by_row(raw == 10, off) + 1
    keys = np.unique(np.stack([row.astype(np.uint64), hashes]), axis=1)[0].astype(np.int64) if len(row) else row
    twin = np.zeros(len(row), bool)
    twin[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    distinct, twins = np.bincount(keys, minlength=len(n)), np.bincount(row[twin], minlength=len(n))
    return np.stack([
        np.log1p(c["n_words"]), c["word_chars"] / n, c["n_symbols"] / n, c["n_repeat_words"] / n, c["n_dup_lines"] / lines,
        counts_by_row(_UPPER[raw], off) / size, counts_by_row(_DIGIT[raw], off) / size, counts_by_row(_MARK[raw], off) / size,
        counts_by_row(_DOT[raw], off) / n, counts_by_row(raw >= 128, off) / size, distinct / n, twins / n, lines / n,
        counts_by_row(SPACE[raw], off) / size,
    ], axis=1)


def word_features(row: np.ndarray, hashes: np.ndarray, n_rows: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, value): logarithmic counts, each row of length 1."""
    keys, n = np.unique(row * buckets + (hashes >> np.uint64(40)).astype(np.int64) % buckets, return_counts=True)
    r, value = keys // buckets, np.log1p(n)
    norm = np.sqrt(np.bincount(r, value * value, minlength=n_rows))
    return r, keys % buckets, value / norm[r]


@dataclass
class Machine:
    """Edges of the statistics' bins and the parameters."""

    settings: Settings
    edges: np.ndarray
    w0: float
    w: np.ndarray
    v: np.ndarray

    def features(self, stats: np.ndarray, r: np.ndarray, b: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All features, sorted by row: the words, then one bin of each
        statistic and one bucket of each metadata column (whose numbers follow
        the statistics)."""
        s = self.settings
        bins = np.stack([np.searchsorted(e, col) for e, col in zip(self.edges, stats.T[:N_STATS], strict=True)], axis=1)
        fields = np.arange(len(s.metadata)) * s.meta_buckets + stats[:, N_STATS:].astype(np.int64)
        column = s.buckets + np.hstack([np.arange(N_STATS) * (s.bins + 1) + bins, N_STATS * (s.bins + 1) + fields])
        rows = np.concatenate([r, np.repeat(np.arange(len(stats)), column.shape[1])])
        order = np.argsort(rows, kind="stable")
        value = np.concatenate([x, np.full(column.size, N_STATS**-0.5)])
        return rows[order], np.concatenate([b, column.ravel()])[order], value[order]

    def logits(self, n_rows: int, r: np.ndarray, f: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Logit of each row, and the factors' sums.  Every row has features."""
        starts = np.searchsorted(r, np.arange(n_rows))
        vx = self.v[f] * x[:, None]
        sums = np.add.reduceat(vx, starts, axis=0)
        squares = np.add.reduceat((vx * vx).sum(axis=1), starts)
        linear = np.add.reduceat(self.w[f] * x, starts)
        return self.w0 + linear + 0.5 * ((sums * sums).sum(axis=1) - squares), sums


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(stats: np.ndarray, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, s: Settings) -> Machine:
    """Adaptive gradient descent on the log loss.  ``rows`` has each row's
    word buckets and values.  Without rows every score is one half."""
    rng = np.random.default_rng(s.seed)
    n_features = s.buckets + N_STATS * (s.bins + 1) + len(s.metadata) * s.meta_buckets
    quantiles = np.arange(1, s.bins + 1) / (s.bins + 1)
    edges = np.quantile(stats[:, :N_STATS], quantiles, axis=0).T if len(stats) else np.zeros((N_STATS, s.bins))
    m = Machine(s, edges, 0.0, np.zeros(n_features), rng.normal(0, 0.05, (n_features, s.rank)))
    if not len(labels):
        m.v[:] = 0
        return m
    mean = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    m.w0 = float(np.log(mean / (1 - mean)))
    g0, gw, gv = 1e-6, np.full(n_features, 1e-6), np.full((n_features, s.rank), 1e-6)
    epochs = -(-s.steps // -(-len(labels) // s.batch))
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for a in range(0, len(order), s.batch):
            pick = order[a : a + s.batch]
            r = np.repeat(np.arange(len(pick)), [len(rows[i][0]) for i in pick])
            r, f, x = m.features(stats[pick], r, np.concatenate([rows[i][0] for i in pick]), np.concatenate([rows[i][1] for i in pick]))
            z, sums = m.logits(len(pick), r, f, x)
            error = (_sigmoid(z) - labels[pick]) / len(pick)
            ex = error[r] * x
            used, where = np.unique(f, return_inverse=True)
            dw = np.bincount(where, ex, minlength=len(used)) + s.decay * m.w[used]
            each = ex[:, None] * (sums[r] - m.v[f] * x[:, None])
            dv = np.stack([np.bincount(where, each[:, k], minlength=len(used)) for k in range(s.rank)], axis=1) + s.decay * m.v[used]
            d0 = error.sum()
            g0 += d0 * d0
            gw[used] += dw * dw
            gv[used] += dv * dv
            m.w0 -= s.rate * d0 / g0**0.5
            m.w[used] -= s.rate * dw / np.sqrt(gw[used])
            m.v[used] -= s.rate * dv / np.sqrt(gv[used])
    return m


def _with_metadata(docs: DataFrame, s: Settings) -> DataFrame:
    """(doc_id, text, meta): the bucket of each metadata column; null has a
    bucket like any other value."""

    def bucket(c: str):
        x = F.col(f"`{c}`")
        if isinstance(docs.schema[c].dataType, NumericType):
            size = x.cast("double")
            x = F.signum(size) * F.floor(F.log2(F.abs(size) + 1) * 4)
        return (F.crc32(F.coalesce(F.concat(F.lit("="), x.cast("string")), F.lit("")).cast("binary")) % s.meta_buckets).cast("int")

    return keyed_text(docs, "doc_id", "text", F.array(*map(bucket, s.metadata)).cast("array<int>").alias("meta"))


def _numbers(part: pa.RecordBatch, st: np.ndarray) -> np.ndarray:
    """The statistics of a slice's rows and the buckets of their metadata."""
    return np.hstack([st, np.array(part.column("meta").flatten(), float).reshape(part.num_rows, -1)])


def _measure(s: Settings):
    """(label, statistics, buckets, values) of labelled rows, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, raw, off in text_chunks(batches):
            row, _, h = words(raw, off)
            st = _numbers(part, statistics(raw, off, row, h))
            r, b, x = word_features(row, h, part.num_rows, s.buckets)
            ends = np.searchsorted(r, np.arange(part.num_rows + 1))
            spans = list(zip(ends, ends[1:]))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("label"), pa.array([x.tobytes() for x in st]),
                 pa.array([b[i:j].astype(np.int32).tobytes() for i, j in spans], pa.binary()),
                 pa.array([x[i:j].astype(np.float32).tobytes() for i, j in spans], pa.binary())],
                names=["doc_id", "label", "stats", "buckets", "values_"],
            )

    return run


def train(docs: DataFrame, labelled: DataFrame, s: Settings = Settings()) -> Machine:
    """Fit on at most ``s.train_rows`` rows of ``labelled`` (doc_id, label),
    the bound of what is broadcast and of what the driver holds.  Of an id's
    repeated documents the one with the least statistics counts."""
    chosen = labelled.orderBy(F.xxhash64("doc_id"), "doc_id").limit(s.train_rows)
    got = _with_metadata(docs, s).join(F.broadcast(chosen), "doc_id").mapInArrow(
        _measure(s), "doc_id long, label double, stats binary, buckets binary, values_ binary"
    )
    # One row for each id, whatever its repeats, reaches the driver.
    one = got.groupBy("doc_id").agg(F.min(F.struct("stats", "buckets", "values_", "label")).alias("x"))
    got = one.select("doc_id", "x.*").orderBy("doc_id").collect()
    rows = [(np.frombuffer(r.buckets, np.int32).astype(np.int64), np.frombuffer(r.values_, np.float32).astype(float)) for r in got]
    stats = np.array([np.frombuffer(r.stats, float) for r in got]).reshape(-1, N_STATS + len(s.metadata))
    return fit(stats, rows, np.array([r.label for r in got]), s)


def _score(machine):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = machine.value
        for part, raw, off in text_chunks(batches):
            row, _, h = words(raw, off)
            st = _numbers(part, statistics(raw, off, row, h))
            z, _ = m.logits(part.num_rows, *m.features(st, *word_features(row, h, part.num_rows, m.settings.buckets)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(_sigmoid(z))], names=["doc_id", "score"])

    return run


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """(doc_id, score) of every document; null and empty texts are scored by
    their statistics alone.  The broadcast machine's size is set by its
    settings, not by the data."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    return _with_metadata(docs, machine.settings).mapInArrow(_score(shared), "doc_id long, score double")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted on rows whose crc32(doc_id) mod 5 is not 0.  Labels that are
    null are left out; of an id's repeated labels the mean counts."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    docs = table(spark, sf_dir, "documents")
    labelled = (
        table(spark, sf_dir, "labels")
        .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & (fold != 0))
        .groupBy("doc_id").agg(F.avg("label").alias("label"))
    )
    got = score(docs, train(docs, labelled, Settings(metadata=("n_chars",))))
    return got.select(
        "doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )
