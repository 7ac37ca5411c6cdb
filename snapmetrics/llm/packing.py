"""Sequence packing with dominance reduction.

Tokenizing is per document; only longer ones than a sequence are cut.  Bins
depend on lengths alone, so the instance is the histogram of piece lengths,
at most ``size`` rows whatever the corpus.  On it, sets that provably
dominate every alternative for an item are fixed for good (Martello and
Toth), and the remainder is packed best-fit in decreasing order.  The
resulting patterns go back to the pieces by each piece's rank within its
length.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapmetrics.llm import tokens
from snapmetrics.llm.common import keyed_text, stored, table

SEQUENCE = 1024
END_ID = 2
#: Pieces of one length that are ranked together.
RANK_GROUP = 512


def cut(n: int, size: int) -> list[int]:
    """Piece lengths of a document of n tokens: whole if it fits, else full
    pieces after a first one with the rest."""
    if n <= size:
        return [n]
    return [n % size] * (n % size > 0) + [size] * (n // size)


def _tokenize(size: int, end_id: int, json_name: str, ranks_name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: tuple[list, ...] = ([], [], [], [], [])
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = np.append(tokens.encode(text.as_py(), json_name, ranks_name), np.uint32(end_id)).astype("<u4")
                at = 0
                for k, n in enumerate(cut(len(ids), size)):
                    for column, value in zip(rows, (doc, k, at, n, zlib.crc32(ids[at : at + n])), strict=True):
                        column.append(value)
                    at += n
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(rows, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"]
            )

    return run


def pieces(docs: DataFrame, size: int = SEQUENCE, end_id: int = END_ID, json_name: str = tokens.BYTE_JSON,
           ranks_name: str = tokens.BYTE_RANKS) -> DataFrame:
    return keyed_text(docs).mapInArrow(
        _tokenize(size, end_id, json_name, ranks_name), "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


# --- bins from the histogram -----------------------------------------------------


class _Stock:
    """Counts by length, with the queries that the reduction asks."""

    def __init__(self, counts: dict[int, int]):
        self.n = {k: v for k, v in counts.items() if v > 0}
        self.order = sorted(self.n)

    def take(self, length: int, count: int) -> None:
        self.n[length] -= count
        if not self.n[length]:
            del self.n[length]
            self.order.remove(length)

    def largest(self, limit: int, used: tuple[int, ...] = ()) -> int | None:
        """Largest length of at most ``limit`` with a copy left beside ``used``."""
        i = bisect.bisect_right(self.order, limit) - 1
        while i >= 0 and self.n[self.order[i]] <= used.count(self.order[i]):
            i -= 1
        return self.order[i] if i >= 0 else None

    def smallest(self, k: int, used: tuple[int, ...] = (), above: int = 0) -> list[int]:
        """The k smallest items longer than ``above``, with multiplicity."""
        out: list[int] = []
        for length in self.order[bisect.bisect_right(self.order, above) :]:
            out += [length] * min(k - len(out), self.n[length] - used.count(length))
            if len(out) >= k:
                break
        return out

    def best_pair(self, limit: int, used: tuple[int, ...]) -> int:
        """Largest sum of two items within ``limit`` (0: none fits)."""
        items = [x for x in self.order for _ in range(min(2, self.n[x] - used.count(x)))]
        a, b, best = 0, len(items) - 1, 0
        while a < b:
            if items[a] + items[b] <= limit:
                best, a = max(best, items[a] + items[b]), a + 1
            else:
                b -= 1
        return best


def dominating(stock: _Stock, j: int, size: int) -> tuple[int, ...] | None:
    """Companions of item j whose set dominates every other feasible set with
    j, or None.

    A set dominates another one if its items have room for the other's items
    in their places.  Proved cases: nothing fits; the largest that fits fills
    the rest; at most one more item fits; at most two fit and the largest one
    alone is as long as the best two; at most two fit and, beside the largest
    one, the longest second has no feasible pair with a longer shorter item.
    Taking items away only removes alternatives, so a case once proved holds
    while its items last.
    """
    room, mine = size - j, (j,)
    few = stock.smallest(3, mine)
    if not few or few[0] > room:
        return ()
    a = stock.largest(room, mine)
    if a == room or len(few) < 2 or few[0] + few[1] > room:
        return (a,)
    if len(few) == 3 and sum(few) <= room:
        return None
    if a >= stock.best_pair(room, mine):
        return (a,)
    b = stock.largest(min(a, room - a), (j, a))
    if b is not None:
        longer = stock.smallest(2, mine, above=b)
        if len(longer) < 2 or sum(longer) > room:
            return (a, b)
    return None


def reduce_instance(counts: dict[int, int], size: int) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """Sets fixed for good, as (lengths, copies), and the counts left."""
    stock, fixed, changed = _Stock(counts), [], True
    while changed:
        changed = False
        for j in sorted(stock.n, reverse=True):
            while j in stock.n and (mates := dominating(stock, j, size)) is not None:
                group = (j, *mates)
                copies = min(stock.n[x] // group.count(x) for x in group)
                fixed.append((group, copies))
                for x in set(group):
                    stock.take(x, copies * group.count(x))
                changed = True
    return fixed, dict(stock.n)


def best_fit(counts: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit decreasing on counts: equal bins are kept as one group."""
    bins: dict[int, list[list]] = {}
    order: list[int] = []

    def put(room: int, group: tuple[int, ...], copies: int) -> None:
        if copies:
            if room not in bins:
                bins[room] = []
                bisect.insort(order, room)
            bins[room].append([group, copies])

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            i = bisect.bisect_left(order, length)
            room = order[i] if i < len(order) else size
            each = min(room // length, left)
            if i < len(order):
                group, have = bins[room][-1]
                use = min(have, left // each)
                bins[room][-1][1] -= use
                if not bins[room][-1][1]:
                    bins[room].pop()
                    if not bins[room]:
                        del bins[room]
                        order.remove(room)
            else:
                group, use = (), left // each
            put(room - each * length, group + (length,) * each, use)
            left -= use * each
    return [(group, copies) for groups in bins.values() for group, copies in groups]


def patterns(counts: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    fixed, rest = reduce_instance(counts, size)
    return fixed + best_fit(rest, size)


def slots(plan: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, copies, offset): a piece
    of the length with rank r in the range goes to sequence
    ``first + (r - lo) % copies`` at ``offset + (r - lo) // copies * length``."""
    out, sequence, ranks = [], 0, {}
    for group, copies in plan:
        offset = 0
        for length in dict.fromkeys(group):
            lo, k = ranks.get(length, 0), group.count(length)
            ranks[length] = lo + k * copies
            out.append((length, lo, lo + k * copies, sequence, copies, offset))
            offset += k * length
        sequence += copies
    return out


def pack(docs: DataFrame, size: int = SEQUENCE, end_id: int = END_ID, json_name: str = tokens.BYTE_JSON,
         ranks_name: str = tokens.BYTE_RANKS) -> DataFrame:
    """Pieces with their ``sequence_id`` and ``offset``.

    Null or empty text is the end id alone; a null doc_id and repeated rows
    are documents of their own.  An empty table gives no rows.

    To the driver comes one row per length.  A group of one length is ranked
    in parts of about ``RANK_GROUP`` pieces whose first ranks are running
    sums of the parts' sizes, so no length makes a large task.  The slot
    table has a few rows per length (bounded by ``size``), hence the
    broadcast.
    """
    spark = docs.sparkSession
    cut_up = stored(pieces(docs, size, end_id, json_name, ranks_name), "pieces")
    counts = {r.length: r.n for r in cut_up.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table_ = spark.createDataFrame(
        slots(patterns(counts, size)), "length long, lo long, hi long, first long, copies long, base long"
    )
    parts = max(1, -(-max(counts.values(), default=1) // RANK_GROUP))
    dealt = cut_up.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(parts)))
    sizes = dealt.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rank0"))
    within = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = dealt.withColumn("r", F.row_number().over(within) - 1).join(starts, ["length", "part"])
    ranked = ranked.withColumn("r", F.col("r") + F.col("rank0"))
    placed = ranked.join(
        F.broadcast(table_.withColumnRenamed("length", "of")),
        (F.col("length") == F.col("of")) & (F.col("r") >= F.col("lo")) & (F.col("r") < F.col("hi")),
    )
    at = F.col("r") - F.col("lo")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("first") + at % F.col("copies")).alias("sequence_id"),
        (F.col("base") + F.floor(at / F.col("copies")).cast("long") * F.col("length")).alias("offset"),
    )


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
