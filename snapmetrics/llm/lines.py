"""Line deduplication with two Bloom filters.

First pass: every task keeps a filter of line hashes seen once and one of
hashes seen twice, in different documents.  Merging two tasks' filters, a
hash may have been seen twice if either task says so or both have it in their
first filter (bitwise and), so nothing seen twice is ever missed.  Second
pass: only lines whose hash is in the merged second filter are shuffled, as
128-bit digests, for the exact count and the choice of the first document.
Documents that lose no line are finished in a scan: a filter of the ids that
do lose one tells them apart, and only the others' texts meet their keys in a
shuffle.

The filters' size follows the input (about 16 bits for every line of 64
bytes), between 16 and 64 MB.  Past some hundred million distinct lines
they let more lines through, which costs shuffle but no result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmetrics.llm.arrays import mix
from snapmetrics.llm.common import stored, table

#: Least and most bits of a filter (16 and 64 MB), and bits of the parts in
#: which it is merged.
FILTER_BITS = 1 << 27
MOST_BITS = 1 << 29
PART_BITS = 1 << 22
MIN_CHARS = 10


def line_key(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """The line without ASCII white space at its ends, A-Z lower-cased; None
    if it has fewer code points than asked."""
    key = line.strip().lower()
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode()) < min_chars):
        return None
    return key


def keys_of(text: str, min_chars: int) -> set[bytes]:
    """The distinct keys of a text."""
    found = {line_key(x, min_chars) for x in text.encode().split(b"\n")}
    found.discard(None)
    return found


def _positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Two bit positions of each hash, as two rows."""
    low = hashes & np.uint64(0xFFFFFFFF)
    return np.stack([hashes >> np.uint64(32), low * np.uint64(0x9E3779B1) & np.uint64(0xFFFFFFFF)]) & np.uint64(bits - 1)


def _pack(positions: np.ndarray) -> bytes:
    return positions.astype("<u4").tobytes()


def filter_bits(n: int, least: int = FILTER_BITS) -> int:
    """At least 16 bits for each of ``n`` entries, a power of two within the bounds."""
    return min(max(least, 1 << (16 * n).bit_length()), MOST_BITS)


def _has(bits_: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each hash whether all its positions are set."""
    return ((bits_[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=0)


def _task_filters(min_chars: int, bits: int, part: int):
    """A task's two filters, as sorted bit positions for each part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for batch in batches:
            hashes = [xxhash.xxh3_64_intdigest(k) for t in batch.column("text") for k in keys_of(t.as_py(), min_chars)]
            h, n = np.unique(np.array(hashes, np.uint64), return_counts=True)
            at = _positions(h, bits)
            known = _has(once, at)
            for target, which in ((twice, at[:, known | (n > 1)]), (once, at)):
                which = which.ravel()
                np.bitwise_or.at(target, which >> np.uint64(3), np.left_shift(np.uint8(1), (which & np.uint64(7)).astype(np.uint8)))
        rows = []
        for k in range(bits // part):
            a, b = (np.flatnonzero(np.unpackbits(f[k * part // 8 : (k + 1) * part // 8], bitorder="little")) for f in (once, twice))
            if len(a):
                rows.append({"part": k, "once": _pack(a), "twice": _pack(b)})
        schema = pa.schema([("part", pa.int32()), ("once", pa.binary()), ("twice", pa.binary())])
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return run


def _merge(part: int):
    """The merged second filter of each part, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once: dict[int, np.ndarray] = defaultdict(lambda: np.zeros(part, bool))
        twice: dict[int, np.ndarray] = defaultdict(lambda: np.zeros(part, bool))
        for batch in batches:
            for k, a, b in zip(*(batch.column(c).to_pylist() for c in ("part", "once", "twice")), strict=True):
                a, b = np.frombuffer(a, "<u4"), np.frombuffer(b, "<u4")
                twice[k][b] = True
                twice[k][a[once[k][a]]] = True
                once[k][a] = True
        for k, v in twice.items():
            yield pa.RecordBatch.from_pylist([{"part": k, "twice": np.packbits(v, bitorder="little").tobytes()}],
                                             schema=pa.schema([("part", pa.int32()), ("twice", pa.binary())]))

    return run


def twice_filter(docs: DataFrame, min_chars: int = MIN_CHARS, bits: int = FILTER_BITS, part: int = PART_BITS) -> Broadcast:
    """Bits of the lines that may occur in two documents or more, on every
    executor; ``bits`` bounds what the driver and the executors hold."""
    got = docs.where(F.col("doc_id").isNotNull()).select("text")
    tasks = got.mapInArrow(_task_filters(min_chars, bits, part), "part int, once binary, twice binary")
    merged = tasks.repartition(bits // part, "part").mapInArrow(_merge(part), "part int, twice binary")
    return _gathered(merged.withColumnRenamed("twice", "set"), bits, part)


def _gathered(parts: DataFrame, bits: int, part: int) -> Broadcast:
    """The parts of a filter (part, set), put together and broadcast."""
    out = np.zeros(bits // 8, np.uint8)
    for row in parts.toLocalIterator():
        out[row.part * part // 8 : (row.part + 1) * part // 8] = np.frombuffer(row.set, np.uint8)
    return parts.sparkSession.sparkContext.broadcast(out)


def _id_positions(ids: pa.Array, bits: int) -> np.ndarray:
    """Bit positions of document ids, null as 0."""
    values = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False).astype(np.uint64)
    return _positions(mix(values), bits)


def _id_bits(bits: int, part: int):
    """The bits of a task's ids, a row for each part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(bits // 8, np.uint8)
        for batch in batches:
            at = _id_positions(batch.column("doc_id"), bits).ravel()
            np.bitwise_or.at(own, at >> np.uint64(3), np.left_shift(np.uint8(1), (at & np.uint64(7)).astype(np.uint8)))
        rows = own.reshape(-1, part // 8)
        used = np.flatnonzero(rows.any(axis=1))
        packed = [_pack(np.flatnonzero(np.unpackbits(rows[k], bitorder="little"))) for k in used]
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(packed, pa.binary())], names=["part", "at"])

    return run


def _merge_ids(part: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, np.ndarray] = defaultdict(lambda: np.zeros(part, bool))
        for batch in batches:
            for k, at in zip(batch.column("part").to_pylist(), batch.column("at").to_pylist(), strict=True):
                parts[k][np.frombuffer(at, "<u4")] = True
        for k, v in parts.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([np.packbits(v, bitorder="little").tobytes()])], names=["part", "set"])

    return run


def id_filter(ids: DataFrame, bits: int, part: int = PART_BITS) -> Broadcast:
    """A filter of the ``doc_id`` of a frame, bounded like the lines'."""
    tasks = ids.select("doc_id").mapInArrow(_id_bits(bits, part), "part int, at binary")
    return _gathered(tasks.repartition(bits // part, "part").mapInArrow(_merge_ids(part), "part int, set binary"), bits, part)


def mapped_hits(df: DataFrame, ids: Broadcast, bits: int, id_col: str = "doc_id") -> Callable[[bool], DataFrame]:
    """The rows whose id may be in the filter (True), or those whose id is
    surely not, or null (False)."""

    def split(wanted: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                own = batch.column(id_col)
                hit = _has(ids.value, _id_positions(own, bits)) & own.is_valid().to_numpy(zero_copy_only=False)
                yield batch.filter(pa.array(hit == wanted))

        return df.mapInArrow(run, df.schema)

    return split


def _suspects(min_chars: int, bits: int, filter_: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = [], []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                own = list(keys_of(text.as_py(), min_chars))
                ids += [doc] * len(own)
                keys += own
            at = _positions(np.array([xxhash.xxh3_64_intdigest(k) for k in keys], np.uint64), bits)
            hit = _has(filter_.value, at)
            found = np.flatnonzero(hit).tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[i] for i in found], pa.int64()), pa.array([xxhash.xxh3_128_digest(keys[i]) for i in found], pa.binary())],
                names=["doc_id", "key"],
            )

    return run


def losses(docs: DataFrame, min_chars: int = MIN_CHARS, bits: int = FILTER_BITS, part: int = PART_BITS) -> DataFrame:
    """(doc_id, lost): the keys that a document loses to a smaller doc_id.

    One row per key and task reaches the exact count.  Its result is written
    first, so that both sides of the join back are plain exchanges and Spark
    may split the hot keys of the suspects.  A document's list is no longer
    than its lines.
    """
    filter_ = twice_filter(docs, min_chars, bits, part)
    named = docs.where(F.col("doc_id").isNotNull())
    suspects = stored(named.mapInArrow(_suspects(min_chars, bits, filter_), "doc_id long, key binary"), "suspect-lines")
    firsts = (
        suspects.groupBy("key").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")).where("first_id < last_id")
    )
    lost = suspects.join(stored(firsts, "repeated-lines"), "key").where(F.col("doc_id") > F.col("first_id"))
    return lost.groupBy("doc_id").agg(F.collect_set("key").alias("lost"))


def _keep(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, dropped, kept = [], [], []
            lost = batch.column("lost").to_pylist() if "lost" in batch.schema.names else [None] * batch.num_rows
            for text, gone in zip(batch.column("text").to_pylist(), lost, strict=True):
                if gone:
                    gone, lines = set(gone), text.encode().split(b"\n")
                    stay = [x for x in lines if (k := line_key(x, min_chars)) is None or xxhash.xxh3_128_digest(k) not in gone]
                    total.append(len(lines))
                    dropped.append(len(lines) - len(stay))
                    kept.append(b"\n".join(stay).decode())
                else:
                    total.append(text.count("\n") + 1)
                    dropped.append(0)
                    kept.append(text)
            columns = [batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.string())]
            rest = [n for n in batch.schema.names if n not in ("doc_id", "text", "lost")]
            yield pa.RecordBatch.from_arrays(columns + [batch.column(n) for n in rest], names=["doc_id", "n_lines", "n_dropped", "kept", *rest])

    return run


def dedup_lines(docs: DataFrame, carry: dict[str, str] | None = None, min_chars: int = MIN_CHARS, bits: int | None = None,
                part: int = PART_BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept) of every document, then the columns
    that ``carry`` names, as its values.

    Null text is one empty line.  Documents without an id keep all lines and
    count for none.  Repeated rows of an id are one document, so a line in
    two of them only is no repeat, and both lose the same keys.
    """
    carry = carry or {}
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                      *[F.col(a).alias(b) for a, b in carry.items()])
    if bits is None:
        size = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        bits = filter_bits(size // 64)
    lost = stored(losses(src.select("doc_id", "text"), min_chars, bits, part), "lost-lines")
    id_bits = filter_bits(lost.count(), part)
    ids = id_filter(lost, id_bits, part)
    kinds = "".join(f", `{b}` {src.schema[b].dataType.simpleString()}" for b in carry.values())
    schema = "doc_id long, n_lines long, n_dropped long, kept string" + kinds
    maybe = mapped_hits(src, ids, id_bits)
    whole = maybe(False).mapInArrow(_keep(min_chars), schema)
    cut = maybe(True).join(lost, "doc_id", "left")
    return whole.unionByName(cut.mapInArrow(_keep(min_chars), schema))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = dedup_lines(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept"), 256).alias("kept_sha256"))
