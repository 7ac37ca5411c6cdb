"""Exact substring deduplication by a run-length index.

A byte of a document goes if a string of ``length`` bytes that covers it also
starts earlier.  Whole texts are read as overlapping phrases: the windows of
``length`` bytes that share their smallest hashed gram (the anchor) form one
phrase, so equal windows always lie in phrases of equal anchors.  Each
distinct phrase counts once (a dictionary as in prefix-free parsing of
repetitive corpora).  Two phrases can match only if they share the anchor and,
as a window has at least ``side`` bytes on one side of it, those bytes too;
others are set aside.  What is left is dealt by anchor into buckets, and each
bucket gets a run-length index that marks the long matches.  The windows of an
anchor with very many phrases are compared by digests instead.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmetrics.llm.arrays import BASE, BYTE_VALUES, mix, repeated
from snapmetrics.llm.common import keyed_text, scratch_path, stored, table, text_chunks
from snapmetrics.llm.runindex import RunIndex

LENGTH = 100
#: Bytes of an anchor.
GRAM = 16
#: Bytes of phrases in an index, about.
BUCKET_BYTES = 1 << 18
#: Phrases of one anchor beyond which its windows are compared by digests.
WIDE = 4000
#: Phrases of one anchor that a task compares at a time; of an anchor with
#: more, all go to the index.
HELD = 1 << 20

PHRASE, REMOVED, NEEDED = range(3)
COLUMNS = ("anchor", "content", "doc", "s", "e", "sides")
ROWS = "kind int, " + ", ".join(f"{c} long" for c in COLUMNS)
_SCHEMA = pa.schema([("kind", pa.int32()), *((c, pa.int64()) for c in COLUMNS)])


def _rows(kind: int, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(columns[0]), 1 << 18):
        part = [c[i : i + (1 << 18)] for c in columns]
        kinds = pa.array(np.full(len(part[0]), kind, np.int32))
        yield pa.RecordBatch.from_arrays([kinds, *(pa.array(c.view(np.int64)) for c in part)], schema=_SCHEMA)


def _longer(h: np.ndarray, span: int) -> np.ndarray:
    """Hashes of twice the span from those of ``span`` bytes."""
    return h[:-span] * (BASE ** np.uint64(span)) + h[span:]


def phrases(raw: np.ndarray, off: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(row, start, end, anchor, content, sides) of the phrases of each row;
    rows shorter than ``length`` have none.  ``sides`` packs a 32-bit hash of
    the bytes before and one of those after the anchor, 0 where a phrase has
    too few.  ``gram`` is 16 or 32 and ``length`` from 80 to 104, as three
    spans of 64 bytes must cover a phrase."""
    n = len(raw)
    windows = n - length + 1
    if windows <= 0:
        return tuple(np.zeros(0, np.int64) for _ in range(3)) + tuple(np.zeros(0, np.uint64) for _ in range(3))
    with np.errstate(over="ignore"):
        h, span = BYTE_VALUES[raw], 1
        while span < gram:
            h, span = _longer(h, span), 2 * span
        grams = mix(h)
        while span < 32:
            h, span = _longer(h, span), 2 * span
        half = h
        h = _longer(h, span)
        low = np.uint64((1 << 24) - 1)
        least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
        # Sliding minimum over the grams of a window, leftmost first.
        width, w = length - gram + 1, 1
        while 2 * w <= width:
            least, w = np.minimum(least[:-w], least[w:]), 2 * w
        least = np.minimum(least[:windows], least[width - w : width - w + windows])
        row = np.repeat(np.arange(len(off) - 1), np.diff(off))[:windows]
        inside = off[1:][row] - np.arange(windows) >= length
        first = inside.copy()
        first[1:] &= ~inside[:-1] | (row[1:] != row[:-1]) | (least[1:] != least[:-1])
        last = inside.copy()
        last[:-1] &= ~inside[1:] | (row[1:] != row[:-1]) | (least[1:] != least[:-1])
        s, e = np.flatnonzero(first), np.flatnonzero(last) + length
        size = (e - s).astype(np.uint64)
        # Three spans of 64 bytes cover a phrase.
        content = mix(mix(h[s] + size * BASE) + h[(s + e - 64) // 2])
        content = mix(content + h[e - 64])
        at = (least[s] & low).astype(np.int64)
        side = -(-(length - gram) // 2)
        left, right = at - s >= side, e - at - gram >= side
        sides = np.zeros(len(s), np.uint64)
        for has, a, shift in ((left, at - side, 32), (right, at + gram, 0)):
            ends = mix(mix(half[a[has]]) + half[a[has] + side - 32]) >> np.uint64(33) | np.uint64(1)
            sides[has] |= ends << np.uint64(shift)
    return row[s], s - off[row[s]], e - off[row[s]], grams[at], content, sides


def _merged(doc: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans in document order, overlapping neighbours made one."""
    by = np.lexsort((s, doc))
    doc, s, e = doc[by], s[by], e[by]
    first = np.ones(len(doc), bool)
    first[1:] = (doc[1:] != doc[:-1]) | (s[1:] > e[:-1])
    at = np.flatnonzero(first)
    return doc[at], s[at], np.maximum.reduceat(e, at) if len(at) else e


def _parse(length: int, gram: int):
    """A task's distinct phrases; their later copies in the task are removed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = []
        for part, raw, off in text_chunks(batches, 1 << 18):
            ids = part.column("doc_id").to_numpy(zero_copy_only=False)
            for a, ends in _parts(off, length):
                row, s, e, anchor, content, sides = phrases(raw[a : a + ends[-1]], ends, length, gram)
                got.append((anchor, content, ids[row], s + a, e + a, sides))
        if not got:
            return
        anchor, content, doc, s, e, sides = (np.concatenate(x) for x in zip(*got, strict=True))
        del got
        if len(doc) and (np.diff(doc) < 0).any():
            by = np.argsort(doc, kind="stable")
            anchor, content, doc, s, e, sides = (x[by] for x in (anchor, content, doc, s, e, sides))
        by = np.argsort(content, kind="stable")
        k, a = content[by], anchor[by]
        first = np.ones(len(by), bool)
        first[1:] = (k[1:] != k[:-1]) | (a[1:] != a[:-1])
        lead = by[np.maximum.accumulate(np.where(first, np.arange(len(by)), 0))]
        later = by[~first & ((doc[by] != doc[lead]) | (s[by] != s[lead]))]
        doc_, s_, e_ = _merged(doc[later], s[later], e[later])
        yield from _rows(REMOVED, doc_, s_, doc_, s_, e_, s_)
        keep = by[first]
        yield from _rows(PHRASE, *(x[keep] for x in (anchor, content, doc, s, e, sides)))

    return run


def _parts(off: np.ndarray, length: int, most: int = 1 << 23) -> Iterator[tuple[int, np.ndarray]]:
    """(start, offsets) of the parts that ``phrases`` takes at a time, whose
    positions fit 24 bits: a chunk as it is; of one very long text, parts that
    overlap by one byte less than a window.  Phrases are cut at part ends,
    where equal windows still share their anchors."""
    if off[-1] <= most:
        yield 0, off
    else:
        for a in range(0, int(off[-1]) - length + 1, most):
            yield a, np.array([0, min(int(off[-1]) - a, most + length - 1)])


def _sharing(x: np.ndarray) -> np.ndarray:
    """True for each phrase (columns in rows) that shares its anchor and the
    bytes on one side of it with another one."""
    need = np.zeros(x.shape[1], bool)
    anchor, sides = x[0].view(np.uint64), x[5].view(np.uint64)
    for side in (sides >> np.uint64(32), sides & np.uint64(0xFFFFFFFF)):
        has = np.flatnonzero(side)
        need[has[repeated(mix(anchor[has] ^ mix(side[has])))]] = True
    return need


def _match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Phrases sorted by (anchor, content, doc, s): later copies of a phrase
    are removed; of the first ones, those that share a side are needed.  An
    anchor's phrases are held until its last, up to ``HELD``."""
    prev = lead = None
    held = np.zeros((len(COLUMNS), 0), np.int64)
    full = False  # the held anchor had more phrases than may be held
    for batch in batches:
        kind = batch.column("kind").to_numpy()
        if (other := np.flatnonzero(kind != PHRASE)).size:
            yield batch.take(pa.array(other))
        at = np.flatnonzero(kind == PHRASE)
        if not at.size:
            continue
        x = np.stack([batch.column(c).to_numpy()[at] for c in COLUMNS])
        first = np.ones(x.shape[1], bool)
        first[1:] = (x[:2, 1:] != x[:2, :-1]).any(axis=0)
        if prev is not None and (x[:2, 0] == prev).all():
            first[0] = False
        leads = np.hstack([x[:, :1] if lead is None else lead[:, None], x[:, first]])
        own = leads[:, np.cumsum(first)]
        later = ~first & ((x[2] != own[2]) | (x[3] != own[3]))
        yield from _rows(REMOVED, *x[:, later])
        prev, lead = x[:2, -1].copy(), own[:, -1].copy()
        held = np.hstack([held, x[:, first]])
        if not held.shape[1]:
            continue
        # The last anchor may go on in the next batch.
        done = int(np.searchsorted(held[0], held[0, -1]))
        if done:
            need = _sharing(held[:, :done])
            need[: np.searchsorted(held[0, :done], held[0, 0], "right")] |= full
            yield from _rows(NEEDED, *held[:, :done][:, need])
            held, full = held[:, done:], False
        if held.shape[1] > HELD:
            yield from _rows(NEEDED, *held)
            held, full = held[:, :1], True
    if held.shape[1]:
        yield from _rows(NEEDED, *held[:, _sharing(held) | full])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the needed phrases of each document."""
    for batch in batches:
        out: tuple[list, ...] = ([], [], [], [])
        for i in range(batch.num_rows):
            doc, text = batch.column("doc_id")[i].as_py(), batch.column("text")[i].as_py().encode()
            want = batch.column("want")[i].values
            for anchor, s, e in zip(*(want.field(c).to_pylist() for c in ("anchor", "s", "e")), strict=True):
                for column, value in zip(out, (anchor, doc, s, text[s:e]), strict=True):
                    column.append(value)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)],
            names=["anchor", "doc", "s", "body"],
        )


def _windows(length: int):
    """128-bit digest and place of each window of the needed phrases."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                doc, text = batch.column("doc_id")[i].as_py(), batch.column("text")[i].as_py().encode()
                want = batch.column("want")[i].values
                at = [p for s, e in zip(*(want.field(c).to_pylist() for c in ("s", "e")), strict=True) for p in range(s, min(e, len(text)) - length + 1)]
                digests = b"".join(hashlib.blake2b(text[p : p + length], digest_size=16).digest() for p in at)
                h = np.frombuffer(digests, np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy()), pa.array([doc] * len(at), pa.int64()), pa.array(at, pa.int64())], names=["h1", "h2", "doc", "s"]
                )

    return run


def _joined(length: int):
    """Spans of windows sorted by document and place, overlapping ones of a
    batch made one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, s = (batch.column(c).to_numpy() for c in ("doc", "s"))
            d, a, b = _merged(doc, s, s + length)
            yield pa.RecordBatch.from_arrays([pa.array(d), pa.array(a), pa.array(b)], names=["doc", "s", "e"])

    return run


def _later_windows(docs: DataFrame, needed: DataFrame, length: int) -> DataFrame:
    """(doc, s, e) of the windows of the needed phrases that start earlier too.

    The aggregate is combined before its shuffle, so a window in a third of
    the documents arrives as one row per task.  The groups are written before
    the join back, so that Spark may split a hot window's rows there.
    """
    windows = stored(docs.join(_wanted(needed), "doc_id").mapInArrow(_windows(length), "h1 long, h2 long, doc long, s long"), "windows")
    place = F.struct("doc", "s")
    groups = windows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last").drop("last")
    later = windows.join(stored(groups, "window-groups"), ["h1", "h2"]).where(place != F.col("first"))
    return later.select("doc", "s").repartition("doc").sortWithinPartitions("doc", "s").mapInArrow(_joined(length), "doc long, s long, e long")


def _wanted(needed: DataFrame) -> DataFrame:
    return needed.groupBy(F.col("doc").alias("doc_id")).agg(F.collect_list(F.struct("anchor", "s", "e")).alias("want"))


def _index(length: int):
    def run(rows: pa.Table) -> pa.Table:
        doc, s = (rows.column(c).to_numpy() for c in ("doc", "s"))
        by = np.lexsort((s, doc))
        # Of repeated rows of a document, one counts.
        once = np.ones(len(by), bool)
        once[1:] = (doc[by[1:]] != doc[by[:-1]]) | (s[by[1:]] != s[by[:-1]])
        by = by[once]
        doc, s = doc[by], s[by]
        bodies = rows.column("body").to_pylist()
        bodies = [bodies[i] for i in by]
        data = np.frombuffer(b"".join(bodies), np.uint8)
        starts = np.cumsum([0, *map(len, bodies)])[:-1]
        hit = np.flatnonzero(RunIndex(data, starts).repeats(length))
        which = np.searchsorted(starts, hit, "right") - 1
        at = s[which] + hit - starts[which]
        d, a, b = _merged(doc[which], at, at + length)
        return pa.table({"doc": d, "s": a, "e": b})

    return run


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc, s, e): byte spans whose union is what each document loses.

    The sort of phrases streams, so a hot anchor takes no memory; copies of
    a phrase are one row per task.  The windows of an anchor with more than
    ``WIDE`` different phrases take no index.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "phrases")
    (
        docs.mapInArrow(_parse(length, gram), ROWS)
        .repartition("anchor")
        .sortWithinPartitions("anchor", "content", "doc", "s")
        .mapInArrow(_match, ROWS)
        .write.partitionBy("kind")
        .parquet(path)
    )
    rows = spark.read.schema(ROWS).parquet(path)
    removed = rows.where(F.col("kind") == REMOVED).select("doc", "s", "e")
    needed = rows.where(F.col("kind") == NEEDED).select("anchor", "doc", "s", "e")
    wide = stored(needed.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > WIDE).select("anchor"), "wide-anchors")
    if not wide.isEmpty():
        removed = removed.unionByName(_later_windows(docs, needed.join(wide, "anchor", "left_semi"), length))
        needed = needed.join(wide, "anchor", "left_anti")
    total = needed.agg(F.sum(F.col("e") - F.col("s"))).first()[0] or 0
    buckets = max(1, -(-int(total) // BUCKET_BYTES))
    bodies = docs.join(_wanted(needed), "doc_id").mapInArrow(_extract, "anchor long, doc long, s long, body binary")
    dealt = bodies.withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(buckets)))
    found = dealt.groupBy("bucket").applyInArrow(_index(length), "doc long, s long, e long")
    return removed.unionByName(found)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, gone, runs, kept = [], [], [], []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans"), strict=True):
            raw = text.encode()
            mask = np.zeros(len(raw) + 1, np.int32)
            if spans.is_valid:
                s, e = (np.minimum(spans.values.field(c).to_numpy(), len(raw)) for c in ("s", "e"))
                np.add.at(mask, s, 1)
                np.add.at(mask, e, -1)
            out = np.cumsum(mask[:-1]) > 0
            sizes.append(len(raw))
            gone.append(int(out.sum()))
            runs.append(int((out[1:] & ~out[:-1]).sum() + out[:1].sum()))
            kept.append(np.frombuffer(raw, np.uint8)[~out].tobytes() if gone[-1] else raw)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in (sizes, gone, runs)), pa.array(kept, pa.binary())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
        )


def dedup_substrings(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept bytes) of every document.

    Null text is empty.  A row without an id loses nothing and counts for no
    other.  Repeated rows of an id are one document: each loses what any of
    them loses.
    """
    texts = keyed_text(docs, id_col, text_col)
    spans = repeated_spans(texts.where(F.col("doc_id").isNotNull()), length, gram)
    lists = spans.groupBy(F.col("doc").alias("doc_id")).agg(F.collect_list(F.struct("s", "e")).alias("spans"))
    return texts.join(lists, "doc_id", "left").mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = dedup_substrings(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
