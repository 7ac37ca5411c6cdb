"""Word-window deduplication by super-k-mer partitioning.

A word of a document goes if a window of ``window`` consecutive words that
covers it also starts earlier.  The smallest hashed run of ``gram`` words in a
window is its minimiser.  Consecutive windows that share one minimiser form a
super-k-mer, and travel as one packed string (their words joined by single
spaces) to the bucket of that minimiser: equal windows have equal minimisers,
so they meet there, and sorting the bucket's windows by content, then place,
tells which one is first.

Before anything travels, a task combines its equal strings, and a light
exchange of (minimiser, place) finds the buckets with a single string, which
holds no two equal windows and stays where it is.  A bucket of more than
``BUCKET_BYTES`` is dealt over several parts by the digest of its strings;
each part sorts its own windows, and only the first window of each content
goes on to be compared with those of the other parts, dealt by the window
itself.  No step holds more than a part, whatever the text has in common.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapmetrics.llm.arrays import BASE, SPACE, _STEPS, mix, windows, words
from snapmetrics.llm.common import byte_view, keyed_text, scratch_path, stored, table, text_chunks

WINDOW = 20
#: Words of a minimiser.
GRAM = 3
#: Bytes of words among which a task combines equal strings.
BLOCK_BYTES = 32 << 20
#: Bytes of strings that a bucket's part holds, about.
BUCKET_BYTES = 1 << 18
#: Bytes of strings that are sorted at a time.
SORT_BYTES = 4 << 20
#: Words taken at a time, so that a place fits beside a hash.
PART_WORDS = 1 << 23

#: Kinds of row: words known to go, a string whose bucket has another one in
#: its block, the only string of its bucket in its block, and the size of a
#: bucket with several strings in a block.
COVERED, SHARED, ALONE, SIZE = range(4)
COLUMNS = ("key", "bucket", "doc", "s", "e", "bytes")
ROWS = "kind int, " + ", ".join(f"{c} long" for c in COLUMNS)
_SCHEMA = pa.schema([("kind", pa.int32()), *((c, pa.int64()) for c in COLUMNS)])

#: Of the sorting step: words known to go, a window still to be compared.
AGAIN = 1
SORTED = "kind int, bucket long, doc long, s long, e long, packed binary"


# --- packed words ---------------------------------------------------------------------


def compact(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) with each word followed by exactly one space."""
    inside = ~SPACE[raw]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    ends = off[1:][off[1:] > off[:-1]] - 1
    last[ends] = inside[ends]
    size = inside + last.astype(np.int64)
    place = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(size, out=place[1:])
    out = np.full(int(place[-1]), 0x20, np.uint8)
    out[place[:-1][inside]] = raw[inside]
    return out, place[off]


def packed_words(raw: np.ndarray, off: np.ndarray):
    """(bytes, row, hash, start and end of each word in the bytes, first word
    of each row)."""
    data, at = compact(raw, off)
    row, start, h = words(data, at)
    end = np.append(start[1:], len(data)) - 1 if len(start) else start
    return data, row, h, start, end, np.searchsorted(row, np.arange(len(off)))


def slices(data: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.LargeBinaryArray:
    """The byte strings data[a:b]."""
    off = np.zeros(len(a) + 1, np.int64)
    np.cumsum(b - a, out=off[1:])
    body = data[np.repeat(a - off[:-1], b - a) + np.arange(off[-1])]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(a), [None, pa.py_buffer(off), pa.py_buffer(body)])


def same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> np.ndarray:
    """True where data[a:b] equals data[c:d]."""
    out = (b - a) == (d - c)
    step = 1 << 14
    for i in range(0, len(a), step):
        k = i + np.flatnonzero(out[i : i + step])
        if k.size:
            n = b[k] - a[k]
            from_ = np.cumsum(n) - n
            at = np.arange(int(n.sum())) - np.repeat(from_, n)
            differ = data[np.repeat(a[k], n) + at] != data[np.repeat(c[k], n) + at]
            out[k] = np.add.reduceat(differ, from_) == 0
    return out


# --- super-k-mers -----------------------------------------------------------------------


def superkmers(h: np.ndarray, row: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(first word, end word, minimiser, content hash) of the super-k-mers of
    hashed words.  A super-k-mer has fewer than twice ``window`` words, so its
    first and last window cover it; no two of its windows are equal."""
    got = []
    for a in range(0, max(len(h) - window + 1, 0), PART_WORDS):
        part = slice(a, a + PART_WORDS + window - 1)
        s, e, *rest = _superkmers(h[part], row[part], window, gram)
        got.append((s + a, e + a, *rest))
    if not got:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*got, strict=True))


def _superkmers(h: np.ndarray, row: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    n, g = len(h) - window + 1, len(h) - gram + 1
    grams = np.zeros(g, np.uint64)
    for j in range(gram):
        grams += h[j : j + g] * _STEPS[j]
    grams = mix(grams)
    low = np.uint64((1 << 24) - 1)
    least = (grams & ~low) | np.arange(g, dtype=np.uint64)
    width, w = window - gram + 1, 1
    while 2 * w <= width:
        least, w = np.minimum(least[:-w], least[w:]), 2 * w
    least = np.minimum(least[:n], least[width - w : width - w + n])
    inside = row[:n] == row[window - 1 :]
    change = np.ones(n + 1, bool)
    change[1:-1] = (least[1:] != least[:-1]) | (inside[1:] != inside[:-1]) | (row[1:n] != row[: n - 1])
    s, e = np.flatnonzero(change[:-1] & inside), np.flatnonzero(change[1:] & inside) + window
    ends = np.zeros((2, len(s)), np.uint64)
    for j in range(window):
        ends[0] += h[s + j] * _STEPS[j]
        ends[1] += h[e - window + j] * _STEPS[j]
    content = mix(mix(ends[0] + (e - s).astype(np.uint64) * BASE) + ends[1])
    return s, e, grams[(least[s] & low).astype(np.int64)], content


def _rows(kind: int, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(columns[0]), 1 << 18):
        part = [c[i : i + (1 << 18)] for c in columns]
        kinds = pa.array(np.full(len(part[0]), kind, np.int32))
        yield pa.RecordBatch.from_arrays([kinds, *(pa.array(c.view(np.int64)) for c in part)], schema=_SCHEMA)


def merged(doc: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans by document, overlapping neighbours made one."""
    by = np.lexsort((s, doc))
    doc, s, e = doc[by], s[by], e[by]
    first = np.ones(len(doc), bool)
    first[1:] = (doc[1:] != doc[:-1]) | (s[1:] > e[:-1])
    at = np.flatnonzero(first)
    return doc[at], s[at], np.maximum.reduceat(e, at) if len(at) else e


def _combine(data: np.ndarray, bucket, content, doc, s, e, a, b) -> Iterator[pa.RecordBatch]:
    """A block's strings: each different one once, with its first place."""
    by = np.lexsort((s, doc, content, bucket))
    bucket, content, doc, s, e, a, b = (x[by] for x in (bucket, content, doc, s, e, a, b))
    first = np.ones(len(by), bool)
    first[1:] = (bucket[1:] != bucket[:-1]) | (content[1:] != content[:-1])
    lead = np.maximum.accumulate(np.where(first, np.arange(len(by)), 0))
    rest = np.flatnonzero(~first)
    # Equal hashes propose copies, their bytes decide.
    first[rest[~same_bytes(data, a[rest], b[rest], a[lead[rest]], b[lead[rest]])]] = True
    later = np.flatnonzero(~first)
    later = later[(doc[later] != doc[lead[later]]) | (s[later] != s[lead[later]])]
    d, x, y = merged(doc[later], s[later], e[later])
    zero = lambda n: np.zeros(n, np.int64)
    yield from _rows(COVERED, mix(d.view(np.uint64) + x.view(np.uint64) * BASE), zero(len(d)), d, x, y, zero(len(d)))
    bucket, doc, s, e, size = bucket[first], doc[first], s[first], e[first], (b - a)[first]
    head = np.ones(len(bucket), bool)
    head[1:] = bucket[1:] != bucket[:-1]
    at = np.flatnonzero(head)
    count = np.diff(at, append=len(bucket))
    alone = np.repeat(count == 1, count)
    x = [c[alone] for c in (bucket, bucket, doc, s, e, size)]
    yield from _rows(ALONE, *x)
    x = [c[~alone] for c in (bucket, doc, s, e, size)]
    yield from _rows(SHARED, mix(x[1].view(np.uint64) + x[2].view(np.uint64) * BASE), *x)
    if len(at):
        many, sums = count > 1, np.add.reduceat(size, at)
        n = int(many.sum())
        yield from _rows(SIZE, bucket[at][many], bucket[at][many], zero(n), zero(n), zero(n), sums[many])


def _parse(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, blobs, size = [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                yield from _combine(np.concatenate(blobs), *(np.concatenate(x) for x in zip(*held, strict=True)))
            held.clear()
            blobs.clear()

        for part, raw, off in text_chunks(batches):
            ids = part.column("doc_id").to_numpy(zero_copy_only=False)
            data, row, h, start, end, base = packed_words(raw, off)
            s, e, bucket, content = superkmers(h, row, window, gram)
            own = row[s]
            held.append((bucket, content, ids[own], s - base[own], e - base[own], start[s] + size, end[e - 1] + size))
            blobs.append(data)
            size += len(data)
            if size > BLOCK_BYTES:
                yield from flush()
                size = 0
        yield from flush()

    return run


# --- buckets -----------------------------------------------------------------------------


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The packed strings of each document's wanted super-k-mers."""
    for part, raw, off in text_chunks(batches):
        data, row, _, start, end, base = packed_words(raw, off)
        want = part.column("want")
        own = np.repeat(np.arange(part.num_rows), np.diff(want.offsets.to_numpy()))
        flat = want.flatten()
        bucket, parts, s, e = (flat.field(c).to_numpy() for c in ("bucket", "parts", "s", "e"))
        # Rows that share an id may be shorter than the one a place is from.
        fits = e <= (base[1:] - base[:-1])[own]
        own, bucket, parts, s, e = (x[fits] for x in (own, bucket, parts, s, e))
        body = slices(data, start[base[own] + s], end[base[own] + e - 1])
        doc = part.column("doc_id").to_numpy()[own]
        out = pa.RecordBatch.from_arrays([*(pa.array(x) for x in (bucket, parts, doc, s)), body.cast(pa.binary())], names=["bucket", "parts", "doc", "s", "packed"])
        for i in range(0, out.num_rows, 1 << 16):
            yield out.slice(i, 1 << 16)


def _first_windows(rows: pa.Table, again: np.ndarray, window: int) -> Iterator[pa.RecordBatch]:
    """Sorts the windows of packed strings: those that are not the first of
    their content go; of rows marked ``again``, the first ones are given for
    another comparison."""
    data, off = byte_view_binary(rows.column("packed"))
    doc, s = (rows.column(c).to_numpy() for c in ("doc", "s"))
    row, start, h = words(data, off)
    base = np.searchsorted(row, np.arange(len(off)))
    next_ = np.append(start[1:] - 1, len(data))
    ends = np.flatnonzero(np.append(row[1:] != row[:-1], True)) if len(row) else row
    next_[ends] = off[1:][row[ends]]
    at, hw = windows(h, row, window)
    own = row[at]
    doc, s = doc[own], s[own] + at - base[own]
    a, b = start[at], next_[at + window - 1]
    by = np.lexsort((s, doc, hw))
    hw, doc, s, a, b, own = (x[by] for x in (hw, doc, s, a, b, own))
    first = np.ones(len(by), bool)
    first[1:] = hw[1:] != hw[:-1]
    run = np.cumsum(first) - 1
    lead = np.flatnonzero(first)[run] if len(by) else run
    rest = np.flatnonzero(~first)
    wrong = rest[~same_bytes(data, a[rest], b[rest], a[lead[rest]], b[lead[rest]])]
    for r in np.unique(run[wrong]).tolist():
        # Different windows under one hash: told apart by their bytes.
        seen: dict[bytes, int] = {}
        for i in np.flatnonzero(run == r).tolist():
            lead[i] = seen.setdefault(data[a[i] : b[i]].tobytes(), i)
            first[i] = lead[i] == i
    later = ~first & ((doc != doc[lead]) | (s != s[lead]))
    d, x, y = merged(doc[later], s[later], s[later] + window)
    none = pa.nulls(len(d), pa.binary())
    names = ["kind", "bucket", "doc", "s", "e", "packed"]
    zero = np.zeros(len(d), np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(d), COVERED, np.int32)), pa.array(zero), pa.array(d), pa.array(x), pa.array(y), none], names=names)
    more = np.flatnonzero(first & again[own])
    for i in range(0, len(more), 1 << 15):
        k = more[i : i + (1 << 15)]
        kind = np.full(len(k), AGAIN, np.int32)
        body = slices(data, a[k], b[k]).cast(pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(hw[k].view(np.int64)), pa.array(doc[k]), pa.array(s[k]), pa.array(s[k] + window), body], names=names)


def byte_view_binary(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    raw, off = byte_view(column.cast(pa.large_binary()).combine_chunks().view(pa.large_string()))
    return raw, off


def _sort(window: int):
    """Strings in order of their part; a part of more than ``SORT_BYTES`` is
    taken piece by piece, and the pieces' first windows are given again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, cut = 0, None  # cut: the part that an earlier piece began

        def key(t, i):
            return t.column("bucket")[i].as_py(), t.column("part")[i].as_py()

        def take(t: pa.Table, broken: set) -> Iterator[pa.RecordBatch]:
            again = t.column("parts").to_numpy() > 1
            for b, p in broken:
                again = again | ((t.column("bucket").to_numpy() == b) & (t.column("part").to_numpy() == p))
            yield from _first_windows(t, again, window)

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.column("packed").nbytes
            if size < SORT_BYTES:
                continue
            t = pa.Table.from_batches(held)
            b, p = (t.column(c).to_numpy() for c in ("bucket", "part"))
            new = np.flatnonzero((b[1:] != b[:-1]) | (p[1:] != p[:-1])) + 1
            end = int(new[-1]) if new.size else t.num_rows
            broken = {cut} if cut is not None else set()
            if not new.size:
                broken.add(key(t, 0))
            yield from take(t.slice(0, end), broken)
            # What is left begins a part anew, unless the only one was cut.
            cut = None if new.size else key(t, 0)
            held = t.slice(end).to_batches() if end < t.num_rows else []
            size = sum(x.column("packed").nbytes for x in held)
        if held:
            yield from take(pa.Table.from_batches(held), {cut} if cut is not None else set())

    return run


def _dealt(strings: DataFrame, window: int, path: str) -> tuple[DataFrame, DataFrame]:
    """Sort strings (bucket, part, parts, doc, s, packed) in their parts:
    (spans to go, windows to be compared again)."""
    columns = [F.col(c) for c in ("bucket", "part", "parts", "doc", "s", "packed")]
    dealt = strings.select(*columns).repartition("bucket", "part").sortWithinPartitions("bucket", "part")
    dealt.mapInArrow(_sort(window), SORTED).write.partitionBy("kind").parquet(path)
    rows = strings.sparkSession.read.schema(SORTED).parquet(path)
    return rows.where(F.col("kind") == COVERED).select("doc", "s", "e"), rows.where(F.col("kind") == AGAIN)


def repeated_words(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc, s, e): word spans whose union is what each document loses."""
    spark = docs.sparkSession
    path = scratch_path(spark, "super-k-mers")
    met = Window.partitionBy("key")
    rows = docs.mapInArrow(_parse(window, gram), ROWS)
    rows = rows.withColumn("n", F.count(F.lit(1)).over(met)).withColumn("total", F.sum("bytes").over(met))
    kind = F.col("kind")
    keep = kind.isin(COVERED, SHARED) | (F.col("n") > 1) & (kind == ALONE) | (kind == SIZE) & (F.col("total") > BUCKET_BYTES)
    rows.where(keep).select("kind", "bucket", "doc", "s", "e", "total").write.partitionBy("kind").parquet(path)
    rows = spark.read.schema("kind int, bucket long, doc long, s long, e long, total long").parquet(path)
    spans = rows.where(kind == COVERED).select("doc", "s", "e")
    large = rows.where(kind.isin(ALONE, SIZE) & (F.col("total") > BUCKET_BYTES)).groupBy("bucket").agg(F.max("total").alias("total"))
    large = stored(large.select("bucket", F.ceil(F.col("total") / BUCKET_BYTES).cast("long").alias("parts")), "large-buckets")
    wanted = rows.where(kind.isin(ALONE, SHARED)).select("bucket", "doc", "s", "e").join(large, "bucket", "left")
    place = F.struct("bucket", F.coalesce("parts", F.lit(1).cast("long")).alias("parts"), "s", "e")
    wanted = wanted.groupBy(F.col("doc").alias("doc_id")).agg(F.collect_list(place).alias("want"))
    strings = docs.join(wanted, "doc_id").mapInArrow(_extract, "bucket long, parts long, doc long, s long, packed binary")
    strings = strings.withColumn("part", F.pmod(F.xxhash64("packed"), F.col("parts")))
    while True:
        found, again = _dealt(strings, window, scratch_path(spark, "windows"))
        spans = spans.unionByName(found)
        if again.isEmpty():
            return spans
        one = F.lit(0).cast("long")
        strings = again.select("bucket", "doc", "s", "packed").withColumns({"part": one, "parts": one})


# --- documents ------------------------------------------------------------------------------


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, raw, off in text_chunks(batches):
        data, row, _, start, end, base = packed_words(raw, off)
        gone = np.zeros(len(row) + 1, np.int64)
        spans = part.column("spans")
        count = np.diff(base)
        own = np.repeat(np.arange(part.num_rows), np.where(spans.is_valid(), np.diff(spans.offsets.to_numpy()), 0))
        flat = spans.flatten()
        for column, step in (("s", 1), ("e", -1)):
            place = np.minimum(flat.field(column).to_numpy(), count[own])
            np.add.at(gone, base[own] + place, step)
        out = np.cumsum(gone[:-1]) > 0
        removed = np.add.reduceat(np.append(out, False), np.minimum(base[:-1], len(out)), dtype=np.int64) * (count > 0)
        size = (end - start + 1) * ~out
        at = np.zeros(len(row) + 1, np.int64)
        np.cumsum(size, out=at[1:])
        body = data[np.repeat(~out, end - start + 1)]
        a, b = at[base[:-1]], at[base[1:]]
        kept = [body[x : max(y - 1, x)].tobytes() for x, y in zip(a.tolist(), b.tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(count), pa.array(removed), pa.array(kept, pa.binary())], names=["doc_id", "n_words", "n_removed", "kept"]
        )


def dedup_windows(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept words joined by one space, as bytes)
    of every document.

    Null text has no words; a text of fewer than ``window`` words has no
    window and stays whole.  A row without an id loses nothing and counts for
    no other.  Rows that share an id are one document: equal windows at the
    same place do not remove each other, and a place that goes in one of the
    rows goes in each.  Other columns are ignored.
    """
    texts = keyed_text(docs, id_col, text_col)
    spans = repeated_words(texts.where(F.col("doc_id").isNotNull()), window, gram)
    lists = spans.groupBy(F.col("doc").alias("doc_id")).agg(F.collect_list(F.struct("s", "e")).alias("spans"))
    return texts.join(lists, "doc_id", "left").mapInArrow(_cut, "doc_id long, n_words long, n_removed long, kept binary")


def op11_super_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = dedup_windows(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
