"""Set similarity join of word shingles by universe partitioning.

Sets are grouped into size bands in which only neighbouring bands can link.
For a band's pairs the sets differ in at most H elements; the universe is
hashed into segments with thresholds 0 (equal) or 1 (one deletion) that sum,
each plus one, to H + 1.  By the pigeonhole principle linked sets agree
within the threshold in some segment, so they share a signature: the hash of
a segment's subset, or of its one-deletion neighbours.  How many segments get
which threshold is chosen for each band by estimated cost.

Signatures only propose pairs; links are verified exactly.  In a bucket every
member is first compared with one leader.  Buckets whose members then are not
all in one component have their remaining pairs across components examined in
blocks, where a parity bitmap bounds the difference from below before a pair
is emitted; a bitmap has at least as many bits as its set has elements, so
unlike sets of every size are ruled out.  Copies, and near copies that all link, thus never make all
pairs, and no link between components is missed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmetrics.llm.arrays import BASE, LOWER, _STEPS, mix, windows, words
from snapmetrics.llm.common import keyed_text, release_memory, scratch_path, stored, table, text_chunks
from snapmetrics.llm.components import components

#: Bits of an element's hash; the rest of a word holds the row of a chunk.
TOKEN_BITS = 52
#: Bits of the smallest bitmap.
BITMAP = 256
#: Members of an open bucket that a task compares at a time, and about the
#: elements of those by bitmaps (a byte for four) and by sets (eight bytes each).
BLOCK = 1024
BITMAP_ELEMENTS, SET_ELEMENTS = 1 << 24, 1 << 20
#: How often the pairs that may join an open block's components are verified
#: before the block's sets themselves meet.
FOREST_ROUNDS = 2
#: Costs, in signatures, of pairing a member with its bucket's leader, and of
#: comparing two members of an open bucket.
LEADER_COST, COMPARE_COST = 15.0, 0.02


@dataclass(frozen=True)
class Similarity:
    words: int = 5
    #: Least Jaccard similarity, in percent.
    percent: int = 80


# --- bands and their segments -------------------------------------------------------


@dataclass(frozen=True)
class Bands:
    """Largest size, segments with threshold 0 and with threshold 1 of each band."""

    tops: np.ndarray
    zero: np.ndarray
    one: np.ndarray

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.tops, sizes)


def band_tops(percent: int, largest: int) -> list[int]:
    """Ends of the bands: the largest set that can link with a band's smallest."""
    tops, low = [], 1
    while low <= largest:
        tops.append(low * 100 // percent)
        low = tops[-1] + 1
    return tops


def most_different(total: int, percent: int) -> int:
    """Most elements in which two linked sets of ``total`` elements differ."""
    return (100 - percent) * total // (100 + percent)


def allocate(top: int, percent: int, sets: float) -> tuple[int, int]:
    """(segments with threshold 0, with threshold 1) of least estimated cost
    for a band with ``sets`` members of size ``top``: signatures made, and
    members that agree by accident in a segment that is empty or nearly so."""
    need = most_different(2 * top, percent) + 1

    def cost(one: int) -> float:
        zero = need - 2 * one
        mean = top / (zero + one)
        void = math.exp(-mean)
        led = LEADER_COST * void * (zero + one * (1 + mean))
        compared = COMPARE_COST * sets / 2 * void * void * (zero + one * (1 + 2 * mean))
        return zero + one * (1 + mean) + led + compared

    one = min(range(need // 2 + 1), key=cost)
    return need - 2 * one, one


def plan_bands(docs: DataFrame, s: Similarity) -> Bands:
    """Bands up to the largest document, allocated from a histogram of text
    lengths (about 6 bytes a word) with one row per band."""
    size = F.ceil(F.octet_length("text") / 6.0) + 1
    exact = math.log(100 / s.percent)
    hist = docs.groupBy(F.floor(F.log(size.cast("double")) / F.lit(exact)).alias("k")).agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length("text")).alias("most")).collect()
    largest = max((r.most for r in hist), default=0) // 2 + 2
    # One band more, for the smaller partners of the last one.
    tops = band_tops(s.percent, largest * 100 // s.percent + 2)
    near = {r.k: r.n for r in hist}
    members = lambda top: sum(near.get(int(math.log(top) / exact) + d, 0) for d in (-1, 0))
    got = [allocate(t, s.percent, max(members(t), 1)) for t in tops]
    return Bands(np.array(tops), np.array([z for z, _ in got]), np.array([o for _, o in got]))


# --- sets and signatures ----------------------------------------------------------------


def shingle_sets(raw: np.ndarray, off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, element hash) of the distinct shingles of each row, sorted; a row
    with fewer than k words has its whole sequence as the only one."""
    row, _, h = words(LOWER[raw], off)
    at, hw = windows(h, row, k)
    count = np.bincount(row, minlength=len(off) - 1)
    short = np.flatnonzero((count > 0) & (count < k))
    first = np.searchsorted(row, short)
    whole = count[short].astype(np.uint64) * BASE
    for j in range(k - 1):
        some = count[short] > j
        whole[some] += h[first[some] + j] * _STEPS[j + 32]
    rows = np.concatenate([row[at], short]).astype(np.uint64)
    token = np.concatenate([hw, mix(whole)]) >> np.uint64(64 - TOKEN_BITS)
    key = np.unique(rows << np.uint64(TOKEN_BITS) | token)
    return (key >> np.uint64(TOKEN_BITS)).astype(np.int64), key & np.uint64((1 << TOKEN_BITS) - 1)


def signatures(row: np.ndarray, token: np.ndarray, band: np.ndarray, bands: Bands, up: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, signature) of rows with elements, for the index of their band
    (``up`` 0) or the next one (1)."""
    index = np.minimum(band + up, len(bands.tops) - 1)
    zero, one = bands.zero[index], bands.one[index]
    m = zero + one
    base = np.cumsum(m) - m
    h = mix(token + BASE)
    segment = ((h >> np.uint64(32)) * m[row].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
    at = base[row] + segment
    subset = np.zeros(int(m.sum()), np.uint64)
    value = mix(h)
    np.add.at(subset, at, value)
    owner = np.repeat(np.arange(len(m)), m)
    place = np.arange(len(owner)) - base[owner]
    tag = mix(index.astype(np.uint64)[owner] << np.uint64(32) | place.astype(np.uint64))
    whole = mix(subset ^ tag)
    near = segment >= zero[row]
    fewer = mix((subset[at[near]] - value[near]) ^ tag[at[near]])
    return np.concatenate([owner, row[near]]), np.concatenate([whole, fewer])


def bitmaps(row: np.ndarray, token: np.ndarray, n: int) -> list[bytes]:
    """Parity of each row's elements over classes, packed: two rows differ in
    at least as many elements as their bitmaps in bits.  A row has the least
    power of two of classes that is not below its size; a bitmap of twice the
    width folds to the narrower one (``fold``), so rows of neighbouring sizes
    can be compared."""
    size = np.maximum(np.bincount(row, minlength=n), BITMAP)
    width = np.int64(1) << np.ceil(np.log2(size)).astype(np.int64)
    base = np.cumsum(width) - width
    at = base[row] + (token & (width[row] - 1).astype(np.uint64)).astype(np.int64)
    odd = np.bincount(at, minlength=int(width.sum())) & 1
    packed = np.packbits(odd.astype(np.uint8))
    return [packed[x : x + w].tobytes() for x, w in zip((base // 8).tolist(), (width // 8).tolist(), strict=True)]


def fold(words_: np.ndarray) -> np.ndarray:
    """Bitmaps, as words, over half as many classes."""
    half = words_.shape[-1] // 2
    return words_[..., :half] ^ words_[..., half:]


#: Kinds of row: a document with its size and bitmap, a sure link, a
#: signature of a document, a proposed pair.
DOCUMENT, LINK, SIGNATURE, PAIR = range(4)
ROWS = "kind int, key long, a long, b long, bitmap binary"
_SCHEMA = pa.schema([("kind", pa.int32()), ("key", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("bitmap", pa.binary())])


def _rows(kind: int, key: np.ndarray, a: np.ndarray, b: np.ndarray | None, bitmap: list[bytes] | None = None) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(key), 1 << 18):
        part = slice(i, i + (1 << 18))
        n = len(key[part])
        bits = pa.nulls(n, pa.binary()) if bitmap is None else pa.array(bitmap[part], pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, kind, np.int32)), pa.array(key[part].view(np.int64)), pa.array(a[part]),
             pa.nulls(n, pa.int64()) if b is None else pa.array(b[part]), bits],
            schema=_SCHEMA,
        )


def _propose(s: Similarity, bands: Bands):
    """Documents, sure links between equal sets of a task, and the task's
    buckets: its first member of each stands for the others, which are paired
    with it here, so that a hot bucket sends one row per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[int, int, int], int] = {}
        sigs, ids = [], []
        for part, raw, off in text_chunks(batches, rows=1 << (64 - TOKEN_BITS)):
            n = part.num_rows
            row, token = shingle_sets(raw, off, s.words)
            size = np.bincount(row, minlength=n)
            doc = part.column("doc_id").to_numpy(zero_copy_only=False)
            yield from _rows(DOCUMENT, doc, doc, size, bitmaps(row, token, n))
            sums = np.zeros((2, n), np.uint64)
            np.add.at(sums[0], row, mix(token))
            np.add.at(sums[1], row, mix(token ^ BASE))
            fresh, links = np.zeros(n, bool), []
            for i in np.flatnonzero(size).tolist():
                key = (int(size[i]), int(sums[0, i]), int(sums[1, i]))
                leader = seen.setdefault(key, int(doc[i]))
                fresh[i] = leader == doc[i]
                if not fresh[i]:
                    links.append((leader, int(doc[i])))
            if links:
                a, b = np.array(links, np.int64).T
                yield from _rows(LINK, a, a, b)
            keep = fresh[row]
            rank = np.cumsum(fresh) - 1
            row, token, doc = rank[row[keep]], token[keep], doc[fresh]
            if len(doc):
                band = bands.of(size[fresh])
                for up in (0, 1):
                    r, sig = signatures(row, token, band, bands, up)
                    sigs.append(sig)
                    ids.append(doc[r])
        if sigs:
            sig, doc = np.concatenate(sigs), np.concatenate(ids)
            del sigs, ids
            order = np.argsort(sig, kind="stable")
            sig, doc = sig[order], doc[order]
            first = np.ones(len(sig), bool)
            first[1:] = sig[1:] != sig[:-1]
            leader = doc[np.maximum.accumulate(np.where(first, np.arange(len(sig)), 0))]
            yield from _rows(SIGNATURE, sig[first], doc[first], None)
            pair = ~first & (leader != doc)
            yield from _rows(PAIR, sig[pair], leader[pair], doc[pair])

    return run


def _lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Signatures, sorted, to pairs of a bucket's first member with each other
    one; other rows pass."""
    key0, leader0 = None, None
    for batch in batches:
        kind = batch.column("kind").to_numpy()
        if (other := np.flatnonzero(kind != SIGNATURE)).size:
            yield batch.take(pa.array(other))
        at = np.flatnonzero(kind == SIGNATURE)
        if not at.size:
            continue
        key, doc = batch.column("key").to_numpy()[at], batch.column("a").to_numpy()[at]
        first = np.ones(len(key), bool)
        first[1:] = key[1:] != key[:-1]
        leader = doc[np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))]
        if key[0] == key0:
            same = key == key0
            leader[same], first[0] = leader0, False
        key0, leader0 = key[-1], leader[-1]
        pair = ~first & (leader != doc)
        yield from _rows(PAIR, key[pair], leader[pair], doc[pair])


# --- exact verification -------------------------------------------------------------------


def _elements(s: Similarity):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, raw, off in text_chunks(batches, rows=1 << (64 - TOKEN_BITS)):
            row, token = shingle_sets(raw, off, s.words)
            ends = np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends), pa.array(token.view(np.int64)))], names=["doc_id", "elements"]
            )

    return run


def _sets(texts: DataFrame, s: Similarity) -> DataFrame:
    return texts.mapInArrow(_elements(s), "doc_id long, elements array<long>")


def _ids(pairs: DataFrame) -> DataFrame:
    """The documents of the pairs (a, b), to be joined by a plain shuffle at
    every size: the ids grow with the corpus."""
    return pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct().hint("merge")


def plausible(pairs: DataFrame, documents: DataFrame, s: Similarity) -> DataFrame:
    """The pairs (a, b) that sizes and bitmaps cannot rule out: linked sets
    differ in at most ``most_different`` elements, bitmaps in no more bits."""
    facts = lambda x: documents.select(F.col("a").alias(x), F.col("b").alias(f"n_{x}"), F.col("bitmap").alias(f"bits_{x}"))
    both = pairs.join(facts("a"), "a").join(facts("b"), "b")
    # Sizes that can link have bitmaps of equal width, or one of twice the other's.
    width = F.least(F.size("bits_a"), F.size("bits_b"))
    xor = lambda x, y: x.bitwiseXOR(y)
    folded = lambda c: F.when(F.size(c) <= width, F.col(c)).otherwise(F.zip_with(F.slice(c, 1, width), F.slice(c, width + 1, width), xor))
    odd = F.zip_with(folded("bits_a"), folded("bits_b"), lambda x, y: F.bit_count(xor(x, y)))
    apart = F.aggregate(odd, F.lit(0), lambda acc, n: acc + n)
    near = 100 * F.least("n_a", "n_b") >= s.percent * F.greatest("n_a", "n_b")
    return both.where(near & ((100 + s.percent) * apart <= (100 - s.percent) * (F.col("n_a") + F.col("n_b")))).select("a", "b").distinct()


def verified(pairs: DataFrame, sets: DataFrame, s: Similarity) -> DataFrame:
    """The pairs (a, b) whose sets link, by exact intersection."""
    named = lambda x: sets.select(F.col("doc_id").alias(x), F.col("elements").alias(f"set_{x}"))
    both = pairs.join(named("a"), "a").join(named("b"), "b")
    common = F.size(F.array_intersect("set_a", "set_b"))
    return both.withColumn("common", common).where(
        100 * F.col("common") >= s.percent * (F.size("set_a") + F.size("set_b") - F.col("common"))
    ).select("a", "b")


def _plausible_rows(rows: dict, root: np.ndarray, s: Similarity) -> Iterator[tuple[int, np.ndarray]]:
    """(row, its partners in other components) in a block pair, of those that
    size and bitmap cannot rule out and that were not refuted.  ``root`` names
    the components and may be changed by the caller on the way."""
    left, right = (np.flatnonzero(rows["side"] == x) for x in (0, 1))
    alone = not right.size
    right = left if alone else right
    n, width, refuted = rows["n"], rows["width"], rows["refuted"]
    # The bitmaps of one width are the rows of a matrix.
    slot, bits = np.zeros(len(n), np.int64), {}
    for w in np.unique(width).tolist():
        which = np.flatnonzero(width == w)
        slot[which] = np.arange(len(which))
        bits[w] = rows["words"][rows["base"][which][:, None] + np.arange(w)]
    for i in left.tolist():
        to = right[right > i] if alone else right
        to = to[100 * np.minimum(n[to], n[i]) >= s.percent * np.maximum(n[to], n[i])]
        own, w = bits[int(width[i])][slot[i]], int(width[i])
        for other in (w // 2, w, 2 * w):
            some = to[(width[to] == other) & (root[to] != root[i])]
            if some.size:
                theirs = bits[other][slot[some]]
                apart = (fold(theirs) if other > w else theirs) ^ (fold(own) if other < w else own)
                apart = np.bitwise_count(apart).sum(axis=1, dtype=np.int64)
                some = some[apart * (100 + s.percent) <= (100 - s.percent) * (n[some] + n[i])]
                if i in refuted:
                    some = some[~np.isin(some, refuted[i])]
                if some.size:
                    yield i, some


def _joined(root: np.ndarray, i: int, some: np.ndarray) -> np.ndarray:
    """One of ``some`` for each component among them, all of which become the
    component of row ``i``."""
    got, first = np.unique(root[some], return_index=True)
    root[np.isin(root, got)] = root[i]
    return some[first]


def _bits_of(t: pa.Table) -> dict:
    """The rows of a block pair with bitmaps, as arrays."""
    rows = {c: t.column(c).to_numpy() for c in ("side", "n", "component", "doc")}
    words_ = t.column("bitmap").combine_chunks()
    off = words_.offsets.to_numpy()
    rows |= {"words": words_.values.to_numpy(), "base": off[:-1].astype(np.int64), "width": np.diff(off), "refuted": {}}
    known = t.column("refuted").to_pylist()
    if any(known):
        at: dict[int, list[int]] = {}
        for i, x in enumerate(rows["doc"].tolist()):
            at.setdefault(x, []).append(i)
        for i, others in enumerate(known):
            for j in (j for x in others or () for j in at.get(x, ())):
                rows["refuted"].setdefault(i, []).append(j)
                rows["refuted"].setdefault(j, []).append(i)
    return rows


def _forest(s: Similarity):
    """Of a block pair the least pairs that would join its components as far
    as bitmaps allow: fewer than it has rows."""

    def solve(key: tuple, t: pa.Table) -> Iterator[pa.RecordBatch]:
        rows = _bits_of(t)
        root, doc = rows["component"].copy(), rows["doc"]
        a, b = [], []
        for i, some in _plausible_rows(rows, root, s):
            to = doc[_joined(root, i, some)]
            a.append(np.minimum(to, doc[i]))
            b.append(np.maximum(to, doc[i]))
        if a:
            a, b = np.concatenate(a), np.concatenate(b)
            yield pa.RecordBatch.from_arrays([*[pa.array(np.full(len(a), k)) for k in key], pa.array(a), pa.array(b)], names=["key", "i", "j", "a", "b"])

    return _by_block(solve)


def _involved(s: Similarity):
    """The members of a block pair that have a plausible partner there."""

    def solve(key: tuple, t: pa.Table) -> Iterator[pa.RecordBatch]:
        rows = _bits_of(t)
        has = np.zeros(len(rows["doc"]), bool)
        for i, some in _plausible_rows(rows, rows["component"], s):
            has[i] = has[some] = True
        doc = np.unique(rows["doc"][has])
        if len(doc):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(doc), key[0])), pa.array(doc)], names=["key", "doc"])

    return _by_block(solve)


def _exact(s: Similarity):
    """Links that join the components of a block pair, from its sets."""

    def solve(key: tuple, t: pa.Table) -> Iterator[pa.RecordBatch]:
        side, doc, root = (t.column(c).to_numpy() for c in ("side", "doc", "component"))
        sets = t.column("elements").combine_chunks()
        off = sets.offsets.to_numpy().astype(np.int64)
        token = np.unique(sets.values.to_numpy(), return_inverse=True)[1]
        n, root, mine = np.diff(off), root.copy(), np.zeros(len(token), bool)
        left, right = (np.flatnonzero(side == x) for x in (0, 1))
        alone = not right.size
        right = left if alone else right
        a, b = [], []
        for i in left.tolist():
            to = right[right > i] if alone else right
            to = to[(root[to] != root[i]) & (100 * np.minimum(n[to], n[i]) >= s.percent * np.maximum(n[to], n[i]))]
            if not to.size:
                continue
            own = token[off[i] : off[i + 1]]
            mine[own] = True
            common = np.array([np.count_nonzero(mine[token[off[x] : off[x + 1]]]) for x in to.tolist()])
            mine[own] = False
            to = to[100 * common >= s.percent * (n[to] + n[i] - common)]
            if to.size:
                to = doc[_joined(root, i, to)]
                a.append(np.minimum(to, doc[i]))
                b.append(np.maximum(to, doc[i]))
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    return _by_block(solve)


def _by_block(solve):
    """``solve`` of each block pair's rows, which come sorted by it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                yield from solve(last, pa.Table.from_batches(held))
                held.clear()

        for batch in batches:
            key = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("key", "i", "j")])
            cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            for x, y in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                if x < y:
                    this = tuple(key[:, x].tolist())
                    if this != last:
                        yield from flush()
                        last = this
                    held.append(batch.slice(x, y - x))
        yield from flush()
        release_memory()

    return run


def _placed(pairs: DataFrame, comp: DataFrame) -> DataFrame:
    """``pairs`` with the component of each side, itself where it has none."""
    named = lambda x: comp.select(F.col("node").alias(x), F.col("component").alias(f"in_{x}"))
    placed = pairs.join(named("a"), "a", "left").join(named("b"), "b", "left")
    return placed.withColumn("in_a", F.coalesce("in_a", "a")).withColumn("in_b", F.coalesce("in_b", "b"))


def _as_links(comp: DataFrame) -> DataFrame:
    return comp.select(F.col("node").alias("a"), F.col("component").alias("b"))


def _across_components(pairs: DataFrame, comp: DataFrame) -> DataFrame:
    return _placed(pairs, comp).where("in_a <> in_b")


def _open_members(pairs: DataFrame, comp: DataFrame) -> DataFrame | None:
    """(key, doc) of the buckets that are not within one component.  A bucket
    of two has no pair but the one with its leader."""
    busy = stored(pairs.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "busy-buckets")
    pairs = pairs.join(busy, "key", "left_semi")
    placed = stored(_placed(pairs, comp), "placed-pairs")
    open_ = stored(placed.where("in_a <> in_b").select("key").distinct(), "open-buckets")
    if open_.isEmpty():
        return None
    inside = placed.join(open_, "key", "left_semi")
    sides = inside.select("key", F.col("a").alias("doc")).unionByName(inside.select("key", F.col("b").alias("doc")))
    return stored(sides.distinct(), "members")


def _dealt(members: DataFrame, elements: int) -> DataFrame:
    """(key, i, j, side, doc): the members (key, doc, n) in pairs of blocks of
    about ``BLOCK`` members, and about ``elements`` elements, at most."""
    count = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n") / elements))
    blocks = stored(members.groupBy("key").agg(count.cast("int").alias("blocks")), "blocks")
    dealt = members.join(blocks, "key").withColumn("own", F.pmod(F.xxhash64("doc"), "blocks").cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return dealt.select(
        "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("side"), "doc",
    )


def _in_blocks(dealt: DataFrame, comp: DataFrame) -> DataFrame:
    """The rows of the blocks with their components, block by block."""
    placed = dealt.join(comp.withColumnRenamed("node", "doc"), "doc", "left").withColumn("component", F.coalesce("component", "doc"))
    return placed.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")


def _compared(dealt: DataFrame, facts: DataFrame, comp: DataFrame, refuted: DataFrame | None) -> DataFrame:
    """The blocks with bitmaps and the pairs (key, i, j, a, b) that were
    refuted in them."""
    rows = dealt.join(facts, "doc")
    if refuted is None:
        rows = rows.withColumn("refuted", F.lit(None).cast("array<long>"))
    else:
        lists = refuted.groupBy("key", "i", "j", F.col("b").alias("doc")).agg(F.collect_set("a").alias("refuted"))
        rows = rows.join(lists, ["key", "i", "j", "doc"], "left")
    return _in_blocks(rows, comp)


def _last_links(dealt: DataFrame, facts: DataFrame, comp: DataFrame, refuted: DataFrame, sets_of, s: Similarity) -> DataFrame:
    """The links that still join components of open blocks: members with a
    plausible partner meet again with their sets, compared inside the task."""
    some = _compared(dealt, facts, comp, refuted).mapInArrow(_involved(s), "key long, doc long")
    some = stored(some.distinct(), "involved")
    sizes = facts.groupBy("doc").agg(F.sum("n").alias("n"))
    blocks = _dealt(some.join(sizes, "doc"), SET_ELEMENTS)
    rows = blocks.join(sets_of(some.select(F.col("doc").alias("doc_id")).distinct().hint("merge")).withColumnRenamed("doc_id", "doc"), "doc")
    return _in_blocks(rows, comp).mapInArrow(_exact(s), "a long, b long").distinct()


def similar_sets(docs: DataFrame, s: Similarity = Similarity(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document.

    Null or empty text, and text without words, has an empty set and no link.
    Repeated rows of an id count as one node, with the links of each; a row
    without an id has no links and no component.
    """
    spark = docs.sparkSession
    texts = keyed_text(docs, id_col, text_col)
    named = texts.where(F.col("doc_id").isNotNull())
    bands = plan_bands(named, s)
    path = scratch_path(spark, "similar")
    (
        named.mapInArrow(_propose(s, bands), ROWS)
        .repartition("key")
        .sortWithinPartitions("key", "a")
        .mapInArrow(_lead, ROWS)
        .write.partitionBy("kind")
        .parquet(path)
    )
    rows = spark.read.schema(ROWS).parquet(path)
    documents, sure, proposed = (rows.where(F.col("kind") == k) for k in (DOCUMENT, LINK, PAIR))
    proposed = proposed.select("key", "a", "b")
    word = lambda i: F.conv(F.hex(F.substring("bitmap", 4 * i + 1, F.lit(4))), 16, 10).cast("long")
    words_ = F.transform(F.sequence(F.lit(0), (F.octet_length("bitmap") / 4 - 1).cast("int")), word)
    documents = stored(documents.select("a", "b", words_.alias("bitmap")), "documents")
    led = proposed.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    near = stored(plausible(led, documents, s), "pairs")
    # One pair for each member first; most others then lie within a component.
    tried = stored(near.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "first-pairs")
    used = _ids(near)
    sets_of = lambda ids: _sets(named.join(ids, "doc_id", "left_semi"), s)
    sets = stored(sets_of(used), "sets")
    links = stored(sure.select("a", "b").unionByName(verified(tried, sets, s)), "links")
    comp = stored(components(links), "components")
    facts = documents.select(F.col("a").alias("doc"), F.col("b").alias("n"), "bitmap").distinct()
    more, refuted, blocks = _across_components(near, comp).select("a", "b"), None, None
    if (members := _open_members(proposed, comp)) is not None:
        sizes = documents.groupBy(F.col("a").alias("doc")).agg(F.sum("b").alias("n"))
        blocks = stored(_dealt(members.join(sizes, "doc"), BITMAP_ELEMENTS), "dealt")
    for _ in range(FOREST_ROUNDS):
        if blocks is not None:
            forest = stored(_compared(blocks, facts, comp, refuted).mapInArrow(_forest(s), "key long, i long, j long, a long, b long"), "forest")
            refuted = forest if refuted is None else refuted.unionByName(forest)
            more = more.unionByName(forest.select("a", "b"))
        more = stored(more.distinct().join(tried, ["a", "b"], "left_anti"), "late-pairs")
        # Members of open buckets may be near each other and not near any leader.
        others = stored(_ids(more).join(used, "doc_id", "left_anti"), "more-ids")
        used = used.unionByName(others)
        sets = sets.unionByName(stored(sets_of(others), "more-sets"))
        late = stored(verified(more, sets, s), "late-links")
        comp = stored(components(_as_links(comp).unionByName(late)), "components")
        if blocks is None:
            break
        # A block is done unless a pair that would join two of its components failed.
        left = stored(_across_components(forest, comp).select("key", "i", "j").distinct(), "open-blocks")
        if left.isEmpty():
            blocks = None
            break
        blocks = blocks.join(left, ["key", "i", "j"], "left_semi")
        tried, more = tried.unionByName(more), more.limit(0)
    if blocks is not None:
        last = stored(_last_links(blocks, facts, comp, refuted, sets_of, s), "last-links")
        comp = stored(components(_as_links(comp).unionByName(last)), "components")
    sized = documents.select(F.col("a").alias("doc_id"), F.col("b").alias("n_shingles"))
    out = sized.join(comp.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    out = out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    return out.unionByName(_nameless(texts, s))


def _nameless(texts: DataFrame, s: Similarity) -> DataFrame:
    sets = _sets(texts.where(F.col("doc_id").isNull()), s)
    return sets.select("doc_id", F.size("elements").cast("long").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"))


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_sets(table(spark, sf_dir, "documents"), Similarity(words=3, percent=90))
