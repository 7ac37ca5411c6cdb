"""Alignment of two tokenizers' tokens, and how well id pairs agree.

Texts are encoded by a byte-level vocabulary (A) and a piece vocabulary (B),
and each chunk of documents then goes through Arrow columns only: token lists
are flattened with their parent indices, byte lengths are summed up within
each document, and a hash join on (document, end) finds the byte offsets where
tokens of both end.  These cut the tokens into groups; a second join on the
group links the distinct ids of a group, each with its number of occurrence
pairs.

How many documents hold a linked pair of ids is counted by a grouped table in
each task and merged by Spark.  The documents' pairs then meet these counts:
the most frequent pairs, at most ``FREQUENT`` rows, are broadcast, so no hot
pair is shuffled; the others are joined by a shuffle.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmetrics.llm.bpe import byte_letters
from snapmetrics.llm.common import keyed_text, scratch_path, stored, table, text_chunks
from snapmetrics.llm.tokens import LATIN

BYTE_JSON, BYTE_RANKS, PIECE_MODEL = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"
#: Rows of the broadcast table of frequent pairs (17 bytes each).
FREQUENT = 1 << 17
#: Pairs that a task counts before it gives its counts away.
HELD_PAIRS = 1 << 20
#: Bytes of text in a chunk.
CHUNK = 1 << 20
#: An id pair is one number: A's id shifted by this, and B's.
ID_BITS = 24
#: Places of an end, within a key (document of the chunk, end).
END_BITS = 40

DOCUMENT, COUNT = range(2)
ROWS = (
    "kind int, row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, "
    "pairs array<struct<pair:long,links:long>>, pair long, n long"
)
_PAIRS = pa.list_(pa.struct([("pair", pa.int64()), ("links", pa.int64())]))
_SCHEMA = pa.schema(
    [("kind", pa.int32()), *((c, pa.int64()) for c in ("row", "doc_id", "n_a", "n_b", "n_groups", "n_links")),
     ("groups", pa.string()), ("pairs", _PAIRS), ("pair", pa.int64()), ("n", pa.int64())]
)


# --- tokens -----------------------------------------------------------------------------


@functools.cache
def byte_tokens(json_name: str, ranks_name: str):
    """(encode, bytes of each id) of a byte-level vocabulary; the strings of
    special tokens are ordinary text."""
    import base64

    import tiktoken
    from tokenizers import Tokenizer

    with open(public_tokenizers.path(json_name), encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    value = {c: b for b, c in enumerate(byte_letters())}
    entries = [b""] * (max(vocab.values()) + 1)
    for token, i in vocab.items():
        entries[i] = bytes([value[c] for c in token]) if all(c in value for c in token) else token.encode()
    with open(public_tokenizers.path(ranks_name), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("byte", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    slow = Tokenizer.from_file(public_tokenizers.path(json_name))
    slow.no_truncation()
    slow.no_padding()
    slow.encode_special_tokens = True

    def encode(text: str) -> np.ndarray:
        # Both libraries agree on the code points of ``LATIN``.
        if LATIN.fullmatch(text):
            return fast.encode_to_numpy(text, disallowed_special=()).astype(np.int64)
        return np.array(slow.encode(text, add_special_tokens=False).ids, np.int64)

    return encode, pa.array(entries, pa.large_binary())


@functools.cache
def piece_tokens(name: str):
    """(encode a list of texts, bytes of each id) of a piece vocabulary."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
    pieces = [model.id_to_piece(i) for i in range(model.vocab_size())]
    entries = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
    return lambda texts: [np.array(x, np.int64) for x in model.encode(texts, num_threads=1)], pa.array(entries, pa.large_binary())


def _lists(ids: list[np.ndarray]) -> pa.LargeListArray:
    off = np.cumsum([0, *map(len, ids)])
    return pa.LargeListArray.from_arrays(pa.array(off), pa.array(np.concatenate([np.zeros(0, np.int64), *ids])))


def _spelled(lists: pa.LargeListArray, entries: pa.LargeBinaryArray, want: list[bytes]) -> np.ndarray:
    """True for each document whose tokens' joined bytes are the wanted ones."""
    tokens = entries.take(lists.flatten())
    _, offsets, body = tokens.buffers()
    at = np.frombuffer(offsets, np.int64)[: len(tokens) + 1][np.asarray(lists.offsets)]
    body = memoryview(body if body is not None else b"").cast("B")
    return np.array([body[a:b] == w for a, b, w in zip(at[:-1].tolist(), at[1:].tolist(), want, strict=True)], bool)


# --- groups and links -------------------------------------------------------------------------


def _keys(lists: pa.LargeListArray, entries: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """(flat ids, key (document, end) of each token): a cumulative sum of the
    byte lengths, restarted at each document."""
    ids = lists.flatten()
    parent = lists.value_parent_indices()
    total = pc.cumulative_sum(pc.binary_length(entries.take(ids)))
    first = np.asarray(lists.offsets)[:-1]
    ends = np.asarray(total)
    before = np.concatenate([[0], ends])[first]
    end = pc.subtract(total, pa.array(before).take(parent))
    return np.asarray(ids), np.asarray(pc.add(pc.shift_left(parent.cast(pa.int64()), END_BITS), end))


def _distinct(group: np.ndarray, ids: np.ndarray, name: str) -> pa.Table:
    """(group, id, occurrences) of the distinct ids of each group."""
    t = pa.table({"of": (group << ID_BITS) + ids}).group_by("of", use_threads=False).aggregate([([], "count_all")])
    of = np.asarray(t["of"])
    return pa.table({"group": of >> ID_BITS, name: of & ((1 << ID_BITS) - 1), f"n_{name}": t["count_all"]})


def aligned(a: pa.LargeListArray, b: pa.LargeListArray, bytes_a: pa.LargeBinaryArray, bytes_b: pa.LargeBinaryArray):
    """(ids of A, ids of B, group of each A token, of each B token, document
    of each group, (document, pair, links)) of a chunk of documents whose A
    and B tokens spell the same bytes."""
    ids_a, key_a = _keys(a, bytes_a)
    ids_b, key_b = _keys(b, bytes_b)
    both = pa.table({"key": key_a}).join(pa.table({"key": key_b}), "key", join_type="inner", use_threads=False)
    cuts = np.sort(np.asarray(both["key"]))
    group_a, group_b = np.searchsorted(cuts, key_a), np.searchsorted(cuts, key_b)
    linked = _distinct(group_a, ids_a, "a").join(_distinct(group_b, ids_b, "b"), "group", join_type="inner", use_threads=False)
    doc = cuts >> END_BITS
    pair = np.asarray(pc.add(pc.shift_left(linked["a"], ID_BITS), linked["b"]))
    links = pc.multiply(linked["n_a"], linked["n_b"])
    held = pa.table({"doc": doc[np.asarray(linked["group"])], "pair": pair, "links": links})
    held = held.group_by(["doc", "pair"], use_threads=False).aggregate([("links", "sum")]).rename_columns(["doc", "pair", "links"])
    return ids_a, ids_b, group_a, group_b, doc, held


@functools.cache
def _decimals(most: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of 0..most, left-aligned in rows with a byte to spare."""
    width = len(str(most)) + 1
    text = [str(i).encode() for i in range(most + 1)]
    digits = np.frombuffer(b"".join(t.ljust(width) for t in text), np.uint8).reshape(-1, width)
    return digits, np.array([len(t) for t in text], np.int64)


def written(ids_a, ids_b, group_a, group_b, doc, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The groups as text, ``a1,a2|b1;a3|b2``, of all documents one after the
    other, and where each starts; every text ends with one sign too many."""
    m = len(doc)
    count_a, count_b = np.bincount(group_a, minlength=m), np.bincount(group_b, minlength=m)
    upto_a, upto_b = np.cumsum(count_a), np.cumsum(count_b)
    at_a = np.arange(len(ids_a)) + (upto_b - count_b)[group_a]
    at_b = np.arange(len(ids_b)) + upto_a[group_b]
    token, sign = np.empty(len(ids_a) + len(ids_b), np.int64), np.full(len(ids_a) + len(ids_b), ord(","), np.uint8)
    token[at_a], token[at_b] = ids_a, ids_b
    if m:
        sign[at_a[upto_a - 1]], sign[at_b[upto_b - 1]] = ord("|"), ord(";")
    digits, size = _decimals(int(token.max(initial=0)))
    size = size[token]
    rows = digits[token]
    rows[np.arange(len(token)), size] = sign
    text = rows[np.arange(digits.shape[1]) <= size[:, None]]
    ends = np.concatenate([[0], np.cumsum(size + 1)])
    tokens = np.bincount(doc, weights=count_a + count_b, minlength=n).astype(np.int64)
    return text, ends[np.concatenate([[0], np.cumsum(tokens)])]


def _table(size: int, kind: int, **columns) -> pa.RecordBatch:
    full = {"kind": pa.array(np.full(size, kind, np.int32))} | columns
    return pa.RecordBatch.from_arrays([full.get(f.name, pa.nulls(size, f.type)) for f in _SCHEMA], schema=_SCHEMA)


def _counted(tables: list[pa.Table]) -> pa.Table:
    t = pa.concat_tables(tables).group_by("pair", use_threads=False).aggregate([("n", "sum")])
    return t.rename_columns(["pair", "n"])


def _given(counts: pa.Table) -> Iterator[pa.RecordBatch]:
    for batch in counts.combine_chunks().to_batches(max_chunksize=1 << 18):
        yield _table(batch.num_rows, COUNT, pair=batch["pair"], n=batch["n"])


def _align(json_name: str, ranks_name: str, model_name: str, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_a, bytes_a = byte_tokens(json_name, ranks_name)
        encode_b, bytes_b = piece_tokens(model_name)
        counts: list[pa.Table] = []
        row = TaskContext.get().partitionId() << 40
        for part, _, _ in text_chunks(batches, CHUNK):
            texts = part.column("text").to_pylist()
            n = len(texts)
            want = [b" " + t.encode() if t else b"" for t in texts]
            ids = [[encode_a(" " + t) if t else np.zeros(0, np.int64) for t in texts], encode_b(texts)]
            lists = [_lists(x) for x in ids]
            good = _spelled(lists[0], bytes_a, want) & _spelled(lists[1], bytes_b, want)
            if not good.all():
                lists = [_lists([x if ok else x[:0] for x, ok in zip(side, good, strict=True)]) for side in ids]
            ids_a, ids_b, group_a, group_b, doc, held = aligned(*lists, bytes_a, bytes_b)
            text, at = written(ids_a, ids_b, group_a, group_b, doc, n)
            groups = [text[x : max(y - 1, x)].tobytes() for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            groups = [(hashlib.sha256(g).hexdigest() if digest else g.decode()) if g else "" for g in groups]
            held = held.sort_by("doc").combine_chunks()
            of, links = np.asarray(held["doc"]), np.asarray(held["links"])
            pairs = pa.StructArray.from_arrays([x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in (held["pair"], held["links"])], ["pair", "links"])
            pairs = pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(n + 1)).astype(np.int32)), pairs)
            n_links = np.zeros(n, np.int64)
            np.add.at(n_links, of, links)
            yield _table(
                n, DOCUMENT, row=pa.array(row + np.arange(n)), doc_id=part.column("doc_id"),
                n_a=pa.array(np.diff(np.asarray(lists[0].offsets))), n_b=pa.array(np.diff(np.asarray(lists[1].offsets))),
                n_groups=pa.array(np.bincount(doc, minlength=n)), n_links=pa.array(n_links), groups=pa.array(groups, pa.string()), pairs=pairs.cast(_PAIRS),
            )
            row += n
            # Each document holds a pair once.
            counts.append(_counted([pa.table({"pair": held["pair"], "n": np.ones(len(of), np.int64)})]))
            if sum(map(len, counts)) > HELD_PAIRS:
                counts = [_counted(counts)]
                if len(counts[0]) > HELD_PAIRS // 2:
                    yield from _given(counts.pop())
        if counts:
            yield from _given(_counted(counts))

    return run


# --- corpus-wide counts -----------------------------------------------------------------------


def _threshold(counts: DataFrame) -> int:
    """Least power of two such that at most ``FREQUENT`` pairs have a count of
    at least it, from a histogram with one row per power."""
    power = F.floor(F.log2(F.col("n").cast("double"))).cast("int")
    hist = {r.p: r.m for r in counts.groupBy(power.alias("p")).agg(F.count(F.lit(1)).alias("m")).collect()}
    least, above = max(hist, default=0) + 1, 0
    while least > 0 and above + hist.get(least - 1, 0) <= FREQUENT:
        least -= 1
        above += hist.get(least, 0)
    return 1 << least


def align(
    docs: DataFrame,
    json_name: str = BYTE_JSON,
    ranks_name: str = BYTE_RANKS,
    model_name: str = PIECE_MODEL,
    digest: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of
    every row of ``docs``.

    ``groups`` is the text of the groups, or its SHA-256 with ``digest``.
    Null and empty texts, and those whose tokens do not spell a space and the
    text, have zeros and an empty text.  Every row counts as a document of
    its own, also rows that share an id or have none.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "aligned")
    keyed_text(docs, id_col, text_col).mapInArrow(_align(json_name, ranks_name, model_name, digest), ROWS).write.partitionBy("kind").parquet(path)
    rows = spark.read.schema(ROWS).parquet(path)
    documents = rows.where(F.col("kind") == DOCUMENT)
    counts = stored(rows.where(F.col("kind") == COUNT).groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
    a: Column = F.shiftright("pair", ID_BITS)
    # One row per id of A's vocabulary.
    best = F.broadcast(counts.groupBy(a.alias("a")).agg(F.max("n").alias("most")))
    marked = counts.withColumn("a", a).join(best, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    least = _threshold(counts)
    links = documents.select("row", F.explode("pairs").alias("p")).select("row", "p.pair", "p.links")
    known = links.join(F.broadcast(marked.where(F.col("n") >= least)), "pair", "left")
    rare = known.where("n IS NULL").select("row", "pair", "links").join(marked.where(F.col("n") < least), "pair")
    linked = known.where("n IS NOT NULL").select("row", "links", "n", "best").unionByName(rare.select("row", "links", "n", "best"))
    sums = linked.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"), F.sum(F.col("links") * F.col("n")).alias("count_sum")
    )
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return documents.join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups"
    )


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"), digest=True).withColumnRenamed("groups", "groups_sha256")
