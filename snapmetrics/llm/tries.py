"""The prefix trie of conversations by vertical bitmaps.

Conversations are dealt into shards of ``1 << SHARD_BITS`` neighbouring ids.
A shard indexes each (position, turn) to the set of its conversations, one bit
each; intersecting a node's set with the postings of the next position, depth
first, yields its children, their counts and the conversations that end there.
Only turn digests and sizes travel, never texts.

Nodes of several shards are the same if their path digests are.  A node of one
shard has its whole subtree there, so the shard's own figures hold.  The nodes
that shards share form the top of the trie: their members add up, and their
subtree sums come from pointer jumping, in as many rounds as the depth has
bits.  Where a shared node's members end, the shards' lists of ids are hashed
in order of their shards, one list at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapmetrics.llm.common import stored, table

#: A shard holds the conversations whose ids agree but for so many low bits.
SHARD_BITS = 10
#: In the query, conversation c takes its first turns from c - c % GROUP, as
#: many as the CRC of its id leaves modulo HEADS.
GROUP, HEADS = 5, 9

ROOT = b""
NODES = (
    "path binary, parent binary, depth long, n_convs long, conv_id long, parent_conv_id long, bytes long, "
    "n_children long, n_leaves long, saved_tokens long, ends string, shard long"
)
_SCHEMA = pa.schema(
    [("path", pa.binary()), ("parent", pa.binary())]
    + [(c, pa.int64()) for c in ("depth", "n_convs", "conv_id", "parent_conv_id", "bytes", "n_children", "n_leaves", "saved_tokens")]
    + [("ends", pa.string()), ("shard", pa.int64())]
)
RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def ordered_turns(convs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, position from 1, token, bytes): each conversation's turns in
    order, null turn first, ties by the token, a digest of role and text.
    Null role and text are empty; rows without a conversation are left out."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    role, body = text(role_col), text(text_col)
    content = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, body)
    token = F.substring(F.unhex(F.sha2(content, 256)), 1, F.lit(16))
    light = convs.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), token.alias("token"), F.octet_length(body).cast("long").alias("bytes")
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "token")
    return light.select("conv_id", F.row_number().over(order).cast("long").alias("position"), "token", "bytes")


def rebuilt(turns: DataFrame) -> DataFrame:
    """Each conversation c anew: the first h turns of c - c % GROUP, then its
    own after its first h, with h = crc32(c) % HEADS.  A conversation without
    any turn left is one row of position 0."""
    base = F.col("conv_id") - F.col("conv_id") % GROUP
    h = F.crc32(F.col("conv_id").cast("string")) % HEADS
    ids = turns.where("position = 1").select("conv_id", base.alias("base"), h.alias("h"))
    heads = turns.where(F.col("position") < HEADS).withColumnRenamed("conv_id", "base")
    first = ids.where("conv_id <> base").join(heads, "base").where("position <= h").select("conv_id", "position", "token", "bytes")
    known = heads.groupBy("base").agg(F.count(F.lit(1)).alias("known"))
    placed = turns.withColumns({"base": base, "h": h}).join(known, "base", "left")
    place = F.least("h", F.coalesce("known", F.lit(0))) + F.col("position") - F.col("h")
    own = placed.where("conv_id = base OR position > h").select(
        "conv_id", F.when(F.col("conv_id") == F.col("base"), F.col("position")).otherwise(place).alias("position"), "token", "bytes"
    )
    none = ids.select("conv_id", F.lit(0).cast("long").alias("position"), F.lit(None).cast("binary").alias("token"), F.lit(0).cast("long").alias("bytes"))
    return first.unionByName(own).unionByName(none)


# --- a shard ------------------------------------------------------------------------------


def _bits(x: int) -> list[int]:
    """Places of the set bits, ascending."""
    raw = np.frombuffer(x.to_bytes((x.bit_length() + 7) // 8, "little"), np.uint8)
    return np.flatnonzero(np.unpackbits(raw, bitorder="little")).tolist()


class Bitmaps:
    """The vertical index of a shard: (position, turn) to a bitset of its
    conversations, and the conversations long enough for each position."""

    def __init__(self, conv: np.ndarray, position: np.ndarray, token: list, size: np.ndarray):
        self.ids, index = np.unique(conv, return_inverse=True)
        self.turns: list[list[bytes]] = [[] for _ in self.ids]
        self.postings: dict[tuple[int, bytes], int] = {}
        self.reach: list[int] = [(1 << len(self.ids)) - 1]
        self.size: dict[bytes, int] = {}
        for k in np.lexsort((position, index)).tolist():
            if position[k]:
                i, t = int(index[k]), token[k]
                self.turns[i].append(t)
                p = len(self.turns[i])
                if p == len(self.reach):
                    self.reach.append(0)
                self.reach[p] |= 1 << i
                self.postings[p, t] = self.postings.get((p, t), 0) | 1 << i
                self.size[t] = int(size[k])
        self.reach.append(0)

    def children(self, members: int, depth: int) -> Iterator[tuple[bytes, int]]:
        """(turn, members) of the children of a node."""
        rest = members & self.reach[depth + 1]
        while rest:
            turn = self.turns[(rest & -rest).bit_length() - 1][depth]
            child = rest & self.postings[depth + 1, turn]
            rest ^= child
            yield turn, child


def shard_nodes(b: Bitmaps) -> dict[str, list]:
    """The nodes of a shard, parents before their children."""
    out: dict[str, list] = {f.name: [] for f in _SCHEMA if f.name != "shard"}
    up: list[int] = []
    todo = [(ROOT, None, 0, b.reach[0], 0, -1)]
    while todo:
        path, parent, depth, members, size, above = todo.pop()
        me = len(up)
        up.append(above)
        ends = members & ~b.reach[depth + 1]
        n = members.bit_count()
        least = int(b.ids[(members & -members).bit_length() - 1])
        values = (path, parent, depth, n, least, out["conv_id"][above] if above >= 0 else None, size, 0, 0, (n - 1) * size,
                  ",".join([str(b.ids[i]) for i in _bits(ends)]) if ends else None)
        for column, value in zip(out.values(), values, strict=True):
            column.append(value)
        for turn, child in b.children(members, depth):
            key = hashlib.blake2b(path + turn, digest_size=16).digest()
            todo.append((key, path, depth + 1, child, b.size[turn], me))
    children, leaves, saved = out["n_children"], out["n_leaves"], out["saved_tokens"]
    for i in range(len(up) - 1, -1, -1):
        if not children[i]:
            leaves[i] = 1
        if (above := up[i]) >= 0:
            children[above] += 1
            leaves[above] += leaves[i]
            saved[above] += saved[i]
    return out


def _shard(rows: pa.Table) -> pa.Table:
    conv, position, size = (rows.column(c).to_numpy() for c in ("conv_id", "position", "bytes"))
    out = shard_nodes(Bitmaps(conv, position, rows.column("token").to_pylist(), size))
    out["shard"] = [int(conv[0]) >> SHARD_BITS] * len(out["path"])
    return pa.table(out, schema=_SCHEMA)


# --- shards together ---------------------------------------------------------------------------


def _hash_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each path's lists, joined by commas, as they come."""
    last, h = None, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([last], pa.binary()), pa.array([h.hexdigest()])], names=["path", "ends_sha256"])

    for batch in batches:
        for path, ends in zip(batch.column("path").to_pylist(), batch.column("ends").to_pylist(), strict=True):
            if path != last:
                if h is not None:
                    yield done()
                last, h = path, hashlib.sha256()
            else:
                h.update(b",")
            h.update(ends.encode())
    if h is not None:
        yield done()


def _summed(top: DataFrame) -> DataFrame:
    """(path, n_leaves, saved_tokens) with the sums over each subtree of
    ``top`` (path, parent, depth, own figures).  After round k a node holds
    the sums of all nodes less than 2^k below it and points 2^k up."""
    state = top.select("path", F.col("parent").alias("up"), "n_leaves", "saved_tokens")
    depth = top.agg(F.max("depth")).first()[0] or 0
    for _ in range(int(depth).bit_length()):
        below = state.where("up IS NOT NULL").groupBy(F.col("up").alias("path")).agg(
            F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved")
        )
        jump = state.select(F.col("path").alias("up"), F.col("up").alias("next"))
        state = state.join(below, "path", "left").join(jump, "up", "left")
        state = stored(
            state.select(
                "path",
                F.col("next").alias("up"),
                (F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
                (F.col("saved_tokens") + F.coalesce("more_saved", F.lit(0))).alias("saved_tokens"),
            ),
            "trie-sums",
        )
    return state.drop("up")


def trie(turns: DataFrame) -> DataFrame:
    """The nodes of the trie of ``turns`` (conv_id, position, token, bytes):
    ``RESULT``, and the digests ``path`` and ``parent``.

    Positions count from 1; a conversation without turns is one row of
    position 0 and a member of the root alone.  A shard holds the digests of
    its conversations' turns.  Without conversations there is no node.
    """
    sharded = turns.withColumn("shard", F.shiftright("conv_id", SHARD_BITS))
    nodes = stored(sharded.groupBy("shard").applyInArrow(_shard, NODES), "shard-nodes")
    first = lambda c: F.min(c).alias(c)
    met = nodes.groupBy("path").agg(
        first("parent"), first("depth"), F.sum("n_convs").alias("n_convs"), first("conv_id"), first("bytes"), F.count(F.lit(1)).alias("shards")
    )
    shared = stored(met.where("shards > 1").drop("shards"), "shared-nodes")
    # Nodes of one shard, with the least member of a parent in several.
    above = shared.select(F.col("path").alias("parent"), F.col("conv_id").alias("above"))
    own = stored(nodes.join(shared.select("path"), "path", "left_anti").join(above, "parent", "left"), "own-nodes")
    one = own.select(
        "conv_id", "depth", F.coalesce("above", "parent_conv_id").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.sha2(F.coalesce("ends", F.lit("")).cast("binary"), 256).alias("ends_sha256"), "path", "parent",
    )
    hung = own.where("above IS NOT NULL").groupBy(F.col("parent").alias("path")).agg(
        F.count(F.lit(1)).alias("hung"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")
    )
    inner = shared.groupBy(F.col("parent").alias("path")).agg(F.count(F.lit(1)).alias("inner"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    top = shared.join(hung, "path", "left").join(inner, "path", "left")
    top = top.select(
        "path", "parent", "depth", "n_convs", "conv_id", (zero("hung") + zero("inner")).alias("n_children"),
        (zero("leaves") + F.when(zero("hung") + zero("inner") == 0, 1).otherwise(0)).alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("bytes") + zero("saved")).alias("saved_tokens"),
    )
    top = stored(top, "top-nodes")
    lists = nodes.where("ends IS NOT NULL").join(shared.select("path"), "path", "left_semi").select("path", "shard", "ends")
    ends = lists.repartition("path").sortWithinPartitions("path", "shard").mapInArrow(_hash_lists, "path binary, ends_sha256 string")
    parents = shared.select(F.col("path").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    many = top.drop("n_leaves", "saved_tokens").join(_summed(top), "path").join(parents, "parent", "left").join(ends, "path", "left")
    many = many.withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)))
    return one.unionByName(many.select(*one.columns))


def conversation_trie(convs: DataFrame, **columns: str) -> DataFrame:
    """The trie of conversations as they are (rows of one turn each; column
    names as for ``ordered_turns``).  Other columns are ignored; repeated
    rows are turns of their own."""
    return trie(ordered_turns(convs, **columns))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(rebuilt(ordered_turns(table(spark, sf_dir, "conversations")))).select(*RESULT)
