import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest

from snapmetrics.llm import tries
from snapmetrics.llm.oracle import ORACLE_SQL
from snapmetrics.llm.tries import RESULT, conversation_trie, op13_prefix_trie, ordered_turns, rebuilt, trie

SF001 = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, shard string, path string"


def originals(rows):
    convs = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            token = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            convs[c].append(((turn is not None, turn or 0, token[:32]), (role, text)))
    return {c: [x for _, x in sorted(t)] for c, t in convs.items()}


def rebuild(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def brute(convs):
    members = defaultdict(list)
    for c, turns in sorted(convs.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    sha = lambda m: hashlib.sha256(",".join(map(str, m)).encode()).hexdigest()
    return sorted(
        (m[0], len(p), members[p[:-1]][0] if p else None, len(m), children[p], leaves[p], saved[p], sha([c for c in m if len(convs[c]) == len(p)]))
        for p, m in members.items()
    )


def _rows(df):
    return sorted(map(tuple, df.select(*RESULT).collect()))


@pytest.fixture(scope="module")
def odd_convs():
    """Ids on both sides of zero and far apart, shared first turns, nulls,
    ties, repeated rows, a long conversation twice."""
    rng = random.Random(5)
    rows = []
    for c in [*range(-12, 40), 2**40 + 1, 2**40 + 3, -(2**63), 2**63 - 1]:
        for turn in range(rng.randint(1, 9)):
            rows.append((c, turn, "user" if turn % 2 == 0 else "assistant", rng.choice(["hi", "", "é漢", None, "so"]) if turn else "hello"))
    rows += [(100, None, None, None), (100, None, "a", "b"), (100, 3, "x", "y"), (100, 3, "x", "y"), (100, 3, "w", "z"), (None, 0, "user", "lost")]
    for c in (55, 2000):
        rows += [(c, i, "r", f"turn {i % 7}") for i in range(40)]
    # Without the conversation they begin with, and few turns: some have none left.
    rows += [(c, 0, "user", "hello") for c in (3001, 3002, 3003, 3004, 3006)]
    rng.shuffle(rows)
    return [(*r, "clash", None) for r in rows]


def test_rebuilt_conversations(spark, odd_convs):
    convs = rebuild(originals(odd_convs))
    assert any(not t for t in convs.values())
    got = rebuilt(ordered_turns(spark.createDataFrame(odd_convs, SCHEMA))).where("position > 0").collect()
    lengths = defaultdict(set)
    for r in got:
        lengths[r.conv_id].add(r.position)
    assert {c: sorted(p) for c, p in lengths.items()} == {c: list(range(1, len(t) + 1)) for c, t in convs.items() if t}


@pytest.mark.parametrize("bits", [0, 2, 10])
def test_matches_brute_force(spark, odd_convs, monkeypatch, bits):
    """With shards of 1, 4 and 1024 ids: all paths shared, some, almost none."""
    monkeypatch.setattr(tries, "SHARD_BITS", bits)
    convs = spark.createDataFrame(odd_convs, SCHEMA).repartition(3)
    assert _rows(conversation_trie(convs)) == brute(originals(odd_convs))
    assert _rows(trie(rebuilt(ordered_turns(convs)))) == brute(rebuild(originals(odd_convs)))


def test_one_conversation_many_times(spark, monkeypatch):
    """Every path is shared by every shard, and all members end together."""
    monkeypatch.setattr(tries, "SHARD_BITS", 1)
    rows = [(c, t, "u", "same") for c in range(30) for t in range(5)]
    got = _rows(conversation_trie(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    assert got == brute(originals(rows)) and len(got) == 6
    assert got[0][6] == 29 * 4 * 5


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert conversation_trie(empty).count() == 0
    assert trie(rebuilt(ordered_turns(empty))).count() == 0


def test_query_and_oracle_on_the_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = brute(rebuild(originals(rows)))
    assert _rows(op13_prefix_trie(spark, SF001)) == want
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF001}/conversations.parquet'")
    got = con.execute(f"SELECT {', '.join(RESULT)} FROM ({ORACLE_SQL['op13_prefix_trie']})").fetchall()
    assert sorted(got) == want
