import base64
import hashlib
from collections import Counter, defaultdict

import public_tokenizers as P
import pyarrow as pa
import pytest

from snapmetrics.llm import alignment
from snapmetrics.llm.alignment import align, aligned, op12_alignment, written

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    slow.encode_special_tokens = True
    return slow, sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))


def brute(rows, libraries):
    """The contract, token by token, on (doc_id, text) rows."""
    slow, pieces = libraries
    ranks = {int(b): base64.b64decode(a) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    made, holds = [], defaultdict(int)
    for doc, text in rows:
        a, b, groups = [], [], []
        if text:
            a = slow.encode(" " + text, add_special_tokens=False).ids
            b = pieces.encode(text)
            of_a = [ranks[i] for i in a]
            name = [pieces.id_to_piece(i) for i in b]
            of_b = [bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, name)]
            if not b"".join(of_a) == b"".join(of_b) == (" " + text).encode():
                a, b = [], []
        if a:
            i = j = x = y = 0
            left, right = [], []
            while i < len(a) or j < len(b):
                if x <= y and i < len(a):
                    left.append(a[i])
                    x += len(of_a[i])
                    i += 1
                else:
                    right.append(b[j])
                    y += len(of_b[j])
                    j += 1
                if x == y:
                    groups.append((left, right))
                    left, right = [], []
        links = Counter((p, q) for g, h in groups for p in g for q in h)
        for pair in links:
            holds[pair] += 1
        made.append((doc, a, b, groups, links))
    best = defaultdict(int)
    for (p, _), n in holds.items():
        best[p] = max(best[p], n)
    out = []
    for doc, a, b, groups, links in made:
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        out.append((doc, len(a), len(b), len(groups), sum(links.values()),
                    sum(n for pair, n in links.items() if holds[pair] == best[pair[0]]),
                    sum(n * holds[pair] for pair, n in links.items()), text))
    return out


def _sorted(rows):
    return sorted(map(tuple, rows), key=str)


EXTRA = ["▁ a piece's own space", "  two  spaces ", "\n\n\ttabs\r\n", "<|endoftext|><s></s><unk><0x41>", "漢字かな 😀😀 Ünïcödé ﬁ ½", "é NFD", "\u0000nul", " "]


def test_matches_brute_force(spark, odd_rows, odd_docs, libraries):
    want = brute(odd_rows, libraries)
    assert _sorted(align(odd_docs).collect()) == _sorted(want)
    rows = list(enumerate(EXTRA)) + [(None, EXTRA[1]), (3, EXTRA[3]), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    want = brute(rows, libraries)
    assert want[0][1] == 0 and want[1][1] > 0 and want[3][1] > 0
    assert _sorted(align(docs).collect()) == _sorted(want)


def test_rare_pairs_are_joined_by_a_shuffle(spark, odd_rows, odd_docs, libraries, monkeypatch):
    monkeypatch.setattr(alignment, "FREQUENT", 20)
    monkeypatch.setattr(alignment, "CHUNK", 2000)
    monkeypatch.setattr(alignment, "HELD_PAIRS", 50)
    assert _sorted(align(odd_docs).collect()) == _sorted(brute(odd_rows, libraries))


def test_groups_of_hand_made_tokens():
    """A: ab|c|d, ef; B: a|b|cd, e|f over two documents and an empty one."""
    entries = pa.array([b"ab", b"c", b"d", b"ef", b"a", b"b", b"cd", b"e", b"f"], pa.large_binary())
    lists = lambda x: pa.array(x, pa.large_list(pa.int64()))
    a, b = lists([[0, 1, 2], [], [3, 3]]), lists([[4, 5, 6], [], [7, 8, 7, 8]])
    ids_a, ids_b, group_a, group_b, doc, held = aligned(a, b, entries, entries)
    assert (group_a.tolist(), group_b.tolist(), doc.tolist()) == ([0, 1, 1, 2, 3], [0, 0, 1, 2, 2, 3, 3], [0, 0, 2, 2])
    pairs = sorted((r["doc"], r["pair"] >> 24, r["pair"] & 0xFFFFFF, r["links"]) for r in held.to_pylist())
    assert pairs == [(0, 0, 4, 1), (0, 0, 5, 1), (0, 1, 6, 1), (0, 2, 6, 1), (2, 3, 7, 2), (2, 3, 8, 2)]
    text, at = written(ids_a, ids_b, group_a, group_b, doc, 3)
    assert [text[x : max(y - 1, x)].tobytes().decode() for x, y in zip(at, at[1:])] == ["0|4,5;1,2|6", "", "3|7,8;3|7,8"]


def test_threshold_bounds_the_broadcast(spark, monkeypatch):
    counts = spark.createDataFrame([(i, 1 + i // 10) for i in range(100)], "pair long, n long")
    for most in (0, 5, 30, 60, 1000):
        monkeypatch.setattr(alignment, "FREQUENT", most)
        least = alignment._threshold(counts)
        assert counts.where(f"n >= {least}").count() <= most
    assert alignment._threshold(counts.limit(0)) in (1, 2)


def test_empty_table(no_docs):
    assert align(no_docs).count() == 0


def test_query_on_the_given_table(spark, libraries):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest() if t else ""
    want = [(*r[:-1], sha(r[-1])) for r in brute([tuple(r) for r in docs], libraries)]
    got = op12_alignment(spark, SF001)
    assert got.columns[-1] == "groups_sha256"
    assert _sorted(got.collect()) == _sorted(want) and all(r[1] for r in want)
