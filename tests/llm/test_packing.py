import random
import zlib
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from snapmetrics.llm import packing as P
from snapmetrics.llm import tokens


@cache
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_ids_are_the_librarys(odd_rows):
    rng = random.Random(2)
    texts = [t for _, t in odd_rows if t] + ["".join(rng.choice("ab Z'st\n\t09éßİſΣ!?.\xa0’…́漢😀") for _ in range(40)) for _ in range(500)]
    for t in texts:
        assert tokens.encode(t).tolist() == library().encode(t, add_special_tokens=False).ids


def test_pack_odd_documents(odd_docs, odd_rows, no_docs, nameless_docs):
    rows = P.pack(odd_docs).collect()
    want = Counter()
    for i, t in odd_rows:
        ids = np.array([*library().encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for k, n in enumerate(P.cut(len(ids), 1024)):
            want[i, k, at, n, zlib.crc32(ids[at : at + n].tobytes())] += 1
            at += n
        assert at == len(ids)
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for spans in places.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at <= 1024
    assert len(places) <= -(-sum(r.length for r in rows) // 1024) + 1
    assert P.pack(no_docs).count() == 0
    assert sorted(r.doc_id or 0 for r in P.pack(nameless_docs).collect()) == [0, 0, 1]


def test_cut():
    assert P.cut(5, 8) == [5] and P.cut(8, 8) == [8] and P.cut(19, 8) == [3, 8, 8] and P.cut(16, 8) == [8, 8]


def least_bins(items, size):
    """Exact number of bins, by trying every place for the largest item."""

    @cache
    def need(rest, rooms):
        if not rest:
            return 0
        x, best = rest[0], 10**6
        for room in sorted(set(rooms)):
            if room >= x:
                left = list(rooms)
                left.remove(room)
                best = min(best, need(rest[1:], tuple(sorted([*left, room - x]))))
        return min(best, 1 + need(rest[1:], tuple(sorted([*rooms, size - x]))))

    return need(tuple(sorted(items, reverse=True)), ())


@pytest.mark.parametrize("seed", range(60))
def test_fixed_sets_never_cost_a_bin(seed):
    rng = random.Random(seed)
    size = rng.choice([10, 17, 30])
    items = [rng.randint(1, size) for _ in range(rng.randint(1, 9))]
    fixed, rest = P.reduce_instance(Counter(items), size)
    used = Counter()
    for group, copies in fixed:
        assert sum(group) <= size
        for x in group:
            used[x] += copies
    assert used + Counter(rest) == Counter(items)
    left = [x for x, n in rest.items() for _ in range(n)]
    assert sum(c for _, c in fixed) + least_bins(left, size) == least_bins(items, size)


@pytest.mark.parametrize("seed", range(20))
def test_patterns_hold_every_item_once(seed):
    rng = random.Random(seed)
    counts = Counter(rng.randint(1, 1024) for _ in range(rng.choice([1, 50, 3000])))
    plan = P.patterns(counts, 1024)
    held = Counter()
    for group, copies in plan:
        assert sum(group) <= 1024 and copies > 0
        for x in group:
            held[x] += copies
    assert held == counts
    total = sum(k * n for k, n in counts.items())
    if len(counts) > 500:
        assert sum(c for _, c in plan) <= -(-total // 1024) * 1.01 + 1
    ranks = defaultdict(list)
    for length, lo, hi, *_ in P.slots(plan):
        ranks[length].append((lo, hi))
    for length, spans in ranks.items():
        assert [a for a, _ in sorted(spans)] == [0, *[b for _, b in sorted(spans)][:-1]] and max(b for _, b in spans) == counts[length]
