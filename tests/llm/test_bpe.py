import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from snapmetrics.llm.bpe import Encoder, encode_documents, op8_bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    return Encoder(PATH)


def test_odd_texts_round_trip(own, library, odd_rows):
    rng = random.Random(1)
    alphabet = "abcXYZ'st \n\t0129éÉßİıſΣςσ!?.-_\xa0\x85\x1c’…́漢😀​"
    texts = [t or "" for _, t in odd_rows]
    texts += ["it's İstanbul ΣΑΣ don't<|endoftext|> x<|startoftext|>", "a\x1cb\x85c\xa0d ²³¼ ªº", "<|endof <||>", "'S 'T I'LL", "x" * 5000, "a1b2!?c3" * 300]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(1500)]
    for t in texts:
        ids = library.encode(t, add_special_tokens=False).ids
        assert own.encode(t) == (" ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False))


def test_forced_boundaries_are_in_no_token(own, library):
    value = {c: b for b, c in enumerate(own.letters)}
    assert len(set(own.letters)) == 256 and 0 < len(own.never) < 65536
    for token in library.get_vocab(with_added_tokens=False):
        body = [value[c] for c in token.removesuffix("</w>")]
        assert not any(pair in own.never for pair in zip(body, body[1:]))


def test_documents(odd_docs, odd_rows, no_docs, library):
    got = sorted((r.doc_id, r.ids) for r in encode_documents(odd_docs).collect())
    assert got == sorted((i, " ".join(map(str, library.encode(t or "", add_special_tokens=False).ids))) for i, t in odd_rows)
    assert encode_documents(no_docs).count() == 0


def test_query(spark):
    r = op8_bpe(spark, "/root/testdata/sf0.001").select("n_tokens").toPandas()
    assert len(r) == 200 and np.all(r.n_tokens >= 0)
