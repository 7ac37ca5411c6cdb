"""Small documents with every odd case, and brute-force versions of the
operators' contracts."""

import random

import pytest
from pyspark.sql import types as T

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
#: Names that clash with columns the operators use themselves.
CLASHES = ["key", "lost", "kept", "host", "base_failed", "component", "bucket", "found", "spans", "length", "shard"]
SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in CLASHES]
)


def odd_texts() -> list[str | None]:
    rng = random.Random(7)
    prose = lambda n: " ".join(rng.choice(WORDS) + str(rng.randint(0, 40)) for _ in range(n))
    base, passage = prose(150), prose(60)
    near = base.split()
    near[70] = "changed"
    out: list[str | None] = [
        None, "", " \t\n\x0b\r ", "one", "one two", "ONE Two", base, base, " ".join(near), base.upper(), "x" * 30_000, "spam " * 3_000,
        prose(20) + "\n" + passage + "\n" + prose(20), prose(25) + "\n" + passage + "\n" + prose(15), passage,
        "a shared line here\nother words of one\nA SHARED line HERE  \n\nshort\nshort",
        "  a shared line here\nshort\nanother line of text", "\n\n\n", "é漢😀 " * 40 + "\nΣίγμα 漢字かな交じり文のテスト",
        "mail joe.doe+x@mail.example.com or 10.20.30.40, 999.1.1.1; card 4111 1111 1111 1111 call +1 (555) 555-0123 now",
        "<|endoftext|> and <|startoftext|> inside", "1 2 3 4 5 " * 50, "\x00\x01 nul \x00 bytes " * 10,
    ]
    out += [prose(rng.randint(1, 80)) for _ in range(25)]
    return out


@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text): ids out of order, one row repeated."""
    texts = odd_texts()
    ids = [(i * 37) % 101 for i in range(len(texts))]
    rows = list(zip(ids, texts))
    return rows + [rows[6]]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    """The rows with null languages, sources and clashing columns."""
    data = [(i, t, None, None if k % 5 == 0 else f"s{k % 3}", None, *(["clash"] * len(CLASHES))) for k, (i, t) in enumerate(odd_rows)]
    return spark.createDataFrame(data, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nameless_docs(spark):
    """Two rows without an id whose texts equal each other and row 1's."""
    text = "the same line of text\n" + " ".join(f"word{i}" for i in range(60))
    return spark.createDataFrame([(None, text, None, None, None, *[None] * len(CLASHES)), (None, text, None, None, None, *[None] * len(CLASHES)),
                                  (1, text, None, None, None, *[None] * len(CLASHES))], SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
