"""BPE encoding and decoding by forced-boundary splitting.

Two adjacent bytes that occur inside no token of the vocabulary can never be
merged, so a cut between them is certain.  Each word is cut there, the
fragments are encoded independently (each distinct one once per task's
cache), and the ids are concatenated.  A run of junk of any length thus falls
into short fragments.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from snapmetrics.llm.common import keyed_text, table
from snapmetrics.llm.tokens import LATIN

WORD_JSON = "word_bpe_49k.json"
#: Words and fragments that a task's cache holds before it starts afresh.
CACHE_WORDS = 200_000


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: the
    printable Latin-1 characters for themselves, the others from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class _Cache(dict):
    """A dictionary that computes what it lacks."""

    def __init__(self, make):
        self.make = make

    def __missing__(self, key):
        if len(self) >= CACHE_WORDS:
            self.clear()
        out = self[key] = self.make(key)
        return out


class Encoder:
    """Encodes as the library does with the given file, decodes as its
    ``decode(ids, skip_special_tokens=False)``."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.models import BPE

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        suffix = model["end_of_word_suffix"]
        self.library = Tokenizer.from_file(path)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        #: A word's last fragment carries the word end, the others do not.
        self.ends, self.inner = BPE(vocab=vocab, merges=merges, end_of_word_suffix=suffix), BPE(vocab=vocab, merges=merges)
        self.letters = byte_letters()
        self.as_letters = dict(enumerate(self.letters))
        #: The forced boundaries: byte pairs that occur inside no token.
        self.never = {(a, b) for a, b in np.argwhere(~self._joined(vocab, suffix)).tolist()}
        self.word_pattern = self._pattern()
        self.fragments = _Cache(self._fragment)
        self.words = _Cache(self._word)

    def _joined(self, vocab: dict[str, int], suffix: str) -> np.ndarray:
        """joined[a, b]: some token has byte b right after byte a."""
        value = {c: b for b, c in enumerate(self.letters)}
        out = np.zeros((256, 256), bool)
        for token in vocab:
            body = [value[c] for c in token.removesuffix(suffix)]
            out[body[:-1], body[1:]] = True
        return out

    @staticmethod
    def _pattern() -> re.Pattern:
        """The vocabulary's word pattern over the code points of ``LATIN``."""
        chars = [c for c in map(chr, range(0x2060)) if LATIN.fullmatch(c)]
        kind = {k: re.escape("".join(c for c in chars if unicodedata.category(c)[0] == k)) for k in "LN"}
        space = "\t-\r \x85\xa0"
        return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{kind['L']}]+|[{kind['N']}]|[^{space}{kind['L']}{kind['N']}]+")

    def _fragment(self, key: tuple[str, bool]) -> tuple[str, str]:
        text, last = key
        got = (self.ends if last else self.inner).tokenize(text)
        return " ".join([str(t.id) for t in got]), " ".join([t.value for t in got])

    def _word(self, word: str) -> tuple[str, str]:
        """(ids, token names) of a word in byte letters, joined by spaces."""
        raw = word.encode("latin-1" if word.isascii() else "utf-8")
        text = raw.decode("latin-1").translate(self.as_letters)
        cuts = [i for i, pair in enumerate(zip(raw, raw[1:]), 1) if pair in self.never]
        if not cuts:
            got = self.ends.tokenize(text)
            return " ".join([str(t.id) for t in got]), " ".join([t.value for t in got])
        out = [self.fragments[text[i:j], False] for i, j in zip([0, *cuts], cuts)]
        out.append(self.fragments[text[cuts[-1] :], True])
        return " ".join([a for a, _ in out]), " ".join([b for _, b in out])

    def _split(self, text: str) -> list[str]:
        """The words of a text without special tokens.  Latin texts are their
        own NFC form; others are normalised and split by the library."""
        if LATIN.fullmatch(text):
            return self.word_pattern.findall(text.lower())
        value = {c: b for b, c in enumerate(self.letters)}
        parts = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [bytes([value[c] for c in p]).decode() for p, _ in parts]

    def encode(self, text: str) -> tuple[str, str]:
        """(decimal ids joined by a space, decoded text)."""
        out: list[tuple[str, str]] = []
        for part in self.split_special.split(text) if "<|" in text else [text]:
            if part in self.special:
                out.append((str(self.special[part]), part))
            else:
                out += map(self.words.__getitem__, self._split(part))
        return " ".join([a for a, _ in out]), " ".join([b for _, b in out])


@functools.cache
def encoder(name: str) -> Encoder:
    return Encoder(public_tokenizers.path(name))


def _run(name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(name)
        for batch in batches:
            ids, decoded = [], []
            for t in batch.column("text"):
                a, b = e.encode(t.as_py())
                ids.append(a)
                decoded.append(b)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.string()), pa.array(decoded, pa.string())], names=["doc_id", "ids", "decoded"]
            )

    return run


def encode_documents(docs: DataFrame, name: str = WORD_JSON) -> DataFrame:
    """(doc_id, ids as decimal text, decoded text) of each document; null
    text is empty and has no ids, repeated rows give repeated rows."""
    return keyed_text(docs).mapInArrow(_run(name), "doc_id long, ids string, decoded string")


def _digests(name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(name)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for batch in batches:
            n, ids, decoded = [], [], []
            for t in batch.column("text"):
                a, b = e.encode(t.as_py())
                n.append(a.count(" ") + 1 if a else 0)
                ids.append(sha(a))
                decoded.append(sha(b))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return run


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of ``encode_documents`` on whole texts, without carrying the
    ids out of the tasks."""
    return keyed_text(table(spark, sf_dir, "documents")).mapInArrow(
        _digests(WORD_JSON), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
