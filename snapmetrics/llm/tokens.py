"""Token ids of whole texts with the given byte-level vocabulary.

The same vocabulary exists for two libraries.  Texts of Latin letters and
common punctuation, for which both agree, take the faster one; any other text
goes to the ``tokenizers`` library itself.
"""

from __future__ import annotations

import base64
import functools
import re

import numpy as np
import public_tokenizers

BYTE_JSON = "byte_bpe_50k.json"
BYTE_RANKS = "byte_bpe_50k.tiktoken"
#: Code points whose classes are the same in every Unicode version in use
#: and that are their own NFC form.
LATIN = re.compile("[\x00-ɏ‐-‧‰-⁞]*")


@functools.cache
def _libraries(json_name: str, ranks_name: str):
    import tiktoken
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(public_tokenizers.path(json_name))
    slow.no_truncation()
    slow.no_padding()
    with open(public_tokenizers.path(ranks_name), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    special = {t.content: i for i, t in slow.get_added_tokens_decoder().items()}
    fast = tiktoken.Encoding("byte", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return slow, fast


def encode(text: str, json_name: str = BYTE_JSON, ranks_name: str = BYTE_RANKS) -> np.ndarray:
    """Ids as unsigned 32-bit integers, as ``encode(text, add_special_tokens=False)``."""
    slow, fast = _libraries(json_name, ranks_name)
    if LATIN.fullmatch(text):
        return fast.encode_to_numpy(text, allowed_special="all")
    return np.array(slow.encode(text, add_special_tokens=False).ids, np.uint32)
