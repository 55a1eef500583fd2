"""Byte-level BPE ids of documents, from a tiktoken ranks file."""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import public_tokenizers
import tiktoken

#: Free id of the ranks file; marks the end of a document.
END = 50256
RANKS = "byte_bpe_50k.tiktoken"


@lru_cache(maxsize=2)
def encoding(path: str) -> tiktoken.Encoding:
    """One encoding per worker process and file."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


def encode(path: str, text: str | None) -> np.ndarray:
    """Ids of a whole text as 16-bit numbers; null is the empty text."""
    if not text:
        return np.empty(0, "<u2")
    return encoding(path).encode_to_numpy(text, allowed_special=set(), disallowed_special=()).astype("<u2")
