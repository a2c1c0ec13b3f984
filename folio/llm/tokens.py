"""The byte-pair tokenizer, loaded from a vocabulary file and shared with the tasks.

The file is read on the driver and broadcast (its size is bounded and
checked), so executors need no copy of it; each worker builds the encoder
once.  Strings that look like special tokens are ordinary text.
"""

from __future__ import annotations

import base64
import hashlib
import os
from collections.abc import Callable
from functools import partial

import numpy as np
import tiktoken
from pyspark import Broadcast
from pyspark.sql import SparkSession

#: Vocabulary in tiktoken's format; its id count leaves one id free for the end of a text.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
MAX_VOCABULARY_MB = 64
END = "<|endoftext|>"

# Fixed value: the pre-token pattern that belongs to this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_ENCODERS: dict[str, tiktoken.Encoding] = {}


def share(spark: SparkSession, path: str = VOCABULARY) -> Broadcast:
    """Broadcast a vocabulary file that the driver can read."""
    size = os.path.getsize(path)
    if size > MAX_VOCABULARY_MB << 20:
        raise ValueError(f"vocabulary of {size} bytes; at most {MAX_VOCABULARY_MB} MB are broadcast")
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encoder(vocabulary: bytes) -> tiktoken.Encoding:
    """The encoder of a shared vocabulary, built once a process."""
    name = hashlib.sha256(vocabulary).hexdigest()
    if name not in _ENCODERS:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, vocabulary.splitlines())}
        _ENCODERS[name] = tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks,
                                            special_tokens={END: max(ranks.values()) + 1})
    return _ENCODERS[name]


def encode(vocabulary: bytes) -> Callable[[str], np.ndarray]:
    """The ids of a text as an array; those of ``encode_ordinary``, without a list of Python numbers between."""
    return partial(encoder(vocabulary).encode_to_numpy, allowed_special=set(), disallowed_special=())


def end_of_text(vocabulary: bytes) -> int:
    """The first id above the vocabulary's."""
    return encoder(vocabulary).max_token_value
