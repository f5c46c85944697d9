"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"

# Fixed value: the published pattern that splits text before the merges of this vocabulary
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_loaded: dict[str, object] = {}


def encoder(path: str):
    """The tokenizer of a rank file, loaded once a process."""
    if path not in _loaded:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        _loaded[path] = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _loaded[path]


def count_tokens(text: str, path: str = TOKENIZER) -> int:
    return len(encoder(path).encode_ordinary(text))


def token_counts(documents: DataFrame, doc_id: str, text: str, keep: list[str] | None = None, tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, keep..., n_tokens) of whole texts; a null text has 0 tokens.

    Rows with a null id are ignored; rows are not made distinct.  ``tokenizer`` is the path of a rank
    file that every executor can read.
    """
    kept = keep or []
    rows = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), *[F.col(c).alias(c) for c in kept], F.col(text).cast("string").alias("_text")).where("doc_id is not null")

    @F.pandas_udf("bigint")
    def sizes(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoder(tokenizer)
        for part in parts:
            yield part.map(lambda t: len(enc.encode_ordinary(t)) if t else 0).astype("int64")

    return rows.select("doc_id", *kept, sizes("_text").alias("n_tokens"))
