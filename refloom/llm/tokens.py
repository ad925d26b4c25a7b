"""Sizes of texts in tokens of a public byte-level BPE vocabulary."""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Where the vocabulary lies, a parameter of every function here; the file is never copied.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How the vocabulary's tokenizer cuts text into words (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@functools.cache
def encoding(vocabulary: str):
    import tiktoken

    with open(vocabulary, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("sizes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(texts: DataFrame, doc_id: str, text: str, *keep: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, keep..., tokens): one row for each id with a text, its whole text counted; an empty text has none.

    Texts are read once and never shuffled; only the sizes are. Repeated rows of an id count once (the largest), rows
    without an id or a text give none.
    """
    cols = texts.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"), *[F.col(c).alias(c) for c in keep]).where("doc_id is not null and _text is not null")
    kinds = ", ".join(f"{c} {cols.schema[c].dataType.simpleString()}" for c in ("doc_id", *keep))

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoding(vocabulary).encode_ordinary
        for pdf in parts:
            yield pdf.drop(columns="_text").assign(tokens=[len(encode(t)) for t in pdf["_text"]])

    sized = cols.mapInPandas(count, f"{kinds}, tokens long")
    return sized.groupBy("doc_id").agg(F.max("tokens").alias("tokens"), *[F.max_by(c, "tokens").alias(c) for c in keep])
