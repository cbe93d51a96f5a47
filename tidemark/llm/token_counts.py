"""Token counts: strings proved to be one token are looked up, only the rest is merged."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.byte_pieces import REMEMBERED, BytePieces, slices
from tidemark.llm.common import worker_cache
from tidemark.llm.packing import tokenizer_path

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 1024


class TokenCounter:
    """Number of tokens of a text.

    ``sizes`` starts with the strings proved to be one token. Other pieces are merged once and
    remembered, ``remembered`` of them at most.
    """

    def __init__(self, pieces: BytePieces, remembered: int = REMEMBERED):
        self.pieces, self.remembered = pieces, remembered
        self.proved = dict.fromkeys(pieces.whole, 1)
        self.sizes = dict(self.proved)

    def __call__(self, text: str) -> int:
        parts = self.pieces.plain_parts(text)
        # Every gap between two parts is one special string, itself a token.
        return len(parts) - 1 + sum(self._plain(piece) for part in parts for piece in slices(part))

    def _plain(self, text: str) -> int:
        cut = self.pieces.cut(text)
        try:
            return sum(map(self.sizes.__getitem__, cut))
        except KeyError:
            if len(self.sizes) > len(self.proved) + self.remembered:
                self.sizes = dict(self.proved)
            for piece in set(cut).difference(self.sizes):
                self.sizes[piece] = len(self.pieces.merge(piece))
            return sum(map(self.sizes.__getitem__, cut))


def _counter(path: str) -> TokenCounter:
    """One per worker process, so that merged pieces outlive a task."""
    kept = worker_cache("token counts")
    if path not in kept:
        kept[path] = TokenCounter(BytePieces(path))
    return kept[path]


def token_count(text: Column, path: str | None = None) -> Column:
    """Tokens of a text without added ones; null counts as empty.

    Special strings inside a text are one token each, as the tokenizer's library takes them by
    default. ``path`` names a tokenizer file on the workers; by default each looks up its own.
    """

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        counter = _counter(path or tokenizer_path(TOKENIZER))
        return pd.Series([counter(t) if t else 0 for t in texts], dtype="int64")

    return count(text)


def count_tokens(
    docs: DataFrame, text: str = "text", row_id: str = "doc_id", limit: int = LIMIT, path: str | None = None
) -> DataFrame:
    """(row_id, n_bytes, n_tokens, over_limit) of every row, in the tasks that read it.

    Null and empty texts have no bytes and no tokens. Rows that repeat, or have no id, each get a
    row. A very long text is cut into slices where a piece begins anyway. Other columns are
    ignored. An empty table gives an empty result.
    """
    counted = docs.select(
        F.col(row_id),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("n_bytes"),
        token_count(F.col(text), path).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
