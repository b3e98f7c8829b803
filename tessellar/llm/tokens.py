"""Token counts under a public byte-level BPE vocabulary, exact, with a cache of the counts of pre-tokenised pieces."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

#: Vocabulary file of ``base64-token rank`` lines; read where tasks run, never copied.
VOCABULARY = os.environ.get("TESSELLAR_VOCABULARY", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")
# Fixed value: the pre-tokenisation pattern that belongs to these vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_CACHE = 1_000_000


class TokenCounter(dict):
    """Counts tokens of texts; as a dict, piece -> number of tokens."""

    def __init__(self, path: str = VOCABULARY, pattern: str = PATTERN) -> None:
        import regex
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(t): int(n) for t, n in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("counted", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.split = regex.compile(pattern).findall

    def __missing__(self, piece: str) -> int:
        if len(self) >= _CACHE:
            self.clear()
        n = self[piece] = len(self.encoding._encode_single_piece(piece))
        return n

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if not text.isascii():
            text = text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")
        return sum(map(self.__getitem__, self.split(text)))


def token_counts(documents: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """(doc_id, source, n_tokens) of every row; null and empty texts count 0."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = TokenCounter(path)
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "source": b["source"], "n_tokens": [counter.count(t) for t in b["text"]]})

    return documents.select("doc_id", "source", "text").mapInPandas(run, "doc_id bigint, source string, n_tokens bigint")
