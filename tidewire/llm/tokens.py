"""Token counts by a two-tier lookup of pre-token lengths, without shuffling pre-tokens."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A pre-token is a run of spaces with the characters up to the next space: the model's merges never pass its end.
_CHUNK = re.compile(r" +[^ ]*")
#: The model writes spaces as this character, so a text that holds it has spaces there.
_MARK = "▁"


def _chunks(text: str) -> list[str]:
    """Pre-tokens without their first space; the model puts one before the text."""
    text = text.replace(_MARK, " ")
    parts = text.split(" ")
    return [m[1:] for m in _CHUNK.findall(" " + text)] if "" in parts else parts


class TokenCounter:
    """Counts tokens of texts from lengths of pre-tokens: first the shared table, then the worker's cache, then the model."""

    def __init__(self, model: bytes, frequent: dict[str, int] | None = None, cache_entries: int = 200_000):
        import sentencepiece

        self.encode = sentencepiece.SentencePieceProcessor(model_proto=model).encode
        self.frequent, self.cache, self.cache_entries = frequent or {}, {}, cache_entries

    def length(self, chunk: str) -> int:
        return len(self.encode(chunk)) if chunk else 1

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        total, frequent, cache = 0, self.frequent.get, self.cache
        for chunk in _chunks(text):
            n = frequent(chunk)
            if n is None:
                n = cache.get(chunk)
                if n is None:
                    n = self.length(chunk)
                    if len(chunk) <= 64:
                        if len(cache) >= self.cache_entries:
                            cache.clear()
                        cache[chunk] = n
            total += n
        return total


def _heavy(per_partition: int, room: int):
    def summarise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.iloc[:, 0]:
                if text:
                    counts.update(c for c in _chunks(text) if len(c) <= 32)
                    if len(counts) > room:
                        counts = Counter(dict(counts.most_common(room // 4)))
        yield pd.DataFrame(counts.most_common(per_partition), columns=["chunk", "n"])

    return summarise


def frequent_chunks(docs: DataFrame, text_col: str = "text", table_entries: int = 32_768, per_partition: int = 1024, room: int = 200_000) -> list[str]:
    """The most frequent pre-tokens of all documents, at most ``table_entries``.

    Every partition sums up its own texts in bounded memory and passes on its
    ``per_partition`` heaviest pre-tokens; only these summaries are added up.
    The choice affects speed alone, never a count.
    """
    heavy = docs.select(text_col).mapInPandas(_heavy(per_partition, room), "chunk string, n long")
    top = heavy.groupBy("chunk").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "chunk").limit(table_entries)
    return [r["chunk"] for r in top.collect()]


def token_counts(docs: DataFrame, model_path: str, text_col: str = "text", name: str = "n_tokens", table_entries: int = 32_768) -> DataFrame:
    """``docs`` with the number of tokens of each whole text, as the model gives it without begin or end tokens.

    The table of at most ``table_entries`` pre-tokens of up to 32 characters and
    the model file are broadcast, both of fixed size; misses are encoded
    once per worker and cached in bounded memory. Null and empty texts have 0
    tokens, texts of any length are counted whole. An existing column ``name`` is replaced.
    """
    context = docs.sparkSession.sparkContext
    model = Path(model_path).read_bytes()
    driver = TokenCounter(model)
    chunks = frequent_chunks(docs, text_col, table_entries)
    shared = context.broadcast((model, "\n".join(c.replace("\n", "\x00\x01") for c in chunks), bytes(min(255, driver.length(c)) for c in chunks)))

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model, joined, lengths = shared.value
        names = [c.replace("\x00\x01", "\n") for c in joined.split("\n")] if lengths else []
        counter = TokenCounter(model, dict(zip(names, lengths, strict=True)))
        for texts in batches:
            yield pd.Series([counter.count(t) for t in texts], dtype="int64")

    return docs.withColumn(name, count(F.col(text_col)))
