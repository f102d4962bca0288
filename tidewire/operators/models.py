"""Batch scoring with a model of the caller's, loaded once per Python worker."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.functions.text import unnest


def score_texts(
    df: DataFrame,
    make_predict: Callable[[], Callable[[Sequence[str]], Sequence[Sequence[tuple[str, float]]]]],
    text: str = "text",
    output: str = "scores",
) -> DataFrame:
    """Add ``array<struct<label, score>>`` from ``make_predict()(texts)``.

    ``make_predict`` runs once per worker and Arrow batches are passed whole. A
    batch that fails is scored text by text, so one bad text costs only its own
    row, which gets null and falls back to the rules.
    """

    @F.pandas_udf("array<struct<label:string,score:double>>")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = make_predict()

        def one(value: str):
            try:
                return model([value])[0]
            except Exception:  # noqa: BLE001 - any model error means "no score" for this row
                return None

        for batch in batches:
            values = batch.fillna("").tolist()
            try:
                results = list(model(values))
            except Exception:  # noqa: BLE001
                results = [one(v) for v in values]
            yield pd.Series(
                [None if r is None else [{"label": str(a), "score": float(s)} for a, s in r] for r in results]
            )

    return df.withColumn(output, predict(F.col(text)))


def score_pairs(
    pairs: DataFrame,
    make_predict: Callable[[], Callable[[Sequence[str], Sequence[str]], np.ndarray]],
    first: str = "text",
    second: str = "hypothesis",
    output: str = "score",
) -> DataFrame:
    """Add a score per (text, hypothesis) pair."""

    @F.pandas_udf("double")
    def predict(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        model = make_predict()
        for a, b in batches:
            yield pd.Series(np.asarray(model(a.tolist(), b.tolist()), dtype="float64"))

    return pairs.withColumn(output, predict(F.col(first), F.col(second)))


def extract_mentions(
    df: DataFrame,
    make_predict: Callable[[], Callable[[str], Sequence[dict]]],
    key: str = "msg_id",
    text: str = "text",
) -> DataFrame:
    """Mentions of a caller's entity model as rows (msg_id, word, entity_group, score,
    start, end, message_text), ready for ``entities.clean_mentions``.

    A text the model fails on has no mentions.
    """

    @F.pandas_udf("array<struct<word:string,entity_group:string,score:double,start:long,end:long>>")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = make_predict()

        def one(value: str) -> list[dict]:
            try:
                return [dict(m) for m in model(value)]
            except Exception:  # noqa: BLE001 - any model error means "no mentions" for this row
                return []

        for batch in batches:
            yield batch.fillna("").map(one)

    found = df.withColumn("_found", predict(F.col(text)))
    rows = unnest(found, "_found", "_m", key, F.col(text).alias("message_text"))
    return rows.select(key, "_m.*", "message_text")
