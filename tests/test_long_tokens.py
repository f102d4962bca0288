"""Tokens of a million characters must not exhaust the regex engine's stack."""

import pytest

from tidewire.operators.style import style_features

SIZE = 1_000_000
TOKENS = {"mixed": "A1" * (SIZE // 2), "capital": "A" * SIZE, "small": "a" * SIZE, "digits": "1" * SIZE}


@pytest.mark.parametrize("name", TOKENS)
def test_style_of_a_long_token(spark, name):
    df = spark.createDataFrame([("1", TOKENS[name])], "msg_id string, text string")
    row = style_features(df).select("style_features").collect()[0][0]
    assert (row.char_count, row.word_count, row.title_case_count) == (SIZE, 1, int(name == "mixed"))
