import random
from pathlib import Path

import pytest

from tidewire.catalog import registry
from tidewire.functions.spans import find_all
from tidewire.operators import quotes
from tidewire.sources.tables import shared_folder


def stored_bytes(spark) -> int:
    return sum(f.stat().st_size for f in Path(shared_folder(spark)).rglob("*") if f.is_file())


@pytest.mark.parametrize("name", ["span_matches", "span_accuracy", "message_accuracy", "quote_detection", "attribution_errors", "attribution_error_examples", "evaluation_report", "aligned_messages"])
def test_scoring_spans_stores_no_texts(spark, tmp_path, name):
    # random letters, so that compression hides nothing
    rng = random.Random(2)
    rows = [(i, "".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789 ", k=60_000)), "en", "s", 60_000) for i in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    before = stored_bytes(spark)
    found = registry.runnable()[name](spark, str(tmp_path)).collect()
    assert found and stored_bytes(spark) - before < 400_000  # the texts have 2.4 MB


@pytest.mark.parametrize("name", ["quote_statistics", "system_statistics"])
def test_totals_read_the_enriched_rows_once(spark, tmp_path, name):
    spark.createDataFrame([(i, "some text", "en", "s", 9) for i in range(24)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    plan = registry.runnable()[name](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan


def test_cues_lose_no_span(spark):
    texts = ["Ann Lee SAID: we go", "x JOHN doe wrote\nhi", "According To Bob Lee so", "as Ann put  it", '"a quoted sentence"', "‘another quoted one’", "> block of words", "| bar of words here",
             "then — dashes are here", "and -- more of them", "x\n - Some trailing name.", "Forwarded FROM Me: the text", "forwarded from me：wide", "none", "", None, "İ said", "İstanbul Ankara saıd: no"]
    df = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], "msg_id long, text string, forwarded_from string")
    with_cues = [str(r) for r in quotes.quote_columns(df).orderBy("msg_id").collect()]
    kept = dict(quotes._CUES)
    quotes._CUES.clear()
    try:
        without = [str(r) for r in quotes.quote_columns(df).orderBy("msg_id").collect()]
    finally:
        quotes._CUES.update(kept)
    assert with_cues == without and sum("quoted" in r for r in without) >= 7
    assert [len(r[0]) for r in df.filter("msg_id < 2").select(find_all("text", "[a-z]+", "contains(text, 'SAID')")).collect()] == [4, 0]
