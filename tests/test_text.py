"""Literal sentences with values worked out by hand."""

import pytest
from pyspark.sql import functions as F

from tidewire.functions.text import split_list
from tidewire.operators import entities, links, quotes, sentiment, stance, style, toxicity
from tidewire.operators.stance import inflections

PHRASE_9 = "WOW!!! Maybe we can't win. Obviously this is the best plan, folks."


def one(spark, text, *steps):
    df = spark.createDataFrame([("1", text, None)], "msg_id string, text string, forwarded_from string")
    for step in steps:
        df = df.transform(step)
    return df.first()


@pytest.mark.parametrize(
    "text, label, score, toxic",
    [
        ("I love this! It's absolutely wonderful!", "positive", 1.0, 0.0),
        ("This is terrible and disappointing.", "negative", 0.0, 0.2),
        ("The weather is okay, nothing special.", "neutral", 0.5, 0.0),
        ("", "neutral", 0.5, 0.0),
        ("Great work but the worst, awful stupid plan", "negative", 1 / 3, 0.375),
    ],
)
def test_scores(spark, text, label, score, toxic):
    row = one(spark, text, sentiment.score_sentiment, toxicity.score_toxicity)
    assert (row.sentiment, row.is_toxic) == (label, False)
    assert row.sentiment_score == pytest.approx(score)
    assert row.toxicity_score == pytest.approx(toxic)


def test_style(spark):
    f = one(spark, PHRASE_9, style.style_features).style_features
    assert (f.char_count, f.word_count, f.sentence_count, f.exclamation_count) == (66, 12, 3, 3)
    assert (f.all_caps_count, f.repeated_punctuation) == (1, 1)
    assert f.avg_word_length == pytest.approx(4.583333, abs=1e-6)
    assert f.readability_score == pytest.approx(13.44, abs=1e-6)
    assert one(spark, "   ", style.style_features).style_features.formality_score == 0.0
    assert one(spark, PHRASE_9, lambda d: style.style_features(d, parity=True)).style_features.all_caps_count == 0


def test_links(spark):
    row = one(spark, "see https://www.foo.com/a,b(c)?x=1#frag then news.bbc.co.uk/x and microsoft.com", links.link_columns)
    assert [x.url for x in row.links][:2] == ["https://www.foo.com/a,b(c)?x=1", "https://news.bbc.co.uk/x"]
    assert (row.links[0].domain, row.links[0].subdomain, row.links[1].domain) == ("foo.com", "www", "bbc.co.uk")
    assert (row.social_media_links, row.most_frequent_domain) == (1, "foo.com")
    assert one(spark, "microsoft.com", lambda d: links.link_columns(d, exact=True)).social_media_links == 0


def test_very_long_host_does_not_overflow(spark):
    assert one(spark, "a." * 200_000 + "com", links.link_columns).total_links >= 1


def test_quotes_after_emoji(spark):
    text = '😀 Barack Obama said: "we will win this together" and left.'
    row = one(spark, text, quotes.quote_columns)
    spans = [(s.span_type, s.speaker, text[s.start : s.end]) for s in row.quote_spans]
    assert ("quoted", "Barack Obama", '"we will win this together"') in spans
    assert row.has_quotes and row.quote_speakers == ["Barack Obama"]
    assert "".join(t for _, _, t in spans) == text


def test_entities_and_stance(spark):
    aliases = [("biden", "Joe Biden", "PERSON", 0), ("cnn", "CNN", "ORG", 1)]
    row = one(
        spark, "I don't support Joe Biden on immigration.",
        lambda d: entities.rule_entities(d, aliases), stance.stance_columns,
    )
    assert (row.entities[0].text, row.entities[0].start, row.entities[0].end) == ("Joe Biden", 20, 25)
    assert [(e.target, e.label, e.method) for e in row.stance_edges] == [("Joe Biden", "oppose", "rules_preferred")]


def test_large_dictionary_equals_small(spark):
    keys = [(f"word{i}", f"Name {i}", "ORG", i) for i in range(400)]
    text = "about word7 and WORD399 and word12"
    big = one(spark, text, lambda d: entities.rule_entities(d, keys, max_entities=9)).entities
    small = one(spark, text, lambda d: entities.rule_entities(d, [k for k in keys if k[3] in (1, 3, 7, 9, 12, 39, 399)], max_entities=9)).entities
    assert big == small


def test_inflections():
    assert inflections("criticize")[1:] == ("criticizes", "criticized", "criticizing")
    assert "slammed" in inflections("slam") and "agreed" in inflections("agree")


def test_split_list(spark):
    row = spark.range(1).select(split_list(F.lit("a, b/c og d\n\n e")).alias("x")).first()
    assert row.x == ["a", "b", "c", "d", "e"]


def test_cheap_forms_equal_the_plain_patterns(spark):
    import re

    from tidewire.functions import lexicons as lex
    from tidewire.functions.text import TOKEN, one_of, tokens
    from tidewire.operators import links, stance

    texts = [
        None, "", " ", "...", "  Éa_1 b'c-D, 中文。x ", "a.b", "a. b", "A.B", "www.-x", "http://", "HTTPS://x", "see x.y.com/z, e.g. this.", "1.2 a.b1 .com a..b", "ſ.ab K.ab ab.ſx",
        "x://y", "www.!", "-.ab", "a-.ab.cd",
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    got = df.select(
        tokens("text"), F.regexp_extract_all(F.lower("text"), F.lit(TOKEN), F.lit(0)),
        links.extract_urls("text"), F.regexp_extract_all("text", F.lit(lex.ANY_URL), F.lit(0)),
    ).collect()
    assert all(r[0] == r[1] and r[2] == r[3] for r in got) and sum(bool(r[2]) for r in got) >= 5
    verbs = {*stance.SUPPORT_FORMS, *stance.OPPOSE_FORMS}
    pattern = re.compile(one_of(verbs))
    tried = verbs | {v[:-1] for v in verbs} | {v + "s" for v in verbs} | {"", "s"}
    assert {t for t in tried if pattern.fullmatch(t)} == verbs


def test_texts_without_targets_give_no_speaker_stance(spark):
    from tidewire.catalog.entities import ALIASES

    texts = [
        'Barack Obama said: "we love the Democrats, always" and left.', 'x supportJoe Biden said: "nobody here"', None, "",
        "I don't support Joe Biden on the border.", "We might endorse Donald Trump, perhaps.", "Joe Biden xsupports us", 'nobody said: "we love the plan very much"', 'Jane Roe said: "xsupport\u2019 us" \u2018hate Joe Biden so\u2019',
    ]
    rows = spark.createDataFrame([(str(i), t, None) for i, t in enumerate(texts)], "msg_id string, text string, forwarded_from string")
    named = entities.rule_entities(rows, ALIASES)
    want, got = (
        sorted(tuple(r) for r in stance.speaker_stance(quotes.quote_columns(df)).select("msg_id", "start", "speaker", "target", "label", "score").collect())
        for df in (named, stance.targeted(named))
    )
    assert got == want and len(want) >= 2
    assert stance.targeted(named).filter("text IS NOT NULL").count() < sum(bool(t) for t in texts)


def test_extended_summary_reads_its_messages_once(spark):
    from datetime import datetime

    from tidewire.operators import rollups

    read = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def score(x):
        read.add(1)
        return float(x)

    rows = [(datetime(2024, 1, 1 + i % 2), i / 4, 1, "a" if i < 3 else "b", [("n%d" % (i % 3),)]) for i in range(8)]
    df = spark.createDataFrame(rows, "date timestamp, x double, stance_edge_count long, primary_topic string, entities array<struct<text:string>>")
    scored = df.select("*", score("x").alias("sentiment_score"), F.col("x").alias("toxicity_score"))
    scored = scored.filter(F.col("sentiment_score") >= 0)
    got = sorted(tuple(r) for r in rollups.daily_summary_extended(scored).collect())
    assert [(g[1], g[4], g[5], g[6]) for g in got] == [(4, 4, 3, "a"), (4, 4, 3, "b")]
    assert read.value <= 2 * len(rows)
