"""Style features: the cheap forms count what the plain patterns count."""

from pyspark.sql import functions as F

from tidewire.functions import lexicons as lex
from tidewire.functions.text import NOT_AFTER_WORD, WORD, count_char, count_matches, sentences, strip, whole_word, word_start, words
from tidewire.operators import style

TEXTS = [
    "", " \t\n", "WOW!!! Maybe we can't win... Obviously, this is the best plan??", "𝐀𝐁 Aa ǅ É ÉÉ O'Neil İI ΣΑΣ ok ok, okay; hell-o",
    "? ! . x. \n y!  . z", "Hell hello shell hell_ gonna_ Wanna", "thinK about it; Think about it; right? bright? 🤔", "why is what\tare somewhat do", "a'b'c'd e' 'f",
    "— -- --- : ; , . ! ? ..", "See https://a.b/c www.x.y @joe #Tag @ #", "😀🚀 plain é", None, "ﬁne ẞ THEREFORE, therefore", "x" * 5000 + "'" + "Y" * 5000,
]


def test_features_equal_plain_patterns(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "msg_id int, text string")
    raw = F.coalesce("text", F.lit(""))
    s = strip(raw)
    w, low = words(s), words(F.lower(s))
    upper = F.filter(w, lambda x: (F.length(x) > 1) & x.rlike(r"\p{Lu}") & ~x.rlike(r"\p{Ll}"))
    title = F.filter(w, lambda x: x.rlike(r"\p{Lu}") & ~x.rlike(style._NOT_TITLE))
    long_words = F.filter(low, lambda x: F.length(x) > 3)
    question = rf"(?i){NOT_AFTER_WORD}(?:{'|'.join(lex.QUESTION_WORDS)})\s+(?:{'|'.join(lex.QUESTION_AUXILIARIES)})"
    rhetorical = rf"(?i){NOT_AFTER_WORD}(?:{'|'.join(lex.RHETORICAL_PHRASES)})|{lex.THINKING_EMOJI}"
    formal = count_matches(F.lower(s), whole_word("|".join(lex.FORMAL_WORDS)))
    informal = count_matches(F.lower(s), whole_word("|".join(lex.INFORMAL_WORDS))) + count_matches(s, "!{2,}") + count_matches(s, rf"{NOT_AFTER_WORD}{WORD}++'{WORD}+")
    n = F.size(w)
    want = {
        "word_count": n, "sentence_count": F.size(sentences(s)), "period_count": F.length(raw) - F.length(F.translate(raw, ".", "")),
        "dash_count": F.length(raw) - F.length(F.translate(raw, "—", "")) + F.floor((F.length(raw) - F.length(F.replace(raw, F.lit("--"), F.lit("")))) / 2),
        "all_caps_count": F.size(upper), "title_case_count": F.size(title),
        "hedge_word_count": F.size(F.filter(low, lambda x: x.isin(*lex.STYLE_HEDGES))),
        "direct_questions": F.length(s) - F.length(F.translate(s, "?", "")) + count_matches(s, question),
        "rhetorical_indicators": count_matches(s, rhetorical), "repeated_punctuation": count_matches(s, r"!{2,}|\?{2,}|\.{3,}"),
        "url_count": count_matches(raw, lex.HTTP_URL), "mention_count": count_matches(raw, rf"@{WORD}+"),
        "hashtag_count": count_matches(raw, rf"#{WORD}+"), "emoji_count": count_matches(raw, style._EMOJI),
        "avg_word_length": F.when(n > 0, F.length(F.regexp_replace(s, r"\s+", "")) / n).otherwise(0.0),
        "word_repetition": F.when(n > 1, (F.size(long_words) - F.size(F.array_distinct(long_words))) / n).otherwise(0.0),
        "formality_score": F.when(formal + informal > 0, formal / (formal + informal) * 10).otherwise(5.0),
    }
    blank = F.length(s) == 0
    got = style.style_features(df).select("msg_id", *[F.col("style_features")[k].cast("double").alias(k) for k in want])
    plain = df.select("msg_id", *[F.when(blank, 0.0).otherwise(v.cast("double")).alias(k) for k, v in want.items()])
    assert [r.asDict() for r in got.orderBy("msg_id").collect()] == [r.asDict() for r in plain.orderBy("msg_id").collect()]


def test_patterns_run_only_where_a_cue_is_held(spark):
    df = spark.createDataFrame([("a--b - !",), ("",), (None,)], "text string")
    got = df.select(count_char("text", "-"), count_matches("text", "-{2,}", ("--",)), count_matches("text", word_start(["a", "b"]))).collect()
    assert [tuple(r) for r in got] == [(3, 1, 2), (0, 0, 0), (None, None, None)]
    plan = style.style_features(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "translate(" not in plan
