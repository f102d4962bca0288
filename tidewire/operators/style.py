"""Style features: punctuation, casing, lexicon, question and formality measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions import lexicons as lex
from tidewire.functions.text import (
    NOT_AFTER_WORD,
    NOT_BEFORE_WORD,
    WORD,
    bind,
    count_char,
    count_in,
    count_literal,
    count_matches,
    holds,
    strip,
    word_start,
)

PROMOTED = (
    "exclamation_count", "caps_ratio", "hedge_word_count", "superlative_count",
    "intensity_score", "formality_score", "readability_score",
)
COUNT_FEATURES = (
    "char_count", "word_count", "sentence_count", "exclamation_count", "question_count",
    "period_count", "comma_count", "semicolon_count", "colon_count", "dash_count",
    "all_caps_count", "title_case_count", "hedge_word_count", "superlative_count",
    "emotion_word_count", "direct_questions", "rhetorical_indicators",
    "repeated_punctuation", "url_count", "mention_count", "hashtag_count", "emoji_count",
)
RATIO_FEATURES = (
    "avg_word_length", "avg_sentence_length", "caps_ratio", "word_repetition",
    "readability_score", "intensity_score", "formality_score",
)
FEATURES = COUNT_FEATURES + RATIO_FEATURES
SUMMARISED = (
    "exclamation_count", "caps_ratio", "hedge_word_count", "superlative_count",
    "intensity_score", "formality_score", "readability_score", "word_count",
    "sentence_count", "emoji_count", "url_count",
)

_UPPER_WORD = r"\p{Lu}"
_LOWER_LETTER = r"\p{Ll}"
# A word is in title case when every run of letters is one capital and small letters.
# Stated as what must not occur: a repeated group would make the regex engine recurse.
_NOT_TITLE = r"\p{L}\p{Lu}|(?<!\p{L})\p{Ll}|[\p{Lt}\p{Lm}\p{Lo}]"
_QUESTION = rf"(?i){word_start(lex.QUESTION_WORDS)}\s+(?:{'|'.join(lex.QUESTION_AUXILIARIES)})"
#: Punctuation that is counted; taken out of the text once, because there is little of it.
_POINTS = "!?.,;:—"
_MARKERS = word_start(lex.FORMAL_WORDS + lex.INFORMAL_WORDS) + NOT_BEFORE_WORD
_EMOJI = "[" + "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in lex.EMOJI_RANGES) + "]"


def _word_counts(text: Column, count_case: bool) -> Column:
    """Everything that needs the word array, from one split of the stripped text.

    Few words have a capital or are listed, so these are picked out in one pass each and then told apart.
    """

    def cased(w: Column, low: Column) -> Column:
        if not count_case:
            return F.struct(F.lit(0).cast("long").alias("caps"), F.lit(0).cast("long").alias("title"))
        # a capital that stays as it is in lower case is not ASCII
        changed = F.filter(w, lambda x, i: (x != F.get(low, i)) | (F.octet_length(x) > F.length(x)))
        return bind(
            F.filter(changed, lambda x: x.rlike(_UPPER_WORD)),
            lambda c: F.struct(
                F.size(F.filter(c, lambda x: (F.length(x) > 1) & ~x.rlike(_LOWER_LETTER))).cast("long").alias("caps"),
                F.size(F.filter(c, lambda x: ~x.rlike(_NOT_TITLE))).cast("long").alias("title"),
            ),
        )

    def listed(w: Column) -> Column:
        known = [*lex.STYLE_HEDGES, *lex.SUPERLATIVES, *lex.EMOTION_WORDS]
        return bind(
            F.filter(w, lambda x: x.isin(known)),
            lambda k: F.struct(
                count_in(k, lex.STYLE_HEDGES).alias("hedge"),
                count_in(k, lex.SUPERLATIVES).alias("superlative"),
                count_in(k, lex.EMOTION_WORDS).alias("emotion"),
            ),
        )

    def repeats(w: Column) -> Column:
        long_words = F.filter(w, lambda x: F.length(x) > 3)
        return bind(long_words, lambda x: F.size(x) - F.size(F.array_distinct(x)))

    def counted(w: Column) -> Column:
        return bind(
            F.transform(w, F.lower),
            lambda low: F.struct(
                F.size(w).cast("long").alias("n"), F.length(F.array_join(w, "")).cast("long").alias("letters"),
                cased(w, low).alias("case"), listed(low).alias("listed"), repeats(low).alias("repeats"),
            ),
        )

    none = F.array().cast("array<string>")
    return bind(F.when(F.length(text) == 0, none).otherwise(F.split(text, r"\s+")), counted)


def style_features(df: DataFrame, text: str = "text", parity: bool = False) -> DataFrame:
    """Add the ``style_features`` struct and seven promoted columns.

    ``parity=True`` counts capitals on lower-cased words, so the capital counts
    are always zero and do not reach the intensity score.
    """
    raw = F.coalesce(F.col(text), F.lit(""))
    s, lower, wc = F.col("_s"), F.col("_lower"), F.col("_wc")
    base = df.withColumn("_s", strip(raw)).withColumn("_lower", F.lower(s))
    markers = F.when(holds(lower, lex.FORMAL_WORDS + lex.INFORMAL_WORDS), F.regexp_extract_all(lower, F.lit(_MARKERS), F.lit(0)))
    base = base.withColumns(
        {
            "_wc": _word_counts(s, not parity),
            "_points": F.regexp_replace(raw, f"[^{_POINTS}]+", ""),
            "_marked": F.coalesce(markers, F.array().cast("array<string>")),
        }
    )
    points = F.col("_points")
    blank = F.length(s) == 0

    rhetorical = rf"(?i){word_start(lex.RHETORICAL_PHRASES)}|{lex.THINKING_EMOJI}"
    asked = [p.replace("\\", "") for p in lex.RHETORICAL_PHRASES] + [lex.THINKING_EMOJI]
    zero = F.lit(0).cast("long")
    # the text is stripped, so what lies between two sentence ends is empty or begins with no blank
    parts = F.filter(F.split(s, r"[.!?]+\s+"), lambda x: x != "")
    counts = {
        "char_count": F.length(s).cast("long"),
        "word_count": wc["n"],
        "sentence_count": F.size(parts).cast("long"),
        "exclamation_count": count_char(points, "!"),
        "question_count": count_char(points, "?"),
        "period_count": count_char(points, "."),
        "comma_count": count_char(points, ","),
        "semicolon_count": count_char(points, ";"),
        "colon_count": count_char(points, ":"),
        "dash_count": count_char(points, "—") + count_literal(raw, "--"),
        "all_caps_count": wc["case"]["caps"],
        "title_case_count": wc["case"]["title"],
        "hedge_word_count": wc["listed"]["hedge"],
        "superlative_count": wc["listed"]["superlative"],
        "emotion_word_count": wc["listed"]["emotion"],
        "direct_questions": count_char(points, "?") + F.when(holds(lower, lex.QUESTION_WORDS), count_matches(s, _QUESTION)).otherwise(zero),
        "rhetorical_indicators": F.when(holds(lower, asked), count_matches(s, rhetorical)).otherwise(zero),
        "repeated_punctuation": count_matches(s, r"!{2,}|\?{2,}|\.{3,}", ("!!", "??", "...")),
        "url_count": count_matches(raw, lex.HTTP_URL, ("http", "www.")),
        "mention_count": count_matches(raw, rf"@{WORD}+", ("@",)),
        "hashtag_count": count_matches(raw, rf"#{WORD}+", ("#",)),
        "emoji_count": F.when(F.octet_length(raw) == F.length(raw), zero).otherwise(count_matches(raw, _EMOJI)),
        "_letters": wc["letters"],
        "_formal": count_in(F.col("_marked"), lex.FORMAL_WORDS),
        "_informal": count_in(F.col("_marked"), lex.INFORMAL_WORDS)
        + count_matches(s, "!{2,}", ("!!",))
        # tried at word starts only, else a long word is scanned from each of its letters
        + count_matches(s, rf"{NOT_AFTER_WORD}{WORD}++'{WORD}+", ("'",)),
    }
    base = base.withColumn("_c", F.struct(*[v.alias(k) for k, v in counts.items()]))
    c = F.col("_c")
    repeats = wc["repeats"]

    def per_word(x: Column) -> Column:
        return F.coalesce(F.try_divide(x.cast("double"), c["word_count"].cast("double")), F.lit(0.0))

    avg_word = per_word(c["_letters"])
    avg_sentence = F.coalesce(
        F.try_divide(c["word_count"].cast("double"), c["sentence_count"].cast("double")), F.lit(0.0)
    )
    raw_intensity = (
        c["exclamation_count"] * 0.3
        + c["all_caps_count"] * 0.4
        + c["superlative_count"] * 0.2
        + c["emotion_word_count"] * 0.2
        + c["repeated_punctuation"] * 0.5
    )
    readability = 100 - (avg_sentence * 1.015 + 84.6 * (avg_word / 4.7))
    markers = c["_formal"] + c["_informal"]
    ratios = {
        "avg_word_length": avg_word,
        "avg_sentence_length": avg_sentence,
        "caps_ratio": per_word(c["all_caps_count"]),
        "word_repetition": F.when(c["word_count"] <= 1, 0.0).otherwise(per_word(repeats)),
        "readability_score": F.when(
            (c["word_count"] > 0) & (c["sentence_count"] > 0),
            F.greatest(F.lit(0.0), F.least(F.lit(100.0), readability)),
        ).otherwise(0.0),
        "intensity_score": F.least(per_word(raw_intensity) * 10, F.lit(10.0)),
        "formality_score": F.when(
            markers > 0, c["_formal"].cast("double") / markers.cast("double") * 10
        ).otherwise(5.0),
    }
    zero_ratio = F.lit(0.0)
    fields = [F.when(blank, zero).otherwise(c[k]).alias(k) for k in COUNT_FEATURES]
    fields += [F.when(blank, zero_ratio).otherwise(ratios[k]).alias(k) for k in RATIO_FEATURES]
    return (
        base.withColumn("style_features", F.struct(*fields))
        .withColumns({k: F.col("style_features")[k] for k in PROMOTED})
        .drop("_s", "_lower", "_wc", "_points", "_marked", "_c")
    )


def style_stats(df: DataFrame) -> DataFrame:
    """One row with mean and max of eleven features and four threshold counts."""
    f = F.col("style_features")
    aggs = []
    for name in SUMMARISED:
        value = f[name].cast("double")
        aggs.append(F.round(F.avg(value), 6).alias(f"avg_{name}"))
        aggs.append(F.round(F.max(value), 6).alias(f"max_{name}"))
    thresholds = {
        "high_intensity_messages": f["intensity_score"] > 5.0,
        "formal_messages": f["formality_score"] > 7.0,
        "informal_messages": f["formality_score"] < 3.0,
        "high_caps_messages": f["caps_ratio"] > 0.1,
    }
    aggs += [F.count_if(cond).alias(name) for name, cond in thresholds.items()]
    return df.agg(F.count("*").alias("total_messages"), *aggs)


def style_export_rows(df: DataFrame) -> DataFrame:
    """Per-message records of the style export: id, date, text length, features."""
    return df.select(
        F.col("msg_id").cast("string").alias("msg_id"),
        F.date_format("date", "yyyy-MM-dd'T'HH:mm:ss").alias("date"),
        F.length("text").cast("long").alias("text_length"),
        "style_features",
    )
