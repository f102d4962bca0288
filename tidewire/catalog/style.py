"""Style queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.catalog.messages import messages, texts
from tidewire.catalog.registry import query, view
from tidewire.catalog.text_scores import hits
from tidewire.functions import lexicons as lex
from tidewire.operators import style

_WS = r"' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _char(c: str) -> str:
    return f"(length(text) - length(replace(text, '{c}', '')))"


def _count(column: str, pattern: str) -> str:
    return f"len(regexp_extract_all({column}, '{pattern}'))"


_AUX = "|".join(lex.QUESTION_AUXILIARIES)
_QUESTION = rf"(?i)(?:^|[^\p{{L}}\p{{N}}_])(?:{'|'.join(lex.QUESTION_WORDS)})\s+(?:{_AUX})"
_RHETORICAL = (
    r"(?i)(?:^|[^\p{L}\p{N}_])(?:"
    + "|".join(p.replace("'", "''") for p in lex.RHETORICAL_PHRASES)
    + ")|"
    + lex.THINKING_EMOJI
)
_EMOJI = "[" + "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in lex.EMOJI_RANGES) + "]"

view(
    "v_style_words",
    rf"""SELECT msg_id, text, s, toks, regexp_split_to_array(s, '\s+') AS w,
    regexp_split_to_array(lower(s), '\s+') AS lw
    FROM (SELECT msg_id, text, trim(text, {_WS}) AS s, toks FROM v_tokens)""",
)
view(
    "v_style_counts",
    rf"""SELECT msg_id, length(s) AS char_count, len(w) AS word_count,
    len(list_filter(regexp_split_to_array(s, '[.!?]+\s+'), lambda x: length(trim(x, {_WS})) > 0)) AS sentence_count,
    {_char('!')} AS exclamation_count, {_char('?')} AS question_count, {_char('.')} AS period_count,
    {_char(',')} AS comma_count, {_char(';')} AS semicolon_count, {_char(':')} AS colon_count,
    {_char('—')} + (length(text) - length(replace(text, '--', ''))) // 2 AS dash_count,
    len(list_filter(w, lambda x: length(x) > 1 AND regexp_matches(x, '\p{{Lu}}')
        AND NOT regexp_matches(x, '\p{{Ll}}'))) AS all_caps_count,
    len(list_filter(w, lambda x: regexp_matches(x, '^[^\p{{L}}]*(?:\p{{Lu}}\p{{Ll}}*(?:[^\p{{L}}]+|$))+$')))
        AS title_case_count,
    {hits(lex.STYLE_HEDGES, 'lw')} AS hedge_word_count,
    {hits(lex.SUPERLATIVES, 'lw')} AS superlative_count,
    {hits(lex.EMOTION_WORDS, 'lw')} AS emotion_word_count,
    {_char('?')} + {_count('s', _QUESTION)} AS direct_questions,
    {_count('s', _RHETORICAL)} AS rhetorical_indicators,
    {_count('s', '!{2,}')} + {_count('s', chr(92) + '?{2,}')} + {_count('s', chr(92) + '.{3,}')} AS repeated_punctuation,
    {_count('text', lex.HTTP_URL)} AS url_count,
    {_count('text', '@[' + chr(92) + 'p{L}' + chr(92) + 'p{N}_]+')} AS mention_count,
    {_count('text', '#[' + chr(92) + 'p{L}' + chr(92) + 'p{N}_]+')} AS hashtag_count,
    {_count('text', _EMOJI)} AS emoji_count,
    list_sum(list_transform(w, lambda x: length(x))) AS letters,
    len(list_filter(lw, lambda x: length(x) > 3))
      - len(list_distinct(list_filter(lw, lambda x: length(x) > 3))) AS repeats,
    {hits(lex.FORMAL_WORDS)} AS formal,
    {hits(lex.INFORMAL_WORDS)} + {_count('s', '!{2,}')}
      + {_count('s', "[" + chr(92) + "p{L}" + chr(92) + "p{N}_]+''[" + chr(92) + "p{L}" + chr(92) + "p{N}_]+")} AS informal
    FROM v_style_words""",
)
_CAPS_WEIGHT = "all_caps_count * 0.4::DOUBLE"
view(
    "v_style",
    f"""SELECT *, letters::DOUBLE / word_count AS avg_word_length,
    word_count::DOUBLE / sentence_count AS avg_sentence_length,
    all_caps_count::DOUBLE / word_count AS caps_ratio,
    CASE WHEN word_count <= 1 THEN 0.0 ELSE repeats::DOUBLE / word_count END AS word_repetition,
    greatest(0.0, least(100.0, 100 - (1.015::DOUBLE * word_count / sentence_count
        + 84.6::DOUBLE * (letters::DOUBLE / word_count / 4.7)))) AS readability_score,
    least((exclamation_count * 0.3::DOUBLE + {_CAPS_WEIGHT} + superlative_count * 0.2::DOUBLE
        + emotion_word_count * 0.2::DOUBLE + repeated_punctuation * 0.5::DOUBLE) / word_count * 10, 10.0)
        AS intensity_score,
    CASE WHEN formal + informal = 0 THEN 5.0 ELSE formal::DOUBLE / (formal + informal) * 10 END AS formality_score
    FROM v_style_counts""",
)

_ROUNDED = ", ".join(f"round({c}, 6) AS {c}" for c in style.RATIO_FEATURES)
_COUNTS = ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in style.COUNT_FEATURES)


def _flat(df: DataFrame) -> DataFrame:
    f = F.col("style_features")
    return df.select(
        "msg_id",
        *[f[c].alias(c) for c in style.COUNT_FEATURES],
        *[F.round(f[c], 6).alias(c) for c in style.RATIO_FEATURES],
    )


@query(
    "Y01 Y02 Y03 Y04 Y05 Y06 Y07 Y08 Y09 Y10 Y11 Y12 Y13 Y14 Y15 Y16 Y17 Y18 Y19 Y20 Y21 Y22 Y23 "
    "Y24 Y25 Y26 Y27 Y28 Y29",
    f"SELECT msg_id, {_COUNTS}, {_ROUNDED} FROM v_style",
)
def style_features(spark: SparkSession, folder: str) -> DataFrame:
    return _flat(style.style_features(texts(spark, folder)))


@query(
    "Y13 Y14 Y15 Y28",
    """SELECT msg_id, CAST(0 AS BIGINT) AS all_caps_count, CAST(0 AS BIGINT) AS title_case_count,
    round(least((exclamation_count * 0.3::DOUBLE + superlative_count * 0.2::DOUBLE
        + emotion_word_count * 0.2::DOUBLE + repeated_punctuation * 0.5::DOUBLE) / word_count * 10, 10.0), 6)
        AS intensity_score FROM v_style""",
)
def style_features_lowercased(spark: SparkSession, folder: str) -> DataFrame:
    flat = _flat(style.style_features(texts(spark, folder), parity=True))
    return flat.select("msg_id", "all_caps_count", "title_case_count", "intensity_score")


_STATS = ", ".join(
    f"round(avg({c}::DOUBLE), 6) AS avg_{c}, round(max({c}::DOUBLE), 6) AS max_{c}" for c in style.SUMMARISED
)


@query(
    "Y30",
    f"""SELECT count(*) AS total_messages, {_STATS},
    count(*) FILTER (intensity_score > 5) AS high_intensity_messages,
    count(*) FILTER (formality_score > 7) AS formal_messages,
    count(*) FILTER (formality_score < 3) AS informal_messages,
    count(*) FILTER (caps_ratio > 0.1) AS high_caps_messages FROM v_style""",
)
def style_statistics(spark: SparkSession, folder: str) -> DataFrame:
    return style.style_stats(style.style_features(texts(spark, folder)))


@query(
    "Y31 S09",
    """SELECT m.msg_id, strftime(m.date, '%Y-%m-%dT%H:%M:%S') AS date, CAST(length(m.text) AS BIGINT) AS text_length,
    CAST(s.word_count AS BIGINT) AS word_count, round(s.formality_score, 6) AS formality_score
    FROM v_messages m JOIN v_style s USING (msg_id)""",
)
def style_export(spark: SparkSession, folder: str) -> DataFrame:
    rows = style.style_export_rows(style.style_features(messages(spark, folder)))
    f = F.col("style_features")
    return rows.select(
        "msg_id", "date", "text_length",
        f["word_count"].alias("word_count"),
        F.round(f["formality_score"], 6).alias("formality_score"),
    )
