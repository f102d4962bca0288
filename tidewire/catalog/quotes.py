"""Quote and span queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.catalog.messages import texts
from tidewire.catalog.registry import query, view
from tidewire.functions import lexicons as lex
from tidewire.operators import quotes

_WS = r"' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _q(pattern: str) -> str:
    return pattern.replace("'", "''")


def _clean(x: str) -> str:
    steps = (r"(?i)^(?:from|by|@)\s*", r"(?i)\s*(?:said|wrote|tweeted|stated).*$", r"[^\p{L}\p{N}_\s\-.]")
    for step in steps:
        x = f"regexp_replace({x}, '{step}', ''{', ' + chr(39) + 'g' + chr(39) if step.startswith('[') else ''})"
    x = rf"trim(regexp_replace({x}, '\s+', ' ', 'g'))"
    return f"coalesce(nullif({x}, ''), 'unknown')"


def _matches(source: str, pattern: str) -> str:
    """Rows (msg_id, i, start, end, match) of a pattern."""
    p = _q(pattern)
    return f"""SELECT msg_id, i, text, ms[i] AS match,
    list_sum(list_transform(gs[1:i], lambda g: length(g)))
      + coalesce(list_sum(list_transform(ms[1:i-1], lambda m: length(m))), 0) AS start
    FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM (
      SELECT msg_id, text, regexp_extract_all(text, '{p}') AS ms, regexp_split_to_array(text, '{p}') AS gs
      FROM {source}) WHERE len(ms) > 0)"""


view(
    "v_attr",
    " UNION ALL ".join(
        f"""SELECT msg_id, {n} AS p, i, '{name}' AS pattern, text, start + length(match) AS stop,
        {_clean(f"regexp_extract(match, '(?i){pattern}', 1)")} AS speaker
        FROM ({_matches('v_texts', '(?i)' + pattern)})"""
        for n, (name, pattern) in enumerate(lex.SPEAKER_PATTERNS)
    ),
)
_NEAR = [f"^(?s:(.{{0,49}}?)){p}" for _, p in lex.QUOTE_PATTERNS]
_FIRST = (
    "CASE "
    + " ".join(f"WHEN regexp_matches(rest, '{_q(n)}') THEN {i}" for i, n in enumerate(_NEAR))
    + " WHEN length(rest) > 0 AND length(rest) < 2048 AND looks THEN 99 END"
)
view(
    "v_attr_rest",
    f"""SELECT *, {_FIRST} AS which FROM (SELECT *,
    CAST(starts_with(rest, '"') AS INT) + CAST(ends_with(rest, '"') AS INT)
    + CAST((length(rest) - length(replace(rest, 'I ', ''))) // 2 >= 2 AS INT)
    + CAST(regexp_matches(lower(rest), 'my |our |we |us ') AS INT)
    + CAST(length(rest) - length(replace(rest, '!', '')) >= 2 AS INT) >= 2 AS looks
    FROM (SELECT *, trim(text[stop+1:], {_WS}) AS rest,
            length(text[stop+1:]) - length(ltrim(text[stop+1:], {_WS})) AS lead FROM v_attr))""",
)


def _pick(group: int) -> str:
    return (
        "CASE which "
        + " ".join(f"WHEN {i} THEN regexp_extract(rest, '{_q(n)}', {group})" for i, n in enumerate(_NEAR))
        + (" WHEN 99 THEN '' END" if group == 1 else " WHEN 99 THEN rest END")
    )


view(
    "v_span0",
    f"""SELECT msg_id, stop + lead + length({_pick(1)}) AS start, stop + lead + length({_pick(0)}) AS stop,
    trim({_pick(2)}, {_WS}) AS text, 'quoted' AS span_type, speaker, 0.8::DOUBLE AS confidence, pattern,
    0 AS grp, p AS p, i FROM v_attr_rest WHERE which IS NOT NULL""",
)
for _n, (_name, _pattern) in enumerate(lex.QUOTE_PATTERNS):
    _flagged = f"(?m){_pattern}"
    view(
        f"v_span{_n + 1}",
        f"""SELECT * FROM v_span{_n} UNION ALL
        SELECT msg_id, start, start + length(match), body, 'quoted', 'unknown', 0.6::DOUBLE, '{_name}', {_n + 1}, 0, i
        FROM (SELECT *, trim(regexp_extract(match, '{_q(_flagged)}', 1), {_WS}) AS body
              FROM ({_matches('v_texts', _flagged)})) c
        WHERE length(body) >= 10 AND NOT EXISTS (SELECT 1 FROM v_span{_n} s
          WHERE s.msg_id = c.msg_id AND s.start <= c.start AND c.start < s.stop)""",
    )
_LAST = f"v_span{len(lex.QUOTE_PATTERNS)}"
_HEAD = rf"(?s)^(.*?)(?-s:{lex.FORWARD_SOURCE})"
view(
    "v_special",
    rf"""SELECT msg_id, 0 AS start, length(text) AS stop, text, 'forwarded' AS span_type,
      {_clean('forwarded_from')} AS speaker, 0.9::DOUBLE AS confidence, NULL AS pattern, -1 AS grp, 0 AS p, 0 AS i
    FROM v_texts WHERE forwarded_from IS NOT NULL
    UNION ALL
    SELECT msg_id, length(head), length(text), trim(text[length(head)+1:], {_WS}), 'forwarded',
      {_clean(f"regexp_extract(text, '{lex.FORWARD_SOURCE}', 1)")}, 0.8::DOUBLE, NULL, -1, 0, 0
    FROM (SELECT msg_id, text, regexp_extract(text, '{_HEAD}') AS head FROM v_texts WHERE forwarded_from IS NULL)
    WHERE head <> '' AND trim(text[length(head)+1:], {_WS}) <> ''
    UNION ALL SELECT * FROM {_LAST}""",
)
view(
    "v_spans",
    f"""SELECT msg_id, start, stop, text, span_type, speaker, confidence, pattern FROM v_special
    UNION ALL
    SELECT msg_id, pos0, start, gap, 'author', 'author', 1.0::DOUBLE, NULL FROM (
      SELECT msg_id, pos0, start, trim(body[pos0+1:start], {_WS}) AS gap FROM (
        SELECT s.msg_id, s.start, t.text AS body, coalesce(max(s.stop) OVER (PARTITION BY s.msg_id
          ORDER BY s.start, s.grp, s.p, s.i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos0
        FROM v_special s JOIN v_texts t ON t.msg_id = s.msg_id) WHERE pos0 < start) WHERE gap <> ''
    UNION ALL
    SELECT msg_id, pos0, length(body), trim(body[pos0+1:], {_WS}), 'author', 'author', 1.0::DOUBLE, NULL FROM (
      SELECT t.msg_id, any_value(t.text) AS body, max(s.stop) AS pos0
      FROM v_special s JOIN v_texts t ON t.msg_id = s.msg_id GROUP BY t.msg_id)
    WHERE pos0 < length(body) AND trim(body[pos0+1:], {_WS}) <> ''
    UNION ALL
    SELECT msg_id, 0, length(text), text, 'author', 'author', 1.0::DOUBLE, NULL
    FROM v_texts t WHERE NOT EXISTS (SELECT 1 FROM v_special s WHERE s.msg_id = t.msg_id)""",
)
view(
    "v_speakers",
    "SELECT DISTINCT msg_id, speaker FROM (SELECT msg_id, speaker FROM v_attr UNION ALL SELECT msg_id, speaker FROM v_special)",
)
view(
    "v_quote_flags",
    """SELECT msg_id, bool_or(span_type <> 'author') AS has_quotes, count(*) AS span_count,
    coalesce((SELECT count(*) FROM v_speakers p WHERE p.msg_id = s.msg_id), 0) > 1 AS multi_speaker,
    coalesce((SELECT string_agg(speaker, '|' ORDER BY speaker) FROM v_speakers p WHERE p.msg_id = s.msg_id), '')
      AS speakers
    FROM v_spans s GROUP BY msg_id""",
)


def with_quotes(df: DataFrame) -> DataFrame:
    return quotes.quote_columns(df)


@query(
    "Q02 Q03 Q04 Q05 Q06 Q07 Q08 Q10 W02 F01",
    """SELECT msg_id, CAST(start AS INTEGER) AS start, CAST(stop AS INTEGER) AS "end", text, span_type, speaker,
    confidence, pattern AS attribution_pattern FROM v_spans""",
)
def quote_spans(spark: SparkSession, folder: str) -> DataFrame:
    return quotes.span_rows(with_quotes(texts(spark, folder)), "msg_id").select(
        "msg_id", "start", "end", "text", "span_type", "speaker", "confidence", "attribution_pattern"
    )


@query("Q09", "SELECT msg_id, has_quotes, multi_speaker, span_count, speakers FROM v_quote_flags")
def quote_flags(spark: SparkSession, folder: str) -> DataFrame:
    return with_quotes(texts(spark, folder)).select(
        "msg_id", "has_quotes", "multi_speaker", "span_count",
        F.array_join("quote_speakers", "|").alias("speakers"),
    )


@query(
    "Q01",
    r"""SELECT msg_id, forwarded_from IS NOT NULL
    OR regexp_matches(text, '(?im)(?:forwarded\s+from\s+.+?[:：])|(?:forwarded\s+message)|(?:fwd:\s*)|(?:re:\s*)')
    AS is_forwarded FROM v_texts""",
)
def forwarded_flags(spark: SparkSession, folder: str) -> DataFrame:
    flag = quotes.is_forwarded("text", "forwarded_from")
    return texts(spark, folder).select("msg_id", flag.alias("is_forwarded"))


@query(
    "Q05",
    """SELECT conv_id, turn, CAST(starts_with(text, '"') AS INT) + CAST(ends_with(text, '"') AS INT)
    + CAST((length(text) - length(replace(text, 'I ', ''))) // 2 >= 2 AS INT)
    + CAST(regexp_matches(lower(text), 'my |our |we |us ') AS INT)
    + CAST(length(text) - length(replace(text, '!', '')) >= 2 AS INT) >= 2 AS looks_quoted FROM conversations""",
)
def quote_like_turns(spark: SparkSession, folder: str) -> DataFrame:
    turns = spark.read.parquet(f"{folder}/conversations.parquet")
    return turns.select("conv_id", "turn", quotes.looks_like_quote("text").alias("looks_quoted"))


@query(
    "Q11",
    """SELECT count(*) AS total_messages, count(*) FILTER (has_quotes) AS messages_with_quotes,
    count(*) FILTER (multi_speaker) AS multi_speaker_messages, CAST(sum(span_count) AS BIGINT) AS total_spans,
    (SELECT count(DISTINCT speaker) FROM v_spans WHERE speaker <> 'author') AS unique_quoted_speakers,
    round(sum(span_count)::DOUBLE / count(*), 6) AS avg_spans_per_message,
    round(count(*) FILTER (has_quotes)::DOUBLE / count(*) * 100, 6) AS quote_percentage FROM v_quote_flags""",
)
def quote_statistics(spark: SparkSession, folder: str) -> DataFrame:
    return quotes.quote_stats(with_quotes(texts(spark, folder)))


@query("Q11", "SELECT span_type, count(*) AS count FROM v_spans GROUP BY span_type")
def span_type_counts(spark: SparkSession, folder: str) -> DataFrame:
    return quotes.span_type_counts(with_quotes(texts(spark, folder)))


@query(
    "Q12",
    """SELECT t.msg_id, coalesce(string_agg(s.text, ' ' ORDER BY s.start), '') AS author_text
    FROM v_texts t LEFT JOIN v_spans s ON s.msg_id = t.msg_id AND s.span_type = 'author' GROUP BY t.msg_id""",
)
def author_texts(spark: SparkSession, folder: str) -> DataFrame:
    return with_quotes(texts(spark, folder)).select("msg_id", quotes.author_text().alias("author_text"))
