"""Quote and speaker spans, all as array expressions inside the row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions import lexicons as lex
from tidewire.functions.spans import SPANS, fill_gaps, find_all, span, sql_text
from tidewire.functions.text import bind, col, count_char, count_literal, is_blank, strip, unnest
from tidewire.sources.tables import cut_lineage

MAX_QUOTE_LENGTH = 2048
#: What a text must hold to match a pattern, in lower case for the speaker patterns; looked for first, because a regular expression tries every letter.
_CUES = {
    "said": "said", "tweeted": "tweeted", "wrote": "wrote", "stated": "stated", "according_to": "according", "put_it": "put",
    "double": '"', "curly": "“", "single_smart": "‘", "block": ">", "bar": "|", "em_dash": "—", "double_dash": "--", "trailing_name": "-",
}
# A quote has to begin within this many characters after the attribution.
_REACH = 49


def is_forwarded(text: Column | str, forwarded_from: Column | str) -> Column:
    markers = "(?im)" + "|".join(f"(?:{p})" for p in lex.FORWARD_MARKERS)
    named = F.length(F.coalesce(col(forwarded_from), F.lit(""))) > 0
    return named | col(text).rlike(markers)


def clean_speaker(name: Column) -> Column:
    bare = F.regexp_replace(name, r"(?i)^(?:from|by|@)\s*", "")
    bare = F.regexp_replace(bare, r"(?i)\s*(?:said|wrote|tweeted|stated).*$", "")
    bare = F.regexp_replace(bare, r"[^\p{L}\p{N}_\s\-.]", "")
    bare = strip(F.regexp_replace(bare, r"\s+", " "))
    return F.when(F.length(bare) > 0, bare).otherwise("unknown")


def looks_like_quote(text: Column | str) -> Column:
    """At least two of five cues."""
    t = col(text)
    low = F.lower(t)
    cues = (
        t.startswith('"'),
        t.endswith('"'),
        count_literal(t, "I ") >= 2,
        F.contains(low, F.lit("my ")) | F.contains(low, F.lit("our "))
        | F.contains(low, F.lit("we ")) | F.contains(low, F.lit("us ")),
        count_char(t, "!") >= 2,
    )
    total = cues[0].cast("int")
    for cue in cues[1:]:
        total = total + cue.cast("int")
    return total >= 2


def forwarded_spans(text: Column, forwarded_from: Column) -> Column:
    """The whole text when the source is known, otherwise what follows the
    "forwarded from X:" marker."""
    none = F.array().cast(SPANS)
    source = F.coalesce(forwarded_from, F.lit(""))
    whole = span(F.lit(0), F.length(text), text, "forwarded", clean_speaker(source), 0.9, source)
    head = rf"(?s)^(.*?)(?-s:{lex.FORWARD_SOURCE})"

    def after(prefix: Column) -> Column:
        start = F.length(prefix)
        body = strip(F.substring(text, start + 1, F.length(text)))
        speaker = clean_speaker(F.regexp_extract(text, lex.FORWARD_SOURCE, 1))
        made = span(start, F.length(text), body, "forwarded", speaker, 0.8)
        return F.when(F.length(body) > 0, F.array(made)).otherwise(none)

    marked = F.when(
        F.contains(F.lower(text), F.lit("forwarded")) & text.rlike(lex.FORWARD_SOURCE), bind(F.regexp_extract(text, head, 0), after)
    ).otherwise(none)
    return F.when(F.length(source) > 0, F.array(whole)).otherwise(marked)


def _quote_after(rest: Column, max_quote_length: int, patterns) -> Column:
    """First quote within reach of the start of ``rest``, by pattern order, else
    the whole of it when it reads like a quote; null when neither."""
    options = []
    for _, pattern in patterns:
        near = rf"(?d)^(?s:(.{{0,{_REACH}}}?)){pattern}"
        options.append(
            F.when(
                rest.rlike(near),
                F.struct(
                    F.length(F.regexp_extract(rest, near, 1)).alias("start"),
                    F.length(F.regexp_extract(rest, near, 0)).alias("end"),
                    strip(F.regexp_extract(rest, near, 2)).alias("text"),
                ),
            )
        )
    whole = F.struct(F.lit(0).alias("start"), F.length(rest).alias("end"), rest.alias("text"))
    fits = (F.length(rest) > 0) & (F.length(rest) < max_quote_length) & looks_like_quote(rest)
    return F.coalesce(*options, F.when(fits, whole))


def _holds(text: str, name: str) -> str:
    return f"contains({text}, {sql_text(_CUES[name])})" if name in _CUES else "true"


def _attributions(text: str, strict_names: bool) -> Column:
    """Attribution phrases with pattern name, cleaned speaker and end offset."""

    def phrases(name: str, pattern: str) -> Column:
        # What follows a run of letters or blanks is never of the same kind, so
        # possessive repetition matches the same and never backtracks.
        pattern = pattern.replace("[a-z]+", "[a-z]++").replace(r"\s+", r"\s++")
        flagged = pattern if strict_names else f"(?i){pattern}"
        return F.transform(
            find_all(text, flagged, _holds("_low", name)),
            lambda m: F.struct(
                F.lit(name).alias("pattern"),
                clean_speaker(F.regexp_extract(m["match"], flagged, 1)).alias("speaker"),
                m["end"].alias("end"),
            ),
        )

    return F.concat(*[phrases(name, pattern) for name, pattern in lex.SPEAKER_PATTERNS])


def _attributed_spans(text: Column, attributions: Column, max_quote_length: int, patterns) -> Column:
    def quote(a: Column) -> Column:
        def placed(raw: Column) -> Column:
            lead = F.length(raw) - F.length(F.ltrim(raw, F.lit(" \t\n\r\x0b\x0c")))
            return bind(
                _quote_after(strip(raw), max_quote_length, patterns),
                lambda q: F.when(
                    q.isNotNull(),
                    F.struct(
                        (a["end"] + lead + q["start"]).cast("int").alias("start"),
                        (a["end"] + lead + q["end"]).cast("int").alias("end"),
                        q["text"].alias("text"),
                        F.lit("quoted").alias("span_type"),
                        a["speaker"].alias("speaker"),
                        F.lit(0.8).alias("confidence"),
                        F.lit(None).cast("string").alias("source"),
                        a["pattern"].alias("attribution_pattern"),
                    ),
                ),
            )

        return bind(F.substring(text, a["end"] + 1, F.length(text)), placed)

    return F.array_compact(F.transform(attributions, quote)).cast(SPANS)


def _standalone_spans(text: str, taken: Column, patterns) -> Column:
    """Add quotes without a named speaker, pattern by pattern, when they do not
    begin inside a span that is already there."""
    if not patterns:
        return taken
    (name, pattern), *rest = patterns
    flagged = f"(?md){pattern}"

    def make(m: Column) -> Column:
        body = strip(F.regexp_extract(m["match"], flagged, 1))
        return span(m["start"], m["end"], body, "quoted", F.lit("unknown"), 0.6, None, name)

    fresh = F.filter(
        F.transform(find_all(text, flagged, _holds(text, name)), make),
        lambda s: (F.length(s["text"]) >= 10)
        & ~F.exists(taken, lambda t: (t["start"] <= s["start"]) & (s["start"] < t["end"])),
    )
    return bind(F.concat(taken, fresh).cast(SPANS), lambda t: _standalone_spans(text, t, rest))


def quote_columns(
    df: DataFrame,
    text: str = "text",
    forwarded_from: str = "forwarded_from",
    detect_forwarded: bool = True,
    detect_quoted: bool = True,
    max_quote_length: int = MAX_QUOTE_LENGTH,
    curly: bool = False,
    strict_names: bool = False,
) -> DataFrame:
    """Add ``quote_spans``, ``quote_speakers``, ``has_quotes``, ``multi_speaker`` and
    ``span_count``.

    ``curly`` also accepts curly double quotes; ``strict_names`` wants speaker
    names capitalised.
    """
    df = df.withColumn("_body", F.coalesce(F.col(text), F.lit(""))).withColumn("_low", F.lower("_body"))
    body = F.col("_body")
    source = F.col(forwarded_from) if forwarded_from in df.columns else F.lit(None).cast("string")
    patterns = list(lex.QUOTE_PATTERNS)
    if curly:
        patterns.insert(1, lex.CURLY_DOUBLE)
    none = F.array().cast(SPANS)

    who = _attributions("_body", strict_names) if detect_quoted else F.array().cast(
        "array<struct<pattern:string,speaker:string,end:int>>"
    )
    df = df.withColumns(
        {"_who": who, "_forwarded": forwarded_spans(body, source) if detect_forwarded else none}
    )
    quoted = (
        bind(
            _attributed_spans(body, F.col("_who"), max_quote_length, patterns),
            lambda taken: _standalone_spans("_body", taken, patterns),
        )
        if detect_quoted
        else none
    )
    df = df.withColumn("_special", F.concat("_forwarded", quoted))
    author = span(F.lit(0), F.length(body), body, "author", F.lit("author"), 1.0)
    spans = (
        F.when(is_blank(body), none)
        .when(F.size("_special") == 0, F.array(author))
        .otherwise(fill_gaps(body, F.col("_special")))
    )
    speakers = F.concat(
        F.transform("_who", lambda a: a["speaker"]), F.transform("_special", lambda s: s["speaker"])
    )
    df = df.withColumns(
        {
            "quote_spans": spans,
            "quote_speakers": F.when(is_blank(body), F.array().cast("array<string>")).otherwise(
                F.array_sort(F.array_distinct(speakers))
            ),
        }
    )
    return df.withColumns(
        {
            "has_quotes": F.exists("quote_spans", lambda s: s["span_type"].isin("quoted", "forwarded")),
            "multi_speaker": F.size("quote_speakers") > 1,
            "span_count": F.size("quote_spans").cast("long"),
        }
    ).drop("_body", "_low", "_who", "_forwarded", "_special")


def author_text(spans: Column | str = "quote_spans") -> Column:
    """The author's own words: author spans joined by blanks."""
    own = F.filter(col(spans), lambda s: s["span_type"] == "author")
    return F.array_join(F.transform(own, lambda s: s["text"]), " ")


def span_rows(df: DataFrame, *keep: str) -> DataFrame:
    rows = df.select(*keep, F.posexplode_outer("quote_spans").alias("pos", "_s")).filter("_s IS NOT NULL")
    return rows.select(*keep, "pos", "_s.*")


def quote_stats(df: DataFrame) -> DataFrame:
    """One row of corpus totals; the spans are worked out once."""
    df = cut_lineage(df.select("has_quotes", "multi_speaker", "span_count", F.array_distinct("quote_spans.speaker").alias("speakers")))
    base = df.agg(
        F.count("*").alias("total_messages"),
        F.count_if("has_quotes").alias("messages_with_quotes"),
        F.count_if("multi_speaker").alias("multi_speaker_messages"),
        F.coalesce(F.sum("span_count"), F.lit(0)).alias("total_spans"),
    )
    speakers = (
        unnest(df, "speakers", "s")
        .filter("s <> 'author'")
        .agg(F.countDistinct("s").alias("unique_quoted_speakers"))
    )
    return base.join(F.broadcast(speakers), F.lit(True)).withColumns(
        {
            "avg_spans_per_message": F.round(F.col("total_spans") / F.col("total_messages"), 6),
            "quote_percentage": F.round(F.col("messages_with_quotes") / F.col("total_messages") * 100, 6),
        }
    )


def span_type_counts(df: DataFrame) -> DataFrame:
    return unnest(df, "quote_spans.span_type", "span_type").groupBy("span_type").agg(
        F.count("*").alias("count")
    )

