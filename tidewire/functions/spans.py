"""Match offsets and gap filling on arrays inside a row.

Offsets are code points. Spark's regex functions return no positions, but the
pieces between matches and the matches themselves alternate, so their lengths
add up to every start.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewire.functions.text import bind

MATCHES = "array<struct<start:int,end:int,match:string>>"
SPANS = (
    "array<struct<start:int,end:int,text:string,span_type:string,speaker:string,"
    "confidence:double,source:string,attribution_pattern:string>>"
)


def sql_text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def find_all(text: str, pattern: str, only_if: str = "true") -> Column:
    """All matches in column ``text`` as ``array<struct<start, end, match>>``.

    The split that yields the positions runs only for rows with a match, the pattern
    itself only where the SQL condition ``only_if`` holds, which every match must imply. Written
    as SQL text because building the same tree call by call is slow on the driver.
    """
    p = sql_text(pattern)
    return F.expr(
        f"""transform(array(CASE WHEN {only_if} THEN regexp_extract_all({text}, {p}, 0) ELSE cast(array() AS array<string>) END), found ->
          CASE WHEN size(found) = 0 THEN cast(array() AS {MATCHES}) ELSE
            transform(array(split({text}, {p}, -1)), pieces ->
              aggregate(
                sequence(0, size(found) - 1),
                named_struct('at', 0, 'out', cast(array() AS {MATCHES})),
                (acc, i) -> named_struct(
                  'at', acc.at + length(pieces[i]) + length(found[i]),
                  'out', cast(array_append(acc.out, named_struct(
                    'start', acc.at + length(pieces[i]),
                    'end', acc.at + length(pieces[i]) + length(found[i]),
                    'match', found[i])) AS {MATCHES})),
                acc -> acc.out))[0]
          END)[0]"""
    )


def split_with_offsets(text: str, pattern: str) -> Column:
    """Pieces of column ``text`` between the matches of ``pattern``, with offsets."""
    return bind(
        find_all(text, pattern),
        lambda seps: F.transform(
            F.sequence(F.lit(0), F.size(seps)),
            lambda i: bind(
                F.struct(
                    F.when(i == 0, F.lit(0)).otherwise(F.get(seps, i - 1)["end"]).alias("start"),
                    F.coalesce(F.get(seps, i)["start"], F.length(text)).alias("end"),
                ),
                lambda e: F.struct(
                    e["start"].alias("start"),
                    e["end"].alias("end"),
                    F.substring(F.col(text), e["start"] + 1, e["end"] - e["start"]).alias("match"),
                ),
            ),
        ),
    )


def span(
    start: Column, end: Column, text: Column, kind: str, speaker: Column, confidence: float,
    source: Column | None = None, pattern: str | None = None,
) -> Column:
    return F.struct(
        start.cast("int").alias("start"),
        end.cast("int").alias("end"),
        text.alias("text"),
        F.lit(kind).alias("span_type"),
        speaker.alias("speaker"),
        F.lit(confidence).alias("confidence"),
        (F.lit(None).cast("string") if source is None else source).alias("source"),
        F.lit(pattern).cast("string").alias("attribution_pattern"),
    )


def by_start(spans: Column) -> Column:
    """Spans by start; equal starts keep their order."""
    numbered = F.transform(spans, lambda s, i: F.struct(s["start"].alias("at"), i.alias("i"), s.alias("s")))
    return F.transform(F.array_sort(numbered), lambda n: n["s"])


def fill_gaps(text: Column, spans: Column) -> Column:
    """Insert author spans where no span covers the text, blank gaps excluded."""
    none = F.array().cast(SPANS)

    def gap(start: Column, end: Column) -> Column:
        body = F.trim(F.substring(text, start + 1, end - start), F.lit(" \t\n\r\x0b\x0c"))
        made = span(start, end, body, "author", F.lit("author"), 1.0)
        return F.when((start < end) & (F.length(body) > 0), F.array(made)).otherwise(none)

    zero = F.struct(F.lit(0).alias("at"), none.alias("out"))

    def step(acc: Column, s: Column) -> Column:
        out = F.concat(acc["out"], gap(acc["at"], s["start"]), F.array(s)).cast(SPANS)
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    return F.aggregate(
        by_start(spans), zero, step, lambda acc: F.concat(acc["out"], gap(acc["at"], F.length(text)))
    )
