"""Text columns: tokens, words, sentences, counts and small formatting helpers.

Everything here is a JVM-side ``Column``. Tokens are maximal runs of letters,
digits and underscore. Java's ``\\b`` and ``\\w`` disagree with other engines on
accented letters, so boundaries are spelled out with explicit classes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITESPACE = " \t\n\r\x0b\x0c"
WORD = r"[\p{L}\p{N}_]"
TOKEN = r"[\p{L}\p{N}_]+"
NOT_WORD = r"[^\p{L}\p{N}_]+"
NOT_AFTER_WORD = r"(?<![\p{L}\p{N}_])"
NOT_BEFORE_WORD = r"(?![\p{L}\p{N}_])"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``.

    Catalyst inlines an expression into every lambda that mentions it, so a
    tokenisation used inside a ``filter`` would run once per element. Passing it
    through a one-element ``transform`` makes it a lambda variable instead.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def unnest(df: DataFrame, array: Column | str, name: str, *keep: Column | str) -> DataFrame:
    """``keep`` columns and one row per element of ``array``, as column ``name``.

    A plain ``explode`` makes the optimizer infer "array is not empty" and push it
    below the projection that computes the array, which then runs twice. The outer
    form followed by a null filter does not.
    """
    return df.select(*keep, F.explode_outer(array).alias(name)).filter(F.col(name).isNotNull())


def strip(c: Column | str) -> Column:
    return F.trim(col(c), F.lit(WHITESPACE))


def is_blank(c: Column | str) -> Column:
    return F.length(strip(F.coalesce(col(c), F.lit("")))) == 0


def tokens(c: Column | str) -> Column:
    """Lower-cased word tokens, as what lies between everything else: a split takes half the time of a search for each."""
    return F.array_remove(F.split(F.lower(col(c)), NOT_WORD), "")


def words(c: Column | str) -> Column:
    """Whitespace-separated words; punctuation stays attached."""
    stripped = strip(c)
    return F.when(F.length(stripped) == 0, F.array().cast("array<string>")).otherwise(
        F.split(stripped, r"\s+")
    )


def sentences(c: Column | str) -> Column:
    """Pieces between sentence-ending punctuation, trimmed, blanks dropped."""
    pieces = F.transform(F.split(col(c), r"[.!?]+\s+"), strip)
    return F.filter(pieces, lambda s: F.length(s) > 0)


def count_char(c: Column | str, char: str) -> Column:
    text = col(c)
    # replace looks for bytes, translate takes the text apart letter by letter
    return (F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))).cast("long")


def count_literal(c: Column | str, literal: str) -> Column:
    """Non-overlapping occurrences of a literal string."""
    text = col(c)
    removed = F.length(text) - F.length(F.replace(text, F.lit(literal), F.lit("")))
    return F.floor(removed / len(literal)).cast("long")


def count_matches(c: Column | str, pattern: str, cues: Sequence[str] = ()) -> Column:
    """Matches of ``pattern``; with ``cues``, one of which every match holds, other texts are not searched."""
    found = F.regexp_count(col(c), F.lit(pattern)).cast("long")
    return F.when(~holds(c, cues), F.lit(0).cast("long")).otherwise(found) if cues else found


def holds(c: Column | str, literals: Sequence[str]) -> Column:
    """Whether the text holds one of the literals; far cheaper than a regular expression, which tries every letter."""
    return reduce(lambda a, b: a | b, [F.contains(col(c), F.lit(x)) for x in literals])


def count_in(array: Column, vocabulary: Iterable[str]) -> Column:
    """How many elements of ``array`` belong to ``vocabulary``."""
    members = list(vocabulary)
    return F.size(F.filter(array, lambda t: t.isin(members))).cast("long")


def word_start(alternatives: Sequence[str]) -> str:
    """Java pattern for one of the alternatives at the start of a word.

    Each begins with a letter. Their first letters are asked for before anything
    else, so nearly every place of a text fails on one character.
    """
    firsts = "".join(sorted({a[0] for a in alternatives}))
    return f"(?=[{firsts}]){NOT_AFTER_WORD}(?:{'|'.join(alternatives)})"


def one_of(words: Iterable[str]) -> str:
    """Java pattern for the given words of letters; what several begin with is tried once."""

    def branch(ends: set[str]) -> str:
        by_first: dict[str, set[str]] = {}
        for end in ends - {""}:
            by_first.setdefault(end[0], set()).add(end[1:])
        parts = [first + branch(rest) for first, rest in sorted(by_first.items())]
        if "" in ends:
            return f"(?:{'|'.join(parts)})?" if parts else ""
        return parts[0] if len(parts) == 1 else f"(?:{'|'.join(parts)})"

    return branch(set(words))


def whole_word(alternatives: str) -> str:
    """Java pattern for the alternatives as whole words."""
    return f"{NOT_AFTER_WORD}(?:{alternatives}){NOT_BEFORE_WORD}"


def preview(c: Column | str, length: int = 100) -> Column:
    text = col(c)
    return F.when(
        F.length(text) > length, F.concat(F.substring(text, 1, length), F.lit("..."))
    ).otherwise(text)


def truncate(c: Column | str, max_length: int = 50, ellipsis: str = "...") -> Column:
    """Cut to ``max_length`` characters, ellipsis included."""
    text = col(c).cast("string")
    return F.when(F.length(text) <= max_length, text).otherwise(
        F.concat(F.substring(text, 1, max_length - len(ellipsis)), F.lit(ellipsis))
    )


def safe_divide(numerator: Column | str, denominator: Column | str, default: float = 0.0) -> Column:
    n, d = col(numerator).try_cast("double"), col(denominator).try_cast("double")
    return F.coalesce(F.try_divide(n, d), F.lit(default))


def clean_text(c: Column | str) -> Column:
    """Collapse whitespace and trim; empty becomes null."""
    collapsed = strip(F.regexp_replace(col(c), r"\s+", " "))
    return F.when(F.length(collapsed) > 0, collapsed)


def first_present(*candidates: Column) -> Column:
    """First candidate that is neither null nor empty."""
    return F.coalesce(*[F.when(F.length(c) > 0, c) for c in candidates])


def split_list(c: Column | str, separators: str = r"(?i)[,\n•/]| og | eller ") -> Column:
    """Split a listing into cleaned, non-empty parts."""
    parts = F.transform(F.split(F.coalesce(col(c), F.lit("")), separators, -1), clean_text)
    return F.filter(parts, lambda p: p.isNotNull())


def band(c: Column | str, limits: Sequence[tuple[float, str]], lowest: str, missing: str) -> Column:
    """Name of the first band whose lower limit is reached; limits descend."""
    score = col(c).try_cast("double")
    chain = F.when(score.isNull(), missing)
    for limit, name in limits:
        chain = chain.when(score >= limit, name)
    return chain.otherwise(lowest)


def rounded(c: Column, digits: int) -> Column:
    """Half-even rounding, the rule pandas and numpy use."""
    return F.bround(c, digits)


def epoch_micros(c: Column | str) -> Column:
    return F.unix_micros(col(c).cast("timestamp"))
