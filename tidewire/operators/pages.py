"""Fields from HTML pages: mail, phone, ids, headings and the assembled record."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions.text import clean_text, col, first_present
from tidewire.operators.sections import sections

SECTION = "struct<text:string,items:array<string>,link:string,name:string>"


def section_after(
    html: Column | str, tag: str = "h2", heading: str | None = None, lenient: bool = False, nth_list: int = 1
) -> Column:
    """What follows a heading: text block, list items, first link, name-like text.

    An Arrow function, because nesting cannot be read with regular expressions.
    """

    @F.pandas_udf(SECTION)
    def read(pages: pd.Series) -> pd.DataFrame:
        from tidewire.functions.html import after_heading

        rows = [after_heading(p, tag, heading, lenient, nth_list) for p in pages]
        return pd.DataFrame(rows, columns=["text", "items", "link", "name"])

    return read(col(html))


def visible_text(html: Column | str) -> Column:
    """Page text without scripts, styles, comments and tags (regex path)."""
    bare = F.regexp_replace(col(html), r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->", " ")
    return clean_text(F.regexp_replace(bare, r"<[^>]*>", " "))


def title(html: Column | str) -> Column:
    """Text of the first h1."""
    inner = F.regexp_extract(col(html), r"(?is)<h1[^>]*>(.*?)</h1>", 1)
    return clean_text(F.regexp_replace(inner, r"<[^>]*>", " "))


def list_items(html: Column | str) -> Column:
    """Items of all lists on the page (regex path)."""
    raw = F.regexp_extract_all(col(html), F.lit(r"(?is)<li[^>]*>(.*?)</li>"), F.lit(1))
    items = F.transform(raw, lambda x: clean_text(F.regexp_replace(x, r"<[^>]*>", " ")))
    return F.filter(items, lambda x: x.isNotNull())


def mail(html: Column | str) -> Column:
    """First mailto address, otherwise the first text piece that contains an @."""
    linked = F.regexp_extract(col(html), r"""(?i)href=["']mailto:([^"'?]*)""", 1)
    piece = F.regexp_extract(col(html), r">([^<>]*@[^<>]*)<", 1)
    return first_present(clean_text(linked), clean_text(piece))


def phone(html: Column | str) -> Column:
    """First tel: link, otherwise the first run of at least eight digits, digits only."""
    linked = F.regexp_replace(F.regexp_extract(col(html), r"""(?i)href=["']tel:([^"']*)""", 1), r"[^0-9+]", "")
    run = F.regexp_extract(visible_text(html), r"(\+?\d[\d \-]{6,}\d)", 1)
    return first_present(linked, F.regexp_replace(run, r"[^\d+]", ""))


def tri_state(c: Column | str, no: str, yes: str) -> Column:
    """False when ``no`` matches, true when ``yes`` does, otherwise null."""
    text = F.coalesce(col(c), F.lit(""))
    return F.when(text.rlike(f"(?i){no}"), False).when(text.rlike(f"(?i){yes}"), True)


def first_integer(c: Column | str) -> Column:
    return F.regexp_extract(col(c), r"\d+", 0).try_cast("long")


def page_identifier(url: Column | str, field: Column | str, in_url: str, in_field: str) -> Column:
    """Identifier from the address, otherwise from a field."""
    return first_present(
        F.regexp_extract(col(url), in_url, 1), F.regexp_extract(F.coalesce(col(field), F.lit("")), in_field, 0)
    )


def prune(c: Column) -> Column:
    """JSON text of a record without null fields."""
    return F.to_json(c, {"ignoreNullFields": "true"})


def none_if_empty(array: Column) -> Column:
    return F.when(F.size(array) > 0, array)


def page_records(df: DataFrame, html: str = "html", tag: str = "h1", key: str = "page_id") -> DataFrame:
    """Nested record per page, pruned of empty fields, as JSON."""
    found = sections(df, key, html, tag).select(F.col(key), F.struct("text", "items", "link", "name").alias("_s"))
    rows = df.join(found, key)
    record = F.struct(
        F.col("url").alias("source_url"),
        page_identifier("url", "_s.text", r"/(\d+)(?:\?|$)", r"[0-9a-fA-F-]{10,}").alias("page_code"),
        title(html).alias("title"),
        F.struct(
            F.col("_s.text").alias("about"), F.col("_s.link").alias("link"), F.col("_s.name").alias("name"),
            mail(html).alias("mail"), phone(html).alias("phone"),
        ).alias("contact"),
        none_if_empty(F.col("_s.items")).alias("items"),
    )
    return rows.select(key, prune(record).alias("record"))
