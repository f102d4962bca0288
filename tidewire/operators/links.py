"""Links: URL extraction, parsing, domain categories and domain rollups."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewire.functions import lexicons as lex
from tidewire.functions.text import bind, col, count_in, strip

_PARTS = r"^[a-zA-Z]+://([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


# What every match of ANY_URL holds: "://", or a dot inside.
_DOT_INSIDE = r"(?i)\.(?<=[a-z0-9]\.)[!$-_a-z]"


def extract_urls(text: Column | str) -> Column:
    """All URLs; the pattern, which is tried at every letter, runs only over texts that can hold one."""
    t = col(text)
    possible = F.contains(t, F.lit("://")) | t.rlike(_DOT_INSIDE)
    found = F.regexp_extract_all(t, F.lit(lex.ANY_URL), F.lit(0))
    return F.when(~possible, F.array().cast("array<string>")).otherwise(found)


def clean_url(url: Column) -> Column:
    url = strip(url)
    return F.when(url.rlike("(?i)^https?://"), url).otherwise(F.concat(F.lit("https://"), url))


def parse_url(url: Column) -> Column:
    """Struct of url, domain, subdomain, path, query and fragment."""

    def parse(u: Column) -> Column:
        host = F.lower(F.regexp_extract(u, _PARTS, 1))
        has_www = host.startswith("www.")
        labels = F.size(F.split(host, r"\."))
        split_first = (~has_www) & (labels > 2)
        domain = (
            F.when(has_www, F.substring(host, F.lit(5), F.length(host)))
            .when(split_first, F.regexp_replace(host, r"^[^.]*\.", ""))
            .otherwise(host)
        )
        subdomain = (
            F.when(has_www, "www").when(split_first, F.regexp_extract(host, r"^([^.]*)\.", 1)).otherwise("")
        )
        return F.struct(
            u.alias("url"),
            domain.alias("domain"),
            subdomain.alias("subdomain"),
            # Parameters of the last path segment (";...") are not part of the path.
            F.regexp_replace(F.regexp_extract(u, _PARTS, 2), r";[^/]*$", "").alias("path"),
            F.regexp_extract(u, _PARTS, 3).alias("query"),
            F.regexp_extract(u, _PARTS, 4).alias("fragment"),
        )

    return bind(url, parse)


def _alternatives(domains: tuple[str, ...]) -> str:
    return "|".join(re.escape(d) for d in domains)


def domain_category(domain: Column | str, exact: bool = False) -> Column:
    """social, news, government or other; the first that applies.

    The default matches a listed name anywhere in the domain; ``exact=True``
    accepts only the listed domain and its subdomains.
    """
    d = F.lower(col(domain))
    left, right = (r"(?:^|\.)", "$") if exact else ("", "")
    social = f"{left}(?:{_alternatives(lex.SOCIAL_DOMAINS)}){right}"
    news = f"{left}(?:{_alternatives(lex.NEWS_DOMAINS)}){right}"
    government = rf"\.(?:{'|'.join(lex.GOVERNMENT_SUFFIXES)})$"
    return (
        F.when(d.rlike(social), "social")
        .when(d.rlike(news), "news")
        .when(d.rlike(government), "government")
        .otherwise("other")
    )


def link_columns(df: DataFrame, text: str = "text", exact: bool = False) -> DataFrame:
    """Add ``links``, ``domains``, ``domain_counts`` and the per-message link statistics."""
    parsed = F.transform(
        extract_urls(F.coalesce(F.col(text), F.lit(""))), lambda u: parse_url(clean_url(u))
    )
    df = df.withColumn("links", F.filter(parsed, lambda x: x["domain"] != ""))
    df = df.withColumn("domains", F.transform("links", lambda x: x["domain"]))
    domains = F.col("domains")
    counts = F.transform(
        F.array_distinct(domains),
        lambda d: F.struct(d, F.size(F.filter(domains, lambda x: x == d)).cast("long")),
    )
    df = df.withColumn("domain_counts", F.map_from_entries(counts)).withColumn(
        "_categories", F.transform(domains, lambda d: domain_category(d, exact))
    )
    total = F.size(domains).cast("long")
    unique = F.size(F.array_distinct(domains)).cast("long")
    ranked = F.transform(
        F.array_distinct(domains),
        lambda d: F.struct(
            F.size(F.filter(domains, lambda x: x == d)).alias("n"),
            (-F.array_position(domains, d)).alias("first"),
            d.alias("domain"),
        ),
    )
    return df.withColumns(
        {
            "total_links": total,
            "unique_domains": unique,
            "domain_diversity": F.coalesce(
                F.try_divide(unique.cast("double"), total.cast("double")), F.lit(0.0)
            ),
            "most_frequent_domain": F.array_max(ranked)["domain"],
            "social_media_links": count_in(F.col("_categories"), ["social"]),
            "news_media_links": count_in(F.col("_categories"), ["news"]),
            "government_links": count_in(F.col("_categories"), ["government"]),
            "other_links": count_in(F.col("_categories"), ["other"]),
        }
    ).drop("_categories")


def domain_table(df: DataFrame, top_k: int | None = 50) -> DataFrame:
    """Domains with occurrences, first and last day seen and distinct messages.

    ``domains`` may hold a domain several times per message. Distinct messages
    are counted from the per-message map, one row per (message, domain), so no
    distinct-count shuffle over message ids is needed.
    """
    per_message = df.select(F.to_date("date").alias("day"), F.explode_outer("domain_counts").alias("domain", "n"))
    per_message = per_message.filter("n IS NOT NULL")
    per_day = per_message.groupBy("domain", "day").agg(F.sum("n").alias("n"), F.count("*").alias("messages"))
    table = per_day.groupBy("domain").agg(
        F.sum("n").alias("count"),
        F.min("day").alias("first_seen"),
        F.max("day").alias("last_seen"),
        F.sum("messages").alias("message_count"),
        F.count("*").alias("unique_days"),
    )
    total = df.agg(F.count("*").alias("_messages"))
    table = table.join(F.broadcast(total), F.lit(True)).select(
        "domain", "count", F.round(F.col("count") / F.col("_messages"), 6).alias("frequency"),
        "first_seen", "last_seen", "message_count", "unique_days",
    )
    return table if top_k is None else table.orderBy(F.desc("count"), "domain").limit(top_k)


def domain_sidecar(df: DataFrame, top_k: int = 50) -> DataFrame:
    """Most linked domains with days seen and a dense rank by link count.

    Any domain of the first ``top_k`` is in the top-k rows, so ranking happens
    after the limit on a bounded number of rows.
    """
    top = domain_table(df, top_k)
    return top.select(
        "domain",
        F.col("count").alias("total_links"),
        "unique_days", "first_seen", "last_seen",
        F.dense_rank().over(W.orderBy(F.desc("count"))).cast("long").alias("top_k_rank"),
    )


def domains_by_category(df: DataFrame, exact: bool = False) -> DataFrame:
    """Category, domain and count over the corpus."""
    table = df.select(F.explode_outer("domain_counts").alias("domain", "n")).filter("n IS NOT NULL").groupBy("domain").agg(
        F.sum("n").alias("count")
    )
    names = {"social": "social_media", "news": "news_media"}
    category = domain_category("domain", exact)
    pairs = [F.lit(x) for kv in names.items() for x in kv]
    return table.select(
        F.coalesce(F.try_element_at(F.create_map(*pairs), category), category).alias("category"),
        "domain",
        "count",
    )


def daily_links(df: DataFrame) -> DataFrame:
    """Links and per-message unique domains summed per day, messages with links only."""
    return (
        df.filter(F.col("total_links") > 0)
        .groupBy(F.to_date("date").alias("day"))
        .agg(F.sum("total_links").alias("total_links"), F.sum("unique_domains").alias("unique_domains"))
    )


def weekday_links(df: DataFrame) -> DataFrame:
    """Mean links and unique domains per weekday, messages with links only."""
    return (
        df.filter(F.col("total_links") > 0)
        .groupBy(F.date_format("date", "EEEE").alias("weekday"))
        .agg(
            F.bround(F.avg("total_links"), 2).alias("total_links"),
            F.bround(F.avg("unique_domains"), 2).alias("unique_domains"),
        )
    )


def corpus_domain_counts(df: DataFrame) -> DataFrame:
    return (
        df.select(F.explode_outer("domain_counts").alias("domain", "n"))
        .filter("n IS NOT NULL")
        .groupBy("domain")
        .agg(F.sum("n").alias("count"))
    )


def link_summary(df: DataFrame) -> DataFrame:
    return df.agg(
        F.coalesce(F.sum("total_links"), F.lit(0)).alias("total_links"),
        F.coalesce(F.sum("unique_domains"), F.lit(0)).alias("unique_domains"),
        F.count_if(F.col("total_links") > 0).alias("messages_with_links"),
    )
