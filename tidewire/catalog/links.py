"""Link and domain queries."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.catalog.messages import messages, texts
from tidewire.catalog.registry import query, view
from tidewire.functions import lexicons as lex
from tidewire.functions.text import unnest
from tidewire.operators import links

_URL = (
    r"(?i)https?://[!$-_a-z]+|www\.[!$-_a-z]+"
    r"|(?:[a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?\.)+[a-z]{2,}(?:/[^\s]*)?"
)


def _any(domains) -> str:
    return "|".join(re.escape(d) for d in domains)


def category_sql(domain: str = "domain", exact: bool = False) -> str:
    left, right = (r"(?:^|\.)", "$") if exact else ("", "")
    return rf"""CASE WHEN regexp_matches({domain}, '{left}(?:{_any(lex.SOCIAL_DOMAINS)}){right}') THEN 'social'
    WHEN regexp_matches({domain}, '{left}(?:{_any(lex.NEWS_DOMAINS)}){right}') THEN 'news'
    WHEN regexp_matches({domain}, '\.(?:gov|mil|edu)$') THEN 'government' ELSE 'other' END"""


view(
    "v_urls",
    rf"""SELECT msg_id, i AS pos, url, lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#]*)', 1)) AS host FROM (
    SELECT msg_id, i, CASE WHEN regexp_matches(u, '(?i)^https?://') THEN u ELSE 'https://' || u END AS url
    FROM (SELECT msg_id, unnest(us) AS u, generate_subscripts(us, 1) AS i
          FROM (SELECT msg_id, regexp_extract_all(text, '{_URL}') AS us FROM v_texts)))""",
)
view(
    "v_links",
    r"""SELECT msg_id, pos, url,
    CASE WHEN starts_with(host, 'www.') THEN host[5:]
         WHEN len(string_split(host, '.')) > 2 THEN regexp_replace(host, '^[^.]*\.', '') ELSE host END AS domain,
    CASE WHEN starts_with(host, 'www.') THEN 'www'
         WHEN len(string_split(host, '.')) > 2 THEN string_split(host, '.')[1] ELSE '' END AS subdomain,
    regexp_replace(regexp_extract(url, '^[a-zA-Z]+://[^/?#]*([^?#]*)', 1), ';[^/]*$', '') AS path,
    regexp_extract(url, '^[a-zA-Z]+://[^?#]*\?([^#]*)', 1) AS query,
    regexp_extract(url, '#(.*)$', 1) AS fragment FROM v_urls WHERE host <> '' AND host <> 'www.'""",
)
view(
    "v_link_stats",
    f"""SELECT msg_id, count(*) AS total_links, count(DISTINCT domain) AS unique_domains,
    count(*) FILTER (cat = 'social') AS social_media_links, count(*) FILTER (cat = 'news') AS news_media_links,
    count(*) FILTER (cat = 'government') AS government_links, count(*) FILTER (cat = 'other') AS other_links
    FROM (SELECT *, {category_sql()} AS cat FROM v_links) GROUP BY msg_id""",
)


@query("K01 K02 K03 K04 F05", "SELECT msg_id, url, domain, subdomain, path, query, fragment FROM v_links")
def link_rows(spark: SparkSession, folder: str) -> DataFrame:
    return unnest(links.link_columns(texts(spark, folder)), "links", "l", "msg_id").select("msg_id", "l.*")


@query(
    "K05 K06 K07 U04",
    """SELECT t.msg_id, coalesce(total_links, 0) AS total_links, coalesce(unique_domains, 0) AS unique_domains,
    coalesce(round(unique_domains::DOUBLE / total_links, 6), 0.0) AS domain_diversity, f.domain AS most_frequent_domain,
    coalesce(social_media_links, 0) AS social_media_links, coalesce(news_media_links, 0) AS news_media_links,
    coalesce(government_links, 0) AS government_links, coalesce(other_links, 0) AS other_links
    FROM v_texts t LEFT JOIN v_link_stats s USING (msg_id)
    LEFT JOIN (SELECT msg_id, domain, row_number() OVER (PARTITION BY msg_id ORDER BY count(*) DESC, min(pos)) AS rn
               FROM v_links GROUP BY msg_id, domain) f ON f.msg_id = t.msg_id AND f.rn = 1""",
)
def link_statistics(spark: SparkSession, folder: str) -> DataFrame:
    return links.link_columns(texts(spark, folder)).select(
        "msg_id", "total_links", "unique_domains",
        F.round("domain_diversity", 6).alias("domain_diversity"),
        "most_frequent_domain", "social_media_links", "news_media_links", "government_links", "other_links",
    )


@query(
    "K05",
    "SELECT msg_id, domain, count(*) AS links FROM v_links GROUP BY msg_id, domain",
)
def message_domain_counts(spark: SparkSession, folder: str) -> DataFrame:
    rows = links.link_columns(texts(spark, folder))
    rows = rows.select("msg_id", F.explode_outer("domain_counts").alias("domain", "links"))
    return rows.filter("links IS NOT NULL")


@query(
    "K08 W04",
    """SELECT domain, count(*) AS count, round(count(*)::DOUBLE / (SELECT count(*) FROM v_messages), 6) AS frequency,
    min(CAST(date AS DATE)) AS first_seen, max(CAST(date AS DATE)) AS last_seen,
    count(DISTINCT l.msg_id) AS message_count, count(DISTINCT CAST(date AS DATE)) AS unique_days
    FROM v_links l JOIN v_messages m ON l.msg_id = m.msg_id GROUP BY domain ORDER BY count DESC, domain LIMIT 50""",
)
def top_domains(spark: SparkSession, folder: str) -> DataFrame:
    table = links.domain_table(links.link_columns(messages(spark, folder)), 50)
    return table


@query(
    "K09",
    f"""SELECT CASE cat WHEN 'social' THEN 'social_media' WHEN 'news' THEN 'news_media' ELSE cat END AS category,
    domain, count FROM (SELECT {category_sql()} AS cat, domain, count(*) AS count FROM v_links GROUP BY domain)""",
)
def domain_categories(spark: SparkSession, folder: str) -> DataFrame:
    return links.domains_by_category(links.link_columns(texts(spark, folder)))


@query(
    "K06",
    f"SELECT domain, {category_sql(exact=True)} AS category, count(*) AS links FROM v_links GROUP BY domain",
)
def domain_categories_exact(spark: SparkSession, folder: str) -> DataFrame:
    rows = links.domains_by_category(links.link_columns(texts(spark, folder)), exact=True)
    names = F.regexp_replace("category", "_media$", "")
    return rows.select("domain", names.alias("category"), F.col("count").alias("links"))


@query(
    "K10",
    """SELECT CAST(date AS DATE) AS day, CAST(sum(total_links) AS BIGINT) AS total_links,
    CAST(sum(unique_domains) AS BIGINT) AS unique_domains
    FROM v_link_stats s JOIN v_messages m USING (msg_id) GROUP BY 1""",
)
def daily_link_counts(spark: SparkSession, folder: str) -> DataFrame:
    return links.daily_links(links.link_columns(messages(spark, folder)))


@query(
    "K11",
    """SELECT dayname(date) AS weekday, round_even(avg(total_links), 2) AS total_links,
    round_even(avg(unique_domains), 2) AS unique_domains
    FROM v_link_stats s JOIN v_messages m USING (msg_id) GROUP BY 1""",
)
def weekday_link_means(spark: SparkSession, folder: str) -> DataFrame:
    return links.weekday_links(links.link_columns(messages(spark, folder)))


@query("K12", "SELECT domain, count(*) AS count FROM v_links GROUP BY domain")
def corpus_domains(spark: SparkSession, folder: str) -> DataFrame:
    return links.corpus_domain_counts(links.link_columns(texts(spark, folder)))


@query(
    "K13",
    """SELECT CAST(sum(total_links) AS BIGINT) AS total_links, CAST(sum(unique_domains) AS BIGINT) AS unique_domains,
    count(*) AS messages_with_links FROM v_link_stats""",
)
def link_totals(spark: SparkSession, folder: str) -> DataFrame:
    return links.link_summary(links.link_columns(texts(spark, folder)))


@query(
    "K14",
    """SELECT domain, count(*) AS total_links, count(DISTINCT CAST(date AS DATE)) AS unique_days,
    min(CAST(date AS DATE)) AS first_seen, max(CAST(date AS DATE)) AS last_seen,
    dense_rank() OVER (ORDER BY count(*) DESC) AS top_k_rank
    FROM v_links l JOIN v_messages m ON l.msg_id = m.msg_id GROUP BY domain
    ORDER BY total_links DESC, domain LIMIT 50""",
)
def domain_sidecar(spark: SparkSession, folder: str) -> DataFrame:
    return links.domain_sidecar(links.link_columns(messages(spark, folder)), 50)
