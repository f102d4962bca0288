"""Page queries. Pages carry no contact data, so a contact block made from the page
number is appended, in SQL as well."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.catalog.registry import query, view
from tidewire.functions.text import clean_text, first_present, split_list
from tidewire.operators import pages, sections
from tidewire.sources.tables import read_table

view(
    "v_pages",
    """SELECT page_id, url, html || CASE page_id % 4
      WHEN 0 THEN '<h2>Contact</h2><p>Jane Doe</p><a href="mailto:jane' || page_id || '@example.org">mail</a><a href="tel:+47 22 33 ' || (page_id % 90 + 10) || ' 44">call</a>'
      WHEN 1 THEN '<h2>Contact</h2><div>write to  info' || page_id || '@example.org </div><p>tel 900 10 ' || (page_id % 900 + 100) || '</p>'
      WHEN 2 THEN '<h2>Openings</h2><p>' || page_id || ' places, remote work not possible</p><ul><li>one, two</li><li>three</li></ul>'
      ELSE '<h2>Openings</h2><p>some places / remote work is possible</p>' END AS html FROM pages""",
)
_STRIP = r"nullif(trim(regexp_replace({}, '\s+', ' ', 'g')), '')"
_VISIBLE = _STRIP.format(
    r"regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g')"
)


def contact_pages(spark: SparkSession, folder: str) -> DataFrame:
    df = read_table(spark, folder, "pages")
    n = F.col("page_id")
    text = n.cast("string")
    extra = (
        F.when(n % 4 == 0, F.concat(
            F.lit('<h2>Contact</h2><p>Jane Doe</p><a href="mailto:jane'), text,
            F.lit('@example.org">mail</a><a href="tel:+47 22 33 '), (n % 90 + 10).cast("string"), F.lit(' 44">call</a>')))
        .when(n % 4 == 1, F.concat(
            F.lit("<h2>Contact</h2><div>write to  info"), text, F.lit("@example.org </div><p>tel 900 10 "),
            (n % 900 + 100).cast("string"), F.lit("</p>")))
        .when(n % 4 == 2, F.concat(
            F.lit("<h2>Openings</h2><p>"), text,
            F.lit(" places, remote work not possible</p><ul><li>one, two</li><li>three</li></ul>")))
        .otherwise(F.lit("<h2>Openings</h2><p>some places / remote work is possible</p>"))
    )
    return df.select("page_id", "url", F.concat("html", extra).alias("html"))


@query("S14 H01", f"SELECT page_id, {_VISIBLE} AS body FROM v_pages")
def page_texts(spark: SparkSession, folder: str) -> DataFrame:
    return contact_pages(spark, folder).select("page_id", pages.visible_text("html").alias("body"))


@query(
    "H02 H12",
    f"""SELECT page_id, coalesce({_STRIP.format(r"regexp_replace(regexp_extract(html, '(?is)<h5[^>]*>(.*?)</h5>', 1), '<[^>]*>', ' ', 'g')")},
    {_STRIP.format(r"regexp_replace(regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1), '<[^>]*>', ' ', 'g')")}) AS title FROM v_pages""",
)
def page_titles(spark: SparkSession, folder: str) -> DataFrame:
    missing = clean_text(F.regexp_extract("html", r"(?is)<h5[^>]*>(.*?)</h5>", 1))
    return contact_pages(spark, folder).select("page_id", first_present(missing, pages.title("html")).alias("title"))


@query(
    "H05",
    rf"""SELECT page_id, i AS pos, item FROM (SELECT page_id, unnest(items) AS item, generate_subscripts(items, 1) AS i FROM (
    SELECT page_id, list_filter(list_transform(regexp_extract_all(html, '(?is)<li[^>]*>(.*?)</li>', 1),
      lambda x: {_STRIP.format("regexp_replace(x, '<[^>]*>', ' ', 'g')")}), lambda x: x IS NOT NULL) AS items FROM v_pages))""",
)
def page_list_items(spark: SparkSession, folder: str) -> DataFrame:
    rows = contact_pages(spark, folder).select("page_id", F.posexplode(pages.list_items("html")).alias("p", "item"))
    return rows.select("page_id", (F.col("p") + 1).cast("long").alias("pos"), "item")


_MAIL = f"""SELECT page_id, coalesce(nullif(regexp_extract(html, '(?i)href=["'']mailto:([^"''?]*)', 1), ''),
    {_STRIP.format("regexp_extract(html, '>([^<>]*@[^<>]*)<', 1)")}) AS mail FROM v_pages"""


@query("H06", _MAIL)
def page_mail(spark: SparkSession, folder: str) -> DataFrame:
    return contact_pages(spark, folder).select("page_id", pages.mail("html").alias("mail"))


_PHONE = rf"""SELECT page_id, coalesce(nullif(regexp_replace(regexp_extract(html, '(?i)href=["'']tel:([^"'']*)', 1), '[^0-9+]', '', 'g'), ''),
    nullif(regexp_replace(regexp_extract({_VISIBLE}, '(\+?\d[\d \-]{{6,}}\d)', 1), '[^\d+]', '', 'g'), '')) AS phone FROM v_pages"""


@query("H07", _PHONE)
def page_phone(spark: SparkSession, folder: str) -> DataFrame:
    return contact_pages(spark, folder).select("page_id", pages.phone("html").alias("phone"))


@query(
    "H08 H09 H10",
    rf"""SELECT page_id, CASE WHEN regexp_matches(html, '(?i)remote.*not possible') THEN false
    WHEN regexp_matches(html, '(?i)remote.*possible') THEN true END AS remote,
    try_cast(nullif(regexp_extract(regexp_extract(html, '<h2>Openings</h2><p>(.*?)</p>', 1), '\d+'), '') AS BIGINT) AS openings,
    coalesce(nullif(regexp_extract(url, '/(\d+)(?:\?|$)', 1), ''), nullif(regexp_extract(html, 'info\d+'), '')) AS code FROM v_pages""",
)
def page_fields(spark: SparkSession, folder: str) -> DataFrame:
    section = F.regexp_extract("html", r"<h2>Openings</h2><p>(.*?)</p>", 1)
    return contact_pages(spark, folder).select(
        "page_id",
        pages.tri_state("html", "remote.*not possible", "remote.*possible").alias("remote"),
        pages.first_integer(section).alias("openings"),
        pages.page_identifier("url", "html", r"/(\d+)(?:\?|$)", r"info\d+").alias("code"),
    )


@query(
    "H03",
    """SELECT page_id, i AS pos, part FROM (SELECT page_id, unnest(ps) AS part, generate_subscripts(ps, 1) AS i FROM (
    SELECT page_id, list_filter(list_transform(regexp_split_to_array(regexp_extract(html, '<h2>Openings</h2><p>(.*?)</p>', 1),
      '(?i)[,\\n•/]| og | eller '), lambda x: nullif(trim(x), '')), lambda x: x IS NOT NULL) AS ps FROM v_pages))""",
)
def page_split_fields(spark: SparkSession, folder: str) -> DataFrame:
    section = F.regexp_extract("html", r"<h2>Openings</h2><p>(.*?)</p>", 1)
    rows = contact_pages(spark, folder).select("page_id", F.posexplode(split_list(section)).alias("p", "part"))
    return rows.select("page_id", (F.col("p") + 1).cast("long").alias("pos"), "part")


@query(
    "H04",
    f"""SELECT page_id, {_STRIP.format("regexp_extract(html, '<h2>(?:Contact|Openings)</h2><(?:p|div)>(.*?)</', 1)")} AS block FROM v_pages""",
)
def page_heading_texts(spark: SparkSession, folder: str) -> DataFrame:
    df = contact_pages(spark, folder)
    exact = sections.sections(df, tag="h2", heading="Contact").select("page_id", F.col("text").alias("exact"))
    loose = sections.sections(df, tag="h2", heading="opening", lenient=True).select("page_id", F.col("text").alias("loose"))
    return exact.join(loose, "page_id").select("page_id", first_present(F.col("exact"), F.col("loose")).alias("block"))


def _names(names: tuple[str, ...]) -> str:
    return ", ".join(f"'{n}'" for n in names)


_DECODED = "tok"
for _reference, _char in sections.REFERENCES:
    _DECODED = f"""replace({_DECODED}, '{_reference}', '{_char.replace("'", "''")}')"""
_TOKEN = sections.TOKEN.replace("'", "''")


def sections_sql(source: str, tag: str) -> str:
    """What follows the first heading of every page, from the tags in order."""
    def end(block: str) -> str:
        return rf"""min(CASE WHEN i > {block}.i AND (({block}.name = 'p' AND ((opens AND name IN ({_names(sections.ENDS_PARAGRAPH)})) OR (closes AND name = 'p')))
          OR ({block}.name NOT IN ('p', 'div') AND closes AND name = {block}.name) OR depth < {block}.depth) THEN i END) OVER k"""

    def first(condition: str) -> str:
        return f"min(CASE WHEN {condition} THEN {{'i': i, 'name': name, 'depth': depth}} END) OVER k"

    return rf"""WITH t AS (SELECT page_id, unnest(toks) AS tok, generate_subscripts(toks, 1) AS i FROM (SELECT page_id, regexp_extract_all(html, '{_TOKEN}') AS toks FROM {source})),
    n AS (SELECT *, CASE WHEN regexp_matches(tok, '(?i)^<(!|script\b|style\b)') THEN '' ELSE lower(regexp_extract(tok, '^</?([A-Za-z][A-Za-z0-9]*)', 1)) END AS name FROM t),
    o AS (SELECT *, name <> '' AND NOT starts_with(tok, '</') AS opens, name <> '' AND starts_with(tok, '</') AS closes,
      CASE WHEN NOT starts_with(tok, '<') THEN nullif(trim(regexp_replace({_DECODED}, '\s+', ' ', 'g')), '') END AS words FROM n),
    d AS (SELECT *, sum(CASE WHEN name NOT IN ({_names(sections.NESTING)}) OR ends_with(tok, '/>') THEN 0 WHEN opens THEN 1 ELSE -1 END) OVER (PARTITION BY page_id ORDER BY i) AS depth FROM o),
    h AS (SELECT page_id, min(i) FILTER (name = '{tag}' AND opens) AS a FROM d GROUP BY 1),
    f AS (SELECT h.page_id, coalesce(min(i) FILTER (name = '{tag}' AND closes AND i > a), min(a)) AS start FROM h JOIN d USING (page_id) WHERE a IS NOT NULL GROUP BY 1),
    r AS (SELECT d.*, sum(CAST(opens AND name = 'ul' AS INTEGER)) OVER (PARTITION BY page_id ORDER BY i) AS u FROM d JOIN f USING (page_id) WHERE i > start),
    s AS (SELECT *, {first(f"opens AND name IN ({_names(sections.TEXT_BLOCKS)})")} AS tb, {first(f"opens AND name IN ({_names(sections.NAME_BLOCKS)})")} AS nb, {first("opens AND name = 'ul' AND u = 1")} AS lb
      FROM r WINDOW k AS (PARTITION BY page_id)),
    e AS (SELECT *, coalesce({end('tb')}, 2147483647) AS te, coalesce({end('nb')}, 2147483647) AS ne, coalesce(min(CASE WHEN i > lb.i AND depth < lb.depth THEN i END) OVER k, 2147483647) AS le
      FROM s WINDOW k AS (PARTITION BY page_id)),
    l AS (SELECT *, sum(CAST(i > lb.i AND i < le AND opens AND name = 'li' AND depth = lb.depth AS INTEGER)) OVER (PARTITION BY page_id ORDER BY i) AS item FROM e),
    x AS (SELECT page_id, string_agg(words, ' ' ORDER BY i) FILTER (i > tb.i AND i < te) AS text,
      arg_min(regexp_extract(tok, '(?is)\shref\s*=\s*["'']?([^"''\s>]+)', 1), i) FILTER (opens AND name = 'a' AND regexp_extract(tok, '(?is)\shref\s*=\s*["'']?([^"''\s>]+)', 1) <> '') AS link,
      arg_min(words, i) FILTER (i > nb.i AND i < ne AND words IS NOT NULL AND NOT regexp_matches(words, '[@\d]') AND len(string_split(words, ' ')) <= 5) AS name,
      count(DISTINCT item) FILTER (i > lb.i AND i < le AND item > 0 AND words IS NOT NULL) AS items FROM l GROUP BY 1),
    y AS (SELECT page_id, string_agg(t, '|' ORDER BY item) AS listed FROM (
      SELECT page_id, item, string_agg(words, ' ' ORDER BY i) AS t FROM l WHERE i > lb.i AND i < le AND item > 0 AND words IS NOT NULL GROUP BY 1, 2) GROUP BY 1)
    SELECT p.page_id, text, coalesce(items, 0) AS items, coalesce(listed, '') AS listed, link, name FROM {source} p LEFT JOIN x USING (page_id) LEFT JOIN y USING (page_id)"""


view("v_sections", sections_sql("v_pages", "h1"))


@query("H03 H04 H05 H11", "SELECT page_id, text, CAST(items AS INTEGER) AS items, listed, link, name FROM v_sections")
def page_sections(spark: SparkSession, folder: str) -> DataFrame:
    found = sections.sections(contact_pages(spark, folder), tag="h1")
    return found.select("page_id", "text", F.size("items").alias("items"), F.array_join("items", "|").alias("listed"), "link", "name")


@query("H12 N18")
def page_records(spark: SparkSession, folder: str) -> DataFrame:
    return pages.page_records(contact_pages(spark, folder))


_H1 = _STRIP.format(r"regexp_replace(regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1), '<[^>]*>', ' ', 'g')")


@query(
    "H03 H09 H12 N18",
    rf"""SELECT p.page_id, url AS source_url, coalesce(nullif(regexp_extract(url, '/(\d+)(?:\?|$)', 1), ''), nullif(regexp_extract(coalesce(s.text, ''), '[0-9a-fA-F-]{{10,}}'), '')) AS page_code,
    {_H1} AS title, s.text AS about, s.link, s.name, m.mail, h.phone, nullif(s.items, 0) AS items
    FROM v_pages p JOIN v_sections s USING (page_id) JOIN ({_MAIL}) m USING (page_id) JOIN ({_PHONE}) h USING (page_id)""",
)
def page_record_fields(spark: SparkSession, folder: str) -> DataFrame:
    """The records read back from their JSON text; fields that were pruned are null."""
    shape = "source_url string, page_code string, title string, contact struct<about:string,link:string,name:string,mail:string,phone:string>, items array<string>"
    rows = page_records(spark, folder).select("page_id", F.from_json("record", shape).alias("r"))
    contact = [F.col(f"r.contact.{c}").alias(c) for c in ("about", "link", "name", "mail", "phone")]
    return rows.select("page_id", "r.source_url", "r.page_code", "r.title", *contact, F.when(F.col("r.items").isNotNull(), F.size("r.items").cast("long")).alias("items"))


@query(
    "H03 H04 H09",
    """SELECT page_id, i AS pos, part, try_cast(nullif(regexp_extract(part, '\\d+'), '') AS BIGINT) AS number FROM (
    SELECT page_id, unnest(ps) AS part, generate_subscripts(ps, 1) AS i FROM (SELECT page_id, list_filter(list_transform(regexp_split_to_array(text,
      '(?i)[,\\n•/]| og | eller '), lambda x: nullif(trim(x), '')), lambda x: x IS NOT NULL) AS ps FROM v_sections WHERE text IS NOT NULL))""",
)
def page_section_parts(spark: SparkSession, folder: str) -> DataFrame:
    """The parts of the text below each page's own first heading, and the first number in each."""
    found = sections.sections(contact_pages(spark, folder), tag="h1")
    rows = found.select("page_id", F.posexplode(split_list("text")).alias("p", "part"))
    return rows.select("page_id", (F.col("p") + 1).cast("long").alias("pos"), "part", pages.first_integer("part").alias("number"))
