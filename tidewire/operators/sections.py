"""Sections of HTML pages: what follows a heading, read from the tags with window sums instead of a parser."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Comments, scripts and styles whole, then tags, then text.
TOKEN = r"(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>|</?[a-z][^>]*>|[^<]+"
#: Tags that hold others: their balance is the depth of a token.
NESTING = ("html", "body", "div", "section", "article", "main", "aside", "header", "footer", "nav", "form", "table", "ul", "ol")
#: Tags that end an open paragraph.
ENDS_PARAGRAPH = ("p", "div", "ul", "ol", "li", "h1", "h2", "h3", "h4", "h5", "h6", "article", "footer", "nav", "section")
TEXT_BLOCKS, NAME_BLOCKS = ("p", "div", "span"), ("strong", "p", "div")
#: Character references that are decoded, the ampersand last.
REFERENCES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def page_tokens(df: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """One row per tag or piece of text: ``key, i, tok, name, opens, closes, words, depth``.

    ``name`` is the tag's, empty for text and comments; ``words`` the cleaned text,
    null where there is none; ``depth`` counts the open tags of ``NESTING``, the row's own included.
    """
    rows = df.select(F.col(key), F.posexplode(F.regexp_extract_all(html, F.lit(TOKEN), F.lit(0))).alias("i", "tok"))
    bare = ~F.col("tok").rlike(r"(?i)^<(!|script\b|style\b)")
    name = F.when(bare, F.lower(F.regexp_extract("tok", "^</?([A-Za-z][A-Za-z0-9]*)", 1))).otherwise("")
    text = F.when(~F.col("tok").startswith("<"), F.col("tok"))
    for reference, char in REFERENCES:
        text = F.replace(text, F.lit(reference), F.lit(char))
    words = F.nullif(F.trim(F.regexp_replace(text, r"\s+", " ")), F.lit(""))
    rows = rows.select(key, "i", "tok", name.alias("name"), F.col("tok").startswith("</").alias("_end"), F.col("tok").endswith("/>").alias("_both"), words.alias("words"))
    rows = rows.withColumns({"opens": (F.col("name") != "") & ~F.col("_end"), "closes": (F.col("name") != "") & F.col("_end")})
    step = F.when(~F.col("name").isin(*NESTING) | F.col("_both"), 0).when(F.col("opens"), 1).otherwise(-1)
    return rows.withColumn("depth", F.sum(step).over(W.partitionBy(key).orderBy("i"))).drop("_end", "_both")


def _until(start: str, name: Column, depth: Column) -> Column:
    """True for the tokens that end the block which opened at ``start``."""
    paragraph = (name == "p") & ((F.col("opens") & F.col("name").isin(*ENDS_PARAGRAPH)) | (F.col("closes") & (F.col("name") == "p")))
    inline = ~name.isin("p", "div") & F.col("closes") & (F.col("name") == name)
    return (F.col("i") > F.col(start)) & (paragraph | inline | (F.col("depth") < depth))


def sections(
    df: DataFrame, key: str = "page_id", html: str = "html", tag: str = "h2", heading: str | None = None, lenient: bool = False, nth_list: int = 1
) -> DataFrame:
    """``key, text, items, link, name`` of every page: what follows its first heading ``tag``.

    ``heading`` asks for the heading with that text, ``lenient`` for one that holds it, whatever the case.
    The text is that of the next paragraph, ``div`` or ``span``, the items those of the ``nth_list``
    list, not of lists inside it, the link the next one, and the name the first piece of the next ``strong``,
    paragraph or ``div`` that has no digit, no @ and at most five words. Pages without the
    heading have nulls and no items. ``key`` names a page; all steps share one shuffle by it, and a page is
    sorted by token, so neither the size nor the nesting of a page has a limit.
    """
    tokens = page_tokens(df, key, html)
    along, page = W.partitionBy(key).orderBy("i"), W.partitionBy(key)
    own = F.col("name") == tag
    tokens = tokens.withColumns({
        "_h": F.sum((own & F.col("opens")).cast("int")).over(along), "_c": F.sum((own & F.col("closes")).cast("int")).over(along),
    })
    pieces = F.array_sort(F.collect_list(F.when(F.col("words").isNotNull() & (F.col("_h") > F.col("_c")), F.struct("i", "words"))))
    titles = tokens.filter("_h > 0").groupBy(key, "_h").agg(
        F.min("i").alias("_at"), F.min(F.when(own & F.col("closes"), F.col("i"))).alias("_to"), F.array_join(F.transform(pieces, lambda x: x["words"]), " ").alias("_title")
    )
    wanted = F.lit(True) if heading is None else F.contains(F.lower("_title"), F.lit(heading.lower())) if lenient else F.col("_title") == heading
    chosen = titles.filter(wanted).groupBy(key).agg(F.min_by(F.coalesce("_to", "_at"), "_at").alias("_from"))
    rest = tokens.join(chosen, key).filter(F.col("i") > F.col("_from")).select(key, "i", "tok", "name", "opens", "closes", "words", "depth")

    def first(condition: Column) -> Column:
        return F.min(F.when(condition, F.struct("i", "name", "depth"))).over(page)

    lists = F.col("opens") & (F.col("name") == "ul")
    rest = rest.withColumn("_u", F.sum(lists.cast("int")).over(along)).withColumns({
        "_text": first(F.col("opens") & F.col("name").isin(*TEXT_BLOCKS)), "_name": first(F.col("opens") & F.col("name").isin(*NAME_BLOCKS)), "_list": first(lists & (F.col("_u") == nth_list)),
    })
    rest = rest.withColumns({
        f"{b}_end": F.min(F.when(_until(f"{b}.i", F.col(f"{b}.name"), F.col(f"{b}.depth")), F.col("i"))).over(page) for b in ("_text", "_name")
    } | {"_list_end": F.min(F.when((F.col("i") > F.col("_list.i")) & (F.col("depth") < F.col("_list.depth")), F.col("i"))).over(page)})

    def within(block: str) -> Column:
        return (F.col("i") > F.col(f"{block}.i")) & (F.col("i") < F.coalesce(f"{block}_end", F.lit(2**31 - 1)))

    item = within("_list") & F.col("opens") & (F.col("name") == "li") & (F.col("depth") == F.col("_list.depth"))
    rest = rest.withColumn("_item", F.sum(item.cast("int")).over(along))
    href = F.regexp_extract("tok", r"""(?is)\shref\s*=\s*["']?([^"'\s>]+)""", 1)
    person = F.col("words").isNotNull() & ~F.col("words").rlike(r"[@\d]") & (F.size(F.split("words", " ")) <= 5)

    def text_of(condition: Column) -> Column:
        return F.array_join(F.transform(F.array_sort(F.collect_list(F.when(condition & F.col("words").isNotNull(), F.struct("i", "words")))), lambda x: x["words"]), " ")

    items = rest.filter(within("_list") & (F.col("_item") > 0) & F.col("words").isNotNull()).groupBy(key, "_item").agg(text_of(F.lit(True)).alias("t"))
    items = items.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_item", "t"))), lambda x: x["t"]).alias("items"))
    found = rest.groupBy(key).agg(
        F.nullif(text_of(within("_text")), F.lit("")).alias("text"),
        F.min_by(href, F.when(F.col("opens") & (F.col("name") == "a") & (href != ""), F.col("i"))).alias("link"),
        F.min_by("words", F.when(within("_name") & person, F.col("i"))).alias("name"),
    )
    return df.select(key).join(found, key, "left").join(items, key, "left").select(key, "text", F.coalesce("items", F.array().cast("array<string>")).alias("items"), "link", "name")
