"""Entities: dictionary and capitalisation rules, model-mention clean-up, statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.functions import lexicons as lex
from tidewire.functions.text import NOT_BEFORE_WORD, WORD, bind, col, count_char, unnest
from tidewire.operators.matching import with_dictionary_hits

# (surface form, canonical name, type, order), surface forms lower-cased
Alias = tuple[str, str, str, int]

ENTITY = T.StructType(
    [
        T.StructField("text", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("start", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
        T.StructField("original_text", T.StringType()),
    ]
)
_OPEN, _CLOSE = "\x03", "\x04"


def _dictionary_hits(lower: Column, aliases: Sequence[Alias], confidence: float) -> Column:
    """Aliases that occur in the lower-cased text as a substring, in dictionary order."""
    shape = "array<struct<name:string,type:string,confidence:double,key:string>>"
    if not aliases:
        return F.array().cast(shape)
    known = F.array(
        *[
            F.struct(
                F.lit(name).alias("name"), F.lit(kind).alias("type"),
                F.lit(confidence).alias("confidence"), F.lit(key).alias("key"),
            )
            for key, name, kind, _ in aliases
        ]
    )
    return F.filter(known, lambda a: F.contains(lower, a["key"]))


def mark_capitalised(text: Column) -> Column:
    """Wrap every run of capitalised words in two control characters.

    Marking single words first and then joining neighbours keeps each pattern
    free of repeated groups, so run length is not limited by regex recursion.
    """
    # The look-behind follows the capital, so most positions fail on one character.
    single = rf"([A-Z](?<!{WORD}[A-Z])[a-z]++){NOT_BEFORE_WORD}"
    marked = F.regexp_replace(text, single, f"{_OPEN}$1{_CLOSE}")
    return F.regexp_replace(marked, rf"{_CLOSE}(\s+){_OPEN}", "$1")


def marked_runs(marked: Column | str) -> Column:
    return F.regexp_extract_all(col(marked), F.lit(f"{_OPEN}([^{_CLOSE}]*){_CLOSE}"), F.lit(1))


def capitalised_names(marked: Column | str) -> Column:
    """Distinct capitalised runs in order of first appearance, stop words dropped."""
    runs = marked_runs(marked)
    return F.array_distinct(
        F.filter(runs, lambda r: ~F.lower(r).isin(*lex.CAPITALISED_STOP_WORDS))
    )


def _start_of_run(marked: Column, name: Column) -> Column:
    """Zero-based offset of the first marked occurrence of a capitalised run."""
    at = F.instr(marked, F.concat(F.lit(_OPEN), name, F.lit(_CLOSE)))
    before = F.substring(marked, F.lit(1), at - 1)
    return F.length(before) - count_char(before, _OPEN) - count_char(before, _CLOSE)


def _first_by_key(items: Column) -> Column:
    """Keep the first element per (lower(name), type); lists are in rank order."""
    keys = F.transform(items, lambda e: F.concat_ws("\x1f", F.lower(e["name"]), e["type"]))
    return bind(
        keys,
        lambda k: F.filter(
            items,
            lambda e, i: F.array_position(k, F.concat_ws("\x1f", F.lower(e["name"]), e["type"])) == i + 1,
        ),
    )


def rule_entities(
    df: DataFrame,
    aliases: Sequence[Alias] | DataFrame = (),
    text: str = "text",
    max_entities: int = 3,
) -> DataFrame:
    """Add ``entities``: dictionary hits (0.85), built-in names (0.8), capitalised
    runs (0.5), one per (name, type), at most ``max_entities``.

    The three groups are already in rank order, so keeping the first per key and
    slicing is the whole ranking. Offsets are computed for the kept ones only.
    A dictionary given as rows is tested inside the row; one given as the frame of
    ``read_aliases`` may have any size and is joined (``matching.dictionary_hits``).
    """
    built_in = [(k, n, t, i) for i, (k, n, t) in enumerate(lex.BUILT_IN_ENTITIES)]
    body = F.coalesce(F.col(text), F.lit(""))
    lower = F.col("_lower")
    if isinstance(aliases, DataFrame):
        # before the text is lowered, as it travels with its row
        df = with_dictionary_hits(df, aliases, text, names=max_entities).withColumn("_lower", F.lower(body))
    else:
        df = df.withColumn("_lower", F.lower(body)).withColumn("_listed", _dictionary_hits(lower, aliases, 0.85))
    # bound, because the hits are read twice
    named = bind(F.concat("_listed", _dictionary_hits(lower, built_in, 0.8)), _first_by_key)
    df = df.withColumns({"_named": named, "_marked": mark_capitalised(body)})

    def misc_runs(taken: Column) -> Column:
        free = F.filter(capitalised_names("_marked"), lambda r: ~F.array_contains(taken, F.lower(r)))
        return F.transform(
            F.slice(free, 1, max_entities),
            lambda r: F.struct(
                r.alias("name"), F.lit("MISC").alias("type"), F.lit(0.5).alias("confidence"),
                F.lit(None).cast("string").alias("key"),
            ),
        )

    misc_names = F.transform(F.filter("_named", lambda e: e["type"] == "MISC"), lambda e: F.lower(e["name"]))
    kept = F.slice(F.concat("_named", bind(misc_names, misc_runs)), 1, max_entities)

    def place(e: Column) -> Column:
        start = F.when(e["key"].isNull(), _start_of_run(F.col("_marked"), e["name"])).otherwise(
            F.instr(lower, e["key"]) - 1
        )
        return F.struct(
            e["name"].alias("text"), e["type"].alias("type"), e["confidence"].alias("confidence"),
            start.cast("int").alias("start"), F.length(F.coalesce(e["key"], e["name"])).alias("size"),
        )

    placed = F.transform(kept, place)
    entities = F.transform(
        placed,
        lambda e: F.struct(
            e["text"].alias("text"), e["type"].alias("type"), e["confidence"].alias("confidence"),
            e["start"].alias("start"), (e["start"] + e["size"]).alias("end"), e["text"].alias("original_text"),
        ),
    )
    return df.withColumn("entities", entities).drop("_lower", "_listed", "_named", "_marked")


def entity_summary(df: DataFrame) -> DataFrame:
    """Add the entity count and the name lists per type."""

    def names(kind: str) -> Column:
        chosen = F.filter("entities", lambda e: e["type"] == kind)
        return F.transform(chosen, lambda e: e["text"])

    return df.withColumns(
        {
            "entity_count": F.size("entities").cast("long"),
            "person_entities": names("PERSON"),
            "org_entities": names("ORG"),
            "loc_entities": names("LOC"),
        }
    )


def entity_rows(df: DataFrame, *keep: str) -> DataFrame:
    return unnest(df, "entities", "_e", *keep).select(*keep, "_e.*")


# --- clean-up of mentions found by a model -----------------------------------

def normalise_type(kind: Column | str) -> Column:
    pairs = [F.lit(x) for kv in lex.ENTITY_TYPES.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.upper(col(kind))), F.lit("MISC"))


def is_usable_mention(word: Column | str) -> Column:
    """Not too short, not a number, not a stop word or word piece."""
    low = F.lower(col(word))
    return (
        (F.length(col(word)) >= 2)
        & ~col(word).rlike(r"^\p{Nd}+$")
        & ~low.isin(*lex.ENTITY_GARBAGE, *lex.PARTIAL_TOKENS)
    )


def is_byline_mention(word: Column, text: Column, person: str, site: str) -> Column:
    """Whether a mention of ``person`` or ``site`` belongs to an attribution line.

    ``person`` is given as words separated by blanks. The patterns name the
    mention itself, so a match is an overlap.
    """
    name = r"\s+".join(person.lower().split())
    first, last = person.lower().split()[0], person.lower().split()[-1]
    site = site.lower()
    low = F.lower(word)
    about_person = F.contains(low, F.lit(first)) & F.contains(low, F.lit(last))
    about_site = low == site
    person_line = (
        rf"(?id){name}\s*\({site}\)|{name}\s*\(retweeted\)|retweeted\s+by\s+{name}|{name}\s*\(.*\)\s*$"
        rf"|^{name}\s*\(|—\s*{name}|by\s+{name}\s*$"
    )
    opening = F.lower(F.substring(text, 1, 50))
    leads = F.startswith(opening, F.lit(person.lower())) & (
        F.contains(opening, F.lit(site)) | F.contains(opening, F.lit("("))
    )
    site_line = rf"(?i)\({site}\)"
    return (about_person & (text.rlike(person_line) | leads)) | (about_site & text.rlike(site_line))


def alias_frame(spark, aliases: Sequence[Alias]) -> DataFrame:
    return spark.createDataFrame(
        list(aliases), "alias_key string, canonical string, alias_type string, ord int"
    )


def canonicalise(mentions: DataFrame, aliases: DataFrame) -> DataFrame:
    """Replace mention text by its canonical name: exact alias first, then, for
    people with several words, the first alias that contains the last word.

    Both sides of each join are keyed, so Spark broadcasts the dictionary when it
    is small and shuffles otherwise.
    """
    exact = aliases.select("alias_key", "canonical", "alias_type")
    by_token = (
        aliases.select("canonical", "alias_type", "ord", F.explode(F.split("alias_key", r"\s+")).alias("token"))
        .groupBy("token")
        .agg(F.min_by(F.struct("canonical", "alias_type"), "ord").alias("_by_last"))
    )
    parts = F.split(F.trim("word"), r"\s+")
    last = F.when((F.col("type") == "PERSON") & (F.size(parts) > 1), F.lower(F.element_at(parts, -1)))
    joined = (
        mentions.withColumn("_key", F.lower("word"))
        .withColumn("_last", last)
        .join(exact, F.col("_key") == F.col("alias_key"), "left")
        .join(by_token, F.col("_last") == F.col("token"), "left")
    )
    return joined.select(
        *mentions.drop("type").columns,
        F.coalesce("canonical", F.col("_by_last.canonical"), "word").alias("text"),
        F.coalesce("alias_type", F.col("_by_last.alias_type"), "type").alias("type"),
    )


def clean_mentions(
    mentions: DataFrame,
    aliases: DataFrame,
    max_entities: int = 3,
    byline: tuple[str, str] | None = None,
) -> DataFrame:
    """Turn model mentions (msg_id, word, entity_group, score, start, end and, for
    the byline filter, message_text) into ranked entities.

    Kept per message: the first mention of each (canonical name, type) by
    position, then the ``max_entities`` best scores.
    """
    cleaned = mentions.withColumn("word", F.replace(F.trim("word"), F.lit("##"), F.lit(""))).filter(
        is_usable_mention("word")
    )
    if byline is not None:
        cleaned = cleaned.filter(~is_byline_mention(F.col("word"), F.col("message_text"), *byline))
    cleaned = cleaned.drop("message_text").withColumn("type", normalise_type("entity_group"))
    named = canonicalise(cleaned, aliases)
    first = W.partitionBy("msg_id", F.lower("text"), "type").orderBy("start", "end")
    best = W.partitionBy("msg_id").orderBy(F.desc("score"), "start", "end")
    return (
        named.withColumn("_n", F.row_number().over(first))
        .filter("_n = 1")
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= max_entities)
        .select(
            "msg_id", "rank", "text", "type", F.col("score").alias("confidence"), "start", "end",
            F.col("word").alias("original_text"),
        )
    )


# --- statistics ----------------------------------------------------------------

def entity_counts(df: DataFrame) -> DataFrame:
    """Entity name and number of occurrences."""
    return entity_rows(df).groupBy(F.col("text").alias("entity")).agg(F.count("*").alias("count"))


def entity_type_counts(df: DataFrame) -> DataFrame:
    return entity_rows(df).groupBy("type").agg(F.count("*").alias("count"))


def entity_totals(df: DataFrame) -> DataFrame:
    """Total and distinct entities and the mean per message."""
    counts = entity_counts(df).agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("total_entities"), F.count("*").alias("unique_entities")
    )
    size = df.agg(F.count("*").alias("_messages"))
    return counts.join(F.broadcast(size), F.lit(True)).select(
        "total_entities", "unique_entities",
        F.round(F.col("total_entities") / F.col("_messages"), 6).alias("avg_entities_per_message"),
    )


def top_entities(df: DataFrame, top_k: int = 10) -> DataFrame:
    return entity_counts(df).orderBy(F.desc("count"), "entity").limit(top_k)
