"""Entity queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.catalog.messages import texts
from tidewire.catalog.registry import query, view
from tidewire.catalog.text_scores import sql_list
from tidewire.functions import lexicons as lex
from tidewire.operators import entities, matching, models
from tidewire.sources.dictionaries import alias_entries, read_aliases
from tidewire.sources.tables import read_table, work_folder

# A small dictionary of this library's own; two people share a last name.
DICTIONARY = {
    "Barack Obama": {"type": "PERSON", "id": 1, "aliases": ["Obama", "President Obama"]},
    "Joe Biden": {"type": "PERSON", "id": 2, "aliases": ["Biden"]},
    "Hunter Biden": {"type": "PERSON", "id": 3, "aliases": []},
    "Donald Trump": {"type": "PERSON", "id": 4, "aliases": ["Trump", "DJT"]},
    "CNN": {"type": "ORG", "id": 5, "aliases": []},
    "White House": {"type": "LOC", "id": 6, "aliases": ["whitehouse"]},
    "Jobs Report": {"type": "MISC", "id": 7, "aliases": ["jobs report"]},
}
ALIASES = alias_entries(DICTIONARY)

_ALIAS_SQL = " UNION ALL ".join(
    f"SELECT '{k}' AS alias_key, '{c}' AS canonical, '{t}' AS alias_type, {o} AS ord" for k, c, t, o in ALIASES
)
_BUILT_IN_SQL = " UNION ALL ".join(
    f"SELECT '{k}' AS alias_key, '{c}' AS canonical, '{t}' AS alias_type, {i} AS ord"
    for i, (k, c, t) in enumerate(lex.BUILT_IN_ENTITIES)
)
view("v_aliases", _ALIAS_SQL)
view("v_builtin", _BUILT_IN_SQL)
view(
    "v_marked",
    r"""SELECT msg_id, text, regexp_replace(translate(regexp_replace(regexp_replace(text,
      '([\p{L}\p{N}_]+)', chr(1) || '\1' || chr(2), 'g'),
      chr(1) || '([A-Z][a-z]+)' || chr(2), chr(3) || '\1' || chr(4), 'g'), chr(1) || chr(2), ''),
      chr(4) || '(\s+)' || chr(3), '\1', 'g') AS marked FROM v_texts""",
)
view(
    "v_runs",
    f"""SELECT msg_id, r AS word, i AS pos FROM (
    SELECT msg_id, unnest(rs) AS r, generate_subscripts(rs, 1) AS i FROM (
      SELECT msg_id, regexp_extract_all(marked, chr(3) || '([^' || chr(4) || ']*)' || chr(4), 1) AS rs
      FROM v_marked)) WHERE lower(r) NOT IN ({sql_list(lex.CAPITALISED_STOP_WORDS)})""",
)
view(
    "v_candidates",
    """SELECT msg_id, canonical AS name, alias_type AS type, 0.85::DOUBLE AS confidence, alias_key AS key, ord AS pos, 1 AS grp
    FROM v_texts JOIN v_aliases ON contains(lower(text), alias_key)
    UNION ALL
    SELECT msg_id, canonical, alias_type, 0.8::DOUBLE, alias_key, ord, 2
    FROM v_texts JOIN v_builtin ON contains(lower(text), alias_key)
    UNION ALL SELECT msg_id, word, 'MISC', 0.5::DOUBLE, NULL, pos, 3 FROM v_runs""",
)
view(
    "v_entities",
    """SELECT msg_id, name AS text, type, confidence, rank,
    CASE WHEN key IS NOT NULL THEN instr(lower(t), key) - 1
      ELSE length(translate(marked[1:instr(marked, chr(3) || name || chr(4)) - 1], chr(3) || chr(4), '')) END AS start,
    length(coalesce(key, name)) AS size
    FROM (SELECT c.*, m.text AS t, m.marked,
            row_number() OVER (PARTITION BY c.msg_id ORDER BY confidence DESC, grp, pos) AS rank
          FROM (SELECT *, row_number() OVER (PARTITION BY msg_id, lower(name), type
                  ORDER BY confidence DESC, grp, pos) AS first_of_key FROM v_candidates) c
          JOIN v_marked m USING (msg_id) WHERE first_of_key = 1) WHERE rank <= 5""",
)


def written_dictionary(spark: SparkSession, folder: str) -> DataFrame:
    """A dictionary file of every capitalised word of the documents, with its first six letters as alias, read back as any other."""
    words = read_table(spark, folder, "documents").select(F.explode(F.regexp_extract_all("text", F.lit("[A-Z][a-z]{5,}"), F.lit(0))).alias("c")).distinct()
    kinds = F.get(F.array(*[F.lit(k) for k in ("PERSON", "ORG", "LOC")]), F.length("c") % 3)
    entry = F.struct(kinds.alias("type"), F.length("c").cast("long").alias("id"), F.array(F.left("c", F.lit(6))).alias("aliases"))
    # the format is one JSON object in one file
    document = words.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("c", entry))))).alias("value"))
    path = work_folder(spark, "dictionary")
    document.write.text(path)
    return read_aliases(spark, f"{path}/*.txt")


view(
    "v_written",
    """SELECT lower(surface) AS alias_key, arg_max(c, 2 * i + j) AS canonical, min(2 * i + j) AS first FROM (
      SELECT c, i, 0 AS j, c AS surface FROM (SELECT c, row_number() OVER (ORDER BY c) AS i FROM (SELECT DISTINCT unnest(regexp_extract_all(text, '[A-Z][a-z]{5,}')) AS c FROM documents))
      UNION ALL SELECT c, i, 1, c[1:6] FROM (SELECT c, row_number() OVER (ORDER BY c) AS i FROM (SELECT DISTINCT unnest(regexp_extract_all(text, '[A-Z][a-z]{5,}')) AS c FROM documents)))
    GROUP BY 1""",
)


@query(
    "E01 E02 S10",
    """SELECT msg_id, alias_key, canonical, ['PERSON', 'ORG', 'LOC'][length(canonical) % 3 + 1] AS type, instr(lower(text), alias_key) - 1 AS start
    FROM v_texts JOIN v_written ON contains(lower(text), alias_key)""",
)
def dictionary_file_mentions(spark: SparkSession, folder: str) -> DataFrame:
    """Every key of a large dictionary file in every text; nothing of it is compiled into the plan."""
    hits = matching.row_hits(texts(spark, folder), written_dictionary(spark, folder), "text", ["msg_id"])
    return hits.select("msg_id", "alias_key", "canonical", F.col("alias_type").alias("type"), F.col("start").cast("long").alias("start"))


@query(
    "E01 E03 E04 E05 S10",
    """SELECT msg_id, rank, name AS text, type, confidence, CAST(CASE WHEN key IS NOT NULL THEN instr(lower(t), key) - 1
      ELSE length(translate(marked[1:instr(marked, chr(3) || name || chr(4)) - 1], chr(3) || chr(4), '')) END AS INTEGER) AS start
    FROM (SELECT c.*, m.text AS t, m.marked, row_number() OVER (PARTITION BY c.msg_id ORDER BY confidence DESC, grp, pos) AS rank
      FROM (SELECT *, row_number() OVER (PARTITION BY msg_id, lower(name), type ORDER BY confidence DESC, grp, pos) AS first_of_key FROM (
          SELECT msg_id, canonical AS name, ['PERSON', 'ORG', 'LOC'][length(canonical) % 3 + 1] AS type, 0.85::DOUBLE AS confidence, alias_key AS key, first AS pos, 1 AS grp
          FROM v_texts JOIN v_written ON contains(lower(text), alias_key)
          UNION ALL SELECT msg_id, canonical, alias_type, 0.8::DOUBLE, alias_key, ord, 2 FROM v_texts JOIN v_builtin ON contains(lower(text), alias_key)
          UNION ALL SELECT msg_id, word, 'MISC', 0.5::DOUBLE, NULL, pos, 3 FROM v_runs)) c
      JOIN v_marked m USING (msg_id) WHERE first_of_key = 1) WHERE rank <= 5""",
)
def dictionary_file_entities(spark: SparkSession, folder: str) -> DataFrame:
    """The ranked entities of each text with a dictionary of any size."""
    found = entities.rule_entities(texts(spark, folder), written_dictionary(spark, folder), max_entities=5)
    rows = found.select("msg_id", F.posexplode_outer("entities").alias("rank", "e")).filter("e IS NOT NULL")
    return rows.select("msg_id", (F.col("rank") + 1).cast("long").alias("rank"), *[F.col("e")[c].alias(c) for c in ("text", "type", "confidence", "start")])


def with_entities(df: DataFrame) -> DataFrame:
    return entities.rule_entities(df, ALIASES, max_entities=5)


@query(
    "E01 E02 E03 E04 E05 S10",
    """SELECT msg_id, rank, text, type, confidence, CAST(start AS INTEGER) AS start,
    CAST(start + size AS INTEGER) AS "end" FROM v_entities""",
)
def entity_mentions(spark: SparkSession, folder: str) -> DataFrame:
    rows = with_entities(texts(spark, folder)).select(
        "msg_id", F.posexplode_outer("entities").alias("rank", "e")
    ).filter("e IS NOT NULL")
    return rows.select(
        "msg_id", (F.col("rank") + 1).cast("long").alias("rank"),
        *[F.col("e")[c].alias(c) for c in ("text", "type", "confidence", "start", "end")],
    )


@query(
    "E13 N16",
    """SELECT t.msg_id, count(e.text) AS entity_count,
    coalesce(string_agg(CASE WHEN type = 'PERSON' THEN e.text END, '|' ORDER BY rank), '') AS persons,
    coalesce(string_agg(CASE WHEN type = 'ORG' THEN e.text END, '|' ORDER BY rank), '') AS orgs,
    coalesce(string_agg(CASE WHEN type = 'LOC' THEN e.text END, '|' ORDER BY rank), '') AS locs
    FROM v_texts t LEFT JOIN v_entities e USING (msg_id) GROUP BY t.msg_id""",
)
def entity_summaries(spark: SparkSession, folder: str) -> DataFrame:
    rows = entities.entity_summary(with_entities(texts(spark, folder)))
    return rows.select(
        "msg_id", "entity_count",
        F.array_join("person_entities", "|").alias("persons"),
        F.array_join("org_entities", "|").alias("orgs"),
        F.array_join("loc_entities", "|").alias("locs"),
    )


@query("E15", "SELECT text AS entity, count(*) AS count FROM v_entities GROUP BY text")
def entity_counts(spark: SparkSession, folder: str) -> DataFrame:
    return entities.entity_counts(with_entities(texts(spark, folder)))


@query("E14", "SELECT type, count(*) AS count FROM v_entities GROUP BY type")
def entity_counts_by_type(spark: SparkSession, folder: str) -> DataFrame:
    return entities.entity_type_counts(with_entities(texts(spark, folder)))


@query(
    "E14 F03",
    """SELECT count(*) AS total_entities, count(DISTINCT text) AS unique_entities,
    round(count(*)::DOUBLE / (SELECT count(*) FROM v_texts), 6) AS avg_entities_per_message FROM v_entities""",
)
def entity_totals(spark: SparkSession, folder: str) -> DataFrame:
    return entities.entity_totals(with_entities(texts(spark, folder)))


@query(
    "E14 O02",
    "SELECT text AS entity, count(*) AS count FROM v_entities GROUP BY text ORDER BY count DESC, entity LIMIT 10",
)
def top_entities(spark: SparkSession, folder: str) -> DataFrame:
    return entities.top_entities(with_entities(texts(spark, folder)), 10)


# Model-like mentions are derived from the capitalised runs: the group comes from
# the length of the name and the score from its position.
_GROUPS = ("PER", "ORG", "GPE", "Miscellaneous", "LOC")
view(
    "v_mentions",
    """SELECT msg_id, CASE WHEN pos % 9 = 0 THEN '##' || word ELSE word END AS word,
    (['PER', 'ORG', 'GPE', 'Miscellaneous', 'LOC'])[CASE WHEN contains(word, ' ') THEN 1 ELSE length(word) % 5 + 1 END]
      AS entity_group,
    (50 + (pos * 37) % 50) / 100.0::DOUBLE AS score, pos AS start, pos + 1 AS "end" FROM v_runs""",
)
view(
    "v_canonical",
    f"""SELECT m.msg_id, m.word, score, start, "end",
    coalesce(a.canonical, l.canonical, m.word) AS text, coalesce(a.alias_type, l.alias_type, m.type) AS type
    FROM (SELECT msg_id, replace(word, '##', '') AS word, score, start, "end",
            CASE upper(entity_group) WHEN 'PER' THEN 'PERSON' WHEN 'ORG' THEN 'ORG' WHEN 'GPE' THEN 'LOC'
              WHEN 'LOC' THEN 'LOC' ELSE 'MISC' END AS type FROM v_mentions
          WHERE length(replace(word, '##', '')) >= 2 AND NOT regexp_matches(word, '^\\d+$')
            AND lower(replace(word, '##', '')) NOT IN ({sql_list(lex.ENTITY_GARBAGE + lex.PARTIAL_TOKENS)})) m
    LEFT JOIN v_aliases a ON a.alias_key = lower(m.word)
    LEFT JOIN (SELECT token, arg_min(canonical, ord) AS canonical, arg_min(alias_type, ord) AS alias_type
               FROM (SELECT *, unnest(string_split(alias_key, ' ')) AS token FROM v_aliases) GROUP BY token) l
      ON m.type = 'PERSON' AND len(regexp_split_to_array(m.word, '\\s+')) > 1
         AND l.token = lower(regexp_split_to_array(m.word, '\\s+')[-1])""",
)


def mention_rows(df: DataFrame) -> DataFrame:
    runs = entities.marked_runs(entities.mark_capitalised(F.col("text")))
    rows = df.select("msg_id", F.col("text").alias("message_text"), F.posexplode(runs).alias("i", "name"))
    pos = F.col("i") + 1
    group = F.get(
        F.array(*[F.lit(g) for g in _GROUPS]),
        F.when(F.contains("name", F.lit(" ")), 0).otherwise(F.length("name") % 5),
    )
    return rows.filter(~F.lower("name").isin(*lex.CAPITALISED_STOP_WORDS)).select(
        "msg_id",
        F.when(pos % 9 == 0, F.concat(F.lit("##"), "name")).otherwise(F.col("name")).alias("word"),
        group.alias("entity_group"),
        ((pos * 37) % 50 + 50).cast("double").alias("s"),
        pos.cast("long").alias("start"),
        (pos + 1).cast("long").alias("end"),
        "message_text",
    ).withColumn("score", F.col("s") / 100.0).drop("s")


@query(
    "E06 E07 E08 E09 E11 J01",
    """SELECT msg_id, rank, text, type, round(score, 6) AS confidence, word AS original_text FROM (
    SELECT *, row_number() OVER (PARTITION BY msg_id ORDER BY score DESC, start, "end") AS rank FROM (
      SELECT *, row_number() OVER (PARTITION BY msg_id, lower(text), type ORDER BY start, "end") AS n FROM v_canonical)
    WHERE n = 1) WHERE rank <= 5""",
)
def canonical_mentions(spark: SparkSession, folder: str) -> DataFrame:
    rows = entities.clean_mentions(
        mention_rows(texts(spark, folder)), entities.alias_frame(spark, ALIASES), max_entities=5
    )
    return rows.select(
        "msg_id", F.col("rank").cast("long").alias("rank"), "text", "type",
        F.round("confidence", 6).alias("confidence"), "original_text",
    )


@query(
    "E10",
    r"""SELECT r.msg_id, r.word, (lower(r.word) LIKE '%barack%' AND lower(r.word) LIKE '%obama%' AND (
      regexp_matches(text, '(?i)barack\s+obama\s*\(cnn\)|barack\s+obama\s*\(retweeted\)|retweeted\s+by\s+barack\s+obama|barack\s+obama\s*\(.*\)\s*$|^barack\s+obama\s*\(|—\s*barack\s+obama|by\s+barack\s+obama\s*$')
      OR (starts_with(lower(text[1:50]), 'barack obama') AND (contains(lower(text[1:50]), 'cnn') OR contains(text[1:50], '(')))))
      OR (lower(r.word) = 'cnn' AND regexp_matches(text, '(?i)\(cnn\)')) AS is_byline
    FROM v_runs r JOIN (SELECT msg_id, CASE doc_id % 3 WHEN 0 THEN 'Barack Obama (CNN) ' || text
      WHEN 1 THEN text || ' by Barack Obama' ELSE text || ' Barack Obama left' END AS text FROM v_texts) t USING (msg_id)""",
)
def byline_mentions(spark: SparkSession, folder: str) -> DataFrame:
    base = texts(spark, folder)
    rows = mention_rows(base).withColumn("word", F.replace("word", F.lit("##"), F.lit("")))
    kind = F.col("msg_id").cast("long") % 3
    line = (
        F.when(kind == 0, F.concat(F.lit("Barack Obama (CNN) "), "message_text"))
        .when(kind == 1, F.concat("message_text", F.lit(" by Barack Obama")))
        .otherwise(F.concat("message_text", F.lit(" Barack Obama left")))
    )
    flag = entities.is_byline_mention(F.col("word"), line, "Barack Obama", "CNN")
    return rows.select("msg_id", "word", flag.alias("is_byline"))


@query(
    "E12 F02",
    """SELECT msg_id, name AS text, CASE WHEN name = 'CNN' THEN 'ORG' ELSE 'PERSON' END AS type, instr(text, name) - 1 AS start
    FROM (SELECT msg_id, text, unnest(['Barack Obama', 'Joe Biden', 'Donald Trump', 'CNN']) AS name FROM v_texts)
    WHERE contains(text, name) AND NOT contains(text, 'Trump')""",
)
def entities_from_model(spark: SparkSession, folder: str) -> DataFrame:
    """A stand-in model that knows four names and fails on texts about one of them."""

    def make():
        names = {"Barack Obama": "PER", "Joe Biden": "per", "CNN": "ORGANIZATION"}

        def predict(text: str):
            if "Trump" in text:
                raise ValueError("model failure")
            return [
                {"word": n, "entity_group": g, "score": 0.9, "start": text.index(n), "end": text.index(n) + len(n)}
                for n, g in names.items()
                if n in text
            ]

        return predict

    mentions = models.extract_mentions(texts(spark, folder), make)
    rows = entities.clean_mentions(mentions, entities.alias_frame(spark, ALIASES), max_entities=5)
    return rows.select("msg_id", "text", "type", "start")
