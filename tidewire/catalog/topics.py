"""Topic queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.catalog.messages import messages, texts
from tidewire.catalog.registry import query, view
from tidewire.catalog.text_scores import sql_list
from tidewire.operators import discovery, models, topics
from tidewire.sources.dictionaries import read_ontology
from tidewire.sources.tables import read_table, work_folder

LABELS = [label for label, _, _ in topics.ONTOLOGY] + ["other"]
view(
    "v_keywords",
    " UNION ALL ".join(
        f"SELECT {i} AS ord, '{label}' AS label, '{' '.join(k.lower().split())}' AS keyword"
        for i, (label, words, _) in enumerate(topics.ONTOLOGY)
        for k in words
    ),
)
view(
    "v_topic_hits",
    """SELECT msg_id, unnest(list_concat(toks, list_transform(range(1, len(toks)), lambda i: toks[i] || ' ' || toks[i + 1])))
    AS keyword FROM v_tokens""",
)
view(
    "v_topic_shares",
    """SELECT msg_id, label, ord, count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY msg_id) AS share
    FROM v_topic_hits JOIN v_keywords USING (keyword) GROUP BY msg_id, label, ord""",
)
view(
    "v_topics",
    """SELECT t.msg_id, coalesce(s.label, 'other') AS primary_topic, coalesce(s.share, 0.0) AS confidence,
    coalesce(s.n, 0) AS topic_count FROM v_texts t LEFT JOIN (
      SELECT *, count(*) OVER (PARTITION BY msg_id) AS n,
        row_number() OVER (PARTITION BY msg_id ORDER BY share DESC, ord) AS r
      FROM v_topic_shares WHERE share >= 0.3) s ON s.msg_id = t.msg_id AND s.r = 1""",
)


@query(
    "P01 P03 S11",
    "SELECT msg_id, primary_topic, round(confidence, 6) AS confidence, topic_count FROM v_topics",
)
def message_topics(spark: SparkSession, folder: str) -> DataFrame:
    return topics.ontology_topics(texts(spark, folder)).select(
        "msg_id", "primary_topic", F.round("primary_topic_confidence", 6).alias("confidence"), "topic_count"
    )


@query("P01 P03 S11", "SELECT msg_id, primary_topic, round(confidence, 6) AS confidence, topic_count FROM v_topics")
def file_topics(spark: SparkSession, folder: str) -> DataFrame:
    """Topics by an ontology file, written and read back; its keywords are joined."""
    rows = spark.createDataFrame([(label, list(words), weight) for label, words, weight in topics.ONTOLOGY], "label string, keywords array<string>, weight double")
    path = work_folder(spark, "ontology")
    rows.coalesce(1).agg(F.to_json(F.collect_list(F.struct("label", "keywords", "weight"))).alias("value")).write.text(path)
    found = topics.ontology_topics(texts(spark, folder), read_ontology(spark, f"{path}/*.txt"))
    return found.select("msg_id", "primary_topic", F.round("primary_topic_confidence", 6).alias("confidence"), "topic_count")


@query(
    "P04 A11",
    """SELECT primary_topic, count(*) AS count FROM v_topics GROUP BY primary_topic
    ORDER BY count DESC, primary_topic LIMIT 15""",
)
def topic_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return topics.topic_distribution(topics.ontology_topics(texts(spark, folder)))


@query(
    "P04",
    """SELECT count(*) AS total_messages, count(DISTINCT primary_topic) AS unique_topics_found,
    round(avg(confidence), 6) AS avg_confidence, count(*) FILTER (confidence >= 0.3) AS confident_classifications,
    round(count(*) FILTER (confidence >= 0.3)::DOUBLE / count(*) * 100, 6) AS confident_percentage,
    count(*) FILTER (topic_count > 1) AS multi_topic_messages,
    round(count(*) FILTER (topic_count > 1)::DOUBLE / count(*) * 100, 6) AS multi_topic_percentage FROM v_topics""",
)
def topic_statistics(spark: SparkSession, folder: str) -> DataFrame:
    return topics.topic_stats(topics.ontology_topics(texts(spark, folder)))


_COUNTS = ", ".join(f"count(*) FILTER (primary_topic = '{x}') AS {x}" for x in LABELS)
_SHARES = ", ".join(
    f"round_even(count(*) FILTER (primary_topic = '{x}')::DOUBLE / count(*) * 100, 2) AS {x}_pct" for x in LABELS
)


@query(
    "P05",
    f"""SELECT CAST(date AS DATE) AS day, {_COUNTS}, count(*) AS total_messages, {_SHARES}
    FROM v_topics JOIN v_messages USING (msg_id) GROUP BY 1""",
)
def topic_trends(spark: SparkSession, folder: str) -> DataFrame:
    return topics.topic_trends(topics.ontology_topics(messages(spark, folder)), LABELS)


@query(
    "P02 F02",
    """SELECT msg_id, CASE WHEN length(text) % 3 = 0 THEN 'economy' WHEN length(text) % 3 = 1 THEN 'climate' ELSE 'other' END
    AS primary_topic, CAST(CASE WHEN length(text) % 3 = 2 THEN 0 WHEN length(text) % 3 = 1 THEN 2 ELSE 1 END AS BIGINT)
    AS topic_count FROM v_texts""",
)
def topics_from_model_scores(spark: SparkSession, folder: str) -> DataFrame:
    def make():
        def predict(bodies):
            by_kind = (
                [("economy", 0.8), ("climate", 0.1)],
                [("economy", 0.35), ("climate", 0.6)],
                [("economy", 0.2), ("climate", 0.2)],
            )
            return [by_kind[len(b) % 3] for b in bodies]

        return predict

    scored = models.score_texts(texts(spark, folder), make)
    return topics.topics_from_scores(scored).select("msg_id", "primary_topic", "topic_count")


# Discovery queries on fixed topic ids: the embeddings' labels, 0 taken as outlier.
view(
    "v_clustered",
    """SELECT t.msg_id, t.text, CASE WHEN e.label = 0 THEN -1 ELSE coalesce(e.label, -1) END AS topic, length(t.text) AS distance
    FROM v_texts t LEFT JOIN embeddings e ON e.vec_id = t.doc_id""",
)
view(
    "v_terms",
    rf"""SELECT topic, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS word FROM (
    SELECT topic, list_filter(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+'), lambda x: length(x) > 1 AND x NOT IN ({sql_list(discovery.STOP_WORDS)})) AS w
    FROM v_clustered)""",
)
view("v_term_counts", "SELECT topic, word, count(*) AS n FROM v_terms GROUP BY ALL")
view(
    "v_features",
    """SELECT word, f FROM (SELECT word, sum(n) AS f, count(*) AS df FROM v_term_counts GROUP BY word)
    WHERE df >= 2 ORDER BY f DESC, word LIMIT 500""",
)
view(
    "v_topic_words",
    """SELECT topic, rank, word, round(weight, 6) AS weight FROM (
    SELECT topic, word, weight, row_number() OVER (PARTITION BY topic ORDER BY round(weight, 9) DESC, word) AS rank FROM (
      SELECT topic, word, n * ln(1 + (SELECT avg(s) FROM (SELECT sum(n) AS s FROM v_term_counts JOIN v_features USING (word) GROUP BY topic)) / f) AS weight
      FROM v_term_counts JOIN v_features USING (word)) WHERE topic <> -1) WHERE rank <= 10""",
)
view(
    "v_topic_labels",
    """SELECT DISTINCT c.topic, CASE WHEN c.topic = -1 THEN 'outliers' ELSE coalesce(w.label, 'topic_' || c.topic) END AS label
    FROM v_clustered c LEFT JOIN (SELECT topic, string_agg(word, '_' ORDER BY rank) AS label FROM v_topic_words
      WHERE rank <= 3 GROUP BY topic) w ON w.topic = c.topic""",
)


def clustered(spark: SparkSession, folder: str) -> DataFrame:
    vectors = read_table(spark, folder, "embeddings").select(
        F.col("vec_id").cast("string").alias("msg_id"), F.when(F.col("label") == 0, -1).otherwise(F.col("label")).alias("discovery_topic_id")
    )
    # a text without a vector is an outlier
    joined = texts(spark, folder).join(vectors, "msg_id", "left").fillna({"discovery_topic_id": -1})
    return joined.withColumns(
        {"distance": F.length("text"), "discovery_topic_probability": (F.col("discovery_topic_id") + 1) / 10}
    )


def _labels(df: DataFrame) -> DataFrame:
    ids = df.select(F.col("discovery_topic_id").alias("topic")).distinct()
    return discovery.topic_labels(discovery.topic_words(df), ids)


@query("P09", "SELECT topic, rank, word, weight FROM v_topic_words")
def topic_words(spark: SparkSession, folder: str) -> DataFrame:
    rows = discovery.topic_words(clustered(spark, folder))
    return rows.withColumn("rank", F.col("rank").cast("long"))


@query("P10", "SELECT c.msg_id, l.label AS discovery_topic_label FROM v_clustered c JOIN v_topic_labels l ON l.topic = c.topic")
def discovery_labels(spark: SparkSession, folder: str) -> DataFrame:
    df = clustered(spark, folder)
    return discovery.add_labels(df, _labels(df)).select("msg_id", "discovery_topic_label")


@query(
    "P12",
    """SELECT c.topic, any_value(l.label) AS label, count(*) AS size,
    coalesce(string_agg(CASE WHEN length(c.text) > 200 THEN c.text[1:200] || '...' ELSE c.text END, '|' ORDER BY c.r)
      FILTER (c.r <= 3 AND c.topic <> -1), '') AS docs
    FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY distance, msg_id) AS r FROM v_clustered) c
    JOIN v_topic_labels l ON l.topic = c.topic GROUP BY c.topic""",
)
def topic_details(spark: SparkSession, folder: str) -> DataFrame:
    df = clustered(spark, folder)
    rows = discovery.topic_details(df, _labels(df))
    return rows.select("topic", "label", "size", F.array_join("representative_docs", "|").alias("docs"))


@query(
    "P13",
    """SELECT t.topic, CASE WHEN b.share >= 0.05 THEN b.label WHEN t.topic = -1 THEN 'other' ELSE 'NEW_TOPIC_' || t.topic END AS ontology_topic
    FROM (SELECT DISTINCT topic FROM v_clustered) t LEFT JOIN (
      SELECT topic, label, share, row_number() OVER (PARTITION BY topic ORDER BY share DESC, ord) AS r FROM (
        SELECT w.topic, k.label, k.ord, round(sum(w.weight) / any_value(x.total), 9) AS share FROM v_topic_words w
        JOIN v_keywords k ON k.keyword = w.word JOIN (SELECT topic, sum(weight) AS total FROM v_topic_words GROUP BY topic) x ON x.topic = w.topic
        GROUP BY w.topic, k.label, k.ord)) b ON b.topic = t.topic AND b.r = 1""",
)
def discovery_to_ontology(spark: SparkSession, folder: str) -> DataFrame:
    df = clustered(spark, folder)
    keywords = _ontology_keywords(spark)
    ids = df.select(F.col("discovery_topic_id").alias("topic")).distinct()
    return discovery.map_to_ontology(discovery.topic_words(df), ids, keywords, threshold=0.05, number_new=True)


@query(
    "P14",
    """SELECT count(*) AS total_messages, count(*) FILTER (topic <> -1) AS messages_with_topics,
    count(*) FILTER (topic = -1) AS outlier_messages, count(DISTINCT CASE WHEN topic <> -1 THEN topic END) AS unique_topics,
    round(avg((topic + 1) / 10.0::DOUBLE), 6) AS avg_topic_probability,
    round(count(*) FILTER (topic <> -1)::DOUBLE / count(*) * 100, 6) AS topic_coverage FROM v_clustered""",
)
def discovery_statistics(spark: SparkSession, folder: str) -> DataFrame:
    return discovery.discovery_stats(clustered(spark, folder))


def _ontology_keywords(spark: SparkSession) -> DataFrame:
    rows = [(i, label, k) for i, (label, words, _) in enumerate(topics.ONTOLOGY) for k in words]
    return spark.createDataFrame(rows, "ord int, label string, keyword string")


def _chain(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    vectors = read_table(spark, folder, "embeddings").select(F.col("vec_id").cast("string").alias("msg_id"), "embedding")
    return discovery.discovered_topics(texts(spark, folder), vectors, _ontology_keywords(spark), threshold=0.05, probability="mixture")


@query("P07 P08 P09 P10 P11 P12 P13")
def discovered_topics(spark: SparkSession, folder: str) -> DataFrame:
    """Every topic that the clustering finds, with words, label, examples and ontology topic made from the clustering itself."""
    _, found = _chain(spark, folder)
    return found.select("topic", "label", "size", "mean_probability", F.array_join("words", "|").alias("words"), "ontology_topic", F.array_join("representative_docs", "|").alias("docs"))


@query("P08 P10 P14")
def discovered_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Every message with the topic that the clustering gives it."""
    rows, _ = _chain(spark, folder)
    return rows.select("msg_id", "discovery_topic_id", F.round("discovery_topic_probability", 6).alias("discovery_topic_probability"), F.round("distance", 6).alias("distance"), "discovery_topic_label")


@query(
    "P06",
    """SELECT n AS messages, greatest(10, n // 50) AS min_cluster_size, least(15, n // 10) AS n_neighbors,
    CASE WHEN n > 100 THEN least(20, n // 30) END AS nr_topics, greatest(5, n // 100) AS min_topic_size
    FROM (SELECT count(*) AS n FROM documents)""",
)
def discovery_parameters(spark: SparkSession, folder: str) -> DataFrame:
    rows = discovery.adaptive_parameters(read_table(spark, folder, "documents"))
    return rows.select(*[F.col(c).cast("long").alias(c) for c in rows.columns])


@query(
    "P06",
    """SELECT msg_id, CASE WHEN length(text) > 10 THEN text[1:1000] END AS discovery_text FROM v_texts""",
)
def discovery_inputs(spark: SparkSession, folder: str) -> DataFrame:
    return discovery.discovery_input(texts(spark, folder)).select("msg_id", "discovery_text")


@query("P07 P08 P11 P15")
def embedding_clusters(spark: SparkSession, folder: str) -> DataFrame:
    found = discovery.cluster_embeddings(read_table(spark, folder, "embeddings"))
    return discovery.reduce_topics(found, 15).groupBy("discovery_topic_id", "discovery_status").agg(
        F.count("*").alias("size"), F.round(F.avg("discovery_topic_probability"), 4).alias("mean_probability")
    )
