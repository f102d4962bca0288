"""Topic discovery: clustering of embeddings, topic words, labels and statistics."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewire.functions.text import bind, strip, tokens
from tidewire.sources.tables import cut_lineage, work_folder

OUTLIER = -1
# Common English words left out of topic words.
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "from", "had", "has", "have",
    "he", "her", "his", "i", "in", "is", "it", "its", "not", "of", "on", "or", "our", "she", "so",
    "that", "the", "their", "them", "they", "this", "to", "was", "we", "were", "which", "who",
    "will", "with", "you", "your",
)


def discovery_input(df: DataFrame, text: str = "text", max_length: int | None = 1000, min_length: int = 10) -> DataFrame:
    """Add ``discovery_text``: text longer than ``min_length``, cut to ``max_length``
    for the encoder; null marks a message that will be an outlier."""
    body = F.coalesce(F.col(text), F.lit(""))
    usable = F.length(strip(body)) > min_length
    cut = body if max_length is None else F.substring(body, 1, max_length)
    return df.withColumn("discovery_text", F.when(usable, cut))


def adaptive_parameters(df: DataFrame) -> DataFrame:
    """Clustering parameters from the number of messages, as one row."""
    n = F.count("*")
    return df.agg(n.alias("messages")).select(
        "messages",
        F.greatest(F.lit(10), F.floor(F.col("messages") / 50)).alias("min_cluster_size"),
        F.least(F.lit(15), F.floor(F.col("messages") / 10)).alias("n_neighbors"),
        F.when(F.col("messages") > 100, F.least(F.lit(20), F.floor(F.col("messages") / 30))).alias("nr_topics"),
        F.greatest(F.lit(5), F.floor(F.col("messages") / 100)).alias("min_topic_size"),
    )


def cluster_embeddings(
    df: DataFrame,
    key: str = "vec_id",
    embedding: str = "embedding",
    candidates: Sequence[int] = (5, 10, 20),
    components: int = 5,
    min_cluster_size: int = 10,
    max_spread: float = 3.0,
    seed: int = 7,
    probability: str = "distance",
) -> DataFrame:
    """(key, discovery_topic_id, discovery_topic_probability, distance, centre_distances, discovery_status).

    Vectors are reduced by PCA and clustered by k-means; k is the candidate with
    the best silhouette. A row is an outlier when its cluster is smaller than
    ``min_cluster_size`` or it lies more than ``max_spread`` times the cluster's
    mean distance from the centre. Too few rows make every row an outlier, and
    the status says so. Rows whose vector is null or holds null or non-finite numbers are outliers with status ``no_vector``.

    The probability of a row's topic is the share of its closeness to all
    centres (``distance``), or (``mixture``) its posterior in the mixture of round normal
    distributions that has the clusters' shares, centres and spreads.
    """
    numbers = F.col(embedding).cast("array<double>")
    sound = F.coalesce((F.size(numbers) > 0) & F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    unusable = df.filter(~sound).select(
        key, F.lit(OUTLIER).alias("discovery_topic_id"), F.lit(0.0).alias("discovery_topic_probability"),
        F.lit(None).cast("double").alias("distance"), F.lit(None).cast("array<double>").alias("centre_distances"), F.lit("no_vector").alias("discovery_status"),
    )
    vectors = df.filter(sound).select(key, array_to_vector(numbers).alias("v"))
    rows = vectors.count()
    usable = [k for k in candidates if 2 <= k < rows]
    if rows < min_cluster_size or not usable:
        return vectors.select(
            key, F.lit(OUTLIER).alias("discovery_topic_id"), F.lit(0.0).alias("discovery_topic_probability"),
            F.lit(None).cast("double").alias("distance"), F.lit(None).cast("array<double>").alias("centre_distances"), F.lit("too_few_rows").alias("discovery_status"),
        ).unionByName(unusable)
    reduced = PCA(k=components, inputCol="v", outputCol="features").fit(vectors).transform(vectors).select(key, "features")
    # read by every candidate
    reduced = cut_lineage(reduced)
    evaluator = ClusteringEvaluator(featuresCol="features")
    fitted = []
    for k in usable:
        model = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="prediction").fit(reduced)
        fitted.append((evaluator.evaluate(model.transform(reduced)), -k, model))
    model = max(fitted, key=lambda f: f[:2])[2]
    # k centres of `components` numbers each.
    centres = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in model.clusterCenters()])
    point = vector_to_array("features")
    near = F.transform(
        centres,
        lambda c: F.sqrt(F.aggregate(F.zip_with(c, point, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)),
    )
    scored = model.transform(reduced).select(key, "prediction", near.alias("d")).withColumns(
        {
            "distance": F.get("d", F.col("prediction")),
            "closeness": F.transform("d", lambda x: 1.0 / (x + 1e-9)),
        }
    )
    # one row per cluster; the driver holds k of them
    stats = scored.groupBy("prediction").agg(F.count("*").alias("size"), F.avg("distance").alias("mean"), F.avg(F.col("distance") * F.col("distance")).alias("spread")).collect()
    if probability == "mixture":
        by = {r["prediction"]: r for r in stats}
        # log share - dimensions / 2 * log variance - distance^2 / (2 variance), the variance being that of one dimension
        variance = [max(by[i]["spread"] / components, 1e-12) if i in by else 1.0 for i in range(len(model.clusterCenters()))]
        constant = [math.log(by[i]["size"] / sum(r["size"] for r in stats)) - components / 2 * math.log(v) if i in by else float("-inf") for i, v in enumerate(variance)]
        logs = F.zip_with("d", F.arrays_zip(F.array(*map(F.lit, constant)).alias("c"), F.array(*map(F.lit, variance)).alias("v")), lambda d, m: m["c"] - d * d / (2 * m["v"]))
        scored = scored.withColumn("_logs", logs).withColumn("closeness", F.transform("_logs", lambda x: F.exp(x - F.array_max("_logs"))))
    share = F.get("closeness", F.col("prediction")) / F.aggregate("closeness", F.lit(0.0), lambda s, x: s + x)
    sizes = df.sparkSession.createDataFrame([(r["prediction"], r["size"], r["mean"]) for r in stats], "prediction int, size long, mean double")
    joined = scored.withColumn("p", share).join(F.broadcast(sizes), "prediction")
    outlier = (F.col("size") < min_cluster_size) | (F.col("distance") > F.col("mean") * max_spread)
    return joined.select(
        key,
        F.when(outlier, OUTLIER).otherwise(F.col("prediction")).alias("discovery_topic_id"),
        F.when(outlier, 0.0).otherwise(F.col("p")).alias("discovery_topic_probability"),
        "distance",
        F.col("d").alias("centre_distances"),
        F.lit("clustered").alias("discovery_status"),
    ).unionByName(unusable)


def reduce_topics(clusters: DataFrame, nr_topics: int) -> DataFrame:
    """Keep the ``nr_topics`` largest topics; each row of a smaller one goes to the kept topic with the nearest centre. Outliers stay."""
    sizes = clusters.filter(F.col("discovery_topic_id") != OUTLIER).groupBy("discovery_topic_id").agg(F.count("*").alias("n"))
    largest = sizes.orderBy(F.desc("n"), "discovery_topic_id").limit(nr_topics)
    kept = largest.agg(F.collect_list("discovery_topic_id").alias("_kept"))
    ways = F.col("centre_distances")
    nearest = F.array_min(F.transform("_kept", lambda t: F.struct(F.get(ways, t).alias("d"), t.alias("t"))))
    moves = (F.col("discovery_topic_id") != OUTLIER) & ~F.array_contains("_kept", F.col("discovery_topic_id"))
    share = (1.0 / (nearest["d"] + 1e-9)) / F.aggregate(ways, F.lit(0.0), lambda a, x: a + 1.0 / (x + 1e-9))
    return clusters.join(F.broadcast(kept), F.lit(True)).withColumns(
        {
            "discovery_topic_id": F.when(moves, nearest["t"]).otherwise(F.col("discovery_topic_id")),
            "discovery_topic_probability": F.when(moves, share).otherwise(F.col("discovery_topic_probability")),
            "distance": F.when(moves, nearest["d"]).otherwise(F.col("distance")),
        }
    ).drop("_kept")


def _kept_words(text: str, stop_words: Sequence[str]) -> Column:
    """Words of at least two characters, stop words removed."""
    return F.filter(tokens(text), lambda t: (F.length(t) > 1) & ~t.isin(*stop_words))


def _term_counts(df: DataFrame, topic: str, text: str, min_df: int, max_features: int, stop_words: Sequence[str]) -> DataFrame:
    """(topic, word, n) of all words, and of the neighbouring pairs of words that may be among the ``max_features`` most frequent terms.

    A pair is found no oftener and in no more topics than either of its words. So a pair with a word rarer than the
    ``max_features``-th word cannot be chosen; it is left out before the counting, which the other pairs go through whole.
    """
    words = df.select(F.col(topic).alias("topic"), F.explode(_kept_words(text, stop_words)).alias("word"))
    singles = cut_lineage(words.groupBy("topic", "word").agg(F.count("*").alias("n")))
    known = singles.groupBy("word").agg(F.sum("n").alias("f"), F.count("*").alias("df")).filter(F.col("df") >= min_df)
    least, found = known.orderBy(F.desc("f")).limit(max_features).agg(F.min("f"), F.count("*")).first()
    # stored, so that Spark knows its size when it joins
    path = work_folder(df.sparkSession, "terms")
    known.filter(F.col("f") >= (least if found == max_features else 0)).select("word").write.parquet(path)
    frequent = df.sparkSession.read.parquet(path)
    pairs = bind(_kept_words(text, stop_words), lambda w: F.transform(F.slice(w, 2, F.size(w)), lambda x, i: F.struct(F.get(w, i).alias("a"), x.alias("b"))))
    both = df.select(F.col(topic).alias("topic"), F.explode(pairs).alias("p")).select("topic", "p.a", "p.b")
    both = both.join(frequent.withColumnRenamed("word", "a"), "a", "left_semi").join(frequent.withColumnRenamed("word", "b"), "b", "left_semi")
    doubles = both.groupBy("topic", "a", "b").agg(F.count("*").alias("n")).select("topic", F.concat_ws(" ", "a", "b").alias("word"), "n")
    return singles.unionByName(cut_lineage(doubles))


def topic_words(
    df: DataFrame,
    topic: str = "discovery_topic_id",
    text: str = "text",
    top_k: int = 10,
    min_df: int = 2,
    max_features: int = 500,
    stop_words: Sequence[str] = STOP_WORDS,
) -> DataFrame:
    """(topic, rank, word, weight): the best terms per topic by class TF-IDF.

    A topic is treated as one long document: terms found in fewer than ``min_df``
    topics are dropped, the ``max_features`` most frequent stay, and a term weighs
    its count in the topic times log(1 + A / f), with A the mean number of terms
    per topic and f the term's total count. Counting combines per task; the rest
    works on (topic, term) counts, which are stored.
    """
    counts = _term_counts(df, topic, text, min_df, max_features, stop_words)
    total = counts.groupBy("word").agg(F.sum("n").alias("f"), F.count("*").alias("df")).filter(F.col("df") >= min_df)
    features = total.orderBy(F.desc("f"), "word").limit(max_features)
    chosen = counts.join(F.broadcast(features), "word")
    mean = chosen.groupBy("topic").agg(F.sum("n").alias("s")).agg(F.avg("s").alias("a"))
    weighted = chosen.join(F.broadcast(mean), F.lit(True)).withColumn("weight", F.col("n") * F.log(1 + F.col("a") / F.col("f")))
    rank = F.row_number().over(W.partitionBy("topic").orderBy(F.desc(F.round("weight", 9)), "word"))
    return (
        weighted.filter(F.col("topic") != OUTLIER).withColumn("rank", rank).filter(F.col("rank") <= top_k)
        .select("topic", "rank", "word", F.round("weight", 6).alias("weight"))
    )


def topic_labels(words: DataFrame, topics: DataFrame) -> DataFrame:
    """(topic, label): the first three words joined, ``outliers`` for -1 and
    ``topic_n`` when a topic has no words. ``topics`` holds the distinct topics."""
    top = words.filter("rank <= 3").groupBy("topic").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "word"))), lambda x: x["word"]), "_").alias("w")
    )
    return topics.join(top, "topic", "left").select(
        "topic",
        F.when(F.col("topic") == OUTLIER, "outliers")
        .otherwise(F.coalesce("w", F.concat(F.lit("topic_"), F.col("topic").cast("string")))).alias("label"),
    )


def add_labels(df: DataFrame, labels: DataFrame, topic: str = "discovery_topic_id") -> DataFrame:
    """Add ``discovery_topic_label``; topics without a label are ``unknown``."""
    named = labels.select(F.col("topic").alias(topic), F.col("label").alias("_label"))
    return df.join(named, topic, "left").withColumn("discovery_topic_label", F.coalesce("_label", F.lit("unknown"))).drop("_label")


def topic_details(df: DataFrame, labels: DataFrame, topic: str = "discovery_topic_id", distance: str = "distance", docs: int = 3) -> DataFrame:
    """Size, label and the ``docs`` most central texts (200 characters) per topic."""
    near = F.row_number().over(W.partitionBy(topic).orderBy(distance, "msg_id"))
    ranked = df.withColumn("_r", near).filter(F.col("_r") <= docs)
    shown = F.when(F.length("text") > 200, F.concat(F.substring("text", 1, 200), F.lit("..."))).otherwise(F.col("text"))
    examples = ranked.filter(F.col(topic) != OUTLIER).groupBy(topic).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_r", shown.alias("t")))), lambda x: x["t"]).alias("representative_docs")
    )
    sizes = df.groupBy(topic).agg(F.count("*").alias("size"))
    named = labels.select(F.col("topic").alias(topic), "label")
    return sizes.join(named, topic, "left").join(examples, topic, "left").select(
        F.col(topic).alias("topic"), "label", "size",
        F.coalesce("representative_docs", F.array().cast("array<string>")).alias("representative_docs"),
    )


def map_to_ontology(words: DataFrame, topics: DataFrame, keywords: DataFrame, threshold: float = 0.3, number_new: bool = False) -> DataFrame:
    """(topic, ontology_topic): the ontology topic with the largest share of the topic
    words' weight, if at least ``threshold``; otherwise ``other`` or ``NEW_TOPIC_n``."""
    words = cut_lineage(words)
    total = words.groupBy("topic").agg(F.sum("weight").alias("total"))
    found = words.join(keywords.select("ord", "label", F.lower("keyword").alias("word")), "word").groupBy("topic", "ord", "label").agg(
        F.sum("weight").alias("w")
    )
    best = found.join(total, "topic").withColumn("share", F.round(F.col("w") / F.col("total"), 9)).groupBy("topic").agg(
        F.min_by(F.struct("label", "share"), F.struct(-F.col("share"), F.col("ord"))).alias("b")
    )
    missing = F.lit("other")
    if number_new:
        missing = F.when(F.col("topic") != OUTLIER, F.concat(F.lit("NEW_TOPIC_"), F.col("topic").cast("string"))).otherwise("other")
    return topics.join(best, "topic", "left").select(
        "topic", F.when(F.col("b.share") >= threshold, F.col("b.label")).otherwise(missing).alias("ontology_topic")
    )


def discovery_stats(df: DataFrame) -> DataFrame:
    with_topic = F.count_if(F.col("discovery_topic_id") != OUTLIER)
    return df.agg(
        F.count("*").alias("total_messages"),
        with_topic.alias("messages_with_topics"),
        F.count_if(F.col("discovery_topic_id") == OUTLIER).alias("outlier_messages"),
        F.countDistinct(F.when(F.col("discovery_topic_id") != OUTLIER, F.col("discovery_topic_id"))).alias("unique_topics"),
        F.round(F.avg("discovery_topic_probability"), 6).alias("avg_topic_probability"),
        F.round(with_topic / F.count("*") * 100, 6).alias("topic_coverage"),
    )


def discovered_topics(df: DataFrame, vectors: DataFrame, keywords: DataFrame, nr_topics: int = 15, key: str = "msg_id", threshold: float = 0.3, **options) -> tuple[DataFrame, DataFrame]:
    """The whole chain: the messages with their topics, and one row per topic.

    Vectors are clustered once and the ids, probabilities and distances stored;
    words, labels, examples and the ontology are all made from them. A message without a
    vector is an outlier. Messages get ``discovery_topic_id, discovery_topic_probability,
    distance, discovery_topic_label``; topics ``topic, label, size, mean_probability, words, ontology_topic, representative_docs``.
    """
    found = cut_lineage(reduce_topics(cluster_embeddings(vectors, key=key, **options), nr_topics).drop("centre_distances", "discovery_status"))
    rows = df.join(found, key, "left").fillna({"discovery_topic_id": OUTLIER, "discovery_topic_probability": 0.0})
    words = cut_lineage(topic_words(rows))
    sizes = cut_lineage(rows.groupBy(F.col("discovery_topic_id").alias("topic")).agg(F.round(F.avg("discovery_topic_probability"), 6).alias("mean_probability")))
    ids = sizes.select("topic")
    labels = cut_lineage(topic_labels(words, ids))
    listed = words.groupBy("topic").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "word"))), lambda x: x["word"]).alias("words"))
    topics = topic_details(rows.withColumn("msg_id", F.col(key)), labels).join(sizes, "topic").join(listed, "topic", "left")
    topics = topics.join(map_to_ontology(words, ids, keywords, threshold, number_new=True), "topic")
    return add_labels(rows, labels), topics.withColumn("words", F.coalesce("words", F.array().cast("array<string>")))
