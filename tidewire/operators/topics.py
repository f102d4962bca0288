"""Topics: ontology keywords, statistics and trends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions import lexicons as lex
from tidewire.functions.bitmap import bitmap, only_in
from tidewire.functions.spans import sql_text
from tidewire.functions.text import NOT_WORD, TOKEN
from tidewire.operators.matching import text_keys

# (label, keywords, weight)
Topic = tuple[str, tuple[str, ...], float]
ONTOLOGY: tuple[Topic, ...] = tuple((label, words, 1.0) for label, words in lex.ONTOLOGY)


def _phrases(ontology: Sequence[Topic]) -> dict[int, set[str]]:
    by_length: dict[int, set[str]] = {}
    for _, keywords, _ in ontology:
        for keyword in keywords:
            by_length.setdefault(len(keyword.split()), set()).add(" ".join(keyword.lower().split()))
    return by_length


def _in(values) -> str:
    return "(" + ", ".join(sql_text(v) for v in sorted(values)) + ")"


def keyword_hits(text: str, ontology: Sequence[Topic]) -> Column:
    """Every occurrence of an ontology keyword, as token sequences, ignoring case."""
    parts = []
    for n, phrases in sorted(_phrases(ontology).items()):
        if n == 1:
            parts.append(f"filter(t, w -> w IN {_in(phrases)})")
        else:
            firsts = _in({p.split()[0] for p in phrases})
            joined = " || ' ' || ".join(f"t[i + {k}]" if k else "t[i]" for k in range(n))
            parts.append(
                f"filter(transform(t, (w, i) -> CASE WHEN w IN {firsts} AND i + {n - 1} < size(t) "
                f"THEN {joined} END), p -> p IN {_in(phrases)})"
            )
    return F.expr(
        f"transform(array(array_remove(split(lower({text}), {sql_text(NOT_WORD)}), '')), t -> concat({', '.join(parts)}))[0]"
    )


def _joined_shares(df: DataFrame, ontology: DataFrame, text: str, salts: int = 16) -> DataFrame:
    """``_t1, _t2`` (see ``text_keys``) and ``_shares`` for texts with a keyword, from an ontology of any size.

    Token runs as long as some keyword pass a bitmap of fixed size and meet the keywords in a salted join. Only the
    numbers of words that keywords have, a few, reach the driver. Copies of a text are counted together, which leaves their shares as they are.
    """
    phrase = F.trim(F.regexp_replace(F.lower("keyword"), r"\s+", " "))
    known = ontology.filter("label IS NOT NULL AND keyword IS NOT NULL").select("ord", "label", F.col("weight").cast("double").alias("weight"), phrase.alias("phrase")).filter("phrase <> ''")
    known = known.distinct().withColumns({"size": F.size(F.split("phrase", " ")), "h": F.xxhash64("phrase")})
    sizes = [r["size"] for r in known.select("size").distinct().collect()]
    if not sizes:
        return df.sparkSession.createDataFrame([], "_t1 long, _t2 long, _shares array<struct<confidence:double,ord:int,topic:string>>")
    rows = df.select(*text_keys(text), F.expr(f"regexp_extract_all(lower({text}), {sql_text(TOKEN)}, 0)").alias("_w")).filter("_w IS NOT NULL")
    bits, found = bitmap(known, "h"), None
    for size in sizes:
        spots = rows.select("_t1", "_t2", "_w", F.explode(F.when(F.size("_w") >= size, F.sequence(F.lit(1), F.size("_w") - (size - 1)))).alias("_p"))
        spots = spots.select("_t1", "_t2", F.array_join(F.slice("_w", F.col("_p"), size), " ").alias("phrase")).withColumn("h", F.xxhash64("phrase"))
        part = only_in(spots, "h", bits).select("_t1", "_t2", "phrase")
        found = part if found is None else found.unionByName(part)
    counts = found.groupBy("_t1", "_t2", "phrase").agg(F.count(F.lit(1)).alias("n")).withColumn("_salt", F.pmod("_t1", F.lit(salts)).cast("int"))
    side = known.select("ord", "label", "weight", "phrase").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    scores = counts.join(side, ["phrase", "_salt"]).groupBy("_t1", "_t2", "ord").agg(F.first("label").alias("topic"), (F.sum("n") * F.first("weight")).alias("s"))
    every = scores.groupBy("_t1", "_t2").agg(F.array_sort(F.collect_list(F.struct("ord", "topic", "s"))).alias("_all"))
    total = F.aggregate("_all", F.lit(0.0), lambda a, x: a + x["s"])
    shares = F.transform("_all", lambda x: F.struct((x["s"] / total).alias("confidence"), (-x["ord"]).cast("int").alias("ord"), x["topic"].alias("topic")))
    return every.select("_t1", "_t2", F.filter(shares, lambda x: x["confidence"] > 0).alias("_shares"))


def ontology_topics(
    df: DataFrame, ontology: Sequence[Topic] | DataFrame = ONTOLOGY, text: str = "text", threshold: float = 0.3
) -> DataFrame:
    """Add topic columns from weighted keyword matches.

    A topic's confidence is its share of all weighted matches. Topics at or above
    the threshold are kept; the primary topic is the best, earlier topics winning
    ties, and ``other`` with 0.0 when nothing matched. An ontology given as rows is
    tested inside the row; one given as the frame of ``read_ontology`` is joined and may have any size.
    """
    if isinstance(ontology, DataFrame):
        first, second = text_keys(text)
        keyed = df.withColumns({"_t1": first, "_t2": second}).join(_joined_shares(df, ontology, text), ["_t1", "_t2"], "left")
        return add_topic_columns(keyed, "_shares", threshold).drop("_t1", "_t2", "_shares")
    scores = [
        F.struct(
            F.lit(label).alias("topic"),
            (F.size(F.filter("_hits", lambda h: h.isin(*[" ".join(k.lower().split()) for k in keywords]))) * F.lit(float(weight))).alias("s"),
        )
        for label, keywords, weight in ontology
    ]
    df = df.withColumn("_hits", F.coalesce(keyword_hits(text, ontology), F.array().cast("array<string>")))
    df = df.withColumn("_scores", F.when(F.size("_hits") > 0, F.array(*scores)))
    total = F.aggregate("_scores", F.lit(0.0), lambda a, x: a + x["s"])
    shares = F.transform(
        "_scores",
        lambda x, i: F.struct((x["s"] / total).alias("confidence"), (-i).alias("ord"), x["topic"].alias("topic")),
    )
    df = df.withColumn("_shares", F.filter(shares, lambda x: x["confidence"] > 0))
    return add_topic_columns(df, "_shares", threshold).drop("_hits", "_scores", "_shares")


def add_topic_columns(df: DataFrame, shares: str, threshold: float = 0.3) -> DataFrame:
    """Topic columns from an ``array<struct<confidence, ord, topic>>`` column, whatever
    produced it (keywords or a zero-shot model)."""
    kept = F.filter(F.col(shares), lambda x: x["confidence"] >= threshold)
    best = F.array_max(kept)
    df = df.withColumns({"_kept": kept})
    best = F.array_max("_kept")
    ranked = F.reverse(F.array_sort("_kept"))
    label = F.coalesce(best["topic"], F.lit("other"))
    confidence = F.coalesce(best["confidence"], F.lit(0.0))
    count = F.coalesce(F.size("_kept"), F.lit(0))
    count = F.greatest(count, F.lit(0)).cast("long")
    record = F.struct(
        F.coalesce(
            F.transform(ranked, lambda x: F.struct(x["topic"].alias("topic"), x["confidence"].alias("confidence"))),
            F.array().cast("array<struct<topic:string,confidence:double>>"),
        ).alias("topics"),
        label.alias("primary_topic"),
        confidence.alias("primary_confidence"),
        count.alias("topic_count"),
    )
    return df.withColumns(
        {
            "ontology_topic_classification": record,
            "ontology_topic_label": label,
            "ontology_topic_confidence": confidence,
            "ontology_topic_count": count,
            "topic_classification": record,
            "primary_topic": label,
            "primary_topic_confidence": confidence,
            "topic_count": count,
        }
    ).drop("_kept")


def topics_from_scores(df: DataFrame, scores: str = "scores", threshold: float = 0.3) -> DataFrame:
    """Topic columns from zero-shot scores ``array<struct<label, score>>``."""
    shares = F.transform(
        F.col(scores),
        lambda s, i: F.struct(s["score"].alias("confidence"), (-i).alias("ord"), s["label"].alias("topic")),
    )
    return add_topic_columns(df.withColumn("_shares", shares), "_shares", threshold).drop("_shares")


def topic_distribution(df: DataFrame, top_k: int = 15) -> DataFrame:
    return (
        df.groupBy("primary_topic").agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "primary_topic").limit(top_k)
    )


def topic_stats(df: DataFrame, threshold: float = 0.3) -> DataFrame:
    confident = F.count_if(F.col("primary_topic_confidence") >= threshold)
    multi = F.count_if(F.col("topic_count") > 1)
    total = F.count("*")
    return df.agg(
        total.alias("total_messages"),
        F.countDistinct("primary_topic").alias("unique_topics_found"),
        F.round(F.avg("primary_topic_confidence"), 6).alias("avg_confidence"),
        confident.alias("confident_classifications"),
        F.round(confident / total * 100, 6).alias("confident_percentage"),
        multi.alias("multi_topic_messages"),
        F.round(multi / total * 100, 6).alias("multi_topic_percentage"),
    )


def topic_trends(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Day by topic counts with totals and percentages; ``labels`` fixes the columns,
    so no extra pass is needed to find them."""
    wide = df.groupBy(F.to_date("date").alias("day")).pivot("primary_topic", list(labels)).agg(F.count(F.lit(1)))
    wide = wide.fillna(0, subset=list(labels))
    total = F.lit(0).cast("long")
    for label in labels:
        total = total + F.col(label)
    wide = wide.withColumn("total_messages", total)
    return wide.withColumns(
        {f"{x}_pct": F.bround(F.try_divide(F.col(x), F.col("total_messages")) * 100, 2) for x in labels}
    )
