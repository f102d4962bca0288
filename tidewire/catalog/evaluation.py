"""Evaluation queries. Gold annotations are derived from the data: the system's own
results with every third message's spans cut short, some speakers, types and labels
changed, and some entries dropped, so that every kind of error occurs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.catalog.messages import texts
from tidewire.catalog.quotes import with_quotes
from tidewire.catalog.registry import query, view
from tidewire.catalog.stance import with_stance
from tidewire.functions import lexicons as lex
from tidewire.operators import evaluation, intervals
from tidewire.sources.tables import cut_lineage

TYPES = lex.ERROR_CATEGORIES


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    return with_quotes(with_stance(texts(spark, folder)))


def gold(df: DataFrame) -> DataFrame:
    """Annotations of the parts that ``df`` has."""
    n = F.col("msg_id").cast("long")
    truth = {
        "quote_spans": lambda: F.transform(
            F.filter("quote_spans", lambda s, i: ~((n % 4 == 1) & (i == 1))),
            lambda s: s.withField("end", F.when(n % 3 == 0, s["start"] + F.floor((s["end"] - s["start"]) * 0.7).cast("int")).otherwise(s["end"]))
            .withField("speaker", F.when((n % 5 == 2) & (s["span_type"] != "author"), F.lit("Somebody Else")).otherwise(s["speaker"]))
            .withField("span_type", F.when((n % 6 == 5) & (s["span_type"] == "author"), F.lit("quoted")).otherwise(s["span_type"])),
        ).alias("spans"),
        "entities": lambda: F.transform(
            F.filter("entities", lambda e, i: ~((n % 5 == 3) & (i == 0))),
            lambda e, i: F.struct(
                e["text"].alias("text"), (e["start"] + F.when(n % 3 == 1, 1).otherwise(0)).alias("start"), e["end"].alias("end"),
                F.when((n % 4 == 2) & (i == 0), F.lit("ORG")).otherwise(e["type"]).alias("type"),
                F.when(n % 7 == 0, F.upper(e["text"])).otherwise(e["text"]).alias("canonical_name"),
            ),
        ).alias("entities"),
        "stance_edges": lambda: F.transform(
            F.filter("stance_edges", lambda e: n % 11 != 0),
            lambda e: F.struct(
                F.when(n % 8 == 6, F.lit("other")).otherwise(e["speaker"]).alias("speaker"), e["target"].alias("target"),
                F.when(n % 5 == 0, F.lit("neutral")).otherwise(e["label"]).alias("label"), e["score"].alias("confidence"),
            ),
        ).alias("stance_edges"),
    }
    kind = F.get(F.array(*[F.lit(t) for t in TYPES]), (n % len(TYPES)).cast("int"))
    return df.filter(n % 10 != 9).select(
        n.alias("message_id"),
        *[c for c in ("text",) if c in df.columns],
        F.struct(*[make() for part, make in truth.items() if part in df.columns]).alias("ground_truth"),
        F.struct(F.array(kind).alias("error_types")).alias("metadata"),
    )


def aligned(spark: SparkSession, folder: str) -> DataFrame:
    df = predictions(spark, folder)
    return evaluation.align(df, gold(df))


def aligned_spans(spark: SparkSession, folder: str, chars: int = 0) -> DataFrame:
    """The spans of both sides, worked out once; no more of their texts than ``chars`` characters is stored or shuffled."""
    df = cut_lineage(with_quotes(texts(spark, folder)).select("msg_id", evaluation.light_spans("quote_spans", chars).alias("quote_spans")))
    return evaluation.align(df, gold(df))


view(
    "v_pspans",
    """SELECT *, row_number() OVER (PARTITION BY msg_id ORDER BY start, stop DESC) - 1 AS pos, CAST(msg_id AS BIGINT) AS n FROM (
    SELECT msg_id, start, stop, text, span_type, speaker FROM v_spans WHERE CAST(msg_id AS BIGINT) % 10 <> 9)""",
)
view(
    "v_gspans",
    """SELECT msg_id, pos, start,
    CASE WHEN n % 3 = 0 THEN start + CAST(floor((stop - start) * 0.7::DOUBLE) AS INT) ELSE stop END AS stop,
    CASE WHEN n % 5 = 2 AND span_type <> 'author' THEN 'Somebody Else' ELSE speaker END AS speaker,
    CASE WHEN n % 6 = 5 AND span_type = 'author' THEN 'quoted' ELSE span_type END AS span_type
    FROM v_pspans WHERE NOT (n % 4 = 1 AND pos = 1)""",
)
view(
    "v_gentities",
    """SELECT msg_id, n, start + CASE WHEN n % 3 = 1 THEN 1 ELSE 0 END AS start, start + size AS stop,
    CASE WHEN n % 4 = 2 AND (rank = 1 OR (rank = 2 AND n % 5 = 3)) AND NOT (n % 5 = 3 AND rank = 1) THEN 'ORG' ELSE type END AS type,
    CASE WHEN n % 7 = 0 THEN upper(text) ELSE text END AS canonical_name
    FROM (SELECT *, CAST(msg_id AS BIGINT) AS n FROM v_entities) WHERE NOT (n % 5 = 3 AND rank = 1) AND n % 10 <> 9""",
)
view(
    "v_gedges",
    """SELECT msg_id, target, CASE WHEN n % 8 = 6 THEN 'other' ELSE 'author' END AS speaker,
    CASE WHEN n % 5 = 0 THEN 'neutral' ELSE label END AS label
    FROM (SELECT *, CAST(msg_id AS BIGINT) AS n FROM v_edges) WHERE n % 11 <> 0 AND n % 10 <> 9""",
)
view("v_pedges", "SELECT * FROM v_edges WHERE CAST(msg_id AS BIGINT) % 10 <> 9")
view("v_pentities", "SELECT *, start + size AS stop FROM v_entities WHERE CAST(msg_id AS BIGINT) % 10 <> 9")
view(
    "v_epairs",
    """SELECT p.msg_id, p.rank, p.type AS ptype, g.type AS gtype, p.start = g.start AND p.stop = g.stop AS same_span,
    p.text = g.canonical_name AS same_name FROM v_pentities p JOIN v_gentities g
    ON g.msg_id = p.msg_id AND p.start < g.stop AND g.start < p.stop""",
)


def matches_sql(threshold: float, only: str = "true") -> str:
    """Each predicted span in turn takes the best free gold span: one after the other, by recursion."""
    return f"""WITH RECURSIVE p AS (SELECT *, row_number() OVER (PARTITION BY msg_id ORDER BY pos) - 1 AS p FROM v_pspans WHERE {only}),
    g AS (SELECT *, row_number() OVER (PARTITION BY msg_id ORDER BY pos) - 1 AS g FROM v_gspans WHERE {only}),
    o AS (SELECT p.msg_id, p.p, list({{'iou': greatest(0, least(p.stop, g.stop) - greatest(p.start, g.start))::DOUBLE
        / nullif((p.stop - p.start) + (g.stop - g.start) - greatest(0, least(p.stop, g.stop) - greatest(p.start, g.start)), 0), 'back': -g.g}}) AS options
      FROM p JOIN g ON g.msg_id = p.msg_id GROUP BY 1, 2),
    r AS (SELECT DISTINCT msg_id, CAST(-1 AS BIGINT) AS p, CAST([] AS BIGINT[]) AS used, CAST(NULL AS STRUCT(iou DOUBLE, back BIGINT)) AS best FROM o
      UNION ALL SELECT msg_id, p, CASE WHEN best IS NULL THEN used ELSE list_append(used, -best.back) END, best FROM (
        SELECT r.msg_id, o.p, r.used, list_max(list_filter(o.options, lambda x: x.iou >= {threshold} AND x.iou > 0 AND NOT list_contains(r.used, -x.back))) AS best
        FROM r JOIN o ON o.msg_id = r.msg_id AND o.p = r.p + 1))
    SELECT r.msg_id, r.p, -best.back AS g, best.iou AS iou, p.speaker AS pspeaker, p.span_type AS ptype, p.start AS pstart, p.text AS ptext, g.speaker AS gspeaker, g.span_type AS gtype
    FROM r JOIN p USING (msg_id, p) JOIN g ON g.msg_id = r.msg_id AND g.g = -best.back WHERE best IS NOT NULL"""


view("v_matches_3", matches_sql(0.3))
view("v_matches_5", matches_sql(0.5))
view("v_matches_8", matches_sql(0.8))
view("v_quote_matches", matches_sql(0.5, "span_type IN ('quoted', 'forwarded')"))
# one row per aligned message with the number of spans on either side
view(
    "v_span_counts",
    """SELECT msg_id, coalesce(p, 0) AS p, coalesce(g, 0) AS g, coalesce(pq, 0) AS pq, coalesce(gq, 0) AS gq FROM v_texts
    LEFT JOIN (SELECT msg_id, count(*) AS p, count(*) FILTER (span_type IN ('quoted', 'forwarded')) AS pq FROM v_pspans GROUP BY 1) USING (msg_id)
    LEFT JOIN (SELECT msg_id, count(*) AS g, count(*) FILTER (span_type IN ('quoted', 'forwarded')) AS gq FROM v_gspans GROUP BY 1) USING (msg_id)
    WHERE doc_id % 10 <> 9""",
)


def metrics_sql(section: str, source: str, **values: str) -> str:
    return " UNION ALL ".join(f"SELECT '{section}' AS section, '{k}' AS metric, round(coalesce(CAST({v} AS DOUBLE), 0), 6) AS value FROM {source}" for k, v in values.items())


_SAME = "CAST(pspeaker = gspeaker AS INTEGER)"
_SPANS = metrics_sql(
    "spans", "v_matches_5", span_accuracy=f"avg({_SAME})", total_spans_evaluated="count(*)", correct_attributions=f"sum({_SAME})",
    **{f"{k}_accuracy": f"avg({_SAME}) FILTER (CASE WHEN gspeaker = 'unknown' THEN 'unknown' ELSE gtype END = '{k}')" for k in ("author", "quoted", "forwarded", "unknown")},
)
_PERFECT = "sum(CAST(p = g AND coalesce(n, 0) = g AND coalesce(other, 0) = 0 AS INTEGER))"
_MESSAGES = metrics_sql(
    "messages",
    "v_span_counts LEFT JOIN (SELECT msg_id, count(*) AS n, count(*) FILTER (NOT coalesce(pspeaker = gspeaker, false)) AS other FROM v_matches_8 GROUP BY 1) USING (msg_id)",
    message_accuracy=f"{_PERFECT}::DOUBLE / count(*)", perfect_attribution_messages=_PERFECT, total_messages_evaluated="count(*)",
)
_TP, _P, _G = "(SELECT count(*) FROM v_quote_matches)::DOUBLE", "sum(pq)", "sum(gq)"
_QUOTES = metrics_sql(
    "quotes", "v_span_counts", quote_detection_precision=f"{_TP} / nullif({_P}, 0)", quote_detection_recall=f"{_TP} / nullif({_G}, 0)",
    quote_detection_f1=f"2 * {_TP} / nullif({_P} + {_G}, 0)", quote_true_positives=f"max({_TP})", quote_false_positives=f"{_P} - {_TP}", quote_false_negatives=f"{_G} - {_TP}",
)
_ERRORS = metrics_sql(
    "errors", "v_span_counts", span_boundary_errors="sum(p + g) - 2 * (SELECT count(*) FROM v_matches_3)",
    speaker_type_errors="max((SELECT count(*) FROM v_matches_3 WHERE ptype <> gtype))", missed_quotes="sum(greatest(gq - pq, 0))", false_quotes="sum(greatest(pq - gq, 0))",
)


@query("J03 V02 V03", "SELECT msg_id, CAST(p AS INTEGER) AS p, CAST(g AS INTEGER) AS g, round(iou, 6) AS iou FROM v_matches_5")
def span_matches(spark: SparkSession, folder: str) -> DataFrame:
    rows = intervals.matched_spans(aligned_spans(spark, folder), "pred_spans", "gold_spans", 0.5)
    return rows.select("msg_id", "p", "g", F.round("iou", 6).alias("iou"))


@query("V04", _SPANS)
def span_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.span_metrics(aligned_spans(spark, folder))


@query("V05", _MESSAGES)
def message_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.message_metrics(aligned_spans(spark, folder))


@query("V06", _QUOTES)
def quote_detection(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.quote_metrics(aligned_spans(spark, folder))


@query("V07", _ERRORS)
def attribution_errors(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.attribution_errors(aligned_spans(spark, folder))


@query(
    "V07 O02",
    "SELECT msg_id, ptext[1:100] AS text, ptype AS predicted_type, gtype AS gold_type FROM v_matches_3 WHERE ptype <> gtype ORDER BY msg_id, pstart LIMIT 10",
)
def attribution_error_examples(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.type_error_examples(aligned_spans(spark, folder, chars=100))


@query(
    "V01 U02 J02",
    """SELECT p.msg_id, p.n AS predicted_spans, g.n AS gold_spans FROM
    (SELECT msg_id, count(*) AS n FROM v_pspans GROUP BY 1) p JOIN
    (SELECT msg_id, count(*) AS n FROM v_gspans GROUP BY 1) g USING (msg_id)""",
)
def aligned_messages(spark: SparkSession, folder: str) -> DataFrame:
    return aligned_spans(spark, folder).select(
        "msg_id", F.size("pred_spans").cast("long").alias("predicted_spans"), F.size("gold_spans").cast("long").alias("gold_spans")
    )


_TYPE_F1 = " UNION ALL ".join(
    f"""SELECT '{t.lower()}_f1', coalesce(2.0::DOUBLE * (SELECT count(DISTINCT msg_id || ':' || rank) FROM v_epairs
      WHERE same_span AND ptype = gtype AND ptype = '{t}') / nullif((SELECT count(*) FROM v_pentities WHERE type = '{t}')
      + (SELECT count(*) FROM v_gentities WHERE type = '{t}'), 0), 0.0)"""
    for t in ("PERSON", "ORG", "LOC", "MISC")
)


_ENTITIES = f"""WITH c AS (SELECT (SELECT count(*) FROM v_pentities) AS np, (SELECT count(*) FROM v_gentities) AS ng,
      count(DISTINCT msg_id || ':' || rank) FILTER (same_span AND ptype = gtype) AS exact,
      count(DISTINCT msg_id || ':' || rank) FILTER (ptype = gtype) AS part_p,
      count(DISTINCT msg_id || ':' || rank) AS touching,
      count(DISTINCT msg_id || ':' || rank) FILTER (same_span) AS bound,
      count(DISTINCT msg_id || ':' || rank) FILTER (same_span AND same_name) AS named FROM v_epairs),
    d AS (SELECT count(*) AS part_g FROM v_gentities g WHERE EXISTS (SELECT 1 FROM v_pentities p WHERE p.msg_id = g.msg_id
      AND p.start < g.stop AND g.start < p.stop AND p.type = g.type))
    SELECT 'entities' AS section, metric, round(value, 6) AS value FROM (
      SELECT 'exact_match_f1' AS metric, 2.0::DOUBLE * exact / (np + ng) AS value FROM c
      UNION ALL SELECT 'partial_match_f1', 2.0::DOUBLE * (part_p::DOUBLE / np) * (part_g::DOUBLE / ng)
        / (part_p::DOUBLE / np + part_g::DOUBLE / ng) FROM c, d
      UNION ALL SELECT 'boundary_accuracy', bound::DOUBLE / touching FROM c
      UNION ALL SELECT 'type_accuracy', exact::DOUBLE / bound FROM c
      UNION ALL SELECT 'alias_accuracy', named::DOUBLE / bound FROM c
      UNION ALL SELECT 'total_entities_evaluated', ng::DOUBLE FROM c UNION ALL {_TYPE_F1})"""


@query("V08", _ENTITIES)
def entity_scores(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.entity_metrics(aligned(spark, folder))


view(
    "v_spairs",
    """SELECT coalesce(p.msg_id, g.msg_id) AS msg_id, p.label AS pl, g.label AS gl, p.method, p.score,
    CASE WHEN p.label IS NOT NULL THEN 'author' END AS ps, g.speaker AS gs
    FROM v_pedges p FULL OUTER JOIN v_gedges g ON p.msg_id = g.msg_id AND p.target = g.target""",
)


def _macro(extra: str) -> str:
    return "(" + " + ".join(
        f"""coalesce(2.0::DOUBLE * count(*) FILTER (pl = '{x}' AND gl = '{x}'{extra})
        / nullif(count(*) FILTER (pl = '{x}') + count(*) FILTER (gl = '{x}'), 0), 0.0)"""
        for x in evaluation.STANCES
    ) + ") / 3"


_STANCE = f"""SELECT 'stance' AS section, metric, round(value, 6) AS value FROM (
      SELECT 'overall_f1' AS metric, {_macro('')} AS value FROM v_spairs
      UNION ALL SELECT 'speaker_aware_f1', {_macro(' AND ps = gs')} FROM v_spairs
      UNION ALL SELECT 'target_entity_f1', 2.0::DOUBLE * count(*) FILTER (pl IS NOT NULL AND gl IS NOT NULL) / (count(pl) + count(gl)) FROM v_spairs
      UNION ALL SELECT 'high_confidence_accuracy', count(*) FILTER (pl = gl AND score >= 0.8)::DOUBLE
        / count(*) FILTER (gl IS NOT NULL AND score >= 0.8) FROM v_spairs
      UNION ALL SELECT 'total_stance_edges_evaluated', count(gl)::DOUBLE FROM v_spairs)"""


@query("V09", _STANCE)
def stance_scores(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.stance_metrics(aligned(spark, folder))


_CONFUSION = """SELECT coalesce(gl, 'none') AS gold_label, coalesce(pl, 'none') AS pred_label, coalesce(method, 'none') AS method,
    count(*) AS edges FROM v_spairs GROUP BY ALL"""


@query("V09", _CONFUSION)
def stance_confusion(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.stance_confusion(aligned(spark, folder))


_CATEGORIES = f"""SELECT ({list(TYPES)!r})[n % {len(TYPES)} + 1] AS error_type, count(*) AS messages FROM (
      SELECT DISTINCT CAST(msg_id AS BIGINT) AS n FROM v_spairs WHERE pl IS NULL OR gl IS NULL OR pl <> gl) GROUP BY 1"""


@query("V10", _CATEGORIES)
def error_category_counts(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.error_categories(aligned(spark, folder))


_SYSTEM = """SELECT 'system' AS section, metric, round(value, 6) AS value FROM (
      SELECT 'total_predictions' AS metric, count(*)::DOUBLE AS value FROM v_quote_flags
      UNION ALL SELECT 'messages_with_quotes', count(*) FILTER (has_quotes)::DOUBLE FROM v_quote_flags
      UNION ALL SELECT 'quote_percentage', count(*) FILTER (has_quotes)::DOUBLE / count(*) * 100 FROM v_quote_flags
      UNION ALL SELECT 'multi_speaker_messages', count(*) FILTER (multi_speaker)::DOUBLE FROM v_quote_flags
      UNION ALL SELECT 'total_entities', count(*)::DOUBLE FROM v_entities
      UNION ALL SELECT 'avg_entities_per_message', count(*)::DOUBLE / (SELECT count(*) FROM v_texts) FROM v_entities
      UNION ALL SELECT 'unique_entities', count(DISTINCT text)::DOUBLE FROM v_entities
      UNION ALL SELECT 'total_stance_edges', count(*)::DOUBLE FROM v_edges
      UNION ALL SELECT 'avg_edges_per_message', count(*)::DOUBLE / (SELECT count(*) FROM v_texts) FROM v_edges
      UNION ALL SELECT 'stance_' || label, count(*)::DOUBLE FROM v_edges GROUP BY label
      UNION ALL SELECT 'processing_coverage', count(*)::DOUBLE / count(*) FILTER (doc_id % 10 <> 9) FROM v_texts)"""


@query("V11", _SYSTEM)
def system_statistics(spark: SparkSession, folder: str) -> DataFrame:
    df = predictions(spark, folder)
    return evaluation.system_stats(df, gold(df))


_REPORT = " UNION ALL ".join(
    f"SELECT section, metric, value FROM ({sql})"
    for sql in (
        _SPANS, _MESSAGES, _QUOTES, _ERRORS, _ENTITIES, _STANCE, _SYSTEM,
        f"SELECT 'confusion' AS section, gold_label || '|' || pred_label || '|' || method AS metric, edges::DOUBLE AS value FROM ({_CONFUSION})",
        f"SELECT 'error_categories' AS section, error_type AS metric, messages::DOUBLE AS value FROM ({_CATEGORIES})",
    )
)


@query("V12 V10", _REPORT)
def evaluation_report(spark: SparkSession, folder: str) -> DataFrame:
    df = predictions(spark, folder)
    return evaluation.full_report(df, gold(df))


@query(
    "V13",
    """WITH x AS (SELECT l.quality AS a, CAST(length(d.text) > 600 AS INTEGER) AS b FROM labels l JOIN documents d USING (doc_id)),
    t AS (SELECT count(*)::DOUBLE AS n, count(*) FILTER (a = b)::DOUBLE AS same FROM x),
    e AS (SELECT sum(na * nb)::DOUBLE AS c FROM (SELECT v, (SELECT count(*) FROM x WHERE a = v) AS na,
      (SELECT count(*) FROM x WHERE b = v) AS nb FROM (SELECT a AS v FROM x UNION SELECT b FROM x)))
    SELECT round(same / n, 6) AS observed, round(c / (n * n), 6) AS expected,
    round((same / n - c / (n * n)) / (1 - c / (n * n)), 6) AS kappa FROM t, e""",
)
def annotator_agreement(spark: SparkSession, folder: str) -> DataFrame:
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    documents = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    pairs = labels.join(documents, "doc_id").select(
        F.col("quality").alias("a"), (F.length("text") > 600).cast("int").alias("b")
    )
    return evaluation.cohen_kappa(pairs, "a", "b")
