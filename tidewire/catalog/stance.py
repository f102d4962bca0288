"""Stance queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.catalog.entities import with_entities
from tidewire.catalog.messages import messages, texts
from tidewire.catalog.quotes import with_quotes
from tidewire.catalog.registry import query, view
from tidewire.catalog.text_scores import sql_list
from tidewire.functions import lexicons as lex
from tidewire.functions.text import unnest
from tidewire.operators import models, stance

_TOK = r"[\p{L}\p{N}_'']+"


def _stance_views(prefix: str, source: str, penalty: float) -> None:
    """Views {prefix}_sent, _tok, _verb, _signal, _rule over ``source``
    (key, msg_id, text), entities by msg_id."""
    view(
        f"{prefix}_tok",
        rf"""SELECT key, msg_id, si, sent, unnest(toks) AS tok, generate_subscripts(toks, 1) AS i FROM (
        SELECT key, msg_id, si, sent, regexp_extract_all(lower(sent), '{_TOK}') AS toks FROM (
        SELECT key, msg_id, unnest(ss) AS sent, generate_subscripts(ss, 1) AS si FROM (
        SELECT key, msg_id, regexp_split_to_array(text, '[.!?]+\s+') AS ss FROM {source})))""",
    )
    view(
        f"{prefix}_verb",
        f"""SELECT *, side * CASE WHEN bool_or(is_neg) OVER before THEN -1 ELSE 1 END AS flipped,
        bool_or(tok IN ({sql_list(lex.STANCE_HEDGES)})) OVER (PARTITION BY key, si) AS hedged FROM (
        SELECT *, tok IN ({sql_list(lex.STANCE_NEGATIONS)}) AS is_neg,
          CASE WHEN tok IN ({sql_list(stance.SUPPORT_FORMS)}) THEN 1
               WHEN tok IN ({sql_list(stance.OPPOSE_FORMS)}) THEN -1 ELSE 0 END AS side FROM {prefix}_tok)
        WINDOW before AS (PARTITION BY key, si ORDER BY i ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)""",
    )
    view(
        f"{prefix}_signal",
        rf"""SELECT v.key, v.msg_id, e.text AS target, e.type AS target_type, v.flipped AS side, v.si, v.tok AS verb,
        CASE WHEN v.hedged THEN 0.7::DOUBLE ELSE 0.8::DOUBLE END - {penalty}::DOUBLE * (abs(v.i - t.i) - 1) AS conf
        FROM (SELECT * FROM {prefix}_verb WHERE side <> 0) v
        JOIN v_entities e ON e.msg_id = v.msg_id AND e.type IN ('PERSON', 'ORG')
        JOIN {prefix}_tok t ON t.key = v.key AND t.si = v.si AND abs(t.i - v.i) <= 5
         AND CASE WHEN regexp_full_match(lower(e.text), '{_TOK}') THEN contains(t.tok, lower(e.text))
             ELSE contains(lower(v.sent), lower(e.text))
               AND len(list_filter(regexp_split_to_array(lower(e.text), '\s+'), lambda p: contains(t.tok, p))) > 0 END""",
    )
    view(
        f"{prefix}_rule",
        f"""SELECT key, msg_id, target, target_type,
        CASE WHEN yes > no AND yes > 0.5 THEN 'support' WHEN no > yes AND no > 0.5 THEN 'oppose' ELSE 'neutral' END AS label,
        CASE WHEN yes > no AND yes > 0.5 THEN least(yes, 1.0) WHEN no > yes AND no > 0.5 THEN least(no, 1.0) ELSE 0.6 END
          AS score, signals FROM (
        SELECT key, msg_id, target, target_type, coalesce(sum(conf) FILTER (side = 1), 0.0) AS yes,
          coalesce(sum(conf) FILTER (side = -1), 0.0) AS no, count(*) AS signals
        FROM {prefix}_signal GROUP BY ALL)""",
    )


view("v_keyed_texts", "SELECT msg_id AS key, msg_id, text FROM v_texts")
_stance_views("v_st", "v_keyed_texts", 0.0)
view(
    "v_edges",
    """SELECT msg_id, target, target_type, label, score, 'rules_preferred' AS method FROM v_st_rule
    WHERE score > 0.7""",
)


def with_stance(df: DataFrame) -> DataFrame:
    return stance.stance_columns(with_entities(df))


@query(
    "G01 G02 G03 G04 G05 G06",
    """SELECT msg_id, target, target_type, label, round(score, 6) AS score, signals FROM v_st_rule""",
)
def stance_rules(spark: SparkSession, folder: str) -> DataFrame:
    ruled = stance.rule_stance(with_entities(texts(spark, folder)))
    rows = unnest(ruled, "rule_stance", "r", "msg_id").filter("r.label <> 'unclear'")
    return rows.select(
        "msg_id", "r.target", "r.target_type", "r.label", F.round("r.score", 6).alias("score"),
        F.size("r.evidence").cast("long").alias("signals"),
    )


@query(
    "G10 G11",
    """SELECT t.msg_id, coalesce(string_agg(e.target || ':' || e.label || ':' || e.method, '|' ORDER BY e.target), '')
    AS edges, count(e.target) AS stance_edge_count FROM v_texts t LEFT JOIN v_edges e USING (msg_id) GROUP BY t.msg_id""",
)
def stance_edges(spark: SparkSession, folder: str) -> DataFrame:
    rows = with_stance(texts(spark, folder))
    named = F.transform("stance_edges", lambda e: F.concat_ws(":", e["target"], e["label"], e["method"]))
    return rows.select("msg_id", F.array_join(F.array_sort(named), "|").alias("edges"), "stance_edge_count")


@query(
    "G07",
    """SELECT msg_id, target, verb, count(*) AS signals FROM v_st_signal GROUP BY ALL
    HAVING msg_id || target IN (SELECT msg_id || target FROM v_edges)""",
)
def stance_evidence(spark: SparkSession, folder: str) -> DataFrame:
    edges = stance.stance_rows(with_stance(texts(spark, folder)), "msg_id")
    return (
        edges.select("msg_id", "target", F.explode("evidence_spans.signal").alias("verb"))
        .groupBy("msg_id", "target", "verb").agg(F.count("*").alias("signals"))
    )


def _pseudo_scores(pairs: DataFrame) -> DataFrame:
    """Stand-in scorer over whole texts: the label favoured depends on text length."""

    def make():
        def predict(bodies, hypotheses):
            favoured = ("support", "opposition", "neutral")
            return [
                (60 + len(b) % 41) / 100.0 if favoured[len(b) % 3] in h else 0.05 for b, h in zip(bodies, hypotheses)
            ]

        return predict

    return models.score_pairs(pairs, make)


@query(
    "G08 G09 F02",
    """SELECT msg_id, target, label, round(score, 6) AS score, method FROM (
    SELECT e.msg_id, e.text AS target,
      CASE WHEN agree THEN mlabel WHEN rscore > 0.7 THEN rlabel WHEN mscore > 0.8 THEN mlabel ELSE 'unclear' END AS label,
      CASE WHEN agree THEN least(rscore * 0.6 + mscore * 0.4, 1.0) WHEN rscore > 0.7 THEN rscore
           WHEN mscore > 0.8 THEN mscore ELSE 0 END AS score,
      CASE WHEN agree THEN 'hybrid_agree' WHEN rscore > 0.7 THEN 'rules_preferred'
           WHEN mscore > 0.8 THEN 'mnli_preferred' END AS method
    FROM (SELECT x.*, rlabel = mlabel AND rscore > 0.6 AND mscore > 0.6 AS agree FROM (
      SELECT e.msg_id, e.text, coalesce(r.label, 'unclear') AS rlabel, coalesce(r.score, 0.0)::DOUBLE AS rscore,
        (['support', 'oppose', 'neutral'])[length(t.text) % 3 + 1] AS mlabel,
        (60 + length(t.text) % 41) / 100.0::DOUBLE AS mscore
      FROM v_entities e JOIN v_texts t USING (msg_id)
      LEFT JOIN v_st_rule r ON r.msg_id = e.msg_id AND r.target = e.text AND r.target_type = e.type
      WHERE e.type IN ('PERSON', 'ORG')) x) e) WHERE label <> 'unclear'""",
)
def stance_with_model(spark: SparkSession, folder: str) -> DataFrame:
    base = with_entities(texts(spark, folder))
    scored = stance.best_hypothesis(_pseudo_scores(stance.hypothesis_pairs(base)))
    edges = stance.stance_columns(base.join(scored, "msg_id", "left"), model="model_stance")
    return stance.stance_rows(edges, "msg_id").select(
        "msg_id", "target", "label", F.round("score", 6).alias("score"), "method"
    )


@query(
    "G12",
    """SELECT count(*) AS total_stance_edges, count(DISTINCT msg_id) AS messages_with_stance,
    round(avg(score), 6) AS avg_confidence FROM v_edges""",
)
def stance_totals(spark: SparkSession, folder: str) -> DataFrame:
    return stance.stance_totals(with_stance(texts(spark, folder)))


@query(
    "G12",
    """SELECT 'label' AS kind, label AS value, count(*) AS count FROM v_edges GROUP BY label
    UNION ALL SELECT 'method', method, count(*) FROM v_edges GROUP BY method""",
)
def stance_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return stance.stance_distribution(with_stance(texts(spark, folder)))


@query("G12 O02", "SELECT target, count(*) AS count FROM v_edges GROUP BY target ORDER BY count DESC, target LIMIT 10")
def stance_top_targets(spark: SparkSession, folder: str) -> DataFrame:
    return stance.top_targets(with_stance(texts(spark, folder)))


view(
    "v_span_texts",
    """SELECT msg_id || ':' || start || ':' || stop || ':' || span_type || ':' || speaker AS key, msg_id, text
    FROM v_spans WHERE speaker <> 'unknown'""",
)
_stance_views("v_ss", "v_span_texts", 0.1)


@query(
    "G13",
    """SELECT msg_id, CAST(string_split(key, ':')[2] AS INTEGER) AS start, string_split(key, ':')[5] AS speaker,
    target, label, round(score, 6) AS score FROM v_ss_rule WHERE score > 0.7""",
)
def speaker_stance(spark: SparkSession, folder: str) -> DataFrame:
    rows = stance.speaker_stance(with_quotes(stance.targeted(with_entities(texts(spark, folder)))))
    return rows.select("msg_id", "start", "speaker", "target", "label", F.round("score", 6).alias("score"))




def dated_stance(spark: SparkSession, folder: str) -> DataFrame:
    return with_stance(messages(spark, folder))
