"""Stance edges author -> entity: verb rules, negation, hedges, fusion with a model.

Sentences, tokens and signals stay arrays inside the row, so no token is ever
shuffled. The rules read word distance; there is no dependency parser.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions import lexicons as lex
from tidewire.functions.spans import split_with_offsets, sql_text
from tidewire.functions.text import one_of, preview, unnest

TOKEN_WITH_APOSTROPHE = r"[\p{L}\p{N}_']+"
SENTENCE_END = r"[.!?]+\s+"
REACH = 5
_IRREGULAR = {"fight": ("fought",), "slam": ("slammed", "slamming"), "crooked": ()}


def inflections(verb: str) -> tuple[str, ...]:
    """Surface forms of a verb by the regular English rules."""
    if verb == "crooked":
        return (verb,)
    if verb.endswith("ee"):
        forms = (verb + "s", verb + "d", verb + "ing")
    elif verb.endswith("e"):
        forms = (verb + "s", verb + "d", verb[:-1] + "ing")
    elif verb.endswith("y") and verb[-2] not in "aeiou":
        forms = (verb[:-1] + "ies", verb[:-1] + "ied", verb + "ing")
    elif verb.endswith(("s", "x", "z", "ch", "sh")):
        forms = (verb + "es", verb + "ed", verb + "ing")
    else:
        forms = (verb + "s", verb + "ed", verb + "ing")
    return (verb, *forms, *_IRREGULAR.get(verb, ()))


SUPPORT_FORMS = tuple(f for v in lex.SUPPORT_VERBS for f in inflections(v))
OPPOSE_FORMS = tuple(f for v in lex.OPPOSE_VERBS for f in inflections(v))


def _in(values) -> str:
    return "(" + ", ".join(sql_text(v) for v in values) + ")"


def _signals(df: DataFrame, text: str) -> DataFrame:
    """Add ``_signals``: per target the verbs within reach, with side, confidence,
    distance and the sentence they were found in."""
    # the first letter is asked for before what stands ahead of it, so most places fail on one character
    firsts = "".join(sorted({v[0] for v in SUPPORT_FORMS + OPPOSE_FORMS}))
    verb = rf"(?i)(?=[{firsts}])(?<![\p{{L}}\p{{N}}_']){one_of(SUPPORT_FORMS + OPPOSE_FORMS)}(?![\p{{L}}\p{{N}}_'])"
    df = df.withColumn("_body", F.coalesce(F.col(text), F.lit(""))).withColumn(
        "_targets", F.filter("entities", lambda e: e["type"].isin("PERSON", "ORG"))
    )
    pieces = F.when(
        (F.size("_targets") > 0) & F.col("_body").rlike(verb), split_with_offsets("_body", SENTENCE_END)
    )
    df = df.withColumn("_pieces", F.filter(pieces, lambda s: s["match"].rlike(verb)))
    df = df.withColumn(
        "_sentences",
        F.expr(
            f"""transform(_pieces, s -> transform(
              array(regexp_extract_all(lower(s.match), {sql_text(TOKEN_WITH_APOSTROPHE)}, 0)), toks -> named_struct(
                'start', s.start, 'end', s.end, 'text', s.match, 'toks', toks,
                'conf', CASE WHEN exists(toks, t -> t IN {_in(lex.STANCE_HEDGES)}) THEN 0.7D ELSE 0.8D END,
                'verbs', filter(transform(toks, (t, j) -> named_struct('at', j, 'word', t, 'side',
                    (CASE WHEN t IN {_in(SUPPORT_FORMS)} THEN 1 WHEN t IN {_in(OPPOSE_FORMS)} THEN -1 ELSE 0 END)
                    * (CASE WHEN exists(slice(toks, greatest(j - 3, 0) + 1, least(j, 3)),
                                        n -> n IN {_in(lex.STANCE_NEGATIONS)}) THEN -1 ELSE 1 END))),
                  v -> v.side <> 0)))[0])"""
        ),
    )
    one_word = rf"lower(e.text) RLIKE {sql_text('^' + TOKEN_WITH_APOSTROPHE + '$')}"
    named = f"""CASE WHEN {one_word} THEN contains(k, lower(e.text))
                ELSE exists(split(lower(e.text), '\\\\s+'), part -> contains(k, part)) END"""
    return df.withColumn(
        "_signals",
        F.expr(
            f"""transform(_targets, e -> named_struct('target', e.text, 'target_type', e.type, 'found', flatten(
              transform(filter(_sentences, s -> {one_word} OR contains(lower(s.text), lower(e.text))), s -> flatten(
                transform(filter(transform(s.toks, (k, i) -> CASE WHEN {named} THEN i END), i -> i IS NOT NULL), i ->
                  transform(filter(s.verbs, v -> abs(v.at - i) <= {REACH}), v -> named_struct(
                    'side', v.side, 'conf', s.conf, 'dist', abs(v.at - i), 'start', s.start, 'end', s.end,
                    'text', s.text, 'verb', v.word))))))))"""
        ),
    ).drop("_targets", "_pieces", "_sentences")


def rule_stance(df: DataFrame, text: str = "text", distance_penalty: float = 0.0) -> DataFrame:
    """Add ``rule_stance``: per PERSON / ORG entity a label, score and evidence.

    Each (entity word, verb) pair votes with its confidence; the larger side wins
    when it exceeds 0.5, a tie is neutral with 0.6, no vote is unclear.
    """
    df = _signals(df, text)

    def weight(side: int) -> str:
        vote = f"s.conf - {distance_penalty}D * (s.dist - 1)" if distance_penalty else "s.conf"
        return f"aggregate(filter(t.found, s -> s.side = {side}), 0.0D, (acc, s) -> acc + {vote})"

    df = df.withColumn(
        "_votes",
        F.expr(f"transform(_signals, t -> named_struct('t', t, 'yes', {weight(1)}, 'no', {weight(-1)}))"),
    )
    return df.withColumn(
        "rule_stance",
        F.expr(
            """transform(_votes, v -> named_struct('target', v.t.target, 'target_type', v.t.target_type,
              'label', CASE WHEN size(v.t.found) = 0 OR v.t.found IS NULL THEN 'unclear'
                            WHEN v.yes > v.no AND v.yes > 0.5 THEN 'support'
                            WHEN v.no > v.yes AND v.no > 0.5 THEN 'oppose' ELSE 'neutral' END,
              'score', CASE WHEN size(v.t.found) = 0 OR v.t.found IS NULL THEN 0.0D
                            WHEN v.yes > v.no AND v.yes > 0.5 THEN least(v.yes, 1.0D)
                            WHEN v.no > v.yes AND v.no > 0.5 THEN least(v.no, 1.0D) ELSE 0.6D END,
              'evidence', transform(coalesce(v.t.found, array()), s -> named_struct('start', s.start, 'end', s.end,
                'text', trim(s.text), 'span_type', 'dependency_rule', 'signal', s.verb))))"""
        ),
    ).drop("_signals", "_votes", "_body")


def fuse(rule: Column, model: Column, rules_weight: float = 0.6, model_weight: float = 0.4) -> Column:
    """Combine a rule result with a model result, both ``struct<label, score>``.

    Agreement of two scores above 0.6 is averaged by weight; otherwise a rule
    score above 0.7, then a model score above 0.8, decides; otherwise unclear.
    """
    model_label = F.coalesce(model["label"], F.lit("unclear"))
    model_score = F.coalesce(model["score"], F.lit(0.0))
    agree = (
        (rule["label"] == model_label) & (rule["label"] != "unclear")
        & (rule["score"] > 0.6) & (model_score > 0.6)
    )
    by_rules = (rule["label"] != "unclear") & (rule["score"] > 0.7)
    by_model = (model_label != "unclear") & (model_score > 0.8)
    mixed = F.least(rule["score"] * rules_weight + model_score * model_weight, F.lit(1.0))
    return F.struct(
        F.when(agree | by_rules, rule["label"]).when(by_model, model_label).otherwise("unclear").alias("label"),
        F.when(agree, mixed).when(by_rules, rule["score"]).when(by_model, model_score).otherwise(0.0).alias("score"),
        F.when(agree, "hybrid_agree").when(by_rules, "rules_preferred").when(by_model, "mnli_preferred")
        .otherwise("hybrid_unclear").alias("method"),
    )


def stance_columns(
    df: DataFrame,
    text: str = "text",
    model: str | None = None,
    speaker: Column | None = None,
    distance_penalty: float = 0.0,
    min_score: float | None = None,
) -> DataFrame:
    """Add ``stance_edges`` and ``stance_edge_count``.

    ``model`` names a ``map<target, struct<label, score>>`` column with the result
    of a classifier; without it the rules stand alone.
    """
    df = rule_stance(df, text, distance_penalty)
    who = F.lit("author") if speaker is None else speaker
    empty = F.lit(None).cast("struct<label:string,score:double>")
    shown = preview(text)

    def evidence(r: Column, method: Column) -> Column:
        own = r["evidence"]
        whole = F.array(
            F.struct(
                F.lit(0).cast("int").alias("start"), F.length(F.col(text)).cast("int").alias("end"),
                F.col(text).alias("text"), F.lit("mnli_classification").alias("span_type"),
                F.lit(None).cast("string").alias("signal"),
            )
        )
        return F.when(method == "mnli_preferred", whole).when(method == "hybrid_agree", F.concat(own, whole)).otherwise(own)

    fused = F.transform(
        "rule_stance",
        lambda r: F.struct(
            r.alias("r"), fuse(r, F.try_element_at(F.col(model), r["target"]) if model else empty).alias("f")
        ),
    )
    df = df.withColumn("_fused", F.filter(fused, lambda x: x["f"]["label"] != "unclear"))
    if min_score is not None:
        df = df.withColumn("_fused", F.filter("_fused", lambda x: x["f"]["score"] >= min_score))
    edges = F.transform(
        "_fused",
        lambda x: F.struct(
            who.alias("speaker"), x["r"]["target"].alias("target"), x["r"]["target_type"].alias("target_type"),
            x["f"]["label"].alias("label"), x["f"]["score"].alias("score"), x["f"]["method"].alias("method"),
            evidence(x["r"], x["f"]["method"]).alias("evidence_spans"), shown.alias("text_preview"),
        ),
    )
    return (
        df.withColumn("stance_edges", edges)
        .withColumn("stance_edge_count", F.size("stance_edges").cast("long"))
        .drop("_fused", "rule_stance")
    )


def targeted(df: DataFrame, text: str = "text") -> DataFrame:
    """Null ``text`` where no person or organisation is named or no verb is held: no edge can come from there, so no spans need be found.

    A filter would do the same, but Spark would push it below the entities and work them out twice.
    A span may cut a word, so a verb counts here wherever its letters stand.
    """
    targets = F.filter("entities", lambda e: e["type"].isin("PERSON", "ORG"))
    verbs = F.col(text).rlike(f"(?i){one_of(SUPPORT_FORMS + OPPOSE_FORMS)}")
    return df.withColumn(text, F.when(F.when(F.size(targets) > 0, verbs), F.col(text)))


def speaker_stance(df: DataFrame, distance_penalty: float = 0.1) -> DataFrame:
    """Edges per speaker: every quote span with a known speaker is read on its own."""
    spans = unnest(df, "quote_spans", "_s", "msg_id", "entities").select("msg_id", "entities", "_s.*")
    spans = spans.filter("speaker <> 'unknown'")
    return stance_columns(
        spans, text="text", speaker=F.col("speaker"), distance_penalty=distance_penalty
    ).transform(stance_rows, "msg_id", "start")


def stance_rows(df: DataFrame, *keep: str) -> DataFrame:
    return unnest(df, "stance_edges", "_e", *keep).select(*keep, "_e.*")


def hypothesis_pairs(df: DataFrame) -> DataFrame:
    """One row per (message, entity, hypothesis) for a zero-shot scorer."""
    targets = df.select(
        "msg_id", "text",
        F.explode(F.filter("entities", lambda e: e["type"].isin("PERSON", "ORG"))).alias("e"),
    ).select("msg_id", "text", F.col("e.text").alias("target"))
    options = F.array(
        *[
            F.struct(
                F.lit(label).alias("label"),
                F.replace(F.lit(template), F.lit("{}"), F.col("target")).alias("hypothesis"),
            )
            for label, template in lex.STANCE_HYPOTHESES.items()
        ]
    )
    return targets.select("msg_id", "target", "text", F.explode(options).alias("o")).select(
        "msg_id", "target", "text", "o.label", "o.hypothesis"
    )


def best_hypothesis(scored: DataFrame) -> DataFrame:
    """``model_stance`` map per message from scored pairs (msg_id, target, label, score)."""
    best = scored.groupBy("msg_id", "target").agg(
        F.max_by("label", F.struct("score", "label")).alias("label"), F.max("score").alias("score")
    )
    return best.groupBy("msg_id").agg(
        F.map_from_entries(
            F.collect_list(F.struct("target", F.struct("label", F.col("score").cast("double").alias("score"))))
        ).alias("model_stance")
    )


def stance_totals(df: DataFrame) -> DataFrame:
    scores = F.col("stance_edges.score")
    total = F.aggregate(scores, F.lit(0.0), lambda a, s: a + s)
    return df.agg(
        F.coalesce(F.sum("stance_edge_count"), F.lit(0)).alias("total_stance_edges"),
        F.count_if(F.col("stance_edge_count") > 0).alias("messages_with_stance"),
        F.round(F.try_divide(F.sum(total), F.sum("stance_edge_count").cast("double")), 6).alias("avg_confidence"),
    )


def stance_distribution(df: DataFrame) -> DataFrame:
    """Counts by label and by method in one long table."""
    edges = stance_rows(df)
    pairs = F.array(
        F.struct(F.lit("label").alias("kind"), F.col("label").alias("value")),
        F.struct(F.lit("method").alias("kind"), F.col("method").alias("value")),
    )
    return edges.select(F.inline(pairs)).groupBy("kind", "value").agg(F.count("*").alias("count"))


def top_targets(df: DataFrame, top_k: int = 10) -> DataFrame:
    return (
        stance_rows(df).groupBy("target").agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "target").limit(top_k)
    )
