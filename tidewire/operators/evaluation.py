"""Scores of predictions against gold annotations.

Predictions and gold are aligned once by message id; spans are matched by an overlap
join (``intervals``), everything else is aggregation.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions.text import unnest
from tidewire.operators.intervals import matched_spans
from tidewire.sources.tables import cut_lineage

QUOTED = ("quoted", "forwarded")
STANCES = ("support", "oppose", "neutral")


def light_spans(spans: Column | str, chars: int = 0) -> Column:
    """Spans with the first ``chars`` characters of their text: the texts of a message's spans are as long as the message."""
    return F.transform(spans, lambda s: s.withField("text", F.substring(s["text"], 1, chars)))


def align(predictions: DataFrame, gold: DataFrame) -> DataFrame:
    """Inner join on the message id as text: ``pred_*`` and ``gold_*`` columns, for the parts that either side has."""
    p = predictions.select(
        F.col("msg_id").cast("string").alias("msg_id"),
        *[F.col(c).alias(f"pred_{n}") for c, n in (("quote_spans", "spans"), ("entities", "entities"), ("stance_edges", "edges")) if c in predictions.columns],
    )
    parts = gold.schema["ground_truth"].dataType.names
    g = gold.select(
        F.col("message_id").cast("string").alias("msg_id"),
        *[F.col(f"ground_truth.{c}").alias(f"gold_{n}") for c, n in (("spans", "spans"), ("entities", "entities"), ("stance_edges", "edges")) if c in parts],
        F.col("metadata.error_types").alias("error_types"),
    )
    return p.join(g, "msg_id")


def span_iou(a: Column, b: Column) -> Column:
    """Intersection over union of two spans with ``start`` and ``end``."""
    common = F.greatest(F.lit(0), F.least(a["end"], b["end"]) - F.greatest(a["start"], b["start"]))
    union = (a["end"] - a["start"]) + (b["end"] - b["start"]) - common
    return F.when(union > 0, common / union).otherwise(0.0)


def match_spans(pred: str, gold: str, threshold: float = 0.5) -> Column:
    """Greedy one-to-one matches ``array<struct<p, g, iou>>`` of array columns:
    each predicted span in turn takes the best free gold span at or above the
    threshold, the first on ties. Within the row, for short arrays; ``intervals.matched_spans`` says the same for any number of spans."""
    common = "greatest(0, least(p.end, g.end) - greatest(p.start, g.start))"
    union = f"((p.end - p.start) + (g.end - g.start) - {common})"
    shape = "array<struct<p:int,g:int,iou:double>>"
    return F.expr(
        f"""aggregate(
          sequence(0, greatest(size({pred}) - 1, 0)),
          named_struct('used', cast(array() AS array<int>), 'out', cast(array() AS {shape})),
          (acc, i) -> transform(array(array_max(filter(
              transform({gold}, (g, j) -> named_struct(
                'iou', CASE WHEN size({pred}) = 0 OR array_contains(acc.used, j) THEN -1.0D
                       ELSE transform(array({pred}[i]), p -> CASE WHEN {union} > 0
                            THEN CAST({common} AS DOUBLE) / {union} ELSE 0.0D END)[0] END,
                'back', -j)),
              x -> x.iou >= {threshold} AND x.iou > 0))), best ->
            named_struct(
              'used', CASE WHEN best IS NULL THEN acc.used ELSE array_append(acc.used, -best.back) END,
              'out', cast(CASE WHEN best IS NULL THEN acc.out
                     ELSE array_append(acc.out, named_struct('p', i, 'g', -best.back, 'iou', best.iou)) END AS {shape})))[0],
          acc -> acc.out)"""
    )


def _metrics(df: DataFrame, section: str, values: dict[str, Column]) -> DataFrame:
    """Aggregate and turn one row into (section, metric, value) rows."""
    wide = df.agg(*[v.cast("double").alias(k) for k, v in values.items()])
    pairs = F.array(
        *[F.struct(F.lit(k).alias("metric"), F.round(F.coalesce(k, F.lit(0.0)), 6).alias("value")) for k in values]
    )
    return wide.select(F.lit(section).alias("section"), F.inline(pairs))


def span_metrics(aligned: DataFrame) -> DataFrame:
    """Speaker accuracy over matched spans, overall and per gold span type."""
    rows = matched_spans(aligned, "pred_spans", "gold_spans", 0.5)
    same = (F.col("pred.speaker") == F.col("gold.speaker")).cast("int")
    kind = F.when(F.col("gold.speaker") == "unknown", "unknown").otherwise(F.col("gold.span_type"))
    values = {
        "span_accuracy": F.avg(same),
        "total_spans_evaluated": F.count("*"),
        "correct_attributions": F.sum(same),
    }
    for name in ("author", "quoted", "forwarded", "unknown"):
        values[f"{name}_accuracy"] = F.avg(F.when(kind == name, same))
    return _metrics(rows, "spans", values)


def message_metrics(aligned: DataFrame) -> DataFrame:
    """Share of messages whose spans all match at 0.8 with the right speakers."""
    matches = matched_spans(aligned, "pred_spans", "gold_spans", 0.8).groupBy("msg_id").agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(~F.coalesce(F.col("pred.speaker") == F.col("gold.speaker"), F.lit(False))).alias("_other")
    )
    rows = aligned.join(matches, "msg_id", "left")
    n, other = F.coalesce("_n", F.lit(0)), F.coalesce("_other", F.lit(0))
    perfect = ((F.size("pred_spans") == F.size("gold_spans")) & (n == F.size("gold_spans")) & (other == 0)).cast("int")
    return _metrics(
        rows.withColumn("_perfect", perfect), "messages",
        {"message_accuracy": F.avg("_perfect"), "perfect_attribution_messages": F.sum("_perfect"), "total_messages_evaluated": F.count("*")},
    )


def _f1(tp: Column, fp: Column, fn: Column) -> dict[str, Column]:
    return {
        "precision": F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0)),
        "recall": F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0)),
        "f1": F.coalesce(F.try_divide(tp * 2, tp * 2 + fp + fn), F.lit(0.0)),
    }


def quote_metrics(aligned: DataFrame) -> DataFrame:
    """Precision, recall and F1 of quoted and forwarded spans."""
    only = lambda c: F.filter(c, lambda s: s["span_type"].isin(*QUOTED))
    rows = aligned.select("msg_id", only("pred_spans").alias("pq"), only("gold_spans").alias("gq"))
    hits = matched_spans(rows, "pq", "gq", 0.5).groupBy("msg_id").agg(F.count(F.lit(1)).alias("hit"))
    rows = rows.join(hits, "msg_id", "left").withColumn("hit", F.coalesce("hit", F.lit(0)))
    tp, p, g = F.sum("hit").cast("double"), F.sum(F.size("pq")), F.sum(F.size("gq"))
    scores = {f"quote_detection_{k}": v for k, v in _f1(tp, p - tp, g - tp).items()}
    return _metrics(
        rows, "quotes",
        {**scores, "quote_true_positives": tp, "quote_false_positives": p - tp, "quote_false_negatives": g - tp},
    )


def attribution_errors(aligned: DataFrame) -> DataFrame:
    """Counts of boundary, type, missed-quote and false-quote errors (IoU 0.3)."""
    count = lambda c: F.size(F.filter(c, lambda s: s["span_type"].isin(*QUOTED)))
    matches = matched_spans(aligned, "pred_spans", "gold_spans", 0.3).groupBy("msg_id").agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(F.col("pred.span_type") != F.col("gold.span_type")).alias("_types")
    )
    rows = aligned.join(matches, "msg_id", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("_n", "_types")})
    gap = count("gold_spans") - count("pred_spans")
    return _metrics(
        rows, "errors",
        {
            "span_boundary_errors": F.sum(F.size("pred_spans") + F.size("gold_spans") - F.col("_n") * 2),
            "speaker_type_errors": F.sum("_types"),
            "missed_quotes": F.sum(F.greatest(gap, F.lit(0))),
            "false_quotes": F.sum(F.greatest(-gap, F.lit(0))),
        },
    )


def type_error_examples(aligned: DataFrame, limit: int = 10) -> DataFrame:
    shown = aligned.withColumns({c: light_spans(c, 100) for c in ("pred_spans", "gold_spans")})
    rows = matched_spans(shown, "pred_spans", "gold_spans", 0.3).filter(F.col("pred.span_type") != F.col("gold.span_type"))
    return rows.orderBy("msg_id", "pred.start").limit(limit).select(
        "msg_id", F.substring("pred.text", 1, 100).alias("text"),
        F.col("pred.span_type").alias("predicted_type"), F.col("gold.span_type").alias("gold_type"),
    )


def entity_metrics(aligned: DataFrame) -> DataFrame:
    """Exact and partial F1, boundary, type and canonical-name accuracy, F1 per type.

    Both lists of a message are in its row, so matching is an array expression.
    Partial means overlapping characters and the same type.
    """
    p, g = "pred_entities", "gold_entities"
    same_span = "p.start = g.start AND p.end = g.end"
    overlap = "p.start < g.end AND g.start < p.end"
    has = lambda a, b, x, y, cond: F.expr(f"size(filter({a}, {x} -> exists({b}, {y} -> {cond})))")
    rows = aligned.select(
        "msg_id",
        F.size(p).alias("np"), F.size(g).alias("ng"),
        has(p, g, "p", "g", f"{same_span} AND p.type = g.type").alias("exact"),
        has(p, g, "p", "g", f"{overlap} AND p.type = g.type").alias("part_p"),
        has(g, p, "g", "p", f"{overlap} AND p.type = g.type").alias("part_g"),
        has(p, g, "p", "g", overlap).alias("touching"),
        has(p, g, "p", "g", same_span).alias("bound"),
        has(p, g, "p", "g", f"{same_span} AND p.text = g.canonical_name").alias("named"),
        *[
            F.struct(
                F.expr(f"size(filter({p}, p -> p.type = '{t}'))").alias("np"),
                F.expr(f"size(filter({g}, g -> g.type = '{t}'))").alias("ng"),
                F.expr(f"size(filter({p}, p -> p.type = '{t}' AND exists({g}, g -> {same_span} AND p.type = g.type)))").alias("hit"),
            ).alias(f"t_{t}")
            for t in ("PERSON", "ORG", "LOC", "MISC")
        ],
    )
    s = lambda c: F.sum(c).cast("double")
    partial_p, partial_r = F.try_divide(s("part_p"), s("np")), F.try_divide(s("part_g"), s("ng"))
    values = {
        "exact_match_f1": F.try_divide(s("exact") * 2, s("np") + s("ng")),
        "partial_match_f1": F.try_divide(partial_p * partial_r * 2, partial_p + partial_r),
        "boundary_accuracy": F.try_divide(s("bound"), s("touching")),
        "type_accuracy": F.try_divide(s("exact"), s("bound")),
        "alias_accuracy": F.try_divide(s("named"), s("bound")),
        "total_entities_evaluated": s("ng"),
    }
    for t in ("PERSON", "ORG", "LOC", "MISC"):
        values[f"{t.lower()}_f1"] = F.try_divide(s(f"t_{t}.hit") * 2, s(f"t_{t}.np") + s(f"t_{t}.ng"))
    return _metrics(rows, "entities", values)


def stance_pairs(aligned: DataFrame) -> DataFrame:
    """Full outer join of predicted and gold edges on message and target."""
    p = unnest(aligned, "pred_edges", "e", "msg_id").select(
        "msg_id", F.col("e.target").alias("target"), F.col("e.label").alias("pred_label"),
        F.col("e.speaker").alias("pred_speaker"), F.col("e.method").alias("method"), F.col("e.score").alias("score"),
    )
    g = unnest(aligned, "gold_edges", "e", "msg_id").select(
        "msg_id", F.col("e.target").alias("target"), F.col("e.label").alias("gold_label"), F.col("e.speaker").alias("gold_speaker"),
    )
    return p.join(g, ["msg_id", "target"], "full_outer")


def stance_metrics(aligned: DataFrame, confident: float = 0.8) -> DataFrame:
    """Macro F1, speaker-aware F1, target F1, accuracy of confident edges."""
    pairs = stance_pairs(aligned)
    pl, gl = F.col("pred_label"), F.col("gold_label")
    same_speaker = F.col("pred_speaker") == F.col("gold_speaker")

    def label_f1(label: str, extra: Column | None = None) -> Column:
        hit = (pl == label) & (gl == label)
        hit = hit if extra is None else hit & extra
        total = F.count_if(pl == label) + F.count_if(gl == label)
        return F.coalesce(F.try_divide(F.count_if(hit) * 2.0, total.cast("double")), F.lit(0.0))

    macro = reduce(lambda a, b: a + b, [label_f1(x) for x in STANCES]) / len(STANCES)
    aware = reduce(lambda a, b: a + b, [label_f1(x, same_speaker) for x in STANCES]) / len(STANCES)
    both = pl.isNotNull() & gl.isNotNull()
    sure = both & (F.col("score") >= confident)
    return _metrics(
        pairs, "stance",
        {
            "overall_f1": macro,
            "speaker_aware_f1": aware,
            "target_entity_f1": F.try_divide(F.count_if(both) * 2.0, (F.count(pl) + F.count(gl)).cast("double")),
            "high_confidence_accuracy": F.try_divide(F.count_if(sure & (pl == gl)).cast("double"), F.count_if(sure).cast("double")),
            "total_stance_edges_evaluated": F.count(gl),
        },
    )


def stance_confusion(aligned: DataFrame) -> DataFrame:
    """Edges per (gold label, predicted label, method); ``none`` where a side is missing."""
    return stance_pairs(aligned).groupBy(
        F.coalesce("gold_label", F.lit("none")).alias("gold_label"),
        F.coalesce("pred_label", F.lit("none")).alias("pred_label"),
        F.coalesce("method", F.lit("none")).alias("method"),
    ).agg(F.count("*").alias("edges"))


def error_categories(aligned: DataFrame) -> DataFrame:
    """How often each annotated error type occurs among messages predicted wrong.

    A message is wrong when its set of (target, label) edges differs from gold.
    """
    names = lambda c: F.array_sort(F.transform(c, lambda e: F.concat_ws(":", e["target"], e["label"])))
    wrong = ~names("pred_edges").eqNullSafe(names("gold_edges"))
    marked = aligned.withColumn("_types", F.when(wrong, F.col("error_types")))
    return unnest(marked, "_types", "error_type", "msg_id").groupBy("error_type").agg(F.count("*").alias("messages"))


def system_stats(predictions: DataFrame, gold: DataFrame) -> DataFrame:
    """Coverage, quotes, entities and stance totals of the predictions, which are worked out once."""
    predictions = cut_lineage(predictions.select(
        "has_quotes", "multi_speaker", F.col("entities.text").alias("names"), F.col("stance_edges.label").alias("labels"),
    ))
    rows = predictions.select(
        F.col("has_quotes").cast("int").alias("q"), F.col("multi_speaker").cast("int").alias("m"),
        F.size("names").alias("e"), F.size("labels").alias("s"),
    )
    main = _metrics(
        rows, "system",
        {
            "total_predictions": F.count("*"), "messages_with_quotes": F.sum("q"), "quote_percentage": F.avg("q") * 100,
            "multi_speaker_messages": F.sum("m"), "total_entities": F.sum("e"), "avg_entities_per_message": F.avg("e"),
            "total_stance_edges": F.sum("s"), "avg_edges_per_message": F.avg("s"),
        },
    )
    unique = _metrics(
        unnest(predictions, "names", "t"), "system", {"unique_entities": F.countDistinct("t")}
    )
    labels = unnest(predictions, "labels", "label").groupBy("label").agg(F.count("*").cast("double").alias("value"))
    stances = labels.select(F.lit("system").alias("section"), F.concat(F.lit("stance_"), "label").alias("metric"), "value")
    size = gold.agg(F.count("*").alias("g"))
    coverage = predictions.agg(F.count("*").alias("p")).join(F.broadcast(size), F.lit(True)).select(
        F.lit("system").alias("section"), F.lit("processing_coverage").alias("metric"),
        F.round(F.try_divide(F.col("p").cast("double"), F.col("g").cast("double")), 6).alias("value"),
    )
    return main.unionByName(unique).unionByName(stances).unionByName(coverage)


def _counts(df: DataFrame, section: str, metric: Column, count: str) -> DataFrame:
    return df.select(F.lit(section).alias("section"), metric.alias("metric"), F.col(count).cast("double").alias("value"))


def full_report(predictions: DataFrame, gold: DataFrame) -> DataFrame:
    """All sections as (section, metric, value), the confusion table as ``gold|predicted|method`` and the error types of wrong messages included.

    The sections read the same enriched rows, so these are stored once, without the texts of spans and of evidence, which no section reads.
    """
    edges = F.transform("stance_edges", lambda e: F.struct(*[e[c].alias(c) for c in ("speaker", "target", "label", "score", "method")]))
    predictions = cut_lineage(predictions.select("msg_id", light_spans("quote_spans").alias("quote_spans"), "entities", edges.alias("stance_edges"), "has_quotes", "multi_speaker"))
    truth = F.col("ground_truth").withField("spans", light_spans("ground_truth.spans"))
    aligned = cut_lineage(align(predictions, gold.withColumn("ground_truth", truth)))
    parts = [
        span_metrics(aligned), message_metrics(aligned), quote_metrics(aligned), attribution_errors(aligned),
        entity_metrics(aligned), stance_metrics(aligned), system_stats(predictions, gold),
        _counts(stance_confusion(aligned), "confusion", F.concat_ws("|", "gold_label", "pred_label", "method"), "edges"),
        _counts(error_categories(aligned), "error_categories", F.col("error_type"), "messages"),
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def cohen_kappa(df: DataFrame, first: str, second: str) -> DataFrame:
    """Agreement of two annotators: observed, expected by chance, kappa."""
    cells = df.groupBy(F.col(first).alias("a"), F.col(second).alias("b")).agg(F.count("*").alias("n"))
    marginal = cells.select("n", F.inline(F.array(
        F.struct(F.col("a").alias("label"), F.lit(1).alias("side")), F.struct(F.col("b").alias("label"), F.lit(2).alias("side"))
    ))).groupBy("label").agg(
        F.sum(F.when(F.col("side") == 1, F.col("n")).otherwise(0)).alias("na"),
        F.sum(F.when(F.col("side") == 2, F.col("n")).otherwise(0)).alias("nb"),
    )
    chance = marginal.agg(F.sum(F.col("na").cast("double") * F.col("nb")).alias("c"))
    seen = cells.agg(F.sum("n").alias("n"), F.sum(F.when(F.col("a") == F.col("b"), F.col("n")).otherwise(0)).alias("same"))
    po = F.col("same") / F.col("n")
    pe = F.col("c") / (F.col("n").cast("double") * F.col("n"))
    return seen.join(F.broadcast(chance), F.lit(True)).select(
        F.round(po, 6).alias("observed"), F.round(pe, 6).alias("expected"),
        F.round(F.try_divide(po - pe, 1 - pe), 6).alias("kappa"),
    )
