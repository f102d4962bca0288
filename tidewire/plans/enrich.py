"""The full enrichment: every per-message operator over one message table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from tidewire.functions.lexicons import STAGES
from tidewire.operators import entities, language, links, quotes, sentiment, stance, style, topics, toxicity
from tidewire.sources.stores import StageStore


def steps(
    aliases: Sequence[entities.Alias] = (),
    profiles: DataFrame | None = None,
    max_entities: int = 5,
    ontology: Sequence[topics.Topic] = topics.ONTOLOGY,
    toxicity_threshold: float = 0.5,
) -> dict[str, Callable[[DataFrame], DataFrame]]:
    """The step of each stage. Apart from language detection all are narrow."""
    return {
        "data_loading": lambda df: df,
        "language_detection": lambda df: language.add_language(df, profiles),
        "quote_detection": quotes.quote_columns,
        "entity_extraction": lambda df: entities.entity_summary(
            entities.rule_entities(df, aliases, max_entities=max_entities)
        ),
        "sentiment_analysis": sentiment.score_sentiment,
        "toxicity_detection": lambda df: toxicity.score_toxicity(df, threshold=toxicity_threshold),
        "stance_classification": stance.stance_columns,
        "style_extraction": style.style_features,
        "topic_classification": lambda df: topics.ontology_topics(df, ontology),
        "link_extraction": links.link_columns,
    }


def enrich(df: DataFrame, **options) -> DataFrame:
    """All columns in one plan: one scan, no shuffle."""
    plan = steps(**options)
    for stage in STAGES:
        df = plan[stage](df)
    return df


def enrich_in_stages(
    df: DataFrame, store: StageStore, keep: Sequence[str] = ("data_loading", STAGES[-1]), **options
) -> DataFrame:
    """Like :func:`enrich`, with the stages in ``keep`` stored and reused when complete.

    Steps between two stored stages stay fused, so storing few stages writes the
    data few times.
    """
    plan = steps(**options)
    done = [s for s in keep if store.completed(s)]
    start = 0
    if done:
        latest = max(done, key=STAGES.index)
        df, start = store.load(latest), STAGES.index(latest) + 1
    for stage in STAGES[start:]:
        df = plan[stage](df)
        if stage in keep:
            df = store.save(stage, df)
    return df
