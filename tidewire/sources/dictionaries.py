"""Dictionaries and gold annotations: alias files, topic ontologies, gold spans."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

ALIAS_JSON = "map<string,struct<type:string,id:bigint,aliases:array<string>>>"
ONTOLOGY_JSON = "label string, name string, keywords array<string>, weight double"
GOLD_JSON = """
    message_id bigint, text string,
    ground_truth struct<
        spans: array<struct<start:int,end:int,text:string,span_type:string,speaker:string,
                            confidence:double,attribution_context:string>>,
        entities: array<struct<text:string,start:int,end:int,type:string,canonical_name:string>>,
        stance_edges: array<struct<speaker:string,target:string,label:string,confidence:double,
                                   span_evidence:array<int>,reasoning:string>>>,
    metadata struct<annotator_id:string,annotation_time:string,difficulty:string,
                    error_types:array<string>,notes:string>
"""


def alias_entries(dictionary: Mapping[str, Mapping]) -> list[tuple[str, str, str, int]]:
    """(lower-cased surface form, canonical name, type, order), a later entry for
    the same surface form replacing the earlier one in place."""
    found: dict[str, tuple[str, str]] = {}
    for canonical, config in dictionary.items():
        for surface in (canonical, *(config.get("aliases") or ())):
            found[surface.lower()] = (canonical, config.get("type") or "MISC")
    return [(key, name, kind, i) for i, (key, (name, kind)) in enumerate(found.items())]


def read_aliases(spark: SparkSession, path: str) -> DataFrame:
    """Alias dictionary file as ``(alias_key, canonical, alias_type, ord)``."""
    document = spark.read.text(path, wholetext=True)
    entries = document.select(F.from_json("value", ALIAS_JSON).alias("m")).select(
        F.posexplode(F.map_entries("m")).alias("i", "e")
    )
    surfaces = F.concat(F.array("canonical"), F.coalesce("aliases", F.array().cast("array<string>")))
    rows = entries.select(
        "i",
        F.col("e.key").alias("canonical"),
        F.coalesce("e.value.type", F.lit("MISC")).alias("alias_type"),
        F.col("e.value.aliases").alias("aliases"),
    ).select("i", "canonical", "alias_type", F.posexplode(surfaces).alias("j", "surface"))
    keyed = rows.select(
        F.lower("surface").alias("alias_key"), "canonical", "alias_type", F.struct("i", "j").alias("at")
    )
    merged = keyed.groupBy("alias_key").agg(
        F.max_by(F.struct("canonical", "alias_type"), "at").alias("v"), F.min("at").alias("first")
    )
    # The dictionary is one file; numbering its entries is bounded by that file.
    return merged.select(
        "alias_key", "v.canonical", "v.alias_type",
        (F.row_number().over(W.orderBy("first.i", "first.j")) - 1).cast("int").alias("ord"),
    )


def read_ontology(spark: SparkSession, path: str) -> DataFrame:
    """Topic ontology file as ``(ord, label, keyword, weight)``."""
    document = spark.read.text(path, wholetext=True)
    topics = document.select(
        F.posexplode(F.from_json("value", f"array<struct<{ONTOLOGY_JSON.replace(' array', ':array').replace(' string', ':string').replace(' double', ':double')}>>")).alias("ord", "t")
    )
    return topics.select(
        "ord",
        F.coalesce("t.label", "t.name").alias("label"),
        F.coalesce("t.weight", F.lit(1.0)).alias("weight"),
        F.explode("t.keywords").alias("keyword"),
    ).select("ord", "label", "keyword", "weight")


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """Gold annotations with nested spans, entities and stance edges."""
    return spark.read.schema(GOLD_JSON).json(path, multiLine=True)


def gold_messages(gold: DataFrame, date: str = "2023-01-01 00:00:00") -> DataFrame:
    """Gold texts as pipeline input with a constant date."""
    return gold.select(
        F.col("message_id").cast("string").alias("msg_id"), "text", F.to_timestamp(F.lit(date)).alias("date")
    )
