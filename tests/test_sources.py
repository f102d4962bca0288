import json

import pytest

from tidewire.catalog.messages import texts
from tidewire.operators import entities, sentiment, topics, toxicity
from tidewire.sources import dictionaries, messages, stores


def test_json_document_and_mapping(spark, tmp_path):
    path = tmp_path / "a.json"
    rows = [
        {"message_id": 1, "date": "2024-01-02 03:04:05", "message": "a\\nb", "sender_id": 9},
        {"message_id": 2, "date": "not a date", "message": "x", "sender_id": 9},
        {"message_id": 1, "date": "2024-01-02 03:04:05", "message": "again", "sender_id": 9},
    ]
    path.write_text(json.dumps({"messages": rows}))
    got = messages.load_messages(spark, str(path), "json").collect()
    assert [(r.msg_id, r.text, r.chat_id) for r in got] == [("1", "a\nb", "9")]


def test_jsonl_skips_bad_lines(spark, tmp_path):
    path = tmp_path / "a.jsonl"
    path.write_text('{"id": 1, "date": "2024-01-02", "text": "one"}\n\n{"id": 2, "da\n{"id": 3, "date": "2024-01-02", "text": " "}\n')
    assert [r.text for r in messages.load_messages(spark, str(path), "jsonl").collect()] == ["one"]


def test_errors(spark, tmp_path):
    with pytest.raises(ValueError):
        messages.read_raw(spark, str(tmp_path), "xml")
    with pytest.raises(ValueError):
        messages.map_columns(spark.range(1))


def test_text_arrays(spark):
    df = spark.createDataFrame([(1, "2024-01-01", ['hello', '{"type":"bold","text":"big"}', "world"])], "id int, date string, text array<string>")
    assert messages.normalise(df).first().text == "hello big world"


def test_dictionaries(spark, tmp_path):
    aliases = tmp_path / "aliases.json"
    data = {"Ann Lee": {"type": "PERSON", "id": 1, "aliases": ["Lee"]}, "Bo Lee": {"type": "PERSON", "id": 2, "aliases": ["lee"]}}
    aliases.write_text(json.dumps(data, indent=1))
    rows = sorted(tuple(r) for r in dictionaries.read_aliases(spark, str(aliases)).collect())
    assert rows == sorted(dictionaries.alias_entries(data))
    ontology = tmp_path / "topics.json"
    ontology.write_text(json.dumps([{"label": "a", "keywords": ["x", "y"], "weight": 0.8}, {"label": "b", "keywords": ["z"]}]))
    assert [tuple(r) for r in dictionaries.read_ontology(spark, str(ontology)).collect()] == [
        (0, "a", "x", 0.8), (0, "a", "y", 0.8), (1, "b", "z", 1.0)
    ]


def test_stages_and_sinks(spark, tmp_path):
    store = stores.StageStore(spark, str(tmp_path / "run"))
    assert store.resume_point() is None
    df = texts(spark, "/root/testdata/sf0.001")
    assert store.save("data_loading", df).count() == df.count()
    assert store.resume_point() == "language_detection"
    assert store.summary().first().completed_steps == 1
    with pytest.raises(FileNotFoundError):
        store.load("link_extraction")
    for suffix in ("parquet", "csv", "json"):
        stores.write_enriched(df.selectExpr("msg_id", "array(text) AS parts"), str(tmp_path / f"out.{suffix}"))
    with pytest.raises(ValueError):
        stores.write_enriched(df, str(tmp_path / "out.xlsx"))


def test_dictionary_files_feed_the_operators(spark, tmp_path):
    people = {f"Person {chr(97 + i % 26)}{i}x": {"type": "PERSON", "id": i, "aliases": [f"alias{i}q"]} for i in range(200)}
    (tmp_path / "aliases.json").write_text(json.dumps(people))
    (tmp_path / "topics.json").write_text(json.dumps([{"label": "sea", "keywords": ["boat", "deep water"]}, {"label": "land", "keywords": ["hill"], "weight": 2.0}]))
    aliases = dictionaries.read_aliases(spark, str(tmp_path / "aliases.json"))
    assert aliases.count() == 400
    df = spark.createDataFrame([(1, "we met alias7q and alias199q on a boat in deep water near a hill")], "msg_id long, text string")
    found = entities.rule_entities(df, aliases).first()["entities"]
    assert [(e["text"], e["type"]) for e in found] == [("Person h7x", "PERSON"), ("Person r199x", "PERSON")]
    row = topics.ontology_topics(df, dictionaries.read_ontology(spark, str(tmp_path / "topics.json"))).first()
    assert (row["primary_topic"], row["topic_count"]) == ("sea", 2)


def test_empty_frames(spark):
    df = spark.createDataFrame([], "msg_id string, text string")
    for score in (sentiment.score_sentiment, toxicity.score_toxicity, entities.rule_entities, topics.ontology_topics):
        assert score(df).count() == 0
