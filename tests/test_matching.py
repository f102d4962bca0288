import random

from tidewire.operators import entities, matching
from tidewire.sources.dictionaries import read_aliases

SCHEMA = "alias_key string, canonical string, alias_type string, ord int"


def test_hits_equal_brute_force(spark):
    rng = random.Random(3)
    letters = "abcé ß日"
    keys = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(1, 12))).strip() or "a" for _ in range(300)})
    aliases = [(k, f"Name {i}", "ORG", i) for i, k in enumerate(keys)]
    texts = ["".join(rng.choice(letters + "XÉ") for _ in range(rng.randint(0, 60))) for _ in range(150)]
    texts += [None, "", keys[0], keys[-1] * 400, "x" * 20_000 + keys[5], texts[0], texts[0]]
    df = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], "id long, text string, h string")
    hits = matching.dictionary_hits(df, spark.createDataFrame([*aliases, ("", "Nothing", "ORG", 999)], SCHEMA))
    rows = df.select("id", *matching.text_keys("text")).join(hits, ["_t1", "_t2"]).select("id", "alias_key", "canonical", "start").collect()
    want = {(i, k, n, t.lower().index(k)) for i, t in enumerate(texts) if t is not None for k, n, _, _ in aliases if k in t.lower()}
    assert {tuple(r) for r in rows} == want and len(rows) == len(want) > 500


def test_a_file_says_the_same_as_rows(spark, tmp_path):
    (tmp_path / "d.json").write_text('{"Ann Lee": {"type": "PERSON", "aliases": ["annie", "Lee"]}, "Lee": {"type": "ORG"}, "Oslo": {"type": "LOC", "aliases": null}, "No type": {}}')
    aliases = read_aliases(spark, str(tmp_path / "d.json"))
    rows = [tuple(r) for r in aliases.select("alias_key", "canonical", "alias_type", "ord").orderBy("ord").collect()]
    assert rows == [("ann lee", "Ann Lee", "PERSON", 0), ("annie", "Ann Lee", "PERSON", 1), ("lee", "Lee", "ORG", 2), ("oslo", "Oslo", "LOC", 3), ("no type", "No type", "MISC", 4)]
    df = spark.createDataFrame([(1, "Annie and ANN LEE flew to Oslo from Rome"), (2, None), (3, "Lee? lee."), (3, "Lee? lee.")], "msg_id long, text string")
    both = [sorted((r["msg_id"], str(r["entities"])) for r in entities.rule_entities(df, a, max_entities=5).collect()) for a in (aliases, rows)]
    assert both[0] == both[1] and "Oslo" in both[0][0][1]


def test_empty_dictionary_and_no_texts(spark):
    none = spark.createDataFrame([], SCHEMA)
    df = spark.createDataFrame([(1, "some text")], "msg_id long, text string")
    assert matching.dictionary_hits(df, none).count() == 0
    assert matching.with_dictionary_hits(df, none).collect()[0]["_listed"] == []
    assert matching.dictionary_hits(df.limit(0), spark.createDataFrame([("a", "A", "ORG", 0)], SCHEMA)).count() == 0


def test_joined_ontology_says_the_same_as_rows(spark):
    from tidewire.operators import topics

    rng = random.Random(9)
    words = ["alpha", "beta", "gamma", "delta", "new", "york", "city"]
    ontology = [("One", ("alpha", "new york"), 1.0), ("Two", ("beta", "New  York city", "alpha"), 2.0), ("Three", ("gamma delta",), 0.5)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 15))).title() for _ in range(80)] + [None, "", "nothing here"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, texts[0], texts[0]])], "id long, text string")
    frame = spark.createDataFrame([(i, label, w, k) for i, (label, ks, w) in enumerate(ontology) for k in ks] + [(9, None, 1.0, "alpha"), (9, "Nine", 1.0, None)], "ord int, label string, weight double, keyword string")
    keep = ["id", "primary_topic", "primary_topic_confidence", "topic_count", "topic_classification"]
    both = [sorted(str(r) for r in topics.ontology_topics(df, o).select(*keep).collect()) for o in (ontology, frame)]
    assert both[0] == both[1]
    assert {r["primary_topic"] for r in topics.ontology_topics(df, frame.limit(0)).collect()} == {"other"}


def test_a_key_travels_once_per_text_and_without_it(spark):
    # letters of two bytes, so that runs which cut a character pass the bitmap of so many keys now and then
    rng = random.Random(5)
    keys = sorted({"".join(rng.choice("abcdéü") for _ in range(rng.randint(3, 9))) for _ in range(3000)})
    texts = ["".join(rng.choice("abcdéü") for _ in range(3000)) for _ in range(20)] + [keys[0] * 1000]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    hits = matching.row_hits(df, spark.createDataFrame([(k, k, "ORG", i) for i, k in enumerate(keys)], SCHEMA), "text", ["id"])
    rows = [(r["id"], r["alias_key"], r["start"]) for r in hits.collect()]
    assert sorted(rows) == sorted((i, k, t.index(k)) for i, t in enumerate(texts) for k in keys if k in t)
    plan = hits._jdf.queryExecution().optimizedPlan().toString()
    assert "around" not in plan and hits.columns == ["id", "alias_key", "canonical", "alias_type", "ord", "start"]


def test_only_the_leading_names_of_a_text_leave_its_task(spark, monkeypatch):
    rng = random.Random(11)
    keys = sorted({"".join(rng.choice("abcdé") for _ in range(rng.randint(1, 6))) for _ in range(900)})
    rng.shuffle(keys)
    # several keys of one name, of names that differ in case only, and of one name with two types
    aliases = [(k, rng.choice(["Ann", "ANN", f"N{i}", f"N{i // 7}", "Bo"]), rng.choice(["ORG", "MISC"]), i) for i, k in enumerate(keys)]
    texts = ["".join(rng.choice("abcdéX ") for _ in range(rng.choice([0, 4, 10, 500]))) for _ in range(60)] + [None, keys[5], keys[5]]
    df, frame = spark.createDataFrame(list(enumerate(texts)), "msg_id long, text string"), spark.createDataFrame(aliases, SCHEMA)
    want = sorted((r["msg_id"], str(r["entities"])) for r in entities.rule_entities(df, aliases, max_entities=5).collect())
    for listed in (1 << 20, 40, 0):
        monkeypatch.setattr(matching, "LISTED", listed)
        assert sorted((r["msg_id"], str(r["entities"])) for r in entities.rule_entities(df, frame, max_entities=5).collect()) == want
    every = matching.row_hits(df, frame, "text", ["msg_id"]).count()
    monkeypatch.setattr(matching, "LISTED", 1 << 20)
    assert matching.row_hits(df, frame, "text", ["msg_id"], names=5).count() < every / 5
    twice = spark.createDataFrame([("ab", "Late", "ORG", 9), ("ab", "Early", "ORG", 0), ("cd", "Null", "ORG", None), ("ef", "Mid", "ORG", 4)], SCHEMA)
    found = matching.row_hits(spark.createDataFrame([(1, "ab cd ef")], "msg_id long, text string"), twice, "text", ["msg_id"], names=2)
    assert {r["canonical"] for r in found.collect()} == {"Null", "Early", "Late"}
