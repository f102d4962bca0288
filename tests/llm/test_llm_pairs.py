import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidewire.llm import near_duplicates as nd
from tidewire.llm import neighbours
from tidewire.llm.components import components


def word(rng):
    return "".join(rng.choice("abcdefghij") for _ in range(5))


def edited(rng, words, share):
    return [word(rng) if rng.random() < share else w for w in words]


def corpus(seed=3):
    rng = random.Random(seed)
    texts = []
    for _ in range(12):
        base = [word(rng) for _ in range(rng.randint(5, 150))]
        texts += [" ".join(edited(rng, base, rng.choice([0, 0.01, 0.03, 0.05, 0.1]))) for _ in range(rng.randint(1, 14))]
    common = [word(rng) for _ in range(60)]
    texts += [" ".join(common + [word(rng) for _ in range(60)]) for _ in range(40)]
    texts += ["one two", "ONE\ttwo", "three", "", " ", "long " * 9000]
    rng.shuffle(texts)
    return [(3 * i, t, 1, "x") for i, t in enumerate(texts)]


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_force(rows):
    parent = {i: i for i, *_ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = {i: shingles(t) for i, t, *_ in rows}
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                a_, b_ = find(a), find(b)
                parent[max(a_, b_)] = min(a_, b_)
    return {i: (len(sets[i]), find(i)) for i in ids}


SCHEMA = "doc_id long, text string, place int, node string"


def test_groups_equal_brute_force(spark):
    rows = corpus()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in nd.near_duplicates(spark.createDataFrame(rows, SCHEMA), block_rows=8).collect()}
    want = brute_force(rows)
    assert got == want and len({c for _, c in want.values()}) < len(rows)


def test_null_ids_and_repeated_rows(spark):
    text = "a b c d e f g h"
    rows = [(5, text, 1, "x"), (5, text, 1, "x"), (None, text, 1, "x"), (None, "null only text here for you", 1, "x"), (9, None, 1, "x"), (2, text.upper(), 1, "x"), (7, "", 1, "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"]), r["kept"]) for r in nd.near_duplicates(df).collect())
    assert got == [("2", 4, "2", True), ("5", 4, "2", False), ("5", 4, "2", False), ("7", 0, "7", True), ("9", 0, "9", True), ("None", 2, "None", True), ("None", 4, "2", False)]
    kept = nd.without_near_duplicates(df.unionByName(df))
    assert kept.columns == df.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["2", "7", "9", "None"]
    assert nd.near_duplicates(df.limit(0)).count() == 0


def test_rows_that_share_an_id_are_decided_by_their_texts(spark):
    a, b, c = ("a b c d e f g h", "quite another text that stands alone", "one two three four five six seven eight nine ten")
    rows = [(3, a), (5, a), (5, b), (7, c), (7, c.upper()), (8, c), (9, ""), (9, None)]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], SCHEMA)
    kept = sorted((r["doc_id"], (r["text"] or "").lower()) for r in nd.without_near_duplicates(df).collect())
    assert kept == [(3, a), (5, b), (7, c), (9, ""), (9, "")]
    flags = nd.near_duplicates(df).collect()
    assert len(flags) == len(rows) and sorted(r["doc_id"] for r in flags if r["kept"]) == [i for i, _ in kept]


def test_sketches_estimate_high_similarities():
    rng = np.random.default_rng(1)
    for n in (3, 50, 400, 6000):
        for similarity in (0.5, 0.75, 0.9):
            shared = round(2 * n * similarity / (1 + similarity))
            u = np.unique(rng.integers(0, 1 << 63, 2 * n - shared, dtype=np.uint64) * np.uint64(2))
            a, b = np.sort(u[:n]), np.sort(u[n - shared :])
            (_, s1, c1), (_, s2, c2) = nd.signature(a), nd.signature(b)
            odd = np.bitwise_count(np.frombuffer(s1, np.uint64) ^ np.frombuffer(s2, np.uint64)).sum()
            most = nd.most_odd_bits(np.array([len(a)]), np.array([len(b)]), np.array([c1]), np.array([c2]), 0.75)[0]
            exact = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            if exact >= 0.75:
                assert odd <= most
            if n >= 50 and exact < 0.6:
                assert odd > most


def test_components_of_paths_stars_and_nothing(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(100, 140)] + [(500, i) for i in range(501, 560)] + [(7, 7), (9, 8), (8, 9)]
    rng.shuffle(links)
    got = {r["node"]: r["comp"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 141)}, **{i: 500 for i in range(500, 560)}, 8: 8, 9: 8}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def vectors(n=1500, size=24, seed=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, size))
    x = (centres[rng.integers(0, 8, n)] + 0.6 * rng.normal(size=(n, size))).astype(np.float32)
    x[200:260] = x[100]
    return x


def test_recall_against_brute_force(spark):
    x = vectors()
    rows = [(i, [float(v) for v in r], 1, "x") for i, r in enumerate(x)]
    bad = [(5000, None, 1, "x"), (5020, [0.0] * 24, 1, "x"), (5040, [float("nan")] * 24, 1, "x"), (5060, [None] * 24, 1, "x"), (5080, [float("inf")] * 24, 1, "x"), (5100, [], 1, "x"), (5120, [1.0], 1, "x"), (None, [1.0] * 24, 1, "x"), rows[40], rows[41]]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, rank int, score string")
    got = {}
    for r in neighbours.nearest_neighbours(df, F.col("vec_id") % 20 == 0, list_rows=100, query_rows=16).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(got) == list(range(0, 1500, 20))
    y, found = x.astype(np.float64), 0
    for q, rows in got.items():
        scores = y @ y[q]
        best = [i for i in np.lexsort((np.arange(len(y)), -scores)) if i != q][:20]
        assert [r for r, _, _ in rows] == list(range(1, 21))
        assert [(-s, v) for _, v, s in rows] == sorted((-s, v) for _, v, s in rows)
        assert all(abs(s - scores[v]) < 1e-9 for _, v, s in rows)
        found += len(set(best) & {v for _, v, _ in rows})
    assert found / (20 * len(got)) >= 0.95
    # copies: the smallest ids first
    assert [v for _, v, _ in got[220]][:3] == [100, 200, 201]


def test_few_and_no_candidates(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (20, [1.0, 0.0]), (3, [0.5, 1.0])], "vec_id long, embedding array<float>")
    got = [(r["query_id"], r["rank"], r["vec_id"]) for r in neighbours.nearest_neighbours(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 20), (0, 2, 3), (20, 1, 0), (20, 2, 3)]
    assert neighbours.nearest_neighbours(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(6)
    folder = str(tmp_path_factory.mktemp("tables"))
    rows = [(i, t, "en", rng.choice(["a", "b", "c"]), len(t)) for i, t, *_ in corpus(9)]
    item = " ".join(word(rng) for _ in range(30))
    rows += [(9000 + i, " ".join(word(rng) for _ in range(20)) + " " + item, "en", "a", 1) for i in range(3)]
    labels, toxic = [], set()
    for i in range(200):
        bad = i % 4 == 0
        text = " ".join(word(rng) for _ in range(30)) + (" gromp gromped" if bad else " fine")
        rows.append((10_000 + i, text, "en", "b", 1))
        labels.append((10_000 + i, 1, int(bad)))
        toxic |= {10_000 + i} if bad else set()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, toxic


def test_pipeline_stage_by_stage(spark, tables):
    folder, rows, toxic = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = [f for _, f in corpus_pipeline.STAGES]
    kept = stages[0](spark, docs, folder)
    assert kept.columns == docs.columns and {r[0] for r in rows} - {r["doc_id"] for r in kept.collect()} == toxic
    kept = stages[1](spark, docs, folder)
    want = brute_force([(i, t) for i, t, *_ in rows])
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, (_, c) in want.items() if i == c)
    kept = stages[2](spark, docs, folder)
    assert {r[0] for r in rows} - {r["doc_id"] for r in kept.collect()} == {9000, 9001, 9002}
    mixed = stages[3](spark, docs, folder)
    assert mixed.columns == docs.columns and mixed.count() > 0
    out = stages[4](spark, mixed, folder)
    assert out.count() == mixed.count()


def test_pipeline_runs_whole(spark, tables):
    folder, rows, toxic = tables
    out = corpus_pipeline.run(spark, folder).collect()
    ids = {r["doc_id"] for r in out}
    assert out and not ids & toxic and not ids & {9000, 9001, 9002}
