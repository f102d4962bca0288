import random

import numpy as np

from tidewire.llm import parity_join as pj
from tidewire.llm import queries
from tidewire.llm.linking import folded


def word(rng):
    return "".join(rng.choice("abcdefgh") for _ in range(5))


def corpus(seed=3):
    rng = random.Random(seed)
    passage = [word(rng) for _ in range(60)]
    texts = []
    for _ in range(40):
        text = [word(rng) for _ in range(rng.choice([1, 3, 4, 5, 12, 20, 40, 90, 200, 700]))]
        if rng.random() < 0.4:
            text += passage
        texts.append(" ".join(text))
        for _ in range(rng.choice([0, 0, 1, 3, 8])):
            near = texts[rng.randrange(max(0, len(texts) - 3), len(texts))].split()
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                at = rng.randrange(len(near))
                near[at : at + rng.choice([0, 1])] = [word(rng)]
            texts.append("  ".join(near))
    texts += [texts[0].upper(), "", None, " \t\n", "É é a b", "é É a b", "walk " * 9000, "walk " * 50]
    rng.shuffle(texts)
    return list(enumerate(texts))


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 4:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 4]) for i in range(len(words) - 3)}


def brute_force(rows, percent=85):
    sets = [(i, shingles(t)) for i, t in rows]
    comp = {i: i for i, _ in sets}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                p, q = find(i), find(j)
                comp[max(p, q)] = min(p, q)
    return {i: (len(s), find(i)) for i, s in sets}


def test_components_equal_brute_force(spark):
    for percent, seed in ((85, 3), (60, 4)):
        rows = corpus(seed)
        df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, bucket int, node string")
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in pj.jaccard_components(df, percent=percent, block_rows=4).collect()}
        want = brute_force(rows, percent)
        assert got == want
        assert sum(c != i for i, (_, c) in want.items()) > 10


def test_null_ids_repeats_and_no_rows(spark):
    a, b = " ".join("abcdefghijkl"), " ".join("mnopqrstuvwx")
    rows = [(4, a), (4, a), (4, b), (7, b), (None, a), (None, "x y z"), (9, "x y z"), (None, "alone here")]
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in pj.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    want = [(4, 9, 4), (4, 9, 4), (4, 9, 4), (7, 9, 4), (None, 9, 4), (None, 1, 9), (9, 1, 9), (None, 1, None)]
    assert got == sorted(want, key=str)
    assert pj.jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_any_linked_pair_shares_a_bucket_and_passes_the_sketch():
    rng = np.random.default_rng(1)
    for percent in (85, 70):
        for n in (7, 8, 12, 13, 20, 47, 100, 333, 1010, 4100):
            for _ in range(30):
                gone = int(rng.integers(0, n * (100 - percent) // 100 + 1))
                more = int(rng.integers(0, n * (100 - percent) // 100 + 1))
                u = np.unique(rng.integers(0, 1 << 63, n + more, dtype=np.uint64) * np.uint64(2))
                a, b = np.sort(u[:n]), np.sort(u[gone:])
                both = len(np.intersect1d(a, b))
                if 100 * both < percent * (len(a) + len(b) - both) or len(a) == len(b) == both:
                    continue
                (x, *least), (y, *most) = pj.buckets_of(a, percent), pj.buckets_of(b, percent)
                shared = np.intersect1d(x, y) & 1
                assert any(np.count_nonzero(shared == side) >= max(1, least[side], most[side]) for side in (0, 1))
                sketches = [pj.parity_sketch(s)[1] for s in (a, b)]
                x, y = (folded([k], min(map(len, sketches))) for k in sketches)
                sizes = np.array([len(a)]), np.array([len(b)])
                assert pj.hamming_slack(percent, x, y, *sizes, *sizes)[0] >= 0
                assert np.bitwise_count(x ^ y).sum() <= len(a) + len(b) - 2 * both


def test_registered_query(spark, tmp_path):
    rows = corpus(5)
    spark.createDataFrame([(i, t) for i, t in rows], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    df = queries.QUERIES["op13_parity_sketch_join"](spark, str(tmp_path))
    assert df.columns == ["doc_id", "n_shingles", "component_id"]
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()} == brute_force(rows)
