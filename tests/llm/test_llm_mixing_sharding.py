import random
import re
from collections import Counter, defaultdict

import pytest
from compare import compare, duck

import __spark_entry__ as entry
from tidewire.llm import mixing, sharding

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, source string, mix_size int, _n string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if re.match(r"op\d+_", n)))
def test_matches_sql(spark, name):
    assert compare(spark, duck(FOLDER), name, entry.queries()[name], entry.oracle_sql()[name], FOLDER) is None


def water_fill(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] > most * sizes[s]}
        if not full:
            return target | share
        for s in full:
            target[s] = float(most * sizes[s])
        open_ -= full
        left = sum(sizes.values()) - sum(target.values())
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 1000, "c": 50, None: 7}, {"a": 0, "b": 5}, {"z": 3}, {"a": 1, "b": 1, "c": 1, "d": 1, "e": 900}, {"a": 0},
])
def test_targets_are_the_water_level(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.mixture_targets(rows).collect()}
    assert got == pytest.approx(water_fill(sizes))


def corpus(seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(1500):
        source = rng.choice(["hot"] * 4 + ["a", "b", None])
        rows.append((i, " ".join("w" for _ in range(rng.randint(0, 60))), source, 1, "x"))
    rows += [(None, "lost id", "a", 1, "x"), (7, None, None, 1, "x"), (8, "", "b", 1, "x"), (9, "long " * 20000, "hot", 1, "x")]
    return rows + rows[:40]


def test_mixture_comes_near_its_targets(spark):
    df = frame(spark, corpus())
    rows = mixing.systematic_mix(df).collect()
    assert len(rows) == df.count()
    taken, target = Counter(), {}
    for r in rows:
        assert 0 <= r["mix_copies"] <= 3
        taken[r["source"]] += r["mix_size"] * r["mix_copies"]
        target[r["source"]] = r["mix_target"]
    for source, goal in target.items():
        assert abs(taken[source] - goal) <= 0.05 * goal + 20_000 * (source == "hot")
    again = mixing.systematic_mix(df.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))
    kept = mixing.mixed(df)
    assert kept.columns == df.columns and kept.count() == sum(r["mix_copies"] for r in rows)


def test_mixing_of_nothing(spark):
    assert mixing.systematic_mix(frame(spark, [])).count() == 0


def test_matrix_has_exact_margins_and_the_law_of_a_permutation():
    rng = random.Random(3)
    blocks = [rng.randint(0, 60) for _ in range(30)]
    total = sum(blocks)
    shards = [total // 7 + (s < total % 7) for s in range(7)]
    matrix = sharding.communication_matrix(blocks, shards, 1)
    assert [sum(r) for r in matrix] == blocks and [sum(c) for c in zip(*matrix, strict=True)] == shards
    draws = [sharding.hypergeometric(random.Random(i), 30, 70, 20) for i in range(4000)]
    assert abs(sum(draws) / 4000 - 6) < 0.12
    assert abs(sum((d - 6) ** 2 for d in draws) / 4000 - 20 * 0.3 * 0.7 * 80 / 99) < 0.35
    assert sharding.hypergeometric(random.Random(1), 10**10, 10**10, 10**10) // 10**6 in range(4999, 5001)


def test_shards(spark):
    df = frame(spark, corpus())
    rows = sharding.shuffled_shards(df, 24, carry=["source"]).collect()
    assert len(rows) == df.count()
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    sizes = [len(slots[s]) for s in range(24)]
    assert max(sizes) - min(sizes) <= 1 and all(sorted(v) == list(range(len(v))) for v in slots.values())
    again = sharding.shuffled_shards(df.repartition(5), 24, carry=["source"]).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))
    # ids are spread over shards and slots as a shuffle spreads them
    by_shard = [sum(1 for r in rows if r["shard"] == s and r["source"] == "hot") for s in range(24)]
    assert min(by_shard) > 15 and max(by_shard) < 55
    assert sharding.shuffled_shards(frame(spark, []), 24).count() == 0


def test_copies_of_a_row_are_shuffled_like_other_rows(spark):
    rows = [(i, f"text {i}", "a", 1, "x") for i in range(600)]
    df = frame(spark, rows * 3 + [(-1, "hot", "b", 1, "x")] * 900)
    got = sharding.shuffled_shards(df, 24, cell_rows=100).collect()
    assert len(got) == 2700
    places = defaultdict(list)
    for r in got:
        places[r["doc_id"]].append((r["shard"], r["slot"]))
    hot = Counter(s for s, _ in places.pop(-1))
    assert len(hot) == 24 and max(hot.values()) < 70
    pairs = [(a, b) for p in places.values() for i, a in enumerate(p) for b in p[:i]]
    same = [(a, b) for a, b in pairs if a[0] == b[0]]
    assert len(pairs) == 1800 and 40 < len(same) < 115
    assert sum(abs(a[1] - b[1]) == 1 for a, b in same) < 8
    again = sharding.shuffled_shards(df.repartition(7), 24, cell_rows=100).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
