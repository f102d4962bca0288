import random

import pytest

from tidewire.operators import evaluation, intervals

SPAN = "array<struct<start:int,end:int,speaker:string>>"


def greedy(pred, gold, threshold):
    used, out = set(), []
    for p, (a, b, *_) in enumerate(pred):
        best = None
        for g, (c, d, *_) in enumerate(gold):
            common = max(0, min(b, d) - max(a, c))
            union = (b - a) + (d - c) - common
            iou = common / union if union > 0 else 0.0
            if g not in used and common > 0 and iou >= threshold and (best is None or iou > best[1]):
                best = (g, iou)
        if best:
            used.add(best[0])
            out.append((p, best[0], round(best[1], 9)))
    return out


def spans(rng, n, size):
    out = []
    for _ in range(n):
        a = rng.randint(0, size)
        out.append((a, a + rng.randint(0, 40), rng.choice("xy")))
    return out


@pytest.mark.parametrize("threshold", [0.0, 0.3, 0.8])
def test_matches_equal_one_after_the_other(spark, threshold):
    rng = random.Random(int(threshold * 10))
    rows = []
    for i in range(60):
        pred = spans(rng, rng.randint(0, 12), 60)
        rows.append((str(i), pred, spans(rng, rng.randint(0, 6), 60) + [(a, b + rng.choice([0, 0, 3]), s) for a, b, s in pred if rng.random() < 0.7]))
    rows += [("none", [], [(0, 5, "x")]), ("null", None, [(0, 5, "x")]), ("long", [(0, 100_000, "x"), (0, 90_000, "y")], [(10, 95_000, "x"), (0, 100_000, "y")])]
    df = spark.createDataFrame(rows, f"msg_id string, p {SPAN}, g {SPAN}")
    got: dict = {}
    for r in intervals.matched_spans(df, "p", "g", threshold).collect():
        got.setdefault(r["msg_id"], []).append((r["p"], r["g"], round(r["iou"], 9)))
    want = {i: greedy(p or [], g, threshold) for i, p, g in rows}
    assert {i: sorted(v) for i, v in got.items()} == {i: v for i, v in want.items() if v}
    folded = df.filter("p is not null").select("msg_id", evaluation.match_spans("p", "g", threshold).alias("m")).collect()
    assert all([(m["p"], m["g"], round(m["iou"], 9)) for m in r["m"]] == want[r["msg_id"]] for r in folded)


def test_a_text_with_thousands_of_spans_and_a_chain_of_refusals(spark):
    # each predicted span likes the gold span of its predecessor best
    pred = [(100 * i, 100 * i + 60, "x") for i in range(3000)]
    gold = [(100 * i, 100 * i + 55, "x") for i in range(3000)]
    chain = [(i, 40 + i, "x") for i in range(8)]
    df = spark.createDataFrame([("many", pred, gold), ("chain", chain, [(i, 39 + i, "x") for i in range(8)])], f"msg_id string, p {SPAN}, g {SPAN}")
    rows = intervals.matched_spans(df, "p", "g", 0.5).collect()
    many = sorted((r["p"], r["g"]) for r in rows if r["msg_id"] == "many")
    assert many == [(i, i) for i in range(3000)]
    assert sorted((r["p"], r["g"], round(r["iou"], 9)) for r in rows if r["msg_id"] == "chain") == greedy(chain, [(i, 39 + i) for i in range(8)], 0.5)
