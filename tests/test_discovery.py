import math
import re
from collections import Counter

import numpy as np
import pytest

from tidewire.operators import discovery


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(4, 8)) * 6
    which = rng.choice(4, 300, p=[0.4, 0.3, 0.2, 0.1])
    x = centres[which] + rng.normal(size=(300, 8))
    themes = [["river", "stone"], ["music", "dance"], ["money", "bank"], ["planet", "star"]]
    texts = [" ".join(rng.choice(themes[w] + ["common", "words"], 12)) for w in which]
    rows = [(str(i), [float(v) for v in r]) for i, r in enumerate(x)]
    rows += [("900", None), ("901", [float("nan")] * 8), ("902", [None] * 8), ("903", [])]
    vectors = spark.createDataFrame(rows, "msg_id string, embedding array<double>")
    messages = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)] + [("900", "no vector"), ("999", "not in the table"), ("901", None)], "msg_id string, text string")
    return messages, vectors, texts, which


def test_clusters_keep_their_invariants(data):
    _, vectors, _, which = data
    rows = discovery.cluster_embeddings(vectors, key="msg_id", candidates=(3, 4, 6), components=3, probability="mixture").collect()
    assert len(rows) == 304 and len({r["msg_id"] for r in rows}) == 304
    assert {r["msg_id"] for r in rows if r["discovery_status"] == "no_vector"} == {"900", "901", "902", "903"}
    fitted = [r for r in rows if r["discovery_status"] == "clustered"]
    nearest = {r["msg_id"]: int(np.argmin(r["centre_distances"])) for r in fitted}
    members = {k: [r for r in fitted if nearest[r["msg_id"]] == k] for k in set(nearest.values())}
    for r in fitted:
        assert abs(r["distance"] - min(r["centre_distances"])) < 1e-9
        if r["discovery_topic_id"] != discovery.OUTLIER:
            assert r["discovery_topic_id"] == nearest[r["msg_id"]] and len(members[r["discovery_topic_id"]]) >= 10
            # posterior of the round mixture
            logs = []
            for k, d in enumerate(r["centre_distances"]):
                m = members[k]
                v = max(np.mean([x["distance"] ** 2 for x in m]) / 3, 1e-12)
                logs.append(math.log(len(m) / len(fitted)) - 1.5 * math.log(v) - d * d / (2 * v))
            p = np.exp(np.array(logs) - max(logs))
            assert abs(r["discovery_topic_probability"] - p[r["discovery_topic_id"]] / p.sum()) < 1e-9
        else:
            assert r["discovery_topic_probability"] == 0.0
    # the planted groups come out
    topic = {int(r["msg_id"]): r["discovery_topic_id"] for r in fitted if r["discovery_topic_id"] != -1}
    pairs = Counter((which[i], t) for i, t in topic.items())
    assert sum(max(n for (w, _), n in pairs.items() if w == g) for g in range(4)) > 0.95 * len(topic)


def test_chain_is_made_from_the_clustering(spark, data):
    messages, vectors, texts, _ = data
    keywords = spark.createDataFrame([(0, "nature", "river"), (0, "nature", "stone"), (1, "arts", "music")], "ord int, label string, keyword string")
    rows, topics = discovery.discovered_topics(messages, vectors, keywords, candidates=(4,), components=3, probability="mixture")
    rows, topics = rows.collect(), {r["topic"]: r for r in topics.collect()}
    assert len(rows) == 303 and {r["msg_id"] for r in rows if r["discovery_topic_id"] == -1} >= {"900", "901", "999"}
    assert {t: r["size"] for t, r in topics.items()} == Counter(r["discovery_topic_id"] for r in rows)
    assert all(r["discovery_topic_label"] == topics[r["discovery_topic_id"]]["label"] for r in rows)
    counts = {t: Counter() for t in topics}
    for r in rows:
        w = [x for x in re.findall(r"\w+", (r["text"] or "").lower()) if len(x) > 1 and x not in discovery.STOP_WORDS]
        counts[r["discovery_topic_id"]].update(w + [f"{a} {b}" for a, b in zip(w, w[1:])])
    total, df = Counter(), Counter()
    for c in counts.values():
        total.update(c)
        df.update(c.keys())
    features = dict(sorted(((w, n) for w, n in total.items() if df[w] >= 2), key=lambda x: (-x[1], x[0]))[:500])
    sums = [s for s in (sum(n for w, n in c.items() if w in features) for c in counts.values()) if s]
    mean = sum(sums) / len(sums)
    for t, r in topics.items():
        if t == -1:
            assert r["label"] == "outliers" and r["representative_docs"] == []
            continue
        best = sorted(((-round(n * math.log(1 + mean / features[w]), 9), w) for w, n in counts[t].items() if w in features))[:10]
        assert r["words"] == [w for _, w in best] and r["label"] == "_".join(r["words"][:3])
        central = sorted((x["distance"], x["msg_id"]) for x in rows if x["discovery_topic_id"] == t)[:3]
        assert r["representative_docs"] == [texts[int(i)][:200] + ("..." if len(texts[int(i)]) > 200 else "") for _, i in central]
        assert r["ontology_topic"] == ("nature" if "river" in r["words"] else "arts" if "music" in r["words"] else r["ontology_topic"])


def test_too_few_rows_are_outliers(data):
    _, vectors, _, _ = data
    rows = discovery.cluster_embeddings(vectors.limit(3), key="msg_id").collect()
    assert {(r["discovery_topic_id"], r["discovery_status"]) for r in rows} <= {(-1, "too_few_rows"), (-1, "no_vector")}


def test_pairs_of_rare_words_are_left_out_before_the_counting(spark):
    import random

    from pyspark.sql import functions as F

    from tidewire.operators import discovery

    rng = random.Random(4)
    common, rare = [f"word{i}" for i in range(12)], [f"rare{i}" for i in range(400)]
    rows = [(t, " ".join(rng.choice(common if rng.random() < 0.7 else rare) for _ in range(60))) for t in (-1, 1, 2, 3) for _ in range(30)]
    df = spark.createDataFrame(rows, "topic int, text string")
    counts = discovery._term_counts(df, "topic", "text", 2, 20, discovery.STOP_WORDS)
    exact: dict = {}
    for t, text in rows:
        w = text.split()
        for term in [*w, *map(" ".join, zip(w, w[1:]))]:
            exact[t, term] = exact.get((t, term), 0) + 1
    got = {(r["topic"], r["word"]): r["n"] for r in counts.collect()}
    assert all(exact[k] == n for k, n in got.items()) and len(got) < len(exact) / 2

    def best(c):
        total: dict = {}
        for (t, term), n in c.items():
            f, d = total.get(term, (0, 0))
            total[term] = (f + n, d + 1)
        return sorted((-f, term) for term, (f, d) in total.items() if d >= 2)[:20]

    assert best(got) == best(exact) and any(" " in term for _, term in best(exact))
    assert discovery.topic_words(df.filter(F.lit(False)), "topic").count() == 0
