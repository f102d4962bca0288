import random
import zlib

import numpy as np
import pytest

from tidewire.llm import pages, quality, queries, tokens, toxicity

TAME = ["river", "stone", "walk", "green", "table", "music", "garden", "window", "paper", "bridge"]
RUDE = ["vilego", "vilemar", "vilesun", "gromp", "gromped"]


def documents(seed=2, n=400):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        text = [rng.choice(TAME) + rng.choice(["", "s", "ing", "er"]) for _ in range(rng.randint(8, 60))]
        toxic, junk = rng.random() < 0.2, rng.random() < 0.3
        if toxic:
            for _ in range(max(1, len(text) // 12)):
                text.insert(rng.randrange(len(text)), rng.choice(RUDE) + ",")
        text = " ".join(text).capitalize() + "."
        rows.append((i, text.upper().replace(" ", "!! ") if junk else text, "s", 0.5))
        if i % 2 == 0 or toxic:
            labels.append((i, int(not junk), int(toxic)))
    rows += [(None, "river gromp", "s", 0.5), (n + 1, None, "s", 0.5), (n + 2, "", "s", 0.5), (n + 3, "walk " * 50000, "s", 0.5), rows[0]]
    return rows, labels + [(None, 1, 1), (n + 50, None, None)]


@pytest.fixture(scope="module")
def tables(spark):
    rows, labels = documents()
    return spark.createDataFrame(rows, "doc_id long, text string, source string, score double"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), dict((a, (b, c)) for a, b, c in labels)


def held(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_toxicity_of_held_out_documents(tables):
    docs, labels, truth = tables
    rows = toxicity.toxicity(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    checked = [(r["score"] >= 0.5, truth[r["doc_id"]][1] == 1) for r in rows if held(r["doc_id"]) and r["doc_id"] in truth and r["doc_id"] is not None]
    assert len(checked) > 30 and sum(a == b for a, b in checked) / len(checked) > 0.95


@pytest.mark.parametrize("times", [0.5, 1, 2, 3])
def test_toxicity_whatever_the_share_of_toxic_labels(times):
    rows, labels = documents(5, 3000)
    rng = random.Random(1)
    texts, truth = {r[0]: r[1] for r in rows if r[0] is not None}, {i: 0 for i in range(3000)} | {i: t for i, _, t in labels if i is not None and t is not None}
    share = sum(truth.values()) / len(truth) * times
    toxic = [i for i in truth if truth[i] and not held(i)][:200]
    clean = rng.sample([i for i in truth if not truth[i] and not held(i)], round(len(toxic) * (1 - share) / share))
    unlabelled = [toxicity.text_features(t) for i, t in texts.items() if not held(i)]
    positive = [toxicity.text_features(texts[i]) for i in toxic]
    prior = toxicity.class_prior(positive, unlabelled, len(toxic) / (len(toxic) + len(clean)), epochs=120)
    model = toxicity.fit_nnpu(positive, unlabelled, prior)
    checked = [(model.score(toxicity.text_features(texts[i])) >= 0.5, truth[i] == 1) for i in truth if held(i)]
    assert len(checked) > 300 and sum(a == b for a, b in checked) / len(checked) > 0.95


def test_risk_and_first_step_equal_plain_computation():
    rng = np.random.default_rng(3)
    positive = [np.array([1, 5], dtype=np.int32)] * 30
    unlabelled = [np.array([1, 5] if rng.random() < 0.3 else [7, 5], dtype=np.int32) for _ in range(90)]
    prior, bias = 0.3, float(np.log(0.3 / 0.7))
    model = toxicity.fit_nnpu(positive, unlabelled, prior, bits=4, epochs=1, rate=0.1)
    # the only feature held more often by confirmed texts is 1; one Adam step moves by the rate against the sign of the gradient
    def risk(w, b):
        def loss(z):
            return np.log1p(np.exp(-z))

        zp = np.array([b + w * (1 in f) / np.sqrt((1 in f) + 1) for f in positive])
        zu = np.array([b + w * (1 in f) / np.sqrt((1 in f) + 1) for f in unlabelled])
        return prior * loss(zp).mean() + max(0.0, loss(-zu).mean() - prior * loss(-zp).mean())

    slopes = [(risk(1e-5, bias) - risk(-1e-5, bias)) / 2e-5, (risk(0, bias + 1e-5) - risk(0, bias - 1e-5)) / 2e-5]
    assert abs(model.weights[1] + 0.1 * np.sign(slopes[0])) < 1e-6
    # the bias begins where its gradient is 0
    assert abs(slopes[1]) < 1e-9 and abs(model.bias - bias) < 1e-6
    assert np.count_nonzero(model.weights) == 1


def test_registered_scores(spark, tables, tmp_path):
    docs, labels, truth = tables
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for name, limit in (("op1_nnpu_toxicity", 0.5), ("op10_fourier_ridge_quality", 0.3)):
        df = queries.QUERIES[name](spark, str(tmp_path))
        assert df.columns == ["doc_id", "held_out", "score", "predicted"]
        rows = df.collect()
        assert len(rows) == docs.count()
        assert all(r["held_out"] == held(r["doc_id"]) and r["predicted"] == int(r["score"] >= limit) for r in rows)


def test_toxicity_without_positive_labels_is_the_prior(tables):
    docs, labels, _ = tables
    rows = toxicity.toxicity(docs, labels.filter("toxic = 0")).collect()
    assert {round(r["score"], 3) for r in rows} == {0.0}
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0


def test_risk_is_not_driven_below_zero():
    rng = np.random.default_rng(0)
    positive = [np.array([1, 5], dtype=np.int32)] * 40
    unlabelled = [np.array([1, 5] if rng.random() < 0.3 else [7, 9], dtype=np.int32) for _ in range(400)]
    model = toxicity.fit_nnpu(positive, unlabelled, 0.3, bits=4)
    assert model.score(np.array([1, 5])) > 0.5 > model.score(np.array([7, 9]))


def test_quality_of_held_out_documents(tables):
    docs, labels, truth = tables
    rows = quality.quality(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    checked = [(r["score"] >= 0.3, truth[r["doc_id"]][0] == 1) for r in rows if held(r["doc_id"]) and r["doc_id"] in truth and r["doc_id"] is not None]
    assert sum(a == b for a, b in checked) / len(checked) > 0.95


def test_ridge_equals_direct_least_squares(spark, tables):
    docs, labels, _ = tables
    model = quality.fit(docs.union(docs), labels.union(labels).repartition(5), ridge=1e-2)
    known = {}
    for r in labels.collect():
        if r["doc_id"] is not None and r["quality"] is not None and not held(r["doc_id"]) and zlib.crc32(str(r["doc_id"]).encode()) % 5 != 4:
            known[r["doc_id"]] = max(known.get(r["doc_id"], 0), r["quality"])
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    ids = [i for i in known if i in texts]
    x, y = np.vstack([quality.statistics(texts[i]) for i in ids]), np.array([known[i] for i in ids], dtype=float)
    assert np.allclose(model.mean, x.mean(axis=0)) and np.allclose(model.scale, np.where(x.std(axis=0) > 1e-9, x.std(axis=0), 1.0), atol=1e-6)
    a = model.features(x)
    # least squares with one more row per weight says the same as the ridge penalty
    extra = np.sqrt(1e-2 * len(ids)) * np.eye(a.shape[1])[:-1]
    direct = np.linalg.lstsq(np.vstack([a, extra]), np.concatenate([y, np.zeros(len(extra))]), rcond=None)[0]
    assert len(ids) > 100 and np.allclose(model.raw(x), a @ direct, atol=1e-6)


def test_quality_of_empty_tables(tables):
    docs, labels, _ = tables
    assert {r["score"] for r in quality.quality(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.quality(docs.limit(0), labels).count() == 0


def test_isotonic_pools_violators():
    x, y = quality.isotonic(np.array([0.0, 1, 2, 3]), np.array([0.0, 3, 1, 4]), np.array([4.0, 4, 4, 4]))
    assert list(x) == [0, 1, 2, 3] and list(y) == [0, 0.5, 0.5, 1]


ODD = ["", " ", "  a   b  ", "a\nb\tc", "x　y", "▁a▁ b", "<s> hi </s>", "\x00a", "\n", "ﬁ ① é", "end ", "﻿a", "a" * 50_000, " " * 40 + "x", "hello world " * 3000]


def test_token_counts_equal_the_library(spark):
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(5)
    texts = ODD + ["".join(rng.choice("ab é\n\t .▁，日本​😀") for _ in range(rng.randint(1, 80))) for _ in range(400)]
    rows = [(i, t, 0) for i, t in enumerate(texts)] + [(None, None, 0), (1, "a b", 0), (1, "a b", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = sorted((r["text"] or "", r["n_tokens"]) for r in tokens.token_counts(df, path, table_entries=50).collect())
    assert got == sorted((t or "", len(model.encode(t or ""))) for _, t, _ in rows)
    assert tokens.token_counts(df.limit(0), path).count() == 0


def test_held_out_pages_are_decoded():
    field, rng = pages.default_model(), random.Random(77)
    right = every = 0
    for _ in range(150):
        page, labels = pages.labelled_page(rng)
        got = field.decode(pages.leaf_blocks(page, field.known))
        right += sum(a == b for a, b in zip(got, labels, strict=True))
        every += len(labels)
    assert right / every > 0.97


def test_viterbi_is_the_best_labelling():
    from itertools import product

    field, rng = pages.default_model(), random.Random(5)
    blocks = [b for b in pages.leaf_blocks(pages.labelled_page(rng)[0], field.known)][:9]
    holder = pages.has_holder(blocks)

    def value(labels):
        total = 0.0
        for t, y in enumerate(labels):
            if y:
                total += sum(field.weights.get(f, 0.0) for f in pages.block_features(blocks[t], holder))
            if t:
                total += field.moves[blocks[t].parent == blocks[t - 1].parent][labels[t - 1]][y]
        return total

    assert value(field.decode(blocks)) == pytest.approx(max(map(value, product((0, 1), repeat=len(blocks)))))


def test_main_text(spark):
    body = "<nav><ul><li><a href='/a'>Home</a><li><a href='/b'>News</a></ul></nav><article><h1>A title</h1><p>First &amp; <b>bo</b>ld\n text, with a clause.<p>Second<br>part of it.</article><footer>&copy; x</footer>"
    rows = [(1, "u", body, 9), (2, "u", None, 9), (3, "u", "", 9), (4, "u", "<div>" * 5000 + "<p>Deep text, that is long enough.</p>", 9), (5, "u", "<p title='", 9), (6, "u", "<script>x", 9), (None, None, body, 9), (1, "u", body, 9)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = [r["text"] for r in pages.main_text(df).collect()]
    want = "A title First & bold text, with a clause. Second part of it."
    assert got[0] == got[6] == got[7] == want
    assert got[1] == got[2] == got[4] == got[5] == "" and got[3] == "Deep text, that is long enough."
    assert pages.main_text(df.limit(0)).count() == 0


@pytest.mark.parametrize("page, want", [
    # a head without end tag
    ("<html><head><title>T</title><body><p>One.</p>", ["One."]),
    ("<html><head><title>T</title><meta charset=x><script>s</script><p>One.</p><p>Two.", ["One.", "Two."]),
    ("<head><template><p>hidden</p></template><style>s</style>\n <b>One.</b>", ["One."]),
    ("<head><title>T</title>\n One. <p>Two.", ["One.", "Two."]),
    ("<head><title>T</title></head><body><p>One.", ["One."]),
    ("<body><p>One.</p><head><p>Two.", ["One.", "Two."]),
    # '/>' closes foreign elements only
    ("<div><svg/><p>One.</p></div><p>Two.", ["One.", "Two."]),
    ("<p>One <svg width='9' /> two.</p>", ["One", "two."]),
    ("<div><svg><title/><path d='m'/></svg><p>One.</p></div>", ["One."]),
    ("<div><svg width=9/><p>hidden</p></svg><p>One.</div>", ["One."]),
    ("<div><math/><p>One.</p></div>", ["One."]),
    ("<div><button/>hidden</button><p>One.</p></div>", ["One."]),
    # formulas are text
    ("<p>With <math><mi>x</mi><mo>=</mo><mn>2</mn></math> it holds.</p>", ["With x=2 it holds."]),
    ("<p><math><semantics><mi>x</mi><annotation>\\x</annotation></semantics></math> it is.</p>", ["x it is."]),
    ("<p><math><mtable><mtr><mtd>1</mtd><mtd>2</mtd></mtr></mtable></math></p>", ["1 2"]),
])
def test_only_hidden_text_is_left_out(page, want):
    assert [b.text for b in pages.leaf_blocks(page)] == want
