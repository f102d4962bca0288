import random
import zlib

import numpy as np
import pytest

from tidewire.llm import pages, queries


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(8)
    path = str(tmp_path_factory.mktemp("registered"))
    docs = [(i, " ".join("".join(rng.choice("abcé") for _ in range(5)) for _ in range(rng.randint(0, 40))), "en", f"s{i % 3}", 1) for i in range(80)]
    docs += [(200, None, None, None, None), (201, "", "en", "s0", 0), (202, "word " * 6000, "en", "s0", 1), (203, docs[0][1], "en", "s1", 1)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    html = [(i, f"http://x/{i}", pages.labelled_page(rng)[0]) for i in range(10)] + [(50, "http://x/50", None), (51, None, "")]
    spark.createDataFrame(html, "page_id long, url string, html string").write.parquet(f"{path}/pages.parquet")
    x = np.random.default_rng(2).normal(size=(100, 6))
    vectors = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(100, None), (120, [0.0] * 6)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>").write.parquet(f"{path}/embeddings.parquet")
    return path, docs, html, x


def test_shards(spark, folder):
    path, docs, *_ = folder
    df = queries.QUERIES["op4_hypergeometric_shards"](spark, path)
    assert df.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    rows = df.collect()
    text = {d[0]: d[1] for d in docs}
    assert len(rows) == len(docs) and {r["law"] for r in rows} == {"rows"} and {r["grown_shard"] for r in rows} == {None}
    for r in rows:
        raw = (text[r["doc_id"]] or "").encode()
        assert r["size"] == len(raw) + 8 and (r["text_crc32"] or 0) == (zlib.crc32(raw) if text[r["doc_id"]] is not None else 0)
    slots = {s: sorted(r["slot"] for r in rows if r["shard"] == s) for s in range(24)}
    assert all(v == list(range(len(v))) for v in slots.values()) and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_main_text(spark, folder):
    path, _, html, _ = folder
    df = queries.QUERIES["op5_crf_main_text"](spark, path)
    assert df.columns == ["page_id", "url", "text", "n_chars"]
    rows = {r["page_id"]: r for r in df.collect()}
    assert len(rows) == len(html) and all(r["n_chars"] == len(r["text"]) for r in rows.values())
    assert rows[50]["text"] == rows[51]["text"] == "" and all(rows[i]["n_chars"] > 0 for i in range(10))


def test_nearest(spark, folder):
    path, _, _, x = folder
    df = queries.QUERIES["op6_adaptive_dimension_search"](spark, path)
    assert df.columns == ["query_id", "rank", "vec_id", "score"]
    rows = df.collect()
    y = x.astype(np.float32).astype(np.float64)
    assert {r["query_id"] for r in rows} == {0, 20, 40, 60, 80} and len(rows) == 100
    found = sum(r["vec_id"] in [i for i in np.argsort(-(y @ y[r["query_id"]]), kind="stable") if i != r["query_id"]][:20] for r in rows)
    assert found >= 95 and all(abs(r["score"] - y[r["query_id"]] @ y[r["vec_id"]]) < 1e-9 for r in rows)


def test_near_duplicates(spark, folder):
    path, docs, *_ = folder
    df = queries.QUERIES["op7_odd_sketch_near_duplicates"](spark, path)
    assert df.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    rows = {r["doc_id"]: r for r in df.collect()}
    assert rows[203]["component_id"] == 0 and not rows[203]["kept"] and rows[200]["n_shingles"] == 0 and rows[200]["kept"]
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows.values()) and rows[202]["n_shingles"] == 1


def test_token_counts(spark, folder):
    import public_tokenizers
    import sentencepiece

    path, docs, *_ = folder
    df = queries.QUERIES["op8_two_tier_token_counts"](spark, path)
    assert df.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows = {r["doc_id"]: r for r in df.collect()}
    for doc_id, text, *_ in docs:
        n = len(model.encode(text or ""))
        assert (rows[doc_id]["n_bytes"], rows[doc_id]["n_tokens"], rows[doc_id]["over_limit"]) == (len((text or "").encode()), n, n > 4096)
    assert rows[202]["over_limit"]


def test_mixing_and_passages(spark, folder):
    path, docs, *_ = folder
    rows = queries.QUERIES["op9_systematic_mixing"](spark, path).collect()
    assert len(rows) == len(docs) and all(r["taken"] <= 3 * r["size"] for r in rows)
    kept = {r["doc_id"]: r for r in queries.QUERIES["op3_line_hashing"](spark, path).collect()}
    assert all(kept[i]["kept_chars"] == (len(t) if t is not None else None) or i == 203 for i, t, *_ in docs)
