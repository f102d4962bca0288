import hashlib
import random

import pytest

from tidewire.llm import decontamination, lines, queries


def words(rng, n):
    return ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n)]


def overlaps(doc, item, window=12, off=2):
    tokens = [[w for w in (t or "").lower().split() if w] for t in (doc, item)]
    a, b = tokens
    return any(
        sum(x == y for x, y in zip(a[i : i + window], b[j : j + window], strict=True)) >= window - off
        for i in range(len(a) - window + 1) for j in range(len(b) - window + 1)
    )


def test_masks_find_every_pattern_of_substitutions():
    from itertools import combinations

    masks = decontamination.seed_masks(12, 2)
    for gone in combinations(range(12), 2):
        assert any(not {p + i for i in m} & set(gone) for m in masks for p in range(12 - m[-1]))


def test_contamination_equals_brute_force(spark):
    rng = random.Random(4)
    items = [(i, " ".join(words(rng, rng.randint(5, 30)))) for i in range(12)] + [(None, "null id"), (50, None), (51, "")]
    docs = []
    for i in range(120):
        text = words(rng, rng.randint(0, 60))
        _, item = rng.choice(items[:12])
        piece = item.split()
        start = rng.randint(0, max(0, len(piece) - 12))
        piece = piece[start : start + rng.choice([8, 11, 12, 13, 20])]
        for _ in range(rng.randint(0, 4)):
            piece[rng.randrange(len(piece))] = words(rng, 1)[0]
        at = rng.randint(0, len(text))
        docs.append((i, " ".join(text[:at] + piece + text[at:]), 1, "x"))
    docs += [(None, docs[0][1], 1, "x"), (500, None, 1, "x"), (501, "", 1, "x"), (502, "w " * 30000, 1, "x"), docs[1], docs[1]]
    df = spark.createDataFrame(docs, "doc_id long, text string, item_id int, h string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((str(r["doc_id"]), r["contaminated"], r["n_items"]) for r in decontamination.contamination(df, bench).collect())
    want = []
    for d in docs:
        n = sum(overlaps(d[1], t) for _, t in items if t) if d[0] != 502 else 0
        want.append((str(d[0]), n > 0, n))
    assert got == sorted(want) and any(w[1] for w in want)
    kept = decontamination.decontaminated(df, bench)
    assert kept.columns == df.columns and kept.count() == sum(not w[1] for w in want)
    assert decontamination.decontaminated(df, bench.limit(0)).count() == len(docs)
    assert decontamination.contamination(df.limit(0), bench).count() == 0


def test_many_items_are_neither_broadcast_nor_compared_one_by_one(spark, tmp_path):
    rng = random.Random(5)
    texts = [" ".join(words(rng, 20)) for _ in range(4)]
    items = [(i, texts[i % 3].upper() if i % 2 else texts[i % 3]) for i in range(60)] + [(None, texts[0]), (None, texts[1]), (0, texts[1])]
    docs = [(0, texts[0]), (1, texts[1] + " " + texts[2]), (2, texts[3]), (3, None)] + [(9, texts[2])] * 2
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/items")
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.read.parquet(f"{tmp_path}/items")
    got = {r["doc_id"]: (r["n_items"], r["first_item"], r["equal_words"]) for r in decontamination.contamination(df, bench).collect()}
    assert got == {0: (21, 0, 12), 1: (42, 0, 12), 2: (0, None, None), 3: (0, None, None), 9: (20, 2, 12)}
    # Spark knows the size of the table of items only, the seeds of which are many times as large
    pairs = decontamination.spaced_seed_overlaps(df, bench)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [h" in plan and "BroadcastHashJoin [h" not in plan
    assert pairs.filter("item_id = 0").count() == 2


def test_pipeline_stage_joins_the_seeds_without_broadcasting_them(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(6)
    text = " ".join(words(rng, 30))
    spark.createDataFrame([(i, text) for i in range(30)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(1, "a " + text), (2, "b " * 20), (3, None)], "doc_id long, text string")
    kept = corpus_pipeline.without_benchmark(spark, docs, str(tmp_path))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [h" in plan and "BroadcastHashJoin [h" not in plan
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3]


def test_filter_grows_and_loses_no_hash(spark):
    from pyspark.sql import functions as F

    hashes = spark.range(20000).select(F.xxhash64("id").alias("h"))
    assert decontamination._bits_for(0, 24) == 24 and decontamination._bits_for(2_000_000, 24) == 26 and decontamination._bits_for(1 << 40, 24) == 28
    made = decontamination._filter_of(hashes, 18)
    assert made[0].count() == 8
    rows = spark.range(0, 40000).select("id", F.xxhash64("id").alias("h")).unionByName(spark.createDataFrame([(-1, None)], "id long, h long"))
    flags = {r["id"]: r["hit"] for r in decontamination._flagged(rows, "h", made, "hit").collect()}
    assert all(flags[i] for i in range(20000)) and not flags[-1] and sum(flags[i] for i in range(20000, 40000)) < 2000


@pytest.mark.parametrize("unit", ["line", "paragraph"])
def test_lines_equal_brute_force(spark, unit):
    rng = random.Random(8)
    joint = "\n" if unit == "line" else "\n\n"
    pool = [" ".join(words(rng, n)) for n in (3, 5, 6, 9, 60)]
    docs = [(i, joint.join(rng.choice(pool + [" ".join(words(rng, 7))]) for _ in range(rng.randint(1, 6))), 1, "x") for i in range(60)]
    docs += [(None, pool[4], 1, "x"), (100, None, 1, "x"), (101, "", 1, "x"), (102, pool[2].upper() + joint + "  " + pool[2], 1, "x"), (103, pool[2] * 3000, 1, "x")]
    df = spark.createDataFrame(docs, "doc_id long, text string, removed int, _k1 string")
    got = {r["doc_id"]: r for r in lines.without_repeats(df, unit=unit).collect()}
    assert len(got) == len(docs)
    seen = set()
    for doc_id, text, *_ in sorted(docs, key=lambda d: (d[0] is None, d[0])):
        row = got[doc_id]
        if text is None:
            assert row["kept_text"] is None and row["removed"] == []
            continue
        kept, gone = [], []
        for part in text.split(joint):
            key = tuple(part.lower().split())
            if len(key) >= 5 and key in seen:
                gone.append(part)
            else:
                kept.append(part)
            if len(key) >= 5:
                seen.add(key)
        assert row["kept_text"] == joint.join(kept)
        assert [text[s["start"] : s["end"]].strip() for s in row["removed"]] == [g.strip() for g in gone]
    assert lines.without_repeats(df.limit(0), unit=unit).count() == 0


def brute_passages(docs, min_words, within):
    """Expected (kept text, spans) by id, over plain tuples of words."""
    import hashlib
    import re

    units, first = {}, {}
    order = sorted((d for d in docs if d[1] is not None), key=lambda d: (d[0] is None, d[0]))
    for doc_id, text, *_ in order:
        cells, words = [], 0
        parts = [(m.group(), m.start(), m.end()) for m in re.finditer(r"[^\x20\x09-\x0D]+|\n", text)]
        new = True
        for token, start, _ in parts:
            if token == "\n":
                new = True
                continue
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in token)
            if new:
                cells.append([])
            cells[-1].append((low, start, words))
            words += 1
            new = hashlib.md5(low.encode()).hexdigest()[0] in "0123"
        units[doc_id] = cells
        for j in range(len(cells) - 1):
            key = tuple(tuple(w for w, *_ in c) for c in cells[j : j + 2])
            first.setdefault(key, (doc_id, j))
    out = {}
    for doc_id, text, *_ in docs:
        if text is None:
            out[doc_id] = (None, [])
            continue
        cells, spans, j = units[doc_id], [], 0
        def again(j):
            seen = first[tuple(tuple(w for w, *_ in c) for c in cells[j : j + 2])]
            return seen != (doc_id, j) if within else seen[0] != doc_id

        while j < len(cells) - 1:
            if not again(j):
                j += 1
                continue
            e = j
            while e < len(cells) - 1 and again(e):
                e += 1
            if sum(len(c) for c in cells[j : e + 1]) >= min_words:
                spans.append((cells[j][0][1], cells[e + 1][0][1] if e + 1 < len(cells) else len(text)))
            j = e
        kept, at = "", 0
        for a, b in spans:
            kept, at = kept + text[at:a], b
        out[doc_id] = (kept + text[at:], spans)
    return out


@pytest.mark.parametrize("within", [True, False])
def test_passages_equal_brute_force(spark, within):
    rng = random.Random(12)
    passage = words(rng, 70)
    docs = []
    for i in range(160):
        text = words(rng, rng.randint(0, 50))
        if i % 3 == 0:
            start = rng.randint(0, 20)
            text += passage[start : start + rng.choice([15, 30, 50])]
        if i % 5 == 0:
            text += words(rng, 3) + text[:40]
        text += words(rng, rng.randint(0, 9))
        docs.append((i, "".join(w + rng.choice([" "] * 40 + ["\n", "\t ", "  "]) for w in text), 1, "x"))
    docs += [(None, " ".join(passage), 1, "x"), (200, None, 1, "x"), (201, "", 1, "x"), (202, " \n", 1, "x"), (203, " ".join(passage).upper(), 1, "x"), (204, "walk " * 20000, 1, "x"), docs[3], docs[3]]
    df = spark.createDataFrame(docs, "doc_id long, text string, removed int, _key string")
    want = brute_passages(docs, 25, within)
    rows = lines.without_passages(df, min_words=25, within=within).collect()
    assert len(rows) == len(docs)
    assert all((r["kept_text"], [tuple(s) for s in r["removed"]]) == want[r["doc_id"]] for r in rows)
    assert sum(bool(spans) for _, spans in want.values()) > 15
    assert lines.without_passages(df.limit(0)).count() == 0


def test_planted_passages_go_and_clean_texts_stay(spark):
    rng = random.Random(9)
    vocabulary = words(rng, 400)
    passages = [[rng.choice(vocabulary) for _ in range(60)] for _ in range(5)]
    docs, dirty = [], set()
    for i in range(300):
        text = [rng.choice(vocabulary) for _ in range(rng.randint(30, 120))]
        if i % 4 == 0:
            at = rng.randint(0, len(text))
            text[at:at] = passages[i % 5]
            dirty |= {i} if i >= 20 else set()
        docs.append((i, " ".join(text)))
    got = {r["doc_id"]: r for r in lines.without_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    gone = {i: sum(len(docs[i][1][a:b].split()) for a, b in r["removed"]) for i, r in got.items()}
    assert all(50 <= gone[i] <= 62 for i in dirty) and not any(n for i, n in gone.items() if i not in dirty)


def ends_piece(word):
    return hashlib.md5(word.encode()).hexdigest()[0] in "0123"


def still(rng, n):
    """Words none of which ends a piece."""
    return [w for w in words(rng, 4 * n + 40) if not ends_piece(w)][:n]


def test_passages_without_an_end_of_piece_go(spark, tmp_path):
    rng = random.Random(21)
    passage, over, short = still(rng, 45), still(rng, 1) * 60, still(rng, 39)
    tail = [w for w in words(rng, 100) if ends_piece(w)][:8]
    texts = {
        0: " ".join(passage), 1: " ".join(passage).upper(),  # a copy that is one piece
        2: "\n".join(["one two", " ".join(passage), "three four"]),  # one line among others
        3: " ".join(still(rng, 3) + passage + still(rng, 4)),  # begins and ends inside a piece
        4: " ".join(over), 5: " ".join(still(rng, 2) + over[:50]), 6: " ".join(over[:39]),  # one word over and over
        7: " ".join(short), 8: " ".join(short),  # too few words
        9: " ".join(still(rng, 2) + passage + tail), 10: " ".join(still(rng, 5) + passage + tail),  # goes on in short pieces
        11: "\n".join([" ".join(still(rng, 41))] * 2), 12: None, 13: "",
    }
    want = {1: [0], 2: [8], 3: [len(texts[3].split(passage[0])[0])], 5: [len(texts[5].split(over[0])[0])], 9: [len(texts[9].split(passage[0])[0])], 10: [len(texts[10].split(passage[0])[0])]}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r for r in lines.without_passages(df, within=False).collect()}
    assert {i: [s["start"] for s in r["removed"]] for i, r in got.items() if r["removed"]} == want
    assert got[1]["kept_text"] == "" and got[2]["kept_text"] == "one two\nthree four" and got[3]["kept_text"].split() == texts[3].split()[:3] + texts[3].split()[-4:]
    assert got[10]["kept_text"].split() == texts[10].split()[:5] and got[9]["kept_text"].split() == texts[9].split()[:2] + tail
    both = {r["doc_id"]: r for r in lines.without_passages(df).collect()}
    assert both[11]["kept_text"] == texts[11].split("\n")[0] + "\n" and got[11]["kept_text"] == texts[11]
    assert all(both[i]["kept_text"] == got[i]["kept_text"] for i in texts if i != 11)
    df.selectExpr("*", "'en' AS lang").write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r["doc_id"]: r for r in queries.QUERIES["op3_line_hashing"](spark, str(tmp_path)).collect()}
    assert {i for i, r in rows.items() if r["n_removed"]} == set(want) and rows[1]["kept_chars"] == 0


def test_repeats_within_documents_equal_sql(spark, tmp_path):
    import duckdb

    rng = random.Random(5)
    quiet, loud = still(rng, 6), [w for w in words(rng, 100) if ends_piece(w)][:6]
    passages = [[rng.choice(quiet if rng.random() < 0.97 else loud) for _ in range(90)] for _ in range(4)]
    docs = []
    for i in range(80):
        text = words(rng, rng.randint(0, 12))
        for _ in range(rng.randint(0, 4)):
            passage, a = rng.choice(passages + [quiet[:1] * 90]), rng.randint(0, 40)
            text += passage[a : a + rng.choice([30, 45, 60])] + words(rng, rng.choice([0, 1, 5])) + rng.choice([[], ["\n"]])
        docs.append((i, " ".join(text)))
    docs += [(100, None), (101, ""), (102, " ".join(passages[0] * 2))]
    docs += [(200 + i, "\n".join([" ".join(own), "between", " ".join(own)])) for i in range(12) for own in [words(rng, 50 + i) if i % 2 else still(rng, 40 + i)]]
    spark.createDataFrame(docs, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = sorted(connection.execute(queries.ORACLE["line_hashing_within"]).fetchall())
    got = {name: sorted(tuple(r) for r in queries.QUERIES[name](spark, str(tmp_path)).collect()) for name in ("line_hashing_within", "op3_line_hashing")}
    assert got["line_hashing_within"] == want
    assert sum(g != o for g, o in zip(want, got["op3_line_hashing"], strict=True)) > 5
