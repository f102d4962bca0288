import random
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest

from tidewire.llm import phrases, queries

SCHEMA = "doc_id long, lang string, text string, n string, phrase int, score double"


def texts(seed=1, n=150):
    rng = random.Random(seed)
    common = ["of the", "in the end", "as a matter of fact", "É dado", "New York City Hall", "x y"]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(0, 12)):
            parts += [rng.choice(common)] if rng.random() < 0.6 else ["".join(rng.choice("abc") for _ in range(rng.randint(1, 3)))]
            parts.append(rng.choice([" ", " ", "  ", "\t", ", ", ". ", "\n", "!?", "\x0b", " ", "-"]))
        rows.append((i, rng.choice(["en", "de", None, "und"]), "".join(parts).upper() if rng.random() < 0.2 else "".join(parts)))
    rows += [(900, "en", None), (901, "en", ""), (902, None, " ,. "), (903, "de", "a b c " * 4000), (904, "fr", "solo " * 3 + "solo"), rows[0], rows[0]]
    return rows


def counted(rows, lengths=(1, 2, 3, 4)):
    f = defaultdict(Counter)
    for _, lang, text in rows:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in lengths:
                f["und" if lang is None else lang].update(" ".join(w[i : i + k]) for i in range(len(w) - k + 1))
    return f


def brute_force(rows, least, top):
    out = []
    for lang, f in counted(rows).items():
        n = sum(v for p, v in f.items() if " " not in p)
        candidates = {p: a for p, a in f.items() if " " in p and a >= least}
        found = []
        for p, a in candidates.items():
            w = p.split(" ")
            cuts = [(2_000_000 * a // (f[" ".join(w[:k])] + f[" ".join(w[k:])]), k, f[" ".join(w[:k])], f[" ".join(w[k:])]) for k in range(1, len(w))]
            score, _, left, right = min(cuts)
            if not any(f" {p} " in f" {q} " and q != p and 100 * b >= 80 * a for q, b in candidates.items()):
                found.append((-score, -a, p.encode(), p, left, right))
        out += [(lang, rank, p, -a, left, right, n, -s) for rank, (s, a, _, p, left, right) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 0.5) for r in rows], SCHEMA)


@pytest.mark.parametrize("options", [{}, {"burst": 3, "room": 20}])
def test_collocations_equal_brute_force(spark, options):
    rows = texts()
    got = sorted(tuple(r) for r in phrases.collocations(frame(spark, rows), least=3, top=40, **options).collect())
    want = brute_force(rows, 3, 40)
    assert got == want and len(want) > 40


def test_registered_query_and_no_rows(spark, tmp_path):
    rows = texts(2, 400)
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    df = queries.QUERIES["op11_trie_collocations"](spark, str(tmp_path))
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {t for _, t in df.dtypes} == {"string", "bigint"}
    want = brute_force(rows, 30, 2000)
    assert sorted(tuple(r) for r in df.collect()) == want and len(want) > 10
    assert phrases.collocations(frame(spark, [])).count() == 0


@pytest.mark.parametrize("lengths", [(1,), (2,), (3, 4)])
def test_slices_spills_and_forgotten_words_lose_no_count(monkeypatch, lengths):
    monkeypatch.setattr(phrases, "SLICE_CHARS", 40)
    monkeypatch.setattr(phrases, "BATCH_TOKENS", 15)
    monkeypatch.setattr(phrases, "REMEMBERED", 12)
    rows = texts(3)
    batches = [pd.DataFrame([("und" if lang is None else lang, t) for _, lang, t in rows[i : i + 20] if t is not None], columns=["_lang", "_text"]) for i in range(0, len(rows), 20)]
    got, total, where = defaultdict(Counter), Counter(), {}
    runs = list(phrases._counter(lengths, None, 3, 10)(iter(batches)))
    for run in runs:
        for part, lang, found, counts in run.itertuples(index=False):
            if found == [""]:
                total[lang] += counts[0]
                continue
            begins = {}
            for phrase, n in zip(found, counts):
                assert len(phrase.split(" ")) in lengths
                begins.setdefault(tuple(phrase.split(" ")[:2]), []).append(phrase)
                got[lang][phrase] += n
            where.update({(lang, w): part for w in begins if where.setdefault((lang, w), part) == part})
            assert all(where[lang, w] == part for w in begins)
    want = counted(rows, lengths)
    assert got == {k: v for k, v in want.items() if v} and len(runs) > 5
    assert total == {k: sum(v.values()) for k, v in counted(rows, (1,)).items() if v}


def test_slots_of_all_tasks_hold_every_frequent_phrase(monkeypatch):
    monkeypatch.setattr(phrases, "SLICE_CHARS", 40)
    monkeypatch.setattr(phrases, "BATCH_TOKENS", 15)
    monkeypatch.setattr(phrases, "SLOT_ROOM", 60)
    rows = texts(3)
    batch = pd.DataFrame([("und" if lang is None else lang, t) for _, lang, t in rows if t is not None], columns=["_lang", "_text"])
    ranges, found = 16, Counter()
    for run in phrases._slot_runs((1, 2, 3, 4), 30, ranges)(iter([batch[:90], batch[90:]])):
        for number, low, high, counts in run.itertuples(index=False):
            gaps = np.frombuffer(low, np.uint16).astype(np.uint64) | np.frombuffer(high, np.uint32).astype(np.uint64) << np.uint64(16)
            slots = np.cumsum(gaps, dtype=np.uint64) | np.uint64(number) << np.uint64(phrases.SLOT_BITS - 4)
            assert (np.diff(slots.astype(np.int64)) > 0).all()
            found.update(dict(zip(slots.tolist(), np.frombuffer(counts, np.uint8).tolist())))
    want = Counter()
    for lang, f in counted(rows).items():
        for phrase, n in f.items():
            h = np.array([phrases.word_hash(lang, w.encode()) for w in phrase.split(" ")], np.uint64)
            want[int(phrases._slots(phrases.phrase_hashes(h, len(h)))[0])] += n
    # a run's counts stop at 30
    assert found.keys() == want.keys() and all(min(found[s], 30) == min(n, 30) for s, n in want.items())


def test_trie_bursts_and_spills_whole_subtrees():
    trie = phrases.PhraseTrie(burst=4, room=30)
    for first in (1, 2, 3):
        rest = sorted((second << (2 * phrases.ID_BITS)) | third for second in range(1, 6) for third in range(first * 2))
        trie.add(first, rest, [1] * len(rest))
        trie.add(first, rest[:3], [1] * 3)
    assert all(isinstance(node, dict) for node in trie.root.values()) and trie.size == 60
    runs = dict(trie.runs())
    assert list(runs) == [3, 2] and trie.size == 10 and list(trie.root) == [1]
    assert all(run == sorted(run) and sum(n for _, n in run) == len(run) + 3 for run in runs.values())
    assert list(trie.runs()) == [] and [f for f, _ in trie.runs(True)] == [1]


def test_scores_beyond_64_bits_are_exact(spark):
    a = 9_000_000_000_000_000_001
    row = spark.range(1).selectExpr(f"(cast({a} as decimal(20,0)) * 2000000) div (cast({a} as decimal(20,0)) + cast({a - 1} as decimal(20,0))) as s").first()
    assert row["s"] == 2_000_000 * a // (2 * a - 1)
