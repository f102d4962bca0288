import hashlib
import random
import re
import zlib
from itertools import product

import pytest

from tidewire.llm import conversations as cv
from tidewire.llm import queries

SCHEMA = "conv_id long, turn long, role string, text string, audit string, cost int"


def damage(rows):
    for conv, turn, role, text, *_ in rows:
        role, text = " " if role is None else role, " " if text is None else text
        f = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if f == 0:
            continue
        if f == 1:
            text = ""
        if f == 2:
            text = re.sub("[.!?]", "", text)
        if f == 4:
            role = "user"
        yield from [(conv, turn, role, text)] * (2 if f == 3 else 1)


def cheapest(rows):
    """Cost, audit and repaired lines, over plain tables of all prefixes: no agenda, no states, roles written so far as text."""
    best = {"": (0, "", ())}
    for step, (role, text, kind) in enumerate([*rows, (None, None, "end")]):
        # up to two insertions before each message are enough: more would be undone by fewer
        for _ in range(3):
            for done, (cost, audit, lines) in list(best.items()):
                for more in ("user", "assistant"):
                    key = tail(done + more[0])
                    if key is not None:
                        value = (cost + 3, audit + "I", (*lines, f"{more}:"))
                        if key not in best or value[:2] < best[key][:2]:
                            best[key] = value
        if kind == "end":
            break
        after = {}
        for done, (cost, audit, lines) in best.items():
            moves = [(done, cost + 4, audit + "D", lines)]
            if kind in " T":
                extra = 3 if kind == "T" else 0
                moves.append((tail(done + role[:1]) if role[:1] else None, cost + extra, audit + "K", (*lines, f"{role}:{text}")))
                moves += [(tail(done + r[0]), cost + extra + 3, audit + "R", (*lines, f"{r}:{text}")) for r in ("user", "assistant")]
            for key, *value in moves:
                if key is not None and (key not in after or tuple(value[:2]) < after[key][:2]):
                    after[key] = tuple(value)
        best = after
    cost, audit, lines = min(v for k, v in best.items() if k in ("", "ua"))
    return cost, audit, "\n".join(lines)


def tail(initials):
    """The shortest text that stands for all that may follow; None where nothing may."""
    if not re.fullmatch("s?(ua)*u?", initials):
        return None
    return "ua" if initials.endswith("ua") else "u" if initials.endswith("u") else initials


def report(rows):
    """Expected row of each conversation from its damaged rows in order."""
    seen, kinds = set(), []
    for _, _, role, text in rows:
        kind = " "
        if not re.search(r"[^\x20\x09-\x0D]", text):
            kind = "B"
        elif (role, text) in seen:
            kind = "D"
        elif text.rstrip(" \t\n\x0b\x0c\r")[-1] not in ".!?":
            kind = "T"
        seen.add((role, text))
        kinds.append(kind)
    turns = [t for _, t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, text = cheapest([(r, t, k) for (_, _, r, t), k in zip(rows, kinds)])
    return (gaps, kinds.count("B"), kinds.count("D"), kinds.count("T"), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def order(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).hexdigest()))


def conversations(seed=1, n=120):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(n), None]:
        for turn in range(rng.choice([1, 2, 4, 7, 12])):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            text = rng.choice(["Yes.", "Why?", "No!", "cut off", "  ", "", None, f"Say {rng.random()}.", f"{rng.random()}", "é.\n", "Ends . "])
            rows.append((conv, None if rng.random() < 0.02 and turn == 0 else turn * rng.choice([1, 1, 1, 2]) + 100, role, text, "x", 1))
    rows += [(900, i, "user" if i % 2 else "assistant", "Word." if i % 7 else f"Word {i}", "x", 1) for i in range(300)]
    rows += [(901, None, "user", "a", "x", 1), (901, None, "user", "a", "x", 1), (902, 5, "user", "Long " * 20000, "x", 1), (903, 1, None, None, "x", 1)]
    return rows


@pytest.mark.parametrize("chunk_rows", [None, 3])
def test_query_equals_brute_force(spark, tmp_path, chunk_rows):
    rows = conversations()
    df = spark.createDataFrame(rows, SCHEMA)
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the long conversation then spans partitions
    try:
        if chunk_rows:
            out = queries._repair_digest(df, cv.repair(cv.damaged(df), chunk_rows=chunk_rows))
        else:
            out = queries.QUERIES["op12_lightest_repair"](spark, str(tmp_path))
        names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
        assert out.columns == names
        got = {r["conv_id"]: tuple(r)[1:] for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    by: dict = {r[0]: [] for r in rows}
    for r in damage(rows):
        by[r[0]].append(r)
    want = {c: report(order(v)) for c, v in by.items()}
    assert {c: v for c, v in got.items() if v != want.get(c)} == {}
    assert got.keys() == want.keys()


def test_chunks_join_to_the_whole():
    rng = random.Random(7)
    for _ in range(300):
        n = rng.randint(0, 14)
        initials = [rng.choice("suuaat") for _ in range(n)]
        kinds = "".join(rng.choice("   TD") for _ in range(n))
        whole = cv.lightest_derivations(initials, kinds, cv.NOTHING)
        cuts = sorted(rng.sample(range(n + 1), min(n, rng.randint(0, 4))))
        parts = list(zip([0, *cuts], [*cuts, n]))
        tables = [{(q, p): v for q in range(4) for p, v in cv.lightest_derivations(initials[a:b], kinds[a:b], q).items()} for a, b in parts]
        cost, audit, path = cv.whole_path(tables)
        assert (cost, audit) == min(whole[e] for e in cv.ENDS)
        assert "".join(tables[i][p][1] for i, p in enumerate(path)) == audit


def test_every_short_conversation_has_its_least_edits():
    for n in range(4):
        for initials in product("sua", repeat=n):
            for kinds in product(" TD", repeat=n):
                found = cv.lightest_derivations(list(initials), "".join(kinds), cv.NOTHING)
                rows = [({"s": "system", "u": "user", "a": "assistant"}[i], ".", k) for i, k in zip(initials, kinds)]
                assert min(found[e] for e in cv.ENDS) == cheapest(rows)[:2]


def test_messages_and_empty_tables(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Anyone?"), (1, 2, "assistant", "Yes."), (2, 0, "tool", "x.")]
    fixed = cv.repair(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA))
    got = [tuple(r) for r in fixed.messages.orderBy("conv_id", "part", "chunk", "position").select("conv_id", "edit", "turn", "role", "text").collect()]
    assert got == [(1, "K", 0, "user", "Hi."), (1, "I", None, "assistant", ""), (1, "K", 1, "user", "Anyone?"), (1, "K", 2, "assistant", "Yes.")]
    assert {r["conv_id"]: (r["cost"], r["audit"]) for r in fixed.report.collect()} == {1: (3, "KIKK"), 2: (4, "D")}
    none = cv.repair(spark.createDataFrame([], SCHEMA))
    assert none.report.count() == none.messages.count() == cv.digests(none).count() == 0
