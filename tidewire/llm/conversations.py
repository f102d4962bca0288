"""Conversation repair: the cheapest edits that make roles alternate, found by Knuth's lightest-derivation agenda."""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.keys import stored

#: Prices of the edits; a truncated message that stays costs ``TRUNCATED`` more.
RELABEL, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: What has been said so far: nothing, a system message, a user's, an assistant's. A conversation may end after nothing or an assistant's message.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (NOTHING, ASSISTANT)
#: State after a message with that initial, where it may follow.
FOLLOWS = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
#: The role that may be written next: a message can be made a user's or an assistant's only.
WRITES = {NOTHING: "user", SYSTEM: "user", ASSISTANT: "user", USER: "assistant"}
_LEGAL = {"su", "ua", "au"}
#: A chunk ends after so many messages or characters.
CHUNK_ROWS, CHUNK_CHARS = 2048, 4_000_000

#: (end state) -> (cost, audit)
Lightest = dict[int, tuple[int, str]]


def lightest_derivations(initials: list[str], kinds: str, start: int) -> Lightest:
    """The cheapest audit to each end state for a run of messages entered in state ``start``.

    Items are (messages consumed, state); each edit is a deduction that adds its
    price to the cost and its initial to the audit. The agenda pops the item of
    least (cost, messages consumed, audit), which then is final: an edit never
    lowers the cost, one without price consumes a message, and of two audits
    of one item and cost neither is the beginning of the other (the rest would be
    insertions, which cost), so adding an initial keeps their order. ``kinds`` has per message
    ``D`` where it must be deleted, ``T`` where it is truncated, else a space.
    """
    final: dict[tuple[int, int], tuple[int, str]] = {}
    agenda = [(0, 0, "", start)]
    found: Lightest = {}
    n = len(initials)
    while agenda and len(found) < 4:
        cost, at, audit, state = heapq.heappop(agenda)
        if (at, state) in final:
            continue
        final[at, state] = (cost, audit)
        written = FOLLOWS[state, WRITES[state][0]]
        heapq.heappush(agenda, (cost + INSERT, at, audit + "I", written))
        if at == n:
            found[state] = (cost, audit)
            continue
        heapq.heappush(agenda, (cost + DELETE, at + 1, audit + "D", state))
        if kinds[at] != "D":
            price = cost + (TRUNCATED if kinds[at] == "T" else 0)
            kept = FOLLOWS.get((state, initials[at]))
            if kept is not None:
                heapq.heappush(agenda, (price, at + 1, audit + "K", kept))
            heapq.heappush(agenda, (price + RELABEL, at + 1, audit + "R", written))
    return found


Table = dict[tuple[int, int], tuple[int, str]]


def joined(left: Table, right: Table) -> tuple[Table, dict[tuple[int, int], int]]:
    """The lightest derivations through both runs, and the state in between."""
    best: Table = {}
    between: dict[tuple[int, int], int] = {}
    for (a, b), (c1, s1) in left.items():
        for (b2, c), (c2, s2) in right.items():
            if b == b2:
                value = (c1 + c2, s1 + s2)
                if (a, c) not in best or value < best[a, c]:
                    best[a, c], between[a, c] = value, b
    return best, between


def whole_path(tables: list[Table]) -> tuple[int, str, list[tuple[int, int]]]:
    """Cost, audit and the (entry, exit) states of every run of a conversation; neighbours are joined in pairs, so audits are copied log2 times."""
    if not tables:
        return 0, "", []
    levels: list[list[tuple[Table, dict]]] = [[(t, {}) for t in tables]]
    while len(levels[-1]) > 1:
        row = levels[-1]
        levels.append([joined(row[i][0], row[i + 1][0]) if i + 1 < len(row) else row[i] for i in range(0, len(row), 2)])
    top = levels[-1][0][0]
    (cost, audit), end = min((top[NOTHING, e], e) for e in ENDS if (NOTHING, e) in top)
    path = [(NOTHING, end)]
    for below, above in zip(reversed(levels[:-1]), reversed(levels[1:]), strict=True):
        wider = []
        for i, (a, c) in enumerate(path):
            if 2 * i + 1 < len(below):
                b = above[i][1][a, c]
                wider += [(a, b), (b, c)]
            else:
                wider.append((a, c))
        path = wider
    return cost, audit, path


def applied(audit: str, state: int, roles: list[str], texts: list[str]) -> Iterator[tuple[str, int, str, str]]:
    """Edit, message number (-1 for an insertion), role and text of what remains."""
    at = 0
    for edit in audit:
        if edit == "D":
            at += 1
            continue
        role = roles[at] if edit == "K" else WRITES[state]
        yield edit, -1 if edit == "I" else at, role, "" if edit == "I" else texts[at]
        state = FOLLOWS[state, role[:1]]
        at += edit != "I"


_MESSAGE = ["_c", "_part", "_dated", "_turn", "_role", "_text", "_md5", "_kind", "_again"]
_CHUNK = (
    "_c string, _part int, _seq int, blank long, duplicate long, truncated long, illegal long, first_initial string, last_initial string, "
    "low long, high long, turns long, first_dated boolean, first_turn long, last_turn long, kinds string, roles array<string>, texts array<string>, dated array<boolean>, turn array<long>, "
    "paths array<struct<entry:int,exit:int,cost:long,audit:string>>"
)


def _chunk(rows: list[tuple], part: int, seq: int, fresh: bool) -> tuple:
    """One row for a run of messages of one conversation; a fresh one can only be entered with nothing said."""
    roles, texts = [r[4] for r in rows], [r[5] for r in rows]
    initials = [r[:1] for r in roles]
    kinds, dated = "".join(r[7] for r in rows), [(r[2], r[3]) for r in rows]
    days = [t for d, t in dated if d]
    paths = [{"entry": q, "exit": p, "cost": c, "audit": a} for q in range(1 if fresh else 4) for p, (c, a) in lightest_derivations(initials, kinds.replace("B", "D"), q).items()]
    illegal = sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:], strict=False))
    return (
        rows[0][0], part, seq, kinds.count("B"), kinds.count("D"), kinds.count("T"), illegal, initials[0], initials[-1],
        min(days, default=None), max(days, default=None), len(set(days)), dated[0][0], dated[0][1], dated[-1][1], kinds, roles, texts,
        [d for d, _ in dated], [t for _, t in dated], paths,
    )


def _chunks(chunk_rows: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Cut sorted messages into chunks. Only a partition's first conversation may have begun before it."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in _CHUNK.split(", ")]
        open_rows: list[tuple] = []
        out: list[tuple] = []
        first = before = None
        seq = chars = 0

        def close() -> None:
            nonlocal open_rows, seq, chars
            if open_rows:
                c = open_rows[0][0]
                out.append(_chunk(open_rows, open_rows[0][1], seq, c != first and seq == 0))
                seq += 1
            open_rows, chars = [], 0

        for batch in batches:
            for row in batch[_MESSAGE].itertuples(index=False, name=None):
                row = list(row)
                if first is None:
                    first = row[0]
                if open_rows and (open_rows[0][0] != row[0] or len(open_rows) >= chunk_rows or chars >= CHUNK_CHARS):
                    same = open_rows[0][0] == row[0]
                    close()
                    if not same:
                        seq = 0
                key = (row[0], row[2], row[3], row[4], row[6])
                # equal messages of one turn are neighbours
                if row[7] != "B" and (row[8] or key == before):
                    row[7] = "D"
                before = key
                open_rows.append(tuple(row))
                chars += len(row[5])
                if len(out) >= 500 or (out and chars >= CHUNK_CHARS):
                    yield pd.DataFrame(out, columns=names)
                    out = []
        close()
        yield pd.DataFrame(out, columns=names)

    return read


_PATH = "_c string, _part int, _seq int, entry int, audit string, whole struct<gaps:long,blank:long,duplicate:long,truncated:long,illegal:long,cost:long,audit:string>"


def _paths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Join the chunks of each conversation, which are consecutive; the first row of a conversation has what holds for it all."""

    def answer(rows: list) -> list[tuple]:
        tables = [{(p["entry"], p["exit"]): (p["cost"], p["audit"]) for p in r.paths} for r in rows]
        cost, audit, path = whole_path(tables)
        pairs = list(zip(rows, rows[1:], strict=False))
        illegal = sum(r.illegal for r in rows) + sum(a.last_initial + b.first_initial not in _LEGAL for a, b in pairs)
        days = [r for r in rows if r.turns]
        turns = sum(r.turns for r in days) - sum(b.first_dated and a.turns > 0 and a.last_turn == b.first_turn for a, b in pairs)
        gaps = int(max(r.high for r in days)) - int(min(r.low for r in days)) + 1 - turns if days else 0
        whole = {"gaps": gaps, "blank": sum(r.blank for r in rows), "duplicate": sum(r.duplicate for r in rows), "truncated": sum(r.truncated for r in rows), "illegal": illegal, "cost": cost, "audit": audit}
        return [(r.c, r.part, r.seq, entry, tables[i][entry, end][1], None if i else whole) for i, (r, (entry, end)) in enumerate(zip(rows, path, strict=True))]

    names = ["_c", "_part", "_seq", "entry", "audit", "whole"]
    waiting: list = []
    for batch in batches:
        out: list[tuple] = []
        for r in batch.rename(columns={"_c": "c", "_part": "part", "_seq": "seq"}).itertuples(index=False):
            if waiting and waiting[0].c != r.c:
                out += answer(waiting)
                waiting = []
            waiting.append(r)
        yield pd.DataFrame(out, columns=names)
    if waiting:
        yield pd.DataFrame(answer(waiting), columns=names)


def _repaired(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ["_c", "_part", "_seq", "_at", "edit", "dated", "turn", "role", "text"]
    for batch in batches:
        out, chars = [], 0
        for r in batch.itertuples(index=False):
            for at, (edit, number, role, text) in enumerate(applied(r.audit, r.entry, list(r.roles), list(r.texts))):
                known = number >= 0 and bool(r.dated[number])
                out.append((r[0], r[1], r[2], at, edit, known, int(r.turn[number]) if known else 0, role, text))
                chars += len(text)
                if chars >= CHUNK_CHARS:
                    yield pd.DataFrame(out, columns=names)
                    out, chars = [], 0
        yield pd.DataFrame(out, columns=names)


class Repair:
    """``report``: one row per conversation with ``gaps, blank, duplicate, truncated, illegal, cost, audit``.

    ``messages``: the repaired conversations, one row per message in the order of
    ``part, chunk, position``, with ``edit`` (K kept, R relabelled, I inserted), ``turn`` (null where inserted), ``role`` and ``text``.
    """

    def __init__(self, report: DataFrame, messages: DataFrame):
        self.report, self.messages = report, messages


def _key(conv_col: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(conv_col).cast("string")), F.lit("~"))


def repair(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", chunk_rows: int = CHUNK_ROWS) -> Repair:
    """Repair every conversation so that its role initials read ``(s?(ua)+)?`` at the least cost.

    Keeping a message is free, making it a user's or an assistant's costs 3,
    deleting it 4, inserting an empty one 3; a truncated message that stays costs 3
    more, blank and repeated ones must go. The audit has the initials of the
    edits in order, of equal costs the least. Null roles and texts are one space, so a null text
    is blank and a null role is kept nowhere; the same holds for an empty role. A null turn comes first and counts in no gap; a null
    conversation id is a conversation. Messages of one turn are ordered by role and the MD5 of the text. Repeated rows are repeated
    messages. Empty tables give empty results, and other columns are ignored.

    Messages are ordered by a range shuffle of (conversation, turn), so one huge
    conversation is spread over tasks. Each task cuts its messages into chunks and
    runs the agenda in each for every state the chunk may be entered in; the chunks'
    derivations, a few letters a message without texts, are then joined per
    conversation, and the chunks edited on their own. Whether a message came earlier is found by a grouped minimum.
    """
    rows = messages.select(
        _key(conv_col).alias("_c"), F.col(turn_col).isNotNull().alias("_dated"), F.coalesce(F.col(turn_col).cast("long"), F.lit(0)).alias("_turn"),
        F.coalesce(F.col(role_col), F.lit(" ")).alias("_role"), F.coalesce(F.col(text_col), F.lit(" ")).alias("_text"),
    ).withColumn("_md5", F.md5(F.col("_text").cast("binary")))
    spot = F.struct("_dated", "_turn")
    firsts = rows.groupBy("_c", "_role", "_md5").agg(F.min(spot).alias("_first"))
    kind = F.when(~F.col("_text").rlike(r"[^\x20\x09-\x0D]"), "B").when(~F.col("_text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), "T").otherwise(" ")
    marked = rows.join(firsts, ["_c", "_role", "_md5"]).select("_c", "_dated", "_turn", "_role", "_text", "_md5", kind.alias("_kind"), (spot > F.col("_first")).alias("_again"))
    order = ["_c", "_dated", "_turn", "_role", "_md5"]
    dealt = marked.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
    chunks = stored(dealt.select(*_MESSAGE).mapInPandas(_chunks(chunk_rows), _CHUNK), "chunks")
    short = chunks.drop("kinds", "roles", "texts", "dated", "turn").repartition("_c").sortWithinPartitions("_c", "_part", "_seq")
    paths = stored(short.mapInPandas(_paths, _PATH), "paths")
    kind_of_id = messages.schema[conv_col].dataType

    def named() -> Column:
        return F.when(F.col("_c") != "~", F.expr("substring(_c, 2)").cast(kind_of_id)).alias(conv_col)

    report = paths.filter("whole is not null").select(named(), "whole.*")
    edits = chunks.select("_c", "_part", "_seq", "roles", "texts", "dated", "turn").join(paths.select("_c", "_part", "_seq", "entry", "audit"), ["_c", "_part", "_seq"])
    done = edits.mapInPandas(_repaired, "_c string, _part int, _seq int, _at int, edit string, dated boolean, turn long, role string, text string")
    return Repair(report, done.select(named(), F.col("_part").alias("part"), F.col("_seq").alias("chunk"), F.col("_at").alias("position"), "edit", F.when(F.col("dated"), F.col("turn")).alias("turn"), "role", "text"))


def digests(repaired: Repair, conv_col: str = "conv_id") -> DataFrame:
    """SHA-256 of each repaired conversation that has messages, ``role:text`` joined by line feeds.

    The hash is sequential by nature: each task streams the sorted messages of its conversations through it and holds none of them.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, running = None, None
        for batch in batches:
            out = []
            for c, role, text in zip(batch["_c"], batch["role"], batch["text"], strict=True):
                line = f"{role}:{text}".encode()
                if c != at:
                    if at is not None:
                        out.append((at, running.hexdigest()))
                    at, running = c, hashlib.sha256(line)
                else:
                    running.update(b"\n" + line)
            yield pd.DataFrame(out, columns=["_c", "sha256"])
        if at is not None:
            yield pd.DataFrame([(at, running.hexdigest())], columns=["_c", "sha256"])

    m = repaired.messages
    rows = m.select(_key(conv_col).alias("_c"), "part", "chunk", "position", "role", "text").repartition("_c").sortWithinPartitions("_c", "part", "chunk", "position")
    found = rows.select("_c", "role", "text").mapInPandas(read, "_c string, sha256 string")
    return found.select(F.when(F.col("_c") != "~", F.expr("substring(_c, 2)").cast(m.schema[conv_col].dataType)).alias(conv_col), "sha256")


def damaged(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Messages with reproducible faults, by CRC-32 of ``conversation:turn`` modulo 20: 0 lost, 1 emptied, 2 without ``[.!?]``, 3 repeated, 4 made a user's. Nulls are one space."""

    def text(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(text(conv_col), F.lit(":"), text(turn_col)).cast("binary")) % 20
    rows = messages.select(F.col(conv_col), F.col(turn_col), text(role_col).alias("_r"), text(text_col).alias("_t"), fault.alias("_f")).filter("_f != 0")
    role = F.when(F.col("_f") == 4, "user").otherwise(F.col("_r"))
    said = F.when(F.col("_f") == 1, "").when(F.col("_f") == 2, F.regexp_replace("_t", "[.!?]", "")).otherwise(F.col("_t"))
    copies = F.explode(F.when(F.col("_f") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select(conv_col, turn_col, role.alias(role_col), said.alias(text_col), copies.alias("_copy")).drop("_copy")
