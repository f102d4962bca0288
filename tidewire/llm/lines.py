"""Substring dedup by hashing lines, paragraphs or pieces of lines."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.keys import boxed, row_keys, stored, unboxed

_BREAK = {"line": re.compile(r"\n"), "paragraph": re.compile(r"\n[ \t]*\n\s*")}


def spans(text: str, unit: str) -> Iterator[tuple[int, int]]:
    """Start and end (code points) of each unit; the breaks between them belong to none."""
    start = 0
    for m in _BREAK[unit].finditer(text):
        yield start, m.start()
        start = m.end()
    yield start, len(text)


def _splitter(unit: str, min_words: int):
    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: list[tuple] = []
            for k1, k2, rank, text in batch.itertuples(index=False):
                for pos, (start, end) in enumerate(spans(text, unit)):
                    words = text[start:end].lower().split()
                    if len(words) >= min_words:
                        digest = hashlib.blake2b(" ".join(words).encode(), digest_size=16).digest()
                        out.append((k1, k2, rank, pos, start, end, int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)))
                        if len(out) >= 20_000:
                            yield pd.DataFrame(out, columns=_UNIT_COLUMNS)
                            out = []
            yield pd.DataFrame(out, columns=_UNIT_COLUMNS)

    return split


_UNIT_COLUMNS = ["_k1", "_k2", "_rank", "_pos", "_start", "_end", "_d1", "_d2"]
_UNIT_SCHEMA = "_k1 long, _k2 long, _rank long, _pos int, _start int, _end int, _d1 long, _d2 long"


def repeated_units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "line", min_words: int = 5) -> DataFrame:
    """Rows ``_k1, _k2, start, end``: every unit that is not the earliest of its kind.

    Units are equal when their lower-cased words are. The earliest occurrence has
    the smallest integer id (null last), then the smallest row key and position.
    Digests are grouped with partial aggregation, then the repeated ones are
    joined back; a very common line is split by the adaptive skew join.
    """
    rows = docs.select(*row_keys(id_col, text_col), F.coalesce(F.col(id_col).cast("long"), F.lit(2**63 - 1)).alias("_rank"), F.col(text_col).alias("_text")).filter("_text is not null")
    units = stored(rows.mapInPandas(_splitter(unit, min_words), _UNIT_SCHEMA), "units")
    place = F.struct("_rank", "_k1", "_k2", "_pos")
    kinds = units.groupBy("_d1", "_d2").agg(F.count(F.lit(1)).alias("_n"), F.min(place).alias("_first")).filter("_n > 1")
    kinds = stored(kinds, "kinds")
    both = units.join(kinds, ["_d1", "_d2"]).filter(place > F.col("_first"))
    return both.select("_k1", "_k2", F.col("_start").alias("start"), F.col("_end").alias("end"))


def _cutter(unit: str):
    joint = "\n" if unit == "line" else "\n\n"

    @F.pandas_udf("string")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, removed in batches:
            out = []
            for text, gone in zip(texts, removed, strict=True):
                if text is not None and gone is not None:
                    starts = {int(x["start"]) for x in gone}
                    text = joint.join(text[a:b] for a, b in spans(text, unit) if a not in starts)
                out.append(text)
            yield pd.Series(out, dtype=object)

    return cut


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "line", min_words: int = 5) -> DataFrame:
    """All columns of ``docs`` with ``kept_text`` and ``removed``, the spans taken out as code point offsets in the original text (an empty array where none are).

    Units with fewer than ``min_words`` words always stay. Null texts stay null; a text whose units all go becomes empty; a text without
    removed units is unchanged. Rows equal in id and text count as one occurrence and are treated alike. Columns of ``docs`` named
    ``kept_text`` or ``removed`` are replaced.
    """
    names = [c for c in docs.columns if c not in ("kept_text", "removed")]
    gone = repeated_units(docs, id_col, text_col, unit, min_words).groupBy("_k1", "_k2").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("_gone"))
    keyed = docs.select(boxed(docs.columns), *row_keys(id_col, text_col)).join(gone, ["_k1", "_k2"], "left")
    text = _cutter(unit)(F.col("_row").getField(text_col), F.col("_gone"))
    return keyed.select(*unboxed(names), text.alias("kept_text"), F.coalesce("_gone", F.array().cast("array<struct<start:int,end:int>>")).alias("removed"))


#: A word ends a piece when the MD5 of it begins with one of these digits: one word in four.
_LAST = "0123"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_U = np.uint64
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 1 << 64)


class _Words(dict):
    """64-bit hash of each word, odd where the word ends a piece; the byte FF, a line break, is 0. Remembered in bounded memory."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if word == b"\xff":
            return 0
        h = xxhash.xxh64_intdigest(word) & ~1 | (hashlib.md5(word).hexdigest()[0] in _LAST)
        if len(self) >= 300_000:
            self.clear()
        if len(word) <= 64:
            self[word] = h or 2
        return h or 2


def pieces(text: str, words: _Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (A-Z lower-cased) and the number of the first word of each piece, closed by the number of words.

    A piece ends at a line break and after one word in four, told by the word
    itself, so equal passages have equal pieces wherever they begin.
    """
    tokens = text.encode("utf-8", "replace").lower().replace(b"\n", b" \xff ").split()
    v = np.fromiter(map(words.__getitem__, tokens), dtype=_U, count=len(tokens))
    breaks = v == 0
    last = ((v & _U(1)) > 0) | np.append(breaks[1:], True)[: len(v)]
    return v[~breaks], np.concatenate([[0], np.flatnonzero(last[~breaks]) + 1]) if len(v) else np.zeros(1, np.int64)


class _Powers:
    """Powers of a number modulo 2**64, as many as were ever asked for."""

    def __init__(self, base: int):
        self.base, self.known = base, np.ones(1, _U)

    def upto(self, n: int) -> np.ndarray:
        if len(self.known) < n:
            out = np.full(max(n, 2 * len(self.known)), _U(self.base))
            out[0] = 1
            self.known = np.multiply.accumulate(out)
        return self.known[:n]


_ON, _OFF = _Powers(_STEP), _Powers(_BACK)


def names(hashes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """64 bits that name the words from each of ``a`` up to ``b``, wherever they stand."""
    sums = np.zeros(len(hashes) + 1, _U)
    np.cumsum(hashes * _ON.upto(len(hashes)), out=sums[1:])
    x = (sums[b] - sums[a]) * _OFF.upto(len(hashes))[a] + (b - a).astype(_U) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def window_names(hashes: np.ndarray, start: int, end: int, size: int) -> np.ndarray:
    """Names of all windows of ``size`` words in the piece from ``start`` to ``end``."""
    a = np.arange(end - start - size + 1)
    return names(hashes[start:end], a, a + size)


def unit_names(hashes: np.ndarray, starts: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and names of the units: 2w for the piece that begins at word w with the next one, 2w + 1 for the window of
    ``min_words`` words at w inside a piece that has as many. Of the equal windows of a piece only the first is given."""
    places, found = [2 * starts[:-2]], [names(hashes, starts[:-2], starts[2:])]
    for j in np.flatnonzero(np.diff(starts) >= min_words):
        d, first = np.unique(window_names(hashes, starts[j], starts[j + 1], min_words), return_index=True)
        places.append(2 * (starts[j] + first) + 1)
        found.append(d)
    return np.concatenate(places).astype(np.int32), np.concatenate(found)


def _units(min_words: int):
    def rows(places: list[np.ndarray], found: list[np.ndarray], ranks: list[int], keys: list[int]) -> pd.DataFrame:
        sizes = np.array([len(d) for d in found])
        return pd.DataFrame({
            "_rank": np.repeat(np.array(ranks, np.int64), sizes), "_key": np.repeat(np.array(keys, np.int64), sizes),
            "_pos": np.concatenate(places), "_d": np.concatenate(found).view(np.int64),
        })

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _Words()
        for batch in batches:
            places: list[np.ndarray] = []
            found: list[np.ndarray] = []
            ranks: list[int] = []
            keys: list[int] = []
            held = 0
            for rank, key, text in zip(batch["_rank"].tolist(), batch["_key"].tolist(), batch["_text"], strict=True):
                at, d = unit_names(*pieces(text, known), min_words)
                places.append(at)
                found.append(d)
                ranks.append(rank)
                keys.append(key)
                held += len(d)
                if held >= 300_000:
                    yield rows(places, found, ranks, keys)
                    places, found, ranks, keys, held = [], [], [], [], 0
            if found:
                yield rows(places, found, ranks, keys)

    return digests


def removed_spans(text: str, repeated: list[int], min_words: int, words: _Words) -> list[tuple[int, int]]:
    """Start and end (code points) of the runs of at least ``min_words`` words whose units are repeated, given their places; a span ends where the next word begins."""
    hashes, starts = pieces(text, words)
    runs: list[list[int]] = []
    for j in np.searchsorted(starts, sorted(p >> 1 for p in repeated if not p & 1)).tolist():
        if runs and j == runs[-1][1] - 1:
            runs[-1][1] = j + 2
        else:
            runs.append([j, j + 2])
    taken = {j for a, b in runs for j in range(a, b)}
    parts = [(int(starts[a]), int(starts[b]), False) for a, b in runs]
    windows: dict[int, list[int]] = {}
    for w in (p >> 1 for p in repeated if p & 1):
        j = int(np.searchsorted(starts, w, "right")) - 1
        if j not in taken:
            windows.setdefault(j, []).append(w - int(starts[j]))
    for j, at in windows.items():
        d = window_names(hashes, starts[j], starts[j + 1], min_words)
        again = starts[j] + np.flatnonzero(np.isin(d, d[at]))
        gaps = np.flatnonzero(np.diff(again) > min_words)
        parts += [(a, b + min_words, True) for a, b in zip(again[np.append(0, gaps + 1)].tolist(), again[np.append(gaps, -1)].tolist(), strict=True)]
    found: list[tuple[int, int, bool]] = []
    for a, b, inside in sorted(parts):
        if found and found[-1][1] == a and (inside or found[-1][2]):
            found[-1] = (found[-1][0], b, inside)
        else:
            found.append((a, b, inside))
    found = [x for x in found if x[1] - x[0] >= min_words]
    if not found:
        return []
    at = [m.start() for m in _WORD.finditer(text)] + [len(text)]
    return [(at[a], at[b]) for a, b, _ in found]


def without_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 40, within: bool = True) -> DataFrame:
    """All columns of ``docs`` with ``kept_text`` and ``removed``, the spans taken out as code point offsets in the original text (an empty array where none are).

    Lines are cut into pieces of a few words (``pieces``). A piece is hashed
    together with the next one, and so is every window of ``min_words`` words inside a
    piece that has as many; the digests are grouped globally. The earliest
    occurrence has the smallest integer id (null last), then the smallest hash of the text, then the
    first position. What comes later is removed if it belongs to a run of neighbours
    that are all repeated and have at least ``min_words`` words in all, so common
    phrases and short lines stay while passages go wherever they begin in a line. Parts of pieces at the ends of a passage
    stay if they have fewer than ``min_words`` words; a passage that has fewer without them is missed. With ``within=False`` only what another
    document has before counts as repeated, not what the document itself has. What one piece repeats of itself (a word said over and
    over) counts for other documents and other pieces only.

    Texts are compared by words, A-Z lower-cased. A digest has 64 bits; one that collides can lengthen a run by a piece or take one window. Null texts stay null; a text that
    goes whole becomes empty. Rows equal in id and text count as one occurrence and are treated alike. Columns of
    ``docs`` named ``kept_text`` or ``removed`` are replaced. No rows give no rows. The digests are dealt out once, for the grouping
    and for the join back; a very common one is split by the adaptive skew join.
    """
    names = [c for c in docs.columns if c not in ("kept_text", "removed")]
    rank = F.coalesce(F.col(id_col).cast("long"), F.lit(2**63 - 1)).alias("_rank")
    key = F.xxhash64(F.lit(29), F.col(text_col)).alias("_key")
    texts = docs.select(rank, key, F.col(text_col).alias("_text")).filter("_text is not null")
    # stored, and the same columns for the grouping and for the join, so that Spark reads the texts and deals the digests out once
    dealt = stored(texts.mapInPandas(_units(min_words), "_rank long, _key long, _pos int, _d long"), "units").repartition("_d")
    place = F.struct("_rank", "_key", "_pos")
    kinds = dealt.groupBy("_d").agg(F.min(place).alias("_first"), F.max(place).alias("_last"))

    def spot(c: str) -> Column:
        return F.struct(*[F.col(f"{c}{k}") for k in (("_rank", "_key", "_pos") if within else ("_rank", "_key"))])

    kinds = kinds.filter(spot("_first.") != spot("_last.")).select("_d", "_first")
    later = dealt.join(kinds, "_d").filter(F.coalesce(spot("") > spot("_first."), F.lit(False)))
    # never null, which Spark need not know; a filter on it would tell the two readings of the digests apart
    keys = [F.coalesce(c, F.lit(0)).alias(c) for c in ("_rank", "_key")]
    gone = later.select(*keys, "_pos").groupBy("_rank", "_key").agg(F.collect_set("_pos").alias("_gone"))

    @F.pandas_udf("kept string, removed array<struct<start:int,end:int>>")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        known = _Words()
        for texts, repeated in batches:
            out = []
            for text, places in zip(texts, repeated, strict=True):
                taken = removed_spans(text, list(places), min_words, known) if text is not None and places is not None else []
                edges = [0, *[x for span in taken for x in span], len(text or "")]
                kept = "".join(text[i:j] for i, j in zip(edges[::2], edges[1::2], strict=True)) if taken else None
                out.append((kept, [{"start": i, "end": j} for i, j in taken]))
            yield pd.DataFrame(out, columns=["kept", "removed"])

    keyed = docs.select(boxed(docs.columns), rank, key).join(gone, ["_rank", "_key"], "left")
    text = F.col("_row").getField(text_col)
    done = keyed.select("_row", cut(F.when(F.col("_gone").isNotNull(), text), F.col("_gone")).alias("_cut"))
    return done.select(*unboxed(names), F.coalesce("_cut.kept", text).alias("kept_text"), F.col("_cut.removed").alias("removed"))
