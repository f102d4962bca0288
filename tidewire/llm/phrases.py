"""Phrase collocations: exact phrase counts from burstable tries that spill sorted runs, and scores of their weakest cuts."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewire.llm.bits import bits_set, shared_bits
from tidewire.llm.keys import stored

#: Longest phrase; a phrase is packed as one word id and up to three more of ID_BITS bits.
LONGEST, ID_BITS = 4, 21
#: A container of a trie bursts beyond so many phrases, and a trie spills beyond so many.
BURST, ROOM = 4096, 400_000
#: Words that a task remembers, frequent or not.
REMEMBERED = 250_000
#: Tokens counted at once.
BATCH_TOKENS = 400_000
#: A longer text is read in slices of so many characters.
SLICE_CHARS = 2_000_000
#: Bits of a phrase's slot in the first pass, and hashes that a task holds there.
SLOT_BITS, SLOT_ROOM = 40, 3_000_000
#: Bits of the filter of frequent phrases, as a power of two: 8 MB whatever the input.
FILTER_BITS = 26

_U = np.uint64
_END = b"\xff"
_SEPARATORS = bytes(_END[0] if chr(c) in ".,;:!?\n\x0b\x0c\r" else c for c in range(256))
_BREAK = re.compile(r"[ \t.,;:!?\n\x0b\x0c\r]")
_PLACES = np.random.default_rng(11).integers(1, 1 << 63, LONGEST, dtype=_U) | _U(1)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0x7FB5D329728EA185)
    x = (x ^ (x >> _U(27))) * _U(0x81DADEF4BC2DD44D)
    return x ^ (x >> _U(33))


def pieces_and_words(text: str) -> list[bytes]:
    """Lower-cased words; the byte FF, which no text holds, stands between pieces."""
    return text.encode("utf-8", "replace").lower().translate(_SEPARATORS).replace(_END, b" \xff ").split()


def slices(text: str) -> Iterator[str]:
    """The text in parts that cut no word."""
    start = 0
    while start < len(text):
        m = _BREAK.search(text, start + SLICE_CHARS)
        end = m.start() if m else len(text)
        yield text[start:end]
        start = end


def word_hash(lang: str, word: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(word, xxhash.xxh64_intdigest(lang.encode("utf-8", "replace")) & 0x7FFFFFFF)


def phrase_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """One number for each run of ``length`` words."""
    n = len(hashes) - length + 1
    total = np.full(max(n, 0), _U(length))
    for j in range(length):
        total += hashes[j : j + max(n, 0)] * _PLACES[j]
    return mixed(total)


class Container:
    """Counts of the phrases that go on from one prefix, by their packed other words."""

    __slots__ = ("counts",)

    def __init__(self) -> None:
        self.counts: dict[int, int] = {}


class PhraseTrie:
    """Burstable trie over word ids: a shallow trie of first words whose leaves are hash containers.

    A container with more than ``BURST`` phrases becomes an inner node with one container per
    second word. Beyond ``ROOM`` phrases the largest subtrees leave as sorted
    runs, as a whole each, until half of the room is free.
    """

    def __init__(self, burst: int = BURST, room: int = ROOM):
        self.burst, self.room, self.size = burst, room, 0
        self.root: dict[int, Container | dict[int, Container]] = {}
        self.weights: dict[int, int] = {}

    def add(self, first: int, rest: list[int], counts: list[int]) -> None:
        """Add counts of phrases that begin with ``first``; ``rest`` is ascending."""
        node = self.root.get(first)
        if node is None:
            node = self.root[first] = Container()
            self.weights[first] = 0
        before = self.weights[first]
        if isinstance(node, Container):
            grown = self._fill(node, rest, counts)
            if len(node.counts) > self.burst:
                children: dict[int, Container] = {}
                for key, n in node.counts.items():
                    second = key >> (2 * ID_BITS)
                    if second not in children:
                        children[second] = Container()
                    children[second].counts[key] = n
                self.root[first] = children
        else:
            grown, start = 0, 0
            while start < len(rest):
                second, end = rest[start] >> (2 * ID_BITS), start + 1
                while end < len(rest) and rest[end] >> (2 * ID_BITS) == second:
                    end += 1
                if second not in node:
                    node[second] = Container()
                grown += self._fill(node[second], rest[start:end], counts[start:end])
                start = end
        self.weights[first] = before + grown
        self.size += grown

    @staticmethod
    def _fill(container: Container, rest: list[int], counts: list[int]) -> int:
        held = container.counts
        before = len(held)
        for key, n in zip(rest, counts, strict=True):
            held[key] = held.get(key, 0) + n
        return len(held) - before

    def runs(self, everything: bool = False) -> Iterator[tuple[int, list[tuple[int, int]]]]:
        """First word and sorted ``(rest, count)`` of each subtree that has to leave."""
        if not everything and self.size <= self.room:
            return
        keep = 0 if everything else self.room // 2
        for first in sorted(self.weights, key=self.weights.__getitem__, reverse=True):
            if self.size <= keep:
                break
            node = self.root.pop(first)
            leaves = [node] if isinstance(node, Container) else [node[k] for k in sorted(node)]
            self.size -= self.weights.pop(first)
            yield first, [pair for leaf in leaves for pair in sorted(leaf.counts.items())]


class _Hashes(dict):
    """Hash of each word of one language, 0 for the end of a piece; remembered in bounded memory."""

    def __init__(self, lang: str):
        super().__init__()
        self.lang = lang

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        h = 0 if word == _END else word_hash(self.lang, word)
        if len(word) <= 64:
            self[word] = h
        return h


def _filter_bits_of(slots: np.ndarray) -> np.ndarray:
    return mixed(slots) >> _U(64 - FILTER_BITS)


def _slots(hashes: np.ndarray) -> np.ndarray:
    return hashes >> _U(64 - SLOT_BITS)


def _passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return bits_set(bits, _filter_bits_of(_slots(hashes)))


def _whole(breaks: np.ndarray, length: int, starts: int) -> np.ndarray:
    """Which of the first ``starts`` words begin a run of ``length`` words of one piece."""
    n = max(min(len(breaks) - length + 1, starts), 0)
    ok = np.ones(n, dtype=bool)
    for j in range(length):
        ok &= ~breaks[j : j + n]
    return ok


class _Words:
    """Word ids of a task: 0 for piece ends and words that cannot be frequent."""

    def __init__(self, bits: np.ndarray | None):
        self.bits = bits
        self.clear()

    def clear(self) -> None:
        self.ids: dict[str, dict[bytes, int]] = {}
        self.words: list[tuple[str, bytes]] = [("", _END)]
        self.hashes: list[int] = [0]
        self.known = 0

    def look_up(self, lang: str, tokens: list[bytes]) -> np.ndarray:
        ids = self.ids.setdefault(lang, {_END: 0})
        found = list(map(ids.get, tokens))
        if None in found:
            new = list(dict.fromkeys(t for t, i in zip(tokens, found, strict=True) if i is None))
            hashes = [word_hash(lang, w) for w in new]
            ok = np.ones(len(new), dtype=bool) if self.bits is None else _passes(self.bits, phrase_hashes(np.array(hashes, _U), 1))
            for word, h, counts in zip(new, hashes, ok.tolist(), strict=True):
                if counts:
                    ids[word] = len(self.words)
                    self.words.append((lang, word))
                    self.hashes.append(h)
                else:
                    ids[word] = 0
            self.known += len(new)
            found = list(map(ids.__getitem__, tokens))
        return np.array(found, dtype=np.int64)

    def full(self) -> bool:
        return self.known > REMEMBERED


def _packed(ids: np.ndarray, hashes: np.ndarray, lengths: tuple[int, ...], starts: int, bits: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """First word and packed rest of every phrase of the given lengths that may be frequent and begins among the first ``starts`` words."""
    firsts, rests = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    breaks, before = ids == 0, None
    for length in lengths:
        ok = _whole(breaks, length, starts)
        if bits is not None and length > 1:
            at = np.flatnonzero(ok)
            if before is not None:
                # a phrase is no more frequent than the one it begins with
                at = at[before[at]]
            passed = at[_passes(bits, phrase_hashes(hashes, length)[at])]
            ok = np.zeros(len(ok), dtype=bool)
            ok[passed] = True
        before = ok if length > 1 else None
        at = np.flatnonzero(ok)
        rest = np.zeros(len(at), dtype=np.int64)
        for j in range(1, LONGEST):
            rest <<= ID_BITS
            if j < length:
                rest |= ids[at + j]
        firsts.append(ids[at])
        rests.append(rest)
    return np.concatenate(firsts), np.concatenate(rests)


_RUN = ["part", "lang", "phrases", "counts"]
_RUN_TYPES = "part int, lang string, phrases array<string>, counts array<long>"


def _counter(lengths: tuple[int, ...], filter_bits, burst: int, room: int, parts_of: int = 4096):
    """Count the phrases of the given lengths in a task and return sorted runs of them per prefix partition.

    Only phrases that pass the broadcast filter of frequent ones are counted; it may let others pass, but holds no frequent one back.
    A prefix partition has the phrases of a language that begin with the same two words, by hash. The empty phrase counts all words.
    """
    low = (1 << ID_BITS) - 1
    ahead = max(lengths) - 1

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = None if filter_bits is None else np.frombuffer(filter_bits.value, dtype=np.uint8)
        words, trie = _Words(bits), PhraseTrie(burst, room)

        def runs(everything: bool) -> Iterator[pd.DataFrame]:
            out: dict[tuple[int, str], tuple[list[str], list[int]]] = {}
            for first, run in trie.runs(everything):
                lang, head = words.words[first]
                at, phrases, counts = -1, [], []
                for rest, n in run:
                    second = rest >> (2 * ID_BITS)
                    if second != at:
                        at = second
                        phrases, counts = out.setdefault(((words.hashes[first] * 3 + words.hashes[second]) % parts_of, lang), ([], []))
                    more = [words.words[i][1] for i in (second, (rest >> ID_BITS) & low, rest & low) if i]
                    phrases.append(b" ".join([head, *more]).decode())
                    counts.append(n)
            if out:
                yield pd.DataFrame([(part, lang, *run) for (part, lang), run in out.items()], columns=_RUN)

        def count_now(ids: np.ndarray, starts: int) -> None:
            firsts, rests = _packed(ids, np.array(words.hashes, dtype=_U)[ids], lengths, starts, bits)
            if not len(firsts):
                return
            single = np.bincount(firsts[rests == 0], minlength=1)
            for i in np.flatnonzero(single).tolist():
                trie.add(i, [0], [int(single[i])])
            firsts, rests = firsts[rests != 0], rests[rests != 0]
            if not len(firsts):
                return
            order = np.lexsort((rests, firsts))
            firsts, rests = firsts[order], rests[order]
            new = np.flatnonzero(np.concatenate([[True], (np.diff(firsts) != 0) | (np.diff(rests) != 0)]))
            counts = np.diff(np.concatenate([new, [len(firsts)]])).tolist()
            firsts, rests = firsts[new], rests[new].tolist()
            edges = [*np.flatnonzero(np.concatenate([[True], np.diff(firsts) != 0])).tolist(), len(firsts)]
            for a, b in zip(edges, edges[1:], strict=False):
                trie.add(int(firsts[a]), rests[a:b], counts[a:b])

        end, parts, held, total = np.zeros(1, dtype=np.int64), [], 0, Counter()
        for batch in batches:
            for lang, text in zip(batch["_lang"], batch["_text"], strict=True):
                for part in slices(text):
                    tokens = pieces_and_words(part)
                    total[lang] += len(tokens) - tokens.count(_END)
                    parts.append(words.look_up(lang, tokens))
                    held += len(parts[-1])
                    if held >= BATCH_TOKENS or words.full():
                        # the last words may begin phrases that go on in the next slice: they are counted then
                        ids = np.concatenate(parts)
                        starts = max(0, len(ids) - ahead)
                        tail = [words.words[i][1] for i in ids[starts:]]
                        count_now(ids, starts)
                        yield from runs(words.full())
                        if words.full():
                            words.clear()
                        parts, held = [words.look_up(lang, tail)], len(tail)
                parts.append(end)
        if parts:
            ids = np.concatenate(parts)
            count_now(ids, len(ids))
        yield from runs(True)
        yield pd.DataFrame([(0, lang, [""], [n]) for lang, n in total.items() if n], columns=_RUN)

    return count


def _slot_runs(lengths: tuple[int, ...], least: int, ranges: int):
    """Count the slots of all phrases of a task, and return them as sorted runs cut into ranges of slots.

    Counts stop at ``least``, and slots are written as differences, low and high halves apart, so a run takes a few bytes a phrase.
    """
    ahead, width = max(lengths) - 1, SLOT_BITS - ranges.bit_length() + 1
    small = np.uint8 if least < 256 else np.uint32

    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        slots, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(slots, kind="stable")
        slots, counts = slots[order], counts[order]
        new = np.flatnonzero(np.concatenate([[True], slots[1:] != slots[:-1]]))
        return slots[new], np.minimum(np.add.reduceat(counts.astype(np.int64), new), least).astype(small)

    def rows(slots: np.ndarray, counts: np.ndarray) -> pd.DataFrame:
        numbers = slots >> _U(width)
        first = np.flatnonzero(np.concatenate([[True], numbers[1:] != numbers[:-1]]))
        gaps = np.diff(slots, prepend=_U(0))
        gaps[first] = slots[first] & _U((1 << width) - 1)
        low, high = (gaps & _U(0xFFFF)).astype(np.uint16), (gaps >> _U(16)).astype(np.uint32)
        out = [(int(numbers[a]), low[a:b].tobytes(), high[a:b].tobytes(), counts[a:b].tobytes()) for a, b in zip(first.tolist(), [*first[1:].tolist(), len(slots)], strict=True)]
        return pd.DataFrame(out, columns=["range", "low", "high", "counts"])

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, _Hashes] = {}
        parts: list[np.ndarray] = []
        held, runs, room = 0, [], 0
        end = np.zeros(1, _U)

        def count_now(h: np.ndarray, starts: int) -> None:
            nonlocal room
            breaks = h == 0
            found = []
            for k in lengths:
                ok = _whole(breaks, k, starts)
                found.append(_slots(phrase_hashes(h, k)[: len(ok)][ok]))
            slots, counts = np.unique(np.concatenate(found), return_counts=True)
            if len(slots):
                runs.append((slots, np.minimum(counts, least).astype(small)))
                room += len(slots)

        for batch in batches:
            for lang, text in zip(batch["_lang"], batch["_text"], strict=True):
                if lang not in known and len(known) >= 64:
                    known.clear()
                hashes = known.setdefault(lang, _Hashes(lang))
                for part in slices(text):
                    tokens = pieces_and_words(part)
                    parts.append(np.fromiter(map(hashes.__getitem__, tokens), dtype=_U, count=len(tokens)))
                    held += len(tokens)
                    if held >= BATCH_TOKENS:
                        h = np.concatenate(parts)
                        starts = max(0, len(h) - ahead)
                        count_now(h, starts)
                        parts, held = [h[starts:]], ahead
                        if room >= SLOT_ROOM:
                            yield rows(*merged(runs))
                            runs, room = [], 0
                parts.append(end)
        if parts:
            h = np.concatenate(parts)
            count_now(h, len(h))
        if runs:
            yield rows(*merged(runs))

    return read


def _ranges(df: DataFrame) -> int:
    """A power of two, many times the number of shuffle partitions."""
    return max(4096, 1 << (int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 16).bit_length())


def _frequent_filter(texts: DataFrame, lengths: tuple[int, ...], least: int) -> Broadcast:
    """Broadcast bitmap that holds every phrase with at least ``least`` occurrences.

    All phrases are counted by a slot of ``SLOT_BITS`` bits; the runs of the tasks meet per range of slots, of which there are many more
    than shuffle partitions. Slots are so many that hardly any two phrases of a corpus share one, and a shared one lets a phrase pass that need not.
    """
    ranges = _ranges(texts)
    width = SLOT_BITS - ranges.bit_length() + 1
    small = np.uint8 if least < 256 else np.uint32

    def frequent(runs: pd.DataFrame) -> pd.DataFrame:
        slots, counts = [], []
        for low, high, n in zip(runs["low"], runs["high"], runs["counts"], strict=True):
            gaps = np.frombuffer(low, np.uint16).astype(_U) | np.frombuffer(high, np.uint32).astype(_U) << _U(16)
            slots.append(np.cumsum(gaps, dtype=_U))
            counts.append(np.frombuffer(n, small).astype(np.int64))
        slot, count = np.concatenate(slots), np.concatenate(counts)
        order = np.argsort(slot, kind="stable")
        slot, count = slot[order], count[order]
        new = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
        found = slot[new][np.add.reduceat(count, new) >= least] | _U(int(runs["range"].iloc[0])) << _U(width)
        return pd.DataFrame({"bit": _filter_bits_of(found).astype(np.int64)})

    runs = texts.mapInPandas(_slot_runs(lengths, least, ranges), "range int, low binary, high binary, counts binary")
    return shared_bits(runs.groupBy("range").applyInPandas(frequent, "bit long"), "bit", FILTER_BITS)


def _merged(least: int):
    """Add up the runs of a prefix partition of one language, and keep what is frequent."""

    def merge(runs: pd.DataFrame) -> pd.DataFrame:
        found: Counter = Counter()
        for phrases, counts in zip(runs["phrases"], runs["counts"], strict=True):
            for phrase, n in zip(phrases, counts.tolist(), strict=True):
                found[phrase] += n
        kept = [(p, n) for p, n in found.items() if n >= least or not p]
        lang = str(runs["lang"].iloc[0])
        rows = [(lang, p, p.count(" ") + 1, n) for p, n in kept]
        return pd.DataFrame(np.array(rows, dtype=object).reshape(len(rows), 4), columns=["lang", "phrase", "words", "f"]).astype({"words": "int32", "f": "int64"})

    return merge


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 30, burst: int = BURST, room: int = ROOM) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, words, f`` of all phrases of one to four words with at least ``least`` occurrences, and ``lang, n`` of all words.

    A first pass counts phrases by hash and leaves a filter of the frequent ones:
    a bitmap of fixed size that may pass too much, never too little. The second
    pass counts what passes. Each task keeps a ``PhraseTrie`` and sends
    its subtrees as sorted runs to prefix partitions, many more than tasks, where
    equal phrases are added up: one run per task and spill, however often a phrase occurs.
    """
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("_lang"), F.col(text_col).alias("_text")).filter("_text is not null")
    lengths = tuple(range(1, LONGEST + 1))
    shared = _frequent_filter(texts, lengths, least)
    runs = texts.mapInPandas(_counter(lengths, shared, burst, room, _ranges(texts)), _RUN_TYPES)
    counts = stored(runs.groupBy("part", "lang").applyInPandas(_merged(least), "lang string, phrase string, words int, f long"), "counts")
    shared.destroy()
    return counts.filter("phrase <> ''"), counts.filter("phrase = ''").select("lang", F.col("f").alias("n"))


def _counted(cuts: DataFrame, counts: DataFrame, part: str, name: str, salts: int = 16) -> DataFrame:
    """Add the count of the phrase in column ``part``. Very many cuts share a frequent word, so single words are spread over salts."""
    spread = F.when(F.col("words") == 1, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    side = counts.select("lang", F.col("phrase").alias(part), F.col("f").alias(name), F.explode(spread).alias("_salt"))
    salt = F.when(F.instr(part, " ") == 0, F.pmod(F.xxhash64("phrase", "k"), F.lit(salts)).cast("int")).otherwise(0)
    return cuts.withColumn("_salt", salt).join(side, ["lang", part, "_salt"]).drop("_salt")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 30, top: int = 2000, subsumed: int = 80, **options) -> DataFrame:
    """The ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    A phrase of two to four words with ``a >= least`` occurrences scores
    floor(2000000 a / (l + r)) at its weakest cut into parts with l and r
    occurrences. A phrase that lies in a longer candidate with at least
    ``subsumed`` hundredths of its occurrences is dropped. Ties go to the phrase of
    more occurrences, then to the smaller one in UTF-8 bytes. Decimals of 38 digits keep the arithmetic exact.

    Null texts and texts without words add nothing, a null language is ``und``;
    repeated rows count as often as they stand there. Other columns are ignored. No rows give no rows.
    """
    counts, totals = phrase_counts(docs, text_col, lang_col, least, **options)
    candidates = counts.filter("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"))
    parts = F.split("phrase", " ")
    cuts = candidates.select("lang", "phrase", "a", parts.alias("_w"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("_w", 1, F.col("k")), " ").alias("_head"), F.array_join(F.slice("_w", F.col("k") + 1, F.size("_w") - F.col("k")), " ").alias("_tail"))
    cuts = _counted(_counted(cuts, counts, "_head", "l"), counts, "_tail", "r")
    score = F.expr("(cast(a as decimal(20,0)) * 2000000) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    best = cuts.select("lang", "phrase", "a", F.struct(score.alias("score"), "k", "l", "r").alias("_cut")).groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min("_cut").alias("_cut"))
    inner = candidates.filter("words > 2").select("lang", "a", "words", parts.alias("_w"))
    inner = inner.select("lang", "a", "_w", "words", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("_m"))
    inner = inner.select("lang", "a", "_w", "_m", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("_m") + 1)).alias("_i"))
    inner = inner.groupBy("lang", F.array_join(F.slice("_w", F.col("_i"), F.col("_m")), " ").alias("phrase")).agg(F.max("a").alias("_longer"))
    exact = "decimal(20,0)"
    kept = best.join(inner, ["lang", "phrase"], "left").filter(F.col("_longer").isNull() | (F.col("_longer").cast(exact) * 100 < F.col("a").cast(exact) * subsumed))
    ranked = kept.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(F.desc("_cut.score"), F.desc("a"), "phrase"))).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "_cut.l", "_cut.r", "n", "_cut.score")
