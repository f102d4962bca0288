"""Dictionary matching for dictionaries of any size: bitmaps of fixed size propose, a join by the key confirms."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.functions.bitmap import BITS, bitmap
from tidewire.sources.tables import cut_lineage

#: Bytes of a key that are looked for first.
GRAM = 6
#: Keys of lower ``ord`` than this are known to the texts' tasks by their hashes, where only the first names of a text are wanted: 24 MB at most.
LISTED = 1 << 20


def text_keys(text: Column | str) -> list[Column]:
    """Two 64-bit hashes that name a text: equal texts have equal matches."""
    return [F.xxhash64(F.lit(3), text).alias("_t1"), F.xxhash64(text, F.lit(5)).alias("_t2")]


_STEP = 0x9E3779B97F4A7C15


class _Runs:
    """Hashes of the byte runs of a text: sums of powers modulo 2**64, mixed with the length. Equal runs have equal hashes."""

    on, off = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def __init__(self, low: bytes):
        n = len(low)
        if len(_Runs.on) < n:
            for name, base in (("on", _STEP), ("off", pow(_STEP, -1, 1 << 64))):
                powers = np.full(2 * n, np.uint64(base))
                powers[0] = 1
                setattr(_Runs, name, np.multiply.accumulate(powers))
        self.bytes = np.frombuffer(low, np.uint8)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((self.bytes + np.uint64(1)) * _Runs.on[:n], out=self.sums[1:])

    def at(self, places: np.ndarray, size: int) -> np.ndarray:
        x = (self.sums[places + size] - self.sums[places]) * _Runs.off[places] + np.uint64(size * 0xD6E8FEB86659FD93 % 2**64)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


def _key_hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    start = np.zeros(1, np.int64)
    for batch in batches:
        rows = [(len(k), int(r.at(start, len(k))[0].view(np.int64)), int(r.at(start, min(len(k), GRAM))[0].view(np.int64))) for k in map(bytes, batch["k"]) for r in (_Runs(k),)]
        yield pd.DataFrame(np.array(rows, np.int64).reshape(-1, 3), columns=["size", "whole", "begin"])


def _dense(hashes: DataFrame, name: str) -> np.ndarray:
    """A bitmap as numbers: 2 MB whatever the number of hashes."""
    out = np.zeros((512, 512), np.int64)
    for r in bitmap(hashes, name).toLocalIterator():
        out[r["piece"]] = r["bits"]
    return out.reshape(-1)


def _marked(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = (hashes & np.uint64((1 << BITS) - 1)).astype(np.int64)
    return (bits[slot >> 6] >> (slot & 63)) & 1 == 1


class _Leading:
    """Leaves of the keys found in a text those that stand no later in the dictionary than the ``names``-th name in it."""

    def __init__(self, keys: DataFrame, names: int):
        place = F.coalesce(F.col("ord").cast("long"), F.lit(-1 << 32))  # null sorts first
        name = F.xxhash64(F.concat_ws("\x1f", F.lower("canonical"), "alias_type"))
        listed = keys.select(place.alias("ord"), name.alias("name"), F.col("alias_key").cast("binary").alias("k")).filter(F.col("ord") < LISTED)

        def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                yield batch[["ord", "name"]].assign(whole=next(_key_hashes(iter([batch])))["whole"].to_numpy())

        table = listed.mapInPandas(hashed, "ord long, name long, whole long").toArrow()
        whole = table["whole"].to_numpy().view(np.uint64)
        order = np.lexsort((table["ord"].to_numpy(), whole))  # of a key with several entries the first is met
        self.names, self.whole, self.ord, self.name = names, whole[order], table["ord"].to_numpy()[order], table["name"].to_numpy()[order]

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        """Which keys of these hashes are left. All are, unless enough names are listed; an unlisted key comes after all that are."""
        every = np.ones(len(hashes), bool)
        if not len(self.whole) or len(hashes) < self.names:
            return every
        at = np.minimum(np.searchsorted(self.whole, hashes), len(self.whole) - 1)
        known = self.whole[at] == hashes
        ords = self.ord[at]
        _, first = np.unique(self.name[at[known][np.argsort(ords[known], kind="stable")]], return_index=True)
        if len(first) < self.names:
            return every
        return known & (ords <= np.sort(ords[known])[np.sort(first)[self.names - 1]])


def row_hits(df: DataFrame, aliases: DataFrame, text: str, keep: Sequence[Column | str], names: int | None = None) -> DataFrame:
    """Rows ``*keep, alias_key, canonical, alias_type, ord, start``: every key that is part of a lower-cased
    text, with the code point where it first stands; one row of ``df`` has a key once.

    Nothing of the dictionary reaches the driver but the byte lengths of its keys and two bitmaps of fixed size. Each place of a text is tested for the
    first ``GRAM`` bytes of a key, then for whole keys of each length; the first of its kind in the text meets the
    dictionary in a join by the key itself. So no text is shuffled, and a key travels once per text however often it stands there. UTF-8
    bytes match where characters do. Null texts and empty keys match nothing.

    With ``names``, only the keys that stand no later in the dictionary than the so many-th distinct name (canonical, case ignored, and
    type) of a text need be returned; the others stay in the task, where the hashes of the first ``LISTED`` keys tell them.
    """
    keys = cut_lineage(aliases.filter(F.length("alias_key") > 0).select("alias_key", "canonical", "alias_type", "ord"))
    hashed = cut_lineage(keys.select(F.col("alias_key").cast("binary").alias("k")).mapInPandas(_key_hashes, "size int, whole long, begin long"))
    lengths = sorted(r["size"] for r in hashed.select("size").distinct().collect())
    whole, begin = _dense(hashed, "whole"), _dense(hashed, "begin")
    leading = _Leading(keys, names) if names else None
    low = df.select(*keep, F.lower(F.col(text)).alias("_low")).filter("_low is not null")
    kept = [c for c in low.columns if c != "_low"]

    def found(text: str) -> tuple[list[str], list[int]]:
        low = text.encode()
        runs = _Runs(low)
        code_points = np.cumsum((runs.bytes & 0xC0) != 0x80) - 1
        first: dict[bytes, tuple[int, int]] = {}
        places: dict[int, np.ndarray] = {}
        for size in lengths:
            if size > len(low):
                break
            lead = min(size, GRAM)
            if lead not in places:
                every = np.arange(len(low) - lead + 1)
                places[lead] = every[_marked(begin, runs.at(every, lead))]
            at = places[lead][: np.searchsorted(places[lead], len(low) - size, side="right")]
            hashes = runs.at(at, size)
            marked = _marked(whole, hashes)
            for p, h in zip(at[marked].tolist(), hashes[marked].tolist(), strict=True):
                first.setdefault(low[p : p + size], (p, h))
        # a run that begins or ends inside a character is no key
        inside = np.append((runs.bytes & 0xC0) == 0x80, False)
        clean = [(k, p, h) for k, (p, h) in first.items() if not inside[p] and not inside[p + len(k)]]
        if leading:
            clean = [c for c, left in zip(clean, leading(np.array([h for _, _, h in clean], np.uint64)), strict=True) if left]
        return [k.decode() for k, _, _ in clean], [int(code_points[p]) for _, p, _ in clean]

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, keys, starts = [], [], []
            for i, text in enumerate(batch["_low"]):
                k, s = found(text)
                rows += [i] * len(k)
                keys += k
                starts += s
                if len(keys) >= 100_000 or i == len(batch) - 1:
                    yield batch[kept].iloc[rows].assign(alias_key=np.array(keys, object), start=np.array(starts, np.int32))
                    rows, keys, starts = [], [], []

    shape = T.StructType([*[low.schema[c] for c in kept], T.StructField("alias_key", T.StringType()), T.StructField("start", T.IntegerType())])
    return low.mapInPandas(find, shape).join(keys, "alias_key").select(*kept, "alias_key", "canonical", "alias_type", "ord", "start")


def dictionary_hits(df: DataFrame, aliases: DataFrame, text: str = "text") -> DataFrame:
    """Rows ``_t1, _t2`` (see ``text_keys``), ``alias_key, canonical, alias_type, ord, start`` of ``row_hits``, equal texts as one."""
    hits = row_hits(df, aliases, text, text_keys(text))
    return hits.groupBy("_t1", "_t2", "ord").agg(*[F.first(c).alias(c) for c in ("alias_key", "canonical", "alias_type")], F.min("start").alias("start"))


def with_dictionary_hits(df: DataFrame, aliases: DataFrame, text: str = "text", confidence: float = 0.85, name: str = "_listed", names: int | None = None) -> DataFrame:
    """Add ``name``: the keys found in each text as ``array<struct<name, type, confidence, key>>`` in dictionary order, empty where none are.

    With ``names``, keys that come after the first so many distinct names of a text may be left out.
    """
    hits = row_hits(df, aliases, text, text_keys(text), names).groupBy("_t1", "_t2").agg(F.array_sort(F.collect_set(F.struct("ord", "canonical", "alias_type", "alias_key"))).alias("_hits"))
    one = F.transform("_hits", lambda h: F.struct(h["canonical"].alias("name"), h["alias_type"].alias("type"), F.lit(confidence).alias("confidence"), h["alias_key"].alias("key")))
    none = F.array().cast("array<struct<name:string,type:string,confidence:double,key:string>>")
    first, second = text_keys(text)
    keyed = df.withColumns({"_t1": first, "_t2": second})
    return keyed.join(hits, ["_t1", "_t2"], "left").withColumn(name, F.coalesce(one, none)).drop("_t1", "_t2", "_hits")
