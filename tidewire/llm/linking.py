"""Confirmed links between classes of equal sets that share buckets: star proposals first, then blocks of what is left."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.components import components
from tidewire.llm.keys import stored

#: Room left before a pair of sketches is passed over: ``slack(sketches_a, sketches_b, n_a, n_b, samples_a, samples_b)``, negative where the pair cannot be linked.
Slack = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]

_BLOCK_ROW = "block long, node long, comp long, inside boolean, outside boolean, n int, samples int, sketch binary"


def folded(sketches: Sequence[bytes], size: int) -> np.ndarray:
    """Sketches as rows of 64-bit words, longer ones folded to ``size`` bytes: the parts are XORed, so a fold differs in no more bits than the whole."""
    lengths = np.fromiter(map(len, sketches), dtype=np.int64, count=len(sketches))
    out = np.zeros((len(sketches), size // 8), dtype=np.uint64)
    for length in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == length)
        parts = np.frombuffer(b"".join([sketches[i] for i in at]), dtype=np.uint64).reshape(len(at), length // size, size // 8)
        out[at] = np.bitwise_xor.reduce(parts, axis=1)
    return out


def shared_buckets(entries: DataFrame) -> DataFrame:
    """Rows ``bucket, node, lead`` of the buckets with several nodes; the lead is the smallest of them.

    The entries are dealt by bucket once, for the counting and for the join. A
    large group of alike classes has many buckets, and one that is large by itself is split by the adaptive skew join.
    """
    dealt = entries.repartition("bucket")
    several = dealt.groupBy("bucket").agg(F.min("node").alias("lead"), F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("bucket", "lead")
    return dealt.join(several, "bucket").select("bucket", "node", "lead")


def _by_block(answer):
    """Hand whole blocks to ``answer``; the rows of a block are consecutive."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: list[pd.DataFrame] = []
        for batch in batches:
            if not len(batch):
                continue
            waiting.append(batch)
            if batch["block"].iloc[0] == batch["block"].iloc[-1] == waiting[0]["block"].iloc[0]:
                continue
            rows = pd.concat(waiting, ignore_index=True)
            last = rows["block"].iloc[-1]
            whole, waiting = rows[rows["block"] != last], [rows[rows["block"] == last]]
            if len(whole):
                yield answer(whole)
        if waiting:
            yield answer(pd.concat(waiting, ignore_index=True))

    return read


def _likely_partners(rows: pd.DataFrame, similarity: float, slack: Slack) -> Iterator[tuple[int, int, np.ndarray]]:
    """Block number, an outsider's row and the rows of all members of other components that its sketch may be linked with, the likeliest first."""
    block, comp, n, c, inside, outside = (rows[k].to_numpy() for k in ("block", "comp", "n", "samples", "inside", "outside"))
    texts = rows["sketch"].tolist()
    edges = np.flatnonzero(np.diff(block)) + 1
    for number, (start, end) in enumerate(zip([0, *edges], [*edges, len(rows)], strict=True)):
        others = start + np.flatnonzero(inside[start:end])
        asked = start + np.flatnonzero(outside[start:end])
        if not len(others) or not len(asked):
            continue
        sketches = folded(texts[start:end], min(map(len, texts[start:end])))
        for i in asked:
            fits = others[(comp[others] != comp[i]) & (np.minimum(n[others], n[i]) >= similarity * np.maximum(n[others], n[i]))]
            if len(fits):
                room = slack(sketches[fits - start], sketches[i - start], n[fits], n[i], c[fits], c[i])
                fits = fits[np.argsort(-room, kind="stable")][: np.count_nonzero(room >= 0)]
                if len(fits):
                    yield number, i, fits


def _participants(similarity: float, slack: Slack):
    """The rows of blocks that are in any likely pair: at most the rows that came, never the pairs."""

    def answer(rows: pd.DataFrame) -> pd.DataFrame:
        used = np.zeros(len(rows), dtype=bool)
        for _, i, fits in _likely_partners(rows, similarity, slack):
            used[i] = True
            used[fits] = True
        return rows[used]

    return _by_block(answer)


def _links(percent: int, slack: Slack):
    """Exact links between components: intersections of full sets, until each pair of components of a block is joined or every likely pair of theirs refuted."""

    def answer(rows: pd.DataFrame) -> pd.DataFrame:
        comp, node, sets = (rows[k].to_numpy() for k in ("comp", "node", "shingles"))
        found, joined, at = [], {}, -1

        def find(x: int) -> int:
            while joined.get(x, x) != x:
                joined[x] = joined.get(joined[x], joined[x])
                x = joined[x]
            return x

        for number, i, fits in _likely_partners(rows, percent / 100, slack):
            if number != at:
                joined, at = {}, number
            for j in fits:
                a, b = find(comp[i]), find(comp[j])
                if a != b:
                    both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    if both * 100 >= (len(sets[i]) + len(sets[j]) - both) * percent:
                        joined[max(a, b)] = min(a, b)
                        found.append((min(node[i], node[j]), max(node[i], node[j])))
        return pd.DataFrame(sorted(set(found)), columns=["a", "b"], dtype="int64")

    return _by_block(answer)


def _blocks(members: DataFrame, sets: DataFrame, comps: DataFrame, block_rows: int) -> DataFrame:
    """Rows of the blocks to compare: in each bucket the members outside its largest component, against all.

    Each bucket's outsiders and members are dealt into chunks of about ``block_rows``; a block is one chunk of either.
    """
    labelled = members.join(comps.select(F.col("node"), F.col("comp").alias("_c")), "node", "left").select("bucket", "node", F.coalesce("_c", "node").alias("comp"))
    sizes = labelled.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("node")).alias("x"), F.sum(F.xxhash64("node").bitwiseAND((1 << 40) - 1)).alias("s"))
    buckets = sizes.groupBy("bucket").agg(F.sum("n").alias("n_all"), F.max(F.struct("n", "comp")).alias("m"), F.count(F.lit(1)).alias("n_comps"), F.bit_xor("x").alias("x"), F.sum("s").alias("s"))
    # the one pair of a bucket of two was proposed before; buckets with the same members are compared once
    buckets = buckets.filter("n_comps > 1 and n_all > 2").groupBy("n_all", "x", "s").agg(F.min("bucket").alias("bucket"), F.first("m").alias("m"))
    buckets = buckets.select("bucket", F.col("m.comp").alias("main"), F.ceil(F.col("n_all") / block_rows).cast("int").alias("ca"), F.ceil((F.col("n_all") - F.col("m.n")) / block_rows).cast("int").alias("co"))
    rows = labelled.join(buckets, "bucket")
    chunk = F.xxhash64("node")
    here = F.pmod(chunk, F.col("ca")).cast("int")
    out = F.when(F.col("comp") != F.col("main"), F.pmod(chunk, F.col("co")).cast("int"))
    # a member stands in the blocks of its own chunk with every chunk of outsiders; an outsider also in those of its chunk of outsiders with every chunk
    every = F.transform(F.sequence(F.lit(0), F.col("co") - 1), lambda i: F.struct(here.alias("i"), i.cast("int").alias("o")))
    asked = F.when(out.isNotNull(), F.transform(F.sequence(F.lit(0), F.col("ca") - 1), lambda i: F.struct(i.cast("int").alias("i"), out.alias("o"))))
    spots = F.explode(F.array_union(every, F.coalesce(asked, F.array().cast("array<struct<i:int,o:int>>"))))
    placed = rows.select("bucket", "node", "comp", here.alias("_i"), out.alias("_o"), spots.alias("s"))
    placed = placed.select(F.xxhash64("bucket", "s.i", "s.o").alias("block"), "node", "comp", (F.col("_i") == F.col("s.i")).alias("inside"), F.coalesce(F.col("_o") == F.col("s.o"), F.lit(False)).alias("outside"))
    return placed.join(sets.select("node", "n", "samples", "sketch"), "node")


def _beside(pairs: DataFrame, sets: DataFrame, columns: list[str], salts: int = 64) -> DataFrame:
    """``pairs`` (a, b) with the given columns of both nodes, suffixed. A node ``a`` of many pairs is repeated over the salts that its pairs have."""
    salted = pairs.withColumn("_salt", F.pmod(F.xxhash64("b"), F.lit(salts)).cast("int"))
    left = sets.select(F.col("node").alias("a"), *[F.col(c).alias(f"{c}_a") for c in columns]).join(salted.select("a", "_salt").distinct(), "a")
    right = sets.select(F.col("node").alias("b"), *[F.col(c).alias(f"{c}_b") for c in columns])
    return salted.join(right, "b").join(left, ["a", "_salt"]).drop("_salt")


def linked_classes(members: DataFrame, sets: DataFrame, percent: int, slack: Slack, block_rows: int) -> DataFrame:
    """Rows ``node, comp`` of every class that is linked with another one: the smallest node of its component.

    ``members`` has the rows of ``shared_buckets``, ``sets`` the ``node, n, samples,
    sketch, shingles`` of all members. Each bucket proposes its members to its
    lead; proposals that pass the sketches are confirmed on full sets. Buckets
    that still hold several components compare the members outside the largest
    one with everybody, in blocks of ``block_rows`` squared. Only links between
    components leave a block, and no pair that shares a bucket is given up.
    """
    similarity = percent / 100

    @F.pandas_udf("boolean")
    def likely(a: pd.Series, b: pd.Series, n1: pd.Series, n2: pd.Series, c1: pd.Series, c2: pd.Series) -> pd.Series:
        n1, n2 = n1.to_numpy(), n2.to_numpy()
        fits = np.minimum(n1, n2) >= similarity * np.maximum(n1, n2)
        sizes = np.minimum(a.map(len).to_numpy(), b.map(len).to_numpy())
        for size in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == size)
            x, y = folded(a.iloc[at].tolist(), size), folded(b.iloc[at].tolist(), size)
            fits[at] &= slack(x, y, n1[at], n2[at], c1.to_numpy()[at], c2.to_numpy()[at]) >= 0
        return pd.Series(fits)

    stars = members.filter("node != lead").select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct()
    stars = _beside(stars, sets, ["n", "samples", "sketch"]).filter(likely("sketch_a", "sketch_b", "n_a", "n_b", "samples_a", "samples_b"))
    both = F.size(F.array_intersect("shingles_a", "shingles_b"))
    checked = _beside(stored(stars.select("a", "b"), "stars"), sets, ["n", "shingles"]).select("a", "b", both.alias("_i"), (F.col("n_a") + F.col("n_b")).alias("_n"))
    comps = components(checked.filter(F.col("_i") * 100 >= (F.col("_n") - F.col("_i")) * percent))
    blocks = _blocks(members, sets, comps, block_rows).repartition("block").sortWithinPartitions("block")
    likely_rows = blocks.select("block", "node", "comp", "inside", "outside", "n", "samples", "sketch").mapInPandas(_participants(similarity, slack), _BLOCK_ROW)
    whole = likely_rows.join(sets.select("node", "shingles"), "node").repartition("block").sortWithinPartitions("block")
    more = whole.mapInPandas(_links(percent, slack), "a long, b long").distinct()
    return components(comps.filter("node != comp").select(F.col("comp").alias("a"), F.col("node").alias("b")).unionByName(more))
