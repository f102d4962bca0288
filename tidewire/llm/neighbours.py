"""Nearest neighbours by inner product: inverted lists scanned with adaptive dimension sampling."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.llm.keys import stored


def usable(vector: Column) -> Column:
    """Not null, not zero, and without null or non-finite components."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & good & F.exists(vector, lambda x: x != 0)


def _rows(column: pd.Series, dtype=np.float32) -> np.ndarray:
    return np.vstack(column.to_numpy()).astype(dtype, copy=False)


def k_means(x: np.ndarray, k: int, rounds: int = 12, seed: int = 6) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        nearest = _nearest(x, centres)
        counts = np.bincount(nearest, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, x)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half = 0.5 * (centres * centres).sum(axis=1)
    return np.concatenate([np.argmax(part @ centres.T - half, axis=1) for part in np.array_split(x, max(1, len(x) // 4096))]) if len(x) else np.zeros(0, int)


class ListIndex:
    """Centres of the lists, a random rotation and the number of lists to probe."""

    def __init__(self, sample: np.ndarray, n_lists: int, neighbours: int, coverage: float, seed: int = 6):
        rng = np.random.default_rng(seed)
        size = sample.shape[1]
        self.rotation = np.linalg.qr(rng.normal(size=(size, size)))[0].astype(np.float32)
        self.centres = k_means(sample, n_lists, seed=seed)
        asked = sample[rng.choice(len(sample), min(300, len(sample)), replace=False)]
        best = np.argsort(-(asked @ sample.T), axis=1)[:, 1 : neighbours + 1]
        order = np.argsort(-(asked @ self.centres.T), axis=1)
        position = np.empty_like(order)
        np.put_along_axis(position, order, np.arange(n_lists)[None, :], axis=1)
        needed = np.sort(np.take_along_axis(position, _nearest(sample, self.centres)[best], axis=1).ravel())
        self.probes = int(needed[int(coverage * (len(needed) - 1))]) + 1 if len(needed) else n_lists


def scan(queries: np.ndarray, vectors: np.ndarray, rotated_queries: np.ndarray, rotated: np.ndarray, floors: np.ndarray, k: int, columns: int = 16, strictness: float = 2.1) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query its row number, the rows of at most ``k`` best vectors with an inner product of ``floors`` or more, and these products.

    Distances grow column block by column block. With d of D rotated dimensions
    seen, D / d times the partial squared distance estimates the whole. A
    candidate is abandoned when the hypothesis that its distance is within the
    threshold is rejected: estimate > threshold * (1 + strictness / sqrt(d))**2.
    The threshold of a candidate follows from the k-th best product known so far, its own length and the query's.
    """
    size = rotated.shape[1]
    lengths, query_lengths = (rotated * rotated).sum(axis=1), (rotated_queries * rotated_queries).sum(axis=1)
    first = min(columns, size)
    head = (rotated_queries[:, :first] ** 2).sum(axis=1)[:, None] + (rotated[:, :first] ** 2).sum(axis=1)[None, :] - 2 * rotated_queries[:, :first] @ rotated[:, :first].T
    for i, q in enumerate(rotated_queries):
        part, alive, floor = head[i], np.arange(len(rotated)), floors[i]
        if len(rotated) > 4 * k:
            # the most promising candidates give a first bound
            near = np.argpartition(part, k - 1)[:k]
            floor = max(floor, float(np.min(rotated[near] @ q)))
        for d in range(first, size, columns):
            bound = np.maximum(query_lengths[i] + lengths[alive] - 2 * floor, 0.0) + 1e-6
            keep = part * (size / d) <= bound * (1 + strictness / math.sqrt(d)) ** 2
            alive, part = alive[keep], part[keep]
            if not len(alive):
                break
            gap = rotated[alive, d : d + columns] - q[d : d + columns]
            part = part + np.einsum("ij,ij->i", gap, gap)
        if not len(alive):
            continue
        rough = 0.5 * (query_lengths[i] + lengths[alive] - part)
        alive = alive[rough >= floor - 1e-4 * (1 + abs(floor))]
        exact = vectors[alive].astype(np.float64) @ queries[i].astype(np.float64)
        keep = exact >= floors[i]
        alive, exact = alive[keep], exact[keep]
        yield i, alive, exact


def nearest_neighbours(
    vectors: DataFrame, queries: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20,
    sample_rows: int = 20_000, coverage: float = 0.985, list_rows: int = 4096, query_rows: int = 1024,
) -> DataFrame:
    """Rows ``query_id, rank, vec_id, score``: for each row that ``queries`` selects, the ``k`` other rows of largest inner product.

    1. Equal vectors are one candidate, a class with its ``k + 1`` smallest ids
       (more can never be among the nearest), so copies neither fill a list nor repeat a search.
    2. Centres, and the number of lists to probe, are fitted on at most
       ``sample_rows`` classes: enough lists that ``coverage`` of the sample's true
       neighbours are in them, and at least ``4 * k`` classes. Every class is indexed.
    3. The first list of each query gives a floor for the k-th score; the others
       are scanned against it. Lists meet queries in blocks of ``list_rows`` by
       ``query_rows``, and each block returns what passes (``scan``).
    4. Scores are inner products of the original vectors in double precision; ties go to the smaller id.

    Rows with a null id, an unusable vector (``usable``) or another length than most rows take no part. With fewer candidates all are
    returned; no rows give no rows. Repeated ids with different vectors are candidates of their own.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<float>").alias("v"), queries.alias("asks")).filter(F.col("id").isNotNull() & usable(F.col("v")))
    rows = rows.select("id", "v", F.coalesce("asks", F.lit(False)).alias("asks"), F.xxhash64(F.lit(1), "v").alias("c1"), F.xxhash64("v", F.lit(2)).alias("c2"))
    most = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if most is None:
        return spark.createDataFrame([], schema)
    rows = rows.filter(F.size("v") == most["n"])
    same = ["c1", "c2"]
    members = rows.select("id", *same).distinct().withColumn("_r", F.row_number().over(Window.partitionBy(*same).orderBy("id"))).filter(F.col("_r") <= k + 1).drop("_r")
    classes = stored(rows.groupBy(*same).agg(F.first("v").alias("v"), F.min("id").alias("least"), F.max("asks").alias("asks")), "classes")
    total = classes.count()
    sample = _rows(classes.select("v").orderBy(F.xxhash64("c1"), "c2").limit(sample_rows).toPandas()["v"])
    index = ListIndex(sample, max(1, min(4096, len(sample) // 8, round(math.sqrt(total) / 2))), k, coverage)
    shared = spark.sparkContext.broadcast((index.centres, index.rotation))

    @F.pandas_udf("int")
    def home(v: pd.Series) -> pd.Series:
        return pd.Series(_nearest(_rows(v), shared.value[0]).astype("int32"))

    placed = stored(classes.withColumn("list", home("v")), "lists")
    sizes = np.zeros(len(index.centres), dtype=np.int64)
    for r in placed.groupBy("list").count().collect():
        sizes[r["list"]] = r["count"]
    probes, enough = index.probes, 4 * k
    chunks = np.maximum(1, -(-sizes // list_rows))

    @F.pandas_udf("array<int>")
    def lists(v: pd.Series) -> pd.Series:
        order = np.argsort(-(_rows(v) @ shared.value[0].T), axis=1)
        need = np.maximum(probes, (np.cumsum(sizes[order], axis=1) < enough).sum(axis=1) + 1)
        return pd.Series([o[:n].astype("int32") for o, n in zip(order, need, strict=True)], dtype=object)

    asking = stored(placed.filter("asks").select(F.col("c1").alias("q1"), F.col("c2").alias("q2"), F.col("v").alias("qv"), lists("v").alias("lists")), "asking")
    list_chunks = F.array(*[F.lit(int(c)) for c in chunks]) if len(chunks) < 64 else F.from_json(F.lit(str([int(c) for c in chunks])), "array<int>")

    def probe(wanted: DataFrame) -> DataFrame:
        """Scan the lists of ``wanted`` (q1, q2, qv, floor, list)."""
        blocks = wanted.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / query_rows).cast("int").alias("n_q"))
        asked = wanted.withColumn("cb", F.explode(F.sequence(F.lit(0), F.element_at(list_chunks, F.col("list") + 1) - 1)))
        asked = asked.join(blocks, "list").withColumn("qb", F.pmod(F.xxhash64("q1"), "n_q").cast("int")).drop("n_q")
        held = placed.select("c1", "c2", "v", "least", "list").join(blocks, "list").withColumn("cb", F.pmod(F.xxhash64("c2"), F.element_at(list_chunks, F.col("list") + 1)).cast("int"))
        held = held.withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("n_q") - 1))).drop("n_q")

        def meet(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
            out = []
            if len(a) and len(b):
                rotation = shared.value[1]
                qs, xs = _rows(a["qv"]), _rows(b["v"])
                least, c1, c2 = b["least"].to_numpy(), b["c1"].to_numpy(), b["c2"].to_numpy()
                q1, q2 = a["q1"].to_numpy(), a["q2"].to_numpy()
                for i, alive, exact in scan(qs, xs, qs @ rotation, xs @ rotation, a["floor"].to_numpy(), k + 1):
                    top = np.lexsort((least[alive], -exact))[: k + 1]
                    picked = alive[top]
                    out.append(pd.DataFrame({"q1": q1[i], "q2": q2[i], "c1": c1[picked], "c2": c2[picked], "least": least[picked], "score": exact[top]}))
            return pd.concat(out) if out else pd.DataFrame({"q1": [], "q2": [], "c1": [], "c2": [], "least": [], "score": []})

        key = ["list", "cb", "qb"]
        return asked.groupBy(*key).cogroup(held.groupBy(*key)).applyInPandas(meet, "q1 long, q2 long, c1 long, c2 long, least long, score double")

    start = asking.select("q1", "q2", "qv", F.lit(float("-inf")).alias("floor"), F.col("lists")[0].alias("list"))
    first = stored(probe(start), "first")
    order = Window.partitionBy("q1", "q2").orderBy(F.desc("score"), "least")
    ranked = first.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") == k + 1).select("q1", "q2", F.col("score").alias("_floor"))
    rest = asking.join(ranked, ["q1", "q2"], "left").select("q1", "q2", "qv", F.coalesce("_floor", F.lit(float("-inf"))).alias("floor"), F.explode(F.slice("lists", 2, len(sizes))).alias("list"))
    found = first.unionByName(probe(rest)).withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= k + 1)
    listed = found.join(members, same).select("q1", "q2", F.struct((-F.col("score")).alias("s"), F.col("id").alias("id")).alias("x"))
    tops = listed.groupBy("q1", "q2").agg(F.slice(F.array_sort(F.collect_list("x")), 1, k + 1).alias("xs"))
    ids = rows.filter("asks").select(F.col("id").alias("query_id"), F.col("c1").alias("q1"), F.col("c2").alias("q2")).distinct()
    near = ids.join(tops, ["q1", "q2"]).select("query_id", F.posexplode(F.slice(F.filter("xs", lambda x: x["id"] != F.col("query_id")), 1, k)).alias("_p", "_x"))
    return near.select("query_id", (F.col("_p") + 1).cast("int").alias("rank"), F.col("_x.id").alias("vec_id"), (-F.col("_x.s")).alias("score"))
