"""Quality scores: random Fourier features of text statistics, ridge regression and isotonic calibration."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.bits import bits_set, shared_bits
from tidewire.llm.keys import held_out, stored

#: Byte classes whose shares of the text are statistics.
_CLASSES = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", " ", "\n", "!", "?", ".", ",", "|", "#$%&*@^~=+_\\", "<>{}[]()", "/:;\"'`-")
_TABLE = np.zeros((256, len(_CLASSES) + 1))
for _k, _chars in enumerate(_CLASSES):
    for _c in _chars:
        _TABLE[ord(_c), _k] = 1
_TABLE[128:, -1] = 1
N_STATISTICS = len(_CLASSES) + 1 + 10


def statistics(text: str | None) -> np.ndarray:
    """Shares of character classes, and lengths and repetition of words and lines; an empty text has zeros."""
    if not text:
        return np.zeros(N_STATISTICS)
    raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    shares = np.bincount(raw, minlength=256) @ _TABLE / len(raw)
    words, rows = text.split(), [x for x in text.split("\n") if x]
    n, counts = max(1, len(words)), Counter(words)
    top = counts.most_common(1)[0][1] if counts else 0
    lines = Counter(rows)
    return np.concatenate([np.sqrt(shares), [
        np.log1p(len(raw)), np.log1p(len(words)), len(raw) / n / 10, len(counts) / n, top / n,
        sum(map(str.isupper, words)) / n, sum(map(str.isalpha, words)) / n, sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
        len(lines) / max(1, len(rows)), np.log1p(len(raw) / max(1, len(rows))),
    ]])


class QualityModel:
    """Standardise, map to cosines, weigh, calibrate."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, frequencies: np.ndarray, phases: np.ndarray, weights: np.ndarray, knots: np.ndarray, values: np.ndarray):
        self.mean, self.scale, self.frequencies, self.phases = mean, scale, frequencies, phases
        self.weights, self.knots, self.values = weights, knots, values

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        waves = np.cos(z @ self.frequencies + self.phases) * np.sqrt(2 / len(self.phases))
        return np.hstack([waves, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.knots, self.values), 0.0, 1.0)


def isotonic(x: np.ndarray, good: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over points in ascending ``x``: the ends and mean of each pooled block, for linear interpolation between blocks."""
    blocks: list[list[float]] = []
    for a, g, n in zip(x, good, total, strict=True):
        blocks.append([a, a, g, n])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][3] >= blocks[-1][2] * blocks[-2][3]:
            _, end, g1, n1 = blocks.pop()
            blocks[-1][1:] = [end, blocks[-1][2] + g1, blocks[-1][3] + n1]
    knots = [k for b in blocks for k in ((b[0], b[1]) if b[1] > b[0] else (b[0],))]
    values = [b[2] / b[3] for b in blocks for _ in range(2 if b[1] > b[0] else 1)]
    return np.array(knots), np.array(values)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.vstack(column.to_numpy()) if len(column) else np.zeros((0, N_STATISTICS))


def _statistics_of(wanted) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Statistics of the texts whose slot is set in the broadcast bitmap, a few hundred at a time."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = np.frombuffer(wanted.value, dtype=np.uint8)
        for batch in batches:
            chosen = batch[bits_set(bits, batch["_slot"].to_numpy())]
            for start in range(0, len(chosen), 512):
                part = chosen.iloc[start : start + 512]
                yield pd.DataFrame({"_id": part["_id"], "_tag": part["_tag"], "_x": [statistics(t) for t in part["_text"]]})

    return read


def _labelled_statistics(docs: DataFrame, known: DataFrame, id_col: str, text_col: str, bits: int = 26) -> DataFrame:
    """``_last, _x, _y`` of one text of each labelled id: of several texts the one of smallest hash.

    A bitmap of fixed size tells most labelled texts from the others before they
    are read; the join with the labels, in which vectors but no texts are shuffled, is exact.
    """
    key = F.col(id_col).cast("string")
    slot = F.pmod(F.xxhash64(key), F.lit(1 << bits)).alias("_slot")
    wanted = shared_bits(known.select(slot), "_slot", bits)
    texts = docs.filter(F.col(id_col).isNotNull() & ~held_out(id_col)).select(key.alias("_id"), slot, F.xxhash64(text_col).alias("_tag"), F.col(text_col).alias("_text"))
    vectors = texts.mapInPandas(_statistics_of(wanted), "_id string, _tag long, _x array<double>")
    rows = vectors.join(known.select(key.alias("_id"), "_y"), "_id").groupBy("_id").agg(F.min_by("_x", "_tag").alias("_x"), F.first("_y").alias("_y"))
    rows = stored(rows.select((F.crc32(F.col("_id").cast("binary")) % 5 == 4).alias("_last"), "_x", "_y"), "statistics")
    wanted.destroy()
    return rows


def _summed(parts: DataFrame) -> np.ndarray:
    """The partitions' arrays ``i, row`` added up, as rows of a matrix."""

    def add(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"i": [key[0]], "row": [np.sum(np.vstack(rows["row"].to_numpy()), axis=0)]})

    return np.array([r["row"] for r in sorted(parts.groupBy("i").applyInPandas(add, "i int, row array<double>").collect(), key=lambda r: r["i"])])


def _moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Count, sums and sums of squares of a partition."""
    total = np.zeros((3, N_STATISTICS))
    for batch in batches:
        x = _matrix(batch["_x"])
        total += np.vstack([np.full(N_STATISTICS, len(x)), x.sum(axis=0), (x * x).sum(axis=0)])
    yield pd.DataFrame({"i": range(3), "row": list(total)})


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    n_features: int = 160, width: float = 4.0, ridge: float = 1e-3, bins: int = 512, seed: int = 10,
) -> QualityModel:
    """Learn from every labelled row that is not held out.

    Of the four folds of such rows, three fit the ridge scores and one the
    calibration. Only labelled texts are read, and none is shuffled. Each
    partition sums its own moments and normal equations, ``n_features + 1`` rows of
    that many numbers, which are added up row by row; the driver solves one
    system of that size. Repeated labels of an id count once, as good if any is, and
    repeated documents of an id as the one whose text has the smallest hash. Without labels every score is 0.5.
    """
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col)).groupBy(id_col).agg(F.max(label_col).cast("double").alias("_y"))
    rows = _labelled_statistics(docs, known, id_col, text_col)
    training = rows.filter("not _last")
    moments = _summed(training.select("_x").mapInPandas(_moments, "i int, row array<double>"))
    count = moments[0, 0] if len(moments) else 0.0
    rng = np.random.default_rng(seed)
    frequencies, phases = rng.normal(size=(N_STATISTICS, n_features)) / width, rng.uniform(0, 2 * np.pi, n_features)
    if not count:
        nothing = np.zeros(N_STATISTICS)
        return QualityModel(nothing, nothing + 1, frequencies, phases, np.zeros(n_features + 1), np.array([0.0]), np.array([0.5]))
    mean = moments[1] / count
    scale = np.sqrt(np.maximum(moments[2] / count - mean * mean, 0.0))
    model = QualityModel(mean, np.where(scale > 1e-9, scale, 1.0), frequencies, phases, np.zeros(n_features + 1), np.array([0.0, 1.0]), np.array([0.0, 1.0]))

    def normal_equations(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((n_features + 1, n_features + 2))
        for batch in batches:
            a = model.features(_matrix(batch["_x"]))
            total += a.T @ np.column_stack([a, batch["_y"].to_numpy()])
        yield pd.DataFrame({"i": range(len(total)), "row": list(total)})

    system = _summed(training.select("_x", "_y").mapInPandas(normal_equations, "i int, row array<double>"))
    penalty = np.eye(n_features + 1) * ridge * count
    penalty[-1, -1] = 0.0
    model.weights = np.linalg.lstsq(system[:, :-1] + penalty, system[:, -1], rcond=None)[0]

    @F.pandas_udf("int")
    def bucket(x: pd.Series) -> pd.Series:
        return pd.Series(np.clip((model.raw(_matrix(x)) + 0.5) / 2 * bins, 0, bins - 1).astype("int32"))

    counts = rows.filter("_last").select(bucket(F.col("_x")).alias("b"), "_y").groupBy("b").agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("g")).collect()
    if counts:
        counts.sort(key=lambda r: r["b"])
        model.knots, model.values = isotonic(np.array([(r["b"] + 0.5) / bins * 2 - 0.5 for r in counts]), np.array([r["g"] for r in counts]), np.array([r["n"] for r in counts]))
    return model


def scored(docs: DataFrame, model: QualityModel, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the calibrated quality of each whole text; null and empty texts are scored by their zero statistics. An existing column ``name`` is replaced."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        out = [model.score(np.vstack([statistics(t) for t in texts[start : start + 512]])) for start in range(0, len(texts), 512)]
        return pd.Series(np.concatenate(out) if out else [], dtype="float64")

    return docs.withColumn(name, score(F.col(text_col)))


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", name: str = "score", **options) -> DataFrame:
    """Fit on the labels and score every row of ``docs``."""
    return scored(docs, fit(docs, labels, id_col, text_col, label_col, **options), text_col, name)
