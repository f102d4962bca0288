"""Toxicity by non-negative positive-unlabelled learning."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.keys import held_out

BITS = 18
_EDGES = ".,;:!?\"'()[]{}<>|*#%&$-–—“”«»…"


def word_features(word: str, bits: int = BITS) -> tuple[int, ...]:
    """Hashed whole word and its first four and five letters; endings vary in inflected languages."""
    word, mask = word.strip(_EDGES), (1 << bits) - 1
    if not word:
        return ()
    found = [zlib.crc32(b"w" + word.encode("utf-8", "replace")) & mask]
    found += [zlib.crc32(b"p%d" % n + word[:n].encode("utf-8", "replace")) & mask for n in (4, 5) if len(word) > n]
    return tuple(found)


def _tokens(text: str | None) -> set[str]:
    return set(text.lower().split()) if text else set()


def text_features(text: str | None, bits: int = BITS) -> np.ndarray:
    """Distinct feature numbers of a text."""
    found: set[int] = set()
    for word in _tokens(text):
        found.update(word_features(word, bits))
    return np.fromiter(sorted(found), dtype=np.int32, count=len(found))


def _log_loss(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, -z)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * z))


class PuModel:
    """Linear model over the known hashed features of a text; n of them count 1 / sqrt(n + 1) each, so neither length nor repetition decides."""

    def __init__(self, weights: np.ndarray, bias: float, bits: int = BITS):
        self.weights, self.bias, self.bits = weights, bias, bits

    def score(self, features: np.ndarray) -> float:
        found = self.weights[features]
        z = self.bias + float(found.sum()) / math.sqrt(np.count_nonzero(found) + 1)
        return float(_sigmoid(np.float64(z)))


def fit_nnpu(
    positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, bits: int = BITS, min_docs: int = 4, min_z: float = 4.0,
    epochs: int = 250, batch: int = 20_000, rate: float = 0.1, decay: float = 1e-5, seed: int = 1,
) -> PuModel:
    """Minimise prior * R+(P) + max(0, R-(U) - prior * R-(P)) with the logistic loss.

    When a batch's corrected negative risk falls below 0, the step goes up that
    risk's gradient instead, which keeps flexible models from fitting the
    unlabelled positives as negatives. Only features of at least ``min_docs``
    texts that confirmed texts hold more often, by at least ``min_z``
    standard errors, are known to the model. Without positives or unlabelled texts the score is the prior everywhere.
    """
    size = 1 << bits
    prior = min(max(prior, 1e-4), 1 - 1e-4)
    weights, bias = np.zeros(size), math.log(prior / (1 - prior))
    if not positive or not unlabelled:
        return PuModel(weights, bias, bits)
    seen = np.zeros((2, size))
    for k, fs in enumerate((positive, unlabelled)):
        for f in fs:
            seen[k, f] += 1
    n = np.array([[len(positive)], [len(unlabelled)]])
    share = seen.sum(axis=0) / n.sum()
    error = np.sqrt(share * (1 - share) * (1 / n).sum()) + 1e-12
    known = (seen.sum(axis=0) >= min_docs) & (seen[0] / n[0] - seen[1] / n[1] >= min_z * error)
    sets = []
    for fs in (positive, unlabelled):
        kept = [f[known[f]] for f in fs]
        sets.append((kept, np.array([1 / math.sqrt(len(f) + 1) for f in kept])))
    rng = np.random.default_rng(seed)
    m, v, mb, vb, step = np.zeros(size), np.zeros(size), 0.0, 0.0, 0
    n_steps = max(1, -(-len(unlabelled) // batch))

    def take(which: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        fs, norm = sets[which]
        picked = [fs[i] for i in rows]
        lengths = np.array([len(p) for p in picked])
        return np.concatenate(picked) if picked else np.zeros(0, np.int32), np.repeat(np.arange(len(rows)), lengths), norm[rows]

    for _ in range(epochs):
        orders = [rng.permutation(len(s[0])) for s in sets]
        for k in range(n_steps):
            rows = [o[k::n_steps] for o in orders]
            if not len(rows[0]) or not len(rows[1]):
                continue
            parts = [take(w, r) for w, r in enumerate(rows)]
            zs = [bias + norm * np.bincount(owner, weights=weights[f], minlength=len(norm)) for f, owner, norm in parts]
            negative = _log_loss(-zs[1]).mean() - prior * _log_loss(-zs[0]).mean()
            n_p, n_u = len(zs[0]), len(zs[1])
            if negative >= 0:
                slopes = [(-prior * _sigmoid(-zs[0]) - prior * _sigmoid(zs[0])) / n_p, _sigmoid(zs[1]) / n_u]
            else:
                slopes = [prior * _sigmoid(zs[0]) / n_p, -_sigmoid(zs[1]) / n_u]
            grad = decay * weights
            for (f, owner, norm), slope in zip(parts, slopes, strict=True):
                grad += np.bincount(f, weights=(slope * norm)[owner], minlength=size)
            grad_b = float(slopes[0].sum() + slopes[1].sum())
            step += 1
            m = 0.9 * m + 0.1 * grad
            v = 0.999 * v + 0.001 * grad * grad
            mb, vb = 0.9 * mb + 0.1 * grad_b, 0.999 * vb + 0.001 * grad_b**2
            fix_m, fix_v = 1 - 0.9**step, 1 - 0.999**step
            weights -= rate * (m / fix_m) / (np.sqrt(v / fix_v) + 1e-8)
            bias -= rate * (mb / fix_m) / (math.sqrt(vb / fix_v) + 1e-8)
    return PuModel(weights, bias, bits)


def most_positives(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, folds: int = 3, errors: float = 1.5, **options) -> float:
    """An upper bound of the share of positives among the unlabelled texts, from the scores of held-back ones.

    Each fold is scored by a model of the others. Above any score, unlabelled
    texts are at least as frequent as the class prior times the share of
    confirmed ones there, so the smallest ratio of the two shares bounds the
    prior. ``errors`` standard errors on either side keep rare scores from deciding.
    """
    scores: list[list[float]] = [[], []]
    for k in range(folds):
        model = fit_nnpu([f for i, f in enumerate(positive) if i % folds != k], [f for i, f in enumerate(unlabelled) if i % folds != k], prior, **options)
        for which, sample in enumerate((positive, unlabelled)):
            scores[which] += [model.score(f) for f in sample[k::folds]]
    confirmed, others = (np.sort(np.array(x))[::-1] for x in scores)
    levels = np.unique(confirmed)
    p = np.searchsorted(-confirmed, -levels, side="right") / len(confirmed)
    u = np.searchsorted(-others, -levels, side="right") / len(others)
    above = u + errors * np.sqrt(u * (1 - u) / len(others))
    below = p - errors * np.sqrt(p * (1 - p) / len(confirmed))
    ratios = above[below > 0] / below[below > 0]
    return float(min(ratios.min(), 1.0)) if len(ratios) else prior


def class_prior(positive: list[np.ndarray], unlabelled: list[np.ndarray], share: float, least: int = 30, **options) -> float:
    """The share of toxic labels where the texts bear it out, else what they say.

    Labels are often gathered where toxic text is frequent, or rare. The bound is
    taken twice, the second time from models with the first bound as prior; it
    exceeds the truth by its error margin, so shares from 0.8 times the bound on
    are believed and others moved there. With fewer than ``least`` texts of either kind the share is all there is.
    """
    if min(len(positive), len(unlabelled)) < least:
        return share
    bound = most_positives(positive, unlabelled, most_positives(positive, unlabelled, share, **options), **options)
    return min(max(share, 0.8 * bound), bound)


def _sampled_features(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> list[np.ndarray]:
    """Feature numbers of one text per id, in the order of the ids; of several texts the one of smallest hash."""
    @F.pandas_udf("binary")
    def features(texts: pd.Series) -> pd.Series:
        return pd.Series([text_features(t).tobytes() for t in texts], dtype=object)

    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text")).join(F.broadcast(ids.select(F.col(id_col).alias("_id"))), "_id", "left_semi")
    one = texts.groupBy("_id").agg(F.min_by("_text", F.struct(F.xxhash64("_text"), F.length("_text"))).alias("_text"))
    rows = one.select("_id", features("_text").alias("f")).collect()
    return [np.frombuffer(r["f"], dtype=np.int32) for r in sorted(rows, key=lambda r: str(r["_id"]))]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", n_positive: int = 2000, n_unlabelled: int = 8000, prior: float | None = None) -> PuModel:
    """Learn from confirmed toxic rows and unlabelled text, never from a row that is held out.

    The fit uses a bounded sample, the first ``n_positive`` and ``n_unlabelled``
    ids by a hash of the id, one text each; only their feature numbers reach the driver. The
    class prior, unless given, is the share of toxic labels as far as the sample
    bears it out (``class_prior``). Negative labels serve for nothing else. Repeated labels of an id count once, as toxic if any is.
    """
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col)).groupBy(id_col).agg(F.max(label_col).alias("_label"))
    order = F.xxhash64(F.lit(5), F.col(id_col))
    toxic = known.filter("_label > 0").select(id_col).orderBy(order, id_col).limit(n_positive)
    some = docs.filter(F.col(id_col).isNotNull() & ~held_out(id_col)).select(id_col).distinct().orderBy(order, id_col).limit(n_unlabelled)
    positive, unlabelled = _sampled_features(docs, toxic, id_col, text_col), _sampled_features(docs, some, id_col, text_col)
    if prior is None:
        prior = class_prior(positive, unlabelled, known.agg(F.avg((F.col("_label") > 0).cast("double"))).first()[0] or 0.0, epochs=120)
    return fit_nnpu(positive, unlabelled, prior)


def scored(docs: DataFrame, model: PuModel, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the probability that each whole text is toxic.

    The model is broadcast (a vector of fixed size). Null and empty texts score by the bias alone. An existing column ``name`` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.bias, model.bits))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights, bias, bits = shared.value
        model, cache = PuModel(weights, bias, bits), {}
        for texts in batches:
            out = []
            for text in texts:
                found: set[int] = set()
                for word in _tokens(text):
                    features = cache.get(word)
                    if features is None:
                        features = word_features(word, bits)
                        if len(word) <= 64:
                            if len(cache) >= 100_000:
                                cache.clear()
                            cache[word] = features
                    found.update(features)
                out.append(model.score(np.fromiter(found, dtype=np.int32, count=len(found))))
            yield pd.Series(out, dtype="float64")

    return docs.withColumn(name, score(F.col(text_col)))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", name: str = "score", **options) -> DataFrame:
    """Fit on the labels and score every row of ``docs``; empty tables give empty results or, without toxic labels, the prior."""
    return scored(docs, fit(docs, labels, id_col, text_col, label_col, **options), text_col, name)
