"""A quality classifier from pairwise preferences.

Bradley-Terry: the chance that one document is preferred to another is the logistic function of the difference of their
scores, which are linear in text features. Weights are learnt from pairs of a preferred and a rejected document by the
logistic loss on feature differences. A quantile of the scores of the documents learnt from is the threshold.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import id_and_text, map_slices
from .shingling import word_hashes

SPACE, LOWER, UPPER, DIGIT, STOP, MARK, SYMBOL, OTHER = range(8)
FEATURES = (
    "lower_share", "upper_share", "digit_share", "stop_share", "mark_share", "symbol_share", "space_share", "mean_word",
    "distinct_words", "distinct_lines", "words_a_line", "log_words", "no_words",
)


def _kinds() -> np.ndarray:
    """The class of each code point below U+3000; those above count as OTHER."""
    by_category = {"Ll": LOWER, "Lu": UPPER, "Lt": UPPER, "Lo": LOWER, "Nd": DIGIT, "Zs": SPACE, "Cc": SPACE}
    kinds = np.array([by_category.get(unicodedata.category(chr(c)), SYMBOL) for c in range(0x3000)] + [OTHER], np.uint8)
    kinds[[ord(c) for c in ".,;:'\"()-?"]] = STOP
    kinds[ord("!")] = MARK
    return kinds


_KINDS = _kinds()


def features(texts: list[str | None]) -> np.ndarray:
    """A row of FEATURES for each text; all of a text without words but ``no_words`` are 0."""
    out = np.zeros((len(texts), len(FEATURES)))
    hashes, first = word_hashes(texts, lower=True)
    for i, text in enumerate(texts):
        n = first[i + 1] - first[i]
        if not n:
            out[i, -1] = 1.0
            continue
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        share = np.bincount(_KINDS[np.minimum(points, 0x3000)], minlength=8) / len(points)
        lines = text.split("\n")
        words = hashes[first[i] : first[i + 1]]
        out[i] = (
            share[LOWER], share[UPPER], share[DIGIT], share[STOP], share[MARK], share[SYMBOL], share[SPACE], (1 - share[SPACE]) * len(points) / n / 10,
            len(np.unique(words)) / n, len(set(lines)) / len(lines), np.log1p(n / len(lines)) / 5, np.log1p(n) / 10, 0.0,
        )
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


@dataclass(frozen=True)
class RankingModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def score(self, texts: list[str | None]) -> np.ndarray:
        """0 to 1; 0.5 where a document is as good as one at the threshold."""
        # Summed row by row, so that equal texts score equally wherever they stand.
        return sigmoid(((features(texts) - self.mean) / self.scale * self.weights).sum(axis=1) - self.threshold)


def fit_ranking(sample: list[tuple[int, str, int]], **options) -> RankingModel:
    """``fit_features`` of a labelled sample of (id, text, label)."""
    found = np.vstack([features([t for _, t, _ in sample[k : k + 256]]) for k in range(0, len(sample), 256)] or [np.zeros((0, len(FEATURES)))])
    return fit_features(found, np.array([y for _, _, y in sample], int), **options)


def fit_ranking_rows(sample: DataFrame, **options) -> RankingModel:
    """``fit_features`` of a bounded DataFrame of (doc_id, text, label); only the features come to the driver, in order of id."""
    rows = sample.select(F.col("doc_id").alias("id"), "text", F.struct("label").alias("row"))

    def kernel(cols: dict[str, list]) -> dict[str, list]:
        return {"id": cols["id"], "own": features(cols["text"]).tolist()}

    found = sorted((r["id"], r["own"], r["row"]["label"]) for r in map_slices(rows, kernel, "id long, own array<double>").toLocalIterator())
    return fit_features(np.array([f for _, f, _ in found]).reshape(-1, len(FEATURES)), np.array([y for _, _, y in found], int), **options)


def pairs_of(few: np.ndarray, many: np.ndarray, most_pairs: int) -> tuple[np.ndarray, np.ndarray]:
    """Partners for each of ``few``: all of ``many`` if ``most_pairs`` allows, else equally often such as stand far apart in it."""
    each = max(1, min(len(many), most_pairs // len(few)))
    a = np.repeat(few[:most_pairs], each)[:most_pairs]
    step = next(p for p in (7919, 7907) if len(many) % p)  # coprime to the number, so that all take turns
    return a, many[(np.arange(len(a)) * step) % len(many)] if each < len(many) else np.tile(many, len(few))[: len(a)]


def fit_features(found: np.ndarray, label: np.ndarray, *, most_pairs: int = 20000, penalty: float = 1e-3, steps: int = 30) -> RankingModel:
    """Learn from a labelled sample's features: each pair prefers a document of label 1 to one of label 0.

    Every document of the rarer label meets as many of the other as ``most_pairs`` allows, in the sample's order. With one
    label only, nothing separates documents: weights are 0 and all score above 0.5 (label 1) or below (label 0). Newton steps.
    """
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not len(good) or not len(bad):
        side = -1.0 if len(good) >= len(bad) else 1.0
        return RankingModel(np.zeros(len(FEATURES)), np.ones(len(FEATURES)), np.zeros(len(FEATURES)), side)
    mean, scale = found.mean(axis=0), np.maximum(found.std(axis=0), 1e-3)
    z = (found - mean) / scale
    few, many = sorted((good, bad), key=len)
    a, b = pairs_of(few, many, most_pairs)
    gap = z[a] - z[b] if few is good else z[b] - z[a]
    w = np.zeros(z.shape[1])
    for _ in range(steps):
        p = sigmoid(gap @ w)
        slope = gap.T @ (p - 1) / len(gap) + penalty * w
        curve = (gap * (p * (1 - p))[:, None]).T @ gap / len(gap) + penalty * np.eye(len(w))
        w = w - np.linalg.solve(curve, slope)
    return RankingModel(mean, scale, w, float(np.quantile(z @ w, len(bad) / len(label), method="midpoint")))


def rank_quality(docs: DataFrame, model: RankingModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of every whole text.

    Null and empty texts get the score of a text without words. Repeated rows give repeated results; other columns are not
    read. Equal texts get equal scores. The model, of fixed size, is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def kernel(cols: dict[str, list]) -> dict[str, list]:
        return {"doc_id": cols["id"], "score": shared.value.score(cols["text"])}

    return map_slices(id_and_text(docs, id_col, text_col), kernel, "doc_id long, score double")
