"""Text quality by learning from trusted positives and unlabelled text.

Positives are documents labelled good; the unlabelled ones are documents as they come, good and bad. With the share of
good documents (the class prior) the risk of a classifier can be estimated without any labelled bad document: the
risk of calling unlabelled text good, less the part of it due to good documents. That difference cannot be negative, so
it counts as zero when its estimate is (non-negative risk); otherwise a flexible model would overfit. The loss is the sigmoid, which is
bounded: an error of the prior then moves the scores of few documents only.

The prior is estimated first: a classifier of positives against unlabelled text orders the documents, and among the
best ones, where bad documents are absent, the unlabelled share per positive share is the prior.

Features are shares and averages of a whole text, computed on the executors. The model is fitted on the driver from at most
about ``TRAIN_ROWS`` documents of either kind.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ctrprep.llm.frames import schema_with
from ctrprep.llm.training import class_samples, even_share, held_out
from ctrprep.llm.wordhash import WordBlock, WordHasher, is_space

TRAIN_ROWS = 8000
HIDDEN, STEPS, RATE, SEED = 16, 800, 0.02, 11
#: The prior is read off where this share of the positives remains.
LEAST_POSITIVES, MOST_POSITIVES = 0.3, 0.9
FEATURES = 14

_BYTE = np.arange(256)
_UPPER = (_BYTE >= ord("A")) & (_BYTE <= ord("Z"))
_LOWER = (_BYTE >= ord("a")) & (_BYTE <= ord("z"))
_DIGIT = (_BYTE >= ord("0")) & (_BYTE <= ord("9"))
_HIGH = _BYTE >= 128
_PROSE = np.isin(_BYTE, list(b".,;:?'\"-()"))
_MARK = (_BYTE > 32) & (_BYTE < 127) & ~(_UPPER | _LOWER | _DIGIT | _PROSE)


def features(block: WordBlock) -> np.ndarray:
    """One row of ``FEATURES`` numbers for each text of the block; a text without words has zeros."""
    n, at, data = block.last - block.first, block.at, block.data
    words = np.diff(at)
    per_word = 1 / np.maximum(words, 1)
    sizes = np.diff(block.offsets) - 1
    per_byte = 1 / np.maximum(sizes, 1)

    def of_bytes(kind: np.ndarray) -> np.ndarray:
        return np.diff(np.append(0, np.cumsum(kind[data]))[block.offsets]) * per_byte

    def of_words(flags: np.ndarray) -> np.ndarray:
        return np.diff(np.append(0, np.cumsum(flags))[at]) * per_word

    w, length = block.words, block.end - block.start
    first, last = data[block.start], data[block.end - 1]
    inner = np.append(0, np.cumsum(_UPPER[data]))
    upper = inner[block.end] - inner[block.start]
    row = np.repeat(np.arange(n), words)
    again = np.zeros(len(w), bool)
    again[1:] = (w[1:] == w[:-1]) & (row[1:] == row[:-1])
    order = np.lexsort((w, row))
    known = np.zeros(len(w), bool)
    known[order[1:]] = (w[order[1:]] == w[order[:-1]]) & (row[order[1:]] == row[order[:-1]])
    columns = [
        of_bytes(_UPPER),
        of_bytes(_DIGIT),
        of_bytes(_HIGH),
        of_bytes(_PROSE),
        of_bytes(_MARK),
        of_words(again),
        of_words(known) * np.minimum(words / 300, 1),
        of_words((length == 1) & _MARK[first]),
        of_words((length > 1) & _MARK[last]),
        of_words((length > 1) & (upper * 2 > length)),
        of_words(length) / 10,
        np.sqrt(np.maximum(of_words(length**2) - of_words(length) ** 2, 0)) / 10,
        np.log1p(words) / 10,
        np.diff(np.append(0, np.cumsum(data == 10))[block.offsets]) * per_word - per_word,
    ]
    out = np.column_stack(columns)
    return np.where(words[:, None] > 0, np.sign(out) * np.sqrt(np.abs(out)), 0.0)


@dataclass(frozen=True)
class QualityModel:
    """A network with one hidden layer on standardised features, and the estimated class prior."""

    centre: np.ndarray
    scale: np.ndarray
    layers: tuple[np.ndarray, np.ndarray, np.ndarray, float]
    prior: float

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-_forward((x - self.centre) / self.scale, self.layers)[1]))


def _forward(x: np.ndarray, layers) -> tuple[np.ndarray, np.ndarray]:
    inside = np.tanh(x @ layers[0] + layers[1])
    return inside, np.clip(inside @ layers[2] + layers[3], -30, 30)


def _slopes(x: np.ndarray, inside: np.ndarray, out_slope: np.ndarray, layers) -> list:
    back = (out_slope[:, None] * layers[2]) * (1 - inside**2)
    return [x.T @ back, back.sum(0), inside.T @ out_slope, out_slope.sum()]


def _fit(x: np.ndarray, positive: np.ndarray, weight: np.ndarray, prior: float | None, target: np.ndarray | None = None) -> tuple:
    """Minimise the non-negative risk; without a prior, the plain risk of telling positives from the rest."""
    rng = np.random.default_rng(SEED)
    layers = [rng.normal(0, 0.3, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.3, HIDDEN), 0.0]
    first, second = [np.zeros_like(v) for v in layers], [np.zeros_like(v) for v in layers]
    share_p = np.where(positive, weight, 0) / weight[positive].sum()
    share_u = np.where(positive, 0, weight) / weight[~positive].sum()
    for step in range(1, STEPS + 1):
        inside, z = _forward(x, layers)
        chance = 1 / (1 + np.exp(-z))
        if prior is None:
            slope = share_p * (chance - 1) + share_u * chance
        else:
            steep = chance * (1 - chance)
            of_rest = share_u - prior * share_p
            slope = -prior * share_p * steep
            if (of_rest * chance).sum() > 0:
                slope = slope + of_rest * steep
        for k, g in enumerate(_slopes(x, inside, slope, layers)):
            g = g + 1e-4 * layers[k]
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            layers[k] = layers[k] - RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return tuple(layers)


def estimated_prior(z_positive: np.ndarray, z_unlabelled: np.ndarray) -> float:
    """The share of unlabelled documents per share of positives among the best ones, as the median over several cuts.

    The scores have to come from a classifier that was fitted to other documents. Two standard errors are taken off: a prior
    that is too high lets bad documents pass as good, one that is a little low costs nothing of note.
    """
    if not len(z_positive) or not len(z_unlabelled):
        return 0.5
    cuts = np.quantile(z_positive, np.linspace(1 - MOST_POSITIVES, 1 - LEAST_POSITIVES, 50))
    ratios = [(z_unlabelled >= c).mean() / max((z_positive >= c).mean(), 1e-9) for c in cuts]
    middle = np.median(ratios)
    error = np.sqrt(middle / (len(z_unlabelled) * 0.6) + middle**2 / (len(z_positive) * 0.6))
    return float(np.clip(middle - 2 * error, 0.02, 0.98))


def fit_model(x: np.ndarray, positive: np.ndarray) -> QualityModel:
    weight = np.ones(len(x))
    if not len(x) or positive.all() or not positive.any():
        zeros = (np.zeros((FEATURES, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), 0.0)
        return QualityModel(np.zeros(FEATURES), np.ones(FEATURES), zeros, 0.5)
    centre, scale = x.mean(0), x.std(0) + 1e-3
    standard = (x - centre) / scale
    half = np.arange(len(x)) % 2 == 0
    if not (positive[half].any() and not positive[half].all()):
        half[:] = True
    z = _forward(standard, _fit(standard[half], positive[half], weight[half], None))[1]
    other = ~half if not half.all() else half
    prior = estimated_prior(z[positive & other], z[~positive & other])
    return QualityModel(centre, scale, _fit(standard, positive, weight, prior), prior)


def train(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "quality", rows: int = TRAIN_ROWS) -> QualityModel:
    """Fit to about ``rows`` positives and as many unlabelled documents, none of the held-out fold.

    Labels of 0 are not used. Without positives or without unlabelled text every score is one half.
    """
    chosen, _ = class_samples(labels.where(F.col(label) == 1), label, rows)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    positives = source.join(F.broadcast(chosen.select("doc_id")), "doc_id").select("doc_id", F.lit(True).alias("p"), "text")
    free = source.where("doc_id is not null").where(~held_out(F.col("doc_id")))
    unlabelled = even_share(free, rows, free.count(), "doc_id", seed=8).select("doc_id", F.lit(False).alias("p"), "text")
    schema = "doc_id bigint, p boolean, x binary"
    got = positives.unionByName(unlabelled).mapInArrow(_featured, schema).collect()
    got.sort(key=lambda r: (r["p"], r["doc_id"], r["x"]))
    x = np.array([np.frombuffer(r["x"]) for r in got]).reshape(-1, FEATURES)
    return fit_model(x, np.array([r["p"] for r in got], bool))


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = WordHasher(is_space())
    for batch in batches:
        for block in hasher.texts(batch["text"]):
            part = batch.slice(block.first, block.last - block.first)
            x = pa.array([row.tobytes() for row in features(block)], pa.binary())
            yield pa.RecordBatch.from_arrays([part["doc_id"], part["p"], x], names=["doc_id", "p", "x"])


def score(docs: DataFrame, model: QualityModel, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` with ``score`` (higher: better) for every row; NULL and empty texts get the score of no words."""
    schema = schema_with(docs, keep, "score double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(is_space())
        for batch in batches:
            for block in hasher.texts(batch["__text"]):
                part = batch.slice(block.first, block.last - block.first)
                yield pa.RecordBatch.from_arrays([*(part[c] for c in keep), pa.array(model(features(block)))], names=[*keep, "score"])

    return docs.select(*keep, F.col(text).alias("__text")).mapInArrow(run, schema)
