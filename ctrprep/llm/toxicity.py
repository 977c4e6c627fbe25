"""Toxicity by multiple-instance learning.

Only documents are labelled, but toxicity sits in sentences. Each sentence has the probability that a linear
model of its words and word beginnings gives; a document is toxic unless all its sentences are clean (noisy-or). The
likelihood of the document labels under this model is what is maximised, so the sentences are learned without having
been labelled, and the same scores then point to them.

The model is fitted on the driver from at most about ``TRAIN_ROWS`` documents of each class, turned into feature numbers
on the executors, and scored everywhere over whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ctrprep.llm.frames import schema_with
from ctrprep.llm.training import class_samples, held_out
from ctrprep.llm.wordhash import WordBlock, WordHasher, is_not_word, mix

TRAIN_ROWS = 1000
BUCKET_BITS = 18
#: Features are the whole word and its beginnings of these many bytes.
BEGINNINGS = (4, 5, 6)
#: Features of fewer training documents than this are left at zero.
LEAST_DOCUMENTS = 4
STEPS, RATE, SHRINK, FIRST_BIAS = 120, 0.1, 2e-5, -5.0

_SENTENCE_ENDS = np.isin(np.arange(256), list(b".!?\n"))


@dataclass(frozen=True)
class Sentences:
    """Sentences of a block of rows: the row of each, its first and last word, and the features of each word."""

    row: np.ndarray
    first: np.ndarray
    last: np.ndarray
    of_word: np.ndarray
    features: np.ndarray


def _hasher() -> WordHasher:
    return WordHasher(is_not_word(), fold=True)


def sentences(hasher: WordHasher, block: WordBlock) -> Sentences:
    """Sentences end at ``. ! ?`` and line ends; those without words do not count."""
    marks = np.cumsum(_SENTENCE_ENDS[block.data])
    number = marks[block.start] if len(block.start) else np.empty(0, np.int64)
    new = np.append(True, number[1:] != number[:-1]) if len(number) else np.empty(0, bool)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(number)) if len(first) else first
    row = np.searchsorted(block.at, first, side="right") - 1
    shift = np.uint64(64 - BUCKET_BITS)
    features = np.zeros((1 + len(BEGINNINGS), len(number)), np.int32)
    features[0] = mix(block.words + np.uint64(1)) >> shift
    for k, size in enumerate(BEGINNINGS, 1):
        enough = block.end - block.start >= size
        features[k, enough] = mix(hasher.beginnings(block, size)[enough] + np.uint64(k + 1)) >> shift
    return Sentences(row, first, last, np.cumsum(new) - 1, features)


@dataclass(frozen=True)
class ToxicityModel:
    """A weight for each feature, and the bias of a sentence."""

    weights: np.ndarray
    bias: float

    def logits(self, s: Sentences) -> np.ndarray:
        words = self.weights[s.features].sum(axis=0)
        return self.bias + np.bincount(s.of_word, words, minlength=len(s.row))


def noisy_or(logits: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """The probability that some sentence of each row is toxic."""
    clean = np.bincount(row, np.logaddexp(0, logits), minlength=rows)
    return -np.expm1(-clean)


def train(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "toxic", per_class: int = TRAIN_ROWS) -> ToxicityModel:
    """Fit the model to labelled rows outside the held-out fold; without any, every sentence gets the first bias."""
    chosen, sizes = class_samples(labels, label, per_class)
    rows = docs.select("doc_id", F.col(text).alias("text")).join(F.broadcast(chosen), "doc_id")
    got = rows.select("y", "doc_id", "text").mapInArrow(_featured, "y int, doc_id bigint, sentence binary, feature binary").collect()
    got.sort(key=lambda r: (r["doc_id"], r["y"], r["feature"]))
    if not sizes or not got:
        return ToxicityModel(np.zeros(1 << BUCKET_BITS), FIRST_BIAS)
    y = np.array([r["y"] for r in got], float)
    weight = np.where(y > 0, *(sizes.get(c, 0) / max(1, (y == c).sum()) for c in (1, 0)))
    return _fit([(np.frombuffer(r["sentence"], np.int32), np.frombuffer(r["feature"], np.int32)) for r in got], y, weight / weight.sum())


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row's distinct (sentence, feature) pairs."""
    hasher = _hasher()
    for batch in batches:
        for block in hasher.texts(batch["text"]):
            s = sentences(hasher, block)
            where, pairs = [], []
            start = np.searchsorted(s.row, np.arange(block.last - block.first + 1))
            for k in range(block.last - block.first):
                lo, hi = block.at[k], block.at[k + 1]
                own = (s.of_word[lo:hi] - start[k]).astype(np.int64)
                both = np.unique((own[None, :] << BUCKET_BITS | s.features[:, lo:hi]).reshape(-1))
                both = both[both & ((1 << BUCKET_BITS) - 1) > 0]
                where.append((both >> BUCKET_BITS).astype(np.int32).tobytes())
                pairs.append((both & ((1 << BUCKET_BITS) - 1)).astype(np.int32).tobytes())
            part = batch.slice(block.first, block.last - block.first)
            yield pa.RecordBatch.from_arrays(
                [part["y"], part["doc_id"].cast(pa.int64()), pa.array(where, pa.binary()), pa.array(pairs, pa.binary())],
                names=["y", "doc_id", "sentence", "feature"],
            )


def _fit(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, weight: np.ndarray) -> ToxicityModel:
    """Maximum likelihood of the documents' labels by Adam over all rows, with weights drawn towards zero."""
    size = 1 << BUCKET_BITS
    spread = np.zeros(size, np.int64)
    for _, f in rows:
        spread[np.unique(f)] += 1
    used = np.flatnonzero(spread >= min(LEAST_DOCUMENTS, len(rows)))
    number = np.full(size, -1)
    number[used] = np.arange(len(used))
    counts = np.array([int(s.max()) + 1 if len(s) else 0 for s, _ in rows])
    offset = np.cumsum(counts) - counts
    row_of = np.repeat(np.arange(len(rows)), counts)
    where = np.concatenate([s + o for (s, _), o in zip(rows, offset, strict=True)])
    feature = number[np.concatenate([f for _, f in rows])]
    where, feature = where[feature >= 0], feature[feature >= 0]
    n = len(row_of)
    w, bias = np.zeros(len(used)), FIRST_BIAS
    first, second = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    for step in range(1, STEPS + 1):
        z = bias + np.bincount(where, w[feature], minlength=n)
        clean = np.bincount(row_of, np.logaddexp(0, z), minlength=len(rows))
        chance = np.maximum(-np.expm1(-clean), 1e-9)
        pull = np.where(y > 0, -np.exp(-clean) / chance, 1.0) * weight
        slope = pull[row_of] / (1 + np.exp(-z))
        g = np.append(np.bincount(feature, slope[where], minlength=len(used)), slope.sum())
        first = 0.9 * first + 0.1 * g
        second = 0.99 * second + 0.01 * g * g
        move = RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-6)
        w, bias = w - move[:-1], min(bias - move[-1], -2.0)
        w = np.sign(w) * np.maximum(np.abs(w) - RATE * SHRINK / (np.sqrt(second[:-1] / (1 - 0.99**step)) + 1e-6), 0)
    weights = np.zeros(size)
    weights[used] = w
    return ToxicityModel(weights, float(bias))


_FOUND = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))


def score(docs: DataFrame, model: ToxicityModel, text: str = "text", keep: tuple[str, ...] = ("doc_id",), threshold: float = 0.5) -> DataFrame:
    """``keep`` with ``score`` and ``sentences``: those of ``threshold`` or more, by code points from first to last word.

    NULL and empty texts have no sentences and score 0.
    """
    schema = schema_with(docs, keep, "score double, sentences array<struct<start: bigint, end: bigint, score: double>>")
    hasher = _hasher()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in hasher.texts(batch["__text"]):
                s = sentences(hasher, block)
                z = model.logits(s)
                n = block.last - block.first
                found: list[list[dict]] = [[] for _ in range(n)]
                for k in np.flatnonzero(z >= np.log(threshold / (1 - threshold))).tolist():
                    r = int(s.row[k])
                    base, start, end = int(block.offsets[r]), int(block.start[s.first[k]]), int(block.end[s.last[k] - 1])
                    lengths = (block.data[base:end] & 0xC0) != 0x80
                    begin = int(np.count_nonzero(lengths[: start - base]))
                    size = int(np.count_nonzero(lengths[start - base :]))
                    found[r].append({"start": begin, "end": begin + size, "score": float(1 / (1 + np.exp(-z[k])))})
                part = batch.slice(block.first, n)
                arrays = [*(part[c] for c in keep), pa.array(noisy_or(z, s.row, n)), pa.array(found, _FOUND)]
                yield pa.RecordBatch.from_arrays(arrays, names=[*keep, "score", "sentences"])

    return docs.select(*keep, F.col(text).alias("__text")).mapInArrow(run, schema)


def drop_toxic(docs: DataFrame, model: ToxicityModel, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, unchanged."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__row")
    scored = score(docs.select(row, F.col(f"`{text}`").alias("__body")), model, "__body", ("__row",))
    return scored.where(F.col("score") < threshold).select("__row.*")


def report(scored: DataFrame, threshold: float) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted``."""
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
