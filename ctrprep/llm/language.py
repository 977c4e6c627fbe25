"""The language of texts by cross-parsing: how few pieces of a language's labelled text a document can be put together from.

For each language a suffix automaton holds all substrings of a sample of its text. A document is parsed from left to right into
phrases, each the longest match with some substring of the sample, or a single letter that the language does not have. The number of
phrases times the logarithm of the sample's size, for each letter of the document, estimates the cross entropy; the language with the
least wins, and among equal ones that with more labelled text.

Texts are lower-cased and what is between their letters becomes one blank. They are parsed in blocks of ``BLOCK`` letters and blanks,
and a phrase ends with its block in every language alike. All blocks of an Arrow batch advance together, a letter a step, in all
languages: the automata are tables that give the next state and whether a phrase ends, so a very long text is just more blocks.

The samples are bounded: ``REFERENCE`` letters of each language, fewer if all languages together would have more than ``REFERENCES``.
They are drawn from all labelled texts by the hashes of pieces, and equal pieces count once.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ctrprep.llm.frames import kept_in_worker, schema_with
from ctrprep.llm.wordhash import text_slices

#: Letters of labelled text that a language is learned from, of all languages together, and of a piece that is drawn.
REFERENCE, REFERENCES, PIECE = 40_000, 400_000, 400
#: How much more than that is read to draw the pieces from, by documents and then by pieces.
_DOCUMENTS, _PIECES = 64, 8
BLOCK = 256
#: Letters that have a class of their own; the others share some classes.
LETTERS, _SHARED = 200, 32
FOLDS, HELD_OUT = 4, 2
UNDECIDED = "und"
_BLANK, _FIRST = 0, 1
_GRAIN = 1 << 30


def held_out(doc_id: Column) -> Column:
    """Whether a row is set aside: the remainder of crc32 of its id as text. A NULL id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


# --- letters ----------------------------------------------------------------------------------------------------------------------


def _is_letter() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def letters(text: str) -> np.ndarray:
    """The lower-cased letters of a text as code points; what stands between two letters is one 0."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    known = kept_in_worker("language-letters", _is_letter)[points]
    out = np.where(known, points, 0)
    # A blank stays where a letter stands before it and another one follows later.
    use = known.copy()
    use[1:] |= known[:-1]
    out = out[use]
    return out[:-1] if len(out) and not out[-1] else out


def alphabet(references: Sequence[str]) -> list[str]:
    """The most frequent letters of the samples, each of which is a class of its own."""
    counted = Counter(c for text in references for c in text if c != " ")
    return [c for c, _ in sorted(counted.items(), key=lambda x: (-x[1], x[0]))[:LETTERS]]


def _classes(known: Sequence[str]) -> np.ndarray:
    """The class of every code point: 0 a blank, then the letters shared by rarer ones, then those of the alphabet."""
    table = _FIRST + (np.arange(0x110000, dtype=np.int64) * 0x9E3779B1 % (1 << 32) >> 27).astype(np.int32) % _SHARED
    table[0] = table[ord(" ")] = _BLANK
    for k, c in enumerate(known):
        table[ord(c)] = _FIRST + _SHARED + k
    return table


# --- automata ---------------------------------------------------------------------------------------------------------------------


class SuffixAutomaton:
    """All substrings of some sequences of classes: for each state its moves, its longest substring and its suffix link."""

    def __init__(self, sequences: Sequence[Sequence[int]]) -> None:
        self.moves: list[dict[int, int]] = [{}]
        self.length, self.link = [0], [-1]
        for sequence in sequences:
            last = 0
            for c in sequence:
                last = self._extend(last, c)

    def _state(self, length: int, link: int, moves: dict[int, int]) -> int:
        self.moves.append(moves)
        self.length.append(length)
        self.link.append(link)
        return len(self.moves) - 1

    def _split(self, at: int, c: int) -> int:
        """The state that ``c`` leads to from ``at``, with just the substrings that are one longer than those of ``at``, or shorter."""
        to = self.moves[at][c]
        if self.length[to] == self.length[at] + 1:
            return to
        part = self._state(self.length[at] + 1, self.link[to], dict(self.moves[to]))
        self.link[to] = part
        while at >= 0 and self.moves[at].get(c) == to:
            self.moves[at][c] = part
            at = self.link[at]
        return part

    def _extend(self, last: int, c: int) -> int:
        if c in self.moves[last]:
            return self._split(last, c)
        new = self._state(self.length[last] + 1, 0, {})
        at = last
        while at >= 0 and c not in self.moves[at]:
            self.moves[at][c] = new
            at = self.link[at]
        if at >= 0:
            self.link[new] = self._split(at, c)
        return new

    def table(self, classes: int) -> np.ndarray:
        """For each state and class twice the next state, and one more if a phrase ends before the class.

        One state more than the automaton's stands for a class without any match, after which a phrase ends in any case.
        """
        n = len(self.moves)
        first = np.full(classes, 2 * n + 1, np.int32)
        for c, to in self.moves[0].items():
            first[c] = 2 * to + 1
        out = np.tile(first, (n + 1, 1))
        for state, moves in enumerate(self.moves):
            if moves:
                out[state, list(moves)] = [2 * to for to in moves.values()]
        # Nothing ends before the first class of a text, known or not.
        out[0] = first - 1
        return out


@dataclass(frozen=True)
class LanguageModel:
    """The languages, those with more labelled text first, and the pieces that stand for each."""

    languages: tuple[str, ...]
    pieces: tuple[tuple[str, ...], ...]

    @property
    def key(self) -> str:
        return hashlib.sha256(repr((self.languages, self.pieces)).encode("utf-8", "surrogatepass")).hexdigest()

    def parser(self) -> Parser:
        return kept_in_worker(("language", self.key), lambda: Parser(self))


class Parser:
    """The automata of a model, ready to parse many blocks at once."""

    def __init__(self, model: LanguageModel) -> None:
        known = alphabet(["".join(p) for p in model.pieces])
        self.of_point = _classes(known)
        classes = _FIRST + _SHARED + len(known)
        tables, self.start = [], []
        at = 0
        for pieces in model.pieces:
            coded = [self.of_point[[ord(c) for c in piece]].tolist() for piece in pieces]
            table = SuffixAutomaton(coded).table(classes)
            # All tables become one, in which each language's states stand behind those before.
            tables.append(table + 2 * at)
            self.start.append(at)
            at += len(table)
        self.moves = np.concatenate(tables) if tables else np.zeros((0, classes), np.int32)
        self.bits = np.array([math.log2(max(2, sum(map(len, p)))) for p in model.pieces])

    def phrases(self, texts: Sequence[np.ndarray]) -> np.ndarray:
        """The number of phrases of each text (rows) in each language (columns)."""
        sizes = np.array([len(t) for t in texts])
        out = np.zeros((len(texts), len(self.start)), np.int64)
        if not sizes.sum() or not self.start:
            return out
        code = self.of_point[np.concatenate(texts)]
        blocks = -(-sizes // BLOCK)
        of_text = np.repeat(np.arange(len(texts)), blocks)
        number = np.arange(len(of_text)) - (np.cumsum(blocks) - blocks)[of_text]
        begin = (np.cumsum(sizes) - sizes)[of_text] + number * BLOCK
        size = np.minimum(BLOCK, sizes[of_text] - number * BLOCK)
        order = np.argsort(-size, kind="stable")
        begin, size, of_text = begin[order], size[order], of_text[order]
        state = np.repeat(np.array(self.start, np.int32)[:, None], len(begin), axis=1)
        # The last phrase of a block ends with it.
        ended = np.ones(state.shape, np.int32)
        running = np.searchsorted(-size, -np.arange(1, int(size[0]) + 1), side="right")
        for step, n in enumerate(running.tolist()):
            to = self.moves[state[:, :n], code[begin[:n] + step][None, :]]
            ended[:, :n] += to & 1
            state[:, :n] = to >> 1
        for k in range(len(self.start)):
            out[:, k] = np.bincount(of_text, ended[k], minlength=len(texts))
        return out


# --- learning and predicting ------------------------------------------------------------------------------------------------------


def _drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of the texts whose hash is below their language's share, and of each slice the one of the least hash in any case."""
    for batch in batches:
        for part in text_slices(batch, "text"):
            out: list[tuple] = []
            least: dict[str, tuple] = {}
            for lang, share, text in zip(*(part[c].to_pylist() for c in ("lang", "share", "text")), strict=True):
                found = letters(text)
                body = "".join(map(chr, np.where(found == 0, 32, found).tolist()))
                for at in range(0, len(body), PIECE):
                    piece = body[at : at + PIECE]
                    place = int.from_bytes(hashlib.blake2b(piece.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big") >> 34
                    row = lang, piece.encode("utf-8", "replace").decode(), place
                    if place < share:
                        out.append(row)
                    elif lang not in least or place < least[lang][2]:
                        least[lang] = row
            out += least.values()
            columns = list(zip(*out, strict=True)) if out else [[]] * 3
            arrays = [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64()), strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["lang", "piece", "place"])


def train(docs: DataFrame, text: str = "text", lang: str = "lang", reference: int = REFERENCE, references: int = REFERENCES) -> LanguageModel:
    """Learn the languages of ``docs``; rows without a language or text teach nothing.

    The samples hold at most ``reference`` letters of each language and ``references`` of all, whatever the number of rows.
    """
    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).where("lang is not null and text is not null")
    # Copies of a text are one here as they are in the sample.
    distinct = rows.select("lang", F.xxhash64("text").alias("hash"), F.length("text").alias("n")).distinct()
    counted = distinct.groupBy("lang").agg(F.sum("n").alias("n"), F.count("*").alias("texts")).collect()
    totals, texts = {r["lang"]: r["n"] or 0 for r in counted}, {r["lang"]: r["texts"] for r in counted}
    names = sorted((name for name, n in totals.items() if n), key=lambda name: (-totals[name], name))
    if not names:
        return LanguageModel((), ())
    reference = max(PIECE, min(reference, references // len(names)))
    shares = []
    for name in names:
        documents = min(1.0, max(_DOCUMENTS * reference / totals[name], _DOCUMENTS / texts[name]))
        shares.append((name, int(documents * _GRAIN), int(min(1.0, _PIECES * reference / (documents * totals[name])) * _GRAIN)))
    # One row for each language.
    known = F.broadcast(rows.sparkSession.createDataFrame(shares, "lang string, documents long, share long"))
    chosen = rows.join(known, "lang").where(F.pmod(F.xxhash64("text"), F.lit(_GRAIN)) < F.col("documents"))
    pieces = chosen.select("lang", "share", "text").mapInArrow(_drawn, "lang string, piece string, place long").distinct()
    # Some hundred pieces of a language; the first ones that fill its sample are taken.
    window = Window.partitionBy("lang").orderBy("place", "piece").rowsBetween(Window.unboundedPreceding, 0)
    taken = pieces.withColumn("until", F.sum(F.length("piece")).over(window)).where(F.col("until") <= reference)
    by_name: dict[str, list[tuple[int, str]]] = {}
    for r in taken.select("lang", "piece", "place").collect():
        by_name.setdefault(r["lang"], []).append((r["place"], r["piece"]))
    learned = tuple(name for name in names if name in by_name)
    return LanguageModel(learned, tuple(tuple(p for _, p in sorted(by_name[name])) for name in learned))


def predict(docs: DataFrame, model: LanguageModel, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` with ``lang_pred``, ``score`` and ``bits``, the least estimate of the cross entropy for each letter.

    The score is the second language's share of both estimates: 0.5 where two languages are alike, 1 if there is no second one. A text
    that is NULL or has no letter, or any if nothing was learned, is ``und`` with score 0 and no bits.
    """
    schema = schema_with(docs, keep, "lang_pred string, score double, bits double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = model.parser()
        for batch in batches:
            for part in text_slices(batch, "__text"):
                found = [letters(t) if t else np.empty(0, np.uint32) for t in part["__text"].to_pylist()]
                sizes = np.array([len(f) for f in found])
                names, scores, bits = [UNDECIDED] * len(found), np.zeros(len(found)), [None] * len(found)
                if model.languages:
                    estimate = parser.phrases(found) * parser.bits[None, :] / np.maximum(sizes, 1)[:, None]
                    best = estimate.argmin(axis=1)
                    least = estimate[np.arange(len(found)), best]
                    second = np.partition(estimate, 1, axis=1)[:, 1] if len(model.languages) > 1 else None
                    share = second / np.maximum(least + second, 1e-300) if second is not None else np.ones(len(found))
                    for k in np.flatnonzero(sizes).tolist():
                        names[k], scores[k], bits[k] = model.languages[best[k]], share[k], float(least[k])
                arrays = [*(part[c] for c in keep), pa.array(names, pa.string()), pa.array(scores), pa.array(bits, pa.float64())]
                yield pa.RecordBatch.from_arrays(arrays, names=[*keep, "lang_pred", "score", "bits"])

    return docs.select(*keep, F.col(text).alias("__text")).mapInArrow(run, schema)
