"""Byte-pair encoding by backtracking, and decoding through an offset table.

**Encoding.** A word's greedy tokenization takes the longest token that starts at each place; an
Aho-Corasick automaton over the reversed tokens finds them all in one pass. Two neighbours are kept only
if they are *compatible*: merging by rank would not have joined anything across their border. A sequence
whose neighbours are all compatible is the one merging by rank gives, so the encoder shortens or takes back
tokens until every pair fits; a place found to lead nowhere is not tried again, which keeps the work linear.

**Decoding.** The texts of all tokens lie in one array of bytes with an offset for each id; a document is
gathered from it by array indexing.

Words repeat, so each worker remembers the tokens of up to ``CACHE_WORDS`` words. The memory is emptied when
full, which changes speed only.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ctrprep.llm.frames import kept_in_worker, schema_with
from ctrprep.llm.wordhash import text_slices

CACHE_WORDS = 400_000
#: Words beyond this length are encoded each time, so that the memory stays small.
CACHE_LENGTH = 40
_WORD_END = "</w>"
#: White space of the tokenizer's pattern language.
_SPACE = r"\t-\r \x85\xa0  -     　"


def byte_names() -> list[str]:
    """The character that byte-level vocabularies write for each byte: itself if it prints, else one from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    names = {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}
    return [names[b] for b in range(256)]


class OffsetTable:
    """Texts by id in one array; ``join`` writes many of them with a blank between."""

    def __init__(self, texts: list[bytes]) -> None:
        sizes = np.array([len(t) + 1 for t in texts], np.int64)
        self.sizes, self.starts = sizes, np.cumsum(sizes) - sizes
        self.body = np.frombuffer(b"".join(t + b" " for t in texts), np.uint8)

    def join(self, ids: np.ndarray) -> bytes:
        if not len(ids):
            return b""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts[ids] - (ends - sizes), sizes)
        at += np.arange(ends[-1])
        return self.body[at[:-1]].tobytes()


class WordBpe:
    """The word-level BPE tokenizer described by a ``tokenizer.json`` with word ends."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model["end_of_word_suffix"] != _WORD_END or spec["decoder"] is not None:
            raise ValueError("this encoder is for BPE vocabularies with word ends and no decoder")
        names = byte_names()
        byte_of = {c: b for b, c in enumerate(names)}

        def symbols(token: str) -> str:
            """One character per byte; a byte that ends a word is 256 higher."""
            ends = token.endswith(_WORD_END)
            codes = [byte_of[c] for c in (token[: -len(_WORD_END)] if ends else token)]
            if ends:
                codes[-1] += 256
            return "".join(map(chr, codes))

        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        singles = [*names, *(n + _WORD_END for n in names)]
        # Tokens are numbered by the order in which merging makes them; the vocabulary's ids come back at the end.
        tokens = singles + [a + b for a, b in merges]
        rank = {t: k for k, t in enumerate(tokens)}
        self.vocabulary_id = [model["vocab"][t] for t in tokens]
        self.parts = [(k, k) for k in range(len(singles))] + [(rank[a], rank[b]) for a, b in merges]
        self.joined = {pair: k for k, pair in enumerate(self.parts) if k >= len(singles)}
        spelled = [symbols(t) for t in tokens]
        self.length = [len(s) for s in spelled]
        self.ends_at = ahocorasick.Automaton()
        for k, s in enumerate(spelled):
            self.ends_at.add_word(s[::-1], k)
        self.ends_at.make_automaton()
        by_text = {s: k for k, s in enumerate(spelled)}
        self.shorter = [next((by_text[s[:n]] for n in range(len(s) - 1, 0, -1) if s[:n] in by_text), -1) for s in spelled]
        self.fits: dict[tuple[int, int], bool] = {}

        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        texts = dict(zip(self.vocabulary_id, tokens, strict=True)) | {i: t for t, i in self.added.items()}
        self.texts = OffsetTable([texts.get(i, "").encode() for i in range(max(texts) + 1)])
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(pattern.replace(r"\s", _SPACE))
        self.specials = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) or r"(?!)")
        self.lower = _Lower()
        self.known: dict[str, tuple[int, ...]] = {}

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging by rank leaves the border between the two tokens alone."""
        key = (left, right)
        if (known := self.fits.get(key)) is not None:
            return known
        # Undo the later of the two merges step by step; ``limit`` is the rank from which a join across the
        # border would come too late to happen.
        limit, fits = len(self.parts), True
        while True:
            joint = self.joined.get((left, right))
            if joint is not None and joint < limit:
                fits = False
                break
            inner, outer = self.parts[left][1], self.parts[right][0]
            if left > right and inner != left or outer == right and inner != left:
                limit, left = left, inner
            elif outer != right:
                limit, right = right + 1, outer
            else:
                break
        if len(self.fits) >= CACHE_WORDS:
            self.fits.clear()
        self.fits[key] = fits
        return fits

    def merge_word(self, word: str) -> tuple[int, ...]:
        """The vocabulary ids of one word."""
        data = word.encode("utf-8", "surrogatepass")
        text = data[:-1].decode("latin-1") + chr(256 + data[-1])
        n = len(text)
        longest = [0] * n
        for end, k in self.ends_at.iter(text[::-1]):
            start = n - 1 - end
            if self.length[k] >= self.length[longest[start]] or self.length[longest[start]] == 1:
                longest[start] = k
        open_at, stack, at, token = [True] * (n + 1), [], 0, longest[0]
        while at < n:
            while token >= 0:
                end = at + self.length[token]
                if open_at[end] and (not stack or self.compatible(stack[-1], token)):
                    break
                token = self.shorter[token]
            if token >= 0:
                stack.append(token)
                at = end
                token = longest[at] if at < n else -1
            else:
                open_at[at] = False
                token = stack.pop()
                at -= self.length[token]
                token = self.shorter[token]
        return tuple(self.vocabulary_id[k] for k in stack)

    def ids(self, text: str) -> np.ndarray:
        """The ids of a whole text; added tokens are recognised before anything else."""
        out, at = [], 0
        for m in self.specials.finditer(text):
            out += [*self._plain(text[at : m.start()]), (self.added[m[0]],)]
            at = m.end()
        out += self._plain(text[at:] if at else text)
        return np.fromiter(chain.from_iterable(out), np.int32)

    def _plain(self, text: str) -> list[tuple[int, ...]]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).translate(self.lower)
        else:
            text = text.lower()
        words, known = self.words.findall(text), self.known
        try:
            return list(map(known.__getitem__, words))
        except KeyError:
            return [known.get(w) or self._learn(w) for w in words]

    def _learn(self, word: str) -> tuple[int, ...]:
        ids = self.merge_word(word)
        if len(word) <= CACHE_LENGTH:
            if len(self.known) >= CACHE_WORDS:
                self.known.clear()
            self.known[word] = ids
        return ids

    def decode(self, ids: np.ndarray) -> bytes:
        """The texts of the tokens with a blank between, as UTF-8."""
        return self.texts.join(ids)


class _Lower(dict):
    """Lower case of single characters, without rules that look at their neighbours."""

    def __missing__(self, code: int) -> str:
        self[code] = chr(code).lower()
        return self[code]


def tokenizer(path: str) -> WordBpe:
    return kept_in_worker(("word-bpe", path), lambda: WordBpe(path))


def encode(docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` with ``ids`` (array<int>) and ``decoded`` (the ids decoded again) for every row.

    NULL and empty texts have no ids and decode to an empty text; rows with equal or NULL keys stay separate.
    Each text is encoded as a whole. ``path`` names the vocabulary file, present on every executor.
    """
    schema = schema_with(docs, keep, "ids array<int>, decoded string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for batch in batches:
            for part in text_slices(batch, "__text"):
                ids = [bpe.ids(t or "") for t in part["__text"].to_pylist()]
                sizes = np.zeros(len(ids) + 1, np.int32)
                np.cumsum([len(i) for i in ids], out=sizes[1:])
                arrays = [part[c] for c in keep]
                arrays.append(pa.ListArray.from_arrays(pa.array(sizes), pa.array(np.concatenate([*ids, np.empty(0, np.int32)]))))
                arrays.append(pa.array([bpe.decode(i).decode() for i in ids], pa.string()))
                yield pa.RecordBatch.from_arrays(arrays, names=[*keep, "ids", "decoded"])

    return docs.select(*keep, F.col(text).alias("__text")).mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` with ``decoded`` for every row of ``ids``; NULL decodes to an empty text."""
    schema = schema_with(encoded, keep, "decoded string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for batch in batches:
            texts = [bpe.decode(np.array(i or [], np.int64)).decode() for i in batch["__ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in keep), pa.array(texts, pa.string())], names=[*keep, "decoded"])

    return encoded.select(*keep, F.col(ids).alias("__ids")).mapInArrow(run, schema)


def digests(encoded: DataFrame, ids: bool = False) -> DataFrame:
    """``doc_id``, ``n_tokens`` and the digests of ids and decoded text, of the rows of ``encode``; with ``ids`` the ids too."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        *(["ids"] if ids else []),
    )
