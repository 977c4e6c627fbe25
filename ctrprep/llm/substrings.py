"""Passages of many words that stand in an earlier document too, removed exactly.

Every run of ``WINDOW`` consecutive words is a window. Its Rabin-Karp hash comes from running sums over the words' hashes, and Spark
counts the hashes: a window is removed from a document if the same window also starts in a document with a smaller id. Windows
that overlap or touch merge into maximal intervals of words.

Three things keep the counting small, none of which loses a window:

* Documents with the same words throughout are counted once; all but the first are repeated as a whole.
* Equal windows share the smallest hash of their shorter runs of ``GRAM`` words. These are a fourteenth as many as windows, and are
  counted first; only windows whose smallest hash occurs in two documents are hashed for counting.
* Equal windows of one block of documents are resolved in the block, and only the earliest one's goes on to the count.

Windows are compared by 95 bits of hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ctrprep.llm.components import apart
from ctrprep.llm.decontaminate import united
from ctrprep.llm.frames import schema_with
from ctrprep.llm.wordhash import WordBlock, WordHasher, is_space, mix
from ctrprep.sources.scratch import store

WINDOW = 50
GRAM = 24
#: Stands for a missing id; such rows are never looked up.
_NO_ID = -(1 << 63)
_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


class Rolling:
    """Rabin-Karp hashes of runs of words, modulo 2**64."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(0, np.uint64)

    def sums(self, words: np.ndarray) -> np.ndarray:
        n = len(words) + 1
        if len(self.up) < n:
            powers = []
            for b in (self.base, self.inverse):
                p = np.full(n + n // 4, b, np.uint64)
                p[0] = 1
                powers.append(np.cumprod(p, dtype=np.uint64))
            self.up, self.down = powers
        total = np.zeros(n, np.uint64)
        np.cumsum(words * self.up[: n - 1], out=total[1:])
        return total

    def between(self, sums: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the words from ``first`` to ``end`` (exclusive)."""
        return mix((sums[end] - sums[first]) * self.down[first])


def _minima(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbours."""
    have, out = 1, values
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


class Windows:
    """The windows of a block: their first words, rows, and smallest gram hashes."""

    def __init__(self, block: WordBlock, rollers: tuple[Rolling, Rolling], window: int, gram: int) -> None:
        self.rollers, self.window = rollers, window
        self.sums = [r.sums(block.words) for r in rollers]
        n = len(block.words)
        rows = np.repeat(np.arange(block.last - block.first), np.diff(block.at))
        first = np.arange(max(0, n - window + 1))
        self.first = first[rows[first] == rows[first + window - 1]] if len(first) else first
        self.row = rows[self.first]
        at = np.arange(max(0, n - gram + 1))
        grams = rollers[0].between(self.sums[0], at, at + gram)
        self.smallest = _minima(grams, window - gram + 1)[self.first] if len(self.first) else np.empty(0, np.uint64)

    def hashes(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first = self.first[which]
        one, two = (r.between(s, first, first + self.window) for r, s in zip(self.rollers, self.sums, strict=True))
        return one.view(np.int64), (two >> np.uint64(33)).astype(np.int32)


def _rollers() -> tuple[Rolling, Rolling]:
    return Rolling(_BASES[0]), Rolling(_BASES[1])


def _lists(values: np.ndarray, row: np.ndarray, rows: int) -> pa.ListArray:
    ends = np.searchsorted(row, np.arange(rows + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def _survey(window: int, gram: int):
    """Per row: number of words, a hash of all of them, and the distinct smallest gram hashes of its windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, rollers = WordHasher(is_space()), _rollers()
        for batch in batches:
            for block in hasher.texts(batch["text"]):
                w = Windows(block, rollers, window, gram)
                whole = [r.between(s, block.at[:-1], block.at[1:]).view(np.int64) for r, s in zip(rollers, w.sums, strict=True)]
                new = np.ones(len(w.row), bool)
                new[1:] = (w.smallest[1:] != w.smallest[:-1]) | (w.row[1:] != w.row[:-1])
                grams = _lists(w.smallest[new].view(np.int64), w.row[new], block.last - block.first)
                part = batch.slice(block.first, block.last - block.first)
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], part["version"], pa.array(np.diff(block.at), pa.int64()), *map(pa.array, whole), grams],
                    names=["doc_id", "version", "n_words", "one", "two", "grams"],
                )

    return run


def _counted(window: int, gram: int):
    """The windows with a gram that occurs in several documents, as (hashes, document, first word, sure).

    ``sure`` windows have an equal one in an earlier document of the block; consecutive ones make one row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, rollers = WordHasher(is_space()), _rollers()
        for batch in batches:
            for block in hasher.texts(batch["text"]):
                part = batch.slice(block.first, block.last - block.first)
                w = Windows(block, rollers, window, gram)
                repeated = part["grams"].flatten().to_numpy(zero_copy_only=False).view(np.uint64)
                which = np.flatnonzero(np.isin(w.smallest, repeated))
                one, two = w.hashes(which)
                row = w.row[which]
                place = w.first[which] - block.at[row]
                doc = part["doc_id"].to_numpy(zero_copy_only=False)[row]
                order = np.lexsort((doc, two, one))
                new = np.ones(len(order), bool)
                new[1:] = (one[order[1:]] != one[order[:-1]]) | (two[order[1:]] != two[order[:-1]])
                earliest = np.empty(len(order), doc.dtype)
                earliest[order] = doc[order][np.flatnonzero(new)][np.cumsum(new) - 1] if len(order) else doc
                sure = doc > earliest
                starts = np.ones(len(which), bool)
                starts[1:] = ~(sure[1:] & sure[:-1] & (row[1:] == row[:-1]) & (place[1:] == place[:-1] + 1))
                at = np.flatnonzero(starts)
                size = np.diff(np.append(at, len(which))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(one[at]),
                        pa.array(two[at]),
                        pa.array(doc[at], pa.int64()),
                        part["version"].take(pa.array(row[at])),
                        pa.array(place[at].astype(np.int32)),
                        pa.array(size),
                        pa.array(sure[at]),
                    ],
                    names=["one", "two", "doc_id", "version", "place", "size", "sure"],
                )

    return run


_WINDOW_ROWS = "one bigint, two int, doc_id bigint, version int, place int, size int, sure boolean"


def repeated_passages(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, version, whole, windows) of documents with words to remove; ``windows`` are (first word, number of windows).

    ``version`` is a short hash of the text, which tells apart rows that share an id. ``whole`` documents repeat an earlier one throughout.
    """
    source = _source(docs, text, doc_id)
    schema = "doc_id bigint, version int, n_words bigint, one bigint, two bigint, grams array<bigint>"
    long_enough = (F.col("n_words") >= window) & (F.col("doc_id") != _NO_ID)
    survey = store(source.mapInArrow(_survey(window, gram), schema).where(long_enough), "substring-survey")
    firsts = survey.groupBy("one", "two", "n_words").agg(F.min("doc_id").alias("first"))
    firsts = firsts.select(apart("one").alias("key"), "two", "n_words", "first")
    ranked = survey.select("doc_id", "version", apart("one").alias("key"), "two", "n_words").join(firsts, ["key", "two", "n_words"])
    copies = ranked.where("doc_id > first").select("doc_id", "version").distinct()

    ids = ranked.where("doc_id = first").select("doc_id", "version").distinct()
    grams = survey.join(ids, ["doc_id", "version"]).select("doc_id", "version", F.explode("grams").alias("gram"))
    grams = store(grams, "substring-grams")
    several = grams.groupBy("gram").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    shared = grams.withColumn("key", apart("gram")).join(several.select(apart("gram").alias("key")), "key")
    suspects = shared.groupBy("doc_id", "version").agg(F.collect_set("gram").alias("grams"))

    rows = source.join(suspects, ["doc_id", "version"]).select("doc_id", "version", "text", "grams")
    windows = rows.mapInArrow(_counted(window, gram), _WINDOW_ROWS)
    earliest = windows.where("not sure").groupBy("one", "two").agg(F.min("doc_id").alias("earliest"), F.max("doc_id").alias("latest"))
    earliest = earliest.where("earliest < latest").select(apart("one").alias("key"), "two", "earliest")
    removed = windows.withColumn("key", apart("one")).join(earliest, ["key", "two"], "left").where("sure or earliest < doc_id")
    partial = removed.groupBy("doc_id", "version").agg(F.collect_list(F.struct("place", "size")).alias("windows"))
    nothing = F.array().cast("array<struct<place: int, size: int>>")
    return partial.select("doc_id", "version", F.lit(False).alias("whole"), "windows").unionByName(
        copies.select("doc_id", "version", F.lit(True).alias("whole"), nothing.alias("windows"))
    )


def _source(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """Keys that are never NULL, so that every join reads the same rows and Spark deals the texts out only once."""
    key = F.coalesce(F.col(doc_id).cast("long"), F.lit(_NO_ID))
    version = F.pmod(F.xxhash64(F.col(text)), F.lit(1 << 24)).cast("int")
    return docs.select(key.alias("doc_id"), F.coalesce(version, F.lit(0)).alias("version"), F.col(text).alias("text"))


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """``doc_id``, ``n_words``, ``removed`` (intervals of words, end exclusive) and ``kept`` (the other words, one blank between).

    NULL and empty texts have no words; a row without an id loses nothing and takes nothing from others; rows that share an id
    do not count as earlier than each other.
    """
    source = _source(docs, text, doc_id)
    joined = source.join(repeated_passages(docs, text, doc_id, window), ["doc_id", "version"], "left")
    schema = schema_with(source, ["doc_id"], "n_words bigint, removed array<struct<first: bigint, end: bigint>>, kept string")
    done = joined.select("doc_id", "text", "whole", "windows").mapInArrow(_removal(window), schema)
    return done.withColumn("doc_id", F.nullif("doc_id", F.lit(_NO_ID)))


_INTERVALS = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))


def _removal(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = max(1, batch.num_rows // max(1, batch.nbytes >> 21))
            for lo in range(0, batch.num_rows, size):
                part = batch.slice(lo, size)
                counts, intervals, kept = [], [], []
                columns = (part[c].to_pylist() for c in ("text", "whole", "windows"))
                for text, whole, windows in zip(*columns, strict=True):
                    words = _words(text)
                    n = len(words)
                    cut = [(0, n)] if whole else united([(w["place"], w["place"] + w["size"] - 1 + window) for w in windows or ()])
                    counts.append(n)
                    intervals.append([{"first": a, "end": b} for a, b in cut])
                    for a, b in reversed(cut):
                        del words[a:b]
                    kept.append(b" ".join(words).decode())
                arrays = [part["doc_id"], pa.array(counts, pa.int64()), pa.array(intervals, _INTERVALS), pa.array(kept, pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_words", "removed", "kept"])

    return run


def _words(text: str | None) -> list[bytes]:
    """Splitting bytes cuts at blanks and the control characters 9 to 13 only."""
    return (text or "").encode().split()


def digests(kept: DataFrame) -> DataFrame:
    size = F.aggregate("removed", F.lit(0).cast("long"), lambda total, i: total + i["end"] - i["first"])
    return kept.select("doc_id", "n_words", size.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))

