"""Benchmark passages in documents, found by a generalised suffix automaton.

The automaton holds every run of words of the normalised test items. A document's words are streamed through it;
after each word it knows the longest run of item words that ends there. Wherever that is a window long, the words
of the run are hit. Items shorter than a window count as a whole.

The automaton goes to every task, so its size is bounded: items are dealt into groups of at most ``GROUP_WORDS`` words (one
item at least), each group has an automaton and a pass of its own, and the hits are united. Documents are then stored once with a
number for each row, by which the hits are united; the driver builds one group's automaton at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ctrprep.llm.frames import schema_with
from ctrprep.llm.wordhash import WordHasher, is_not_word
from ctrprep.sources.scratch import store

WINDOW = 13
#: A document is contaminated if this share of its words, or more, is hit.
COVERAGE_PARTS = 20
GROUP_WORDS = 1_000_000

_HITS = "n_words bigint, hits array<struct<first: bigint, end: bigint, byte: bigint, byte_end: bigint>>, items array<string>"
_HIT_TYPE = pa.list_(pa.struct([(n, pa.int64()) for n in ("first", "end", "byte", "byte_end")]))


class ItemAutomaton:
    """All runs of words of some items; states are numbered, state 0 is the empty run."""

    def __init__(self, items: list[tuple[str | None, list[int]]], window: int = WINDOW) -> None:
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        whole = [self._add(words) for _, words in items]
        #: Items of the windows whose last word leads to a state; short items that a state ends with, and their size.
        self.of_window: dict[int, set[str]] = {}
        self.of_short: dict[int, set[tuple[int, str]]] = {}
        for (name, words), last in zip(items, whole, strict=True):
            if 0 < len(words) < window:
                self.of_short.setdefault(last, set()).add((len(words), name or ""))
            state = 0
            for k, word in enumerate(words):
                state = self.next[state][word]
                if k + 1 >= window:
                    self.of_window.setdefault(self.shortest(state), set()).add(name or "")
        # The run length from which a state can hold a window or a short item.
        self.need = [window] * len(self.next)
        for state in sorted(range(len(self.next)), key=self.length.__getitem__):
            sizes = [size for size, _ in self.of_short.get(state, ())]
            if self.link[state] >= 0:
                sizes.append(self.need[self.link[state]])
            self.need[state] = min([window, *sizes])

    def shortest(self, state: int) -> int:
        """The state of the last ``window`` words of the run that led here."""
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def _state(self, length: int, link: int, moves: dict[int, int]) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _add(self, words: list[int]) -> int:
        last = 0
        for word in words:
            last = self._extend(last, word)
        return last

    def _split(self, state: int, word: int, target: int) -> int:
        """The state for the runs of ``target`` no longer than those of ``state`` with ``word``."""
        copy = self._state(self.length[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = copy
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: int) -> int:
        known = self.next[last].get(word)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, word, known)
        new, state = self._state(self.length[last] + 1, 0, {}), last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            target = self.next[state][word]
            fits = self.length[target] == self.length[state] + 1
            self.link[new] = target if fits else self._split(state, word, target)
        return new

    def stream(self, words: list[int], first: int, hits: list[tuple[int, int]], items: set[str]) -> None:
        """Append the hit runs of ``words``, whose first word has number ``first``, and the items they are of."""
        moves, links, lengths, need = self.next, self.link, self.length, self.need
        state = size = 0
        for k, word in enumerate(words):
            after = moves[state].get(word)
            while after is None and state:
                state = links[state]
                size = lengths[state]
                after = moves[state].get(word)
            if after is None:
                continue
            state, size = after, size + 1
            if size >= need[state]:
                self._mark(state, size, first + k + 1, hits, items)

    def _mark(self, state: int, size: int, end: int, hits: list[tuple[int, int]], items: set[str]) -> None:
        if size >= self.window:
            hits.append((end - size, end))
            items |= self.of_window[self.shortest(state)]
        while state > 0 and self.need[state] < self.window:
            for short, name in self.of_short.get(state, ()):
                if short <= size:
                    hits.append((end - short, end))
                    items.add(name)
            state = self.link[state]


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans that meet or overlap as one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _item_groups(benchmark: DataFrame, item: str, text: str) -> tuple[int, Iterator[list]]:
    """The number of groups of items, each of a bounded number of characters, and the groups, read one at a time."""
    sized = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text")).where("text is not null")
    total = sized.agg(F.sum(F.length("text"))).first()[0] or 0
    groups = int(-(-total // (GROUP_WORDS * 4)))
    if groups <= 1:
        return 1, iter([sized.collect()])
    dealt = sized.withColumn("group", F.pmod(F.xxhash64("item", "text"), F.lit(2 * groups)))
    return 2 * groups, (dealt.where(F.col("group") == k).select("item", "text").collect() for k in range(2 * groups))


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    window: int = WINDOW,
) -> DataFrame:
    """``keep`` with ``n_words``, ``hits`` (runs of hit words, as word numbers and as bytes) and ``items`` (sorted ids as text).

    NULL and empty texts have no words; items without words match nothing; an item without an id hits words but is
    not listed. Documents are told apart by row, so ``keep`` may hold anything, equal rows and NULLs included.
    """
    hasher = WordHasher(is_not_word(), fold=True)
    schema = schema_with(docs, keep, _HITS)
    source = docs.select(*keep, F.col(text).alias("__text"))
    count, groups = _item_groups(benchmark, item, item_text)
    if count == 1:
        return source.mapInArrow(_searcher(hasher, _numbered(hasher, next(groups)), keep, window), schema)
    # Written once, so that a row has one number in all passes.
    rows = store(source.withColumn("__at", F.monotonically_increasing_id()), "passages-rows")
    texts, numbered = rows.select("__at", "__text"), schema_with(rows, ("__at",), _HITS)

    def searched(k: int, group: list) -> DataFrame:
        found = texts.mapInArrow(_searcher(hasher, _numbered(hasher, group), ("__at",), window), numbered)
        # The first pass has every row, the others those with hits.
        return store(found if k == 0 else found.where(F.size("hits") > 0), "passages-hits")

    passes = [searched(k, group) for k, group in enumerate(groups)]
    every = passes[0]
    for other in passes[1:]:
        every = every.unionByName(other)
    together = every.groupBy("__at").agg(
        F.first("n_words").alias("n_words"),
        F.flatten(F.collect_list("hits")).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    merge = F.udf(_merged, "array<struct<first: bigint, end: bigint, byte: bigint, byte_end: bigint>>")
    # Both sides have one row for each number.
    return rows.select(*keep, "__at").join(together.withColumn("hits", merge("hits")), "__at").select(*schema.names)


def _merged(hits: list) -> list[tuple[int, int, int, int]]:
    words = united([(h["first"], h["end"]) for h in hits])
    data = united([(h["byte"], h["byte_end"]) for h in hits])
    if len(words) == len(data):
        return [(*w, *d) for w, d in zip(words, data, strict=True)]
    firsts, ends = {h["first"]: h["byte"] for h in hits}, {h["end"]: h["byte_end"] for h in hits}
    return [(a, b, firsts[a], ends[b]) for a, b in words]


def _numbered(hasher: WordHasher, rows: list) -> tuple[np.ndarray, list[tuple[str | None, list[int]]]]:
    """The sorted word hashes of the items, and the items as numbers of these."""
    hashed: list[np.ndarray] = []
    for block in hasher.texts(pa.array([r["text"] for r in rows], pa.string())):
        hashed += [words for _, words in block.rows()]
    known = np.unique(np.concatenate([*hashed, np.empty(0, np.uint64)]))
    return known, [(r["item"], np.searchsorted(known, w).tolist()) for r, w in zip(rows, hashed, strict=True)]


def _searcher(hasher: WordHasher, numbered, keep: tuple[str, ...], window: int):
    known, items = numbered
    automaton = ItemAutomaton(items, window)
    shortest = min([window, *(len(w) for _, w in items if w)])

    def numbers(words: np.ndarray) -> np.ndarray:
        if not len(known):
            return np.full(len(words), -1)
        at = np.minimum(np.searchsorted(known, words), len(known) - 1)
        return np.where(known[at] == words, at, -1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in hasher.texts(batch["__text"]):
                number = numbers(block.words)
                # Only runs of item words can hold a match, and only runs as long as the shortest window.
                inside = np.zeros(len(number) + 2, np.int8)
                inside[1:-1] = number >= 0
                inside[block.at[1:-1] + 1] |= 2
                edges = np.flatnonzero((inside[1:] & 1) != (inside[:-1] & 1))
                rows: list[tuple[list, set]] = [([], set()) for _ in range(block.last - block.first)]
                starts, ends = edges[::2], edges[1::2]
                cuts = block.at[1:-1]
                for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
                    if b - a < shortest:
                        continue
                    row = int(np.searchsorted(block.at, a, side="right")) - 1
                    inner = cuts[np.searchsorted(cuts, a, side="right") : np.searchsorted(cuts, b)]
                    for lo, hi in zip([a, *inner.tolist()], [*inner.tolist(), b], strict=True):
                        if hi - lo >= shortest:
                            row = int(np.searchsorted(block.at, lo, side="right")) - 1
                            automaton.stream(number[lo:hi].tolist(), lo, *rows[row])
                hits = []
                for k, (spans, _) in enumerate(rows):
                    base, byte = int(block.at[k]), int(block.offsets[k])
                    hits.append(
                        [
                            {
                                "first": a - base,
                                "end": b - base,
                                "byte": int(block.start[a]) - byte,
                                "byte_end": int(block.end[b - 1]) - byte,
                            }
                            for a, b in united(spans)
                        ]
                    )
                part = batch.slice(block.first, block.last - block.first)
                arrays = [part[c] for c in keep]
                arrays.append(pa.array(np.diff(block.at), pa.int64()))
                arrays.append(pa.array(hits, _HIT_TYPE))
                arrays.append(pa.array([sorted(x - {""}) for _, x in rows], pa.list_(pa.string())))
                yield pa.RecordBatch.from_arrays(arrays, names=[*keep, "n_words", "hits", "items"])

    return run


def judged(found: DataFrame, parts: int = COVERAGE_PARTS) -> DataFrame:
    """``find_passages`` with ``n_hit`` and ``contaminated``: some word is hit, and one in ``parts`` or more."""
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda total, h: total + h["end"] - h["first"])
    return found.withColumn("n_hit", n_hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * parts >= F.col("n_words"))
    )


def report(found: DataFrame) -> DataFrame:
    """One row per document with its counts, and the digest of the items found."""
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without contaminated rows, and with the hit passages cut from the others.

    A passage goes from its first to its last hit word; what stands around it stays as it is. Texts without hits are
    returned unchanged, NULL included. An ``n_chars`` column is set anew where text was cut.
    """
    columns = docs.columns
    row = F.struct(*(F.col(f"`{c}`") for c in columns))
    found = judged(find_passages(docs.select(row.alias("__row"), F.col(f"`{text}`").alias("__body")), benchmark, "__body", keep=("__row", "__body")))
    kept = found.where(~F.col("contaminated"))
    data = F.encode("__body", "UTF-8")

    def cut(state, h):
        return F.struct(
            F.concat(state["text"], F.substring(data, (state["at"] + 1).cast("int"), (h["byte"] - state["at"]).cast("int"))).alias("text"),
            h["byte_end"].alias("at"),
        )

    start = F.struct(F.lit(b"").alias("text"), F.lit(0).cast("long").alias("at"))
    pieces = F.aggregate("hits", start, cut)
    rest = F.concat(pieces["text"], data.substr((pieces["at"] + 1).cast("int"), F.octet_length("__body")))
    body = F.when(F.size("hits") == 0, F.col("__body")).otherwise(F.decode(rest, "UTF-8"))
    out = kept.select("__row.*", body.alias("__new"), F.size("hits").alias("__cuts"))
    changed = {text: F.col("__new")}
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(F.col("__cuts") > 0, F.length("__new").cast(kind)).otherwise(F.col("n_chars"))
    return out.withColumns(changed).select(*(F.col(f"`{c}`") for c in columns))
