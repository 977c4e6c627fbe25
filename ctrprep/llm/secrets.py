"""Secrets in text, all rules in one pass over the bytes.

All rules, whole, are compiled together into one minimal deterministic automaton. Scanning gives, for each byte, the
rules of which a match ends there. From the first such byte behind the match before, the rule's reversed pattern is walked back
to the leftmost start; the match ends where these bytes cease to follow each other. Matches of a rule do not overlap
and are taken from left to right; what fails a rule's size afterwards is dropped, with its text used up. Each byte is walked a
fixed number of times, however rules' beginnings nest.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ctrprep.llm.automaton import Automaton, compile_patterns, either_case, parse, reverse
from ctrprep.llm.frames import schema_with
from ctrprep.llm.wordhash import text_blocks


@dataclass(frozen=True)
class Rule:
    """A pattern, and ``keep``, which decides on a match's bytes whether it is reported.

    Matches from one start have to end at places that follow each other, so that the longest ends with the last, no match may
    lie within one that starts earlier and can only end later, and none may hold a line feed.
    """

    kind: str
    pattern: str
    keep: Callable[[bytes], bool] = lambda match: True
    any_case: bool = False


def _at_least(n: int) -> Callable[[bytes], bool]:
    return lambda match: len(match) >= n


def _assigned(match: bytes) -> bool:
    """Whether six characters or more are assigned."""
    at = min(k for k in (match.find(b":"), match.find(b"=")) if k >= 0)
    value = match[at + 1 :].lstrip(b" ")
    return len(value) - value.startswith((b'"', b"'")) >= 6


#: The first three are what every report counts; the others are further formats of well-known issuers.
BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=\-]+""", _assigned, True),
    Rule("access", r"AKIA[A-Z0-9]+", _at_least(20)),
    Rule("hex", r"[0-9a-f]{8,}", _at_least(24)),
)
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("web_token", r"eyJ[A-Za-z0-9_\-]+\.eyJ[A-Za-z0-9_\-]+\.[A-Za-z0-9_\-]+", _at_least(40)),
    Rule("code_host", r"gh[oprsu]_[A-Za-z0-9]+", _at_least(40)),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9\-]+", _at_least(20)),
    Rule("payment", r"[rs]k_live_[A-Za-z0-9]+", _at_least(24)),
    Rule("cloud_key", r"AIza[A-Za-z0-9_\-]+", _at_least(39)),
)
RULES = BASE_RULES + MORE_RULES
SPANS = "array<struct<start: bigint, rank: int, end: bigint, kind: string>>"


class Scanner:
    """The rules as automata: all together, and each alone, forwards to be taken up behind a match and backwards for starts."""

    def __init__(self, rules: tuple[Rule, ...] = RULES) -> None:
        trees = [either_case(parse(r.pattern)) if r.any_case else parse(r.pattern) for r in rules]
        self.rules = rules
        self.together = compile_patterns(trees)
        self.alone = [compile_patterns([n]) for n in trees]
        self.back = [compile_patterns([reverse(n)], anchored=True) for n in trees]

    def spans(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(row, start, end, rule) in bytes of their rows, for rows that are joined by one line feed."""
        ends = self.together.accepts[self.together.scan(data)]
        hit = np.flatnonzero(ends)
        bits = ends[hit]
        found: list[tuple[int, int, int, int]] = []
        for k, rule in enumerate(self.rules):
            places = hit[bits & (1 << k) > 0]
            firsts = np.append(True, places[1:] != places[:-1] + 1) if len(places) else np.empty(0, bool)
            begins, lasts = places[firsts], places[np.append(firsts[1:], True)] if len(places) else places
            run, used = 0, 0
            while run < len(begins):
                row = int(np.searchsorted(offsets, begins[run], side="right")) - 1
                used, high = max(used, int(offsets[row])), int(offsets[row + 1])
                place = max(used, int(begins[run]))
                start = _leftmost(self.back[k], data, used, place + 1)
                if start is None:
                    # The match that ends here began before ``used``; the rule alone tells the first that did not.
                    place = _first_end(self.alone[k], data, used, high)
                    start = None if place is None else _leftmost(self.back[k], data, used, place + 1)
                if start is None:
                    used = high
                else:
                    used = int(lasts[np.searchsorted(lasts, place)]) + 1
                    if rule.keep(data[start:used].tobytes()):
                        found.append((row, start - int(offsets[row]), used - int(offsets[row]), k))
                run = int(np.searchsorted(lasts, used))
        return found


def _leftmost(back: Automaton, data: np.ndarray, low: int, end: int) -> int | None:
    """The smallest start of a match that ends at ``end`` and does not begin before ``low``."""
    state, best, at = 0, None, end
    while at > low:
        at -= 1
        state = int(back.table[state * back.classes + back.byte_class[data[at]]])
        if state == back.dead:
            break
        if back.accepts[state]:
            best = at
    return best


def _first_end(alone: Automaton, data: np.ndarray, low: int, high: int) -> int | None:
    """The last byte of the match that ends first of those within ``low`` and ``high``."""
    state = 0
    for at in range(low, high):
        state = int(alone.table[state * alone.classes + alone.byte_class[data[at]]])
        if alone.accepts[state]:
            return at
    return None


@cache
def _scanner() -> Scanner:
    return Scanner()


def code_point(data: np.ndarray, at: int) -> int:
    """The number of characters in the first ``at`` bytes."""
    return int(np.count_nonzero((data[:at] & 0xC0) != 0x80))


def find_secrets(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` with ``spans``: start and end (code points, end exclusive), kind and the kind's rank, in order.

    NULL and empty texts have no spans. Every row is looked at by itself, so repeated rows give equal spans.
    """
    schema = schema_with(docs, keep, f"spans {SPANS}")
    scanner = _scanner()
    kind = pa.list_(pa.struct([("start", pa.int64()), ("rank", pa.int32()), ("end", pa.int64()), ("kind", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in text_blocks(batch["__text"]):
                rows: list[list[dict]] = [[] for _ in range(last - first)]
                for r, start, end, k in scanner.spans(data, offsets):
                    own = data[offsets[r] : offsets[r + 1]]
                    begin = code_point(own, start)
                    span = {"start": begin, "rank": k, "end": begin + code_point(own[start:], end - start), "kind": scanner.rules[k].kind}
                    rows[r].append(span)
                for spans in rows:
                    spans.sort(key=lambda s: (s["start"], s["rank"], s["end"]))
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays([*(part[c] for c in keep), pa.array(rows, kind)], names=[*keep, "spans"])

    return docs.select(*keep, F.col(text).alias("__text")).mapInArrow(run, schema)


def span_report(found: DataFrame, base: tuple[str, ...], base_only: bool = False) -> DataFrame:
    """``doc_id``, the number of spans of each base kind, the digest of these spans, and all spans as text.

    With ``base_only``, spans count as base ones only if their ``base`` says so.
    """

    def written(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of_kind(*kinds: str):
        return F.filter("spans", lambda s: (s["kind"].isin(*kinds) & s["base"]) if base_only else s["kind"].isin(*kinds))

    return found.select(
        "doc_id",
        *(F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in base),
        F.sha2(written(of_kind(*base)), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )
