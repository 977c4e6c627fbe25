"""Personal data: fixed formats, and identifiers that only their context gives away.

E-mail and network addresses, card and telephone numbers of strict formats are found by their form. They are the seeds of a
bootstrap: the words around them become lexical patterns, and looser candidates (numbers with separators, spelled-out or
colon-separated addresses) that stand in the same contexts may be identifiers too. Each round works on the graph of patterns and
distinct values, by joins and sums in Spark: a pattern around ``LEAST_SEEDS`` or more trusted values of a kind has as confidence the sum
of their trust over the number of values it surrounds, those of the kind that are still undecided left out and one added; a candidate's
trust is a noisy-or over its confident patterns. Candidates of high trust are trusted from then on and induce patterns of their own, which
discover further ones, until a round finds nothing new. They are reported with the kind of their patterns. Patterns that surround
values of several kinds do not become confident, nor do chance contexts in running text, which lack seeds.

Texts are read once. What the rounds work on are the few values found, never the texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ctrprep.llm.frames import schema_with
from ctrprep.llm.wordhash import text_slices
from ctrprep.sources.scratch import store

KINDS = ("email", "ip", "card", "phone")
#: Trusted values that make a pattern, the least confidence of a pattern, the least trust of a discovered value, and the most rounds.
LEAST_SEEDS, LEAST_PATTERN, LEAST_TRUST, ROUNDS = 5, 0.4, 0.8, 12

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits is only tried from its first one, which finds the same and keeps long runs linear.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOOSE = {
    "phone": re.compile(r"(?<![\w@.:/+-])\(?[0-9](?:[\x20().-]{0,2}[0-9]){6,14}(?![\w@:/-])"),
    "card": re.compile(r"(?<![\w@.:/+-])[0-9](?:[\x20-]?[0-9]){11,18}(?![\w@:/-])"),
    "email": re.compile(r"(?<![\w.])[A-Za-z0-9._%+-]{1,64}\x20?(?:\(at\)|\[at\])\x20?[A-Za-z0-9-]{1,63}(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]{1,63}){1,4}"),
    "ip": re.compile(r"(?<![\w:])(?:[0-9a-fA-F]{1,4}:){7}[0-9a-fA-F]{1,4}(?![\w:])"),
}
_DIGITS = re.compile(r"[^0-9]")
Span = tuple[int, int, str]


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Strictly formatted identifiers: start, end and kind, in order; one kind's spans do not overlap."""
    found: list[Span] = []
    at, used = text.find("@"), 0
    while at >= 0:
        start = at
        while start > used and text[start - 1] in _LOCAL:
            start -= 1
        host = _HOST.match(text, at + 1) if start < at else None
        if host:
            used = host.end()
            found.append((start, used, "email"))
        else:
            used = max(used, at + 1)
        at = text.find("@", max(at + 1, used))
    for m in _IP.finditer(text):
        # An octet may have more leading zeros than a number may have digits.
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in (part.lstrip("0") for part in m[0].split("."))):
            found.append((*m.span(), "ip"))
    for m in _CARD.finditer(text):
        digits = _DIGITS.sub("", m[0])
        if 12 <= len(digits) <= 19 and _luhn(digits):
            found.append((*m.span(), "card"))
    for m in _PHONE.finditer(text):
        if 9 <= len(_DIGITS.sub("", m[0])) <= 15:
            found.append((*m.span(), "phone"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def loose_spans(text: str, taken: list[Span]) -> list[Span]:
    """Candidates of looser form that overlap none of ``taken``; of overlapping ones the longest."""
    found = sorted(((*m.span(), kind) for kind, p in _LOOSE.items() for m in p.finditer(text)), key=lambda s: (s[0], -s[1], s[2]))
    out: list[Span] = []
    blocked = sorted(taken)
    k = used = 0
    for span in found:
        while k < len(blocked) and blocked[k][1] <= span[0]:
            k += 1
        if span[0] >= used and not any(b[0] < span[1] for b in blocked[k : k + 4]):
            out.append(span)
            used = span[1]
    return out


def contexts(text: str, start: int, end: int) -> list[str]:
    """The lexical patterns around a span: two words before it, and one on either side, of the same line."""
    before = text[max(0, start - 80) : start].rpartition("\n")[2].lower().split()[-2:]
    after = text[end : end + 40].partition("\n")[0].lower().split()[:1]
    out = []
    if len(before) == 2:
        out.append(f"{before[0]} {before[1]} _")
    if before and after:
        out.append(f"{before[-1]} _ {after[0]}")
    return out


_ITEM = pa.struct(
    [("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("seed", pa.bool_()), ("value", pa.string()), ("patterns", pa.list_(pa.string()))]
)
_ITEMS = "array<struct<start: bigint, end: bigint, kind: string, seed: boolean, value: string, patterns: array<string>>>"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_slices(batch, "__text"):
            rows = []
            for text in part["__text"].to_pylist():
                items: list[dict] = []
                if text and ("@" in text or "(at)" in text or "[at]" in text or re.search("[0-9]", text)):
                    base = base_spans(text)
                    spans = [(s, True) for s in base] + [(s, False) for s in loose_spans(text, base)]
                    for (start, end, kind), seed in spans:
                        value = re.sub(r"[\x20()-]", "", text[start:end].lower())
                        items.append({"start": start, "end": end, "kind": kind, "seed": seed, "value": value, "patterns": contexts(text, start, end)})
                rows.append(items)
            columns = [part[c] for c in part.schema.names if c != "__text"]
            names = [c for c in part.schema.names if c != "__text"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(rows, pa.list_(_ITEM))], names=[*names, "items"])


def _discovered(edges: DataFrame) -> DataFrame:
    """(kind, value) of candidates that their patterns give away. ``edges`` are distinct (pattern, kind, value, seed)."""
    edges = store(edges, "pii-edges")
    candidates = edges.where("not seed").select("pattern", "kind", "value").distinct()
    places = edges.select("pattern", "kind", "value").distinct()
    trusted = store(edges.where("seed").select("kind", "value", F.lit(1.0).alias("trust")).distinct(), "pii-trusted")
    found = store(trusted.where("false").select("kind", "value"), "pii-found")
    kinds = places.groupBy("pattern", "kind").agg(F.count("*").alias("n"))
    # At most one row of each kind for a pattern.
    sizes = kinds.groupBy("pattern").agg(F.sum("n").alias("total"))
    for k in range(ROUNDS):
        known = places.join(trusted, ["kind", "value"]).groupBy("pattern", "kind").agg(F.count("*").alias("trusted"), F.sum("trust").alias("trust"))
        useful = known.where(F.col("trusted") >= LEAST_SEEDS).join(kinds, ["pattern", "kind"]).join(sizes, "pattern")
        confidence = F.col("trust") / (F.col("trusted") + F.col("total") - F.col("n") + 1)
        confident = useful.select("pattern", "kind", confidence.alias("confidence")).where(F.col("confidence") >= LEAST_PATTERN)
        chance = 1 - F.exp(F.sum(F.log1p(-F.least(F.col("confidence"), F.lit(0.999)))))
        scored = candidates.join(confident, ["pattern", "kind"]).groupBy("kind", "value").agg(chance.alias("trust"))
        new = scored.where(F.col("trust") >= LEAST_TRUST).join(trusted.select("kind", "value"), ["kind", "value"], "left_anti")
        new = store(new, f"pii-new-{k}")
        if new.isEmpty():
            break
        trusted = store(trusted.unionByName(new), f"pii-trusted-{k}")
        found = store(found.unionByName(new.select("kind", "value")), f"pii-found-{k}")
    return found


def find_personal_data(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` with ``spans``: start and end (code points, end exclusive) and kind of each, in order, ``base`` if strict.

    NULL and empty texts have no spans. Rows are told apart by all of ``keep`` and their text, so repeated rows and NULL keys are safe.
    """
    key = F.xxhash64(*keep, F.lit(1)).alias("__a"), F.xxhash64(F.lit(2), *keep, F.col(text)).alias("__b")
    source = docs.select(*keep, *key, F.col(text).alias("__text"))
    schema = schema_with(source, [*keep, "__a", "__b"], f"items {_ITEMS}")
    found = store(source.mapInArrow(_scan, schema), "pii-found")
    each = found.where(F.size("items") > 0).select("__a", "__b", F.explode("items").alias("item")).select("__a", "__b", "item.*")
    edges = each.select(F.explode("patterns").alias("pattern"), "kind", "value", "seed").distinct()
    more = (
        each.where("not seed")
        .join(_discovered(edges), ["kind", "value"])
        .select("__a", "__b", F.struct("start", "end", "kind", F.lit(False).alias("base")).alias("span"))
        .groupBy("__a", "__b")
        .agg(F.collect_set("span").alias("more"))
    )
    base = F.transform(
        F.filter("items", lambda s: s["seed"]), lambda s: F.struct(s["start"], s["end"], s["kind"], F.lit(True).alias("base"))
    )
    rank = F.create_map(*(F.lit(x) for k, kind in enumerate(KINDS) for x in (kind, k)))
    every = F.concat(base, F.coalesce("more", F.array().cast("array<struct<start: bigint, end: bigint, kind: string, base: boolean>>")))
    ordered = F.array_sort(F.transform(every, lambda s: F.struct(s["start"], rank[s["kind"]].alias("rank"), s["end"], s["kind"], s["base"])))
    return found.join(more, ["__a", "__b"], "left").select(*keep, ordered.alias("spans"))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; overlapping spans are replaced together.

    Texts without spans are returned unchanged, NULL included; ``n_chars`` is set anew where text changed.
    """
    columns = docs.columns
    row = F.struct(*(F.col(f"`{c}`") for c in columns if c != text))
    rows = docs.select(row.alias("__row"), F.col(f"`{text}`").alias("__body"))
    found = find_personal_data(rows, "__body", keep=("__row", "__body"))
    schema = schema_with(found, ["__row", "__body"], "__cuts int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, cuts = [], []
            for body, spans in zip(batch["__body"].to_pylist(), batch["spans"].to_pylist(), strict=True):
                pieces, at = [], 0
                for s in spans or ():
                    if s["start"] >= at:
                        pieces += [body[at : s["start"]], f"[{s['kind'].upper()}]"]
                    at = max(at, s["end"])
                texts.append(body if not spans else "".join([*pieces, body[at:]]))
                cuts.append(len(spans or ()))
            yield pa.RecordBatch.from_arrays([batch["__row"], pa.array(texts, pa.string()), pa.array(cuts, pa.int32())], names=["__row", "__body", "__cuts"])

    done = found.mapInArrow(run, schema).select("__row.*", F.col("__body").alias("__new"), "__cuts")
    changed = {text: F.col("__new")}
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(F.col("__cuts") > 0, F.length("__new").cast(kind)).otherwise(F.col("n_chars"))
    return done.withColumns(changed).select(*(F.col(f"`{c}`") for c in columns))
