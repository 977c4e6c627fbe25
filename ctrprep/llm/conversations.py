"""Repair of the turn structure of conversations at the least cost.

The rows of a conversation, by turn, are kept, given another role, deleted or joined by inserted rows until their role initials read
``(s?(ua)+)?``. The cheapest edits are a shortest path over (row, state of that expression), with one integer as weight of an edge:
the high digits carry the cost, and below them every row has a slot of ``SLOT`` digits at its own position for the letters of its edit
(insertions before it, then its own), filled up with zeros at the end. A letter word ends with the row's own letter, so no word begins
another; therefore the smaller integer is the cheaper path and, among those of equal cost, the one whose letters come first. The
shortest path is an ordinary minimum over sums of such integers and needs no tie rule of its own.

Edits: keep (K, 0), new role user or assistant (R, 1), delete (D, 2; the only edit of a blank or repeated row), insert an empty row of
role user or assistant (I, 5). A truncated row that is not deleted costs 5 more.

Conversations of at most ``LONG`` rows are repaired whole, in the order of one shuffle. Longer ones are never gathered in a task: their
rows are sorted over all partitions and stored, each run of at most ``SEGMENT`` rows is summed up by what the cheapest way from each
state to each other costs and how these ways compare as letters, and a walk over these few numbers decides which way each run takes.
Both ways give the same result; which one a conversation takes depends on its number of rows only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ctrprep.llm.components import apart
from ctrprep.llm.frames import kept_in_worker
from ctrprep.sources.scratch import store

#: Rows of a conversation that one task repairs as a whole, and of a run of a longer one.
LONG, SEGMENT = 2048, 512
#: Letters of one row's edit: at most three insertions and its own.
SLOT = 4
_DIGIT = {"D": 1, "I": 2, "K": 3, "R": 4}
_BITS = 4 * SLOT
#: States of the expression: nothing yet, after s, after u, after a; the first and last may end it.
_STATES, _ENDS = 4, (0, 3)
USER, ASSISTANT = "user", "assistant"
_NEXT = (2, 2, 3, 2)
_REFUSED = "!"
_SPACE = " \t\n\v\f\r"
#: Conversations of up to so many rows are looked up by their rows' kinds, among so many at most.
_KNOWN_ROWS, _KNOWN = 32, 50_000


def _edits(kind: str, truncated: bool) -> tuple[tuple[int, int, int, str], ...]:
    """(state, next state, cost, letters) of a row of role initial ``kind``; ``!`` can only be deleted.

    Of several ways between the same states the cheapest and then first is enough, since what else a path costs does not depend on it.
    Insertions right before a deletion are left out: the same insertions after it cost as much and come first.
    """
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for state in range(_STATES):
        ways = [(state, 2, "D")]
        at, more = state, 5 if truncated else 0
        for inserted in range(SLOT if kind != _REFUSED else 0):
            to = _NEXT[at]
            ways.append((to, 5 * inserted + 1 + more, "I" * inserted + "R"))
            if kind == "ua"[to == 3]:
                ways.append((to, 5 * inserted + more, "I" * inserted + "K"))
            if kind == "s" and at == 0:
                ways.append((1, 5 * inserted + more, "I" * inserted + "K"))
            at = to
        for to, cost, letters in ways:
            best[state, to] = min(best.get((state, to), (1 << 30, "")), (cost, letters))
    return tuple((a, b, cost, letters) for (a, b), (cost, letters) in sorted(best.items()))


def _code(letters: str) -> int:
    return int("".join(str(_DIGIT[c]) for c in letters).ljust(SLOT, "0"), 16)


#: For each kind of row (state, next state, cost, digits of the letters).
_WEIGHTS = {
    (kind, truncated): tuple((a, b, cost, _code(letters)) for a, b, cost, letters in _edits(kind, truncated))
    for kind in ("s", "u", "a", "", _REFUSED)
    for truncated in (False, True)
}


def _end_edits() -> list[tuple[int, int, str]]:
    """(state, cost, letters) of ending the conversation there."""
    out = []
    for state in range(_STATES):
        at, n = state, 0
        while at not in _ENDS:
            at, n = _NEXT[at], n + 1
        out.append((state, 5 * n, "I" * n))
    return out


def ways(kinds: Sequence[tuple[str, bool]], start: int, slots: int | None = None) -> list[int | None]:
    """The least weight from state ``start`` to each state over rows of these kinds; the last slot is left for the end."""
    slots = len(kinds) + 1 if slots is None else slots
    high = _BITS * slots
    least: list[int | None] = [None] * _STATES
    least[start] = 0
    for k, kind in enumerate(kinds):
        shift, after = _BITS * (slots - 1 - k), [None] * _STATES
        for a, b, cost, code in _WEIGHTS[kind]:
            if least[a] is not None:
                weight = least[a] + (cost << high) + (code << shift)
                if after[b] is None or weight < after[b]:
                    after[b] = weight
        least = after
    return least


def letters_of(weight: int, slots: int) -> tuple[int, list[str]]:
    """The cost and each slot's letters of a weight."""
    digits = f"{weight & ((1 << _BITS * slots) - 1):0{SLOT * slots}x}".translate(str.maketrans("01234", " DIKR"))
    return weight >> _BITS * slots, [digits[k : k + SLOT].rstrip() for k in range(0, SLOT * slots, SLOT)]


def _cheapest(kinds: tuple[tuple[str, bool], ...]) -> tuple[int, tuple[str, ...]]:
    if len(kinds) > _KNOWN_ROWS:
        return _whole(kinds)
    known = kept_in_worker("conversations", dict)
    if len(known) > _KNOWN:
        known.clear()
    if kinds not in known:
        known[kinds] = _whole(kinds)
    return known[kinds]


def _whole(kinds: tuple[tuple[str, bool], ...]) -> tuple[int, tuple[str, ...]]:
    """Cost and letters (of each row, then of the end) of a whole conversation."""
    slots = len(kinds) + 1
    least = ways(kinds, 0)
    ends = [least[s] + (cost << _BITS * slots) + (_code(letters) if letters else 0) for s, cost, letters in _end_edits() if least[s] is not None]
    cost, letters = letters_of(min(ends), slots)
    return cost, tuple(letters)


def faults(role: str, text: str, seen: set) -> str:
    """``b`` blank, ``d`` repeated, ``t`` truncated or nothing; what was seen is added to."""
    last = text.rstrip(_SPACE)[-1:]
    if not last:
        return "b"
    if (role, text) in seen:
        return "d"
    seen.add((role, text))
    return "" if last in ".!?" else "t"


def kind_of(role: str, fault: str) -> tuple[str, bool]:
    """What decides a row's edits: its role initial, or that it has to go, and whether it is truncated."""
    initial = role[:1] if role[:1] in ("s", "u", "a") else ""
    return (_REFUSED, False) if fault in ("b", "d") else (initial, fault == "t")


def repaired(rows: Sequence[tuple[str, str]], letters: Sequence[str], state: int) -> tuple[list[str], int]:
    """``role:text`` of what is left of the rows, and the state after; a slot more than rows stands for the end."""
    out = []
    for k, word in enumerate(letters):
        for c in word:
            if c == "D":
                continue
            if c == "K" and rows[k][0][:1] == "s":
                state = 1
                out.append(":".join(rows[k]))
                continue
            state = _NEXT[state]
            role = rows[k][0] if c == "K" else (ASSISTANT if state == 3 else USER)
            out.append(f"{role}:{rows[k][1] if c != 'I' else ''}")
    return out, state


def _legal(a: str, b: str) -> bool:
    return a[:1] + b[:1] in ("su", "ua", "au")


_ROW = "conv_id {kind}, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
_COUNTS = ("blank", "duplicate", "truncated", "illegal")


def repair_rows(rows: Sequence[tuple[int | None, str, str]]) -> tuple:
    """Gaps, the four counts, cost, letters and digest of one conversation's rows (turn, role, text), which are in order."""
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    seen: set = set()
    found = [faults(role, text, seen) for _, role, text in rows]
    illegal = sum(not _legal(a[1], b[1]) for a, b in zip(rows, rows[1:]))
    cost, letters = _cheapest(tuple(kind_of(role, fault) for (_, role, _), fault in zip(rows, found)))
    body, _ = repaired([r[1:] for r in rows], letters, 0)
    digest = hashlib.sha256("\n".join(body).encode("utf-8", "surrogatepass")).hexdigest()
    return gaps, found.count("b"), found.count("d"), found.count("t"), illegal, cost, "".join(letters), digest


def repair(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", copies: str | None = None, long: int = LONG
) -> DataFrame:
    """One row for each conversation: its faults, the cost and letters of its cheapest repair and the digest of what that leaves.

    The column ``copies``, if given, tells how often a row stands at its place, 0 for a row that is only to name its conversation:
    one without rows is returned with no faults and nothing repaired. Rows go by turn, NULL first; rows of one turn by role and
    then text, in the order of code points. NULL roles and texts are one blank. A NULL ``conv_id`` is one conversation.
    """
    times = F.col(f"`{copies}`") if copies else F.lit(1)
    rows = conversations.select(
        F.col(f"`{conv_id}`").alias("__conv"),
        F.col(f"`{turn}`").cast("long").alias("__turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("__role"),
        F.coalesce(F.col(f"`{text}`"), F.lit(" ")).alias("__text"),
        times.cast("long").alias("__copies"),
    )
    kind = rows.schema["__conv"].dataType.simpleString()
    counted = rows.groupBy("__conv").agg(F.sum("__copies").alias("n"))
    large = store(counted.where(F.col("n") > long).select("__conv"), "long-conversations")
    out = _repair_short(rows, large, kind)
    if large.isEmpty():
        return out
    return out.unionByName(_repair_long(rows, large, kind))


def _repair_short(rows: DataFrame, large: DataFrame, kind: str) -> DataFrame:
    same = F.col("__conv").eqNullSafe(F.col("__large"))
    if not large.isEmpty():
        rows = rows.join(large.select(F.col("__conv").alias("__large")), same, "left_anti")
    dealt = rows.repartition("__conv").sortWithinPartitions("__conv", "__turn", "__role", "__text")
    # A batch can end within a conversation, whose rows are held until the next one begins.
    return dealt.mapInArrow(_short, _ROW.format(kind=kind))


def _output(done: list[tuple], conv_type: pa.DataType) -> pa.RecordBatch:
    kinds = [conv_type, *[pa.int64()] * 6, pa.string(), pa.string()]
    columns = list(zip(*done, strict=True)) if done else [[]] * len(kinds)
    names = ["conv_id", "gaps", *_COUNTS, "cost", "audit", "repaired_sha256"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)


def _short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, held, done, conv_type = (), [], [], None
    for batch in batches:
        conv_type = batch["__conv"].type
        for conv, turn, role, text, copies in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (conv,) != last:
                if last:
                    done.append((*last, *repair_rows(held)))
                last, held = (conv,), []
            held += [(turn, role, text)] * copies
        if len(done) >= 2000:
            yield _output(done, conv_type)
            done = []
    if last:
        done.append((*last, *repair_rows(held)))
        yield _output(done, conv_type)


# --- conversations too long for one task ------------------------------------------------------------------------------------------

#: Bits of a stored row's number that count within its partition.
_PART = 33
_SEGMENT_ROW = "seg bigint, {counts}, n bigint, head string, tail string, turns bigint, low bigint, high bigint, cost array<bigint>, place array<int>"


def _repair_long(rows: DataFrame, large: DataFrame, kind: str) -> DataFrame:
    """The same for the conversations of ``large``, run by run."""
    spark = rows.sparkSession
    own = rows.where("__copies > 0").join(
        large.select(F.col("__conv").alias("__large")), F.col("__conv").eqNullSafe(F.col("__large")), "left_semi"
    )
    # Equal rows of one turn travel as one with their number.
    collapsed = own.groupBy("__conv", "__turn", "__role", "__text").agg(F.sum("__copies").alias("__copies"))
    body = F.struct("__role", "__text")
    two = F.xxhash64(body), F.xxhash64(F.lit(5), body)
    keyed = store(
        collapsed.withColumns({"__h1": two[0], "__h2": two[1]})
        .repartitionByRange("__conv", "__turn", "__role", "__text")
        .sortWithinPartitions("__conv", "__turn", "__role", "__text")
        .withColumn("__seq", F.monotonically_increasing_id()),
        "long-rows",
    )
    # The first turn at which a role and text stands in a conversation: partial sums take the frequent ones together, and the rows
    # meet them by a join whose frequent keys can be split.
    firsts = keyed.groupBy("__conv", "__h1", "__h2").agg(F.min("__seq").alias("__first"), F.count("*").alias("__n")).where("__n > 1")
    firsts = firsts.select(F.struct("__conv").alias("__c"), apart("__h1").alias("__a"), F.col("__h2").alias("__b"), "__first")
    places = keyed.select("__seq", F.struct("__conv").alias("__c"), apart("__h1").alias("__a"), F.col("__h2").alias("__b"))
    again = store(places.join(firsts, ["__c", "__a", "__b"]).where("__seq > __first").select("__seq"), "long-again")

    # Runs follow the stored order: some hundred rows of one stored partition each. What is known of a row, and later of a run, travels
    # as a row without a text that comes before it.
    part, place = F.shiftright("__seq", _PART), F.col("__seq").bitwiseAND((1 << _PART) - 1)
    run = (F.shiftleft(part, _PART) + F.floor(place / SEGMENT) * SEGMENT).alias("__run")
    runs = keyed.select("__conv", "__turn", "__role", "__text", "__copies", "__seq", run)
    runs = runs.unionByName(again.select("__seq", run), allowMissingColumns=True)
    counts = ", ".join(f"{c} bigint" for c in _COUNTS)
    conv = f"conv_id {kind}, "
    summed = store(_in_runs(runs).mapInArrow(_summaries, conv + _SEGMENT_ROW.format(counts=counts)), "long-runs")
    # A few hundred bytes for a run, dealt by conversation; no text among them.
    plans = summed.repartition("conv_id").sortWithinPartitions("conv_id", "seg")
    planned = plans.mapInArrow(_plan, conv + "seg bigint, enter int, leave int, last boolean, gaps bigint, " + counts + ", cost bigint")
    planned = store(planned, "long-plans")
    steps = planned.select(F.col("conv_id").alias("__conv"), F.col("seg").alias("__run"), "enter", "leave", "last", F.lit(-1).alias("__seq"))
    edited = _in_runs(runs.unionByName(steps, allowMissingColumns=True)).mapInArrow(_edited, conv + "seg bigint, audit string, body array<string>")
    edited = store(edited, "long-edited")
    digests = edited.select("conv_id", "seg", "body").repartition("conv_id").sortWithinPartitions("conv_id", "seg")
    hashed = digests.mapInArrow(_digest, conv + "repaired_sha256 string").select(F.col("conv_id").alias("__hc"), "repaired_sha256")
    audits = edited.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seg", "audit"))), lambda s: s["audit"]), "").alias("audit"))
    totals = planned.where("last").drop("seg", "enter", "leave", "last")
    out = totals.join(audits.withColumnRenamed("conv_id", "__ac"), F.col("conv_id").eqNullSafe(F.col("__ac")))
    out = out.join(hashed, F.col("conv_id").eqNullSafe(F.col("__hc")))
    return out.select("conv_id", "gaps", *_COUNTS, "cost", "audit", "repaired_sha256")


def _in_runs(rows: DataFrame) -> DataFrame:
    return rows.repartition("__run").sortWithinPartitions("__run", "__seq", F.col("__copies").asc_nulls_first())


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conversation, run, rows, step) of each conversation within each run. A row gets ``again`` if it was seen before; the step is
    the row with the states at the run's ends, where there is one."""
    last, held, steps, repeated = None, [], {}, -1
    for batch in batches:
        for row in batch.to_pylist():
            key = row["__conv"], row["__run"]
            if row["__copies"] is None:
                if row["__seq"] < 0:
                    steps[key] = row
                else:
                    repeated = row["__seq"]
                continue
            if key != last:
                if held:
                    yield *last, held, steps.pop(last, None)
                last, held = key, []
            held.append(row | {"again": row["__seq"] == repeated})
    if held:
        yield *last, held, steps.pop(last, None)


def _spread(rows: list[dict]) -> tuple[list[str], list[tuple[str, bool]], list[tuple[str, str]], list[int]]:
    """Fault, kind and (role, text) of the distinct rows, and how many deletions follow each: copies of a row only repeat it."""
    fault, body, copies = [], [], []
    for row in rows:
        found = faults(row["__role"], row["__text"], set())
        fault.append("d" if row["again"] and found != "b" else found)
        body.append((row["__role"], row["__text"]))
        copies.append(row["__copies"] - 1)
    return fault, [kind_of(r, f) for (r, _), f in zip(body, fault, strict=True)], body, copies


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    done, conv_type = [], None
    for conv, run, rows, _ in _runs(_typed(batches, held := [])):
        conv_type = held[0]
        fault, kinds, body, copies = _spread(rows)
        slots = len(rows) + 1
        cost, place = [], []
        for state in range(_STATES):
            found = ways(kinds, state)
            order = sorted((w & ((1 << _BITS * slots) - 1), s) for s, w in enumerate(found) if w is not None)
            rank = {s: k for k, (_, s) in enumerate(order)}
            cost += [-1 if w is None else w >> _BITS * slots for w in found]
            place += [rank.get(s, -1) for s in range(_STATES)]
        more = sum(copies)
        blank = sum(1 + c for f, c in zip(fault, copies, strict=True) if f == "b")
        again = sum(c if f in ("", "t") else 1 + c for f, c in zip(fault, copies, strict=True) if f != "b")
        # Copies are neighbours of one role, which is never a lawful pair.
        illegal = sum(not _legal(a[0], b[0]) for a, b in zip(body, body[1:])) + more
        turns = [r["__turn"] for r in rows if r["__turn"] is not None]
        cost = [c if c < 0 else c + 2 * more for c in cost]
        done.append(
            (conv, run, blank, again, fault.count("t"), illegal, len(rows), body[0][0][:1], body[-1][0][:1], len(set(turns)), min(turns, default=None), max(turns, default=None), cost, place)
        )
    kinds = [conv_type, *[pa.int64()] * 6, pa.string(), pa.string(), *[pa.int64()] * 3, pa.list_(pa.int64()), pa.list_(pa.int32())]
    names = ["conv_id", "seg", *_COUNTS, "n", "head", "tail", "turns", "low", "high", "cost", "place"]
    if done:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), kinds, strict=True)], names=names)


def _typed(batches: Iterator[pa.RecordBatch], held: list) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held[:] = [batch["__conv"].type]
        yield batch


def plan(costs: Sequence[Sequence[int]], places: Sequence[Sequence[int]]) -> tuple[int, list[int]]:
    """The cost of a conversation, and the state at the start of each run and at the end.

    From the end backwards, for each state the least cost of the rest. Ways of equal cost are told apart by their letters in the run at
    hand: two ways through a run with the same letters lead to the same state, so there is never a tie.
    """
    rest = [5 * len(letters) for _, _, letters in _end_edits()]
    choices: list[list[int]] = []
    for cost, place in zip(reversed(costs), reversed(places), strict=True):
        least = []
        for a in range(_STATES):
            options = [(cost[k] + rest[b], place[k], b) for b in range(_STATES) if cost[k := _STATES * a + b] >= 0]
            least.append(min(options))
        rest = [total for total, _, _ in least]
        choices.append([b for _, _, b in least])
    path = [0]
    for chosen in reversed(choices):
        path.append(chosen[path[-1]])
    return rest[0], path


def _plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Which way each run of a conversation takes; the totals stand in its last row."""
    conv_type, done = None, []

    def finish(rows: list[dict]) -> None:
        total, path = plan([r["cost"] for r in rows], [r["place"] for r in rows])
        known = [r for r in rows if r["low"] is not None]
        joins = sum(not _legal(a["tail"], b["head"]) for a, b in zip(rows, rows[1:]))
        # Two runs share a turn where the one ends with what the other begins with.
        shared = sum(a["high"] == b["low"] for a, b in zip(known, known[1:]))
        gaps = known[-1]["high"] - known[0]["low"] + 1 - (sum(r["turns"] for r in known) - shared) if known else 0
        sums = [sum(r[c] for r in rows) for c in _COUNTS]
        sums[3] += joins
        for k, r in enumerate(rows):
            done.append((r["conv_id"], r["seg"], path[k], path[k + 1], k == len(rows) - 1, gaps, *sums, total))

    rows: list[dict] = []
    for batch in batches:
        conv_type = batch["conv_id"].type
        for row in batch.to_pylist():
            if rows and rows[0]["conv_id"] != row["conv_id"]:
                finish(rows)
                rows = []
            rows.append(row)
    if rows:
        finish(rows)
        kinds = [conv_type, pa.int64(), pa.int32(), pa.int32(), pa.bool_(), *[pa.int64()] * 6]
        names = ["conv_id", "seg", "enter", "leave", "last", "gaps", *_COUNTS, "cost"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), kinds, strict=True)], names=names)


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The letters of each run and what it leaves."""
    for conv, run, rows, step in _runs(_typed(batches, held := [])):
        _, kinds, body, copies = _spread(rows)
        enter, leave = step["enter"], step["leave"]
        letters = letters_of(ways(kinds, enter)[leave], len(rows) + 1)[1][:-1]
        left, state = repaired(body, letters, enter)
        audit = "".join(word + "D" * more for word, more in zip(letters, copies, strict=True))
        if step["last"]:
            end = _end_edits()[state][2]
            left += repaired([], [end], state)[0]
            audit += end
        arrays = [pa.array([conv], held[0]), pa.array([run], pa.int64()), pa.array([audit], pa.string()), pa.array([left], pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays(arrays, names=["conv_id", "seg", "audit", "body"])


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation's pieces in order, a piece at a time."""
    last, digest, empty, done, conv_type = (), None, True, [], None
    for batch in batches:
        conv_type = batch["conv_id"].type
        for conv, body in zip(batch["conv_id"].to_pylist(), batch["body"].to_pylist(), strict=True):
            if (conv,) != last:
                if last:
                    done.append((*last, digest.hexdigest()))
                last, digest, empty = (conv,), hashlib.sha256(), True
            for line in body:
                digest.update((line if empty else "\n" + line).encode("utf-8", "surrogatepass"))
                empty = False
    if last:
        done.append((*last, digest.hexdigest()))
        arrays = [pa.array(c, t) for c, t in zip(zip(*done, strict=True), [conv_type, pa.string()], strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names=["conv_id", "repaired_sha256"])


def damage(conversations: DataFrame) -> DataFrame:
    """``conversations`` with faults that follow from ``conv_id`` and ``turn`` alone, and ``__copies``: how often each row stands.

    By crc32 of ``conv_id:turn``, modulo 20: 0 drops the row, 1 empties its text, 2 takes the marks ``.!?`` from it, 3 repeats it,
    4 makes its role user. NULLs are one blank in the sum, in roles and in texts. Dropped rows stay, with no copies.
    """
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"), fault.alias("__fault"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("__fault") == 4, F.lit(USER)).otherwise(F.col("role")).alias("role"),
        F.when(F.col("__fault") == 1, F.lit("")).when(F.col("__fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("__fault") == 0, 0).when(F.col("__fault") == 3, 2).otherwise(1).alias("__copies"),
    )
